import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starforge.session import build_session
    s = build_session("local[4]", app="starforge-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    from starforge.session import work_dir
    work_dir(s)  # uses spark.checkpoint.dir; sets a scratch one only where unset
    yield s
