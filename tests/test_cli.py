"""Command line entry points on staging Parquet written from the smallest test tables."""

import json
import uuid

from starforge import cli, schemas
from starforge.session import work_path
from starforge.sources.adapter import staging_from_driver
from starforge.sources.staging import write_staging
from starforge.sources.table_state import read_state
from starforge.streaming.incremental import fact_batches


def test_cli_load_dq_profile(spark, capsys):
    root = work_path(spark, "test-cli", uuid.uuid4().hex)
    write_staging(staging_from_driver(spark, "/root/testdata/sf0.001"), f"{root}/staging")
    cli.main(["load", "--staging", f"{root}/staging", "--warehouse", f"{root}/wh",
              "--as-of", "2002-01-01", "--spine-start", "1995-01-01", "--spine-end", "2003-12-31"])
    out = capsys.readouterr().out
    rep = json.loads(out[out.index('{"run_id"'):].splitlines()[0])
    assert rep["run_id"] == "20020101"
    assert [s["status"] for s in rep["stages"]] == ["success"] * 5
    assert rep["stages"][0]["rows"] == 3287  # 1995-01-01 .. 2003-12-31
    cli.main(["dq", "--staging", f"{root}/staging", "--warehouse", f"{root}/wh", "--as-of", "2002-01-01"])
    whole = capsys.readouterr().out
    assert "Orphan payments" in whole
    for _ in range(2):  # the same day again adds nothing
        cli.main(["dq", "--staging", f"{root}/staging", "--warehouse", f"{root}/wh", "--as-of", "2002-01-01", "--batch", "b1", "--compact"])
        daily = capsys.readouterr().out
        for rule in ("Duplicate payment_id", "Orphan payments", "Underage members", "Invalid plan_type"):
            assert [x for x in daily.splitlines() if x.startswith(rule)] == [x for x in whole.splitlines() if x.startswith(rule)] != []
    cli.main(["profile", "--staging", f"{root}/staging", "--rows", "3"])
    out = capsys.readouterr().out
    assert "== lottery months, top 10" in out and "n_members" in out
    cli.main(["incremental", "--warehouse", f"{root}/wh", "--as-of", "2002-01-02", "--checkpoint", f"{root}/ck",
              "--members-in", f"{root}/staging/members", "--payments-in", f"{root}/staging/payments"])
    full = spark.read.parquet(f"{root}/wh/fact_payments/run_id=20020101").count()
    assert fact_batches(spark, f"{root}/wh").count() == full > 0
    batch = read_state(spark, f"{root}/wh", "fact_payments").batches
    assert len(batch) == 1  # the same payments again: the fact that load wrote holds all of them
    assert spark.read.schema(schemas.FACT_PAYMENTS).parquet(f"{root}/wh/fact_payments/run_id={batch[0]}").count() == 0
    assert "run_id" in spark.read.parquet(f"{root}/wh/fact_payments").columns  # one folder column: the table's folder reads
