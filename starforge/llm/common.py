"""Helpers shared by the corpus operators: shared folders, batch bounds, joins on skewed keys."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.session import work_path

#: Rows and bytes in one Arrow batch handed to Python: the bound of a worker's input.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
#: A key holding more than this share of all rows is hot; at most 1 / HOT_SHARE keys can be.
HOT_SHARE = 1.0 / 1000

_SENT: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Before Python runs on executors: bound what one Arrow batch may hold, so that long texts don't pile
    up in a worker, and send the package along (once per application)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="starforge-code-"))  # on the driver; executors fetch it
    archive = os.path.join(folder, "starforge_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.join(os.path.basename(root), os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(archive)
    _SENT.add(app)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a new folder under the shared work folder and read it back.

    This cuts lineage: what follows reads files that every executor sees, so
    a lost executor never causes the work before to run again, and columns
    that depend on the physical layout (partition numbers) are fixed.
    """
    spark = df.sparkSession
    path = work_path(spark, "llm", f"{tag}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_groups(rows: DataFrame, groups: DataFrame, on: str | list[str], size: str, share: float = HOT_SHARE) -> DataFrame:
    """Inner join of row facts to group facts (one row per ``on``) without loading one task with a hot group.

    ``size`` is the group's row count in ``groups``. Groups above ``share`` of
    the counted rows number at most 1 / share: those few are broadcast and
    their rows never move. All other groups hold at most that share, so the
    shuffle join of the rest is even. Both inputs are read twice: pass stored tables.
    """
    on = [on] if isinstance(on, str) else on
    total = groups.agg(F.sum(size)).first()[0] or 0
    limit = max(1.0, float(total) * share)
    hot = F.broadcast(groups.where(F.col(size) > limit))
    cold = groups.where(F.col(size) <= limit)
    near = rows.join(hot, on, "inner")
    far = rows.join(hot.select(*on), on, "left_anti").join(cold, on, "inner")
    return near.unionByName(far)


def spare(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to differ from all columns of ``df``."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def keep_named(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Only the columns an operator needs, cast; a missing one is null. Other columns can't clash."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[c]}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()])
