"""Sinks: snapshot tables (S3/S4), insert-ignore append (S5) and the run audit.

Plain Parquet has no UPDATE/MERGE and a job must not overwrite the path it
reads, so every load writes a new snapshot directory ``<table>/run_id=<id>``;
readers take the greatest *complete* one (it has a ``_SUCCESS`` marker).
Re-running a run id overwrites only that run's directory, so a replay after a
lost executor or a failed attempt is harmless.
"""

from __future__ import annotations

import datetime as dt
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def write_snapshot(df: DataFrame, base: str, table: str, run_id: str,
                   partition_by: list[str] | None = None) -> str:
    """S3: write ``df`` as the snapshot ``run_id`` of ``table`` (overwrite of that run only)."""
    path = f"{base.rstrip('/')}/{table}/run_id={run_id}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_part(df: DataFrame, base: str, table: str, run_id: str, first: bool) -> str:
    """Write ``df`` as the ``first`` or a further part of the snapshot ``run_id``: it is complete, and seen by readers, once
    :func:`complete` has marked it. A first part replaces what the run had."""
    path = f"{base.rstrip('/')}/{table}/run_id={run_id}"
    w = df.write.mode("overwrite" if first else "append").option("compression", "zstd")
    w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return path


def complete(spark: SparkSession, base: str, table: str, run_id: str) -> None:
    """Mark a snapshot of :func:`append_part` as complete."""
    fs, done, _ = _fs(spark, f"{base.rstrip('/')}/{table}/run_id={run_id}/_SUCCESS")
    fs.create(done, True).close()


def run_order(run_id: str) -> tuple:
    """Sort key of run ids: runs of digits compare as numbers, so that d9 comes before d10."""
    return tuple((1, int(x), "") if x.isdigit() else (0, 0, x) for x in re.split(r"(\d+)", run_id) if x)


def snapshot_runs(spark: SparkSession, base: str, table: str, prefix: str = "run_id=") -> list[str]:
    """Complete snapshot run ids of ``table``, oldest first (directory listing only)."""
    fs, root, jvm = _fs(spark, f"{base.rstrip('/')}/{table}")
    if not fs.exists(root):
        return []
    runs = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                runs.append(name[len(prefix):])
    return sorted(runs, key=run_order)


def _runs(spark, base, table, before=None, upto=None) -> list[str]:
    return [r for r in snapshot_runs(spark, base, table)
            if (before is None or run_order(r) < run_order(before)) and (upto is None or run_order(r) <= run_order(upto))]


def runs_upto(spark: SparkSession, base: str, table: str, upto: str) -> list[str]:
    """Complete runs up to ``upto``, oldest first."""
    return _runs(spark, base, table, upto=upto)


def read_latest(spark: SparkSession, base: str, table: str, schema: T.StructType | None = None,
                before: str | None = None, upto: str | None = None) -> DataFrame | None:
    """The greatest complete snapshot, optionally only among runs before ``before``
    (exclusive) or up to ``upto`` (inclusive)."""
    runs = _runs(spark, base, table, before, upto)
    if not runs:
        return None
    path = f"{base.rstrip('/')}/{table}/run_id={runs[-1]}"
    if schema is None:
        return spark.read.parquet(path)
    # partition columns come back last; restore the declared order
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_scd2_current(spark: SparkSession, base: str, table: str, schema: T.StructType,
                      before: str | None = None, upto: str | None = None) -> DataFrame | None:
    """Current rows of an SCD2 table: the ``is_current=true`` part of the newest
    complete run (each run stores its whole current set there)."""
    runs = _runs(spark, base, table, before, upto)
    if not runs:
        return None
    path = f"{base.rstrip('/')}/{table}/run_id={runs[-1]}"
    return (spark.read.schema(schema).parquet(path).where(F.col("is_current"))
                 .select(*schema.fieldNames()))


def read_scd2(spark: SparkSession, base: str, table: str, schema: T.StructType,
              before: str | None = None, upto: str | None = None) -> DataFrame | None:
    """The whole SCD2 table: newest current set plus every run's closed rows.

    A run writes only the rows it closed under ``is_current=false``; history is
    append-only and is never rewritten.
    """
    runs = _runs(spark, base, table, before, upto)
    if not runs:
        return None
    root = base.rstrip("/")
    cur = read_scd2_current(spark, base, table, schema, before, upto)
    closed = (spark.read.schema(schema).option("basePath", f"{root}/{table}")
                   .parquet(*[f"{root}/{table}/run_id={r}" for r in runs])
                   .where(~F.col("is_current")).select(*schema.fieldNames()))
    return closed.unionByName(cur)


def append_audit(spark: SparkSession, base: str, run_id: str, stage: str, status: str,
                 rows: int = 0, duration: float = 0.0, error: str | None = None, rejected: int = 0) -> None:
    """Append one audit row, committed on its own (one small JSON file per
    stage and run, created through the cluster file system; no Spark job)."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rec = {"run_id": run_id, "stage": stage, "status": status, "rows_inserted": int(rows), "rows_rejected": int(rejected),
           "duration_sec": float(duration), "error_msg": error,
           "logged_at": now.isoformat(timespec="milliseconds")}
    name = f"{run_id}__{now.strftime('%Y%m%dT%H%M%S%f')}__{stage}.json"
    write_small(spark, f"{base.rstrip('/')}/stage_runs/{name}", json.dumps(rec) + "\n")


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, complete or absent: written beside its place, then renamed."""
    fs, final, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{final.getParent().toString()}/_tmp/{final.getName()}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(tmp, final):
        raise OSError(f"could not move {tmp.toString()} to {path}")


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a file of :func:`write_small`; None where there is none."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    fs, p, _ = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p, _ = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def drop_old_runs(spark: SparkSession, base: str, table: str, keep: int) -> list[str]:
    """Delete all but the newest ``keep`` complete snapshots of a table that each run
    writes whole. Not for the member dimension: its runs hold the closed history."""
    old = snapshot_runs(spark, base, table)[:-max(1, keep)]
    for r in old:
        remove(spark, f"{base.rstrip('/')}/{table}/run_id={r}")
    return old


def read_audit(spark: SparkSession, base: str) -> DataFrame:
    return (spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", "false")
                 .json(f"{base.rstrip('/')}/stage_runs/*.json"))

