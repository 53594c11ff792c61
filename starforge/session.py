"""SparkSession settings the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job assumes: UTC dates, adaptive execution (coalescing, skew
# join splitting, runtime broadcast switch) and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "starforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` so one
    shuffle partition holds roughly 128-256 MB; AQE coalesces small ones.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def scale_conf(shuffle_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 << 20,
               broadcast_bytes: int = 64 << 20) -> dict:
    """Settings for a cluster run, from the largest expected shuffle and the core count.

    * one shuffle partition per ``target_partition_bytes`` of the largest
      shuffle (the payment fact), at least 3 waves of tasks; AQE coalesces the
      small stages and splits skewed ones, so this is an upper bound, not a
      target for every stage;
    * scans split at the same size, so an input split fits in task memory;
    * Catalyst/AQE broadcast a join side only while its measured size is
      under ``broadcast_bytes``; the library forces a broadcast only for
      sets with a proven bound (see the README); the member dimension at full
      scale stays a sort-merge join;
    * a partition is "skewed" when over 4x the median and over 512 MB; AQE then
      splits it (inner, left outer, left semi/anti sides).
    """
    parts = max(3 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def apply_runtime_conf(spark: SparkSession) -> None:
    """Settings that can be changed on a running session (used on sessions we did not build)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # static or locked conf on a managed cluster
            pass


# Shuffle files of a write or action are deleted when it ends, not when the driver next collects garbage; a join whose
# smaller side has at most this size in every shuffle partition (measured) hashes it instead of sorting both.
LOAD_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


@contextmanager
def load_settings(spark: SparkSession):
    """Settings of a load that stores what it uses again: under them an action repeated on the same DataFrame object has
    to shuffle again. Those of before are restored."""
    before = {k: spark.conf.get(k, None) for k in LOAD_CONF}
    for k, v in LOAD_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the platform (HDFS / object store) so that
    every executor sees it; unset, it is an error there. Only on a local master
    (tests) a scratch folder is created and registered as the checkpoint directory.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:
            d = None
    if not d and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:  # unset: local tests only
        d = tempfile.mkdtemp(prefix="starforge-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core setting locked at runtime; the context dir below holds it
            pass
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
    except Exception:
        pass
    return d.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([work_dir(spark)] + [p.strip("/") for p in parts])
