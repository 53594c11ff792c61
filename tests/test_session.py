"""Session helpers: cluster sizing and the shared work folder."""

from starforge.session import scale_conf, work_dir, work_path


def test_scale_conf_sizes_partitions_and_bounds():
    c = scale_conf(shuffle_bytes=30 * 2 ** 40, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 30 * 2 ** 40 // (256 << 20)
    assert int(c["spark.sql.autoBroadcastJoinThreshold"]) == 64 << 20
    small = scale_conf(shuffle_bytes=1 << 20, total_cores=100)
    assert int(small["spark.sql.shuffle.partitions"]) == 300  # at least three waves of tasks


def test_work_dir_reads_the_session_setting(spark):
    d = work_dir(spark)
    assert d and not d.endswith("/")
    preset = spark.conf.get("spark.checkpoint.dir", None)
    if preset:  # a cluster-provided folder is used as is, never replaced
        assert d == preset.rstrip("/")
    assert work_path(spark, "a", "b/") == f"{d}/a/b"
