"""Exact samples and dense numbers."""

import pytest
from pyspark.sql import functions as F

from starforge.operators import selection


@pytest.mark.parametrize("n, k", [(0, 0), (0, 5), (7, 0), (7, 3), (7, 7), (7, 9), (30_000, 4_321)])
def test_first_by_hash_takes_exactly_k(spark, n, k):
    df = spark.range(n).select(F.col("id"), (F.col("id") % 13).alias("x"))
    got = [r.id for r in selection.first_by_hash(df, k, ["id"]).collect()]
    assert len(got) == len(set(got)) == min(n, k)
    order = [r.id for r in df.orderBy(selection.sample_hash(df, ["id"], 42)).collect()]
    assert set(got) == set(order[:k])


def test_equal_rows_and_keys(spark, monkeypatch):
    monkeypatch.setattr(selection, "LAST_BIN", 4)
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").alias("k"), (F.col("id") % 3).alias("x"))  # null keys too
    for k in (1, 299, 300, 301, 950, 1000):
        got = selection.first_by_hash(df, k, ["k"]).collect()
        assert len(got) == k
    assert selection.exact_sample(df, 0.1234, ["k"]).count() == 123
    assert selection.exact_sample(df.limit(0), 0.5, ["k"]).count() == 0


@pytest.mark.parametrize("rows_per_task", [1, 7, 10_000])
def test_dense_numbers_have_no_gaps_and_go_on(spark, rows_per_task):
    df = spark.range(20).select((F.col("id") * 7 % 20).alias("k"))
    one, high = selection.dense_numbers(df, ["k"], "no", rows_per_task=rows_per_task)
    assert high == 20 and [(r.k, r.no) for r in one.orderBy("k").collect()] == [(i, i + 1) for i in range(20)]
    two, high = selection.dense_numbers(df.where("k < 5"), ["k"], "no", high, rows_per_task)
    assert high == 25 and [r.no for r in two.orderBy("k").collect()] == [21, 22, 23, 24, 25]
    assert selection.dense_numbers(df.limit(0), ["k"], "no", high)[1] == 25


def test_sample_of_a_join_moves_whole_rows_of_the_sample_only(spark):
    """The filter on the key's hash is below the join, so that only the sample's rows are joined (F1)."""
    pays = spark.range(2000).select(F.col("id").alias("o"), F.concat(F.lit("p"), (F.col("id") % 700).cast("string")).alias("k"))
    orders = spark.range(2000).select(F.col("id").alias("o"), (F.col("id") % 5).alias("c"))
    df = pays.hint("shuffle_merge").join(orders, "o")
    got = selection.exact_sample(df, 0.1, ["k"])
    whole = df.orderBy(selection.sample_hash(df, ["k"], 42)).limit(200)
    assert got.count() == 200 and got.exceptAll(whole).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan[plan.index("Join"):]
