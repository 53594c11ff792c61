"""First-wins de-duplication per key (S5 insert-ignore, W2 DISTINCT ON).

Implemented as ``row_number() = 1`` over the key: Spark plans a partial
WindowGroupLimit *before* the shuffle, so each map task forwards at most one
row per key and a hot key (even a third of all rows) costs no more shuffle
than a cold one. The ordering must be total for a deterministic winner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key group under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: list[str],
                  order: list[Column]) -> DataFrame:
    """S5 against an existing target: the first incoming row per key wins, then keys
    already held are dropped (the order of the two doesn't change the result, and a hot
    key reaches the join as one row). Returns only the rows to append."""
    return first_per_key(incoming, keys, order).join(target.select(*keys), keys, "left_anti")
