"""Fault injection (I1-I5): table-to-table jobs that plant known dirty data.

Sampling is a deterministic threshold on an MD5 of (seed, key): no sort, no
shuffle, the same rows in any engine that has MD5, and stable on re-run. The
fraction holds in expectation, not exactly. Rows sharing a key share a fate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.functions.exact import scaled


def _key(keys) -> Column:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def threshold_hex(fraction: float) -> str:
    """32-hex-digit cut so that md5 < cut holds for ``fraction`` of uniform hashes."""
    f = min(max(fraction, 0.0), 1.0)
    return format(min(int(f * 16 ** 32), 16 ** 32 - 1), "032x")


def in_sample(keys, fraction: float, seed: int | str, salt: str = "") -> Column:
    """Sampling predicate on the key's hash."""
    h = F.md5(F.concat(F.lit(f"{seed}:{salt}"), _key(keys)))
    return h < F.lit(threshold_hex(fraction))


def hash_int(keys, seed: int | str, salt: str) -> Column:
    """A 32-bit non-negative integer from the hash (first 8 hex digits)."""
    h = F.md5(F.concat(F.lit(f"{seed}:{salt}"), _key(keys)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def hash_sample(df: DataFrame, keys, fraction: float, seed: int = 42) -> DataFrame:
    """Fraction sample without replacement (by key)."""
    return df.where(in_sample(keys, fraction, seed, "s"))


def inject_nulls(df: DataFrame, keys, column: str, fraction: float = 0.08,
                 seed: int = 42) -> DataFrame:
    """Set ``column`` to NULL on the sampled rows."""
    dtype = df.schema[column].dataType
    return df.withColumn(column, F.when(in_sample(keys, fraction, seed, "n"),
                                        F.lit(None).cast(dtype)).otherwise(F.col(column)))


def inject_duplicates(df: DataFrame, keys, fraction: float = 0.03, seed: int = 42) -> DataFrame:
    """Append exact copies of the sampled rows."""
    return df.unionByName(df.where(in_sample(keys, fraction, seed, "d")))


def inject_negative(df: DataFrame, keys, column: str = "paid_amount", fraction: float = 0.005,
                    seed: int = 42) -> DataFrame:
    """I4: replace ``column`` by a negative amount in [-9999.00, -1.00] on sampled rows."""
    cents = F.lit(100) + F.pmod(hash_int(keys, seed, "v"), F.lit(999801))
    dtype = df.schema[column].dataType
    neg = scaled(-cents, 2).cast(dtype)
    return df.withColumn(column, F.when(in_sample(keys, fraction, seed, "g"), neg)
                         .otherwise(F.col(column)))


def inject_bad_dates(df: DataFrame, keys, paid: str = "paid_date", due: str = "due_date",
                     fraction: float = 0.003, seed: int = 42) -> DataFrame:
    """A non-NULL paid date becomes 1-10 days before the due date on sampled rows."""
    back = (F.lit(1) + F.pmod(hash_int(keys, seed, "b"), F.lit(10))).cast("int")
    hit = in_sample(keys, fraction, seed, "t") & F.col(paid).isNotNull()
    return df.withColumn(paid, F.when(hit, F.date_sub(F.col(due), back)).otherwise(F.col(paid)))
