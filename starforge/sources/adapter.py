"""Driver test tables -> staging tables (members, plans, subscriptions, payments, lottery).

This module only reshapes the given TPC-H-like tables into the staging schemas
of :mod:`starforge.schemas` (FIXTURES.md section 2). It does none of the star
schema work; every job downstream must be right on any data of those schemas.
The same mapping is written in SQL in :mod:`starforge.oracle`.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge import schemas
from starforge.schemas import conform

# Reference date and calendar span used for data built from the driver tables.
AS_OF = dt.date(2002, 1, 1)
SPINE = (dt.date(1995, 1, 1), dt.date(2003, 12, 31))

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


class DriverTables:
    """Lazy readers for the parquet files of one scale factor.

    The test files hold a single row group each, which Spark cannot split: the
    scan is one task. ``spread`` asks for that many partitions, dealt
    round-robin; by default a scan is left as it is.
    """

    SMALL_TABLES = {"region", "nation"}

    def __init__(self, spark: SparkSession, sf_dir: str, spread: int | None = None):
        self.spark = spark
        self.spread = spread
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if self.spread and name not in self.SMALL_TABLES:
            df = df.repartition(self.spread)
        self.__dict__[name] = df
        return df


def _padded_id(letter: str, key: Column, width: int) -> Column:
    """Zero-padded to ``width`` digits; longer keys keep all their digits."""
    return F.when(key.isNotNull(), F.format_string(f"{letter}%0{width}d", key.cast("long")))


def member_id_of(key: Column) -> Column:
    return _padded_id("M", key, 8)


def plan_id_of(key: Column) -> Column:
    return _padded_id("P", key, 6)


def _members(t: DriverTables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    base = (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
             .join(first, c.c_custkey == first.o_custkey, "left"))
    k = F.col("c_custkey")
    status = (F.when(k % 59 == 0, "askida")  # no valid status
              .when(F.col("c_mktsegment") == "FURNITURE", "terk")
              .when(F.col("c_mktsegment") == "MACHINERY", "gecikmeli")
              .when(F.col("c_mktsegment") == "HOUSEHOLD", "pasif")
              .otherwise("aktif"))
    # k % 33 = 0 rows appear twice; the copy is 30 days newer and "pasif".
    copy = F.explode(F.when(k % 33 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    base = base.select("*", copy.alias("_copy"))
    dup = F.col("_copy") == 1
    signup = F.col("first_order").cast("date")
    rows = base.select(
        member_id_of(k).alias("member_id"),
        F.col("c_name").alias("full_name"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .when(k % 41 == 0, F.lit(""))
         .otherwise(F.sha2(k.cast("string"), 256)).alias("tc_hash"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("district"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(1940 + k % 75).cast("int").alias("birth_year"),
        F.make_date((1940 + k % 75).cast("int"), (1 + k % 12).cast("int"),
                    (1 + k % 28).cast("int")).alias("birth_date"),
        (F.col("c_acctbal") * 25).cast("decimal(12,2)").alias("income"),
        F.when(dup, F.date_add(signup, 30)).otherwise(signup).alias("signup_date"),
        F.when(dup, F.lit("pasif")).otherwise(status).alias("status"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("email"),
    )
    return conform(rows, schemas.STAGING_MEMBERS)


def _plans(t: DriverTables) -> DataFrame:
    p = F.col("p_partkey")
    kind = F.split(F.col("p_type"), " ").getItem(0)
    plan_type = (F.when(kind == "STANDARD", "konut").when(kind == "ECONOMY", "arsa")
                 .when(kind == "MEDIUM", "ticari").when(kind == "SMALL", "arac")
                 .when(kind == "LARGE", "isyeri").when(kind == "PROMO", "diger"))
    out = t.part.select(
        plan_id_of(p).alias("plan_id"),
        F.col("p_name").alias("plan_name"),
        plan_type.alias("plan_type"),
        F.when(p % 97 == 0, 0).otherwise(F.col("p_size")).cast("int").alias("duration_months"),
        (F.col("p_retailprice") * 1000).cast("decimal(15,2)").alias("target_amount"),
    )
    return conform(out, schemas.STAGING_PLANS)


def _subscriptions(t: DriverTables) -> DataFrame:
    st = F.col("o_orderstatus")
    out = (t.orders.where(F.col("o_orderkey") % 50 != 0).select(
        F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("subscription_id"),
        member_id_of(F.col("o_custkey")).alias("member_id"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.when(st == "O", "aktif").when(st == "P", "beklemede").when(st == "F", "terk")
         .alias("subscription_status")))
    return conform(out, schemas.STAGING_SUBSCRIPTIONS)


def _payments(t: DriverTables) -> DataFrame:
    unpaid = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    money = lambda c: c.cast("decimal(12,2)")
    # short columns before the join: what it shuffles
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("due"),
        (F.col("l_quantity").cast("long") % 15).cast("int").alias("q"), unpaid.alias("unpaid"),
        (F.col("l_returnflag") == "R").alias("returned"), money(F.col("l_extendedprice")).alias("price"),
        F.when(unpaid, money(F.lit(0)))
         .when(F.col("l_suppkey") % 50 == 0, money(-F.col("l_quantity")))
         .otherwise(money(F.col("l_extendedprice"))).alias("paid_amount"))
    o = t.orders.select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    unpaid, q, due = F.col("unpaid"), F.col("q"), F.col("due")
    out = j.select(
        F.concat(F.lit("PAY"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("payment_id"),
        F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("subscription_id"),
        member_id_of(F.col("o_custkey")).alias("member_id"),
        plan_id_of(F.col("l_partkey")).alias("plan_id"),
        F.col("l_linenumber").cast("int").alias("installment_no"),
        due.alias("due_date"),
        F.when(unpaid, F.lit(None).cast("date"))
         .otherwise(F.date_add(due, q - 5)).alias("paid_date"),
        F.when(F.col("l_orderkey") % 101 == 7, F.lit(None).cast("decimal(12,2)"))
         .when(F.col("l_orderkey") % 101 == 11, money(F.lit(0)))
         .otherwise(F.col("price")).alias("due_amount"),
        "paid_amount",
        F.when(F.col("l_orderkey") % 101 == 13, "iade")  # no valid status
         .when(unpaid, "odenmedi").when(F.col("returned"), "kismi")
         .when(q > 8, "gecikmeli").otherwise("odendi").alias("payment_status"),
    )
    return conform(out, schemas.STAGING_PAYMENTS)


def _lottery(t: DriverTables) -> DataFrame:
    o = F.col("o_orderkey")
    n_parts = t.part.select(F.count(F.lit(1))).scalar()  # scalar subquery, no join
    out = t.orders.withColumn("_n_parts", n_parts).select(  # bound once, read as a column
        F.concat(F.lit("L"), o.cast("string")).alias("lottery_id"),
        member_id_of(F.col("o_custkey")).alias("member_id"),
        plan_id_of(o % F.col("_n_parts")).alias("plan_id"),
        F.date_add(F.col("o_orderdate").cast("date"), (o % 700).cast("int")).alias("lottery_date"),
        (1 + o % 8).cast("int").alias("lottery_round"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_winner"),
    )
    return conform(out, schemas.STAGING_LOTTERY)


@dataclass
class Staging:
    """The five staging tables as DataFrames."""
    members: DataFrame
    plans: DataFrame
    subscriptions: DataFrame
    payments: DataFrame
    lottery: DataFrame


class DriverStaging(Staging):
    """Staging tables derived lazily from a driver scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, spread: int | None = None):  # noqa: D107
        self.tables = DriverTables(spark, sf_dir, spread)

    members = cached_property(lambda self: _members(self.tables))
    plans = cached_property(lambda self: _plans(self.tables))
    subscriptions = cached_property(lambda self: _subscriptions(self.tables))
    payments = cached_property(lambda self: _payments(self.tables))
    lottery = cached_property(lambda self: _lottery(self.tables))


def staging_from_driver(spark: SparkSession, sf_dir: str, spread: int | None = None) -> Staging:
    return DriverStaging(spark, sf_dir, spread)


def previous_members(members: DataFrame) -> DataFrame:
    """Staging members as they stood one day earlier, for SCD2 runs on driver data.

    Keys with k % 7 = 0 did not exist yet and keys with k % 5 = 0 had the other
    of aktif / pasif as status (k = numeric part of member_id). Same schema as
    the input; the SCD2 job then sees inserts, updates and unchanged rows.
    """
    k = F.substring("member_id", 2, 64).cast("long")
    flipped = F.when(F.col("status") == "aktif", "pasif").otherwise("aktif")
    return (members.where(k % 7 != 0)
                   .withColumn("status", F.when(k % 5 == 0, flipped).otherwise(F.col("status"))))
