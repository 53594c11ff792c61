"""Foreign keys enforced by the load. Rows of a fact whose member, plan or date has no parent are marked in one
pass, with the first parent they lack as the reason; the rest of the rows is what the fact takes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge.functions.calendar import date_key

NO_MEMBER, NO_PLAN, NO_DATE = "no member", "no plan", "no date"


def date_keys(dim_date: DataFrame) -> DataFrame:
    """The parent keys of ``date_key``: one row a day of the spine."""
    return dim_date.select("date_key").distinct()


def within_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Rows of a fact whose date key has a parent; a NULL key passes, as in SQL."""
    known = date_keys(dim_date).withColumn("_d", F.lit(True))
    return fact.join(known, "date_key", "left").where(F.col("_d") | F.col("date_key").isNull()).select(*fact.columns)


def rejected_rows(rows: DataFrame, date, dim_member: DataFrame, dim_plan: DataFrame, dim_date: DataFrame | None) -> DataFrame:
    """Staging rows (member_id, plan_id and more) without a current member, a plan, or ``date`` in the calendar, with the
    ``reason``. Columns are those of ``rows``. Without ``dim_date`` dates are not held against it."""
    members = dim_member.where(F.col("is_current")).select("member_id", F.lit(True).alias("_m")).distinct()
    plans = dim_plan.select("plan_id", F.lit(True).alias("_p")).distinct()
    marked = rows.join(members, "member_id", "left").join(plans, "plan_id", "left")
    reason = F.when(F.col("_m").isNull(), NO_MEMBER).when(F.col("_p").isNull(), NO_PLAN)
    if dim_date is not None:
        marked = marked.withColumn("_k", date_key(date)).join(date_keys(dim_date).select(F.col("date_key").alias("_k"), F.lit(True).alias("_d")), "_k", "left")
        reason = reason.when(F.col("_k").isNotNull() & F.col("_d").isNull(), NO_DATE)
    return marked.select(*rows.columns, reason.alias("reason")).where(F.col("reason").isNotNull())


def held_against(rows: DataFrame, date, dim_member: DataFrame, dim_plan: DataFrame, dim_date: DataFrame | None,
                 member_columns: tuple[str, ...] = ("member_key",)) -> DataFrame:
    """``rows`` with the keys of their parents and the ``reason`` of a rejection (NULL: none), from one join with each
    parent: what :func:`taken` and :func:`rejected` read once it is stored. A row is there once for each pair of parents of
    its ids, as in an inner join; ``first_parents`` marks one of them."""
    def numbered(parent: DataFrame, key: str) -> DataFrame:
        w = Window.partitionBy(key).orderBy(*[c for c in parent.columns if c != key])
        return parent.withColumn(f"_{key}", F.row_number().over(w))

    members = numbered(dim_member.where(F.col("is_current") & F.col("member_id").isNotNull()).select("member_id", *member_columns), "member_id")
    plans = numbered(dim_plan.where(F.col("plan_id").isNotNull()).select("plan_id", "plan_key"), "plan_id")
    marked = rows.join(members, "member_id", "left").join(plans, "plan_id", "left")
    reason = F.when(F.col("_member_id").isNull(), NO_MEMBER).when(F.col("_plan_id").isNull(), NO_PLAN)
    if dim_date is not None:
        marked = marked.withColumn("_k", date_key(date)).join(date_keys(dim_date).select(F.col("date_key").alias("_k"), F.lit(True).alias("_d")), "_k", "left")
        reason = reason.when(F.col("_k").isNotNull() & F.col("_d").isNull(), NO_DATE)
    first = (F.coalesce("_member_id", F.lit(1)) == 1) & (F.coalesce("_plan_id", F.lit(1)) == 1)
    return marked.select(*rows.columns, *member_columns, "plan_key", reason.alias("reason"), first.alias("first_parents"))


def rejected(held: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of :func:`rejected_rows`, each once, from stored rows of :func:`held_against`."""
    return held.where(F.col("reason").isNotNull() & F.col("first_parents")).select(*columns, "reason")


def taken(held: DataFrame) -> DataFrame:
    """The rows that have all their parents."""
    return held.where(F.col("reason").isNull()).drop("reason", "first_parents")


def joined():
    """Whether a row has its member and plan, whatever its date."""
    return F.col("reason").isNull() | (F.col("reason") == NO_DATE)
