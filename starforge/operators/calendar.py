"""Calendar dimension (C1/R8/D1), holiday set (C8) and holiday proximity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.functions import calendar as cal


def _d(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        x = dt.date.fromisoformat(x)
    return F.lit(x)


def calendar_rows(days: DataFrame, col: str = "full_date") -> DataFrame:
    """Calendar attributes of every date in ``col``."""
    d = F.col(col)
    return days.select(
        cal.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).cast("int").alias("day"),
        F.month(d).cast("int").alias("month"),
        cal.quarter(d).alias("quarter"),
        F.year(d).cast("int").alias("year"),
        cal.day_of_week(d).alias("day_of_week"),
        cal.day_name(d).alias("day_name"),
        cal.is_weekend(d).alias("is_weekend"),
        cal.is_holiday(d).alias("is_holiday"),
        cal.is_ramadan(d).alias("is_ramadan"),
    )


def date_spine(spark: SparkSession, start=cal.DEFAULT_SPINE[0], end=cal.DEFAULT_SPINE[1]) -> DataFrame:
    """One row per day from start to end inclusive, spread over partitions.

    ``spark.range`` over the day offsets is generated in parallel on the
    executors (no driver-side list, no single-partition explode).
    """
    start = dt.date.fromisoformat(start) if isinstance(start, str) else start
    end = dt.date.fromisoformat(end) if isinstance(end, str) else end
    n = (end - start).days + 1
    parts = max(1, min(spark.sparkContext.defaultParallelism, n // 365 + 1))
    days = spark.range(0, max(n, 0), numPartitions=parts).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    return days


def dim_date(spark: SparkSession, start=cal.DEFAULT_SPINE[0], end=cal.DEFAULT_SPINE[1]) -> DataFrame:
    """The calendar dimension for a fixed span."""
    return calendar_rows(date_spine(spark, start, end))


def dim_date_covering(*date_cols: tuple[DataFrame, str | list[str]]) -> DataFrame:
    """D1 over the span the data needs: every day between the smallest and largest date.

    Bounds come from a global min/max aggregate (partial per partition); the
    days are produced by ``sequence`` on that one bounds row, so the spine grows
    with the calendar span, not with the row count.
    """
    bounds = None
    for df, cols in date_cols:
        cols = [cols] if isinstance(cols, str) else list(cols)
        mins = [F.min(c) for c in cols]
        maxs = [F.max(c) for c in cols]
        b = df.agg(*[m.alias(f"lo{i}") for i, m in enumerate(mins)],
                   *[m.alias(f"hi{i}") for i, m in enumerate(maxs)])
        lo = [F.col(f"lo{i}") for i in range(len(cols))]
        hi = [F.col(f"hi{i}") for i in range(len(cols))]
        b = b.select((F.least(*lo) if len(lo) > 1 else lo[0]).alias("lo"),
                     (F.greatest(*hi) if len(hi) > 1 else hi[0]).alias("hi"))
        bounds = b if bounds is None else bounds.unionByName(b)
    span = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    return calendar_rows(days)


def holiday_calendar(spark: SparkSession, years: DataFrame | None = None,
                     first_year: int = cal.DEFAULT_HOLIDAY_YEARS[0],
                     last_year: int = cal.DEFAULT_HOLIDAY_YEARS[1]) -> DataFrame:
    """Distinct holiday dates = fixed (month, day) for every year, plus religious days.

    ``years`` is a one-column DataFrame (``year``) of the years to cover, e.g.
    the distinct years of the data; by default the fixed year range is used.
    Religious holidays are dated, so only those falling in the years are kept.
    """
    if years is None:
        years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    years = years.select(F.col("year").cast("int").alias("year")).distinct()
    fixed = years.select(F.explode(F.array(*[
        F.make_date(F.col("year"), F.lit(m), F.lit(d)) for m, d in cal.FIXED_HOLIDAYS
    ])).alias("holiday"))
    religious_starts = spark.createDataFrame(
        [(dt.date(y, m, d), n) for y, m, d, n in cal.RELIGIOUS_HOLIDAYS], "start date, n int")
    religious = religious_starts.select(
        F.explode(F.sequence("start", F.date_add("start", F.col("n") - 1))).alias("holiday"))
    # years: distinct calendar years, at most a few thousand rows -> broadcast is bounded
    religious = religious.join(F.broadcast(years), F.year("holiday") == years.year, "left_semi")
    return fixed.unionByName(religious).distinct()


def near_holiday_days(holidays: DataFrame, window: int = 7) -> DataFrame:
    """Every day d with a holiday h where 0 <= h - d <= window (distinct)."""
    return holidays.select(F.explode(F.sequence(F.date_sub("holiday", window), F.col("holiday")))
                           .alias("near_day")).distinct()


def flag_near_holiday(df: DataFrame, date_col: str, holidays: DataFrame, window: int = 7,
                      out: str = "near_holiday") -> DataFrame:
    """Flag rows whose date lies within ``window`` days before a holiday (or on it).

    Rewritten from "scan every holiday per row" to an equi-join on the
    expanded day set. That set holds distinct calendar dates, so it can never
    exceed the number of days in the calendar span (a few thousand rows for
    decades of data): it is broadcast explicitly, and the big side is never
    shuffled even when the holidays are derived from the data itself.
    """
    days = near_holiday_days(holidays, window).withColumn("_near", F.lit(True))
    j = df.join(F.broadcast(days), F.col(date_col) == F.col("near_day"), "left")
    return j.withColumn(out, F.coalesce(F.col("_near"), F.lit(False))).drop("near_day", "_near")
