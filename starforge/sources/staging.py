"""Staging scan (S1) and bulk staging write (S2) with declared schemas."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from starforge import schemas
from starforge.schemas import conform


def read_staging(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Scan one staging table with its declared schema (no inference)."""
    return spark.read.schema(schemas.STAGING[table]).parquet(f"{base.rstrip('/')}/{table}")


def read_raw_staging(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One staging table with the types its files have, for checks before the cast to the declared ones."""
    return spark.read.parquet(f"{base.rstrip('/')}/{table}")


def read_all_staging(spark: SparkSession, base: str):
    from starforge.sources.adapter import Staging
    return Staging(**{t: read_staging(spark, base, t) for t in schemas.STAGING})


def write_staging(staging, base: str) -> None:
    """Replace the staging tables (truncate + bulk insert) under ``base``, as concurrent jobs."""
    frames = {t: conform(getattr(staging, t), schema) for t, schema in schemas.STAGING.items()}
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        list(pool.map(lambda t: frames[t].write.mode("overwrite").parquet(f"{base.rstrip('/')}/{t}"), frames))


def read_staging_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
                      partition_column: str | None = None, lower: int | None = None,
                      upper: int | None = None, num_partitions: int = 64) -> DataFrame:
    """S1 from the operational database: a staging table read over JDBC, split into
    ``num_partitions`` range queries on a numeric ``partition_column`` (e.g. the
    SERIAL ``id``) so executors read in parallel, then shaped to the declared
    schema. Only the declared columns are selected, so the database sends no
    more than the loaders use. Not exercised here: the tests run without a
    database server.
    """
    schema = schemas.STAGING[table.split(".")[-1]]
    query = "(SELECT {} FROM {}) AS t".format(
        ", ".join([f.name for f in schema.fields] + ([partition_column] if partition_column else [])),
        table)
    r = spark.read.options(**properties)
    if partition_column:
        df = r.jdbc(url, query, column=partition_column, lowerBound=lower, upperBound=upper,
                    numPartitions=num_partitions)
    else:
        df = r.jdbc(url, query)
    return conform(df, schema)
