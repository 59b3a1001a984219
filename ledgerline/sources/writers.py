"""Writers with pinned schemas, and stores that survive reruns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.tables import fresh_path


def pin(df: DataFrame, schema: str) -> DataFrame:
    """Exactly the columns and types of the schema, in its order."""
    fields = [part.strip().split(" ", 1) for part in schema.split(",")]
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in fields])


def write_parquet(df: DataFrame, path: str, schema: str, rows_per_file: int = 5_000_000) -> None:
    pin(df, schema).write.option("compression", "snappy").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Append; every part file carries its header, which the reader expects."""
    df.write.mode("append").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_monthly(df: DataFrame, ts: str, path: str) -> None:
    """One folder per calendar month, so a month filter reads that folder only.

    Rows are spread by (month, day) first: each month is written by up to 31 tasks, not by one.
    """
    spread = df.withColumn("month", F.date_format(ts, "yyyy-MM"))
    spread.repartition("month", F.dayofmonth(ts)).write.partitionBy("month").parquet(path)


def create_monthly_views(monthly: DataFrame, prefix: str) -> list[str]:
    """Twelve temporary views over a ``write_monthly`` table, one per month of the year.

    Each view filters the folder column, so it reads the folders of its month and nothing else.
    """
    names = []
    for m in range(1, 13):
        name = f"{prefix}_{m:02d}"
        monthly.where(F.col("month").endswith(f"-{m:02d}")).createOrReplaceTempView(name)
        names.append(name)
    return names


def fill_missing(rows: DataFrame, cache: str | None, keys: Sequence[str], build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results for all rows: those in the cache are reused, the others are built and appended to it."""
    spark = rows.sparkSession
    if cache is None:
        cache = fresh_path(spark, "cache")
        build(rows).write.parquet(cache)
    else:
        done = spark.read.parquet(cache).select(*keys)
        build(rows.join(done, list(keys), "left_anti")).write.mode("append").parquet(cache)
    return spark.read.parquet(cache)


def backfill_missing(df: DataFrame, part: str, path: str, job: Callable[[DataFrame], DataFrame]) -> list:
    """Run ``job`` for the partition values that are wanted and not in the store yet; returns those values."""
    spark = df.sparkSession
    wanted = df.select(part).distinct()
    have = spark.read.parquet(path).select(part).distinct()
    todo = [r[0] for r in wanted.join(have, part, "left_anti").orderBy(part).collect()]  # partition values only
    if todo:
        job(df.where(F.col(part).isin(todo))).write.mode("append").partitionBy(part).parquet(path)
    return todo
