"""Readers with declared schemas."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_tsv_sources(spark: SparkSession, sources: Mapping[str, str], schema: str) -> DataFrame:
    """Headerless tab files, quotes taken literally, each row tagged with its source."""
    out = None
    for tag, path in sources.items():
        part = spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path).withColumn("source", F.lit(tag))
        out = part if out is None else out.unionByName(part)
    return out


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def read_many(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All files of a glob or list, with the file each row came from."""
    many = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*many).withColumn("origin", F.col("_metadata.file_path"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of every archive under a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")


def unzip_csv(archives: DataFrame, schema: str, columns: Sequence[str]) -> DataFrame:
    """The rows of the one CSV inside each archive; an archive with none or several stops the job."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    inside = [m for m in z.namelist() if m.lower().endswith(".csv")]
                    if len(inside) != 1:
                        raise ValueError(f"{name}: expected one CSV, found {len(inside)}")
                    with z.open(inside[0]) as f:
                        for piece in pd.read_csv(f, dtype=str, keep_default_na=False, na_values=[""], chunksize=50_000):
                            yield piece[list(columns)]

    texts = archives.mapInPandas(unpack, ", ".join(f"{c} string" for c in columns))
    kinds = dict(part.strip().split(" ", 1) for part in schema.split(","))
    return texts.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns])


# experiment / run / metrics or params / name, with or without Spark's partition prefixes.
RUN_PATH = r"/(?:exp=)?([^/]+)/(?:run=)?([^/]+)/(?:kind=)?(metrics|params)/(?:name=)?([^/]+?)(?:/part-[^/]*)?$"


def read_run_logs(spark: SparkSession, root: str) -> DataFrame:
    """(experiment, run, kind, name, value) from one small file per metric or parameter.

    A metric file reads ``time value step``; a parameter file holds its value.
    """
    files = (
        spark.read.option("wholetext", True)
        .option("recursiveFileLookup", True)
        .text(root)
        .select(F.col("_metadata.file_path").alias("path"), F.trim(F.regexp_replace("value", r"\s+", " ")).alias("body"))
    )
    part = [F.regexp_extract("path", RUN_PATH, i) for i in range(1, 5)]
    rows = files.select(*[p.alias(n) for p, n in zip(part, ("experiment", "run", "kind", "name"))], "body").where(F.col("kind") != "")
    return rows.select(
        "experiment", "run", "kind", "name", F.when(F.col("kind") == "metrics", F.split("body", " ")[1]).otherwise(F.col("body")).alias("value")
    )


def wide_runs(logs: DataFrame, metrics: Sequence[str], params: Sequence[str]) -> DataFrame:
    """One row per run with the listed metrics as numbers and parameters as text."""
    names = [f"metrics.{m}" for m in metrics] + [f"params.{p}" for p in params]
    wide = logs.withColumn("what", F.concat_ws(".", "kind", "name")).groupBy("experiment", "run").pivot("what", names).agg(F.max("value"))
    return wide.select(
        "experiment", "run", *[F.col(f"`metrics.{m}`").try_cast("double").alias(m) for m in metrics], *[F.col(f"`params.{p}`").alias(p) for p in params]
    )


def best_run(runs: DataFrame, metric: str) -> DataFrame:
    """The run with the lowest metric per experiment; ties go to the first run name."""
    best = F.min(F.struct(F.col(metric), F.col("run")))
    return runs.where(F.col(metric).isNotNull()).groupBy("experiment").agg(best.alias("b")).select("experiment", "b.run", f"b.{metric}")
