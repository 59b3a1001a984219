"""Input tables and the shared folder jobs may write to."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one input table; the Parquet footer carries the declared schema."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Hand a scan with fewer pieces than cores to all cores; a large table has pieces enough and stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def place(df: DataFrame, *keys: str) -> DataFrame:
    """Rows placed by key in a stated number of pieces.

    The number is stated because work on texts is heavy per byte: left alone, adaptive execution would
    merge the pieces by their size and idle most cores.
    """
    spark = df.sparkSession
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(pieces, *keys)


def in_pieces(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """A stored table placed by key in pieces of about ``rows`` rows; one whose pieces are smaller stays as it is.

    Learners unfold and keep a whole piece (thousands of numbers a row), so pieces are cut by rows, not by stored bytes.
    """
    pieces = -(-df.count() // rows)
    return df.repartition(pieces, *keys) if pieces > df.rdd.getNumPartitions() else df


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is missing, a session on this machine alone uses a
    local folder; on a cluster that is an error, since executors could not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        folder = os.path.join(tempfile.gettempdir(), "ledgerline-local")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that no earlier job wrote to."""
    return f"{shared_folder(spark)}/ledgerline/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
