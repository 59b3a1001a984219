"""What the operators of this package share: written intermediates, text batches, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.tables import fresh_path

_resident: list = []


def resident(key: tuple, make: Callable[[], object]):
    """What a worker process keeps for its next task: one thing at a time.

    Spark reuses workers across stages, so tables that one operator has filled would still be there when the next one
    needs the memory. The old thing goes, and its memory goes back to the system, before the new one is made.
    """
    if not _resident or _resident[0] != key:
        if _resident:
            _resident.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim is not None:
                trim(0)
        _resident.extend((key, make()))
    return _resident[1]


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


class Scratch:
    """Tables written to the shared folder for one job: lineage ends there, and lost executors lose nothing.

    ``drop`` deletes a table that no later step reads. What the returned DataFrame reads stays.
    """

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark, self.root = spark, fresh_path(spark, tag)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about ``most`` bytes of text; a longer text is a piece of its own."""
    at = batch.schema.get_field_index(column)
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # Arrow keeps what the pieces took, else


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node its links reach.

    Alternates large stars and small stars until the edges stop changing. Each step is a minimum per node, merged
    before the shuffle, and a join that skew handling may split: no list of neighbours is ever held.
    """
    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    mark, turn = _mark(now), 0
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        turn += 1
        after = scratch.write(small, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
