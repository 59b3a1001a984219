"""Long keys in order: rows numbered along one range sort, and digests of what each key's rows spell in a row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

#: Binary logarithm of the rows that a block may hold at most.
BLOCK_BITS = 10


def number_rows(df: DataFrame, order: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """``df`` written in the order of ``order`` (nulls first) with ``pos``, a number that rises along it.

    Rows are placed by range of all of ``order``, so one key with most rows is sorted by many tasks. Along a task's
    rows ``pos`` rises by one. Written before use, so that a lost executor cannot renumber anything.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.write(placed.withColumn("pos", F.monotonically_increasing_id()), name)


def block(pos: str = "pos", bits: int = BLOCK_BITS) -> Column:
    """The block of a row: with its key, a run of at most 2 ** ``bits`` neighbours. Blocks rise with the rows."""
    return F.shiftright(F.col(pos), bits)


def joined_sha256(df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, between: str) -> DataFrame:
    """(keys, sha256): lower-case SHA-256 of the texts of each key's rows in ``order``, parted by ``between``.

    A digest of a sequence is sequential by definition, so a key's rows pass one task, as a stream: memory holds one
    batch of rows, whatever the key's length. Null texts count as empty. ``keys`` must be longs.
    """
    schema = ", ".join(f"{k} long" for k in keys) + ", sha256 string"
    part = between.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            names = list(zip(*(batch.column(i).to_pylist() for i in range(len(keys))), strict=True))
            for key, value in zip(names, batch.column(len(keys)).to_pylist(), strict=True):
                if key != now or digest is None:
                    if digest is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(value or b"")
                else:
                    digest.update(part + (value or b""))
            if done:
                yield rows(done)
        if digest is not None:
            yield rows([(*now, digest.hexdigest())])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        *ids, digests = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([*(pa.array(i, pa.int64()) for i in ids), pa.array(digests, pa.string())], names=[*keys, "sha256"])

    placed = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.select(*keys, F.col(text).cast("binary").alias("_text")).mapInArrow(run, schema)


def running_sums(df: DataFrame, key: str, at: str, sums: dict[str, Column], bits: int = BLOCK_BITS) -> DataFrame:
    """Adds, for each name of ``sums``, the sum over the key's rows up to and with this one in order of ``at``.

    Sums inside blocks of neighbouring ``at`` plus one carried row a block: no task sweeps a whole key. ``key`` is not
    null, and (key, ``at``) unique.
    """
    rows = df.select("*", block(at, bits).alias("_blk"), *[v.alias(f"_v_{n}") for n, v in sums.items()])
    totals = rows.groupBy(key, "_blk").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    along = W.partitionBy(key).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(key, "_blk", *[F.coalesce(F.sum(f"_t_{n}").over(along), F.lit(0)).alias(f"_c_{n}") for n in sums])
    inside = W.partitionBy(key, "_blk").orderBy(at).rowsBetween(W.unboundedPreceding, 0)
    out = rows.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_s_{n}") for n in sums]).join(carried, [key, "_blk"])
    return out.select(*[F.col(c) for c in df.columns], *[(F.col(f"_s_{n}") + F.col(f"_c_{n}")).alias(n) for n in sums])
