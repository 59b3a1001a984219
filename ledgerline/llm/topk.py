"""Exact largest inner products by norm buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLACK = 1 + 1e-9  # float bounds are widened by this much, so rounding never prunes a true answer
PARTIAL = "query_id long, vec_id long, score long"


def quantised(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; null where the vector or a component is null or not finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vec.isNotNull() & ~bad, F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a dense matrix; short vectors are filled with zeros, which change no product."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _dot(rows: np.ndarray, vec: np.ndarray) -> np.ndarray:
    """Exact integer products: by floats where every sum fits their 53 bits, by integers beyond."""
    if float(np.abs(rows).max(initial=0)) * float(np.abs(vec).max(initial=0)) * max(1, vec.shape[-1]) < 2**52:
        return np.rint(rows.astype(np.float64) @ vec.astype(np.float64)).astype(np.int64)
    return rows @ vec


class Best:
    """The k best (score, smaller id first) of each query so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.score, self.vec = k, [np.empty(0, np.int64)] * n, [np.empty(0, np.int64)] * n

    def add(self, q: int, score: np.ndarray, vec: np.ndarray) -> None:
        score, vec = np.concatenate([self.score[q], score]), np.concatenate([self.vec[q], vec])
        top = np.lexsort((vec, -score))[: self.k]
        self.score[q], self.vec[q] = score[top], vec[top]

    def floor(self, q: int) -> float:
        return float(self.score[q][-1]) if len(self.score[q]) == self.k else -np.inf


def search_bucket(ids: np.ndarray, vecs: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, best: Best, least: np.ndarray, focus: int = 4, coordinate_from: float = 0.3) -> None:
    """One bucket (longest vectors first) against all queries.

    The bucket's longest norm turns a query's k-th best score into a local cosine threshold. Above 1 the bucket is
    skipped. A low threshold leaves only the length test: vectors too short for the score are a suffix. A higher one
    uses coordinates: a unit vector within that cosine of the query must lie in a narrow interval on the query's
    largest coordinates. What is left is verified by its product.
    """
    lengths = np.sqrt((vecs.astype(np.float64) ** 2).sum(1))
    units = np.asfortranarray(vecs / np.maximum(lengths, 1e-300)[:, None])
    q_lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    longest = float(lengths[0]) if len(lengths) else 0.0
    for q in range(len(q_ids)):
        theta = max(best.floor(q), float(least[q]))
        reach = q_lengths[q] * longest * SLACK
        if reach < theta:
            continue
        if theta <= 0 or q_lengths[q] == 0:
            rows = slice(None)
        else:
            near = np.searchsorted(-lengths, -theta / (q_lengths[q] * SLACK), side="right")
            rows, local = slice(0, near), theta / reach
            if local >= coordinate_from:
                unit = queries[q] / q_lengths[q]
                ok = np.ones(near, bool)
                for f in np.argsort(-np.abs(unit))[:focus]:
                    x = unit[f]
                    wide = np.sqrt(max(0.0, 1 - x * x)) * np.sqrt(max(0.0, 1 - local * local)) + 1e-9
                    if x < local:
                        ok &= units[:near, f] <= x * local + wide
                    if -x < local:
                        ok &= units[:near, f] >= x * local - wide
                rows = np.flatnonzero(ok)
        score, vec = _dot(vecs[rows], queries[q]), ids[rows]
        keep = (score >= theta) & (vec != q_ids[q])
        if keep.any():
            best.add(q, score[keep], vec[keep])


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: int = 256, bucket_rows: int = 4096, query_rows: int = 65_536) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer products of each query with all other rows.

    Components become floor(scale * x). Ties go to the smaller id. Vectors that are null or hold a null or non-finite
    component, and rows with a null id, take no part; vectors of unequal length count as filled with zeros. Rows that
    share a query's id are its own; if several do, the least vector is the query. Repeated ids among the candidates are
    candidates each. Fewer than ``k`` others give fewer ranks, an empty table none.

    Rows are placed by norm, so a task holds vectors of like length in buckets of ``bucket_rows``; equal norms are
    split by id. Queries are broadcast in chunks of at most ``query_rows``: each chunk is one pass over the rows. The
    longest bucket gives every query its first threshold.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vec_col), scale).alias("v"), is_query.alias("q")).where("id is not null and v is not null")
    rows = rows.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    spark = vectors.sparkSession
    queries = rows.where("q").groupBy("id").agg(F.min("v").alias("v"))
    passes = max(1, -(-queries.count() // query_rows))
    found = None
    longest = rows.orderBy(F.desc("norm"), "id").limit(bucket_rows).select("id", "v").toArrow()
    placed = rows.select("id", "v", "norm").repartitionByRange(F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id").select("id", "v")
    for i in range(passes):
        chunk = queries.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == i).toArrow().combine_chunks() if passes > 1 else queries.toArrow().combine_chunks()
        part = _one_pass(spark, chunk, longest, placed, k, bucket_rows)
        found = part if found is None else found.unionByName(part)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _one_pass(spark, chunk: pa.Table, longest: pa.Table, placed: DataFrame, k: int, bucket_rows: int) -> DataFrame:
    q_col = chunk.column("v").combine_chunks() if chunk.num_rows else pa.array([], pa.list_(pa.int64()))
    q_col = q_col.chunk(0) if isinstance(q_col, pa.ChunkedArray) and q_col.num_chunks else q_col
    top = longest.column("v").combine_chunks() if longest.num_rows else pa.array([], pa.list_(pa.int64()))
    top = top.chunk(0) if isinstance(top, pa.ChunkedArray) and top.num_chunks else top
    width = max([0, *(len(x) for x in (*q_col, *top))])
    q_ids, q_vecs = chunk.column("id").to_numpy(), _matrix(q_col, width) if chunk.num_rows else np.zeros((0, width), np.int64)
    least = np.full(len(q_ids), -np.inf)
    if len(q_ids) and longest.num_rows:
        ids, vecs, first = longest.column("id").to_numpy(), _matrix(top, width), Best(len(q_ids), k)
        search_bucket(ids, vecs, q_ids, q_vecs, first, least)
        least = np.array([first.floor(q) for q in range(len(q_ids))])
    shared = spark.sparkContext.broadcast((q_ids, q_vecs, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_vecs, least = shared.value
        best = Best(len(q_ids), k)
        for batch in batches:
            if not len(q_ids):
                continue
            for start in range(0, batch.num_rows, bucket_rows):
                part = batch.slice(start, bucket_rows)
                col = part.column(1)
                wide = max(q_vecs.shape[1], int(np.diff(col.offsets.to_numpy()).max(initial=0)))
                padded = np.pad(q_vecs, ((0, 0), (0, wide - q_vecs.shape[1])))
                search_bucket(part.column(0).to_numpy(), _matrix(col, wide), q_ids, padded, best, least)
        sizes = [len(x) for x in best.score]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, sizes)), pa.array(np.concatenate([*best.vec, np.empty(0, np.int64)])), pa.array(np.concatenate([*best.score, np.empty(0, np.int64)]))], names=["query_id", "vec_id", "score"])

    return placed.mapInArrow(search, PARTIAL)
