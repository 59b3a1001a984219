"""Order-dependent work split so that no key has to fit in one task.

The pattern is the same throughout: work inside (key, chunk), carry one small row per (key, chunk)
across chunks, and add the carry back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.tables import materialise


#: Binary logarithm of the rows that one window may hold.
CHUNK_BITS = 16


def in_order(df: DataFrame, key: str, *order: str, bits: int = CHUNK_BITS) -> DataFrame:
    """``df`` with ``_at``, which rises along (key, ``order``), and ``_chunk``: at most 2 ** ``bits`` neighbours of a key.

    Rows are placed by range of key and order together, so a key whose rows all fall in one hour is still sorted by many
    tasks. Written once, so that a lost executor cannot number rows anew.
    """
    placed = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    return materialise(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumn("_chunk", F.shiftright("_at", bits))


def previous_value(df: DataFrame, key: str, ts: str, tie: str, value: str, out: str, bits: int = CHUNK_BITS) -> DataFrame:
    """``lag(value, 1)`` per key ordered by (ts, tie), skew-safe: a window holds at most 2 ** ``bits`` rows."""
    chunked = in_order(df, key, ts, tie, bits=bits)
    tails = chunked.groupBy(key, "_chunk").agg(F.max_by(value, "_at").alias("_tail"))
    carry = tails.select(
        key, "_chunk", F.lag("_tail").over(W.partitionBy(key).orderBy("_chunk")).alias("_carry")
    )
    inside = W.partitionBy(key, "_chunk").orderBy("_at")
    return (
        chunked.withColumn("_prev", F.lag(value).over(inside))
        .withColumn("_first", F.row_number().over(inside) == 1)
        .join(carry, [key, "_chunk"], "left")
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev")))
        .drop("_chunk", "_at", "_prev", "_first", "_carry")
    )


def as_of(facts: DataFrame, snapshots: DataFrame, key: str, ts: str, value: str, out: str, tie: str, bits: int = CHUNK_BITS) -> DataFrame:
    """Attach to each fact the latest snapshot value of its key at or before its time.

    Both sides are stacked and swept once, so there is no range join; a window holds at most 2 ** ``bits`` rows, and one
    small row a chunk carries the last snapshot on. Snapshots sort before facts at equal times; ``tie`` breaks ties
    between snapshots (the larger wins).
    """
    left = facts.withColumn("_fact", F.lit(1))
    right = snapshots.select(key, ts, F.col(tie), F.col(value).alias("_value")).withColumn("_fact", F.lit(0))
    # A snapshot is boxed so that a null snapshot value still counts as the latest one.
    stacked = (
        left.unionByName(right, allowMissingColumns=True)
        .withColumn("_box", F.when(F.col("_fact") == 0, F.struct(F.col("_value").alias("v"))))
        .drop("_value")
    )
    stacked = in_order(stacked, key, ts, "_fact", tie, bits=bits)
    tails = stacked.groupBy(key, "_chunk").agg(F.max_by("_box", F.when(F.col("_fact") == 0, F.col("_at"))).alias("_tail"))
    before = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carry = tails.select(key, "_chunk", F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
    sweep = W.partitionBy(key, "_chunk").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    return (
        stacked.withColumn("_here", F.last("_box", ignorenulls=True).over(sweep))
        .where("_fact = 1")
        .join(carry, [key, "_chunk"], "left")
        .withColumn(out, F.coalesce("_here", "_carry")["v"])
        .drop("_fact", "_box", "_chunk", "_at", "_here", "_carry")
    )


def running_totals(df: DataFrame, order: str, sums: Sequence[str], buckets: int = 200) -> DataFrame:
    """Running sums over the whole frame in order of ``order`` (distinct values), in two levels.

    Adds ``before_<c>`` (sum over smaller values) for each column and ``all_<c>`` (the grand total).
    """
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(order, cuts, 10_000).alias("b")).scalar()
    placed = df.withColumn("_bounds", bounds).withColumn(
        "_bucket", F.expr(f"size(filter(_bounds, x -> x < `{order}`))")
    ).drop("_bounds")
    totals = placed.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # ``totals`` has at most ``buckets`` rows: safe for one task and safe to broadcast.
    ahead = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(ahead), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(W.partitionBy()).alias(f"all_{c}") for c in sums],
    )
    inside = W.partitionBy("_bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    out = placed.join(F.broadcast(offsets), "_bucket")
    for c in sums:
        out = out.withColumn(f"before_{c}", F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_o_{c}"))
    return out.drop("_bucket", *[f"_o_{c}" for c in sums])


def global_position(df: DataFrame, *order: str) -> DataFrame:
    """``pos`` from 0 in the order of the whole frame; ``order`` has to be unique.

    A range sort places the rows, each task numbers its own, and the tasks' counts are added up: one row per task.
    """
    numbered = materialise(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_m", 33)
    counts = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_c"))
    ahead = F.sum("_c").over(W.orderBy("_part")) - F.col("_c")
    offsets = counts.select("_part", ahead.alias("_ahead"))
    placed = numbered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.withColumn("pos", F.col("_m").bitwiseAND((1 << 33) - 1) + F.col("_ahead")).drop("_m", "_part", "_ahead")


def hashed_position(df: DataFrame, key: str, by: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Rank rows of each stratum by the hash of their key: ``pos`` from 1, ``size`` the stratum's rows.

    The first hex digits of the hash cut every stratum into equal buckets, so a stratum holding most
    rows is ranked by many tasks.
    """
    hashed = df.withColumn("_h", F.md5(F.col(key).cast("string"))).withColumn("_p", F.substring("_h", 1, digits))
    counts = hashed.groupBy(*by, "_p").agg(F.count("*").alias("_c"))
    order = W.partitionBy(*by).orderBy("_p")
    offsets = counts.select(
        *by,
        "_p",
        (F.sum("_c").over(order) - F.col("_c")).alias("_ahead"),
        F.sum("_c").over(W.partitionBy(*by)).alias("size"),
    )
    inside = W.partitionBy(*by, "_p").orderBy("_h", key)
    return (
        hashed.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, [*by, "_p"])
        .withColumn("pos", (F.col("_rn") + F.col("_ahead")).cast("long"))
        .withColumn("size", F.col("size").cast("long"))
        .drop("_h", "_p", "_rn", "_ahead")
    )
