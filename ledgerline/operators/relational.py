"""Joins, ranking cuts and group totals used by the reports."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(facts: DataFrame, dim: DataFrame, on: str, dim_key: str, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Bring dimension columns onto facts. The planner broadcasts the dimension only if its size allows."""
    side = dim.select(F.col(dim_key).alias(on), *cols)
    return facts.join(side, on, how)


def top_k(df: DataFrame, k: int, order: Sequence[Column], tie: Sequence[str]) -> DataFrame:
    """First k rows; ``tie`` must make the order total so that reruns agree."""
    return df.orderBy(*order, *[F.col(c).asc() for c in tie]).limit(k)


def rows_of(facts: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Facts whose key is in the list."""
    return facts.join(keys.select(*on), list(on), "left_semi")


def rows_missing(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that are expected and absent."""
    return expected.join(present.select(*on), list(on), "left_anti")


def densify(
    facts: DataFrame,
    keys: DataFrame,
    ts: str,
    first: Column,
    last: Column,
    step: str,
    fill: Mapping[str, float],
) -> DataFrame:
    """Every key gets every step from first to last; absent cells are filled.

    Each key row unfolds its own calendar, so no product of two tables is built.
    """
    calendar = F.sequence(first, last, F.expr(f"interval {step}"))
    grid = keys.withColumn(ts, F.explode(calendar))
    return grid.join(facts, [*keys.columns, ts], "left").fillna(dict(fill))


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order``. Merges before the shuffle, unlike row_number."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(best).select(*keys, "_r.*").select(*df.columns)


def oldest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(best).select(*keys, "_r.*").select(*df.columns)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and share per value; nulls are left out of both."""
    known = df.where(F.col(col).isNotNull())
    counts = known.groupBy(col).agg(F.count("*").alias("n"))
    total = known.agg(F.count("*").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def pivot_sums(df: DataFrame, row: str, col: str, values: Sequence[str], agg: Column) -> DataFrame:
    """Wide table over a stated list of columns, so no extra pass looks for them."""
    return df.groupBy(row).pivot(col, list(values)).agg(agg)


def share_matrix(df: DataFrame, row: str, col: str, n: str, names: Sequence) -> DataFrame:
    """Counts per (row, col) as one row of shares; rows whose ``col`` is null count in the total only."""
    parts = [F.coalesce(F.sum(F.when(F.col(col) == c, F.col(n))), F.lit(0)) / F.sum(n) for c in names]
    return df.groupBy(row).agg(*[F.round(p, 6).alias(str(c)) for p, c in zip(parts, names, strict=True)])


def group_agg(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """``{column: [functions]}`` with flattened names; null keys are dropped, an empty sum is 0."""
    made = []
    for col, fns in spec.items():
        for fn in fns:
            value = getattr(F, fn)(col)
            made.append((F.coalesce(value, F.lit(0.0)) if fn == "sum" else value).alias(f"{col}_{fn}"))
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*made)


BLOCK_ITEMS = 2000


def item_blocks(items: DataFrame, item: str) -> int:
    """Into how many blocks an item list has to be cut; read it off the dimension, not the facts."""
    n = items.agg(F.approx_count_distinct(item).alias("n")).first()["n"]
    return max(1, -(-int(n * 1.1) // BLOCK_ITEMS))


#: Pairs of items that a task adds up before it hands them on.
HELD_PAIRS = 1_000_000


def cooccurring_pairs(bridge: DataFrame, group: str, item: str, blocks: int = 1, least_support: int = 1, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """How many groups hold both items, for every unordered pair: (item_a, item_b, pair_count), a < b.

    Each task turns its groups into 0/1 rows and adds up their Gram matrix, so what leaves the task is
    at most one number per pair of items, whatever the number of groups. The item list is cut into
    ``blocks`` (see ``item_blocks``) so that one matrix stays small; with more than one
    block every pair of blocks is a separate piece of work. A task holds at most about ``held_pairs``
    partial sums and hands them on when it has more; they merge by pair.

    With ``least_support``, only pairs held by that many groups are given. No pair is held by more groups than the rarer
    of its items, so items of fewer groups are dropped before any pair is made.
    """
    if least_support > 1:
        often = bridge.select(group, item).distinct().groupBy(item).agg(F.count("*").alias("_n")).where(F.col("_n") >= least_support)
        bridge = bridge.join(often.select(item), item, "left_semi")
    block = F.pmod(F.xxhash64(item), F.lit(blocks)).alias("b")
    sets = (
        bridge.select(group, item, block)
        .distinct()
        .groupBy(group, "b")
        .agg(F.collect_set(item).alias("items"))  # at most one block of items
    )
    if blocks == 1:
        work = sets.select(F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.col("items").alias("xs"), F.col("items").alias("ys"))
    else:
        # Every ordered pair of this group's blocks meets once, keyed by (group, block pair).
        left = sets.select(group, F.explode(F.sequence(F.col("b"), F.lit(blocks - 1))).alias("bj"), F.col("b").alias("bi"), F.col("items").alias("xs"))
        right = sets.select(group, F.explode(F.sequence(F.lit(0), F.col("b"))).alias("bi"), F.col("b").alias("bj"), F.col("items").alias("ys"))
        work = left.join(right, [group, "bi", "bj"])
        # A block pair is spread over 16 tasks by group, so no pair is bound to one task.
        work = work.repartition("bi", "bj", F.pmod(F.xxhash64(group), F.lit(16))).select("bi", "bj", "xs", "ys")

    def handed_on(sums: dict[tuple[int, int], pd.Series]) -> Iterator[pd.DataFrame]:
        for s in sums.values():
            yield s.astype(np.int64).rename("n").rename_axis(["p", "q"]).reset_index()
        sums.clear()

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], pd.Series] = {}
        for pdf in batches:
            for pair, part in pdf.groupby(["bi", "bj"]):
                x = pd.DataFrame({"g": np.repeat(np.arange(len(part)), part["xs"].str.len()), "k": np.concatenate(part["xs"].to_list())})
                y = pd.DataFrame({"g": np.repeat(np.arange(len(part)), part["ys"].str.len()), "k": np.concatenate(part["ys"].to_list())})
                xc, xn = pd.factorize(x["k"])
                yc, yn = pd.factorize(y["k"])
                mx = np.zeros((len(part), len(xn)), np.float32)
                my = np.zeros((len(part), len(yn)), np.float32)
                mx[x["g"], xc] = 1
                my[y["g"], yc] = 1
                dense = mx.T @ my
                i, j = np.nonzero(dense)
                found = pd.Series(dense[i, j].astype(np.int64), index=pd.MultiIndex.from_arrays([xn[i], yn[j]]))
                sums[pair] = found if pair not in sums else sums[pair].add(found, fill_value=0)
                if sum(map(len, sums.values())) > held_pairs:
                    yield from handed_on(sums)
        yield from handed_on(sums)

    kind = dict(bridge.dtypes)[item]
    counted = work.mapInPandas(gram, schema=f"p {kind}, q {kind}, n bigint")
    if blocks == 1:
        counted = counted.where(F.col("p") < F.col("q"))
    else:
        counted = counted.where(F.col("p") != F.col("q"))
    same_block = F.pmod(F.xxhash64("p"), F.lit(blocks)) == F.pmod(F.xxhash64("q"), F.lit(blocks))
    if blocks > 1:
        # Inside one block both orders are produced; keep one of them.
        counted = counted.where(~same_block | (F.col("p") < F.col("q")))
    pairs = counted.groupBy(F.least("p", "q").alias("item_a"), F.greatest("p", "q").alias("item_b")).agg(
        F.sum("n").alias("pair_count")
    )
    return pairs.where(F.col("pair_count") >= least_support) if least_support > 1 else pairs


def rfm(df: DataFrame, key: str, ts: str, order: str, amount: str) -> DataFrame:
    """Recency in days from the day after the last purchase, distinct orders, total amount."""
    reference = df.agg((F.max(ts) + F.expr("interval 1 day")).alias("r")).scalar()
    return df.groupBy(key).agg(
        F.max(ts).alias("last_order"),
        F.count_distinct(order).alias("frequency"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("monetary"),
    ).select(
        key,
        "last_order",
        F.datediff(reference, F.col("last_order")).cast("int").alias("recency"),
        F.col("frequency").cast("long").alias("frequency"),
        F.round("monetary", 2).alias("monetary"),
    )
