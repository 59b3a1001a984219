"""Hour and day series: dense grids, lags, rolling frames, gap filling, decomposition.

Every frame below runs over an already aggregated series, whose length is the calendar's, so one key
always fits in one task however many raw rows it had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.scalars import round_hour
from ledgerline.operators.relational import densify
from ledgerline.tables import materialise


def hourly_counts(df: DataFrame, ts: str, key: str, out: str = "n") -> DataFrame:
    return df.groupBy(round_hour(F.col(ts)).alias("hr"), key).agg(F.count("*").alias(out))


def hour_grid(df: DataFrame, ts: str, key: str) -> DataFrame:
    """(hr, key, n) for every hour between the first and last and every key, zero where silent.

    Ends and keys are read off the written hourly counts, so the raw rows are read once.
    """
    counts = materialise(hourly_counts(df, ts, key), "hours")
    first = counts.agg(F.min("hr").alias("v")).scalar()
    last = counts.agg(F.max("hr").alias("v")).scalar()
    keys = counts.select(key).where(F.col(key).isNotNull()).distinct()
    return densify(counts, keys, "hr", first, last, "1 hour", {"n": 0})


def daily_series(df: DataFrame, key: str, ts: str, amount: str, out: str = "sales") -> DataFrame:
    """(key, d, sales) for every day of the whole span; days without rows sum to 0.

    Ends of the calendar and keys are read off the daily sums, so the raw rows are aggregated once.
    """
    days = df.where(F.col(key).isNotNull()).groupBy(key, F.to_date(ts).alias("d")).agg(F.sum(amount).alias(out))
    first = days.agg(F.min("d").alias("v")).scalar()
    last = days.agg(F.max("d").alias("v")).scalar()
    return densify(days, days.select(key).distinct(), "d", first, last, "1 day", {out: 0.0})


def series_window(key: str, ts: str):
    return W.partitionBy(key).orderBy(ts)


def lags(df: DataFrame, key: str, ts: str, col: str, ks: Sequence[int]) -> DataFrame:
    w = series_window(key, ts)
    return df.withColumns({f"lag_{k}": F.lag(col, k).over(w).cast("double") for k in ks})


def lead_target(df: DataFrame, key: str, ts: str, col: str) -> DataFrame:
    return df.withColumn("target", F.lead(col, 1).over(series_window(key, ts)).cast("double"))


def _whole(frame, col: str, size: int, value: Column) -> Column:
    return F.when(F.count(col).over(frame) == size, value)


def rolling_mean_before(key: str, ts: str, col: str, size: int) -> Column:
    """Mean of the previous ``size`` rows; null until all of them exist."""
    frame = series_window(key, ts).rowsBetween(-size, -1)
    return _whole(frame, col, size, F.avg(col).over(frame))


def rolling_mean_with(key: str, ts: str, col: str, size: int) -> Column:
    """Mean of the current and previous rows, from one row on."""
    return F.avg(col).over(series_window(key, ts).rowsBetween(-(size - 1), 0))


def rolling_std_with(key: str, ts: str, col: str, size: int) -> Column:
    """Sample deviation of the last ``size`` rows; null until all of them exist."""
    frame = series_window(key, ts).rowsBetween(-(size - 1), 0)
    return _whole(frame, col, size, F.stddev_samp(col).over(frame))


def moving_average(key: str, ts: str, col: str, size: int) -> Column:
    frame = series_window(key, ts).rowsBetween(-(size - 1), 0)
    return _whole(frame, col, size, F.avg(col).over(frame))


def fill_forward_back(df: DataFrame, key: str, ts: str, cols: Sequence[str]) -> DataFrame:
    """Last known value, then the first known one for a leading gap."""
    w = series_window(key, ts)
    back = w.rowsBetween(W.unboundedPreceding, 0)
    ahead = w.rowsBetween(0, W.unboundedFollowing)
    return df.withColumns(
        {c: F.coalesce(F.last(c, True).over(back), F.first(c, True).over(ahead)) for c in cols}
    )


def interpolate(df: DataFrame, key: str, ts: str, col: str, out: str, by: str = "time") -> DataFrame:
    """Straight line between known points; the last known value after the final one.

    ``by``: weight by elapsed ``time``, or by ``position``, where every row is one step.
    """
    if by not in ("time", "position"):
        raise ValueError(f"unknown weight: {by}")
    w = series_window(key, ts)
    back = w.rowsBetween(W.unboundedPreceding, 0)
    ahead = w.rowsBetween(0, W.unboundedFollowing)
    at = F.row_number().over(w).cast("long") if by == "position" else F.unix_micros(F.col(ts).cast("timestamp"))
    point = F.when(F.col(col).isNotNull(), F.struct(F.col("_at").alias("t"), F.col(col).alias("v")))
    p, q = F.col("_p"), F.col("_q")
    share = F.try_divide(F.col("_at") - p["t"], q["t"] - p["t"])
    return (
        df.withColumn("_at", at)
        .withColumn("_p", F.last(point, True).over(back))
        .withColumn("_q", F.first(point, True).over(ahead))
        .withColumn(out, F.coalesce(F.col(col), p["v"] + (q["v"] - p["v"]) * share, p["v"]))
        .drop("_at", "_p", "_q")
    )


def decompose(df: DataFrame, key: str, ts: str, col: str, period: int, model: str = "additive") -> DataFrame:
    """Trend, seasonal and residual parts by centred moving average.

    An even period uses half weights at both ends. The seasonal index is the mean detrended value per
    position, normalised to mean 0 (additive) or mean 1 (multiplicative).
    """
    additive = model == "additive"
    w = series_window(key, ts)
    half = period // 2
    whole = w.rowsBetween(-half, half)
    if period % 2:
        trend = F.avg(col).over(whole)
    else:
        inner = F.sum(col).over(w.rowsBetween(-(half - 1), half - 1))
        ends = F.lag(col, half).over(w) + F.lead(col, half).over(w)
        trend = (inner + 0.5 * ends) / period
    width = 2 * half + 1
    pos = F.pmod(F.row_number().over(w) - 1, F.lit(period))
    spread = (lambda a, b: a - b) if additive else (lambda a, b: F.try_divide(a, b))
    parts = (
        df.withColumn("trend", F.when(F.count(col).over(whole) == width, trend))
        .withColumn("_pos", pos)
        .withColumn("_detrended", spread(F.col(col), F.col("trend")))
    )
    # The index is read off the same partitioning, so it costs no further exchange by key.
    raw = F.avg("_detrended").over(W.partitionBy(key, "_pos"))
    # One value per position: those of the first cycle stand for all.
    cycle = F.when(F.row_number().over(w) <= period, F.col("_raw"))
    centre = F.avg("_first").over(W.partitionBy(key))
    out = parts.withColumn("_raw", raw).withColumn("_first", cycle).withColumn("seasonal", spread(F.col("_raw"), centre))
    rest = (
        F.col(col) - F.col("trend") - F.col("seasonal")
        if additive
        else F.try_divide(F.col(col), F.col("trend") * F.col("seasonal"))
    )
    return out.withColumn("resid", rest).drop("_pos", "_detrended", "_raw", "_first")


def sequences(df: DataFrame, key: str, ts: str, col: str, steps: int) -> DataFrame:
    """The previous ``steps`` values as an array and the current one as label; short heads are left out."""
    frame = series_window(key, ts).rowsBetween(-steps, -1)
    past = F.transform(
        F.array_sort(F.collect_list(F.struct(ts, col)).over(frame)), lambda s: s[col]
    )
    return df.withColumn("past", past).where(F.size("past") == steps).withColumn("label", F.col(col))


def first_rows(df: DataFrame, key: str, ts: str, n: int) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(series_window(key, ts))).where(F.col("_rn") <= n).drop("_rn")


def mark_last(df: DataFrame, key: str, ts: str, n: int) -> DataFrame:
    """``part`` is test for the last n rows of each series and train before."""
    rn = F.row_number().over(W.partitionBy(key).orderBy(F.col(ts).desc()))
    return df.withColumn("part", F.when(rn <= n, F.lit("test")).otherwise(F.lit("train")))


def mark_share(df: DataFrame, key: str, ts: str, share: float) -> DataFrame:
    """``part`` is train for the first ``floor(share * n)`` rows of each series."""
    rn = F.row_number().over(series_window(key, ts))
    n = F.count("*").over(W.partitionBy(key))
    return df.withColumn("part", F.when(rn <= F.floor(n * F.lit(share)), F.lit("train")).otherwise(F.lit("test")))


def time_blocks(df: DataFrame, ts: str, folds: int) -> DataFrame:
    """Adds ``block``: 0 for the first training stretch, then 1 .. folds for the equal blocks after it.

    Blocks are cut over the distinct time stamps, so every key shares them. The stamps are a calendar,
    which fits in one task.
    """
    stamps = df.select(ts).distinct()
    cal = stamps.withColumn("_i", F.row_number().over(W.orderBy(ts)) - 1).withColumn("_n", F.count("*").over(W.partitionBy()))
    size = F.floor(F.col("_n") / F.lit(folds + 1))
    first = F.col("_n") - size * folds
    block = F.when(F.col("_i") < first, F.lit(0)).otherwise(F.floor((F.col("_i") - first) / size) + 1)
    return df.join(cal.select(ts, block.cast("int").alias("block")), ts)


def expanding_folds(df: DataFrame, ts: str, folds: int) -> DataFrame:
    """Long (fold, part, row) table: train grows block by block, the next block validates."""
    rows = time_blocks(df, ts, folds)
    fold = F.explode(F.sequence(F.greatest(F.col("block"), F.lit(1)), F.lit(folds)))
    return rows.withColumn("fold", fold).withColumn(
        "part", F.when(F.col("block") == F.col("fold"), F.lit("valid")).otherwise(F.lit("train"))
    ).drop("block")
