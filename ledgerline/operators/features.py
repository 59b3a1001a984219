"""Feature preparation: time and weather features, scaling, encoding, splits, oversampling."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.calendar import is_holiday
from ledgerline.functions.scalars import flag
from ledgerline.functions.text import normalize_text, token_table, tokenize
from ledgerline.operators.evaluation import RUSH_HOURS
from ledgerline.operators.ordered import global_position, hashed_position
from ledgerline.operators.series import fill_forward_back, lags, lead_target, rolling_mean_before, rolling_mean_with
from ledgerline.tables import materialise

# Hours of the evening rush, of evening events, the wording for a trace of rain and its amount.
EVENING_RUSH = (16, 17, 18, 19)
EVENT_HOURS = (18, 19, 20, 21, 22, 23)
TRACE_OF_RAIN = "Trace of precipitation"
TRACE_AMOUNT = 0.1

# Zones of the event grid treated as downtown and as nightlife areas.
DOWNTOWN = ("error", "purchase")
NIGHTLIFE = ("click",)


def time_flags(df: DataFrame, ts: str) -> DataFrame:
    hour, dow, month = F.hour(ts), F.weekday(ts), F.month(ts)
    weekend = dow >= 5
    return df.withColumns(
        {
            "hour_of_day": hour,
            "is_weekend": flag(weekend),
            "is_rush_hour": flag(hour.isin(*RUSH_HOURS) & ~weekend),
            "is_evening_rush": flag(hour.isin(*EVENING_RUSH) & ~weekend),
            "is_event_time": flag(hour.isin(*EVENT_HOURS) & weekend),
            "is_peak_hour": flag(hour.between(12, 18)),
            "is_summer": flag(month.isin(6, 7, 8)),
            "is_winter": flag(month.isin(12, 1, 2)),
        }
    )


def zone_flags(df: DataFrame, zone: str, downtown: Sequence, nightlife: Sequence) -> DataFrame:
    """Which listed sets of zones a row's zone belongs to."""
    return df.withColumns(
        {"is_downtown": flag(F.col(zone).isin(*downtown)), "is_nightlife": flag(F.col(zone).isin(*nightlife))}
    )


def interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_weekend_hour": F.col("is_weekend") * F.col("hour_of_day"),
            "is_rush_hour_downtown": F.col("is_rush_hour") * F.col("is_downtown"),
            "is_downtown_hour": F.col("is_downtown") * F.col("hour_of_day"),
        }
    )


def hourly_weather(weather: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    """One row per hour of the weather's span; a missing hour repeats the hour before.

    The whole table is one row per calendar hour, so the single sweep over it stays small.
    """
    span = weather.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    hours = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias(ts))
    known = W.orderBy(ts).rowsBetween(W.unboundedPreceding, 0)
    return hours.join(weather, ts, "left").withColumns({c: F.last(c, True).over(known) for c in cols})


WEATHER = ("temperature", "humidity", "rain")


def demand_mart(grid: DataFrame, weather: DataFrame, key: str, ts: str, col: str, cols: Sequence[str] = WEATHER, per_key: bool = False) -> DataFrame:
    """Training features per (hour, key): calendar, weather, lags, rolling means, next-hour target.

    Hours without weather take the last known one; with ``per_key`` within the key's own rows, and before its first
    known hour the first known one. Rows whose history or target is incomplete are dropped.
    """
    cols = list(cols)
    wet = weather.select(ts, *cols) if per_key else hourly_weather(weather, ts, cols)
    base = interactions(zone_flags(time_flags(grid, ts), key, DOWNTOWN, NIGHTLIFE)).withColumns(
        {"day_of_week": F.weekday(ts), "day_of_month": F.dayofmonth(ts), "is_holiday": is_holiday(F.to_date(ts))}
    )
    # One row per calendar hour.
    rich = base.join(F.broadcast(wet), ts, "left")
    rich = (fill_forward_back(rich, key, ts, cols) if per_key else rich).fillna(0.0, cols)
    rich = rich.withColumn("is_raining", flag(F.col("rain") > 0)).withColumn(
        "is_raining_downtown", F.col("is_raining") * F.col("is_downtown")
    )
    history = [1, 2, 3, 6, 12, 24]
    full = lead_target(lags(rich, key, ts, col, history), key, ts, col).withColumns(
        {"rolling_mean_3h": rolling_mean_before(key, ts, col, 3), "rolling_mean_24h": rolling_mean_before(key, ts, col, 24)}
    )
    return full.dropna(subset=["target", *[f"lag_{k}" for k in history], "rolling_mean_3h", "rolling_mean_24h"])


def store_features(grid: DataFrame, key: str, ts: str, col: str) -> DataFrame:
    """Feature-store rows: lags with 0 for missing history, rolling means that include the current hour."""
    out = lags(grid, key, ts, col, [1, 2, 24, 168]).fillna(0.0)
    return out.withColumns(
        {"rolling_mean_3h": rolling_mean_with(key, ts, col, 3), "rolling_mean_24h": rolling_mean_with(key, ts, col, 24)}
    )


def next_hour_row(store: DataFrame, weather: DataFrame, key: str, ts: str, col: str) -> DataFrame:
    """One feature row per key for the hour after the store's last: values at exact offsets, 0 where missing.

    Weather of the target hour falls back to the mean of the latest known hour.
    """
    last = store.agg(F.max(ts).alias("v")).scalar()
    target = last + F.expr("interval 1 hour")
    hours = {"lag_1": 1, "lag_2": 2, "lag_24": 24, "lag_168": 168}

    def at(k: int) -> Column:
        return F.col(ts) == target - F.expr(f"interval {k} hours")

    per = store.where(F.col(ts) >= target - F.expr("interval 168 hours")).groupBy(key).agg(
        *[F.coalesce(F.max(F.when(at(k), F.col(col))), F.lit(0)).cast("double").alias(name) for name, k in hours.items()],
        *[F.coalesce(F.max(F.when(at(1), F.col(c))), F.lit(0.0)).alias(c) for c in ("rolling_mean_3h", "rolling_mean_24h")],
    )
    keys = store.select(key).distinct()
    newest = weather.agg(F.max(ts).alias("v")).scalar()
    cols = ["temperature", "humidity", "rain"]
    exact = weather.where(F.col(ts) == target).agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("s")).scalar()
    recent = weather.where(F.col(ts) == newest).agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("s")).scalar()
    rows = keys.join(per, key, "left").fillna(0.0).withColumn(ts, target)
    for c in cols:
        rows = rows.withColumn(c, F.coalesce(exact.getField(c), recent.getField(c), F.lit(0.0)))
    flagged = zone_flags(time_flags(rows, ts), key, DOWNTOWN, NIGHTLIFE)
    return flagged.withColumns({"day_of_week": F.weekday(ts), "day_of_month": F.dayofmonth(ts), "is_holiday": is_holiday(F.to_date(ts))})


def rain_amount(text: Column) -> Column:
    number = F.when(text == TRACE_OF_RAIN, F.lit(TRACE_AMOUNT)).otherwise(text.try_cast("double"))
    return F.coalesce(number, F.lit(0.0))


def _row(df: DataFrame, *aggs: Column) -> Column:
    """The aggregates of a whole frame as one struct, attached as a scalar subquery."""
    return df.agg(F.struct(*aggs).alias("s")).scalar()


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean, unit population deviation; statistics come from ``fit_on``. A constant column becomes 0."""
    s = _row(
        df if fit_on is None else fit_on,
        *[F.avg(c).alias(f"{c}_m") for c in cols],
        *[F.stddev_pop(c).alias(f"{c}_s") for c in cols],
    )
    out = {}
    for c in cols:
        sd = s.getField(f"{c}_s")
        out[c] = (F.col(c) - s.getField(f"{c}_m")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return df.withColumns(out)


def min_max_stats(df: DataFrame, cols: Sequence[str]) -> Column:
    return _row(df, *[F.min(c).alias(f"{c}_lo") for c in cols], *[F.max(c).alias(f"{c}_hi") for c in cols])


def min_max_scale(df: DataFrame, cols: Sequence[str], stats: Column) -> DataFrame:
    return df.withColumns(
        {
            c: F.coalesce(
                F.try_divide(F.col(c) - stats.getField(f"{c}_lo"), (stats.getField(f"{c}_hi") - stats.getField(f"{c}_lo")).cast("double")),
                F.lit(0.0),
            )
            for c in cols
        }
    )


def min_max_inverse(df: DataFrame, cols: Sequence[str], stats: Column) -> DataFrame:
    return df.withColumns(
        {c: F.col(c) * (stats.getField(f"{c}_hi") - stats.getField(f"{c}_lo")) + stats.getField(f"{c}_lo") for c in cols}
    )


def levels(df: DataFrame, col: str, most: int = 1000) -> list:
    """The sorted levels of a category. The list becomes columns; more than ``most`` levels are an error."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} levels")
    return sorted(found)


def one_hot(df: DataFrame, col: str, known: Sequence, drop_first: bool = False) -> DataFrame:
    """One 0/1 column per level fixed at fit time; a new level gives all zeros."""
    chosen = list(known)[1:] if drop_first else list(known)
    return df.withColumns({f"{col}_{v}": flag(F.col(col) == v) for v in chosen})


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """Levels numbered in alphabetical order from 0; the ranking sees distinct levels only."""
    names = df.select(col).where(F.col(col).isNotNull()).distinct()
    codes = names.withColumn(out, (F.row_number().over(W.orderBy(col)) - 1).cast("int"))
    return df.join(codes, col, "left")


def align(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The stored columns in the stored order; missing ones are 0."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in expected])


def polynomial2(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Squares and cross terms, without a constant."""
    made = {}
    for i, a in enumerate(cols):
        for b in cols[i:]:
            made[f"{a}_x_{b}"] = F.col(a) * F.col(b)
    return df.withColumns(made)


def stratified_split(df: DataFrame, key: str, by: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """Exact shares per stratum: rows are ranked by the hash of their key inside their stratum."""
    ranked = hashed_position(df, key, by)
    names = list(shares)
    upto, part = 0.0, None
    for name in names[:-1]:
        upto += shares[name]
        hit = F.col("pos") <= F.floor(F.col("size") * F.lit(round(upto, 9)))
        part = F.when(hit, name) if part is None else part.when(hit, name)
    return ranked.withColumn("part", part.otherwise(names[-1])).drop("pos", "size")


NEAR = "array<struct<dist:double,near:bigint,nv:array<double>>>"


def _nearest(x: np.ndarray, ids: np.ndarray, y: np.ndarray, others: np.ndarray, k: int, within: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row of ``x`` that has any: the k nearest rows of ``y`` no farther than ``within`` (squared), itself left out."""
    sizes, norms = (x * x).sum(1), (y * y).sum(1)
    for at in range(0, len(x), 256):
        rough = sizes[at : at + 256, None] + norms[None, :] - 2 * x[at : at + 256] @ y.T
        rough[ids[at : at + 256, None] == others[None, :]] = np.inf
        # Rounding of the product form must not hide a neighbour: candidates have slack, then are measured anew.
        slack = 1e-9 * (1 + sizes[at : at + 256] + norms.max())
        bound = np.minimum(np.partition(rough, min(k, len(y)) - 1, axis=1)[:, min(k, len(y)) - 1], within[at : at + 256]) + slack
        for i in np.flatnonzero((rough <= bound[:, None]).any(1)):
            close = np.flatnonzero(rough[i] <= bound[i])
            close = close[np.isfinite(rough[i, close])]
            dist = np.round(((y[close] - x[at + i]) ** 2).sum(1), 9)
            order = np.lexsort((others[close], dist))[:k]
            yield at + i, dist[order], close[order]


def near_neighbours(points: DataFrame, key: str, k: int, block_rows: int = 2000, pivots: int = 32) -> DataFrame:
    """(key, near): the k nearest other points of each, as structs (dist, near, nv) in order; ``points`` has (key, v).

    Exact at every size. Points are sorted by nearest pivot and distance to it and cut into blocks of ``block_rows``.
    Inside its block each point finds k neighbours, which bound how far the others may lie. A block knows its least and
    largest distance to each pivot; by the triangle inequality a pair of blocks whose ranges are farther apart than the
    first block's bound cannot hold a neighbour and is left out. Every other pair is searched by a task of its own, and
    partial lists merge by key. Equal distances (to nine places) go to the smaller key.

    A task holds two blocks, a row carries a block as one binary value. In high dimensions distances are alike and few
    pairs are left out: the work is then that of all pairs of blocks, side by side.
    """
    spark = points.sparkSession
    chosen = points.orderBy(F.xxhash64(key), key).limit(pivots).select("v").collect()
    if not chosen:
        return points.select(key, F.array().cast(NEAR).alias("near"))
    posts = np.array([r["v"] for r in chosen], float)

    def to_posts(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (posts * posts).sum(1)[None, :] - 2 * x @ posts.T))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                d = to_posts(np.stack(pdf["v"].to_numpy()).astype(float))
                yield pdf.assign(post=d.argmin(1), away=d.min(1))

    placed = points.select(key, "v").mapInPandas(assign, f"{key} bigint, v array<double>, post int, away double")
    placed = global_position(placed, "post", "away", key).withColumn("blk", F.floor(F.col("pos") / block_rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = np.stack(pdf["v"].to_numpy()).astype(float), pdf[key].to_numpy(np.int64)
        d = to_posts(x)
        far = np.full(len(x), np.inf)
        rows = [[] for _ in range(len(x))]
        for i, dist, close in _nearest(x, ids, x, ids, k, far.copy()):
            rows[i] = [{"dist": a, "near": int(ids[j]), "nv": x[j].tolist()} for a, j in zip(dist, close, strict=True)]
            if len(dist) == k:
                far[i] = dist[-1]
        return pd.DataFrame([{"blk": pdf["blk"].iloc[0], "ids": ids.tobytes(), "data": x.tobytes(), "far": far.tobytes(), "lo": d.min(0).tolist(), "hi": d.max(0).tolist(), "reach": float(np.sqrt(far.max())), "found": rows}])

    shape = f"blk bigint, ids binary, data binary, far binary, lo array<double>, hi array<double>, reach double, found array<{NEAR}>"
    blocks = materialise(placed.groupBy("blk").applyInPandas(pack, shape), "blocks")
    # Pairs of blocks: a thousand blocks' ranges stand in one row, which each block meets by its number.
    ranges = blocks.select("blk", "lo", "hi", "reach").withColumn("bundle", F.floor(F.col("blk") / 1000))
    bundles = ranges.groupBy("bundle").agg(F.collect_list(F.struct("blk", "lo", "hi")).alias("others"))
    last = ranges.agg(F.max("bundle").alias("m")).scalar()

    def apart(other: Column) -> Column:
        above = F.zip_with(other["lo"], F.col("hi"), lambda x, y: x - y)
        below = F.zip_with(F.col("lo"), other["hi"], lambda x, y: x - y)
        return F.greatest(F.array_max(above), F.array_max(below))

    # Ranges come from products: a little slack keeps pairs that rounding would part.
    meets = ranges.withColumn("bundle", F.explode(F.sequence(F.lit(0).cast("long"), last))).join(bundles, "bundle")
    near_by = F.filter("others", lambda o: (o["blk"] != F.col("blk")) & (apart(o) <= F.col("reach") * (1 + 1e-9) + 1e-6))
    pairs = meets.select("blk", F.explode(F.transform(near_by, lambda o: o["blk"])).alias("other"))
    sides = blocks.select("blk", "ids", "data", "far")
    meeting = pairs.join(sides, "blk").join(sides.select(F.col("blk").alias("other"), F.col("ids").alias("oids"), F.col("data").alias("odata")), "other")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                ids, others = np.frombuffer(r.ids, np.int64), np.frombuffer(r.oids, np.int64)
                x, y, far = np.frombuffer(r.data).reshape(len(ids), -1), np.frombuffer(r.odata).reshape(len(others), -1), np.frombuffer(r.far)
                out = [(ids[i], [{"dist": a, "near": int(others[j]), "nv": y[j].tolist()} for a, j in zip(dist, close, strict=True)]) for i, dist, close in _nearest(x, ids, y, others, k, far)]
                yield pd.DataFrame(out, columns=[key, "found"])

    kind = f"{key} bigint, found {NEAR}"
    across = meeting.select("ids", "data", "far", "oids", "odata").mapInPandas(search, kind)

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for ids, found in zip(pdf["ids"], pdf["found"], strict=True):
                yield pd.DataFrame({key: np.frombuffer(ids, np.int64), "found": [[] if f is None else list(f) for f in found]})

    own = blocks.select("ids", "found").mapInPandas(unpack, kind)
    every = own.unionByName(across).groupBy(key).agg(F.flatten(F.collect_list("found")).alias("all"))
    return every.select(key, F.slice(F.array_sort("all"), 1, k).alias("near"))


def oversample_interpolated(
    df: DataFrame, key: str, vector: str, label: str, minority, ratio: float, k: int = 5, block_rows: int = 2000
) -> DataFrame:
    """(origin, copy, near, v, label): synthetic minority rows between a row and one of its k nearest neighbours.

    Enough rows are made to bring minority / majority to ``ratio``: the whole share for every minority row, the
    remainder by hashed position. The neighbours are exact at every size. Neighbour and place on the line come from the hash of (origin, copy), so reruns give
    the same rows. Equal vectors count as one point and are not each other's neighbours: no made row is a copy. Rows
    without a vector take no part; with fewer than two different vectors nothing is made.
    """
    known = df.where(F.col(vector).isNotNull())
    counts = _row(known, F.count_if(F.col(label) == minority).alias("few"), F.count_if(F.col(label) != minority).alias("many"))
    few, many = counts.getField("few"), counts.getField("many")
    wanted = F.greatest(F.ceil(many * F.lit(ratio)) - few, F.lit(0))
    small = known.where(F.col(label) == minority).select(key, F.col(vector).cast("array<double>").alias("v"))
    copies = F.floor(wanted / few) + (F.col("pos") <= wanted % few).cast("long")
    ranked = hashed_position(small, key).select(F.col(key).alias("origin"), "v", copies.alias("copies")).where("copies > 0")
    points = materialise(small.groupBy("v").agg(F.min(key).alias("point")), "points")
    near = points.join(near_neighbours(points, "point", k, block_rows), "point").select("v", F.col("near").alias("l")).where(F.size("l") > 0)
    rows = ranked.join(near, "v").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    h = F.md5(F.concat_ws(":", F.col("origin").cast("string"), F.col("copy").cast("string")))
    number = [F.conv(F.substring(h, at, 8), 16, 10).cast("long") for at in (1, 9)]
    picked = rows.select("origin", "copy", "v", F.get("l", (number[0] % F.size("l")).cast("int")).alias("n"), ((number[1] + 0.5) / float(1 << 32)).alias("u"))
    made = F.zip_with("v", "n.nv", lambda a, b: a + F.col("u") * (b - a))
    return picked.select("origin", "copy", F.col("n.near").alias("near"), made.alias("v"), F.lit(minority).alias(label))


def oversample_augmented(df: DataFrame, key: str, text: str, minority: Column, synonyms: DataFrame, share: float = 0.3) -> DataFrame:
    """(key, copy, body): every text normalised, plus one copy of each minority text with words swapped.

    About ``share`` of the words that have a synonym are swapped, chosen by the hash of (key, position),
    so reruns give the same copies. ``synonyms`` is a supplied dictionary (token, other).
    """
    cut = f"{int(round(share * 256)):02x}"
    originals = df.select(key, F.lit(0).alias("copy"), F.concat_ws(" ", tokenize(normalize_text(F.col(text)))).alias("body"))
    words = token_table(df.where(minority), [key], text).join(synonyms, "token", "left")
    chosen = F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col("pos").cast("string"))), 1, 2) < cut
    word = F.when(chosen, F.coalesce("other", "token")).otherwise(F.col("token")).alias("w")
    rows = words.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", word))).alias("s"))
    copies = rows.select(key, F.lit(1).alias("copy"), F.concat_ws(" ", F.transform("s", lambda x: x["w"])).alias("body"))
    return originals.unionByName(copies)
