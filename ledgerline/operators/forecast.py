"""Per-series jobs. Spark groups an aggregated series (one row per day) and each group is fitted with numpy.

The calendar bounds a group's size, whatever the number of raw rows behind it.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calendar import is_holiday, near_holiday
from ledgerline.tables import materialise


def with_future(df: DataFrame, key: str, ts: str, value: str, horizon: int) -> DataFrame:
    """The series plus ``horizon`` days without a value, and the calendar columns of every day."""
    last = df.agg(F.max(ts).alias("v")).scalar()
    ahead = F.sequence(F.date_add(last, 1), F.date_add(last, horizon), F.expr("interval 1 day"))
    future = df.select(key).distinct().withColumn(ts, F.explode(ahead))
    return calendar_columns(df.select(key, ts, value).unionByName(future, allowMissingColumns=True), ts)


def calendar_columns(df: DataFrame, ts: str) -> DataFrame:
    d = F.col(ts)
    columns: dict[str, Column] = {
        "dow": F.weekday(d),
        "month": F.month(d),
        "week": F.weekofyear(d),
        "doy": F.dayofyear(d),
        "holiday": is_holiday(d),
        "near": near_holiday(d),
    }
    return df.withColumns(columns)


def _wave(position: np.ndarray, period: float, order: int) -> list[np.ndarray]:
    angle = 2 * np.pi * position / period
    return [f(k * angle) for k in range(1, order + 1) for f in (np.sin, np.cos)]


def _columns(days: np.ndarray, near: np.ndarray, week: int = 3, year: int = 5) -> np.ndarray:
    return np.column_stack([np.ones(len(days)), days / 365.25, *_wave(days, 7, week), *_wave(days, 365.25, year), near])


def _design(pdf: pd.DataFrame, start) -> np.ndarray:
    return _columns((pd.to_datetime(pdf["_ts"]) - start).dt.days.to_numpy(float), pdf["near"].to_numpy(float))


def _trend_fit(train: pd.DataFrame, rows: pd.DataFrame, value: str, level: float):
    """Least squares on trend, weekly and yearly waves and holidays; prediction interval from the residuals."""
    start = pd.to_datetime(train["_ts"]).min()
    x, y = _design(train, start), train[value].to_numpy(float)
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    spread = np.sqrt(((y - x @ beta) ** 2).sum() / max(len(y) - x.shape[1], 1))
    z = _design(rows, start)
    reach = NormalDist().inv_cdf(0.5 + level / 2) * spread * np.sqrt(1 + ((z @ np.linalg.pinv(x.T @ x)) * z).sum(1))
    yhat = z @ beta
    return yhat, yhat - reach, yhat + reach


def forecast(df: DataFrame, key: str, ts: str, value: str, horizon: int, level: float = 0.95, validate: bool = False) -> DataFrame:
    """(key, ts, actual, yhat, low, high) for the next ``horizon`` days, or for the last ones when validating."""
    days = calendar_columns(df.select(key, ts, value), ts) if validate else with_future(df, key, ts, value, horizon)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.rename(columns={ts: "_ts"}).sort_values("_ts")
        train, rows = pdf.iloc[:-horizon], pdf.iloc[-horizon:]
        yhat, low, high = _trend_fit(train, rows, value, level)
        return pd.DataFrame({key: rows[key], ts: rows["_ts"], "actual": rows[value], "yhat": yhat, "low": low, "high": high})

    kind = dict(df.dtypes)
    return days.groupBy(key).applyInPandas(run, f"{key} {kind[key]}, {ts} {kind[ts]}, actual double, yhat double, low double, high double")


def backtest(df: DataFrame, key: str, ts: str, value: str, initial: int, period: int, horizon: int) -> DataFrame:
    """(key, cutoff, n, mae, smape): refit at every cutoff of a rolling origin, score the days after it."""
    days = calendar_columns(df.select(key, ts, value), ts)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.rename(columns={ts: "_ts"}).sort_values("_ts")
        when = pd.to_datetime(pdf["_ts"])
        cutoff, out = when.max() - pd.Timedelta(days=horizon), []
        while cutoff >= when.min() + pd.Timedelta(days=initial):
            rows = pdf[(when > cutoff) & (when <= cutoff + pd.Timedelta(days=horizon))]
            yhat, _, _ = _trend_fit(pdf[when <= cutoff], rows, value, 0.95)
            y = rows[value].to_numpy(float)
            both = np.abs(y) + np.abs(yhat)
            out.append((pdf[key].iloc[0], cutoff.date(), len(y), np.abs(y - yhat).mean(), 100 * np.mean(2 * np.abs(y - yhat) / np.where(both == 0, 1, both))))
            cutoff -= pd.Timedelta(days=period)
        return pd.DataFrame(out, columns=[key, "cutoff", "n", "mae", "smape"])

    kind = dict(df.dtypes)
    return days.groupBy(key).applyInPandas(run, f"{key} {kind[key]}, cutoff date, n bigint, mae double, smape double")


#: Parameter points to draw from: waves in a week and a year, ridge weight, days of history (0: all).
GRID = [(w, y, r, h) for w in (1, 2, 3) for y in (2, 4, 6, 8) for r in (0.0, 0.1, 1.0, 10.0, 100.0) for h in (0, 365, 730)]


def _ridge(day: np.ndarray, near: np.ndarray, y: np.ndarray, upto: float, ahead: np.ndarray, point) -> np.ndarray:
    """Fit one point on the days up to ``upto`` and predict rows ``ahead``."""
    known = np.flatnonzero((day <= upto) & ((day > upto - point["history"]) | (point["history"] == 0)))
    x, z = (_columns(day[i], near[i], point["week"], point["year"]) for i in (known, ahead))
    weight = np.full(x.shape[1], point["ridge"])
    weight[0] = 0.0
    beta, *_ = np.linalg.lstsq(np.vstack([x, np.diag(np.sqrt(weight))]), np.append(y[known], np.zeros(len(weight))), rcond=None)
    return z @ beta


def tune(df: DataFrame, key: str, ts: str, value: str, initial: int, period: int, horizon: int, draws: int = 10) -> tuple[DataFrame, DataFrame]:
    """Scores of drawn parameter points, and the forecast of each series' best point for the days ahead.

    A series (a day per row) becomes one row of arrays. Each draws ``draws`` points of the grid by hash, and every
    (series, point, cutoff) is a row of its own, fitted by whichever task holds it. Scores: key, point (number in the
    grid), week, year, ridge, history, cutoffs, smape (mean over the cutoffs), chosen (least smape, then least number).
    Forecast: key, ts, point, yhat, refitted on all days. Cutoffs stand ``period`` days apart, the last one ``horizon``
    days before the end, the first at least ``initial`` days after the start.
    """
    kind = dict(df.dtypes)
    every = with_future(df, key, ts, value, horizon)
    first = df.agg(F.min(ts).alias("v")).scalar()
    day = F.datediff(ts, first).cast("double")
    packed = every.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(day.alias("day"), F.col("near").cast("double").alias("near"), F.col(value).cast("double").alias("y")))).alias("s"), F.min(ts).alias("start"))
    packed = materialise(packed.repartition(key).select(key, "start", *[F.col(f"s.{n}").alias(n) for n in ("day", "near", "y")]), "series")
    grid = F.array(*[F.struct(F.lit(i).alias("point"), F.lit(w).alias("week"), F.lit(y).alias("year"), F.lit(r).alias("ridge"), F.lit(h).alias("history")) for i, (w, y, r, h) in enumerate(GRID)])
    ranked = F.array_sort(F.transform(grid, lambda p: F.struct(F.md5(F.concat_ws(":", F.col(key).cast("string"), p["point"].cast("string"))).alias("h"), p.alias("p"))))
    drawn = packed.withColumn("p", F.explode(F.transform(F.slice(ranked, 1, draws), lambda x: x["p"])))
    last = F.element_at("day", -1) - horizon  # the last day with a value
    cuts = F.sequence((last - horizon).cast("int"), (F.col("day")[0] + initial).cast("int"), F.lit(-period))
    jobs = drawn.where(last - horizon >= F.col("day")[0] + initial).withColumn("cutoff", F.explode(cuts))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                day, near, y = (np.asarray(a, float) for a in (r.day, r.near, r.y))
                rows = np.flatnonzero((day > r.cutoff) & (day <= r.cutoff + horizon))
                yhat = _ridge(day, near, y, r.cutoff, rows, r.p)
                both = np.abs(y[rows]) + np.abs(yhat)
                out.append((r[0], r.p, r.cutoff, 100 * np.mean(2 * np.abs(y[rows] - yhat) / np.where(both == 0, 1, both))))
            yield pd.DataFrame(out, columns=[key, "p", "cutoff", "smape"])

    shape = "struct<point:int,week:int,year:int,ridge:double,history:int>"
    fits = jobs.select(key, "p", "day", "near", "y", "cutoff").repartition(key, "p", "cutoff").mapInPandas(score, f"{key} {kind[key]}, p {shape}, cutoff int, smape double")
    scores = materialise(fits.groupBy(key, "p").agg(F.count("*").alias("cutoffs"), F.avg("smape").alias("smape")), "scores")
    best = scores.groupBy(key).agg(F.min_by("p", F.struct("smape", "p.point")).alias("p"))
    marked = scores.join(best.select(key, F.col("p.point").alias("_best")), key).select(key, "p.*", "cutoffs", "smape", (F.col("p.point") == F.col("_best")).alias("chosen"))

    def refit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                day, near, y = (np.asarray(a, float) for a in (r.day, r.near, r.y))
                ahead = np.arange(len(day) - horizon, len(day))
                yhat = _ridge(day, near, y, day[-horizon - 1], ahead, r.p)
                dates = pd.to_datetime(r.start) + pd.to_timedelta(day[ahead] - day[0], unit="D")
                yield pd.DataFrame({key: r[0], ts: dates.date if kind[ts] == "date" else dates, "point": r.p["point"], "yhat": yhat})

    ahead = packed.join(best, key).select(key, "p", "day", "near", "y", "start").mapInPandas(refit, f"{key} {kind[key]}, {ts} {kind[ts]}, point int, yhat double")
    return marked, ahead


def recursive_forecast(df: DataFrame, key: str, ts: str, value: str, horizon: int = 30) -> DataFrame:
    """(key, ts, y_pred): a linear model on lags 1, 7, 30, rolling mean and deviation of 7 and the calendar.

    Every prediction feeds the lags of the days after it.
    """
    days = with_future(df, key, ts, value, horizon)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        sales = pdf[value].astype(float)
        past = sales.shift(1)
        known = np.column_stack([past, sales.shift(7), sales.shift(30), past.rolling(7).mean(), past.rolling(7).std()])
        dow = pdf["dow"].to_numpy(float)
        cal = np.column_stack([np.ones(len(pdf)), dow, pdf["month"], dow >= 5, pdf["holiday"], pdf["week"]]).astype(float)
        y, n = sales.to_numpy().copy(), len(pdf) - horizon
        beta, *_ = np.linalg.lstsq(np.hstack([known, cal])[30:n], y[30:n], rcond=None)
        for i in range(n, len(y)):
            week = y[i - 7 : i]
            y[i] = np.concatenate([[y[i - 1], y[i - 7], y[i - 30], week.mean(), week.std(ddof=1)], cal[i]]) @ beta
        return pd.DataFrame({key: pdf[key].iloc[n:], ts: pdf[ts].iloc[n:], "y_pred": y[n:]})

    kind = dict(df.dtypes)
    return days.groupBy(key).applyInPandas(run, f"{key} {kind[key]}, {ts} {kind[ts]}, y_pred double")


# Published response-surface coefficients of the unit-root test with a constant.
CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}


def unit_root(df: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """(key, statistic, lags, n, critical values): augmented Dickey-Fuller with a constant, lags by AIC."""

    def regress(y: np.ndarray, lags: int, drop: int) -> tuple[float, float, int]:
        dy = np.diff(y)
        rows = np.arange(drop, len(dy))
        x = np.column_stack([y[rows], np.ones(len(rows)), *[dy[rows - k] for k in range(1, lags + 1)]])
        beta, *_ = np.linalg.lstsq(x, dy[rows], rcond=None)
        rss = ((dy[rows] - x @ beta) ** 2).sum()
        n, k = x.shape
        se = np.sqrt(rss / (n - k) * np.linalg.pinv(x.T @ x)[0, 0])
        return float(beta[0] / se), float(n * np.log(rss / n) + 2 * k), n

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(ts)[value].to_numpy(float)
        most = int(np.ceil(12 * (len(y) / 100) ** 0.25))
        best = min(range(most + 1), key=lambda p: regress(y, p, most)[1])
        t, _, n = regress(y, best, best)
        crit = {c: b0 + b1 / n + b2 / n**2 + b3 / n**3 for c, (b0, b1, b2, b3) in CRITICAL.items()}
        return pd.DataFrame([{key: pdf[key].iloc[0], "statistic": t, "lags": best, "n": n, **crit}])

    kind = dict(df.dtypes)
    return df.groupBy(key).applyInPandas(run, f"{key} {kind[key]}, statistic double, lags int, n bigint, crit_1 double, crit_5 double, crit_10 double")
