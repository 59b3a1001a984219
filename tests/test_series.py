from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import forecast as FC
from ledgerline.operators import series as S


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(6)
    t = pd.date_range("2024-01-01", periods=120, freq="D")
    parts = []
    for k, slope in (("a", 0.5), ("b", -0.2)):
        y = 50 + slope * np.arange(120) + 5 * np.sin(2 * np.pi * np.arange(120) / 7) + rng.normal(size=120)
        parts.append(pd.DataFrame({"k": k, "d": t, "x": y}))
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("d", F.col("d").cast("timestamp_ntz"))


def same(got, want):
    return np.allclose(got.to_numpy(float), want.to_numpy(float), equal_nan=True)


def test_frames_equal_pandas(df, pdf):
    got = df.select(
        "k", "d", S.rolling_mean_before("k", "d", "x", 3).alias("before"), S.rolling_mean_with("k", "d", "x", 24).alias("with"), S.rolling_std_with("k", "d", "x", 7).alias("std")
    ).toPandas().sort_values(["k", "d"])
    g = pdf.sort_values(["k", "d"]).groupby("k")["x"]
    assert same(got["before"], g.transform(lambda s: s.shift(1).rolling(3).mean()))
    assert same(got["with"], g.transform(lambda s: s.rolling(24, min_periods=1).mean()))
    assert same(got["std"], g.transform(lambda s: s.rolling(7).std()))


def test_fill_and_interpolate_equal_pandas(spark, pdf):
    holed = pdf.assign(x=pdf["x"].where(np.random.default_rng(7).random(len(pdf)) > 0.4))
    df = spark.createDataFrame(holed).withColumn("d", F.col("d").cast("timestamp_ntz")).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    g = holed.sort_values(["k", "d"]).groupby("k")["x"]
    filled = S.fill_forward_back(df, "k", "d", ["x"]).toPandas().sort_values(["k", "d"])
    assert same(filled["x"], g.transform(lambda s: s.ffill().bfill()))
    line = S.interpolate(df, "k", "d", "x", "y").toPandas().sort_values(["k", "d"])
    assert same(line["y"], g.transform(lambda s: s.interpolate()))


@pytest.mark.parametrize("period,model", [(7, "additive"), (6, "additive"), (7, "multiplicative"), (6, "multiplicative")])
def test_decomposition_adds_up(df, period, model):
    out = S.decompose(df, "k", "d", "x", period, model).toPandas().sort_values(["k", "d"])
    known = out.dropna(subset=["trend"])
    assert len(out) - len(known) == 2 * 2 * (period // 2)
    back = known["trend"] + known["seasonal"] + known["resid"] if model == "additive" else known["trend"] * known["seasonal"] * known["resid"]
    assert same(back, known["x"])
    index = out.groupby("k").head(period).groupby("k")["seasonal"].mean()
    assert np.allclose(index, 0 if model == "additive" else 1)


def test_even_trend_uses_half_weights(df, pdf):
    out = S.decompose(df, "k", "d", "x", 6).where("k = 'a'").toPandas().sort_values("d")["trend"].to_numpy()
    x = pdf[pdf.k == "a"]["x"].to_numpy()
    w = np.array([0.5, 1, 1, 1, 1, 1, 0.5]) / 6
    assert np.allclose(out[3:-3], np.convolve(x, w, "valid"))


def test_sequences_hold_the_past_only(df, pdf):
    rows = S.sequences(df, "k", "d", "x", 5).where("k = 'b'").toPandas().sort_values("d")
    x = pdf[pdf.k == "b"]["x"].to_numpy()
    assert len(rows) == 115 and np.allclose(rows["past"].iloc[0], x[:5]) and np.isclose(rows["label"].iloc[0], x[5])


def test_folds_grow_and_do_not_overlap(df):
    folds = S.expanding_folds(df, "d", 5).toPandas()
    for k, part in folds.groupby("fold"):
        train, valid = part[part.part == "train"], part[part.part == "valid"]
        assert train["d"].max() < valid["d"].min()
        assert (train["d"].nunique(), valid["d"].nunique()) == (20 * k, 20)


def test_forecast_follows_trend_and_week(spark):
    t = pd.date_range("2022-01-01", periods=800, freq="D")
    y = 10 + 0.1 * np.arange(800) + 3 * np.sin(2 * np.pi * np.arange(800) / 7)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "d": t.date, "x": y}))
    out = FC.forecast(df, "k", "d", "x", 30, validate=True).toPandas()
    assert len(out) == 30 and (out["yhat"] - out["actual"]).abs().max() < 0.5
    assert ((out["low"] <= out["yhat"]) & (out["yhat"] <= out["high"])).all()
    ahead = FC.recursive_forecast(df, "k", "d", "x", 14).toPandas().sort_values("d")
    assert len(ahead) == 14 and ahead["d"].iloc[0] == t[-1].date() + pd.Timedelta(days=1)
    tests = FC.backtest(df, "k", "d", "x", 400, 60, 30).toPandas()
    assert (tests["n"] == 30).all() and len(tests) == (799 - 30 - 400) // 60 + 1 and tests["mae"].max() < 2


def test_unit_root_tells_a_walk_from_noise(spark):
    rng = np.random.default_rng(8)
    e = rng.normal(size=600)
    t = pd.date_range("2022-01-01", periods=600, freq="D").date
    pdf = pd.concat([pd.DataFrame({"k": "walk", "d": t, "x": e.cumsum()}), pd.DataFrame({"k": "noise", "d": t, "x": e})])
    rows = {r["k"]: r for r in FC.unit_root(spark.createDataFrame(pdf), "k", "d", "x").collect()}
    assert rows["noise"]["statistic"] < rows["noise"]["crit_1"] < -3.4
    assert rows["walk"]["statistic"] > rows["walk"]["crit_5"]
