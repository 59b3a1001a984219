"""Quantiles, ordered scans and ranks against pandas, with one key holding most rows."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quantiles
from ledgerline.operators.ordered import as_of, hashed_position, in_order, previous_value, running_totals
from ledgerline.operators.quantiles import exact_quantiles, iqr_fences

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 1000])
def test_small_groups_equal_numpy(spark, n):
    x = np.round(np.random.default_rng(n).normal(size=n), 2)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    q = exact_quantiles(df, ["x"], PROBS).first()
    assert np.allclose(q["q"], np.quantile(x, PROBS))
    assert (q["n"], q["low"], q["high"]) == (n, x.min(), x.max())


def skewed(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Key 0 holds two thirds, and half of its values are one value."""
    rng = np.random.default_rng(0)
    key = np.where(rng.random(n) < 0.67, 0, rng.integers(1, 4, n))
    return key, np.where(rng.random(n) < 0.5, 7.0, np.round(rng.lognormal(size=n), 3))


@pytest.mark.parametrize(("most", "bins", "passes"), [(quantiles.MOST, quantiles.BINS, 1), (40, 8, 3)])
def test_large_skewed_groups_equal_numpy(spark, monkeypatch, most, bins, passes):
    key, x = skewed(300_000)
    df = spark.createDataFrame(pd.DataFrame({"k": key, "x": x}))
    settled, sizes = quantiles._settled, []
    monkeypatch.setattr(quantiles, "_settled", lambda state, by: sizes.append(1) or settled(state, by))
    got = exact_quantiles(df, ["x"], PROBS, ["k"], most=most, bins=bins).collect()
    assert len(sizes) - 1 >= passes
    assert len(got) == 4
    for r in got:
        mine = x[key == r["k"]]
        assert r["n"] == len(mine)
        assert np.allclose(r["q"], np.quantile(mine, PROBS))


def test_no_task_sorts_more_than_the_bound(spark):
    """The arrays that the last pass sorts, read from the plan's own collected lists."""
    _, x = skewed(50_000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": -x * 1e6}))
    seen = []
    inner = F.sort_array
    try:
        F.sort_array = lambda c: seen.append(c) or inner(c)
        q = exact_quantiles(df, ["x", "y"], PROBS, most=30, bins=16)
    finally:
        F.sort_array = inner
    assert len(seen) == 1
    for r in q.collect():
        assert np.allclose(r["q"], np.quantile(x if r["metric"] == "x" else -x * 1e6, PROBS))


def test_quantiles_of_extreme_values(spark):
    x = [1e308, -1e308, 5e-324, -5e-324, 0.0, 1.0, 1.0000000000000002, float("inf"), 1e-300, 2e-300, *(10.0**k for k in range(-30, 300, 7))] * 3
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    inner = [p for p in np.linspace(0, 1, 23)]
    got = exact_quantiles(df, ["x"], inner, most=2, bins=6).first()["q"]
    ordered = np.sort(x)
    for p, q in zip(inner, got):
        a, b = ordered[int(np.floor(p * (len(x) - 1)))], ordered[int(np.ceil(p * (len(x) - 1)))]
        assert a <= q <= b


def test_null_values_and_keys_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), (None, 100.0)], "k string, x double")
    rows = exact_quantiles(df, ["x"], [0.5], ["k"]).collect()
    assert [(r["k"], r["n"], r["q"]) for r in rows] == [("a", 2, [2.0])]


def test_fences_of_two_columns(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(101)], "a double, b double")
    fences = iqr_fences(df, ["a", "b"])
    row = df.limit(1).select(*[c.alias(f"{n}{i}") for n, pair in fences.items() for i, c in enumerate(pair)]).first()
    assert (row["a0"], row["a1"]) == (25 - 75.0, 75 + 75.0)
    assert (row["b0"], row["b1"]) == (625 - 7500.0, 5625 + 7500.0)


def events(n: int, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "k": np.where(rng.random(n) < 0.5, 0, rng.integers(1, 6, n)),
            "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 60 * 24 * 5, n), unit="min"),
            "v": rng.normal(size=n),
        }
    )


def test_previous_value_equals_shift(spark):
    pdf = events(3000)
    got = previous_value(spark.createDataFrame(pdf), "k", "ts", "id", "v", "prev", bits=3).toPandas().sort_values("id")
    want = pdf.sort_values(["k", "ts", "id"]).assign(prev=lambda d: d.groupby("k")["v"].shift(1)).sort_values("id")
    assert np.allclose(got["prev"], want["prev"], equal_nan=True)
    assert len(got) == len(pdf)


def test_as_of_equals_merge_asof(spark):
    facts, snaps = events(2000, 2).drop(columns="v"), events(300, 3)
    got = as_of(spark.createDataFrame(facts), spark.createDataFrame(snaps), "k", "ts", "v", "last", "id", bits=3).toPandas().sort_values("id")
    snaps = snaps.sort_values(["ts", "id"]).drop_duplicates(["k", "ts"], keep="last")
    want = pd.merge_asof(facts.sort_values("ts"), snaps[["k", "ts", "v"]].sort_values("ts"), on="ts", by="k").sort_values("id")
    assert len(got) == len(facts)
    assert np.allclose(got["last"], want["v"], equal_nan=True)


def test_as_of_keeps_a_null_snapshot(spark):
    t = dt.datetime.fromisoformat
    facts = spark.createDataFrame([(1, "a", t("2024-01-02"))], "id int, k string, ts timestamp_ntz")
    snaps = spark.createDataFrame([(1, "a", t("2024-01-01 00:00"), 5.0), (2, "a", t("2024-01-01 12:00"), None)], "id int, k string, ts timestamp_ntz, v double")
    assert as_of(facts, snaps, "k", "ts", "v", "last", "id").first()["last"] is None


def test_hot_key_in_one_hour_is_swept_by_many_tasks(spark):
    """One key holds all rows of one hour: several tasks sort it, and no window holds more rows than stated."""
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, start + dt.timedelta(seconds=(i * 7919) % 3000), i) for i in range(4000)], "k int, ts timestamp_ntz, id int").repartition(8)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # small pieces would be merged by size
    spark.conf.set(merging, "false")
    try:
        placed = in_order(df, "k", "ts", "id", bits=6)
    finally:
        spark.conf.unset(merging)
    assert placed.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0] <= 64
    per_task = [r["count"] for r in placed.groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(per_task) >= 4
    assert max(per_task) < 2000
    got = previous_value(df, "k", "ts", "id", "id", "prev", bits=6).toPandas().sort_values(["ts", "id"])
    assert got["prev"].tolist()[1:] == got["id"].tolist()[:-1]


def test_running_totals_equal_cumsum(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"x": np.unique(np.round(rng.normal(size=5000), 3))})
    pdf["a"] = rng.integers(0, 9, len(pdf))
    got = running_totals(spark.createDataFrame(pdf), "x", ["a"], buckets=16).toPandas().sort_values("x")
    assert (got["before_a"].to_numpy() == pdf["a"].cumsum().to_numpy() - pdf["a"].to_numpy()).all()
    assert (got["all_a"] == pdf["a"].sum()).all()


def test_hashed_position_is_a_permutation_per_stratum(spark):
    df = spark.range(5000).withColumn("s", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    rows = hashed_position(df, "id", ["s"], digits=2).toPandas()
    for _, part in rows.groupby("s"):
        assert sorted(part["pos"]) == list(range(1, len(part) + 1))
        assert (part["size"] == len(part)).all()
