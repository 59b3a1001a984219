from __future__ import annotations

import datetime as dt
import itertools
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import cleaning as C
from ledgerline.operators import relational as R


@pytest.mark.parametrize("blocks", [1, 3])
def test_pairs_equal_brute_force(spark, blocks):
    rng = np.random.default_rng(5)
    rows = [(int(g), f"i{int(i)}") for g, i in zip(rng.integers(0, 60, 800), rng.integers(0, 15, 800))]
    rows += [(999, f"i{i}") for i in range(15)]  # one group holding every item
    got = {(r["item_a"], r["item_b"]): r["pair_count"] for r in R.cooccurring_pairs(spark.createDataFrame(rows, "g int, i string"), "g", "i", blocks).collect()}
    want = Counter()
    for g in {g for g, _ in rows}:
        want.update(itertools.combinations(sorted({i for h, i in rows if h == g}), 2))
    assert got == dict(want)


def test_group_agg_drops_null_keys_and_sums_nothing_to_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), (None, 9.0)], "k string, x double")
    rows = {r["k"]: (r["x_sum"], r["x_count"]) for r in R.group_agg(df, ["k"], {"x": ["sum", "count"]}).collect()}
    assert rows == {"a": (0.0, 0), "b": (2.0, 1)}


def test_value_counts_shares_sum_to_one_without_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    rows = {r["k"]: (r["n"], r["share"]) for r in R.value_counts(df, "k").collect()}
    assert rows == {"a": (2, 2 / 3), "b": (1, 1 / 3)}


def test_newest_and_oldest_break_ties(spark):
    df = spark.createDataFrame([("a", 1, 10, "x"), ("a", 1, 11, "y"), ("a", 0, 99, "z")], "k string, t int, id int, v string")
    assert R.newest(df, ["k"], ["t", "id"]).first()["v"] == "y"
    assert R.oldest(df, ["k"], ["t", "id"]).first()["v"] == "z"


def test_densify_has_every_cell_once(spark):
    facts = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 3), 5)], "k string, hr timestamp_ntz, n int")
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    grid = R.densify(facts, keys, "hr", F.expr("timestamp_ntz'2024-01-01'"), F.expr("timestamp_ntz'2024-01-02'"), "1 hour", {"n": 0})
    assert grid.count() == 2 * 25 and grid.distinct().count() == 50
    assert grid.agg(F.sum("n")).first()[0] == 5


def test_top_k_is_total(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(50)], "id int, x double").repartition(7)
    assert [r["id"] for r in R.top_k(df, 3, [F.col("x").desc()], ["id"]).collect()] == [0, 1, 2]


def test_rfm_by_hand(spark):
    t = dt.datetime.fromisoformat
    df = spark.createDataFrame([(1, t("2024-01-01"), 10, 5.0), (1, t("2024-01-03"), 10, 1.0), (2, t("2024-01-10"), 11, 2.5)], "c int, d timestamp_ntz, o int, x double")
    rows = {r["c"]: (r["recency"], r["frequency"], r["monetary"]) for r in R.rfm(df, "c", "d", "o", "x").collect()}
    assert rows == {1: (8, 1, 6.0), 2: (1, 1, 2.5)}


def test_outlier_fences_come_from_the_unfiltered_frame(spark):
    pdf = pd.DataFrame({"a": [*range(20), 500], "b": [*range(20, 0, -1), -400]}).astype(float)
    keep = np.ones(len(pdf), bool)
    for c in ("a", "b"):
        q1, q3 = pdf[c].quantile([0.25, 0.75])
        keep &= pdf[c].between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    df = spark.createDataFrame(pdf)
    assert C.drop_iqr_outliers(df, ["a", "b"]).count() == keep.sum() == 20
    assert C.label_iqr_outliers(df, "a", "b").where("outlier = -3").count() == 1


def test_validate_counts_unknown_as_broken_and_require_stops(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    assert C.validate(df, {"pos": F.col("x") > 0}).first()["violations"] == 2
    with pytest.raises(ValueError, match="missing columns"):
        C.require(df, ["x", "y"])
    with pytest.raises(ValueError, match="broken rules"):
        C.require(df, ["x"], {"pos": F.col("x") > 0})


def test_drop_all_null_and_snake_case(spark):
    df = spark.createDataFrame([(1, None, "a")], "`Row Id` int, `Empty One` double, `Sub-Category` string")
    assert C.snake_case(C.drop_all_null(df)).columns == ["row_id", "sub_category"]


def test_zscore_ignores_nulls_and_constant_groups(spark):
    rows = [("a", 1.0)] * 30 + [("a", 100.0), ("a", None), ("c", 5.0), ("c", 5.0)]
    out = C.drop_zscore(spark.createDataFrame(rows, "k string, x double"), "x", 2.0, ["k"])
    assert out.count() == 33 and out.where("x = 100").count() == 0


def test_histogram_keeps_the_top_edge_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (10.0,)], "x double")
    rows = C.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 0, 0, 0, 1]
    assert abs(sum(r["density"] for r in rows) * 2.0 - 1) < 1e-12


def test_funnel_is_cumulative(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (None, 1)], "a int, b int")
    rows = C.funnel(df, {"a": F.col("a") == 1, "b": F.col("b") == 1}).orderBy("step_no").collect()
    assert [r["rows"] for r in rows] == [4, 2, 1]


@pytest.mark.parametrize("blocks", [1, 3])
@pytest.mark.parametrize("held", [1, 1_000_000])
def test_pairs_with_least_support(spark, blocks, held):
    """Rare items go before pairs are made; tasks that may hold one pair at a time give the same sums."""
    rng = np.random.default_rng(8)
    rows = sorted({(int(g), f"i{min(int(rng.geometric(0.15)), 30)}") for g in range(120) for _ in range(5)})
    held_by = {}
    for g, i in rows:
        held_by.setdefault(i, set()).add(g)
    want = {(a, b): len(held_by[a] & held_by[b]) for a in held_by for b in held_by if a < b and len(held_by[a] & held_by[b]) >= 6}
    got = R.cooccurring_pairs(spark.createDataFrame(rows, "g int, i string"), "g", "i", blocks, least_support=6, held_pairs=held)
    assert {(r["item_a"], r["item_b"]): r["pair_count"] for r in got.collect()} == want


def test_histogram_by_class_with_one_value(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("b", 5.0), (None, 1.0), ("b", None)], "k string, x double")
    got = sorted(tuple(r) for r in C.histogram_by(df, "x", "k", 2).collect())
    assert got == [("a", 0, 5.0, 2, 1.0), ("a", 1, 5.0, 0, 0.0), ("b", 0, 5.0, 1, 1.0), ("b", 1, 5.0, 0, 0.0)]

