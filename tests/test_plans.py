"""Shapes of physical plans that must hold at any size."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries

QUERIES = queries()


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


NO_ACTION = [n for n in sorted(QUERIES) if re.match(r"(q0|q1[12456]|j|a|s0|u0|pr|f|w|t0|t1[0-7]|p0|p1|m1[678]|m2[3-8]|m3[1236])", n) and n not in ("pr06_drop_all_null",)]


@pytest.mark.parametrize("name", NO_ACTION)
def test_no_product_of_tables(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name,part",
    [
        ("io03_read_parquet", "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]"),
        ("pr11_valid_range", "GreaterThanOrEqual(l_quantity,5.0)"),
        ("pr27_latest_window", "GreaterThanOrEqual(ts,2024-01-19T00:00)"),
        ("a08_rounded_average", "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>"),
        ("s02_top_k", "TakeOrderedAndProject"),
        ("t10_words_by_class", "WindowGroupLimit"),
    ],
)
def test_work_reaches_the_scan(spark, sf_dir, name, part):
    assert part in plan(spark, sf_dir, name)


def test_windows_on_one_series_share_one_exchange(spark, sf_dir):
    """Nine lags, one shuffle by key on top of the grid's own."""
    text = plan(spark, sf_dir, "w01_lags").split("Subqueries")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(event_type#\d+, \d+\)", text)) == 1
