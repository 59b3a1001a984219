"""Every named query against its SQL twin on the smallest tables; queries without one must give rows."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, compare

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()

# Learners that only repeat the same fit at length; the smaller ones cover the same code.
LONG = {"m07_boosted_two_step", "m12_per_source_classifier", "m14_elbow_silhouette"}


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    message = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert message.startswith(("ok", "EMPTY")), message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - LONG))
def test_gives_rows(spark, sf_dir, name):
    assert len(QUERIES[name](spark, sf_dir).collect()) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"segment", "customers", "recency", "frequency", "monetary_100"}


@pytest.mark.parametrize("name", ["a28_rfm", "j09_as_of", "w10_gap_to_previous", "a15_quantiles", "m26_auc", "q11_skill_pairs", "t14_map_reduce_summary", "p08_stratified_split"])
def test_partition_count_does_not_matter(spark, sf_dir, name):
    def bag():
        return sorted(map(str, QUERIES[name](spark, sf_dir).collect()))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    eight = bag()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert bag() == eight
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
