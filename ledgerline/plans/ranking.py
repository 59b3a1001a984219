"""Sorting and top-k S-01 .. S-04, set operations U-01 .. U-04."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.relational import newest, rows_missing, rows_of, top_k
from ledgerline.plans.common import GRID, events_grid
from ledgerline.registry import query
from ledgerline.tables import table


@query("s01_multi_key_order", "select o_orderkey, o_orderpriority, o_totalprice, o_orderdate from orders order by o_orderpriority, o_totalprice desc, o_orderkey")
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate").orderBy(
        F.col("o_orderpriority").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last(), "o_orderkey"
    )


@query("s02_top_k", "select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def s02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 20, [F.col("o_totalprice").desc_nulls_last()], ["o_orderkey"])


@query("s03_top_k_absolute", "select c_custkey, c_acctbal, abs(c_acctbal - 4500) as gap from customer order by gap desc, c_custkey limit 15")
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.abs(F.col("c_acctbal") - 4500).alias("gap"))
    return top_k(gap, 15, [F.col("gap").desc()], ["c_custkey"])


@query(
    "s04_top_keys_filter",
    """with best as (select l_partkey, count(*) as n from lineitem group by 1 order by n desc, l_partkey limit 10)
select l_partkey, l_returnflag, count(*) as n, round(avg(l_extendedprice), 4) as mean_price from lineitem where l_partkey in (select l_partkey from best) group by all""",
)
def s04(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_extendedprice")
    best = top_k(lines.groupBy("l_partkey").agg(F.count("*").alias("n")), 10, [F.col("n").desc()], ["l_partkey"])
    return rows_of(lines, F.broadcast(best), ["l_partkey"]).groupBy("l_partkey", "l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("mean_price")
    )


@query(
    "u01_union_by_name",
    """select o_orderkey, o_totalprice, 'jan' as part, o_orderpriority from orders where month(o_orderdate) = 1
union all select o_orderkey, o_totalprice, 'feb', null from orders where month(o_orderdate) = 2""",
)
def u01(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    jan = orders.where(F.month("o_orderdate") == 1).select("o_orderkey", "o_totalprice", F.lit("jan").alias("part"), "o_orderpriority")
    feb = orders.where(F.month("o_orderdate") == 2).select(F.lit("feb").alias("part"), "o_totalprice", "o_orderkey")
    return jan.unionByName(feb, allowMissingColumns=True)


@query(
    "u02_union_keep_last",
    f"""with {GRID}, b as (select hr, event_type, n, 1 as version from grid where hr < timestamp '2024-01-20'
  union all select hr, event_type, n * 2, 2 from grid where hr >= timestamp '2024-01-15')
select hr, event_type, n, version from b qualify row_number() over (partition by hr, event_type order by version desc) = 1""",
)
def u02(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = events_grid(spark, sf_dir)
    old = grid.where("hr < timestamp_ntz'2024-01-20'").withColumn("version", F.lit(1))
    new = grid.where("hr >= timestamp_ntz'2024-01-15'").withColumn("n", F.col("n") * 2).withColumn("version", F.lit(2))
    return newest(old.unionByName(new), ["hr", "event_type"], ["version"])


@query(
    "u03_set_difference",
    "select distinct o_custkey from orders where o_orderpriority = '1-URGENT' except select o_custkey from orders where o_orderpriority = '5-LOW'",
)
def u03(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey").distinct()
    low = orders.where(F.col("o_orderpriority") == "5-LOW").select("o_custkey").distinct()
    return rows_missing(urgent, low, ["o_custkey"])


@query("u04_distinct", "select distinct o_orderstatus, o_orderpriority from orders")
def u04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()
