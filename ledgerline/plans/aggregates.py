"""Aggregations A-01 .. A-41."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import day
from ledgerline.operators.cleaning import histogram
from ledgerline.operators.evaluation import binary_counts
from ledgerline.operators.features import levels
from ledgerline.operators.quantiles import exact_quantiles, quantile_scalars
from ledgerline.operators.relational import attach, group_agg, pivot_sums, rfm, rows_of, share_matrix, top_k, value_counts
from ledgerline.plans.common import DAILY, ERRORS, baseline_errors, brand_days, brand_lines
from ledgerline.plans.reports import SKILL_PAY_SQL, skill_pay
from ledgerline.registry import query
from ledgerline.tables import materialise, table

# Levels of the fixture, which the SQL has to spell out; the queries read theirs from the tables.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "a01_group_agg",
    """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as l_quantity_sum, round(avg(l_quantity), 6) as l_quantity_avg,
round(max(l_extendedprice), 2) as l_extendedprice_max, count(l_extendedprice) as l_extendedprice_count from lineitem group by all""",
)
def a01(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = group_agg(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"],
        {"l_quantity": ["sum", "avg"], "l_extendedprice": ["max", "count"]},
    )
    return out.withColumns({"l_quantity_sum": F.round("l_quantity_sum", 2), "l_quantity_avg": F.round("l_quantity_avg", 6), "l_extendedprice_max": F.round("l_extendedprice_max", 2)})


@query(
    "a02_count_distinct",
    "select o_orderstatus, count(distinct o_custkey) as customers, count(distinct o_orderpriority) as priorities from orders group by all",
)
def a02(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Distinct counts are planned in two steps keyed by (status, value), so no status is bound to one task.
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderpriority").alias("priorities")
    )


@query(
    "a03_having",
    """select p_brand as brand, count(*) as n, round(avg(l_extendedprice), 4) as mean_price from lineitem join part on l_partkey = p_partkey
group by all having count(*) > (select count(*) from lineitem) / 25""",
)
def a03(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = brand_lines(spark, sf_dir)
    total = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("t")).scalar()
    return lines.groupBy("brand").agg(F.count("*").alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("mean_price")).where(F.col("n") > total / 25)


@query("a04_value_counts", "select o_orderpriority, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from orders where o_orderpriority is not null group by all")
def a04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "orders"), "o_orderpriority").withColumn("share", F.round("share", 6))


@query(
    "a05_share_matrix",
    "select c_mktsegment, " + ", ".join(f"round(count(*) filter (o_orderpriority = '{p}') / count(*), 6) as \"{p}\"" for p in PRIORITIES)
    + " from orders join customer on o_custkey = c_custkey group by all",
)
def a05(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counts per customer and priority merge before the join, however hot a customer is.
    per = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    seg = attach(per, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", ["c_mktsegment"], "inner")
    cells = materialise(seg.groupBy("c_mktsegment", "o_orderpriority").agg(F.sum("n").alias("n")), "shares")
    return share_matrix(cells, "c_mktsegment", "o_orderpriority", "n", levels(cells, "o_orderpriority"))


@query("a06_crosstab", "select quality, count(*) filter (toxic = 0) as toxic_0, count(*) filter (toxic = 1) as toxic_1 from labels group by all")
def a06(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "labels").groupBy("quality").pivot("toxic", [0, 1]).agg(F.count(F.lit(1))).fillna(0)
    return wide.select("quality", F.col("0").alias("toxic_0"), F.col("1").alias("toxic_1"))


# Part types of the fixture, for the SQL.
PANEL_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "a07_pivot_panel",
    "select cast(l_shipdate as date) as d, " + ", ".join(f"round(sum(l_extendedprice) filter (p_type = '{t}'), 2) as {t.lower()}" for t in PANEL_TYPES)
    + " from lineitem join part on l_partkey = p_partkey group by all",
)
def a07(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = brand_lines(spark, sf_dir).withColumn("d", day(F.col("l_shipdate")))
    types = levels(table(spark, sf_dir, "part"), "p_type")
    wide = pivot_sums(lines, "d", "p_type", types, F.sum("l_extendedprice"))
    return wide.select("d", *[F.round(F.col(f"`{t}`"), 2).alias(t.lower()) for t in types])


@query("a08_rounded_average", "select o_orderpriority, count(*) as n_orders, round(avg(o_totalprice), 0) as avg_price from orders where o_totalprice is not null group by all")
def a08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_totalprice").isNotNull()).groupBy("o_orderpriority").agg(
        F.count("*").alias("n_orders"), F.round(F.avg("o_totalprice"), 0).alias("avg_price")
    )


@query(
    "a09_demand_by_segment",
    """select c_mktsegment, l_partkey, count(*) as demand from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
where c_mktsegment = 'BUILDING' group by all order by demand desc, l_partkey limit 10""",
)
def a09(spark: SparkSession, sf_dir: str) -> DataFrame:
    who = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    mine = attach(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), who, "o_custkey", "c_custkey", ["c_mktsegment"], "inner")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    demand = lines.join(mine, "o_orderkey").groupBy("c_mktsegment", "l_partkey").agg(F.count("*").alias("demand"))
    return top_k(demand, 10, [F.col("demand").desc()], ["l_partkey"])


@query("a10_optimal_ranking", f"{SKILL_PAY_SQL} select * from pay where demand_count > 50 order by avg_price desc, demand_count desc, brand limit 10")
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(skill_pay(spark, sf_dir).where(F.col("demand_count") > 50), 10, [F.col("avg_price").desc(), F.col("demand_count").desc()], ["brand"])


@query(
    "a11_location_ranking",
    """select n_name, count(*) as n_customers, round(avg(c_acctbal), 4) as mean_balance from customer join nation on c_nationkey = n_nationkey
group by all having count(*) >= 5 order by mean_balance desc, n_name limit 15""",
)
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n_customers"), F.round(F.avg("c_acctbal"), 4).alias("mean_balance"))
    named = attach(per, table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", ["n_name"], "inner").drop("c_nationkey")
    return top_k(named.where(F.col("n_customers") >= 5), 15, [F.col("mean_balance").desc()], ["n_name"])


@query(
    "a12_average_selling_price",
    """select p_brand as brand, p_type, round(sum(l_extendedprice) / count(distinct l_orderkey), 4) as asp
from lineitem join part on l_partkey = p_partkey group by all""",
)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two steps: per order first, so a hot (brand, type) is merged by many tasks.
    per = brand_lines(spark, sf_dir).groupBy("brand", "p_type", "l_orderkey").agg(F.sum("l_extendedprice").alias("s"))
    return per.groupBy("brand", "p_type").agg(F.round(F.try_divide(F.sum("s"), F.count("*")), 4).alias("asp")).orderBy(F.col("asp").desc())


@query(
    "a13_per_capita",
    """with p(n_nationkey, population) as (select n_nationkey, 1000000 + 50000 * n_nationkey from nation),
top as (select c_nationkey, count(*) as n from customer group by 1 order by n desc, c_nationkey limit 5)
select n_name, n as customers, round(n * 100000.0::double / population, 6) as per_100k from top join nation on c_nationkey = nation.n_nationkey join p on p.n_nationkey = c_nationkey""",
)
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    top = top_k(counts, 5, [F.col("customers").desc()], ["c_nationkey"])
    # Populations are not in the tables; they are derived from the nation key.
    people = table(spark, sf_dir, "nation").withColumn("population", 1000000 + 50000 * F.col("n_nationkey"))
    named = attach(top, people, "c_nationkey", "n_nationkey", ["n_name", "population"], "inner")
    return named.select("n_name", "customers", F.round(F.col("customers") * 100000.0 / F.col("population"), 6).alias("per_100k"))


@query(
    "a14_describe",
    """select event_type, count(value) as n, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std, min(value) as low,
round(quantile_cont(value, 0.25), 6) as q1, round(quantile_cont(value, 0.5), 6) as q2, round(quantile_cont(value, 0.75), 6) as q3, max(value) as high
from events group by all""",
)
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_type", "value")
    moments = ev.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_samp("value"), 6).alias("std"))
    q = exact_quantiles(ev, ["value"], [0.25, 0.5, 0.75], ["event_type"], stored=True)
    return q.join(moments, "event_type").select(
        "event_type", "n", "mean", "std", "low", *[F.round(F.col("q")[i], 6).alias(f"q{i + 1}") for i in range(3)], "high"
    )


@query(
    "a15_quantiles",
    "select " + ", ".join(f"round(quantile_cont(o_totalprice, {p}), 6) as p{int(p * 100)}" for p in (0.01, 0.1, 0.33, 0.5, 0.66, 0.9, 0.99)) + " from orders",
)
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    probs = [0.01, 0.1, 0.33, 0.5, 0.66, 0.9, 0.99]
    q = exact_quantiles(table(spark, sf_dir, "orders"), ["o_totalprice"], probs, stored=True)
    return q.select(*[F.round(F.col("q")[i], 6).alias(f"p{int(p * 100)}") for i, p in enumerate(probs)])


@query("a15_quantiles_approx")
def a15_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.percentile_approx("o_totalprice", 0.5, 10_000).alias("median"))


NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "a16_correlation_matrix",
    " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from lineitem" for a in NUMERIC for b in NUMERIC),
)
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]]
    row = table(spark, sf_dir, "lineitem").agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    both = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs if a != b]
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"`{c}`"), 6).alias("r")) for a, b, c in both])
    return row.select(F.inline(cells))


@query(
    "a17_histogram",
    """with e as (select min(value) as lo, max(value) as hi, count(*) as t from events),
b as (select least(floor((value - lo) / (hi - lo) * 20), 19)::int as bin, count(*) as n from events, e group by 1)
select i::int as bin, round(lo + i * (hi - lo) / 20, 6) as low, coalesce(n, 0)::bigint as n, round(coalesce(n, 0) / t / ((hi - lo) / 20), 6) as density
from e cross join range(20) r(i) left join b on b.bin = i""",
)
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(table(spark, sf_dir, "events"), "value", 20).select(
        "bin", F.round("low", 6).alias("low"), "n", F.round("density", 6).alias("density")
    )


@query("a17_histogram_log", "select floor(log10(o_totalprice) * 4)::int as bin, count(*) as n from orders where o_totalprice > 0 group by all")
def a17_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 0).groupBy(F.floor(F.log10("o_totalprice") * 4).cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query(
    "a18_box_stats",
    """with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as q2, quantile_cont(value, 0.75) as q3 from events group by 1)
select event_type, min(value) as low, round(any_value(q1), 6) as q1, round(any_value(q2), 6) as q2, round(any_value(q3), 6) as q3, max(value) as high,
  min(value) filter (value >= q1 - 1.5 * (q3 - q1)) as whisker_low, max(value) filter (value <= q3 + 1.5 * (q3 - q1)) as whisker_high
from events join q using (event_type) group by event_type""",
)
def a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_type", "value")
    box = materialise(exact_quantiles(ev, ["value"], [0.25, 0.5, 0.75], ["event_type"], stored=True), "box")
    spread = (F.col("q")[2] - F.col("q")[0]) * 1.5
    inside = ev.join(box.select("event_type", "q"), "event_type").groupBy("event_type").agg(
        F.min(F.when(F.col("value") >= F.col("q")[0] - spread, F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= F.col("q")[2] + spread, F.col("value"))).alias("whisker_high"),
    )
    return box.join(inside, "event_type").select(
        "event_type", "low", *[F.round(F.col("q")[i], 6).alias(f"q{i + 1}") for i in range(3)], "high", "whisker_low", "whisker_high"
    )


@query("a19_grid_density", "select floor(l_quantity / 5)::bigint as gx, floor(l_extendedprice / 5000)::bigint as gy, count(*) as n from lineitem group by all")
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.floor(F.col("l_quantity") / 5).alias("gx"), F.floor(F.col("l_extendedprice") / 5000).alias("gy")).agg(F.count("*").alias("n"))


@query(
    "a20_rollup",
    "select p_type, p_brand as brand, round(sum(l_extendedprice), 2) as total, count(*) as n from lineitem join part on l_partkey = p_partkey group by rollup (p_type, p_brand)",
)
def a20(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Leaf totals first, so only they are repeated per level.
    leaf = brand_lines(spark, sf_dir).groupBy("p_type", "brand").agg(F.sum("l_extendedprice").alias("s"), F.count("*").alias("c"))
    return leaf.rollup("p_type", "brand").agg(F.round(F.sum("s"), 2).alias("total"), F.sum("c").alias("n"))


@query(
    "a21_grouping_sets",
    """select c_mktsegment, c_nationkey, o_orderpriority, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey
group by grouping sets ((c_mktsegment), (c_nationkey), (o_orderpriority))""",
)
def a21(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.sum("o_totalprice").alias("s"))
    facts = attach(per, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", ["c_mktsegment", "c_nationkey"], "inner")
    leaf = facts.groupBy("c_mktsegment", "c_nationkey", "o_orderpriority").agg(F.sum("s").alias("s"))
    sets = [[F.col("c_mktsegment")], [F.col("c_nationkey")], [F.col("o_orderpriority")]]
    return leaf.groupingSets(sets, "c_mktsegment", "c_nationkey", "o_orderpriority").agg(F.round(F.sum("s"), 2).alias("total"))


@query(
    "a22_arg_max",
    """with t as (select o_custkey, p_brand as brand, round(sum(l_quantity), 2) as qty from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by all)
select o_custkey, brand, qty from t qualify row_number() over (partition by o_custkey order by qty desc, brand) = 1""",
)
def a22(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_order = brand_lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("o_orderkey"), "brand").agg(F.sum("l_quantity").alias("q"))
    owner = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    qty = per_order.join(owner, "o_orderkey").groupBy("o_custkey", "brand").agg(F.round(F.sum("q"), 2).alias("qty"))
    # min over (-qty, brand): the largest quantity, ties to the first brand; merges before the shuffle.
    best = qty.groupBy("o_custkey").agg(F.min(F.struct((-F.col("qty")).alias("m"), F.col("brand"))).alias("b"))
    return best.select("o_custkey", "b.brand", (-F.col("b.m")).alias("qty"))


@query(
    "a23_first_known",
    """select event_type, cast(ts as date) as d, arg_min(value, (ts, event_id)) filter (event_id % 7 <> 0) as first_value, count(*) as n from events group by all""",
)
def a23(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    order = F.when(F.col("value").isNotNull(), F.struct("ts", "event_id"))
    return ev.groupBy("event_type", day(F.col("ts")).alias("d")).agg(F.min_by("value", order).alias("first_value"), F.count("*").alias("n"))


@query(
    "a24_mean_gap",
    """with g as (select o_custkey, datediff('day', lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey), o_orderdate) as gap from orders),
m as (select o_custkey, avg(gap) as g from g group by 1) select round(avg(g), 6) as mean_gap, count(g) as customers from m""",
)
def a24(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Gaps between successive dates add up to the last minus the first, so no ordering is needed.
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).alias("span"), F.count("*").alias("n"))
    gap = F.when(F.col("n") > 1, F.col("span") / (F.col("n") - 1))
    return per.agg(F.round(F.avg(gap), 6).alias("mean_gap"), F.count(gap).alias("customers"))


@query("a25_multi_period_share", "with y as (select o_custkey, count(distinct year(o_orderdate)) as y from orders group by 1) select round(avg((y > 1)::int), 6) as share, count(*) as customers from y")
def a25(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.year(F.max("o_orderdate")) > F.year(F.min("o_orderdate"))).alias("several"))
    return per.agg(F.round(F.avg(F.col("several").cast("int")), 6).alias("share"), F.count("*").alias("customers"))


@query("a26_mean_of_counts", "with c as (select o_custkey, count(distinct o_orderkey) as n from orders group by 1) select round(avg(n), 6) as mean_orders, max(n) as most from c")
def a26(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("n"))
    return per.agg(F.round(F.avg("n"), 6).alias("mean_orders"), F.max("n").alias("most"))


@query(
    "a27_one_time_buyers",
    """with one as (select o_custkey from orders where o_orderdate >= timestamp '2001-01-01' group by 1 having count(distinct o_orderkey) = 1)
select p_brand as brand, count(*) as n from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
where o_custkey in (select o_custkey from one) group by all order by n desc, brand limit 10""",
)
def a27(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    one = orders.where("o_orderdate >= timestamp_ntz'2001-01-01'").groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("n")).where("n = 1")
    theirs = rows_of(orders, one, ["o_custkey"]).select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey").join(theirs, "o_orderkey")
    per_part = lines.groupBy("l_partkey").agg(F.count("*").alias("c"))
    brands = attach(per_part, table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand"), "l_partkey", "p_partkey", ["brand"], "inner")
    return top_k(brands.groupBy("brand").agg(F.sum("c").alias("n")), 10, [F.col("n").desc()], ["brand"])


RFM_SQL = """rfm as (select o_custkey, max(o_orderdate) as last_order,
  datediff('day', max(o_orderdate), (select max(o_orderdate) + interval 1 day from orders))::int as recency,
  count(distinct o_orderkey) as frequency, round(sum(o_totalprice), 2) as monetary from orders group by 1)"""


@query("a28_rfm", f"with {RFM_SQL} select * from rfm")
def a28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")


@query(
    "a29_rfm_line_revenue",
    """with s as (select * from lineitem join orders on l_orderkey = o_orderkey where l_quantity > 0 and l_extendedprice > 0 and l_returnflag <> 'R')
select o_custkey, max(o_orderdate) as last_order, datediff('day', max(o_orderdate), (select max(o_orderdate) + interval 1 day from s))::int as recency,
count(distinct o_orderkey) as frequency, round(sum(l_extendedprice * l_quantity), 2) as monetary from s group by 1""",
)
def a29(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = table(spark, sf_dir, "lineitem").where("l_quantity > 0 and l_extendedprice > 0 and l_returnflag <> 'R'")
    per_order = sold.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice") * F.col("l_quantity")).alias("revenue"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return rfm(per_order.join(orders, "o_orderkey"), "o_custkey", "o_orderdate", "o_orderkey", "revenue")


@query(
    "a30_volume_tiers",
    f"""with {DAILY}, m as (select brand, avg(sales) as mean_sales from daily group by 1),
q as (select quantile_cont(mean_sales, 0.33) as lo, quantile_cont(mean_sales, 0.66) as hi from m)
select brand, round(mean_sales, 4) as mean_sales, case when mean_sales <= lo then 'low' when mean_sales <= hi then 'mid' else 'high' end as tier from m, q""",
)
def a30(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = materialise(brand_days(spark, sf_dir).groupBy("brand").agg(F.avg("sales").alias("mean_sales")), "means")
    q = quantile_scalars(means, ["mean_sales"], [0.33, 0.66], stored=True).getField("mean_sales_q")
    tier = F.when(F.col("mean_sales") <= q[0], "low").when(F.col("mean_sales") <= q[1], "mid").otherwise("high")
    return means.select("brand", F.round("mean_sales", 4).alias("mean_sales"), tier.alias("tier"))


@query(
    "a31_head_tail_share",
    """with c as (select o_custkey, count(*) as n from orders group by 1)
select round(avg((n > 10)::int), 6) as head, round(avg((n <= 10)::int), 6) as tail, count(*) filter (n = 1) as singles, count(*) as keys from c""",
)
def a31(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    big = (F.col("n") > 10).cast("int")
    return per.agg(F.round(F.avg(big), 6).alias("head"), F.round(F.avg(1 - big), 6).alias("tail"), F.count_if(F.col("n") == 1).alias("singles"), F.count("*").alias("keys"))


@query(
    "a32_class_balance",
    """select toxic, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share,
round((select count(*) from labels where toxic = 0) / count(*), 6) as weight from labels group by all""",
)
def a32(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    base = labels.agg(F.count_if(F.col("toxic") == 0).alias("v")).scalar()
    return value_counts(labels, "toxic").select("toxic", "n", F.round("share", 6).alias("share"), F.round(base / F.col("n"), 6).alias("weight"))


@query(
    "a33_data_drift",
    """with e as (select case when ts < timestamp '2024-01-08' then 'base' when ts >= timestamp '2024-01-22' and ts < timestamp '2024-01-29' then 'now' end as w,
  value, (props->>'k')::double as k from events),
m as (select 'value' as metric, avg(value) filter (w = 'base') as mb, avg(value) filter (w = 'now') as mn, stddev_samp(value) filter (w = 'base') as sb, stddev_samp(value) filter (w = 'now') as sn from e
  union all select 'k', avg(k) filter (w = 'base'), avg(k) filter (w = 'now'), stddev_samp(k) filter (w = 'base'), stddev_samp(k) filter (w = 'now') from e)
select metric, round(mb, 6) as mean_base, round(mn, 6) as mean_now, round(abs(mn - mb) / abs(mb), 6) as mean_shift, round(abs(sn - sb) / sb, 6) as std_shift,
  (abs(mn - mb) / abs(mb) > 0.1 or abs(sn - sb) / sb > 0.1) as drifted from m""",
)
def a33(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").where("ts < timestamp_ntz'2024-01-08' or (ts >= timestamp_ntz'2024-01-22' and ts < timestamp_ntz'2024-01-29')")
    ev = ev.select((F.col("ts") < F.expr("timestamp_ntz'2024-01-08'")).alias("base"), "value", F.get_json_object("props", "$.k").try_cast("double").alias("k"))
    long = ev.select("base", F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("x")) for c in ("value", "k")])))
    m = long.groupBy("metric").agg(
        *[f(F.when(F.col("base") == side, F.col("x"))).alias(n + t) for side, t in ((True, "b"), (False, "n")) for f, n in ((F.avg, "m"), (F.stddev_samp, "s"))]
    )
    mean_shift = F.abs(F.col("mn") - F.col("mb")) / F.abs("mb")
    std_shift = F.abs(F.col("sn") - F.col("sb")) / F.col("sb")
    return m.select(
        "metric", F.round("mb", 6).alias("mean_base"), F.round("mn", 6).alias("mean_now"), F.round(mean_shift, 6).alias("mean_shift"),
        F.round(std_shift, 6).alias("std_shift"), ((mean_shift > 0.1) | (std_shift > 0.1)).alias("drifted"),
    )


DIMS = ("event_type", "hour_of_day", "day_of_week", "is_rush_hour", "is_holiday", "is_weekend")


@query(
    "a34_error_by_dimension",
    f"with {ERRORS} " + " union all ".join(f"select '{d}' as dimension, {d}::varchar as level, round(avg(abs_error), 6) as mae, count(*) as n from err group by {d}" for d in DIMS),
)
def a34(spark: SparkSession, sf_dir: str) -> DataFrame:
    err = baseline_errors(spark, sf_dir)
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("level")) for d in DIMS])
    return err.select("abs_error", F.inline(cells)).groupBy("dimension", "level").agg(F.round(F.avg("abs_error"), 6).alias("mae"), F.count("*").alias("n"))


@query(
    "a35_worst_best_days",
    f"""with {ERRORS}, d as (select cast(hr as date) as d, round(avg(abs_error), 6) as mae from err group by 1)
(select 'worst' as side, d, mae from d order by mae desc, d limit 10) union all (select 'best', d, mae from d order by mae, d limit 10)""",
)
def a35(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = baseline_errors(spark, sf_dir).groupBy(day(F.col("hr")).alias("d")).agg(F.round(F.avg("abs_error"), 6).alias("mae"))
    worst = top_k(per, 10, [F.col("mae").desc()], ["d"]).select(F.lit("worst").alias("side"), "d", "mae")
    best = top_k(per, 10, [F.col("mae").asc()], ["d"]).select(F.lit("best").alias("side"), "d", "mae")
    return worst.unionByName(best)


@query(
    "a35_worst_best_zones",
    f"""with {ERRORS}, z as (select event_type, round(avg(abs_error), 6) as mae, round(avg(signed), 6) as bias, count(*) as n from err group by 1)
(select 'worst' as side, * from z order by mae desc, event_type limit 2) union all (select 'best', * from z order by mae, event_type limit 2)""",
)
def a35_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones forecast worst and best, with the sign of their error; the event type stands for the zone."""
    errors = [F.round(F.avg("abs_error"), 6).alias("mae"), F.round(F.avg("signed"), 6).alias("bias"), F.count("*").alias("n")]
    per = materialise(baseline_errors(spark, sf_dir).groupBy("event_type").agg(*errors), "zones")
    worst = top_k(per, 2, [F.col("mae").desc()], ["event_type"]).select(F.lit("worst").alias("side"), *per.columns)
    best = top_k(per, 2, [F.col("mae").asc()], ["event_type"]).select(F.lit("best").alias("side"), *per.columns)
    return worst.unionByName(best)


@query("a36_bias", f"with {ERRORS} select event_type, round(avg(signed), 6) as mean_signed, round(quantile_cont(signed::double, 0.5), 6) as median_signed from err group by all")
def a36(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One key's errors are at most one per calendar hour.
    return baseline_errors(spark, sf_dir).groupBy("event_type").agg(
        F.round(F.avg("signed"), 6).alias("mean_signed"), F.round(F.percentile(F.col("signed").cast("double"), F.lit(0.5)), 6).alias("median_signed")
    )


@query(
    "a37_online_error_alarm",
    f"""with {ERRORS}, o as (select avg(abs_error) as offline from err where hr < timestamp '2024-01-15'),
h as (select hr, avg(abs_error) as mae from err where hr >= timestamp '2024-01-15' group by 1)
select hr, round(mae, 6) as mae, mae > 1.2 * offline as alarm from h, o""",
)
def a37(spark: SparkSession, sf_dir: str) -> DataFrame:
    err = baseline_errors(spark, sf_dir)
    cut = F.expr("timestamp_ntz'2024-01-15'")
    offline = err.where(F.col("hr") < cut).agg(F.avg("abs_error").alias("v")).scalar()
    per = err.where(F.col("hr") >= cut).groupBy("hr").agg(F.avg("abs_error").alias("m"))
    return per.select("hr", F.round("m", 6).alias("mae"), (F.col("m") > 1.2 * offline).alias("alarm"))


@query(
    "a38_quarter_year_totals",
    """with q as (select last_day(date_trunc('quarter', o_orderdate) + interval 2 month)::date as period_end, sum(o_totalprice) as s, count(*) as c from orders where o_orderpriority = '5-LOW' group by 1),
cal as (select unnest(generate_series((select date_trunc('quarter', min(period_end)) from q), (select max(period_end) from q), interval 3 month)) as x),
dense as (select last_day(x + interval 2 month)::date as period_end, coalesce(s, 0) as s, coalesce(c, 0) as c from cal left join q on q.period_end = last_day(x + interval 2 month)::date)
select 'quarter' as level, period_end, round(s, 2) as total, c::bigint as n from dense
union all select 'year', make_date(year(period_end), 12, 31), round(sum(s), 2), sum(c)::bigint from dense group by year(period_end)""",
)
def a38_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter and year sums; empty quarters between the first and the last are 0, and years add up from the quarters."""
    low = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "5-LOW")
    quarter = F.trunc("o_orderdate", "quarter").alias("q")
    per = materialise(low.groupBy(quarter).agg(F.sum("o_totalprice").alias("total"), F.count("*").alias("n")), "quarters")
    cal = per.agg(F.min("q").alias("lo"), F.max("q").alias("hi")).select(F.explode(F.sequence("lo", "hi", F.expr("interval 3 month"))).alias("q"))
    dense = cal.join(per, "q", "left").fillna({"total": 0.0, "n": 0})
    ends = F.array(F.struct(F.lit("quarter").alias("level"), F.last_day(F.add_months("q", 2)).alias("period_end")), F.struct(F.lit("year").alias("level"), F.make_date(F.year("q"), F.lit(12), F.lit(31)).alias("period_end")))
    return dense.select("total", "n", F.inline(ends)).groupBy("level", "period_end").agg(F.round(F.sum("total"), 2).alias("total"), F.sum("n").alias("n"))


@query(
    "a38_calendar_totals",
    """with m as (select last_day(o_orderdate) as month_end, sum(o_totalprice) as s, count(*) as c from orders where o_orderpriority = '5-LOW' group by 1),
cal as (select unnest(generate_series((select date_trunc('month', min(month_end)) from m), (select max(month_end) from m), interval 1 month)) as x)
select last_day(x)::date as month_end, year(x)::int as year, last_day(date_trunc('quarter', x) + interval 2 month)::date as quarter_end, round(coalesce(s, 0), 2) as total, coalesce(c, 0)::bigint as n
from cal left join m on m.month_end = last_day(x)""",
)
def a38(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "5-LOW")
    per = low.groupBy(F.last_day("o_orderdate").alias("month_end")).agg(F.sum("o_totalprice").alias("total"), F.count("*").alias("n"))
    span = low.agg(F.trunc(F.min("o_orderdate"), "month").alias("lo"), F.trunc(F.max("o_orderdate"), "month").alias("hi"))
    cal = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("x")).select(F.last_day("x").alias("month_end"))
    quarter_end = F.last_day(F.add_months(F.trunc("month_end", "quarter"), 2))
    return cal.join(per, "month_end", "left").fillna({"total": 0.0, "n": 0}).select(
        "month_end", F.year("month_end").alias("year"), quarter_end.alias("quarter_end"), F.round("total", 2).alias("total"), "n"
    )


@query(
    "a39_time_profile",
    """with e as (select hour(ts)::int as h, (isodow(ts) - 1)::int as w, (isodow(ts) >= 6)::int as we from events where year(ts) = 2024), t as (select count(*) as t from e)
select 'hour' as part, h as level, round(100.0::double * count(*) / any_value(t), 6) as percent from e, t group by h
union all select 'weekday', w, round(100.0::double * count(*) / any_value(t), 6) from e, t group by w
union all select 'weekend', we, round(100.0::double * count(*) / any_value(t), 6) from e, t group by we""",
)
def a39(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").where("ts >= timestamp_ntz'2024-01-01' and ts < timestamp_ntz'2025-01-01'").select("ts")
    # One pass to 168 hour-of-week counts; every profile is a sum of those.
    base = ev.groupBy(F.hour("ts").alias("h"), F.weekday("ts").alias("w")).agg(F.count("*").alias("c"))
    total = ev.agg(F.count("*").alias("t")).scalar()
    cells = F.array(
        F.struct(F.lit("hour").alias("part"), F.col("h").alias("level")),
        F.struct(F.lit("weekday").alias("part"), F.col("w").alias("level")),
        F.struct(F.lit("weekend").alias("part"), (F.col("w") >= 5).cast("int").alias("level")),
    )
    return base.select("c", F.inline(cells)).groupBy("part", "level").agg(F.round(100.0 * F.sum("c") / total, 6).alias("percent"))


@query(
    "a40_segment_profile",
    f"""with {RFM_SQL}, q as (select quantile_cont(monetary, 0.33) as lo, quantile_cont(monetary, 0.66) as hi from rfm)
select case when monetary <= lo then 'low' when monetary <= hi then 'mid' else 'high' end as tier, count(*) as n, round(avg(recency), 4) as recency,
round(avg(frequency), 4) as frequency, round(avg(monetary), 4) as monetary from rfm, q group by 1""",
)
def a40(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = materialise(a28(spark, sf_dir), "rfm")
    q = quantile_scalars(r, ["monetary"], [0.33, 0.66], stored=True).getField("monetary_q")
    tier = F.when(F.col("monetary") <= q[0], "low").when(F.col("monetary") <= q[1], "mid").otherwise("high")
    return r.withColumn("tier", tier).groupBy("tier").agg(F.count("*").alias("n"), *[F.round(F.avg(c), 4).alias(c) for c in ("recency", "frequency", "monetary")])


@query(
    "a41_cost_benefit",
    """with s as (select l.toxic as label, (n_chars % 7 = 0)::int as pred from labels l join documents d using (doc_id)),
c as (select count(*) filter (label = 1 and pred = 1) as tp, count(*) filter (label = 0 and pred = 1) as fp, count(*) filter (label = 1 and pred = 0) as fn from s)
select tp, fp, fn, (tp * 5000 - fp * 500 - fn * 2000)::bigint as net_value from c""",
)
def a41(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    scored = table(spark, sf_dir, "labels").join(docs, "doc_id").select(F.col("toxic").alias("label"), (F.col("n_chars") % 7 == 0).cast("int").alias("pred"))
    c = binary_counts(scored, F.col("label"), F.col("pred"))
    return c.select("tp", "fp", "fn", (F.col("tp") * 5000 - F.col("fp") * 500 - F.col("fn") * 2000).alias("net_value"))
