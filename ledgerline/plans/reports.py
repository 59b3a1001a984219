"""Star-schema reports Q-01 .. Q-12.

Roles: posting = order, company = customer, skill = part brand, the skill bridge = distinct (order, brand).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.relational import attach, cooccurring_pairs, item_blocks, top_k
from ledgerline.registry import query
from ledgerline.tables import table

BRIDGE = """bridge as (
  select distinct l_orderkey as o_orderkey, p_brand as brand
  from lineitem join part on l_partkey = p_partkey
)"""


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return attach(lines, table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand"), "l_partkey", "p_partkey", ["brand"], "inner").select("o_orderkey", "brand").distinct()


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def wanted(df: DataFrame) -> DataFrame:
    """Postings of one title with a stated salary."""
    return df.where(F.col("o_orderpriority") == "1-URGENT").where(F.col("o_totalprice").isNotNull())


TOP_SQL = """select o_orderkey, o_orderpriority, o_orderdate, o_totalprice, c_name as customer_name
from orders left join customer on o_custkey = c_custkey
where o_orderpriority like '%URGENT%' and o_orderstatus like '%O%' and o_totalprice is not null
order by o_totalprice desc, o_orderkey"""


def top_orders(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """The cut comes first, so the name lookup touches k rows only."""
    facts = orders(spark, sf_dir).where(
        F.col("o_orderpriority").like("%URGENT%") & F.col("o_orderstatus").like("%O%") & F.col("o_totalprice").isNotNull()
    ).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    cut = top_k(facts, k, [F.col("o_totalprice").desc_nulls_last()], ["o_orderkey"])
    names = table(spark, sf_dir, "customer").withColumnRenamed("c_name", "customer_name")
    return attach(cut, names, "o_custkey", "c_custkey", ["customer_name"]).drop("o_custkey")


@query("q01_top_paying", TOP_SQL + " limit 30")
def q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_orders(spark, sf_dir, 30)


@query(
    "q02_top_paying_skills",
    f"""with top as ({TOP_SQL} limit 1000), {BRIDGE}
select brand, count(*) as frequency, ((200 * sum(round(o_totalprice * 100)::bigint) + count(*)) // (2 * count(*)))::double / 10000 as mean_price
from top join bridge using (o_orderkey) group by brand""",
)
def q02(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_orders(spark, sf_dir, 1000).select("o_orderkey", "o_totalprice")
    # 1000 rows by construction. The lines of those orders are found before the brand is looked up.
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    found = lines.join(F.broadcast(top), "o_orderkey")
    brands = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand")
    pairs = attach(found, brands, "l_partkey", "p_partkey", ["brand"], "inner").select("o_orderkey", "o_totalprice", "brand").distinct()
    # Money adds up in whole cents and is rounded once, so the order of the rows cannot show.
    mean = F.expr("cast((200 * sum(cast(round(o_totalprice * 100) as bigint)) + count(*)) div (2 * count(*)) as double) / 10000")
    return pairs.groupBy("brand").agg(F.count("*").alias("frequency"), mean.alias("mean_price"))


def wanted_brands(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Distinct (order, brand) of the wanted postings: lines are cut to those orders before the brand lookup."""
    pay = wanted(orders(spark, sf_dir)).select("o_orderkey", *cols)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey").join(pay, "o_orderkey")
    brands = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand")
    return attach(lines, brands, "l_partkey", "p_partkey", ["brand"], "inner").select("o_orderkey", *cols, "brand").distinct()


def skill_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wanted_brands(spark, sf_dir, "o_totalprice").groupBy("brand").agg(
        F.count("*").alias("demand_count"), F.round(F.avg("o_totalprice"), 0).alias("avg_price")
    )


SKILL_PAY_SQL = f"""with {BRIDGE}, pay as (
  select brand, count(*) as demand_count, round(avg(o_totalprice), 0) as avg_price
  from orders join bridge using (o_orderkey)
  where o_orderpriority = '1-URGENT' and o_totalprice is not null group by brand)"""


@query("q03_most_demanded", f"{SKILL_PAY_SQL} select brand, demand_count from pay order by demand_count desc, brand limit 10")
def q03(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand = skill_pay(spark, sf_dir).select("brand", "demand_count")
    return top_k(demand, 10, [F.col("demand_count").desc()], ["brand"])


@query("q04_best_paid", f"{SKILL_PAY_SQL} select brand, avg_price from pay order by avg_price desc, brand limit 20")
def q04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(skill_pay(spark, sf_dir).select("brand", "avg_price"), 20, [F.col("avg_price").desc()], ["brand"])


@query(
    "q05_optimal_skills",
    f"{SKILL_PAY_SQL} select * from pay where demand_count > 10 order by avg_price desc, demand_count desc, brand limit 20",
)
def q05(spark: SparkSession, sf_dir: str) -> DataFrame:
    often = skill_pay(spark, sf_dir).where(F.col("demand_count") > 10)
    return top_k(often, 20, [F.col("avg_price").desc(), F.col("demand_count").desc()], ["brand"])


@query(
    "q06_best_companies",
    """select c_name as customer_name, count(o_orderkey) as num_orders, round(avg(o_totalprice), 0) as avg_price
from orders join customer on o_custkey = c_custkey
where o_orderpriority = '1-URGENT' and o_totalprice is not null
group by c_name having count(o_orderkey) >= 3 order by avg_price desc, customer_name limit 15""",
)
def q06(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Sums per key first: the join then sees one row per customer, however hot a customer is.
    per = wanted(orders(spark, sf_dir)).groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("s")
    )
    named = attach(per, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", ["c_name"], "inner")
    pay = named.groupBy(F.col("c_name").alias("customer_name")).agg(
        F.sum("n").alias("num_orders"), F.round(F.sum("s") / F.sum("n"), 0).alias("avg_price")
    ).where(F.col("num_orders") >= 3)
    return top_k(pay, 15, [F.col("avg_price").desc()], ["customer_name"])


def pay_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n_orders"), F.round(F.avg("o_totalprice"), 0).alias("avg_price"))


def pay_by_sql(key: str, where: str) -> str:
    return f"select {key}, count(*) as n_orders, round(avg(o_totalprice), 0) as avg_price from orders where {where} group by all"


@query("q07_pay_by_schedule", pay_by_sql("o_orderpriority", "o_orderstatus = 'O' and o_totalprice is not null"))
def q07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay_by(orders(spark, sf_dir).where((F.col("o_orderstatus") == "O") & F.col("o_totalprice").isNotNull()), "o_orderpriority")


@query(
    "q08_best_locations",
    """select n_name, count(*) as n_orders, round(avg(o_totalprice), 0) as avg_price
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
where o_orderpriority = '1-URGENT' and o_totalprice is not null and n_name like 'NATION_1%'
group by n_name having count(*) >= 5 order by avg_price desc, n_name limit 15""",
)
def q08(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = wanted(orders(spark, sf_dir)).groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    place = attach(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        table(spark, sf_dir, "nation").where(F.col("n_name").like("NATION_1%")),
        "c_nationkey", "n_nationkey", ["n_name"], "inner",
    )
    pay = attach(per, place, "o_custkey", "c_custkey", ["n_name"], "inner").groupBy("n_name").agg(
        F.sum("n").alias("n_orders"), F.round(F.sum("s") / F.sum("n"), 0).alias("avg_price")
    ).where(F.col("n_orders") >= 5)
    return top_k(pay, 15, [F.col("avg_price").desc()], ["n_name"])


@query("q09_degree_impact", pay_by_sql("o_orderstatus", "o_orderpriority = '1-URGENT' and o_totalprice is not null"))
def q09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay_by(wanted(orders(spark, sf_dir)), "o_orderstatus")


@query(
    "q10_benefits_impact",
    """select c_acctbal >= 0 as in_credit, count(*) as n_orders, round(avg(o_totalprice), 0) as avg_price
from orders join customer on o_custkey = c_custkey
where o_orderpriority = '1-URGENT' and o_totalprice is not null group by all""",
)
def q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = wanted(orders(spark, sf_dir)).groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    credit = table(spark, sf_dir, "customer").withColumn("in_credit", F.col("c_acctbal") >= 0)
    return attach(per, credit, "o_custkey", "c_custkey", ["in_credit"], "inner").groupBy("in_credit").agg(
        F.sum("n").alias("n_orders"), F.round(F.sum("s") / F.sum("n"), 0).alias("avg_price")
    )


@query(
    "q11_skill_pairs",
    f"""with {BRIDGE}, mine as (
  select b.* from bridge b join orders using (o_orderkey) where o_orderpriority = '1-URGENT' and o_totalprice is not null)
select a.brand as skill_a, b.brand as skill_b, count(*) as pair_count
from mine a join mine b on a.o_orderkey = b.o_orderkey and a.brand < b.brand
group by all having count(*) >= 5 order by pair_count desc, skill_a, skill_b limit 15""",
)
def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = item_blocks(table(spark, sf_dir, "part"), "p_brand")
    pairs = cooccurring_pairs(wanted_brands(spark, sf_dir), "o_orderkey", "brand", blocks, least_support=5)
    named = pairs.select(F.col("item_a").alias("skill_a"), F.col("item_b").alias("skill_b"), "pair_count")
    return top_k(named, 15, [F.col("pair_count").desc()], ["skill_a", "skill_b"])


@query(
    "q12_monthly_view",
    """select o_orderkey, o_orderdate, o_totalprice, n_name from orders join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey where month(o_orderdate) = 7 and n_name = 'NATION_7'""",
)
def q12(spark: SparkSession, sf_dir: str) -> DataFrame:
    july = orders(spark, sf_dir).where(F.month("o_orderdate") == 7)
    place = attach(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        table(spark, sf_dir, "nation").where(F.col("n_name") == "NATION_7"),
        "c_nationkey", "n_nationkey", ["n_name"], "inner",
    )
    return attach(july, place, "o_custkey", "c_custkey", ["n_name"], "inner").select("o_orderkey", "o_orderdate", "o_totalprice", "n_name")
