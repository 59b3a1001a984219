"""Projections, cleaning and predicates PR-01 .. PR-28."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import flag, parse_money, recode, right_closed
from ledgerline.operators import cleaning as C
from ledgerline.operators.relational import attach, oldest
from ledgerline.plans.aggregates import RFM_SQL, a28
from ledgerline.plans.common import DAILY, brand_days
from ledgerline.registry import query
from ledgerline.tables import materialise, table

# Nulls are injected the same way on both sides: the tables hold none.
HOLES = "holes as (select event_id, ts, user_id, event_type, case when event_id % 7 <> 0 then value end as value, case when event_id % 5 <> 0 then user_id end as visitor from events)"


def holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("visitor"),
    )


@query("pr01_keep_rename", "select p_partkey as id, p_name as name, p_size from part")
def pr01(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "part").drop("p_retailprice", "p_brand", "p_type")
    return kept.withColumnsRenamed({"p_partkey": "id", "p_name": "name"}).select("id", "name", "p_size")


@query("pr02_snake_case", "select s_suppkey as supplier_key, s_name as full_name, s_acctbal as account_balance from supplier")
def pr02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.snake_case(table(spark, sf_dir, "supplier").drop("s_nationkey").toDF("Supplier Key", "Full-Name", "Account Balance"))


@query(
    "pr03_coerce",
    """select event_id, try_cast(json_extract_string(props, '$.k') as int) as k, try_cast(event_type as double) as bad_number,
try_cast(case when event_id % 3 = 0 then 'n/a' else ts::varchar end as timestamp) as seen from events""",
)
def pr03(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("bad_number"),
        F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise(F.col("ts").cast("string")).alias("seen"),
    )
    return C.coerce(raw, {"k": "int", "bad_number": "double", "seen": "timestamp_ntz"})


@query("pr04_parse_money", "select c_custkey, round(c_acctbal, 2) as balance from customer")
def pr04(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("$"), F.format_number("c_acctbal", 2))
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("t")).select("c_custkey", F.round(parse_money(F.col("t")), 2).alias("balance"))


@query(
    "pr05_null_profile",
    f"with {HOLES} " + " union all ".join(
        f"select '{c}' as \"column\", '{t}' as type, count(*) filter ({c} is null) as nulls, round(100.0::double * count(*) filter ({c} is null) / count(*), 6) as percent from holes"
        for c, t in (("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("visitor", "bigint"))
    ),
)
def pr05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.null_profile(holes(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


@query("pr06_drop_all_null", f"with {HOLES} select * from holes")
def pr06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_all_null(holes(spark, sf_dir).withColumn("empty", F.lit(None).cast("double")))


@query("pr07_drop_null", f"with {HOLES} select * from holes where value is not null and visitor is not null")
def pr07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holes(spark, sf_dir).na.drop(subset=["value", "visitor"])


@query(
    "pr08_impute",
    f"""with {HOLES}, m as (select quantile_cont(value, 0.5) as med, avg(visitor) as mean from holes)
select event_id, round(coalesce(value, med), 6) as value, round(coalesce(visitor::double, mean), 6) as visitor from holes, m""",
)
def pr08(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = holes(spark, sf_dir).withColumn("visitor", F.col("visitor").cast("double"))
    return C.impute(df, {"value": "median", "visitor": "mean"}).select("event_id", F.round("value", 6).alias("value"), F.round("visitor", 6).alias("visitor"))


@query("pr09_invalidate", "select c_custkey, case when c_acctbal < 1000 then null else c_acctbal end as c_acctbal from customer")
def pr09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.invalidate(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), {"c_acctbal": F.col("c_acctbal") < 1000})


@query(
    "pr10_map_values",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 100 when '2-HIGH' then 75 when '3-MEDIUM' then 50 else 25 end as level,
case n_regionkey when 0 then 'south' when 1 then 'west' else 'other' end as area from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
)
def pr10(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = attach(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", ["n_regionkey"], "inner")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return attach(orders, place, "o_custkey", "c_custkey", ["n_regionkey"], "inner").select(
        "o_orderkey",
        recode(F.col("o_orderpriority"), {"1-URGENT": 100, "2-HIGH": 75, "3-MEDIUM": 50}, 25).alias("level"),
        recode(F.col("n_regionkey"), {0: "south", 1: "west"}, "other").alias("area"),
    )


@query("pr11_valid_range", "select l_orderkey, l_linenumber, l_quantity, l_discount, l_extendedprice from lineitem where l_quantity between 5 and 45 and l_discount between 0 and 0.07")
def pr11(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")
    return C.valid_range(lines, {"l_quantity": (5, 45), "l_discount": (0, 0.07)})


@query(
    "pr12_in_set",
    """with z as (select n_nationkey from nation where n_regionkey = 2)
select l_orderkey, l_linenumber, l_extendedprice, c_nationkey, s_nationkey from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
where c_nationkey in (select * from z) or s_nationkey in (select * from z)""",
)
def pr12(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The wanted keys come from a dimension; each side gets its flag from its own small join.
    wanted = table(spark, sf_dir, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("k"), F.lit(True).alias("hit"))

    def flagged(df, key, name):
        return df.join(wanted, F.col(key) == F.col("k"), "left").withColumn(name, F.coalesce("hit", F.lit(False))).drop("k", "hit")

    buyers = flagged(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "_c")
    sellers = flagged(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey", "_s")
    orders = attach(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), buyers, "o_custkey", "c_custkey", ["c_nationkey", "_c"], "inner")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    both = attach(attach(lines, sellers, "l_suppkey", "s_suppkey", ["s_nationkey", "_s"], "inner"), orders, "l_orderkey", "o_orderkey", ["c_nationkey", "_c"], "inner")
    return both.where(F.col("_c") | F.col("_s")).select("l_orderkey", "l_linenumber", "l_extendedprice", "c_nationkey", "s_nationkey")


@query("pr13_matches", "select p_partkey, p_name, p_name like '%ring%' as has_ring, starts_with(p_name, 'small') as small, regexp_matches(p_name, '^[a-m].*t$') as a_to_t from part where not regexp_matches(p_name, '^x') and contains(p_name, ' ')")
def pr13(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_name")
    return table(spark, sf_dir, "part").where(~n.rlike("^x") & n.contains(" ")).select(
        "p_partkey", "p_name", n.like("%ring%").alias("has_ring"), n.startswith("small").alias("small"), n.rlike("^[a-m].*t$").alias("a_to_t")
    )


@query("pr14_dedupe_rows", "select distinct l_orderkey, l_linenumber, l_partkey from lineitem")
def pr14(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.unionByName(lines).dropDuplicates()


@query("pr14_dedupe_keep_first", "select event_type, user_id, event_id, ts, value from events qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1")
def pr14_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id", "ts", "value")
    return oldest(ev, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "pr15_duplicate_report",
    """with c as (select count(*) as n from lineitem group by l_orderkey, l_linenumber)
select count(*) filter (n > 1) as repeated_keys, sum(n - 1)::bigint as surplus_rows, count(*) as distinct_keys from c""",
)
def pr15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.duplicate_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "pr16_validate",
    """with c as (select *, case when c_custkey % 11 = 0 then null else c_acctbal end as balance from customer),
v as (select count(*) filter (balance is null) as present, count(*) filter (balance is null or balance < 0) as non_negative,
 count(*) filter (c_mktsegment not in ('BUILDING', 'MACHINERY')) as in_set, count(*) filter (c_name not like 'Customer#%') as named from c)
unpivot v on columns(*) into name rule value violations""",
)
def pr16(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("balance", F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal")))
    return C.validate(
        C.require(c, ["c_custkey", "balance", "c_mktsegment", "c_name"]),
        {
            "present": F.col("balance").isNotNull(),
            "non_negative": F.col("balance") >= 0,
            "in_set": F.col("c_mktsegment").isin("BUILDING", "MACHINERY"),
            "named": F.col("c_name").like("Customer#%"),
        },
    )


@query("pr17_rule_violations", "select l_orderkey, l_linenumber, l_shipdate, o_orderdate from lineitem join orders on l_orderkey = o_orderkey where not (l_shipdate >= o_orderdate)")
def pr17(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return lines.join(orders, "l_orderkey").where(~(F.col("l_shipdate") >= F.col("o_orderdate")))


@query("pr18_sample")
def pr18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").sample(0.1, seed=42)


@query("pr18_sample_by_hash", "select o_orderkey, o_totalprice from orders where substr(md5(o_orderkey::varchar), 1, 4) < '199a'")
def pr18_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A tenth of the 16-bit hash range: the same rows are drawn wherever and whenever this runs.
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").where(
        F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 4) < "199a"
    )


@query("pr19_flags", "select event_id, (value > 10)::int as large, (event_type = 'error')::int as failed, (isodow(ts) >= 6)::int as weekend from events")
def pr19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", flag(F.col("value") > 10).alias("large"), flag(F.col("event_type") == "error").alias("failed"), flag(F.weekday("ts") >= 5).alias("weekend")
    )


FENCE = "select quantile_cont({c}, 0.25) - {k} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) as lo, quantile_cont({c}, 0.75) + {k} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) as hi from {t}"


@query("pr20_clip_iqr", f"with f as ({FENCE.format(c='o_totalprice', k='0.5::double', t='orders')}) select o_orderkey, round(least(greatest(o_totalprice, lo), hi), 6) as o_totalprice from orders, f")
def pr20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clip_iqr(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 0.5, stored=True).withColumn("o_totalprice", F.round("o_totalprice", 6))


@query(
    "pr21_drop_iqr_outliers",
    f"with {RFM_SQL}, a as ({FENCE.format(c='frequency', k='1.5::double', t='rfm')}), b as ({FENCE.format(c='monetary', k='1.5::double', t='rfm')}) select rfm.* from rfm, a, b where frequency between a.lo and a.hi and monetary between b.lo and b.hi",
)
def pr21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_iqr_outliers(materialise(a28(spark, sf_dir), "rfm"), ["frequency", "monetary"], stored=True)


LABELLED = f"""{RFM_SQL}, a as ({FENCE.format(c='frequency', k='1.5::double', t='rfm')}), b as ({FENCE.format(c='monetary', k='1.5::double', t='rfm')}),
flags as (select rfm.*, not (frequency between a.lo and a.hi) as fo, not (monetary between b.lo and b.hi) as mo from rfm, a, b),
labelled as (select * exclude (fo, mo), (case when fo and mo then -3 when fo then -2 when mo then -1 else 0 end)::int as outlier from flags)"""


@query("pr22_label_iqr_outliers", f"with {LABELLED} select o_custkey, frequency, monetary, outlier from labelled")
def pr22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.label_iqr_outliers(materialise(a28(spark, sf_dir), "rfm"), "frequency", "monetary", stored=True).select("o_custkey", "frequency", "monetary", "outlier")


@query(
    "pr23_drop_zscore",
    f"""with {DAILY}, s as (select brand, avg(sales) as m, stddev_pop(sales) as sd from daily group by 1)
select brand, d, sales from daily join s using (brand) where abs((sales - m) / sd) <= 2""",
)
def pr23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_zscore(brand_days(spark, sf_dir), "sales", 2.0, ["brand"]).select("brand", "d", "sales")


@query("pr24_bucketize", "select p_partkey, p_size, case when p_size <= 0 then null when p_size <= 10 then 'small' when p_size <= 30 then 'mid' when p_size <= 100 then 'big' end as size_group from part")
def pr24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", right_closed(F.col("p_size"), [0, 10, 30, 100], ["small", "mid", "big"]).alias("size_group"))


@query(
    "pr25_retention",
    """with s as (select count(*) as start, count(*) filter (l_quantity > 0) as positive, count(*) filter (l_quantity > 0 and l_discount <= 0.08) as discount,
  count(*) filter (l_quantity > 0 and l_discount <= 0.08 and l_returnflag <> 'R') as kept_sale from lineitem),
u as (unpivot s on columns(*) into name step value rows)
select case step when 'start' then 0 when 'positive' then 1 when 'discount' then 2 else 3 end::int as step_no, step, rows, round(rows / (select start from s), 6) as kept from u""",
)
def pr25(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = {"positive": F.col("l_quantity") > 0, "discount": F.col("l_discount") <= 0.08, "kept_sale": F.col("l_returnflag") != "R"}
    return C.funnel(table(spark, sf_dir, "lineitem"), steps).withColumn("kept", F.round("kept", 6))


@query("pr26_unique_values", "select 'p_brand' as \"column\", p_brand as value from part union select 'p_type', p_type from part union select 'p_size', p_size::varchar from part")
def pr26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.unique_values(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@query("pr27_latest_window", "select event_id, ts, event_type from events where ts >= timestamp '2024-01-20 00:00:00' - interval 24 hour and ts < timestamp '2024-01-20 00:00:00'")
def pr27(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type").where(
        "ts >= timestamp_ntz'2024-01-20 00:00:00' - interval 24 hours and ts < timestamp_ntz'2024-01-20 00:00:00'"
    )


@query("pr28_coalesce_text", "select doc_id, coalesce(nullif(case when doc_id % 4 = 0 then '' else text end, ''), source) as body from documents")
def pr28(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.nullif(cleaned, F.lit("")), F.col("source")).alias("body"))
