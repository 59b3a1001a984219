"""Queries on ``conversations``, each next to its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.tables import table

from .ordering import joined_sha256
from .repair import repair_conversations
from .trie import prefix_trie


def crc_sql(text: str) -> str:
    """CRC-32 of ASCII text as a bigint: DuckDB has no function for it, so bit by bit."""
    bits = "list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295, list_reduce([4294967295::bigint] || list_transform(range(length({text})), lambda j: ascii(substr({text}, j + 1, 1))::bigint), lambda c, b: {bits}))"


def damage(turns: DataFrame) -> DataFrame:
    """One row in 20 of each kind: dropped, emptied, without end marks, twice, said to be the user's. Nulls are a space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind")).where("kind <> 0")
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), copies.alias("copy")).drop("copy")


def _put(x: str, role: str) -> str:
    return f"case when {x} is null then null else {{'c': {x}.c + 2, 'a': {x}.a || 'I', 't': list_append({x}.t, '{role}:')}} end"


def _go(x: str, letter: str, cost: str, line: str, when: str = "true") -> str:
    return f"case when {x} is null or not ({when}) then null else {{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 't': list_append({x}.t, {line})}} end"


def _drop(x: str) -> str:
    return f"case when {x} is null then null else {{'c': {x}.c + 3, 'a': {x}.a || 'D', 't': {x}.t}} end"


#: The four states of the role grammar: nothing yet, a system turn, a user's turn, an assistant's turn.
OP12_SQL = f"""
with recursive raw as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations
), kinds as (select *, {crc_sql("k")} % 20 as kind from raw),
damaged as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(case when kind = 3 then [1, 2] else [1] end) as copy from kinds where kind <> 0
), placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i, left(role, 1) as r from damaged
), faults as (
    select *, not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
        not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') as cut, lag(r) over (partition by conv_id order by i) || r as pair from placed
), rows_ as (select *, case when blank or again then 2 when cut then 1 else 0 end as f from faults),
counts as (
    select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count_if(blank)::bigint as blank, count_if(again and not blank)::bigint as duplicate,
        count_if(cut and not blank and not again)::bigint as truncated, count_if(pair is not null and pair not in ('su', 'ua', 'au'))::bigint as illegal from rows_ group by conv_id
), walk as (
    select conv_id, 0::bigint as i, {{'c': 0::bigint, 'a': '', 't': []::varchar[]}} as q0, null::struct(c bigint, a varchar, t varchar[]) as qs, null::struct(c bigint, a varchar, t varchar[]) as qu, null::struct(c bigint, a varchar, t varchar[]) as qa from counts
    union all
    select conv_id, i, {_drop("q0")}, list_min([{_drop("qs")}, {_go("q0", "K", "f", "line", "r = 's'")}]),
        list_min([{_drop("u1")}, {_go("before_u", "K", "f", "line", "r = 'u'")}, {_go("before_u", "R", "f + 2", "'user:' || text", "f < 2")}]),
        list_min([{_drop("a1")}, {_go("u1", "K", "f", "line", "r = 'a'")}, {_go("u1", "R", "f + 2", "'assistant:' || text", "f < 2")}])
    from (
        select x.*, list_min([q0, qs, a1]) as before_u, case when x.f = 2 then '' else x.role0 end as r from (
            select y.*, list_min([qa, {_put("u1", "assistant")}]) as a1 from (
                select w.conv_id, w.i + 1 as i, q0, qs, qa, list_min([qu, {_put("q0", "user")}, {_put("qs", "user")}, {_put("qa", "user")}]) as u1, s.f, s.r as role0, s.role || ':' || s.text as line, s.text
                from walk w join rows_ s on w.conv_id is not distinct from s.conv_id and s.i = w.i + 1
            ) y
        ) x
    )
), ends as (
    select conv_id, list_min([q0, qa, {_put("u1", "assistant")}]) as best from (
        select w.*, list_min([qu, {_put("q0", "user")}, {_put("qs", "user")}, {_put("qa", "user")}]) as u1 from walk w join counts c on w.conv_id is not distinct from c.conv_id and w.i = c.n
    )
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
    coalesce(best.c, 0) as cost, coalesce(best.a, '') as audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on o.conv_id is not distinct from c.conv_id left join ends e on o.conv_id is not distinct from e.conv_id
"""


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found, repaired = repair_conversations(damage(turns))
    lines = repaired.withColumn("line", F.concat("role", F.lit(":"), "text"))
    digests = joined_sha256(lines, ["conv_id"], ["pos", "nth"], "line", "\n")
    every = turns.select("conv_id").distinct().alias("o")
    out = every.join(found.alias("f"), F.col("o.conv_id").eqNullSafe(F.col("f.conv_id")), "left").join(digests.alias("d"), F.col("o.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("o.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP13_SQL = f"""
with recursive placed as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as i
    from conversations where conv_id is not null
), plans as (select conv_id, conv_id - conv_id % 100 as base, {crc_sql("conv_id::varchar")} % 6 as h from (select distinct conv_id from placed)),
heads as (select p.conv_id, t.i as d, t.role, t.text from plans p join placed t on t.conv_id = p.base and t.i <= p.h),
rebuilt as (
    select * from heads
    union all
    select p.conv_id, t.i - p.h + (select count(*) from heads x where x.conv_id = p.conv_id), t.role, t.text from plans p join placed t on t.conv_id = p.conv_id and t.i > p.h
), sizes as (select p.conv_id, (select count(*) from rebuilt r where r.conv_id = p.conv_id) as n from plans p),
members as (
    select conv_id, 0::bigint as d, []::varchar[] as path, 0::bigint as chars from plans
    union all
    select m.conv_id, r.d, list_append(m.path, strlen(r.role)::varchar || ':' || r.role || r.text), length(r.text)::bigint from members m join rebuilt r on r.conv_id = m.conv_id and r.d = m.d + 1
), nodes as (
    select d, path, min(m.conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * min(chars) as saves, string_agg(m.conv_id::varchar, ',' order by m.conv_id) filter (where s.n = m.d) as ends
    from members m join sizes s on s.conv_id = m.conv_id group by d, path
), linked as (select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.d = n.d + 1 and c.path[:n.d] = n.path) as n_children from nodes n left join nodes p on p.d = n.d - 1 and p.path = n.path[:n.d - 1])
select a.conv_id, a.d as depth, a.parent_conv_id, a.n_convs, a.n_children, count_if(b.n_children = 0)::bigint as n_leaves, sum(b.saves)::bigint as saved_tokens, sha256(coalesce(a.ends, '')) as ends_sha256
from linked a join linked b on b.d >= a.d and b.path[:a.d] = a.path group by a.path, a.conv_id, a.d, a.parent_conv_id, a.n_convs, a.n_children, a.ends
"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    def head(conv: Column) -> Column:
        return F.crc32(conv.cast("string").cast("binary")) % 6

    nodes, ends = prefix_trie(table(spark, sf_dir, "conversations"), lambda c: c - c % 100, head, longest_head=5)
    key = ["depth", "fa", "fb"]
    digests = joined_sha256(ends.withColumn("name", F.col("conv_id").cast("string")), key, ["conv_id"], "name", ",")
    out = nodes.join(digests, key, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
