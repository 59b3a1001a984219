"""Repair, prefix trie and language identification against SQL, plain search and held-out rows, and on odd input."""

from __future__ import annotations

import heapq
import random
import re

import duckdb
import numpy as np
import pytest

pytest.importorskip("ledgerline.llm")

from ledgerline.llm import conversation_queries as Q
from ledgerline.llm import language as L
from ledgerline.llm import ordering, trie
from ledgerline.llm.repair import Edits, Parser, Stacks, repair_conversations
from ledgerline.tables import fresh_path
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string"


def stored(spark, rows, name="conversations", schema=TURNS):
    path = fresh_path(spark, "fixture")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return path


def twin(path, sql):
    con = duckdb.connect()
    con.execute(f"create view conversations as from '{path}/conversations.parquet/*.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted((tuple(r[names.index(n)] for n in sorted(names)) for r in cur.fetchall()), key=repr)


def rows_of(df):
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def odd_turns():
    r = random.Random(4)
    words = ["yes.", "no", "why?", " ", "", "go on!", None, "x" * 50_000 + ".", "é́ \x00 İ."]
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool", "", None]), r.choice(words)) for c in [*range(60), 100, 160, 205, -7] for t in range(r.randint(0, 7))]
    rows += [(7, None, "user", "null turn."), (7, None, "user", "null turn."), (None, 1, "user", "nobody's."), (None, 2, "assistant", "nobody's either.")]
    rows += [(8, 3, "user", "tie a."), (8, 3, "user", "tie b."), (8, 3, "assistant", "tie a."), (900, 5, None, None)]
    return rows + rows[:15]


def test_parser_equals_plain_search():
    """Uniform-cost search over edits, the grammar as a pattern; runs of rows parsed in one or in three pieces."""
    p, r = Parser(Edits()), random.Random(5)
    for _ in range(150):
        rows = [(r.choice("suax"), r.choice((0, 0, 0, 1, 2))) for _ in range(r.randint(1, 5))]
        heap = [(0, "", "", 0)]
        while True:
            c, a, o, i = heapq.heappop(heap)
            if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", o):
                break
            if not re.fullmatch(r"s?(ua)*u?", o):
                continue
            if i < len(rows):
                x, f = rows[i]
                heapq.heappush(heap, (c + 3, a + "D", o, i + 1))
                if f != 2:
                    heapq.heappush(heap, (c + f, a + "K", o + x, i + 1))
                    for y in "ua":
                        heapq.heappush(heap, (c + 2 + f, a + "R", o + y, i + 1))
            for y in "ua":
                heapq.heappush(heap, (c + 2, a + "I", o + y, i))
        code = "".join(chr(97 + 3 * (p.initials.index(x) if x in p.initials else 3) + f) for x, f in rows)
        cuts = sorted(r.randint(0, len(code)) for _ in range(2))
        for parts in ([code], [code[: cuts[0]], code[cuts[0] : cuts[1]], code[cuts[1] :]]):
            made = [p.matrix(x, k == 0) for k, x in enumerate(filter(None, parts))]
            cost, entries, last, plan = p.path([m[:2] for m in made])
            assert cost == c
            assert "".join(m[2][e] for m, e in zip(made, entries, strict=True)) + last == a
            assert "".join(m[3][e] for m, e in zip(made, entries, strict=True)).replace("-", "") + plan.replace("-", "") == o


def test_other_grammars():
    lists = Stacks({"S": ((), ("S", "q", "A")), "A": (("a",), ("A", "a"))})  # a question, then any number of answers
    assert len(lists.nodes) < 10
    ambiguous = Stacks({"S": (("u", "X"), ("u", "Y")), "X": (("a",),), "Y": (("a",), ("a", "t"))})
    node = ambiguous.nodes[0]
    for symbol in "uat":
        (node,) = ambiguous.shift(node, symbol)
    assert node in ambiguous.accepting
    with pytest.raises(ValueError, match="nests"):
        Stacks({"S": ((), ("u", "S", "a"))}, most=50)


def test_repair_equals_sql_on_odd_input(spark):
    path = stored(spark, odd_turns())
    assert rows_of(Q.op12(spark, path)) == twin(path, Q.OP12_SQL)


def test_trie_equals_sql_on_odd_input(spark):
    path = stored(spark, odd_turns())
    assert rows_of(Q.op13(spark, path)) == twin(path, Q.OP13_SQL)


def test_long_conversation_in_blocks(spark):
    r = random.Random(6)
    rows = [(3, t, r.choice(["user", "assistant", "assistant", "system"]), r.choice(["a.", "b", "", "c?"]) + str(t % 700) + r.choice(".!x")) for t in range(2600)]
    rows += [(c, t, "user", f"{c}.") for c in (1, 2, 4) for t in range(3)]
    path = stored(spark, rows)
    assert rows_of(Q.op12(spark, path)) == twin(path, Q.OP12_SQL)
    found, repaired = repair_conversations(spark.read.parquet(f"{path}/conversations.parquet"))
    initials = "".join(x["role"][0] for x in repaired.where("conv_id = 3").orderBy("pos", "nth").collect())
    assert re.fullmatch(r"(s?(ua)+)?", initials)
    assert len(found.where("conv_id = 3").first()["audit"]) >= 2600


def test_deep_trie_in_blocks(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (101, 103) for t in range(2100)] + [(102, t, "user", f"turn {t}") for t in range(40)]
    nodes, ends = trie.prefix_trie(spark.createDataFrame(rows, TURNS), lambda c: c, lambda c: F.lit(0), longest_head=5)
    got = {r["depth"]: r for r in nodes.collect()}
    assert len(got) == 2101
    size = [len(f"turn {t}") for t in range(2100)]
    for d in (0, 1, 39, 40, 41, 1024, 2100):
        assert got[d]["n_convs"] == (3 if d <= 40 else 2)
        assert got[d]["n_leaves"] == 1
        assert got[d]["saved_tokens"] == sum((2 if t < 40 else 1) * size[t] for t in range(max(d - 1, 0), 2100))
    assert {(r["depth"], r["conv_id"]) for r in ends.collect()} == {(2100, 101), (2100, 103), (40, 102)}


def test_power_and_sums(spark):
    base = trie.bases(0)[1]
    got = spark.range(0, 5000, 7).select("id", trie.power(base, F.col("id") * 1_000_003).alias("p")).collect()
    assert all(r["p"] == pow(base, r["id"] * 1_000_003, trie.PRIME) for r in got)
    df = spark.range(0, 3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"))
    out = ordering.running_sums(df, "k", "at", {"s": F.col("at"), "n": F.lit(1)}, bits=4).collect()
    assert all(r["s"] == sum(range(r["k"], r["at"] + 1, 2)) and r["n"] == r["at"] // 2 + 1 for r in out)


@pytest.mark.parametrize("query", [Q.op12, Q.op13])
def test_conversations_empty_and_clashing_columns(spark, query):
    assert query(spark, stored(spark, [])).count() == 0
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b."), (2, 0, "user", "a.")]
    plain = rows_of(query(spark, stored(spark, rows)))
    more = [(*r, 1, "x", 2, "y", 3) for r in rows]
    assert rows_of(query(spark, stored(spark, more, schema=TURNS + ", pos long, audit string, depth long, sha256 string, blk long"))) == plain


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    net = L.Network.drawn(["a", "b", "c"], 4, rng)
    x, sizes, y = rng.integers(0, 256, (3, 7)), np.array([7, 5, 1]), np.array([0, 2, 1])
    _, grads = net.gradients(x, sizes, y)
    for w, g in zip(net.weights(), grads, strict=True):
        read = [(k, int(x[0, 0]) + o, j) for k in range(3) for o in (0, 256) for j in range(4)]
        for i in read if w is net.table else list(np.ndindex(w.shape))[:30]:
            old, values = w[i], []
            for move in (1e-2, -1e-2):
                w[i] = old + move
                values.append(net.gradients(x, sizes, y)[0])
            w[i] = old
            assert abs((values[0] - values[1]) / 2e-2 - g[i]) < 2e-3


def test_stretches_cover_every_byte():
    texts = [b"", b"a" * 128, b"b" * 129, b"c", b"", b"d" * 1000]
    x, sizes, counts = L.stretches(texts)
    assert sizes.sum() == sum(map(len, texts))
    at = 0
    for t, n in zip(texts, counts, strict=True):
        assert b"".join(x[i, : sizes[i]].tobytes() for i in range(at, at + n)) == t
        at += n


def test_language_held_out_and_odd_input(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = L.train(docs, sample=800)
    got = L.identify_language(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where(L.remainder(F.col("doc_id")) == 2).collect()
    right = [r["lang"] == r["lang_pred"] for r in got]
    assert len(right) > 150
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = [(1, None), (2, ""), (3, "123 ... _ ²"), (None, "the and this of that is there with her"), (4, "the and that of " * 30_000), (5, "x"), (5, "x"), (6, "\x00\ud800 é́".encode("utf-8", "replace").decode())]
    frame = spark.createDataFrame([(i, t, "zz", 1.0) for i, t in odd], "doc_id long, text string, lang_pred string, score double")
    out = L.identify_language(frame, net).collect()
    assert len(out) == len(odd)
    by = {r["doc_id"]: r for r in out}
    assert [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert by[4]["lang_pred"] == by[None]["lang_pred"] == "en"
    # Whole texts: the middle of a long text decides where most of it lies there.
    en, de = docs.where("lang = 'en'").orderBy("doc_id").first()["text"], " ".join(r["text"] for r in docs.where("lang = 'de'").orderBy("doc_id").limit(40).collect())
    assert L.predict(net, [en + de + en])[0] == ["de"]
    assert L.identify_language(frame.limit(0), net).count() == 0


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "the text", None), (None, "other", "en"), (3, None, "en")], "doc_id long, text string, lang string")
    net = L.train(docs)
    assert {r["lang_pred"] for r in L.identify_language(docs, net).collect()} == {"und"}
    one = L.train(spark.createDataFrame([(i, "some words", "en") for i in range(40)], "doc_id long, text string, lang string"), sample=40)
    assert [r["lang_pred"] for r in L.identify_language(docs.where("doc_id = 1"), one).collect()] == ["en"]
