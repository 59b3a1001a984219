"""Each operator against a brute-force version or an exact round trip, and on empty, null, repeated and odd input."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("ledgerline.llm")

import public_tokenizers
from ledgerline.llm import jaccard as J
from ledgerline.llm import licences, toxicity
from ledgerline.llm.decontaminate import drop_leaks, find_leaks
from ledgerline.llm.encoding import Encoder
from ledgerline.llm.lines import dedup_lines
from ledgerline.llm.packing import pack, pack_documents
from ledgerline.llm.secret_scan import ADDED, BASE, automaton, scan_secrets, spans_of
from ledgerline.llm.tokenfile import Reader, read_digests, read_index, write_tokens
from ledgerline.llm.topk import top_k
from ledgerline.llm.warc import read_archive, write_archive
from ledgerline.tables import fresh_path, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "alpha beta gamma delta epsilon"), (4, "x " * 60_000), (5, "alpha beta gamma delta epsilon"), (5, "alpha beta gamma delta epsilon"), (6, "é́ \x00 ß\r\nİ")]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def blanks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_components(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = blanks(t)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[find(a)] = min(least.get(find(a), i), i)
    return sorted((i, len(sets[a]), least[find(a)]) for a, (i, _) in enumerate(rows))


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (2, 4, 5), (1, 3, 5)])
def test_jaccard_against_all_pairs(spark, k, num, den):
    rnd = random.Random(k)
    words = [f"W{i}" for i in range(400)]
    rows, base = [], [rnd.choice(words) for _ in range(60)]
    for i in range(160):
        kind = i % 4
        t = list(base) if kind == 0 else [rnd.choice(words[:40]) for _ in range(rnd.randrange(0, 30))] if kind == 1 else base[: rnd.randrange(1, 30)] if kind == 2 else [rnd.choice(words) for _ in range(50)]
        for _ in range(rnd.randrange(0, 4)):
            if t:
                t[rnd.randrange(len(t))] = rnd.choice(words)
        rows.append((1000 - i, rnd.choice([" ", "\n", "\t "]).join(t)))
    got = J.jaccard_components(documents(spark, rows), J.Rule(k, num, den), frequent_from=4, direct_most=6).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_components(rows, k, num, den)


def test_jaccard_keeps_members_outside_a_hub_in_their_rows(spark, monkeypatch):
    plans = {}

    class Watched(J.Scratch):
        def write(self, df, name):
            plans[name] = df._jdf.queryExecution().toString()
            return super().write(df, name)

    monkeypatch.setattr(J, "Scratch", Watched)
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(60):  # families of three around one passage: near each other, far from the hub
        own = [f"f{i // 3}w{j}" for j in range(24)]
        own[rnd.randrange(24)] = f"x{i}"
        rows.append((i, " ".join(passage + own)))
    got = J.jaccard_components(documents(spark, rows), J.Rule(1, 4, 5), frequent_from=4, rounds=1, direct_most=6).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_components(rows, 1, 4, 5)
    assert "known" in plans
    assert not [name for name, plan in plans.items() if "explode(outside" in plan]


def test_small_sets_link_by_subsets():
    rule = J.Rule(1, 4, 5)
    sizes = {n: 10 for n in range(1, 40)}
    assert 1 < J.choose_boundary(rule, sizes, 3.0) < 48
    for n, m in itertools.product(range(1, 40), repeat=2):
        need = rule.need(n, m)
        assert rule.den * need >= rule.num * (n + m - need) and rule.den * (need - 1) < rule.num * (n + m - need + 1)
        if need <= min(n, m):
            assert abs(rule.band(n) - rule.band(m)) <= 1 and m in rule.partners(n)


def test_jaccard_odd_input(spark):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(documents(spark, ODD), J.Rule(4, 85, 100)).collect()}
    assert got == {(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 2, 5), (4, 1, 4), (5, 2, 5), (6, 1, 6)}
    assert J.jaccard_components(documents(spark, []), J.Rule()).count() == 0
    assert J.keep_one(documents(spark, ODD), J.Rule()).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_lines(spark):
    shared = "This Line is long enough to count"
    rows = [(1, f"a\n{shared}\nb"), (2, f" {shared.upper()}\t\n"), (3, f"{shared}\n{shared}\nshort"), (4, None), (5, ""), (6, "short\n" * 3)]
    df = documents(spark, rows).withColumn("n_lines", F.lit("clash")).withColumn("row", F.lit(7)).withColumn("gone", F.lit(8))
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped, r["row"], r["gone"]) for r in dedup_lines(df).collect()}
    assert got[1] == ("a\nb", 3, 1, 7, 8) and got[2][:3] == ("", 2, 1) and got[3][:3] == (rows[2][1], 3, 0)
    assert got[4][:3] == ("", 1, 0) and got[5][:3] == ("", 1, 0) and got[6][:3] == ("short\n" * 3, 4, 0)
    assert dedup_lines(documents(spark, [])).count() == 0 and dedup_lines(documents(spark, ODD)).count() == len(ODD)


def test_lines_of_repeated_ids_against_sql(spark):
    import duckdb

    a, b = "A line that two documents hold", "A line that three documents hold"
    rows = [(1, f"{a}\n{b}"), (1, f"{a}\n{b}\nx"), (2, f"{a}\n{b}"), (3, b)]
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in dedup_lines(documents(spark, rows)).collect())
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    shared = con.execute("select line from (select doc_id, unnest(string_split(text, chr(10))) as line from documents) where length(line) >= 20 group by line having count(distinct doc_id) >= 3").fetchall()
    assert shared == [(b,)]
    assert got == [(1, 2, 1, a), (1, 3, 1, f"{a}\nx"), (2, 2, 1, a), (3, 1, 0, b)]


def test_warc_round_trip(spark):
    rows = [(1, "http://a\r\nb", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 100_000), (None, "u", "y"), (6, "u", "z"), (6, "u", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha256", F.lit("clash")).withColumn("size", F.lit(0))
    path = fresh_path(spark, "warc-test")
    write_archive(pages, path)
    got = {r.page_id: r for r in read_archive(spark, path).collect()}
    assert got[1].record_type == "revisit" and got[1].refers_to == 2 and got[2].record_type == "response" and got[3].refers_to == 4
    assert bytes(got[2].payload) == "<p>é</p>".encode() and got[1].payload_bytes == 9
    import base64

    assert got[5].payload_digest == base64.b32encode(hashlib.sha1(b"x" * 100_000).digest()).decode()
    head, body = bytes(got[5].record).split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and body == b"x" * 100_000 + b"\r\n\r\n" and b"Content-Length: 100000" in head
    assert None in got and sum(1 for r in read_archive(spark, path).collect()) == len(rows)
    path = fresh_path(spark, "warc-test")
    write_archive(pages.limit(0), path)
    assert read_archive(spark, path).count() == 0


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    out = toxicity.score_toxicity(docs, toxicity.train(docs, labels)).join(labels, "doc_id").select("doc_id", "score", "spans", "toxic").collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    hit = [r for r in held if r.score >= 0.7]
    assert hit and sum(r.toxic for r in hit) / len(hit) > 0.9 and sum(r.toxic for r in hit) / sum(r.toxic for r in held) > 0.6
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id][s.start : s.stop].strip() == texts[r.doc_id][s.start : s.stop] for r in hit for s in r.spans)
    model = toxicity.train(docs.limit(0), labels)
    odd = toxicity.score_toxicity(documents(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd) and toxicity.score_toxicity(documents(spark, []), model).count() == 0


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    score, trans = rng.normal(0, 2, 9), np.array([0.0, -1.0, 0.4, 0.8, -0.3])
    first = np.array([1, 0, 0, 0, 0, 1, 0, 0, 0], bool)
    ahead, back = toxicity.forward_backward(score, first, trans)
    weight = np.zeros((9, 2))
    for y in itertools.product((0, 1), repeat=9):
        w = sum(score[t] * y[t] + (trans[4] * y[t] if first[t] else trans[2 * y[t - 1] + y[t]]) for t in range(9))
        for t in range(9):
            weight[t, y[t]] += np.exp(w)
    assert np.allclose(ahead * back, weight[:, 1] / weight[:, 0])


def test_licences(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model, level = licences.train(docs)
    rows = [(1, "Intro\nReleased under the MIT License.\nmore"), (2, "Licensed under the Apache License, Version 2.0."), (3, "the that of and into"), (4, None), (5, "This work is licensed under the GNU General Public License, version 3. Thwhing onwh haheble"), (6, "Licensed under CC BY-NC 4.0."), (7, "a licence to drive")]
    got = {(r.doc_id, r.para, r.family) for r in licences.scan_licences(documents(spark, rows), model, level).collect()}
    assert got == {(1, 1, "MIT"), (2, 0, "Apache-2.0"), (5, 0, "GPL"), (6, 0, "CC-BY-NC")}
    assert licences.scan_licences(documents(spark, ODD), model, level).count() == 0


def test_licences_learn_from_every_paragraph(spark, monkeypatch):
    shown = []

    class Fit(licences.LogisticRegression):
        def fit(self, df):
            shown.append(df.where(F.col("label") == licences.UNKNOWN).count())
            return super().fit(df)

    monkeypatch.setattr(licences, "LogisticRegression", Fit)
    rows = [(i, f"alpha{i} beta\nplain words of line {i}") for i in range(4000)] + [(5000, "Released under the MIT License."), (5001, None)]
    docs = documents(spark, rows)
    licences.train(docs)
    plain = docs.where("doc_id < 4000").select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("para"))
    assert shown == [1 + plain.where(F.pmod(F.xxhash64("doc_id", "para", F.lit("licence")), F.lit(4)) != 0).count()]


def test_top_k_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) * (1 + i % 5) for _ in range(6)]) for i in range(300)] + [(1000 + i, [0.5] * 6) for i in range(100)]
    rows += [(2000, None), (2001, [1.0, None, 1.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (2004, [3.0]), (2010, []), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("norm", F.lit("clash"))
    got = sorted(map(tuple, top_k(df, F.col("vec_id") % 10 == 0, bucket_rows=32, query_rows=11).collect()))
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in ok:
        if q % 10 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q)[:5]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got == sorted(want) and top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_token_files(spark):
    path, file = fresh_path(spark, "tokens-test"), public_tokenizers.path("word_bpe_49k.json")
    write_tokens(documents(spark, ODD), path, file, end_id=2, length=16, rows=4)
    tokenizer = Tokenizer.from_file(file)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in ODD}
    got, at = read_digests(spark, path).orderBy("start").collect(), 0
    for r, i in zip(got, [None, 1, 2, 3, 4, 5, 5, 6], strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes()))
        at += r.n_tokens
    one = read_index(spark, path).orderBy(F.desc("n_tokens")).first()
    reader = Reader(one.file)
    assert [x for part in reader.ids(one["at"], one.n_tokens) for x in part.tolist()] == ids[4]
    table_, mask = reader.rows(0)
    assert table_.shape[1] == 16 and mask.shape == table_.shape and not next(reader.ids(0, 3)).flags.writeable
    path = fresh_path(spark, "tokens-test")
    write_tokens(documents(spark, []), path, file, end_id=2)
    assert read_digests(spark, path).count() == 0


def test_licences_read_texts_once(spark):
    docs = documents(spark, [(1, "Released under the MIT License.\nThe cat is under the table."), (2, None), (2, "the of\n\nSPDX-License-Identifier: MIT"), (None, "word")])
    seen = licences.featured(docs)
    got = {(r.doc_id, r.para): r.agreements and dict(zip(licences.FAMILIES, r.agreements, strict=True)) for r in seen.collect()}
    assert set(got) == {(1, 0), (1, 1), (2, 0), (2, 2), (None, 0)} and got[1, 1] is got[2, 0] is got[None, 0] is None
    assert got[1, 0]["MIT"] == got[2, 2]["MIT"] == 1.0 and got[1, 0]["GPL"] < 0.5 < got[1, 0]["BSD"] < 0.8
    model, level = licences.train(docs, seen=seen)
    plain, kept = (sorted(map(tuple, licences.scan_licences(docs, model, level, seen=x).collect())) for x in (None, seen))
    assert plain == kept and {r[0] for r in kept} <= {1, 2}


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_whole_texts(file):
    rnd, path = random.Random(8), public_tokenizers.path(file)
    bits = ["a", "key", "mot", "fin", "!", "~", "'s", "12", "é", "ß"] + [" "] * 8 + ["\n"] * 3 + ["\t", "\u00a0", "\r\n", "\r", "\x1c", "\x1f", "\x85", "\u2003", "\u3000", "  ", "\n\n", "\x0b", "\u200b"]
    texts = ["key\tvalue ", "a\tb c", "mot\u00a0! fin ", "a\tb\tc\n\n", " a\tb", "a\r\nb  c"] + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 30))) for _ in range(3000)]
    whole = Tokenizer.from_file(path)
    got = Encoder(path).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_cuts_only_where_rules_part(file):
    rnd, path = random.Random(9), public_tokenizers.path(file)
    bits = ["a", "Key", "it's", "'ll", "'", "HI", "12", "é", "e\u0301", "\u0301", "h\u0331", "中", "ก", "\u0e33", "한", "ﬀ", "~", "<|endoftext|>", "<|", "=\u0338", "👍🏽", "\x00", "\x7f", "\u180e", "\ufeff"]
    bits += list("!#$%&*,.:;?-_@/()[]\"") + [" "] * 12 + ["\n"] * 6 + ["  ", "\n\n", "\n ", " \n", "\t", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\u00a0", "\u1680", "\u2009", "\u2028", "\u202f", "\u205f", "\u3000"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 40))) for _ in range(6000)]
    whole, encoder, got = Tokenizer.from_file(path), Encoder(path, most=2000), []
    for i in range(0, len(texts), 1500):  # most is small: remembered stretches are dropped between calls
        got += encoder.encode(pa.array(texts[: i + 1500]).slice(i))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_learns_a_word_once_for_all_marks_and_lines(monkeypatch):
    words = ["".join(x) for x in itertools.product("bcd", "aeiou", "lmnr")]
    texts = [f"the {w}{mark} to {w}\n{w}{mark}\nof {w}" for w in words for mark in "!#$%&*,.:;?"]
    for file in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        encoder, learned = Encoder(public_tokenizers.path(file)), []
        learn = encoder.learn
        monkeypatch.setattr(encoder, "learn", lambda new, learn=learn, learned=learned: learned.extend(new) or learn(new))
        encoder.encode(texts)
        assert len(learned) == len(set(learned)) <= 2 * len(words) + 11 + 4


def test_encoder_looks_each_stretch_up_once(monkeypatch):
    path, asked = public_tokenizers.path("byte_bpe_50k.json"), []
    encoder = Encoder(path)
    look_up = encoder.look_up
    monkeypatch.setattr(encoder, "look_up", lambda parts: asked.append(sorted(parts)) or look_up(parts))
    texts = pa.array(["skipped", "the key\nthe mot", None, "the  key", "", "mot the key"])
    got = encoder.encode(texts.slice(1))
    whole = Tokenizer.from_file(path)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()[1:]]
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0])) and "skipped" not in asked[0]
    assert encoder.encode(texts.slice(0, 0)) == []


def test_leaks(spark):
    item = "Anna drove 120 km to Berlin in 3 hours. How fast did Anna drive on the long way to Berlin on that day?"
    items = spark.createDataFrame([(7, item), (8, "too short"), (9, None)], "item_id long, text string")
    noise = "some other words stand here before and behind it all the time. "
    rows = [(1, noise + item + " " + noise), (2, noise + item.upper()), (3, item.replace("Anna", "Bob").replace("Berlin", "Rome").replace("120", "90")), (4, item.replace("Berlin", "Rome", 1)), (5, noise * 40), (6, None), (7, item), (7, item)]
    got = {r.doc_id: r for r in find_leaks(documents(spark, rows).withColumn("w", F.lit(1)), items).collect()}
    assert set(got) == {1, 3, 7} | ({2} & set(got)) and got[1].n_changed == 0 and got[3].n_changed >= 4 and got[7].coverage == 1.0
    left = drop_leaks(documents(spark, rows), items)
    assert {r.doc_id for r in left.collect()} >= {4, 5, 6} and left.columns[0] == "doc_id"
    assert find_leaks(documents(spark, ODD), items).count() == 0 and find_leaks(documents(spark, rows), items.limit(0)).count() == 0


LONG = "A train of the old line leaves Vienna at noon and runs 40 km each hour until it comes to the small town of Graz where people wait for it and then it goes on to Vienna again over the same hills"


def test_leaks_with_shifted_words(spark):
    items = spark.createDataFrame([(1, LONG), (2, "What is 3 plus 4?"), (3, "Paris 5 km, Rome 7 km, Berlin 9 km, then Bonn 2 km and Ulm 4 km")], "item_id long, text string")
    words = LONG.split()
    middle = len(words) // 2
    three = [w if i not in (9, 18, 27) else "otherwise" for i, w in enumerate(words)]
    rows = [(1, " ".join([*words[:middle], "very", *words[middle:]])), (2, " ".join(words[:middle] + words[middle + 1 :])), (3, LONG.replace("Graz", "Los Santos")), (4, " ".join(three))]
    rows += [(5, "so tell me: What is 8 plus 9? said the man"), (6, items.collect()[2].text.replace("Rome", "Oslo").replace("7", "8")), (7, " ".join(words[:12])), (8, " ".join(words[: middle - 2] + ["and so on"] * 20 + words[middle + 14 :]))]
    got = {(r.doc_id, r.item_id) for r in find_leaks(documents(spark, rows), items).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 3)}


def test_leaks_at_every_place(spark):
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    wrong = LONG.replace("Vienna", "Linz", 1)
    quoted = " ".join(LONG.split()[:30]) + " whatever else the writer of this has put behind the passage Again and Again"
    rows = [(1, wrong + ". " + LONG), (2, wrong), (3, quoted), (4, LONG + ". " + wrong)]
    got = {r.doc_id: r for r in find_leaks(documents(spark, rows), items).collect()}
    assert set(got) == {1, 3, 4} and got[1].n_changed == 0 and got[1].coverage == 1.0 and got[3].coverage < 1 and got[3].n_changed == 0


def test_leaks_with_names_anywhere(spark):
    item = "Anna has 5 apples. Anna buys 3 more of them. Anna gives USA-made apples to McDonald: Eve has how many of the apples? Anna asks."
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item.upper()), (2, item.lower()), (3, item.replace("Anna", "Bob").replace("5", "7").replace("McDonald", "O").replace("USA", "EU")), (4, item.replace(" ", "\n")), (5, item.replace("Eve", "eve"))]
    got = {r.doc_id: r for r in find_leaks(documents(spark, rows), items).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and [got[i].n_changed for i in (1, 2, 4, 5)] == [0] * 4 and got[3].n_changed >= 6


def test_leaks_against_plain_search(spark):
    docs, items = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    texts = [(r.item_id, plain(r.text)) for r in items.collect()]
    assert found == {(d.doc_id, i) for d in docs.collect() for i, t in texts if t in plain(d.text)}


def test_remembered_tokens_are_small():
    """F1: a worker's score table holds numbers, not texts, and gives the same scores as an empty one, also after it was cleared."""
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(0, 0.5, 1 << toxicity.BITS).astype("f4"), np.array([0.0, -2.0, 0.5, 0.3, -2.0]), -1.0, np.array([-2.0, 0.2, 0.1]))
    scorer, small = toxicity.Scorer(model), toxicity.Scorer(model, most=1500)
    words = [f"wort{k}é" if k % 2 else f"Word{k}" for k in range(20_000)]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for k in range(0, len(words), 1000):
            scorer.logits(list(map("".join, words[k : k + 1000])), np.array([0, 400, 0, 600]))
        assert tracemalloc.get_traced_memory()[0] - before < 64 * len(words)
    finally:
        tracemalloc.stop()
    for k in range(0, len(words), 1700):
        tokens = [words[i] for i in rng.integers(max(0, k - 300), min(k + 1000, len(words)), 900)]
        sizes = np.array([300, 0, 599, 1])
        want = toxicity.Scorer(model).logits(tokens, sizes)
        assert np.array_equal(scorer.logits(tokens, sizes), want) and np.array_equal(small.logits(tokens, sizes), want)
    first, whole = words[:50], np.array([50])
    own, before, after = (np.array(x) for x in zip(*((float(model.weights[o].sum()), float(model.weights[b]), float(model.weights[a])) for o, b, a in map(toxicity.slots, first)), strict=True))
    score = own + model.bias
    score[1:] += before[:-1]
    score[:-1] += after[1:]
    ahead, back = toxicity.forward_backward(score, np.arange(50) == 0, model.trans)
    assert np.array_equal(scorer.logits(first, whole), np.log(ahead) + np.log(back)) and len(scorer.logits([], np.array([0]))) == 0


def test_packing_with_a_small_table(spark):
    """how much a worker remembers changes no row."""
    file = public_tokenizers.path("byte_bpe_50k.json")
    rows = [sorted(map(tuple, pack_documents(documents(spark, ODD), file, 1, remember=n).collect()), key=repr) for n in (20, 10_000_000)]
    assert rows[0] and rows[0] == rows[1]


def test_packing(spark):
    rnd = random.Random(2)
    sizes = [rnd.choice([1, 3, 700, 2047, 2048, 2049, 9000, rnd.randrange(1, 3000)]) for _ in range(700)]
    seen = [[] for _ in sizes]
    for seq in pack(sizes):
        at = 0
        for doc, start, n, offset in seq:
            assert offset == at and n > 0
            at += n
            seen[doc].append((start, n))
        assert at == 2048 or at & (at - 1) == 0
    for n, got in zip(sizes, seen, strict=True):
        got.sort()
        assert sum(x[1] for x in got) == n and all(a[0] + a[1] == b[0] for a, b in itertools.pairwise(got)) and got[0][0] == 0
    file = public_tokenizers.path("byte_bpe_50k.json")
    out = pack_documents(documents(spark, ODD), file, 1, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out)
    whole = [x for r in sorted((r for r in out if r.doc_id == 4), key=lambda r: r.start) for x in r.ids]
    assert whole == [*Tokenizer.from_file(file).encode(ODD[4][1], add_special_tokens=False).ids, 1]
    assert pack_documents(documents(spark, []), file, 1).count() == 0


def test_secrets_against_regular_expressions(spark):
    rules = BASE + ADDED
    machine, rnd = automaton(rules), random.Random(1)
    bits = ["password", "passwd", "token", "secret", "api_key", "APIKEY", '"', "'", " ", ":", "=", "AKIA", "ABCD1234", "0123456789abcdef", "é", "\n", ",", "passwor", "xoxb-", "ghp_", "-----BEGIN ", "RSA KEY-----", "abcdefgh1", "."]

    def brute(text):
        found = []
        for i, (kind, pattern, group, least) in enumerate(rules):
            found += [(m.start(), i, kind, m.end()) for m in re.finditer(pattern.replace("{32,}", "+") if kind == "hex" else pattern, text) if len(m[group]) >= least]
        return [(k, a, b) for a, _, k, b in sorted(found)]

    for _ in range(400):
        texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(50))) for _ in range(3)]
        assert spans_of(machine, [t.encode() for t in texts], rules) == [brute(t) for t in texts]
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in scan_secrets(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}
    assert scan_secrets(documents(spark, ODD)).count() == len(ODD) and scan_secrets(documents(spark, [])).count() == 0
