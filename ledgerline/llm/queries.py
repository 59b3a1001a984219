"""The queries of this package, each next to its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.tables import fresh_path, table

from .common import Scratch
from .conversation_queries import OP12_SQL, OP13_SQL, op12, op13
from .decontaminate import find_leaks
from .jaccard import Rule, jaccard_components
from .language import identify_language
from .language import remainder as language_fold
from .language import train as train_language
from .licences import featured, scan_licences
from .licences import train as train_licences
from .lines import dedup_lines
from .packing import pack_documents
from .secret_scan import BASE, scan_secrets
from .tokenfile import read_digests, write_tokens
from .topk import top_k
from .toxicity import remainder, score_toxicity
from .toxicity import train as train_toxicity
from .warc import read_archive, write_archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    "op1_ngram_jaccard_join",
    """
    with recursive words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents
    ), sets as (
        select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
            else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) end as s from words
    ), items as (select doc_id, len(s) as n, unnest(s) as g from sets),
    shared as (
        select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as k
        from items a join items b on a.g = b.g and a.doc_id < b.doc_id and a.n * 100 >= 85 * b.n and b.n * 100 >= 85 * a.n group by a.doc_id, b.doc_id
    ), links as (select a, b from shared where 100 * k >= 85 * (n + m - k)),
    both_ways as (select a, b from links union all select b, a from links),
    reach as (select a, b from both_ways union select r.a, l.b from reach r join both_ways l on r.b = l.a)
    select s.doc_id, len(s.s)::bigint as n_shingles, least(s.doc_id, coalesce((select min(r.b) from reach r where r.a = s.doc_id), s.doc_id)) as component_id from sets s
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), Rule(words=4, num=85, den=100))


@query(
    "op2_line_dedup",
    """
    with lines as (
        select doc_id, unnest(range(len(l))) as pos, unnest(l) as line from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
    ), keyed as (
        select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines
    ), shared as (select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
    marked as (select doc_id, pos, line, coalesce(keeper <> doc_id, false) as gone from keyed left join shared using (k))
    select doc_id, count(*)::bigint as n_lines, count_if(gone)::bigint as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
    from marked group by doc_id
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op3_warc_archive",
    """
    with p as (select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages),
    chunks as (select page_id, list_transform(range(8), lambda i: ('0x' || h[i * 5 + 1:i * 5 + 5])::bigint) as v from p),
    digits as (
        select page_id, array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31)::int + 1, 1)), '')), '') as d from chunks
    )
    select p.page_id, n::bigint as payload_bytes, d as payload_digest, case when page_id = max(page_id) over (partition by html) then 'response' else 'revisit' end as record_type,
        case when page_id <> max(page_id) over (partition by html) then max(page_id) over (partition by html) end as refers_to
    from p join digits using (page_id)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


@query("op5_licence_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seen = Scratch(spark, "licences").write(featured(docs), "paragraphs")
    found = scan_licences(docs, *train_licences(docs, seen=seen), seen=seen)
    return found.select("doc_id", F.col("para").cast("long").alias("paragraph"), "family")


@query(
    "op6_exact_top_k",
    """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
        select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
    ), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
    select query_id, rank::int as rank, vec_id, score from r where rank <= 5
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), end_id=2)
    return read_digests(spark, path)


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=1)


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    kinds = [k for k, *_ in BASE]
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", *counts, F.sha2(joined(of(*kinds)), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs, train_language(docs))
    held_out = F.coalesce(language_fold(F.col("doc_id")) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


query("op12_structure_repair", OP12_SQL)(op12)
query("op13_prefix_trie", OP13_SQL)(op13)
