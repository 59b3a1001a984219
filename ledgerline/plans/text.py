"""Text jobs T-01 .. T-17 (T-18 is scored with the models)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import text as X
from ledgerline.operators import corpus as K
from ledgerline.operators.cleaning import histogram_by
from ledgerline.operators.quantiles import exact_quantiles
from ledgerline.registry import query
from ledgerline.tables import materialise, spread, table

WS = r"[ \t\n\r\f\x0B]"


def norm_sql(col: str) -> str:
    known = f"(case when {col} is null or {col} = '' then 'no_review' else {col} end)"
    bare = f"regexp_replace({known}, 'http\\S+|www\\S+|[\\x{{1F600}}-\\x{{1F64F}}]', '', 'g')"
    return f"regexp_replace(lower({bare}), '[^a-z \\t\\n\\r\\f\\x0B]', '', 'g')"


def spaced_sql(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS}+', ' ', 'g'))"


def tokens_sql(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, '{WS}+'), lambda t: t <> '')"


NEG = "|".join(X.NEGATIONS)


def neg_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '(^| )({NEG}) ([^ ]+)', '\\1\\2_\\3', 'g')"


STOP = "[" + ", ".join(f"'{w}'" for w in X.STOP_WORDS) + "]"
DOC_TOKENS = f"""dt as (select doc_id, {tokens_sql(norm_sql('text'))} as toks from documents),
tok as (select doc_id, unnest(toks) as token, unnest(range(len(toks))) as pos from dt)"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text work is heavy per row, so even a one-file table should keep every core busy."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.token_table(docs(spark, sf_dir), ["doc_id"], "text")


def doc_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as arrays of words, one row each."""
    return K.word_rows(docs(spark, sf_dir), ["doc_id"], X.tokenize(X.normalize_text(F.col("text"))))


@query("t01_normalize", f"select doc_id, {norm_sql('body')} as clean from (select doc_id, case when doc_id % 50 = 0 then null when doc_id % 50 = 1 then '' else text end as body from documents)")
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 50
    body = F.when(k == 0, F.lit(None)).when(k == 1, F.lit("")).otherwise(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", X.normalize_text(body).alias("clean"))


def contraction_sql(expr: str) -> str:
    for short, long in X.CONTRACTIONS.items():
        start = "" if short.startswith("'") or short.startswith("n'") else "\\b"
        expr = f"regexp_replace({expr}, '(?i){start}{short.replace(chr(39), chr(39) * 2)}\\b', '{long}', 'g')"
    return expr


# Short forms are put in front of every turn, since the invented prose holds none.
@query("t02_contractions", f"select conv_id, turn, {contraction_sql('body')} as expanded from (select conv_id, turn, 'It''s clear we can''t stop; they''ve said I''m late, DON''T go. ' || text as body from conversations)")
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit("It's clear we can't stop; they've said I'm late, DON'T go. "), F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", X.expand_contractions(body).alias("expanded"))


@query("t03_tokenize", f"with {DOC_TOKENS} select doc_id, pos::int as pos, token from tok")
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.token_table(docs(spark, sf_dir), ["doc_id"], "text")


NEGATED = "not so no never good the none of it nothing "


def negated_body() -> F.Column:
    """Negations in front of every turn and in place of one common word."""
    return F.concat(F.lit(NEGATED), F.regexp_replace("text", " (the|la) ", " not "))


NEG_BODY = f"'{NEGATED}' || regexp_replace(text, ' (the|la) ', ' not ', 'g')"


@query("t04_join_negations", f"select conv_id, turn, {neg_sql(spaced_sql(norm_sql(NEG_BODY)))} as joined from conversations")
def t04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("conv_id", "turn", X.join_negations(X.one_spaced(X.normalize_text(negated_body()))).alias("joined"))


@query("t05_stop_words", f"select doc_id, list_filter({tokens_sql(neg_sql(spaced_sql(norm_sql('text'))))}, lambda t: not list_contains({STOP}, t)) as tokens from documents")
def t05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", X.prepared(F.col("text")).alias("tokens"))


@query(
    "t05_prepared_text",
    f"""with p as (select conv_id, turn, list_filter({tokens_sql(neg_sql(spaced_sql(norm_sql("case when turn % 3 = 0 then 'the of' else text end"))))}, lambda t: not list_contains({STOP}, t)) as toks from conversations)
select conv_id, turn, case when len(toks) > 0 then array_to_string(toks, ' ') else 'no_review' end as body from p""",
)
def t05_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("turn") % 3 == 0, F.lit("the of")).otherwise(F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", X.prepared_text(body).alias("body"))


# Dictionaries are derived from the texts, whose words are invented.
LEMMAS = f"""lem as (select token as form, regexp_replace(token, '(es|s)$', '') as lemma from (select token, count(*) as n from tok where regexp_matches(token, '.{{3,}}s$') group by 1 order by n desc, token limit 5000))"""


def lemma_table(tokens: DataFrame) -> DataFrame:
    plural = tokens.where(F.col("token").rlike("^.{3,}s$"))
    top = K.term_counts(plural).orderBy(F.col("n").desc(), "token").limit(5000)
    return top.select(F.col("token").alias("form"), F.regexp_replace("token", "(es|s)$", "").alias("lemma"))


@query(
    "t06_lemmas",
    f"with {DOC_TOKENS}, {LEMMAS} select doc_id, coalesce(string_agg(coalesce(lemma, token), ' ' order by pos), '') as lemmas from documents left join tok using (doc_id) left join lem on form = token group by 1",
)
def t06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.lookup_lemmas(doc_words(spark, sf_dir), lemma_table(doc_tokens(spark, sf_dir)), ["doc_id"])


LEX = f"""ct as (select conv_id, turn, {tokens_sql(norm_sql('text'))} as toks from conversations),
lex as (select token, ((('0x' || substr(md5(token), 1, 2))::int % 9 - 4) / 2.0)::double as valence from (select token, count(*) as n from (select unnest(toks) as token from ct) group by 1 order by n desc, token limit 5000)),
jt as (select conv_id, turn, unnest({tokens_sql(neg_sql(spaced_sql(norm_sql(NEG_BODY))))}) as token from conversations),
sg as (select conv_id, turn, case when regexp_matches(token, '^({NEG})_') then substr(token, strpos(token, '_') + 1) else token end as word, case when regexp_matches(token, '^({NEG})_') then -1 else 1 end as sign from jt),
sv as (select conv_id, turn, coalesce(valence, 0) * sign as v from sg left join lex on lex.token = word)"""


def lexicon(tokens: DataFrame) -> DataFrame:
    top = K.vocabulary(tokens, 5000)
    return top.select("token", ((F.conv(F.substring(F.md5("token"), 1, 2), 16, 10).cast("int") % 9 - 4) / F.lit(2.0)).alias("valence"))


@query(
    "t07_lexicon_sentiment",
    f"with {LEX} select conv_id, turn, round(count(*) filter (v > 0) / count(*), 6) as pos, round(count(*) filter (v < 0) / count(*), 6) as neg, round(sum(v) / sqrt(sum(v) * sum(v) + 15), 6) + 0.0 as compound from sv group by 1, 2",
)
def t07(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = X.token_table(turns(spark, sf_dir), ["conv_id", "turn"], "text")
    joined = X.tokenize(X.join_negations(X.one_spaced(X.normalize_text(negated_body()))))
    rows = K.word_rows(turns(spark, sf_dir), ["conv_id", "turn"], joined)
    s = K.lexicon_scores(rows, lexicon(words), ["conv_id", "turn"], X.NEGATIONS)
    return s.select("conv_id", "turn", *[F.round(c, 6).alias(c) for c in ("pos", "neg")], (F.round("compound", 6) + 0.0).alias("compound"))


@query("t08_rating_label", "select doc_id, (n_chars % 6)::int as rating, case when n_chars % 6 in (1, 2) then 0 when n_chars % 6 = 3 then 2 when n_chars % 6 in (4, 5) then 1 end as label from documents")
def t08(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = (F.col("n_chars") % 6).cast("int")
    return table(spark, sf_dir, "documents").select("doc_id", r.alias("rating"), X.rating_label(r).alias("label"))


VOCAB = "vocab as (select token, n, (row_number() over (order by n desc, token))::int as rank from (select token, count(*) as n from tok group by 1 order by n desc, token limit 5000))"


@query("t09_vocabulary", f"with {DOC_TOKENS}, {VOCAB} select * from vocab")
def t09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.vocabulary(X.token_table(docs(spark, sf_dir), ["doc_id"], "text"), 5000)


@query("t09_bag_of_words", f"with {DOC_TOKENS}, {VOCAB} select doc_id, rank, count(*) as count from tok join vocab using (token) group by all")
def t09_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.bag_of_words(doc_words(spark, sf_dir), K.vocabulary(doc_tokens(spark, sf_dir), 5000), ["doc_id"])


@query(
    "t10_words_by_class",
    f"""with {DOC_TOKENS}, c as (select quality, token, count(*) as n from tok join labels using (doc_id) where not list_contains({STOP}, token) group by all)
select quality, token, n, (row_number() over (partition by quality order by n desc, token))::int as rank from c qualify row_number() over (partition by quality order by n desc, token) <= 50""",
)
def t10(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = docs(spark, sf_dir).join(marks, "doc_id")  # the join comes before the words unfold
    words = labelled.select("quality", F.explode(X.drop_stop_words(X.tokenize(X.normalize_text(F.col("text"))))).alias("token"))
    return K.top_words_by_class(words, "quality", 50)


@query(
    "t11_encode_pad",
    f"""with {DOC_TOKENS}, {VOCAB}, e as (select doc_id, list(rank order by pos) as ids from tok join vocab using (token) where rank < 5000 group by 1)
select doc_id, list_concat(list_slice(ids, greatest(len(ids) - 499, 1), len(ids)), list_transform(range(greatest(500 - len(ids), 0)), lambda x: 0)) as ids, len(ids)::int as n_known from (select doc_id, coalesce(ids, []::bigint[]) as ids from documents left join e using (doc_id))""",
)
def t11(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Index 0 is the padding, so a limit of 5000 words leaves ranks 1 .. 4999.
    return K.encode(doc_words(spark, sf_dir), K.vocabulary(doc_tokens(spark, sf_dir), 5000).where("rank < 5000"), ["doc_id"], 500)


VECTORS = "vec as (select token, [" + ", ".join(f"((('0x' || substr(md5(token), {2 * i + 3}, 2))::int - 128) / 128.0)::double" for i in range(4)) + "] as vector from vocab where substr(md5(token), 1, 1) < 'c')"


def word_vectors(vocab: DataFrame) -> DataFrame:
    h = F.md5("token")
    dims = [(F.conv(F.substring(h, 2 * i + 3, 2), 16, 10).cast("int") - 128) / F.lit(128.0) for i in range(4)]
    return vocab.where(F.substring(h, 1, 1) < "c").select("token", F.array(*dims).alias("vector"))


@query("t12_vector_coverage", f"with {DOC_TOKENS}, {VOCAB}, {VECTORS} select (select count(*) from vec) as covered, count(*) + 1 as size, round((select count(*) from vec) / (count(*) + 1), 6) as share from vocab")
def t12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = K.vocabulary(doc_tokens(spark, sf_dir), 5000)
    return K.vector_coverage(vocab, word_vectors(vocab)).withColumn("share", F.round("share", 6))


@query("t12_max_pool", f"with {DOC_TOKENS}, {VOCAB}, {VECTORS} select doc_id, pooled from (select doc_id, [" + ", ".join(f"max(vector[{i + 1}])" for i in range(4)) + "] as maxima, case when count(vector) > 0 then maxima end as pooled from documents left join tok using (doc_id) left join vec using (token) group by 1)")
def t12_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.max_pool(doc_words(spark, sf_dir), word_vectors(K.vocabulary(doc_tokens(spark, sf_dir), 5000)), ["doc_id"], 4)


@query(
    "t13_chunks",
    """select doc_id, i::int as chunk, substr(text, i * 900 + 1, 1000) as body from (select doc_id, text, unnest(range(0, 1 + greatest(length(text) - 101, 0) // 900)) as i from documents)""",
)
def t13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.chunks(docs(spark, sf_dir), ["doc_id"], "text", 1000, 100)


SENT = f"""sl as (select doc_id, list_filter(string_split(regexp_replace(text, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '') as ss from documents),
st as (select doc_id, unnest(ss) as sentence, unnest(range(len(ss))) as sent from sl),
sw as (select doc_id, sent, unnest({tokens_sql(norm_sql('sentence'))}) as token from st),
tf as (select doc_id, token, count(*) as tf from sw group by 1, 2),
sc as (select doc_id, sent, avg(tf) as score from sw join tf using (doc_id, token) group by 1, 2),
ranked as (select st.doc_id, st.sent, sentence, coalesce(score, 0) as score from st left join sc using (doc_id, sent)),
best as (select *, sent // 20 as chunk from ranked qualify row_number() over (partition by doc_id, sent // 20 order by score desc, sent) <= 2),
final as (select * from best qualify row_number() over (partition by doc_id order by score desc, sent) <= 3)"""
SUMMARY = "select doc_id, coalesce(string_agg(sentence, ' ' order by sent), '') as summary from documents left join {t} using (doc_id) group by 1"


@query("t14_map_reduce_summary", f"with {SENT} " + SUMMARY.format(t="final"))
def t14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.summarise(table(spark, sf_dir, "documents"), "doc_id", "text", "map_reduce")


REFINED = f"""told as (select doc_id, sent, list_distinct({tokens_sql(norm_sql('sentence'))}) as words from st),
cand as (select b.doc_id, b.chunk, list({{'score': b.score, 'sent': b.sent, 'words': t.words}} order by b.sent) as c from best b join told t using (doc_id, sent) group by b.doc_id, b.chunk),
walk as (
  select distinct doc_id, -1::bigint as chunk, []::struct(rank double, sent bigint, words varchar[])[] as summary from cand
  union all
  select w.doc_id, c.chunk, list_sort(list_concat(w.summary, list_transform(c.c, lambda x: {{'rank': -(x.score * case when len(x.words) = 0 then 0 else len(list_filter(x.words, lambda t: not list_contains(w.said, t)))::double / len(x.words) end), 'sent': x.sent, 'words': x.words}})))[:3]
  from (select *, flatten(list_transform(summary, lambda s: s.words)) as said from walk) w join cand c on c.doc_id = w.doc_id and c.chunk = w.chunk + 1
),
refined as (select r.doc_id, st.sent, st.sentence from (select doc_id, unnest(list_transform(summary, lambda s: s.sent)) as sent from (select doc_id, max_by(summary, chunk) as summary from walk group by 1)) r join st on st.doc_id = r.doc_id and st.sent = r.sent)"""


@query("t15_refine_summary", f"with recursive {SENT}, {REFINED} " + SUMMARY.format(t="refined"))
def t15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.summarise(table(spark, sf_dir, "documents"), "doc_id", "text", "refine")


@query("t15_stuff_summary", f"with {SENT}, whole as (select * from ranked qualify row_number() over (partition by doc_id order by score desc, sent) <= 3) " + SUMMARY.format(t="whole"))
def t15_stuff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.summarise(table(spark, sf_dir, "documents"), "doc_id", "text", "stuff")


# Structured summaries are written around each document's own words.
@query(
    "t16_parse_summary",
    f"""with w as (select doc_id, {spaced_sql(norm_sql('text'))} as body from documents) select doc_id, body as main_idea, ['first of ' || source, 'more on it', 'second'] as key_points, trim('ends with ' || body || ' and ' || lang) as conclusion
from w join documents using (doc_id)""",
)
def t16(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = X.one_spaced(X.normalize_text(F.col("text")))
    written = F.concat(
        F.lit("Main Idea: "), body, F.lit("\nKey Points:\n- first of "), F.col("source"), F.lit("\n  more on it \n\n- second\nConclusion: ends with "), body, F.lit("\n and "), F.col("lang"), F.lit("\n")
    )
    return table(spark, sf_dir, "documents").select("doc_id", X.parse_summary(written).alias("s")).select("doc_id", "s.*")


@query(
    "t17_length_profile",
    """select quality, count(*) as n, round(avg(length(text)), 6) as mean, round(stddev_samp(length(text)), 6) as std, min(length(text))::double as low,
round(quantile_cont(length(text)::double, 0.25), 6) as q1, round(quantile_cont(length(text)::double, 0.5), 6) as q2, round(quantile_cont(length(text)::double, 0.75), 6) as q3, max(length(text))::double as high
from documents join labels using (doc_id) group by 1""",
)
def t17(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = docs(spark, sf_dir).select("doc_id", F.length("text").alias("size")).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    sized = materialise(sized.select("quality", "size"), "sizes")
    moments = sized.groupBy("quality").agg(F.round(F.avg("size"), 6).alias("mean"), F.round(F.stddev_samp("size"), 6).alias("std"))
    q = exact_quantiles(sized, ["size"], [0.25, 0.5, 0.75], ["quality"], stored=True)
    return q.join(moments, "quality").select("quality", "n", "mean", "std", "low", *[F.round(F.col("q")[i], 6).alias(f"q{i + 1}") for i in range(3)], "high")


@query(
    "t17_length_histogram",
    """with s as (select quality, length(text)::double as size from documents join labels using (doc_id) where text is not null and quality is not null),
e as (select min(size) as lo, max(size) as hi from s),
b as (select quality, least(floor((size - lo) / (hi - lo) * 30), 29)::int as bin, count(*) as n from s, e group by all),
t as (select quality, count(*) as t from s group by 1)
select t.quality, r.i::int as bin, round(lo + r.i * (hi - lo) / 30, 6) as low, coalesce(n, 0)::bigint as n, round(coalesce(n, 0) / t, 6) as share
from t cross join range(30) r(i) cross join e left join b on b.quality = t.quality and b.bin = r.i""",
)
def t17_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = docs(spark, sf_dir).select("doc_id", F.length("text").alias("size")).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    bins = histogram_by(materialise(sized.select("quality", "size"), "sizes"), "size", "quality", 30)
    return bins.select("quality", "bin", F.round("low", 6).alias("low"), "n", F.round("share", 6).alias("share"))
