"""Corpus jobs: vocabularies, encodings, lexicon scores, extractive summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import normalize_text, sentences, tokenize
from ledgerline.tables import place


def term_counts(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def vocabulary(tokens: DataFrame, size: int) -> DataFrame:
    """(token, n, rank) of the ``size`` most frequent words; ties in word order. At most ``size`` rows."""
    top = term_counts(tokens).orderBy(F.col("n").desc(), F.col("token")).limit(size)
    return top.withColumn("rank", F.row_number().over(W.orderBy(F.col("n").desc(), F.col("token"))))


def word_rows(df: DataFrame, keys: Sequence[str], words: Column) -> DataFrame:
    """(keys..., words): one row a text, its words as an array; a text without words has an empty one."""
    return df.select(*keys, F.coalesce(words, F.array().cast("array<string>")).alias("words"))


def word_pieces(batch: pa.RecordBatch, at: int, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about ``most`` items in its array column; a longer row is a piece of its own."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def looked_up(rows: DataFrame, words: str, entries: DataFrame, out: str, most: int = 100_000) -> DataFrame:
    """Adds ``out``: for each word of an array column its value in ``entries`` (token, value), null where it has none.

    The dictionary is small by contract (more than ``most`` entries are an error) and travels with the job; rows stay
    where they are and whole, so nothing is shuffled and no text is lost. Batches are looked up at once, by hash.
    """
    known = entries.limit(most + 1).toArrow()
    if known.num_rows > most:
        raise ValueError(f"more than {most} entries in the dictionary")
    tokens, values = (known.column(i).combine_chunks() for i in range(2))
    kind = T.ArrayType(entries.schema.fields[1].dataType)
    at = rows.columns.index(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for b in batches for piece in word_pieces(b, at)):
            column = batch.column(at)
            flat = column.flatten()
            found = values.take(pc.index_in(flat, value_set=tokens.cast(flat.type)))
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, found)], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, kind)]))


def bag_of_words(rows: DataFrame, vocab: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., rank, count) for words of the vocabulary; ``rows`` are ``word_rows``. Counted inside each row."""
    ranked = looked_up(rows, "words", vocab.select("token", "rank"), "ranks")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for b in batches for piece in word_pieces(b, len(keys))):
            column = batch.column(len(keys))
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = column.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            pairs, counts = np.unique(row << 32 | ranks.astype(np.int64), return_counts=True)  # one number a pair
            picked = pa.array(pairs >> 32)
            yield pa.RecordBatch.from_arrays([*(c.take(picked) for c in batch.columns[: len(keys)]), pa.array(pairs & 0xFFFFFFFF, pa.int32()), pa.array(counts, pa.int64())], names=[*keys, "rank", "count"])

    known = ranked.select(*keys, F.array_compact("ranks").alias("ranks"))
    fields = [*rows.select(*keys).schema.fields, T.StructField("rank", T.IntegerType()), T.StructField("count", T.LongType())]
    return known.mapInArrow(count, T.StructType(fields))


def encode(rows: DataFrame, vocab: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Word ranks in text order, zero-padded at the end to ``width``; longer rows keep their last ``width``.

    ``rows`` are ``word_rows``. Only words inside the vocabulary are kept; ``n_known`` tells how many there were. A text
    without a known word, or without words, is all padding.
    """
    ids = F.array_compact("ranks")
    ranked = looked_up(rows, "words", vocab.select("token", "rank"), "ranks").select(*keys, ids.alias("ids"))
    tail = F.slice("ids", F.greatest(F.size("ids") - width + 1, F.lit(1)), width)
    padded = F.concat(tail, F.array_repeat(F.lit(0), F.greatest(F.lit(width) - F.size("ids"), F.lit(0))))
    return ranked.select(*keys, padded.alias("ids"), F.size("ids").alias("n_known"))


def lookup_lemmas(rows: DataFrame, lemmas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each word replaced by its lemma where the dictionary (form, lemma) has one, in text order; no words, no text."""
    named = looked_up(rows, "words", lemmas.select("form", "lemma"), "lemma")
    return named.select(*keys, F.concat_ws(" ", F.zip_with("words", "lemma", lambda w, lemma: F.coalesce(lemma, w))).alias("lemmas"))


def lexicon_scores(rows: DataFrame, lexicon: DataFrame, keys: Sequence[str], negations: Sequence[str]) -> DataFrame:
    """Word valences of a text; a joined negation flips the sign of the word behind it. A text without words scores 0."""

    def negated(token: Column) -> Column:
        return (F.instr(token, "_") > 0) & F.substring_index(token, "_", 1).isin(*negations)

    def bare(token: Column) -> Column:
        return F.when(negated(token), F.substr(token, F.instr(token, "_") + 1)).otherwise(token)

    signs = F.transform("words", lambda t: F.when(negated(t), -1.0).otherwise(1.0)).alias("signs")
    found = looked_up(rows.select(*keys, F.transform("words", bare).alias("words"), signs), "words", lexicon.select("token", "valence"), "valence")
    v = found.select(*keys, F.zip_with("valence", "signs", lambda x, s: F.coalesce(x, F.lit(0.0)) * s).alias("v"))
    s = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    shares = [F.coalesce(F.try_divide(F.size(F.filter("v", hit)), F.size("v")), F.lit(0.0)).alias(n) for n, hit in (("pos", lambda x: x > 0), ("neg", lambda x: x < 0))]
    return v.select(*keys, *shares, (s / F.sqrt(s * s + 15)).alias("compound"))


def top_words_by_class(tokens: DataFrame, label: str, k: int) -> DataFrame:
    """The k most frequent words of each class; the rank cut is applied before the shuffle to the class."""
    counts = tokens.groupBy(label, "token").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy(label).orderBy(F.col("n").desc(), F.col("token")))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def scored_sentences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sent, score): mean frequency in the document of the sentence's words; 0 without words.

    ``df`` is spread by ``key`` and every step below groups inside it, so nothing is exchanged again.
    """
    parts = df.select(key, F.posexplode(sentences(F.col(text))).alias("sent", "sentence"))
    words = parts.select(key, "sent", F.explode_outer(tokenize(normalize_text(F.col("sentence")))).alias("token"))
    per = words.groupBy(key, "sent", "token").agg(F.count("token").alias("c"))
    tf = F.sum("c").over(W.partitionBy(key, "token"))
    total = F.sum(F.col("c") * F.col("tf"))
    return per.withColumn("tf", tf).groupBy(key, "sent").agg(F.coalesce(F.try_divide(total, F.sum("c")), F.lit(0.0)).alias("score"))


def _best(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.col("score").desc(), F.col("sent")))
    return df.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def summarise(df: DataFrame, key: str, text: str, how: str, chunk: int = 20, per_chunk: int = 2, n: int = 3) -> DataFrame:
    """Extractive summary per document: (key, summary), the chosen sentences in text order.

    ``map_reduce``: best sentences of each run of ``chunk`` sentences, then the best of those.
    ``refine``: chunk by chunk, the summary so far and the chunk's winners compete; a winner counts by the share of its
    words that the summary so far does not say yet, so a later chunk does not repeat an earlier one.
    ``stuff``: the best of the whole document at once.
    A document without sentences has an empty summary. The texts move once, by key; scores, ranks and the final pick-up
    of sentences stay in place.
    """
    placed = place(df.select(key, text), key)
    s = scored_sentences(placed, key, text)
    if how == "stuff":
        chosen = _best(s, [key], n).groupBy(key).agg(F.array_sort(F.collect_list("sent")).alias("pick"))
    else:
        winners = _best(s.withColumn("chunk", F.floor(F.col("sent") / chunk)), [key, "chunk"], per_chunk)
        if how == "map_reduce":
            chosen = _best(winners, [key], n).groupBy(key).agg(F.array_sort(F.collect_list("sent")).alias("pick"))
        elif how == "refine":
            chosen = winners.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk", "sent", "score"))).alias("l"))  # per_chunk items per chunk
        else:
            raise ValueError(f"unknown way to summarise: {how}")
    cut = F.concat_ws(" ", F.transform("pick", lambda i: F.get(F.col("_s"), i)))
    every = placed.withColumn("_s", sentences(F.col(text))).join(chosen, key, "left")
    if how == "refine":
        every = every.withColumn("pick", _refined("l", "_s", n))
    return every.select(key, F.coalesce(cut, F.lit("")).alias("summary"))


def _refined(winners: str, spoken: str, n: int) -> Column:
    """Numbers of the sentences that are left when ``winners`` (chunk, sent, score) are folded into a summary of ``n``."""

    def told(x: Column) -> Column:
        words = F.array_distinct(tokenize(normalize_text(F.get(F.col(spoken), x["sent"]))))
        return F.struct(x["chunk"].alias("chunk"), x["sent"].alias("sent"), x["score"].alias("score"), words.alias("words"))

    def entry(x: Column, share: Column) -> Column:
        return F.struct((-(x["score"] * share)).alias("rank"), x["sent"].alias("sent"), x["words"].alias("words"))

    known = F.transform(winners, told)

    def step(summary: Column, chunk: Column) -> Column:
        said = F.flatten(F.transform(summary, lambda s: s["words"]))

        def fresh(x: Column) -> Column:
            return F.coalesce(F.try_divide(F.size(F.array_except(x["words"], said)).cast("double"), F.size(x["words"])), F.lit(0.0))

        new = F.transform(F.filter(known, lambda x: x["chunk"] == chunk), lambda x: entry(x, fresh(x)))
        return F.slice(F.array_sort(F.concat(summary, new)), 1, n)

    nothing = F.slice(F.transform(known, lambda x: entry(x, F.lit(1.0))), 1, 0)
    kept = F.aggregate(F.array_distinct(F.transform(winners, lambda x: x["chunk"])), nothing, step)
    return F.array_sort(F.transform(kept, lambda s: s["sent"]))


def vector_coverage(vocab: DataFrame, vectors: DataFrame) -> DataFrame:
    """Words of the vocabulary that have a vector; one index is reserved, so the share divides by size + 1."""
    hit = vocab.join(vectors.select("token", F.lit(1).alias("hit")), "token", "left")
    return hit.agg(F.count("hit").alias("covered"), (F.count("*") + 1).alias("size")).withColumn("share", F.col("covered") / F.col("size"))


def max_pool(rows: DataFrame, vectors: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Largest value per dimension over the words of a text that have a vector; null where none has."""
    found = looked_up(rows, "words", vectors.select("token", "vector"), "vectors").select(*keys, F.array_compact("vectors").alias("vectors"))
    pooled = F.array(*[F.array_max(F.transform("vectors", lambda v: F.get(v, F.lit(i)))) for i in range(width)])
    return found.select(*keys, F.when(F.size("vectors") > 0, pooled).alias("pooled"))
