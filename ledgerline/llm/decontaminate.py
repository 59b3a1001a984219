"""Benchmark items found in documents by their templates, with other numbers, names or units too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

NAME, NUMBER, UNIT, OPENER, LAST = "\u0001", "\u0002", "\u0003", "\u0004", "\u0005"
UNITS = "km|cm|mm|metres?|meters?|miles?|inch(?:es)?|feet|kg|mg|grams?|pounds?|litres?|liters?|ml|mph|kmh|seconds?|minutes?|hours?|days?|weeks?|months?|years?|percent|dollars?|euros?|cents?|degrees?"
END = r"(?![\p{L}\p{N}])"


def typed_tokens(text: Column, openers: bool = False) -> Column:
    """Words in lower case; names, numbers and units keep their value behind a mark of their type.

    A name is a capitalised word, a number stands alone, a unit follows a number. With ``openers`` a capitalised word
    has a mark of its own unless the text shows it capitalised within a sentence: it may be a name or not.
    """
    marked = text
    if openers:
        marked = F.regexp_replace(marked, r"\p{Lu}(?<=[^.!?:\s]\s.)[\p{L}\p{N}]*", f"{NAME}$0")
    marked = F.regexp_replace(marked, rf"\p{{Lu}}(?<![\p{{L}}\p{{N}}{NAME}].)[\p{{L}}\p{{N}}]*", f"{OPENER if openers else NAME}$0")
    marked = F.regexp_replace(marked, r"(?<![\p{L}\p{N}.,])\d+(?:[.,]\d+)*" + END, f"{NUMBER}$0")
    marked = F.regexp_replace(F.lower(marked), rf"({NUMBER}[\d.,]*\d) ?({UNITS})" + END, f"$1 {UNIT}$2")
    return F.regexp_extract_all(marked, F.lit(rf"{NUMBER}\d+(?:[.,]\d+)*|[{NAME}{UNIT}{OPENER}]?[\p{{L}}\p{{N}}]+"), F.lit(0))


def value(token: Column) -> Column:
    """The word without its mark."""
    return F.when(token < LAST, F.substring(token, 2, 2**31 - 1)).otherwise(token)


def template(tokens: Column) -> Column:
    """Values out, marks stay."""
    return F.transform(tokens, lambda t: F.when(t < LAST, F.translate(F.substring(t, 1, 1), OPENER, NAME)).otherwise(t))


def hashes(words: Column) -> Column:
    return F.transform(words, lambda t: F.xxhash64(t))


def window_hashes(h: Column, width: Column) -> Column:
    """At each word hash that of the window which begins there; null where too few words are left."""
    return F.transform(h, lambda _, i: F.when(i + width <= F.size(h), F.xxhash64(F.slice(h, i + 1, width))))


def item_windows(items: DataFrame, item_col: str, text_col: str, width: int, plain_words: int) -> DataFrame:
    """One row an item: its tokens, the positions of the windows looked up and their hashes."""
    b = once(items.select(F.col(item_col).alias("item_id"), typed_tokens(F.col(text_col), openers=True).alias("b_tokens")), "b_tokens")
    b = once(b.withColumn("names", F.transform("b_tokens", lambda t: F.concat(F.lit(NAME), value(t)))), "names")
    named = F.transform("b_tokens", lambda t, i: F.when(t.startswith(OPENER) & F.array_contains("b_tokens", F.get("names", i)), F.get("names", i)).otherwise(t))
    b = b.select("item_id", named.alias("b_tokens")).where(F.size("b_tokens") > 0).dropDuplicates(["item_id", "b_tokens"])
    b = b.withColumn("b_key", F.xxhash64("item_id", "b_tokens")).withColumn("b_width", F.least(F.size("b_tokens"), F.lit(width)))
    starts = F.sequence(F.lit(0), F.size("b_tokens") - F.col("b_width"))
    steps = {
        "ht": hashes(template(F.col("b_tokens"))),
        "hp": hashes(F.transform("b_tokens", value)),
        "wt": window_hashes(F.col("ht"), F.col("b_width")),
        "wp": window_hashes(F.col("hp"), F.col("b_width")),
        "plain": F.transform(starts, lambda i: F.size(F.filter(F.slice("b_tokens", i + 1, F.col("b_width")), lambda t: t >= LAST))),
        "most": F.array_max("plain"),
        "told": F.filter(starts, lambda i: (F.col("most") < plain_words // 2) | (F.get("plain", i) >= F.least("most", F.lit(plain_words)))),
        "looked": F.filter(starts, lambda i: F.array_contains("told", i) | (F.get("plain", i) >= plain_words // 2)),
        "windows": F.transform("looked", lambda i: F.struct(i.alias("b_pos"), F.array_contains("told", i).alias("counts"), F.array_distinct(F.when(F.col("most") < plain_words // 2, F.array(F.get("wp", i))).otherwise(F.array(F.get("wt", i), F.get("wp", i)))).alias("ws"))),
        "b_reach": F.size(covered(F.col("told"), F.col("b_width"))),
    }
    for name, step in steps.items():
        b = once(b.withColumn(name, step), name)
    step = F.greatest(F.lit(4), F.floor(F.size("b_tokens") / 4)).cast("int")
    return b.select("item_id", "b_key", "b_tokens", "b_width", "b_reach", "windows", step.alias("b_step"), (F.col("most") < plain_words).alias("weak"))


def covered(starts: Column, width: Column) -> Column:
    """The positions that windows of these starts hold, each once."""
    return F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + width - 1))))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 8, least: float = 0.5, plain_words: int = 4, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, text_hash, item_id, coverage, n_slots, n_changed): documents that hold an item's template.

    Windows of ``width`` tokens are looked up twice: as templates, and word by word in lower case, so that copies are
    met whatever their case. An item is found at a place where the windows met hold at least ``least`` of its tokens
    (``coverage``) and the slots in them are consistent: each value that the item repeats is one value in the document
    too. A place is a band of offsets as wide as a quarter of the item, 4 at least, so words put in or left out, or
    a value of more words, only cost the windows across them. Every place is tested, the best consistent one counts.
    ``n_changed`` counts slots with another value: above 0 the question was re-parameterised. Words that open a sentence
    may have any value, unless the item shows them as names.

    Windows with fewer than ``plain_words`` ordinary words say too little to count: with half as many they only show
    further slots of a place. Where an item has none better, its best ones count and all of them must be met; below half
    of ``plain_words`` only with the item's own values. An item of fewer than ``width`` tokens is one window.

    Null or empty texts hold nothing. Rows repeated with one id and text are one; rows with one id and other texts are
    told apart by ``text_hash``; a null id is a value like any other. Empty tables give none.

    Item windows are broadcast while they are few, joined by hash beyond. Texts are read again only for the documents
    found, by a join on their ids whose side Spark broadcasts while it is small.
    """
    b = Scratch(docs.sparkSession, "leaks").write(item_windows(items, item_col, item_text_col, width, plain_words), "items")
    keyed = b.select("b_key", "b_step", F.explode("windows").alias("x")).select("b_key", "b_step", "x.b_pos", "x.counts", F.explode("x.ws").alias("w"))
    if keyed.count() <= broadcast_rows:
        keyed = F.broadcast(keyed)
    widths = [width, *sorted(r[0] for r in b.where(F.col("b_width") < width).select("b_width").distinct().collect())]

    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    seen = once(texts.select("doc_id", "text_hash", typed_tokens(F.col("text")).alias("tokens")), "tokens")
    seen = seen.select("doc_id", "text_hash", hashes(template(F.col("tokens"))).alias("ht"), hashes(F.transform("tokens", value)).alias("hp"))
    seen = once(once(seen, "ht"), "hp")
    windows = []
    for n in widths:
        windows += [F.col(f"t{n}"), F.zip_with(f"p{n}", f"t{n}", lambda p, t: F.when(p != t, p))]
        seen = once(seen.withColumn(f"t{n}", window_hashes(F.col("ht"), F.lit(n))), f"t{n}")
        seen = seen.withColumn(f"p{n}", window_hashes(F.col("hp"), F.lit(n)))
    seen = once(seen.withColumn("ws", F.concat(*windows)), "ws")
    seen = seen.select("doc_id", "text_hash", F.size("ht").alias("n"), F.posexplode("ws").alias("at", "w")).where("w is not null")
    off = F.col("at") % F.col("n") - F.col("b_pos")
    met = seen.join(keyed, "w").select("doc_id", "text_hash", "b_key", "b_step", "b_pos", "counts", off.alias("off"))
    # Bands overlap by half: offsets less than a step apart are together in one.
    band = F.floor(F.col("off") / F.col("b_step"))
    met = met.withColumn("band", F.explode(F.array(band, band - 1)))
    # A document that repeats an item has bands for each place, so a group never holds more than an item's windows at the offsets of a band.
    met = met.groupBy("doc_id", "text_hash", "b_key", "band").agg(F.collect_set(F.struct("b_pos", "off", "counts")).alias("hits"))
    met = met.join(b.drop("windows", "b_step"), "b_key")
    met = met.withColumn("coverage", F.size(covered(F.transform(F.filter("hits", lambda x: x["counts"]), lambda x: x["b_pos"]), F.col("b_width"))) / F.col("b_reach"))
    met = met.where(F.col("coverage") >= F.when(F.col("weak"), 1.0).otherwise(F.lit(least)))
    # Where windows of several offsets hold a slot, the offset with most windows in the band tells its word.
    often = F.reverse(F.array_sort(F.transform(F.array_distinct("hits.off"), lambda o: F.struct(F.size(F.filter("hits", lambda x: x["off"] == o)).alias("n"), (-o).alias("back"), o.alias("off")))))
    met = once(met.withColumn("often", often), "often")
    holds = lambda i, o: F.exists("hits", lambda x: (x["off"] == o) & (x["b_pos"] <= i) & (i < x["b_pos"] + F.col("b_width")))
    slots = F.filter(F.sequence(F.lit(0), F.size("b_tokens") - 1), lambda i: F.get("b_tokens", i) < LAST)
    placed = F.transform(slots, lambda i: F.struct(F.get("b_tokens", i).alias("b"), (i + F.get(F.filter("often", lambda o: holds(i, o["off"])), F.lit(0))["off"]).alias("p")))
    met = once(met.withColumn("placed", placed), "placed")
    spots = met.select("doc_id", "text_hash", F.struct("item_id", "coverage", F.filter("placed", lambda s: s["p"].isNotNull()).alias("slots")).alias("spot"))
    spots = spots.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("th")).agg(F.collect_set("spot").alias("spots"))
    wide = texts.join(spots, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("th")))
    wide = once(wide.select("doc_id", "text_hash", "spots", typed_tokens(F.col("text")).alias("tokens")), "tokens")
    filled = F.transform("spots", lambda s: F.struct(s["item_id"].alias("item_id"), s["coverage"].alias("coverage"), F.transform(s["slots"], lambda x: F.struct(x["b"].alias("b"), value(F.get("tokens", x["p"])).alias("d"))).alias("slots")))
    wide = wide.select("doc_id", "text_hash", F.explode(filled).alias("spot")).select("doc_id", "text_hash", "spot.*")
    told = F.filter("slots", lambda s: ~s["b"].startswith(OPENER))
    values = F.size(F.array_distinct(F.transform(told, lambda s: s["b"])))
    pairs = F.size(F.array_distinct(F.transform(told, lambda s: F.concat(s["b"], F.lit(LAST), s["d"]))))
    changed = F.size(F.filter("slots", lambda s: value(s["b"]) != s["d"]))
    out = wide.where(values == pairs).groupBy("doc_id", "text_hash", "item_id").agg(F.max_by(F.struct("coverage", F.size("slots").alias("n_slots"), changed.alias("n_changed")), F.struct("coverage", -changed)).alias("best"))
    return out.select("doc_id", "text_hash", "item_id", "best.coverage", F.col("best.n_slots").cast("long").alias("n_slots"), F.col("best.n_changed").cast("long").alias("n_changed"))


def once(df: DataFrame, column: str) -> DataFrame:
    """``column`` behind a one-row explode: later steps read its value and do not spell out its expression again."""
    return df.withColumn(column, F.explode(F.array(column)))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` less the documents that hold an item; columns are unchanged."""
    found = find_leaks(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash")).distinct()
    same = docs[id_col].eqNullSafe(found["leak_id"]) & (F.xxhash64(docs[text_col]) == found["leak_hash"])
    return docs.join(found, same, "left_anti")
