"""Lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

STRIP = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """Stripped of blanks at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(STRIP)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text_col`` less its shared lines, plus ``n_lines`` (before) and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses all its lines, except in
    the document with the largest id. Other lines stay as they are, joined by ``\\n``.

    A null or empty text is one empty line. Rows of one id count as one document; rows that share the largest id
    all keep the line. A null id is not counted and never keeps a shared line. An empty table gives an empty one. Other columns pass through; the two new columns replace input columns of their names.

    Lines are known by two 64-bit hashes, so only fixed-width rows are counted and joined: a line in a third of all
    documents is first made distinct by line and id, then one row per task after the partial count. Texts move once, to meet the positions they lose.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # Names of this step's own columns cannot clash: the input travels as one struct.
    rows = docs.select(F.struct(*own).alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = rows.select("id", F.xxhash64("text").alias("th"), F.transform(F.split("text", "\n", -1), line_key).alias("keys"))

    def hashes(key: Column) -> list[Column]:
        return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]

    found = lines.select("id", F.explode(F.array_distinct(F.filter("keys", lambda k: F.char_length(k) >= min_chars))).alias("key")).select("id", *hashes(F.col("key")))
    shared = found.groupBy("h1", "h2").agg(F.count_distinct("id").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs).drop("n")
    placed = lines.select("id", "th", F.posexplode("keys").alias("pos", "key")).where(F.char_length("key") >= min_chars).select("id", "th", "pos", *hashes(F.col("key")))
    lost = placed.join(shared, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
    lost = lost.groupBy(F.col("id").alias("lost_id"), F.col("th").alias("lost_th")).agg(F.collect_set("pos").alias("gone"))
    met = rows.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.xxhash64("text") == F.col("lost_th")), "left")
    cut = met.select("row", F.split("text", "\n", -1).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda p: F.get("lines", p))
    cut = cut.select("row", F.array_join(kept, "\n").alias("kept"), F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"))
    return cut.select(*[(F.col("kept") if c == text_col else F.col("row").getField(c)).alias(c) for c in own], "n_lines", "n_dropped")
