"""Text preparation as column expressions and token tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[ \t\n\r\f\x0B]+"

# The placeholder for an empty text and the words that negate the next one.
NO_TEXT = "no_review"
NEGATIONS = ("not", "never", "no", "nobody", "none", "nothing", "nowhere", "neither", "nor")

# A starter dictionary of contractions; users pass their own.
CONTRACTIONS = {
    "can't": "cannot",
    "won't": "will not",
    "shan't": "shall not",
    "it's": "it is",
    "let's": "let us",
    "i'm": "i am",
    "n't": " not",
    "'re": " are",
    "'ve": " have",
    "'ll": " will",
    "'d": " would",
}

# A starter list of function words in the four languages of the texts; users pass their own.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "had", "has", "have", "he", "her", "his",
    "i", "if", "in", "is", "it", "its", "me", "my", "of", "on", "or", "our", "she", "so", "that", "the", "their",
    "them", "they", "this", "to", "was", "we", "were", "will", "with", "you", "your",
    "au", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "ou", "par", "pas",
    "pour", "que", "qui", "sur", "un", "une",
    "aber", "auf", "das", "dem", "den", "der", "die", "ein", "eine", "er", "es", "ist", "mit", "nicht", "sie", "und",
    "von", "zu",
    "al", "con", "del", "el", "los", "por", "se", "su", "una", "y",
)


def expand_contractions(text: Column, table: Mapping[str, str] = CONTRACTIONS) -> Column:
    """Replace in the order of the dictionary, ignoring case; suffix entries attach to any word."""
    for short, long in table.items():
        start = "" if short.startswith("'") or short.startswith("n'") else r"\b"
        text = F.regexp_replace(text, f"(?i){start}{short}\\b", long)
    return text


def normalize_text(text: Column) -> Column:
    """Placeholder for nothing, no links or emoji, lower case, letters and spaces only."""
    known = F.when(text.isNull() | (text == ""), F.lit(NO_TEXT)).otherwise(text)
    bare = F.regexp_replace(known, r"http\S+|www\S+|[\x{1F600}-\x{1F64F}]", "")
    return F.regexp_replace(F.lower(bare), r"[^a-z \t\n\r\f\x0B]", "")


def one_spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE, " "))


def join_negations(text: Column) -> Column:
    """``not good`` becomes ``not_good``, greedily from the left, on single-spaced text.

    One linear scan: each match takes the following word with it, so ``not no good`` gives ``not_no good``.
    """
    words = "|".join(NEGATIONS)
    return F.regexp_replace(text, f"(^| )({words}) ([^ ]+)", "$1$2_$3")


def tokenize(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda t: t != "")


def drop_stop_words(tokens: Column, words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*words))


def prepared(text: Column) -> Column:
    """Normalised tokens with negations joined and stop words removed."""
    return drop_stop_words(tokenize(join_negations(one_spaced(normalize_text(text)))))


def prepared_text(text: Column) -> Column:
    """The prepared tokens as one string; the placeholder when nothing is left."""
    tokens = prepared(text)
    return F.when(F.size(tokens) > 0, F.concat_ws(" ", tokens)).otherwise(F.lit(NO_TEXT))


def token_table(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys..., pos, token), one row per normalised word."""
    return df.select(*keys, F.posexplode(tokenize(normalize_text(F.col(text)))).alias("pos", "token"))


def rating_label(rating: Column) -> Column:
    """1 and 2 are negative (0), 3 is neutral (2), 4 and 5 are positive (1), anything else is unknown."""
    return F.when(rating.isin(1, 2), 0).when(rating == 3, 2).when(rating.isin(4, 5), 1)


def sentences(text: Column) -> Column:
    """Cut after ., ! or ? followed by white space."""
    marked = F.regexp_replace(text, f"([.!?]){SPACE}", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: F.trim(s) != "")


def chunks(df: DataFrame, keys: Sequence[str], text: str, size: int, overlap: int = 0) -> DataFrame:
    """(keys..., chunk, body): the whole text cut into pieces of ``size`` characters that overlap."""
    step = size - overlap
    last = F.greatest(F.length(text) - overlap - 1, F.lit(0))
    starts = F.sequence(F.lit(0), F.floor(last / step).cast("int"))
    return df.select(*keys, text, F.explode(starts).alias("chunk")).select(
        *keys, "chunk", F.substring(F.col(text), F.col("chunk") * step + 1, F.lit(size)).alias("body")
    )


def parse_summary(text: Column) -> Column:
    """Struct (main_idea, key_points, conclusion): the text is cut at its headings, each part read by itself.

    The main idea is the rest of its heading's line. Key points are the lines from the first dash up to the conclusion,
    one point a line, dashes taken off. The conclusion is all lines after its heading as one line. Blank lines do not
    count; a missing part is empty.
    """
    parts = F.split(text, r"(?m)^[ \t]*Conclusion:", 2)
    listed = F.regexp_extract(parts[0], r"(?ms)^[ \t]*(- .*)", 1)

    def lines(part: Column) -> Column:
        return F.filter(F.transform(F.split(part, "\n"), lambda s: F.trim(F.regexp_replace(F.trim(s), "^- ", ""))), lambda s: s != "")

    return F.struct(
        F.trim(F.regexp_extract(parts[0], r"(?m)^[ \t]*Main Idea:([^\n]*)", 1)).alias("main_idea"),
        lines(listed).alias("key_points"),
        F.array_join(lines(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))), " ").alias("conclusion"),
    )
