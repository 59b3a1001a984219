"""Secrets in texts, all rules in one pass of one automaton."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import RESET, Automaton
from .common import pieces

#: (kind, pattern, least length of the group named, or of the whole match). Order decides ties at one start.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),  # shorter runs are dropped anyhow; runs are maximal, so the bound may stand here
)
#: Further kinds of public token formats; they only add spans.
ADDED = (
    ("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("pem", r"-----BEGIN [A-Z ]+-----", 0, 20),
)
END = bytes([RESET])
SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,stop:long>>"


def automaton(rules: tuple) -> Automaton:
    return Automaton([r[1] for r in rules])


def spans_of(machine: Automaton, texts: list[bytes], rules: tuple) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, stop) in code points of each UTF-8 text, by start, then kind as listed."""
    data = b"".join(t + END for t in texts)
    exact = [re.compile(r[1]) for r in rules]
    raw = np.frombuffer(data, np.uint8)
    stops = np.cumsum([len(t) + 1 for t in texts])
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    last: dict[tuple[int, int], int] = {}
    where, what = machine.ends(raw) if len(raw) else ((), ())
    for end, bits in zip(map(int, where), map(int, what), strict=True):
        doc = int(np.searchsorted(stops, end, side="right"))
        base = int(stops[doc - 1]) if doc else 0
        for i, (kind, _, group, least) in enumerate(rules):
            if bits >> i & 1:
                start = machine.start_of(i, data, end, max(base, last.get((doc, i), 0)))
                last[doc, i] = end  # a match that fails below has used up its bytes all the same
                span = data[start:end].decode("ascii")
                if len(exact[i].fullmatch(span)[group]) >= least:
                    out[doc].append((kind, start - base, end - base))
    rank = {r[0]: i for i, r in enumerate(rules)}
    for doc, found in enumerate(out):
        if found:
            text = np.frombuffer(texts[doc], np.uint8)
            points = np.cumsum((text & 0xC0) != 0x80)  # code points up to and with each byte
            found = [(k, int(points[a]) - 1, int(points[b - 1])) for k, a, b in found]
            out[doc] = sorted(found, key=lambda s: (s[1], rank[s[0]]))
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple = BASE + ADDED) -> DataFrame:
    """(doc_id, spans): every text's matches, leftmost and without overlap within each kind; stop is exclusive.

    Whole texts are read as bytes. A null or empty text has no spans; repeated rows are scanned each for itself; an
    empty table gives an empty one. Nothing is shuffled: a task holds one piece of a batch at a time. The automaton is
    built once and broadcast; its size depends on the rules alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for whole in batches:
            for batch in pieces(whole, "text"):
                texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
                found = [[{"kind": k, "start": a, "stop": b} for k, a, b in s] for s in spans_of(shared.value, texts, rules)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
