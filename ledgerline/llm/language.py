"""Languages of texts by a bidirectional gated recurrent network over bytes that labels every position."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces

WIDTH = 128  # bytes of a stretch: the network starts anew in each, in both directions
UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double"


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4; rows where it is 2 are held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4


@dataclass
class Network:
    """Weights for both directions (first axis): forwards, backwards.

    The first axis of ``table`` and ``recur`` are the gates: update, reset, candidate. An input is a byte, so its weights
    are a row of ``table``, biases included. All that a step touches lies in one stretch of memory, gate by gate.
    """

    langs: list[str]
    table: np.ndarray  # 3, 512, H: bytes read forwards, then bytes read backwards
    recur: np.ndarray  # 3, 2, H, H
    held: np.ndarray  # 2, 1, H: bias of the candidate's recurrent part
    out: np.ndarray  # 2, H, L
    bias: np.ndarray  # L

    @classmethod
    def drawn(cls, langs: list[str], hidden: int, rng: np.random.Generator) -> Network:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        n = len(langs)
        return cls(langs, normal(3, 512, hidden, scale=0.3), normal(3, 2, hidden, hidden, scale=hidden**-0.5), np.zeros((2, 1, hidden), np.float32), normal(2, hidden, n, scale=hidden**-0.5), np.zeros(n, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.recur, self.held, self.out, self.bias]

    def states(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Hidden states (2, T, B, H) by position of stretches ``x`` (B, T); ``trace`` collects what learning needs."""
        size, width = x.shape
        both = np.stack([x.T, x.T[::-1] + 256], 1)  # T, 2, B: what each direction reads at each step
        h = np.zeros((2, size, self.recur.shape[-1]), np.float32)
        found = np.empty((2, width, *h.shape[1:]), np.float32)
        for t in range(width):
            sums, carried = np.take(self.table, both[t], 1), h @ self.recur
            gates = sums[:2]
            gates += carried[:2]
            gates *= 0.5
            np.tanh(gates, out=gates)  # a logistic function is a stretched tanh
            gates += 1
            gates *= 0.5
            inner, new = carried[2], sums[2]
            inner += self.held
            new += gates[1] * inner
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((h, gates, inner, new))
            h = h - new
            h *= gates[0]
            h += new
            found[0, t], found[1, width - 1 - t] = h[0], h[1]
        return found

    def probabilities(self, found: np.ndarray) -> np.ndarray:
        """Probabilities (T, B, L) of the languages at each position."""
        logit = found[0] @ self.out[0] + found[1] @ self.out[1] + self.bias
        logit -= logit.max(-1, keepdims=True)
        np.exp(logit, out=logit)
        logit /= logit.sum(-1, keepdims=True)
        return logit

    def pooled(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sums (B, L) of the probabilities over the first ``sizes`` positions of each stretch."""
        p = self.probabilities(self.states(x))
        p *= (np.arange(x.shape[1])[:, None] < sizes)[..., None]
        return p.sum(0)

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss of the positions and its gradients, by backpropagation through time."""
        size, width = x.shape
        trace: list = []
        found = self.states(x, trace)
        p = self.probabilities(found)
        mask = (np.arange(width)[:, None] < sizes)[..., None].astype(np.float32)
        total = float(mask.sum()) or 1.0
        steps, rows = np.arange(width)[:, None], np.arange(size)[None, :]
        loss = -float((np.log(p[steps, rows, y] + 1e-9) * mask[..., 0]).sum()) / total
        p[steps, rows, y] -= 1
        p *= mask / total
        d_out = np.stack([np.tensordot(found[k], p, ([0, 1], [0, 1])) for k in (0, 1)])
        d_found = np.stack([p @ self.out[k].T for k in (0, 1)])
        d_found[1] = d_found[1][::-1].copy()  # in the order of the steps
        hidden = self.recur.shape[-1]
        d_recur, d_held, d_read = np.zeros_like(self.recur), np.zeros_like(self.held), np.empty((width, 3, 2, size, hidden), np.float32)
        flow = np.zeros((2, size, hidden), np.float32)
        back = self.recur.transpose(0, 1, 3, 2)
        for t in range(width - 1, -1, -1):
            before, gates, inner, new = trace[t]
            update, reset = gates
            flow = flow + d_found[:, t]
            d_sums = d_read[t]
            d_sums[2] = flow * (1 - update) * (1 - new * new)
            d_sums[0] = flow * (before - new) * update * (1 - update)
            d_sums[1] = d_sums[2] * inner * reset * (1 - reset)
            d_carried = d_sums.copy()
            d_carried[2] *= reset
            d_recur += before.transpose(0, 2, 1) @ d_carried
            d_held += d_carried[2].sum(1, keepdims=True)
            flow = flow * update + (d_carried @ back).sum(0)
        both = np.stack([x.T, x.T[::-1] + 256], 1).ravel()
        order = np.argsort(both, kind="stable")
        starts = np.flatnonzero(np.diff(both[order], prepend=-1))
        d_table = np.zeros_like(self.table)
        for k in range(3):
            d_table[k, both[order][starts]] = np.add.reduceat(d_read[:, k].reshape(-1, hidden)[order], starts)
        return loss, [d_table, d_recur, d_held, d_out, p.sum((0, 1))]


def stretches(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all texts as rows of ``width`` (the last of a text padded with zeros), their sizes, rows of each text."""
    counts = np.array([-(-len(t) // width) for t in texts], np.int64)
    rows = int(counts.sum())
    data = b"".join(t.ljust(int(n) * width, b"\0") for t, n in zip(texts, counts, strict=True))
    x = np.frombuffer(data, np.uint8).reshape(rows, width)
    sizes = np.full(rows, width, np.int64)
    full = counts > 0
    sizes[np.cumsum(counts)[full] - 1] = np.array([(len(t) - 1) % width + 1 for t in texts if t], np.int64)
    return x, sizes, counts


def plain(text: str) -> bytes:
    """What the network reads: lower case in UTF-8; lone surrogates as question marks."""
    return text.lower().encode("utf-8", "replace")


def fit(langs: list[str], x: np.ndarray, sizes: np.ndarray, y: np.ndarray, hidden: int = 8, epochs: int = 10, batch: int = 128, rate: float = 0.02) -> Network:
    """Adam on shuffled batches of stretches with a falling rate; gradients are cut at a norm of 1."""
    rng = np.random.default_rng(11)
    net = Network.drawn(langs, hidden, rng)
    if len(langs) < 2:
        return net
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    step, last = 0, epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            at = order[i : i + batch]
            _, grads = net.gradients(x[at].astype(np.int64), sizes[at], y[at])
            step += 1
            cut = min(1.0, 1.0 / (np.sqrt(sum(float((g * g).sum()) for g in grads)) + 1e-9))
            now = rate * (1 - step / (last + 1))
            for w, g, (m, v) in zip(net.weights(), grads, moments, strict=True):
                g = g * cut
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 2400, per_text: int = 2, most_langs: int = 500) -> Network:
    """Learn from a bounded sample of rows that are not held out: about ``sample`` texts in all, as many of each language.

    Of each text that a hash of its id picks, ``per_text`` stretches at places drawn from that hash teach; only these
    leave the executors, at most about a megabyte in all. Rows without id, text or language teach nothing. Without any
    language, the network is empty and every prediction is ``und``. More than ``most_langs`` languages are an error.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("id is not null and lang is not null").where(F.col("text").rlike("\\p{L}") & (remainder(F.col("id")) != 2))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(most_langs + 1).collect()}
    if len(counts) > most_langs:
        raise ValueError(f"more than {most_langs} languages")
    langs = sorted(counts)
    if not langs:
        return Network.drawn([], 1, np.random.default_rng(0))
    rate = F.coalesce(*[F.when(F.col("lang") == k, F.lit(sample / len(langs) / counts[k])) for k in langs])
    picked = rows.where(F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 20)) < rate * (1 << 20))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text, lang in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                data, seed = plain(text), xxhash.xxh64_intdigest(str(i))
                for k in range(per_text):
                    at = xxhash.xxh64_intdigest(str(k), seed=seed) % max(1, len(data) - WIDTH + 1)
                    out.append((i, k, lang, data[at : at + WIDTH]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["id", "nth", "lang", "data"])

    got = picked.mapInArrow(draw, "id long, nth long, lang string, data binary").toArrow().sort_by([("id", "ascending"), ("nth", "ascending"), ("lang", "ascending"), ("data", "ascending")])
    if got.num_rows == 0:
        return Network.drawn([], 1, np.random.default_rng(0))
    x, sizes, _ = stretches(got.column("data").to_pylist())
    number = {k: i for i, k in enumerate(langs)}
    return fit(langs, x, sizes, np.array([number[k] for k in got.column("lang").to_pylist()]))


def predict(net: Network, texts: list[str | None], rows: int = 1024) -> tuple[list[str], list[float]]:
    """Language and its mean probability over all positions of each whole text; ``und`` and 0 for null."""
    read = [plain(t) if t else b"" for t in texts]
    if not net.langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    x, sizes, counts = stretches(read)
    sums = np.concatenate([np.zeros((0, len(net.langs))), *(net.pooled(x[i : i + rows].astype(np.int64), sizes[i : i + rows]) for i in range(0, len(x), rows))])
    ends = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(sums, 0, dtype=np.float64)])
    stops = np.cumsum(counts)
    total = ends[stops] - ends[stops - counts]
    best = total.argmax(1)
    score = total[np.arange(len(texts)), best] / np.maximum(1, [len(t) for t in read])
    return [net.langs[b] if t else UNKNOWN for b, t in zip(best, read, strict=True)], [min(1.0, max(0.0, s)) if t else 0.0 for s, t in zip(score.tolist(), read, strict=True)]


def identify_language(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every document.

    Whole texts are read: every byte lies in one stretch of 128, the network labels each position in both directions,
    and the text's language has the largest mean probability (ties: the first in order). A null text, an empty one or
    one without a letter is ``und`` with score 0; a network that learnt no language says ``und`` always. Repeated rows
    are predicted each for itself, null ids too; other columns do not matter; an empty table gives an empty one.
    Nothing is shuffled; a task holds one piece of a batch (4 MB of texts or one longer text) and 1024 stretches' states.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                langs, scores = predict(shared.value, batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    lettered = F.when(F.col(text_col).rlike("\\p{L}"), F.col(text_col)).alias("text")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), lettered).mapInArrow(run, SCHEMA)
