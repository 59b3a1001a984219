"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ProcessPoolExecutor
from dataclasses import dataclass
from multiprocessing import get_context

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, resident

WORD = re.compile(r"[^\W_]+")
BITS = 18
ROW = 64  # tokens that the scan takes in one step of numpy
PIECE = 1 << 20  # bytes of text scored at once: a token takes some 200 bytes meanwhile
SCHEMA = "doc_id long, score double, spans array<struct<start:long,stop:long,p:double>>"


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows where it is 1 are held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def tags(token: str) -> list[str]:
    """What a word says of itself: the word, how it begins, how it ends."""
    return [token, *(f"{n}{token[:n]}" for n in range(3, 7) if len(token) > n), f"-{token[-3:]}"]


def slot(tag: str) -> int:
    return xxhash.xxh64_intdigest(tag) & ((1 << BITS) - 1)


def slots(token: str) -> tuple[list[int], int, int]:
    """Feature numbers of a token itself, as the one before, as the one after."""
    token = token.lower()
    return [slot(t) for t in tags(token)], slot(f"<{token}"), slot(f">{token}")


def mobius(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """r[t] = (a + b * r[t-1]) / (c + d * r[t-1]), r[-1] = 1: all steps of a two-state chain.

    Each step is a 2 x 2 matrix. Rows of ``ROW`` steps are multiplied side by side, the rows' products are chained, and
    a second sweep starts every row from the ratio that reaches it.
    """
    n = len(a)
    rows = -(-n // ROW)
    pad = rows * ROW - n
    a, b, c, d = (np.pad(x, (0, pad), constant_values=v).reshape(rows, ROW) for x, v in ((a, 0.0), (b, 1.0), (c, 1.0), (d, 0.0)))
    # (top, bottom) of r as linear in (1, r): top = p + q r, bottom = s + t r
    p, q, s, t = np.zeros(rows), np.ones(rows), np.ones(rows), np.zeros(rows)
    for k in range(ROW):
        p, q, s, t = a[:, k] * s + b[:, k] * p, a[:, k] * t + b[:, k] * q, c[:, k] * s + d[:, k] * p, c[:, k] * t + d[:, k] * q
        most = np.maximum(np.maximum(p, q), np.maximum(s, t))
        p, q, s, t = p / most, q / most, s / most, t / most
    entry, now = np.empty(rows), 1.0
    for i, (x, y, z, w) in enumerate(zip(p.tolist(), q.tolist(), s.tolist(), t.tolist(), strict=True)):
        entry[i] = now
        now = min(max((x + y * now) / max(z + w * now, 1e-280), 1e-30), 1e30)
    out, now = np.empty((rows, ROW)), entry
    for k in range(ROW):
        now = np.clip((a[:, k] + b[:, k] * now) / (c[:, k] + d[:, k] * now), 1e-30, 1e30)
        out[:, k] = now
    return out.ravel()[:n]


def forward_backward(score: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios (toxic over clean) of the forward and backward messages. ``first`` marks where a sequence begins.

    ``trans`` holds log weights of clean-clean, clean-toxic, toxic-clean, toxic-toxic and of a toxic beginning.
    """
    e = np.exp(np.clip(score, -25, 25))
    t = np.exp(trans)
    one, zero = np.ones_like(e), np.zeros_like(e)
    ahead = mobius(np.where(first, e * t[4], e * t[1]), np.where(first, zero, e * t[3]), np.where(first, one, t[0]), np.where(first, zero, t[2]))
    last = np.append(first[1:], True)
    follow = np.append(e[1:], 1.0)
    back = mobius(*(x[::-1] for x in (np.where(last, one, t[2]), np.where(last, zero, t[3] * follow), np.where(last, one, t[0]), np.where(last, zero, t[1] * follow))))[::-1]
    return ahead, back


@dataclass
class Model:
    weights: np.ndarray  # one for each feature number
    trans: np.ndarray
    bias: float
    document: np.ndarray  # weights of (1, largest logit, log of expected toxic tokens)

    def document_scores(self, logit: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence(logit, sizes) @ self.document, -30, 30)))


def evidence(logit: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each document: 1, its largest logit, the log of its expected number of toxic tokens."""
    out = np.tile([1.0, -20.0, 0.0], (len(sizes), 1))
    full = np.flatnonzero(sizes)
    if len(full):
        at = (np.cumsum(sizes) - sizes)[full]
        out[full, 1] = np.maximum.reduceat(np.clip(logit, -20, 20), at)
        out[full, 2] = np.log1p(np.add.reduceat(1 / (1 + np.exp(-logit)), at))
    return out


class Scorer:
    """Emission scores by token, remembered while a process lasts: 64 bits of hash and three numbers a token, no texts."""

    def __init__(self, model: Model, most: int = 400_000) -> None:
        self.model, self.most = model, most
        self.clear()

    def clear(self) -> None:
        self.known, self.scores = np.empty(0, np.uint64), np.empty((0, 3))

    def look_up(self, tokens: list[str]) -> np.ndarray:
        """Scores of each of some distinct tokens: its own, as the one before, as the one after."""
        if len(self.known) > self.most:
            self.clear()
        key = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
        at = np.searchsorted(self.known, key)
        found = at < len(self.known)
        found[found] = self.known[at[found]] == key[found]
        out = np.empty((len(tokens), 3))
        out[found] = self.scores[at[found]]
        w, new = self.model.weights, np.flatnonzero(~found)
        for i in new.tolist():
            own, before, after = slots(tokens[i])
            out[i] = float(w[own].sum()), w[before], w[after]
        new = new[np.argsort(key[new])]
        self.known = np.insert(self.known, at[new], key[new])
        self.scores = np.insert(self.scores, at[new], out[new], axis=0)
        return out

    def logits(self, tokens: list[str], sizes: np.ndarray) -> np.ndarray:
        """Log odds that each token is toxic, from the marginals of its document's chain."""
        if not tokens:
            return np.empty(0)
        place = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
        at = np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))
        own, before, after = self.look_up(list(place)).T
        first = np.zeros(len(tokens), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        score = own[at] + self.model.bias
        score[1:] += np.where(first[1:], 0.0, before[at[:-1]])
        score[:-1] += np.where(first[1:], 0.0, after[at[1:]])
        ahead, back = forward_backward(score, first, self.model.trans)
        return np.log(ahead) + np.log(back)


def token_labels(docs: list[np.ndarray], of_word: list[list[str]], toxic: np.ndarray) -> list[np.ndarray]:
    """Labelled tokens from labelled documents (arrays of word numbers): in a toxic one, the words that set toxic ones apart.

    A word counts by its best tag that is at least twenty times as frequent in toxic documents; of a document's words,
    those with at least a third of its best support are toxic, so chance words beside a strong one stay clean.
    """
    seen = [Counter(), Counter()]
    for words, y in zip(docs, toxic, strict=True):
        seen[y].update({t for w in np.unique(words).tolist() for t in of_word[w]})
    n = [int((toxic == y).sum()) for y in (0, 1)]
    floor = 3 if n[1] >= 20 else 2
    strong = {t: k for t, k in seen[1].items() if k >= floor and (k + 0.5) / (n[1] + 1) >= 20 * (seen[0][t] + 0.5) / (n[0] + 1)}
    best = np.array([max((strong.get(t, 0) for t in ts), default=0) for ts in of_word], np.int32)
    out = []
    for words, y in zip(docs, toxic, strict=True):
        support = best[words] if y and strong else np.zeros(len(words), np.int32)
        out.append(support >= max(floor, support.max(initial=0) / 3))
    return out


def fit(texts: list[str], toxic: np.ndarray, share: np.ndarray, steps: int = 60, clean_windows: int = 2, window: int = 32) -> Model:
    """Learn from whole documents. ``share``: how many documents each one stands for in the calibration.

    Words are numbered once; a training token is three word numbers (its own and its neighbours'), so a step sums
    features per word and not per token.
    """
    rng = np.random.default_rng(7)
    number: dict[str, int] = {}
    docs = [np.fromiter((number.setdefault(w.lower(), len(number)) for w in WORD.findall(t)), np.int32) for t in texts]
    words = list(number)
    labels = token_labels(docs, [tags(w) for w in words], toxic)
    model = Model(np.zeros(1 << BITS), np.array([0.0, -2.0, 0.0, 0.0, -2.0]), -4.0, np.array([-2.0, 0.2, 0.0]))
    if not any(x.any() for x in labels):
        base = float((share * toxic).sum() / max(share.sum(), 1e-9))
        model.document = np.array([np.log((base + 1e-3) / (1 - base + 1e-3)), 0.0, 0.0])
        return model
    # Training stretches: all with a toxic token, and some of every clean document. -1: no neighbour.
    own, left, right, y, first = [], [], [], [], []
    for doc, marks in zip(docs, labels, strict=True):
        starts = np.arange(0, len(doc), window)
        hit = [s for s in starts if marks[s : s + window].any()]
        rest = [s for s in starts if not marks[s : s + window].any()]
        for s in [*hit, *rng.permutation(rest)[:clean_windows].astype(int)]:
            part = doc[s : s + window]
            own.append(part)
            left.append(np.append(np.int32(-1), part[:-1]))
            right.append(np.append(part[1:], np.int32(-1)))
            y.append(marks[s : s + window])
            first.append(np.arange(len(part)) == 0)
    own, left, right, y, first = (np.concatenate(x) for x in (own, left, right, y, first))
    used, own = np.unique(own, return_inverse=True)
    place = np.full(len(words) + 1, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    own, left, right, y = own.astype(np.int32), place[left], place[right], y.astype(np.float32)
    known = [slots(words[w]) for w in used]
    pad, count = 1 << BITS, len(used)  # pad: a feature that is always zero
    x = np.full((count, max(len(k[0]) for k in known)), pad, np.int32)
    for i, k in enumerate(known):
        x[i, : len(k[0])] = k[0]
    before, after = (np.array([*(k[j] for k in known), pad], np.int32) for j in (1, 2))  # the last one: no neighbour
    weights, moment, speed = (np.zeros(pad + 6) for _ in range(3))
    weights[pad + 1 :] = [model.bias, *model.trans[1:]]
    for step in range(1, steps + 1):
        w = weights[: pad + 1]
        trans = np.concatenate([[0.0], weights[pad + 2 :]])
        score = w[x].sum(1)[own] + w[before][left] + w[after][right] + weights[pad + 1]
        ahead, back = forward_backward(score, first, trans)
        p = ahead * back / (1 + ahead * back)
        # Pairs of neighbours: expected minus seen.
        inner = np.flatnonzero(~first)
        r, b, e = ahead[inner - 1], back[inner], np.exp(np.clip(score[inner], -25, 25))
        t = np.exp(trans)
        joint = np.stack([np.full(len(inner), t[0]), t[1] * e * b, t[2] * r, t[3] * r * e * b])
        joint /= joint.sum(0)
        u, v = y[inner - 1], y[inner]
        seen = np.stack([(1 - u) * (1 - v), (1 - u) * v, u * (1 - v), u * v])
        grad = np.empty_like(weights)
        of_word = np.bincount(own, p - y, count)
        grad[: pad + 1] = np.bincount(x.ravel(), np.repeat(of_word, x.shape[1]), pad + 1)
        for neighbour, feature in ((left, before), (right, after)):
            grad[: pad + 1] += np.bincount(feature, np.bincount(neighbour + 1, p - y, count + 1)[np.append(np.arange(1, count + 1), 0)], pad + 1)
        grad[pad] = 0.0
        grad[pad + 1] = (p - y).sum()
        grad[pad + 2 : pad + 5] = (joint - seen).sum(1)[1:]
        grad[pad + 5] = (p - y)[first].sum()
        grad += 0.05 * weights * (np.arange(len(weights)) < pad)
        moment, speed = 0.9 * moment + 0.1 * grad, 0.99 * speed + 0.01 * grad * grad
        weights -= 0.15 * (moment / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.99**step)) + 1e-6)
    model = Model(weights[:pad].astype(np.float32), np.concatenate([[0.0], weights[pad + 2 :]]), float(weights[pad + 1]), model.document)
    del own, left, right, x, y, weights, moment, speed
    scorer, facts, at = Scorer(model), [], 0
    while at < len(docs):  # some hundred thousand tokens at a time
        stop = at + 1
        while stop < len(docs) and sum(map(len, docs[at : stop + 1])) <= 200_000 and stop - at < 200:
            stop += 1
        sizes = np.array([len(d) for d in docs[at:stop]], np.int64)
        facts.append(evidence(scorer.logits([words[w] for d in docs[at:stop] for w in d.tolist()], sizes), sizes))
        at = stop
    model.document = logistic(np.concatenate(facts), toxic.astype(float), share)
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Newton steps for a weighted logistic regression of a few columns."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w = w - move * min(1.0, 4.0 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-6:
            break
    return w


MODEL = "weights binary, trans array<double>, bias double, document array<double>"


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 3000, most_bytes: int = 32 << 20) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    At most about ``sample`` documents, a third of them toxic where there are so many, chosen and ordered by a hash of
    the id, and of these as many as ``most_bytes`` of whole texts hold. Only their ids are broadcast, so texts are
    filtered where they are scanned; one task fits, and only the model (a megabyte) reaches the driver. An id with
    several labels counts as toxic if one says so; null labels and texts teach nothing. Without labelled texts, or on
    an empty table, every score is the same.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
    known = known.where(F.col("id").isNotNull() & (remainder(F.col("id")) != 1))
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bound = {1: sample // 3, 0: sample - sample // 3}
    rate = F.when(F.col("y") == 1, F.lit(bound[1] / max(1, count.get(1, 0)))).otherwise(F.lit(bound[0] / max(1, count.get(0, 0))))
    order = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 20))
    picked = known.where(order < rate * (1 << 20)).limit(2 * sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") <= most_bytes // 16)
    got = rows.join(F.broadcast(picked), "id").select(order.alias("at"), F.col("id").cast("long").alias("id"), "text", F.col("y").cast("int").alias("y"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fit_sample(batches, count, most_bytes)
        yield pa.RecordBatch.from_pylist([{"weights": model.weights.astype("<f4").tobytes(), "trans": model.trans.tolist(), "bias": float(model.bias), "document": model.document.tolist()}], names_of(MODEL))

    row = got.repartition(1).sortWithinPartitions("at", "id", "text").mapInArrow(learn, MODEL).first()
    if row is None:  # no labelled text: nothing ran
        return fit([], np.zeros(0, int), np.zeros(0))
    return Model(np.frombuffer(row["weights"], "<f4"), np.array(row["trans"]), row["bias"], np.array(row["document"]))


def names_of(ddl: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(n, kinds[k]) for n, k in (field.split(" ") for field in ddl.split(", "))])


def fit_sample(batches: Iterator[pa.RecordBatch], count: dict[int, int], most_bytes: int) -> Model:
    """Fit on (at, id, text, y) as far as ``most_bytes`` go. Copies would outvote other words: one document of each
    smallest five-word hash teaches."""
    text, y, seen, held = [], [], set(), 0
    for batch in batches:
        for t, label in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            words = t.lower().split()
            mark = min((xxhash.xxh64_intdigest(" ".join(words[k : k + 5])) for k in range(max(1, len(words) - 4))), default=0)
            if (mark, label) not in seen and held + len(t) <= most_bytes:
                seen.add((mark, label))
                held += len(t)
                text.append(t)
                y.append(label)
    toxic = np.array(y, int)
    share = np.where(toxic == 1, count.get(1, 0) / max(1, int((toxic == 1).sum())), count.get(0, 0) / max(1, int((toxic == 0).sum())))
    # In a process of its own: what fitting takes goes back to the system, and later tasks of this worker have it.
    resident(("toxicity fit",), lambda: None)  # what an earlier stage has left goes first
    with ProcessPoolExecutor(1, mp_context=get_context("fork")) as apart:
        return apart.submit(fit, text, toxic, share).result()


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", span_from: float = 0.5, carry: bool = False) -> DataFrame:
    """(doc_id, score, spans) of every document; spans are stretches of tokens with a marginal of at least ``span_from``.

    The score is the calibrated chance of the label. Whole texts are one chain each. A null or empty text, or one
    without words, has no spans and the score of no evidence. Repeated rows are scored each for itself; an empty table
    gives an empty one; other columns do not matter. ``carry`` adds the whole input row as ``row``, so a caller that
    filters by score needs no join. Nothing is shuffled; a task holds one piece of a batch at a time.
    """
    key = int(xxhash.xxh32_intdigest(model.weights.tobytes() + model.document.tobytes()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = resident(("toxicity", key), lambda: Scorer(shared.value))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())]))
        for whole in batches:
            if carry:
                row = whole.column(1)
                whole = pa.RecordBatch.from_arrays([whole.column(0), row.field(row.type.get_field_index(text_col)), row], names=["doc_id", "text", "row"])
            for batch in pieces(whole, "text", PIECE):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                words = [WORD.findall(t) for t in texts]
                sizes = np.array([len(w) for w in words], np.int64)
                logit = scorer.logits([w for doc in words for w in doc], sizes)
                scores = scorer.model.document_scores(logit, sizes)
                at, spans = 0, []
                hot = logit >= np.log(span_from / (1 - span_from))
                for text, n in zip(texts, sizes.tolist(), strict=True):
                    spans.append(toxic_spans(text, hot[at : at + n], logit[at : at + n]))
                    at += n
                arrays = [batch.column(0), pa.array(scores), pa.array(spans, kind), *([batch.column(2)] if carry else [])]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "score", "spans", *(["row"] if carry else [])])

    name = F.col(id_col).cast("long").alias("doc_id")
    if carry:
        row = F.struct(*docs.columns).alias("row")
        return docs.select(name, row).mapInArrow(run, f"{SCHEMA}, row {docs.schema.simpleString()}")
    return docs.select(name, F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def toxic_spans(text: str, hot: np.ndarray, logit: np.ndarray) -> list[dict]:
    if not hot.any():
        return []
    out: list[dict] = []
    for i, m in enumerate(WORD.finditer(text)):
        if hot[i]:
            p = float(1 / (1 + np.exp(-logit[i])))
            if i and hot[i - 1]:
                out[-1] = {"start": out[-1]["start"], "stop": m.end(), "p": max(p, out[-1]["p"])}
            else:
                out.append({"start": m.start(), "stop": m.end(), "p": p})
    return out
