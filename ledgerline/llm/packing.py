"""Documents packed into sequences of equal attention cost."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces
from .encoding import encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def capacities(total: int, most: int) -> list[int]:
    """Room for exactly ``total`` ids: full sequences, then one of each power of two in what is left over."""
    rest = total % most
    return [most] * (total // most) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(sizes: list[int], most: int = 2048, linear: float = 1.0, quadratic: float = 1.0 / 1024) -> list[list[tuple[int, int, int, int]]]:
    """Pieces (document, start, length, offset) of each sequence.

    A piece of n ids costs linear * n + quadratic * n * n: its share of the layers and of attention. Whole stretches of
    ``most`` ids are sequences of their own. What is left of each document goes, longest first, to the sequence of
    lowest cost that has room for it. One that fits nowhere is cut over the cheapest sequences with room. Capacities add
    up to the number of ids, so every sequence ends full: at ``most``, or at a power of two that needs no padding.
    """
    out: list[list[tuple[int, int, int, int]]] = []
    tails = []
    for doc, n in enumerate(sizes):
        for start in range(0, n - most + 1, most):
            out.append([(doc, start, most, 0)])
        if n % most:
            tails.append((n % most, doc, n - n % most))
    tails.sort(key=lambda t: (-t[0], t[1]))
    room = capacities(sum(t[0] for t in tails), most)
    first = len(out)
    out.extend([] for _ in room)
    free = list(room)
    # One queue of (cost, sequence) per power of two of free room: a search looks at a dozen queues, not at all sequences.
    queues: list[list[tuple[float, int]]] = [[] for _ in range(most.bit_length() + 1)]
    cost = [0.0] * len(room)

    def enter(s: int) -> None:
        if free[s]:
            heapq.heappush(queues[free[s].bit_length()], (cost[s], s))

    def put(s: int, doc: int, start: int, n: int) -> None:
        out[first + s].append((doc, start, n, room[s] - free[s]))
        free[s] -= n
        cost[s] += linear * n + quadratic * n * n
        enter(s)

    def cheapest(need: int) -> int | None:
        """Takes the cheapest sequence with room for ``need`` out of its queue."""
        best: tuple[float, int, int] | None = None
        low = need.bit_length()
        for b in range(low + 1 if need != 1 << (low - 1) else low, len(queues)):
            if queues[b] and (best is None or queues[b][0] < best[:2]):
                best = (*queues[b][0], b)
        # Sequences whose free room has as many bits as the need may or may not hold it.
        aside = []
        mixed = queues[low]
        while mixed and (best is None or mixed[0] < best[:2]):
            top = heapq.heappop(mixed)
            if free[top[1]] >= need:
                for x in aside:
                    heapq.heappush(mixed, x)
                return top[1]
            aside.append(top)
        for x in aside:
            heapq.heappush(mixed, x)
        if best is None:
            return None
        heapq.heappop(queues[best[2]])
        return best[1]

    for s in range(len(room)):
        enter(s)
    for n, doc, start in tails:
        while n:
            s = cheapest(n)
            if s is None:  # fits nowhere: fill the cheapest that has any room
                s = cheapest(1)
            take = min(n, free[s])
            put(s, doc, start, take)
            start, n = start + take, n - take
    return out


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", most: int = 2048, group_tokens: int = 4_000_000, linear: float = 1.0, quadratic: float = 1.0 / 1024, with_ids: bool = False, remember: int = 10_000_000) -> DataFrame:
    """One row per piece: its document, place, CRC-32 of its ids, sequence and offset; ``ids`` too if asked for.

    A task reads its share of the documents as they come and packs them in groups of about ``group_tokens`` ids, so
    nothing is shuffled and memory is bounded; each group's sequences end full, so groups cost no padding. A sequence's
    number is its task's and its place there: a lost task that runs again gives the same rows. Ids of a null or empty
    text are ``end_id`` alone. Rows that repeat a doc_id are packed each for itself. An empty table gives no rows.
    A worker remembers the ids of at most twice ``remember`` characters of stretches: less memory, more encoding.
    """
    step = np.dtype("<u4").itemsize
    end = np.array([end_id], "<u4").tobytes()

    def pack_group(group: list[tuple[int | None, bytes]], base: int) -> tuple[pa.RecordBatch, int]:
        packed = pack([len(ids) // step for _, ids in group], most, linear, quadratic)
        rows = []
        for k, seq in enumerate(packed):
            for doc, start, n, offset in seq:
                ids = group[doc][1][start * step : (start + n) * step]
                rows.append((group[doc][0], start, n, zlib.crc32(ids), len(group[doc][1]) // step, base + k, offset, ids))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            arrays.append(pa.array([np.frombuffer(x, "<u4").tolist() for x in columns[7]], pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names), len(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base = encoder(tokenizer, most=remember).encode, TaskContext.get().partitionId() << 40
        group: list[tuple[int | None, bytes]] = []
        held = 0
        for whole in batches:
            for batch in pieces(whole, "text"):
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                    group.append((doc_id, ids + end))
                    held += len(ids) // step + 1
                if held >= group_tokens:
                    out, n = pack_group(group, base)
                    yield out
                    group, held, base = [], 0, base + n
        if group:
            yield pack_group(group, base)[0]

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA + (", ids array<long>" if with_ids else ""))
