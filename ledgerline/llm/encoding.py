"""Tokenizer calls that encode each distinct stretch of a text once."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import resident

#: Stretches that may be encoded side by side in one string.
PLAIN = re.compile(r" ?[!-}\w]+")
#: What parts stretches in such a string: each is one id that no plain stretch can yield, whether white space counts or not.
PARTERS = ("\n", " ~ ")
TOGETHER = 400
#: What a byte of UTF-8 is: visible (those of longer characters count, see ``WIDE``), an ASCII letter, a mark that no rule
#: joins to a letter before it (an apostrophe may join), a space, tab or line end.
SEEN, LETTER, MARK, BLANK = 1, 2, 4, 8
KINDS = np.zeros(256, np.uint8)
KINDS[0x21:0x7F] = KINDS[0x80:] = SEEN
KINDS[[i for i in range(128) if chr(i).isalpha()]] |= LETTER
KINDS[list(b"!#$%&*,.:;?")] |= MARK
KINDS[list(b" \t\n\r")] = BLANK
#: White space beyond ASCII by its first byte.
WIDE: dict[int, list[bytes]] = {}
for _c in (chr(i).encode() for i in range(0x80, 0x3001) if chr(i).isspace()):
    WIDE.setdefault(_c[0], []).append(_c)


def cuts(data: np.ndarray) -> np.ndarray:
    """Where a stretch starts, one flag for each byte of UTF-8.

    That is at a blank behind a visible character, behind such a line end if it stands alone, and at a mark behind a
    letter: every rule here parts these, and looks at nothing before the parting.
    """
    kinds = KINDS[data]
    for first, chars in WIDE.items():
        at = np.flatnonzero(data == first)
        for char in chars:
            found = at[at <= len(data) - len(char)]
            for i in range(1, len(char)):
                found = found[data[found + i] == char[i]]
            for i in range(len(char)):
                kinds[found + i] = 0
    out = np.zeros(len(data), bool)
    # By the kinds of two neighbours: a blank behind what is seen (8 and 1), a mark behind a letter (4 and 2).
    out[1:] = (kinds[1:] >> 3) & kinds[:-1] | (kinds[1:] >> 1) & kinds[:-1] & LETTER
    ends = np.flatnonzero(out[:-1] & (data[:-1] == 10)) + 1
    out[ends[kinds[ends] & SEEN != 0]] = True
    return out


class Encoder:
    """ids of whole texts by a ``tokenizers`` file, as unsigned integers of ``dtype``.

    Both files used here part texts at ``cuts``, so a text's ids are those of its stretches in a row. Stretches keep
    their white space and repeat, so each is encoded once while it is remembered. Memory holds two generations of at
    most ``most`` characters; what is used again moves to the newer one. Texts are encoded whole, never cut short.
    """

    def __init__(self, path: str, dtype: str = "<u4", most: int = 10_000_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.most = Tokenizer.from_file(path), dtype, most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.parter, self.part_id = next((p, ids[0]) for p in PARTERS if len(ids := self.ids([p])[0]) == 1)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def data(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, self.dtype).tobytes() for ids in self.ids(texts)]

    def learn(self, new: list[str]) -> None:
        plain, other = [], []
        for p in new:
            (plain if PLAIN.fullmatch(p) else other).append(p)
        groups = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        for group, ids in zip(groups, self.ids([self.parter.join(g) for g in groups]), strict=True):
            array = np.array(ids, self.dtype)
            ends = np.flatnonzero(array == self.part_id)
            if len(ends) != len(group) - 1:
                raise ValueError("the parter is not a boundary of this tokenizer")
            data, size = array.tobytes(), array.itemsize
            starts, stops = [0, *((ends + 1) * size).tolist()], [*(ends * size).tolist(), len(data)]
            self.known.update(zip(group, (data[a:b] for a, b in zip(starts, stops, strict=True)), strict=True))
        for i in range(0, len(other), 10_000):
            part = other[i : i + 10_000]
            self.known.update(zip(part, self.data(part), strict=True))

    def look_up(self, parts: list[str]) -> list[bytes]:
        """The ids of each of some distinct stretches."""
        found = list(map(self.known.get, parts))
        lost = [i for i, d in enumerate(found) if d is None]
        if not lost:
            return found
        missing = [parts[i] for i in lost]
        again = {p: d for p, d in zip(missing, map(self.older.get, missing), strict=True) if d is not None}
        size = sum(map(len, missing))
        if self.held + size > self.most:
            self.known, self.older, self.held = {}, self.known, 0
        self.held += size
        self.known.update(again)
        self.learn([p for p in missing if p not in again])
        for i, p in zip(lost, missing, strict=True):
            found[i] = self.known[p]
        return found

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian bytes; null counts as empty.

        All texts are cut at once and each stretch is looked up once a call; Arrow puts the ids together.
        """
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
        first, size = int(bounds[0]), int(bounds[-1] - bounds[0])
        if not size:
            return [b""] * len(texts)
        data, bounds = data.slice(first, size), bounds - first
        start = cuts(np.frombuffer(data, np.uint8))
        start[bounds[bounds < size]] = True
        # Stretches follow each other without a gap, so they lie in the texts' own buffer.
        places = np.append(np.flatnonzero(start), size)
        flat = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places), data).dictionary_encode()
        ids = self.look_up(flat.dictionary.to_numpy(zero_copy_only=False).tolist())
        joined = pa.array(ids, pa.large_binary()).take(flat.indices)
        _, offsets, data = joined.buffers()
        ends = np.frombuffer(offsets, np.int64, len(joined) + 1, joined.offset * 8)[np.searchsorted(places, bounds)].tolist()
        whole = memoryview(data) if data is not None else memoryview(b"")
        return [bytes(whole[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def encoder(path: str, dtype: str = "<u4", most: int = 10_000_000) -> Encoder:
    """One for each worker process: what one task has encoded, the next need not."""
    return resident(("encoder", path, dtype, most), lambda: Encoder(path, dtype, most))


def vocabulary(path: str) -> int:
    """One more than the largest id."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1
