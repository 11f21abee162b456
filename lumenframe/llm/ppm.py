"""Prediction by partial matching over bytes, with frozen statistics.

A text is read as its lower-cased words, one space between them and one end symbol. Statistics
are counts of (context, symbol) for contexts of 0 to ``order`` bytes. A symbol is coded in the
longest context that was seen; where it is new there, an escape (method C) is coded and the
next shorter context follows, in which the symbols of the longer one are excluded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenframe.llm.base import texts, words

END = b"\n"  # in no word: pads the first contexts and ends a text
FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
COUNTED = 1_500_000  # distinct grams a task holds before it hands them on


def grams(raw: list[bytes | None], order: int) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Codes of order + 1 bytes, one for each coded symbol; the first code of each text; words."""
    split = [words(t) for t in raw]
    pad = END * order
    parts = [pad + b" ".join(w) + END for w in split]
    a = np.frombuffer(b"".join(parts), np.uint8)
    code = np.zeros(max(len(a) - order, 0), np.uint64)
    for k in range(order + 1):
        code <<= np.uint64(8)
        code |= a[k : len(a) - order + k]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    begin = np.cumsum(size) - size
    keep = np.ones(len(code), bool)
    for k in range(1, order + 1):  # codes that reach over from one text into the next
        keep[begin[1:] - k] = False
    return code[keep], begin - order * np.arange(len(parts)), split


class Counts:
    """Counts of grams by key, handed on whenever many have gathered."""

    def __init__(self):
        self.parts: dict[object, list] = {}
        self.held = 0

    def add(self, key, codes: np.ndarray) -> None:
        c, n = np.unique(codes, return_counts=True)
        self.parts.setdefault(key, []).append((c, n))
        self.held += len(c)

    def take(self) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
        for key, parts in self.parts.items():
            yield key, *summed(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))
        self.parts, self.held = {}, 0

    def shrink(self) -> bool:
        """Sum what is held; True if it stays large."""
        held = list(self.take())
        self.parts = {k: [(c, n)] for k, c, n in held}
        self.held = sum(len(c) for _, c, _ in held)
        return self.held > COUNTED


def summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.nonzero(np.r_[True, codes[1:] != codes[:-1]])[0] if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """(key, text) to key, code, n: grams counted over all texts, in partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counts()

        def out():
            for key, c, n in held.take():
                for at in range(0, len(c), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(c[part]), pa.string()), pa.array(c[part].view(np.int64)), pa.array(n[part])], ["key", "code", "n"]
                    )

        for part, raw in texts(batches):
            keys = part.column("key").to_pylist()
            for key in dict.fromkeys(keys):
                code, _, _ = grams([t for t, k in zip(raw, keys, strict=True) if k == key], order)
                held.add(key, code)
            if held.held > 4 * COUNTED and held.shrink():
                yield from out()
        yield from out()

    return docs.mapInArrow(run, "key string, code long, n long")


class Tree:
    """The context tree of one key: per level sorted grams with counts, and contexts with their
    sum, number of symbols, and the sum that their symbols have one level down."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, order: int, root: tuple[np.ndarray, np.ndarray], upper: Sequence[tuple] = ()):
        """``root`` and ``upper`` are the grams and counts of levels 0, 1, ...; where ``codes`` are
        only those of some contexts, these levels have to be whole."""
        self.levels, below = [], None
        known = [root, *upper]
        for j in range(order + 1):
            if j < len(known):
                g, c = known[j]
            else:
                g, c = summed(codes & np.uint64((1 << 8 * (j + 1)) - 1), n)
            ctx, first = np.unique(g >> np.uint64(8), return_index=True)
            total = np.add.reduceat(c, first) if len(first) else c
            kinds = np.diff(np.r_[first, len(g)])
            excluded = np.zeros(len(ctx), np.int64)
            if j and len(g):
                at = np.searchsorted(below[0], g & np.uint64((1 << 8 * j) - 1))
                excluded = np.add.reduceat(below[1][at], first)
            self.levels.append((g, c, ctx, total, kinds, excluded))
            below = (g, c)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last byte after its first ones."""
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        x, d = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)  # excluded sum, symbols
        for j in range(len(self.levels) - 1, -1, -1):
            g, c, ctx, total, kinds, excluded = self.levels[j]
            if not len(g) or not len(todo):
                continue
            own = codes[todo] & np.uint64((1 << 8 * (j + 1)) - 1)
            at = np.minimum(np.searchsorted(ctx, own >> np.uint64(8)), len(ctx) - 1)
            seen = (ctx[at] == own >> np.uint64(8)) & (kinds[at] > d[todo])
            rest = total[at] - x[todo] + kinds[at] - d[todo]
            gat = np.minimum(np.searchsorted(g, own), len(g) - 1)
            hit = seen & (g[gat] == own)
            out[todo[hit]] += np.log10(c[gat[hit]] / rest[hit])
            esc = seen & ~hit
            out[todo[esc]] += np.log10((kinds[at[esc]] - d[todo[esc]]) / rest[esc])
            known = ctx[at] == own >> np.uint64(8)
            x[todo[known]], d[todo[known]] = excluded[at[known]], kinds[at[known]]
            todo = todo[~hit]
        out[todo] -= np.log10(256 - d[todo])
        return out


class Index:
    """A hash table from distinct codes to their places."""

    def __init__(self, codes: np.ndarray):
        self.bits = max(int(2 * len(codes)).bit_length(), 4)
        self.key = np.full(1 << self.bits, FREE, np.uint64)
        self.row = np.zeros(1 << self.bits, np.int32)
        rows, slot = np.arange(len(codes), dtype=np.int32), self._slot(codes)
        while len(rows):
            free = self.key[slot] == FREE
            self.key[slot[free]] = codes[rows[free]]
            mine = self.key[slot] == codes[rows]
            self.row[slot[mine]] = rows[mine]
            rows, slot = rows[~mine], (slot[~mine] + 1) & (len(self.key) - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each code, 0 for those that are not there, and which these are."""
        slot = self._slot(codes)
        key = self.key[slot]
        row = self.row[slot]
        far = np.nonzero(key != codes)[0]
        new = []
        while len(far):
            none = key[far] == FREE
            new.append(far[none])
            far = far[~none]
            slot[far] = (slot[far] + 1) & (len(self.key) - 1)
            key[far], row[far] = self.key[slot[far]], self.row[slot[far]]
            far = far[key[far] != codes[far]]
        new = np.concatenate(new) if new else np.empty(0, np.int64)
        row[new] = 0
        return row, new


class Scorer:
    """Trees by key, and one hash table with the values of all grams that any tree has seen."""

    def __init__(self, trees: list[Tree]):
        self.trees = trees
        top = [t.levels[-1][0] for t in trees]
        codes = np.unique(np.concatenate(top)) if top else np.empty(0, np.uint64)
        self.values = np.stack([t.log10(codes) for t in trees], axis=1).astype(np.float32) if trees else None
        self.index = Index(codes)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """log10 probabilities, a column for each tree."""
        row, new = self.index.find(codes)
        out = self.values[row] if len(self.values) else np.zeros((len(codes), len(self.trees)), np.float32)
        if len(new):
            few, back = np.unique(codes[new], return_inverse=True)
            out[new] = np.stack([t.log10(few) for t in self.trees], axis=1)[back]
        return out


def text_sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the rows of each text (each text has its end symbol, so none is empty)."""
    return np.add.reduceat(values, begin, axis=0, dtype=np.float64)
