"""Removal of repeated byte strings by sorting suffixes in range partitions.

Windows are the strings of ``length`` bytes of the texts; a window is repeated if it starts
anywhere else too. Sorting the suffixes of all positions would move each byte many times, so three
sorts share the work. The first sorts anchor suffixes: the window at p belongs to the smallest of
the hashes of the ``choose`` grams that begin in it first, which depends on the window alone, so
equal windows have equal anchors. An anchor owns a run of windows, its block. Equal blocks are
repeated as a whole; an anchor whose leading bytes (a part of all its windows) are unique has no
repeated window. What is left, one of each kind of block where anchors agree and blocks differ, is
cut out of the texts. The second sort does the same with cells of CELL windows that lie alike to
the anchor; what it leaves open has the suffixes of all its positions sorted by the third, which
decides them.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.base import keyed, stage, texts

SAMPLE, CHUNK = 4000, 1 << 14  # stretches, about, whose anchors are looked at, and their windows
KEYS = 100  # keys per bucket from which splitters are picked
BUCKET_BYTES = 64 << 20  # text for each bucket, about a million anchors
GRAM, CELL = 8, 16
SHAPE = 1 << 16
U64 = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


class Fingerprints:
    """64-bit fingerprints of any substrings of a text from one pass of prefix sums."""

    _table = np.random.default_rng(200).integers(0, 2**64 - 1, 256, np.uint64, endpoint=True)
    _base = 0x5851F42D4C957F2D
    _up = _down = np.ones(1, np.uint64)

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._up) < n:
            n = 1 << n.bit_length()
            inverse = pow(cls._base, -1, 1 << 64)
            for name, base in (("_up", cls._base), ("_down", inverse)):
                x = np.full(n, U64(base))
                x[0] = 1
                setattr(cls, name, np.multiply.accumulate(x))
        return cls._up, cls._down

    def __init__(self, text: np.ndarray):  # the powers above are kept for the next text
        up, self.down = self.powers(len(text) + 1)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self._table[text] * up[: len(text)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])


class Second(Fingerprints):
    """The same from other numbers: strings are equal where both agree."""

    _table = np.random.default_rng(201).integers(0, 2**64 - 1, 256, np.uint64, endpoint=True)
    _base = 0x2545F4914F6CDD1D


def leading(text: bytes, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as a number that sorts like them."""
    all_ = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    return all_[at].astype(np.uint64)


def anchors(text: bytes, length: int, choose: int) -> tuple[np.ndarray, ...]:
    """Leading bytes, fingerprint of the leading part, two of the block, first window and shape."""
    n = len(text) - length + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (U64, U64, U64, U64, np.int64, np.int64))
    g = np.ndarray((len(text) - GRAM + 1,), "<u8", text, strides=(1,)).astype(np.uint64)
    key = ((_mixed(g) >> U64(32)) << U64(32)) | np.arange(len(g), dtype=np.uint64)
    rows = -(-len(key) // choose)
    full = np.full(rows * choose, ~U64(0))
    full[: len(key)] = key
    grid = full.reshape(rows, choose)
    fore = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:n], fore[choose - 1 : choose - 1 + n])
    a = (low & U64(0xFFFFFFFF)).astype(np.int64)
    first = np.nonzero(np.r_[True, a[1:] != a[:-1]])[0]
    last = np.r_[first[1:], n] - 1
    a = a[first]
    data = np.frombuffer(text, np.uint8)
    return _entries(text, data, a, a + length - choose + 1, first, last + length, a - first, last - first, first)


def _entries(text: bytes, data: np.ndarray, core: np.ndarray, core_end: np.ndarray, begin: np.ndarray, end: np.ndarray, before: np.ndarray, more: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """What is sorted of blocks and cells whose windows share ``core``: ``before`` and ``more`` are
    the windows before the core's own and how many follow the first."""
    print_of, second_of = Fingerprints(data), Second(data)
    shape = before * SHAPE + more
    salt = shape.astype(np.uint64) * U64(0xD6E8FEB86659FD93)
    prints = (_mixed(p(begin, end) + salt) for p in (print_of, second_of))
    return leading(text, core), print_of(core, core_end), *prints, first, shape


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by the columns in turn: each further column is read for ties only."""
    order = np.argsort(columns[0], kind="stable")
    col = columns[0][order]
    group = np.cumsum(np.r_[False, col[1:] != col[:-1]]) if len(col) else np.empty(0, np.int64)
    for column in columns[1:]:
        same = group[1:] == group[:-1]
        tied = np.nonzero(np.r_[same, False] | np.r_[False, same])[0]
        if not len(tied):
            break
        part = order[tied]
        part = part[np.lexsort((column[part], group[tied]))]
        order[tied] = part
        col = column[order]
        group = np.cumsum(np.r_[False, (group[1:] != group[:-1]) | (col[1:] != col[:-1])])
    return order


def bucket_of(splitters: list[tuple], columns: list[np.ndarray]) -> np.ndarray:
    """Number of splitters at or below each row, by the columns in turn."""
    lead = np.array([s[0] for s in splitters], np.uint64)
    lo, hi = np.searchsorted(lead, columns[0], "left"), np.searchsorted(lead, columns[0], "right")
    for i in np.nonzero(lo != hi)[0]:
        lo[i] = bisect.bisect_right(splitters, tuple(int(c[i]) for c in columns))
    return lo


def _below(rate: float, *columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < int(min(rate, 1.0) * (1 << 40)) + 1


def stretches(flat: DataFrame, length: int) -> DataFrame:
    """About SAMPLE stretches of CHUNK windows, picked by hash from all texts: (key, text)."""
    size = F.octet_length("text")
    count = F.ceil((size - length + 1) / CHUNK).cast("int")
    flat = flat.where(size >= length)
    rate = SAMPLE / max(flat.agg(F.sum(count)).first()[0] or 0, 1)
    own = F.filter(F.sequence(F.lit(0), count - 1), lambda c: _below(rate, F.col("key"), c))
    cut = F.transform(own, lambda c: F.substring(F.col("text").cast("binary"), c * CHUNK + 1, F.lit(CHUNK + length - 1)))
    return flat.select("key", F.explode(cut).alias("text"))


def some_windows(passages: DataFrame, parts: int) -> DataFrame:
    """About KEYS windows per bucket, picked by hash from all open ones: passages with (at)."""
    total = passages.agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] or 0
    own = F.filter(F.sequence("first", "last"), lambda p: _below(KEYS * parts / max(total, 1), F.col("key"), p))
    own = F.transform(own, lambda p: F.struct(p.alias("first"), p.alias("last")))
    return passages.withColumn("open", own).where(F.size("open") > 0)


def pick_splitters(sample: DataFrame, columns: list[str], parts: int) -> list[tuple]:
    """Evenly spaced keys of at most KEYS keys per bucket, those of smallest hash."""
    rows = sample.select(*columns).orderBy(F.xxhash64(*columns)).limit(KEYS * parts).toArrow()
    cols = [rows.column(c).to_numpy().view(np.uint64) for c in columns]
    order = multikey_order(cols)
    at = (np.arange(1, parts) * len(order)) // parts if len(order) else []
    return sorted({tuple(int(c[order[i]]) for c in cols) for i in at})


def _batch(names: list[str], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), 50_000):
        part = [c[at : at + 50_000] for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == U64 else c.astype(np.int64)) for c in part], names)


ENTRY = ["lead", "core", "block", "second", "key", "first", "shape"]
SORTED = 5  # of them in turn


def _find_anchors(length: int, choose: int, splitters: list[tuple] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in texts(batches, rows=128):
            found = [anchors(t, length, choose) for t in raw]
            cols = [np.concatenate(c) for c in zip(*found, strict=True)]
            keys = np.repeat(part.column("key").to_numpy().view(np.uint64), [len(f[0]) for f in found])
            cols.insert(4, keys)
            yield from _dealt(ENTRY, cols, splitters)

    return run


def _dealt(names: list[str], cols: list[np.ndarray], splitters: list[tuple] | None) -> Iterator[pa.RecordBatch]:
    if splitters is not None:
        names, cols = [*names, "bucket"], [*cols, bucket_of(splitters, cols[:SORTED])]
    yield from _batch(names, cols)


def _settle(length: int):
    """Sort a bucket of anchors or cells: repeated ones (open 0) and ones to look into (open 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        rows = pa.Table.from_batches(rows)
        cols = {c: rows.column(c).to_numpy() for c in ENTRY}
        order = multikey_order([cols[c].view(np.uint64) for c in ENTRY[:SORTED]])
        cols = {c: v[order] for c, v in cols.items()}
        n = len(order)
        new_core = np.r_[True, (cols["lead"][1:] != cols["lead"][:-1]) | (cols["core"][1:] != cols["core"][:-1])]
        new_block = new_core | np.r_[True, (cols["block"][1:] != cols["block"][:-1]) | (cols["second"][1:] != cols["second"][:-1])]
        core, block = np.cumsum(new_core) - 1, np.cumsum(new_block) - 1
        copies = np.bincount(block)[block]
        kinds = np.bincount(core[new_block])[core]
        # A core at the edge of the bucket may go on in the next one: look into it too.
        edge = (core == 0) | (core == core[-1])
        twice = copies > 1
        look = new_block & ((kinds > 1) | edge)
        first, before, last = cols["first"], cols["shape"] // SHAPE, cols["first"] + cols["shape"] % SHAPE
        for open_, at, end in ((0, twice, last + length), (1, look, last)):
            k = np.nonzero(at)[0]
            yield from _batch(["open", "key", "first", "last", "before"], [np.full(len(k), open_), cols["key"][k], first[k], end[k], before[k]])

    return run


def _passages(length: int):
    """(key, text, blocks) to the blocks' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in texts(batches, rows=64):
            keys, found = part.column("key").to_pylist(), part.column("blocks").to_pylist()
            rows = [(k, b["first"], b["last"], b["before"], t[b["first"] : b["last"] + length]) for k, t, own in zip(keys, raw, found, strict=True) for b in own]
            for at in range(0, len(rows), 4096):
                cols = list(zip(*rows[at : at + 4096], strict=True))
                kinds = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["key", "first", "last", "before", "bytes"])

    return run


def _joined(part: pa.RecordBatch, raw: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Bytes of all passages of a slice, as they are and as numbers, the shift from a passage's
    own positions to places in them, and key, first, last and before."""
    text = b"".join(raw)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    own = [part.column(c).to_numpy() for c in ("key", "first", "last", "before")]
    return text, np.frombuffer(text, np.uint8), np.cumsum(size) - size - own[1], own


def _find_cells(length: int, splitters: list[tuple]):
    """Passages to their cells: the windows from c to c + CELL - 1, where c is a whole number of
    cells from the anchor. Those share the bytes from the last one's start to the first one's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in texts(batches, column="bytes", rows=2048):
            text, data, shift, (key, first, last, before) = _joined(part, raw)
            anchor = first + before
            low, high = (first - anchor) // CELL, (last - anchor) // CELL
            of = np.repeat(np.arange(len(raw)), high - low + 1)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
            c = anchor[of] + CELL * (low[of] + nth)
            begin, end, to = np.maximum(first[of], c), np.minimum(last[of], c + CELL - 1), shift[of]
            entries = _entries(text, data, to + c + CELL - 1, to + c + length, to + begin, to + end + length, begin - c, end - begin, begin)
            cols = list(entries)
            # Further on a cell is known by its passage: how far it is from that one's first window.
            cols[5] = (begin - first[of]) * SHAPE + (end - begin)
            cols.insert(4, key[of].view(np.uint64))
            yield from _dealt(ENTRY, cols, splitters)

    return run


WINDOW = ["lead", "print", "second", "key", "at"]


def _expand(length: int, splitters: list[tuple] | None):
    """Passages with open stretches to all windows of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in texts(batches, column="bytes", rows=1024):
            text, data, shift, (key, *_) = _joined(part, raw)
            runs = part.column("open")
            of = np.repeat(np.arange(len(raw)), pc.list_value_length(runs).to_numpy())
            begin, end = (pc.struct_field(runs.flatten(), c).to_numpy() for c in ("first", "last"))
            size = end - begin + 1
            at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            of = np.repeat(of, size)
            place = at + shift[of]
            prints = (p(data)(place, place + length) for p in (Fingerprints, Second))
            yield from _dealt(WINDOW, [leading(text, place), *prints, key[of].view(np.uint64), at.astype(np.uint64)], splitters)

    return run


def _settle_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a bucket of windows: those equal to a neighbour (edge 0), and its first (1) and last (2)."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    rows = pa.Table.from_batches(rows)
    cols = [rows.column(c).to_numpy() for c in WINDOW]
    bucket = rows.column("bucket")[0].as_py()
    order = multikey_order([c.view(np.uint64) for c in cols])
    cols = [c[order] for c in cols]
    same = np.logical_and.reduce([c[1:] == c[:-1] for c in cols[:3]])
    twice = np.nonzero(np.r_[same, False] | np.r_[False, same])[0]
    at = np.r_[twice, 0, len(order) - 1]
    edge = np.r_[np.zeros(len(twice), np.int64), 1, 2]
    yield from _batch(["edge", "bucket", *WINDOW], [edge, np.full(len(at), bucket), *[c[at] for c in cols]])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raw in texts(batches, rows=64):
        out = []
        for t, spans in zip(raw, part.column("spans").to_pylist(), strict=True):
            step = np.zeros(len(t) + 1, np.int64)
            if spans:
                s = np.array([(x["first"], x["end"]) for x in spans])
                np.add.at(step, s[:, 0], 1)
                np.add.at(step, s[:, 1], -1)
            gone = np.cumsum(step)[:-1] > 0
            kept = np.frombuffer(t, np.uint8)[~gone].tobytes() if spans else t
            runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            out.append((len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def cut_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", length: int = 200, choose: int = 128) -> DataFrame:
    """Texts without the bytes that any repeated string of ``length`` bytes covers.

    Splitters from at most KEYS keys a bucket, picked by hash, of any length of documents,
    range-partition the suffixes by leading bytes and, so that no repeated string can crowd a
    bucket, by fingerprints, document and position; the number of buckets follows the bytes of all
    texts. A bucket sorts its suffixes by these keys in turn and compares neighbours; the first and
    last suffix of each bucket are compared across buckets (two rows per bucket reach the driver).
    Strings are taken for equal where their eight leading bytes and two independent 64-bit
    fingerprints agree. Whole texts are moved twice: once to cut out open blocks, once at the end.

    Returns one row per input row: ``id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs), ``kept_sha256``, ``kept`` (the remaining bytes, binary). Strings are judged on
    the input; matches never cross documents; overlapping occurrences count. Null text is empty;
    texts shorter than ``length`` lose nothing. Every row is a document of its own, also where rows
    repeat an id or are equal. Null ids do no harm; an empty table gives an empty result; other
    columns are ignored.
    """
    if length - choose + 1 < 8 or length < choose + GRAM - 1 or choose >= SHAPE or length - CELL + 1 < 8:
        raise ValueError("length has to exceed choose by at least 7, and choose is below 65,536")
    spark = docs.sparkSession
    rows, key = keyed(docs, "suffix-rows")
    flat = rows.select(F.col(key).alias("key"), F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), (flat.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES)

    longs = " long, ".join(ENTRY) + " long"
    settled = "open long, key long, first long, last long, before long"
    some = stretches(flat, length).mapInArrow(_find_anchors(length, choose, None), longs)
    splitters = pick_splitters(some, ENTRY[:SORTED], parts)
    found = flat.select("key", "text").mapInArrow(_find_anchors(length, choose, splitters), longs + ", bucket long")
    found = found.repartitionById(parts, F.col("bucket").cast("int")).drop("bucket")
    blocks = stage(found.mapInArrow(_settle(length), settled), "blocks")

    open_ = blocks.where("open = 1").groupBy("key").agg(F.collect_set(F.struct("first", "last", "before")).alias("blocks"))
    passages = flat.select("key", "text").join(open_, "key").mapInArrow(_passages(length), "key long, first long, last long, before long, bytes binary")
    passages = stage(passages, "passages")
    windows_of = " long, ".join(WINDOW) + " long"
    splitters = pick_splitters(some_windows(passages, parts).mapInArrow(_expand(length, None), windows_of), WINDOW, parts)
    cells = passages.mapInArrow(_find_cells(length, splitters), longs + ", bucket long")
    cells = cells.repartitionById(parts, F.col("bucket").cast("int")).drop("bucket")
    cells = stage(cells.mapInArrow(_settle(length), settled), "cells")

    open_ = cells.where("open = 1").groupBy("key", (F.col("first") - F.col("before")).alias("first")).agg(F.collect_set(F.struct("first", "last")).alias("open"))
    windows = passages.join(open_, ["key", "first"]).mapInArrow(_expand(length, splitters), windows_of + ", bucket long")
    windows = windows.repartitionById(parts, F.col("bucket").cast("int"))
    windows = stage(windows.mapInArrow(_settle_windows, "edge long, bucket long, " + windows_of), "windows")

    edges = sorted(windows.where("edge > 0").collect(), key=lambda r: (r.bucket, r.edge))
    ends = zip(edges[1::2], edges[2::2], strict=False)
    met = [(x.key, x.at) for a, b in ends if (a.lead, a.print, a.second) == (b.lead, b.print, b.second) for x in (a, b)]
    twice = windows.where("edge = 0").select("key", "at").union(spark.createDataFrame(met, "key long, at long"))
    spans = blocks.unionByName(cells).where("open = 0").select("key", "first", F.col("last").alias("end"))
    spans = spans.union(twice.select("key", F.col("at").alias("first"), (F.col("at") + length).alias("end")))
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    kind = docs.schema[id].dataType.simpleString()
    out = flat.join(spans, "key", "left").select("id", "text", "spans")
    out = out.mapInArrow(_cut_out, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("id", id)
