"""Best-fit packing after Martello-Toth dominance reduction.

Documents of one length are alike, so an instance is a count per length: as many numbers as a
sequence has tokens, whatever the corpus. The reduction and best fit work on these counts, many
equal sequences at a step; a document then finds its place from its number among those of its
length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.base import stage
from lumenframe.llm.token_ids import slices, token_ids

Contents = dict[int, int]  # lengths in a sequence, and how often


def smallest(count: np.ndarray, k: int) -> list[int]:
    """The k smallest lengths, repeated as they occur; fewer if there are no more."""
    out = []
    for s in np.flatnonzero(count)[:k].tolist():
        out += [s] * min(int(count[s]), k - len(out))
    return out


def pairs(count: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length r its largest partner s <= r that fits into ``room`` with it."""
    have = np.flatnonzero(count)
    r = have[have < room]
    limit = np.minimum(room - r, r)
    at = np.searchsorted(have, limit, "right") - 1
    s = np.where(at >= 0, have[np.maximum(at, 0)], 0)
    alone = (s == r) & (count[r] < 2)  # the partner must be another document
    s = np.where(alone, np.where(at >= 1, have[np.maximum(at - 1, 0)], 0), s)
    return r[s > 0], s[s > 0]


def dominating(count: np.ndarray, j: int, size: int) -> list[int] | None:
    """A set of at most three lengths with ``j`` that dominates every set that fits with it.

    One set dominates another if the other's members can be gathered into groups, each no longer
    than a member of its own in the first. Then some packing with the fewest sequences has the
    first set in a sequence by itself.
    """
    rest = count.copy()
    rest[j] -= 1
    room = size - j
    low = smallest(rest[: room + 1], 3)
    if not low:
        return [j]  # nothing fits with it
    best = int(np.flatnonzero(rest[: room + 1])[-1])
    if best == room or len(low) < 2 or low[0] + low[1] > room:
        return [j, best]  # it fills the sequence, or one more document is all that fits
    if len(low) > 2 and sum(low) <= room:
        return None
    r, s = pairs(rest, room)
    if best >= int((r + s).max()):
        return [j, best]  # longer than any two together
    third = np.flatnonzero(rest[: room - best + 1])
    third = third[(third != best) | (rest[third] > 1)]
    if not len(third):
        return None
    # For each first member the largest second one is the hardest to be dominated.
    if np.any((s > third[-1]) & (r + s > best)):
        return None
    return [j, best, int(third[-1])]


def reduce_instance(count: np.ndarray, size: int) -> tuple[list[tuple[Contents, int]], np.ndarray]:
    """Sequences that dominance fixes for good, (contents, how many), and the counts left.

    A set stays dominating while its members last, because fewer documents make fewer rivals; so
    it is fixed as often as they allow at once. Lengths go from long to short, again and again
    until nothing is fixed.
    """
    count, fixed = count.copy(), []
    while True:
        before = len(fixed)
        for j in np.flatnonzero(count)[::-1].tolist():
            while count[j]:
                found = dominating(count, j, size)
                if found is None:
                    break
                contents = {s: found.count(s) for s in found}
                times = min(int(count[s]) // k for s, k in contents.items())
                for s, k in contents.items():
                    count[s] -= k * times
                fixed.append((contents, times))
        if len(fixed) == before:
            return fixed, count


def best_fit(count: np.ndarray, size: int) -> list[tuple[Contents, int]]:
    """Best fit of the counts, long documents first: each goes where it leaves the least room."""
    room: dict[int, list[tuple[Contents, int]]] = defaultdict(list)
    for s in np.flatnonzero(count)[::-1].tolist():
        left = int(count[s])
        while left:
            fits = min((r for r, bins in room.items() if r >= s and bins), default=None)
            contents, bins = ({}, left) if fits is None else room[fits].pop()
            free = size if fits is None else fits
            # A sequence with room for more of this length is the best place for them as well.
            each = min(free // s, left)
            full = min(bins, left // each)
            room[free - each * s].append(({**contents, s: each}, full))
            left -= full * each
            if fits is not None and bins > full:
                room[fits].append((contents, bins - full))
    return [b for bins in room.values() for b in bins]


def places(count: np.ndarray, size: int) -> np.ndarray:
    """Places in the packed sequences: rows (length, first number, each, sequence, offset).

    The documents ``first ..`` of a length lie ``each`` to a sequence, from ``sequence`` on, at
    ``offset``. The rows depend on the number of lengths, not on that of documents.
    """
    fixed, left = reduce_instance(count, size)
    out, used, sequence = [], np.zeros(size + 1, np.int64), 0
    for contents, bins in fixed + best_fit(left, size):
        offset = 0
        for s in sorted(contents, reverse=True):
            out.append((s, used[s], contents[s], sequence, offset))
            used[s] += contents[s] * bins
            offset += contents[s] * s
        sequence += bins
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def _pieces(vocabulary: str, size: int, end_id: int, keep_ids: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, me, seen = token_ids(vocabulary), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            for b in slices(batch):
                ids, ends = lib.flat(b.column("text"), end_id)
                ids = ids.astype("<u4")
                n = np.diff(np.r_[0, ends])
                number = -(-n // size)
                doc = np.repeat(np.arange(len(n)), number)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                head = n[doc] - (number[doc] - 1) * size  # only the first piece is shorter
                start = np.where(piece > 0, head + (piece - 1) * size, 0)
                length = np.where(piece > 0, size, head)
                at = (ends - n)[doc] + start
                own = [ids[x:y] for x, y in zip(at.tolist(), (at + length).tolist(), strict=True)]
                crc = np.fromiter(map(zlib.crc32, own), np.int64, len(own))
                order = np.argsort(length, kind="stable")
                many = np.bincount(length, minlength=size + 1)
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(length)) - (np.cumsum(many) - many)[length[order]]
                k = rank + seen[length]
                seen += many
                cols = [b.column("id").take(pa.array(doc)), piece, start, length, crc, np.full(len(doc), me), k]
                cols.append(pa.array([x.tolist() for x in own] if keep_ids else [None] * len(own), schema.field("ids").type))
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def pack_best_fit(
    docs: DataFrame, vocabulary: str, *, id: str = "doc_id", text: str = "text", length: int = 1024, end_id: int = 2, keep_ids: bool = False
) -> DataFrame:
    """Pack whole documents into few sequences of at most ``length`` tokens.

    A document is its token ids and ``end_id``. Only longer documents are cut, into pieces of
    ``length`` tokens of which the first may be shorter. Sets of up to three pieces that provably
    dominate all others with their longest piece are fixed, which shrinks the instance; what is
    left goes long to short, each piece where it leaves the least room.

    One pass tokenises and numbers the pieces of each length in their task, sums per task and
    length give each task's first number, and a table of places, whose size follows ``length``
    and not the corpus, tells where the k-th piece of a length lies. Text is never shuffled; the
    driver sees one count per length.

    Returns one row per piece: ``id``, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32``
    (of little-endian unsigned 32-bit ids), ``sequence_id``, ``offset`` (gapless from 0 in a
    sequence) and, with ``keep_ids``, ``ids``. Null and empty texts are their end id alone;
    repeated rows and null ids are documents like any other; an empty table gives no piece. Other
    columns are ignored.
    """
    flat = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    id_type = flat.select("id").limit(0).toArrow().schema.field("id").type
    own = [("id", id_type), ("piece", pa.int32()), *[(c, pa.int64()) for c in ("start", "length", "ids_crc32", "run", "k")], ("ids", pa.list_(pa.int64()))]
    cut = flat.mapInArrow(
        _pieces(vocabulary, length, end_id, keep_ids, pa.schema(own)),
        f"id {kind}, piece int, start long, length long, ids_crc32 long, run long, k long, ids array<long>",
    )
    rows = stage(cut, "pieces")
    sums = rows.groupBy("run", "length").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.withColumn("base", F.coalesce(F.sum("n").over(upto), F.lit(0))), "lengths")
    count = np.zeros(length + 1, np.int64)
    for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``length`` rows
        count[r.length] = r.n
    table = places(count, length)
    shift = 1 << 50  # more than documents of a length
    key = table[:, 0] * shift + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, k = b.column("length").to_numpy(), b.column("k").to_numpy()
            slot = table[np.searchsorted(key, n * shift + k, "right") - 1]
            nth = k - slot[:, 1]
            sequence, offset = slot[:, 3] + nth // slot[:, 2], slot[:, 4] + nth % slot[:, 2] * n
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")], pa.array(sequence), pa.array(offset), b.column("ids")],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"],
            )

    placed = rows.join(sums.drop("n"), ["run", "length"])
    placed = placed.select("id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("k")).alias("k"), "ids")
    out = placed.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids array<long>")
    out = out.withColumnRenamed("id", id)
    return out if keep_ids else out.drop("ids")
