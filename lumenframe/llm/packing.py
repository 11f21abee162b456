"""Mixture-controlled packing of documents into token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.base import stage
from lumenframe.llm.token_ids import slices, token_ids

DIRECT = 64  # level of the sources of two tokens a window at least; others have fewer binary digits
BUCKETS = 1024


def tokenised(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(id, src, text) to ids with the end id, and each document's place in its task's queue of
    its source. ``run`` is the number of the task's input split, so reruns over the same splits
    give the same queues; the written table fixes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, queue, me = token_ids(vocabulary), {}, TaskContext.get().partitionId()
        for batch in batches:
            for b in slices(batch):
                ids, ends = lib.flat(b.column("text"), end_id)
                n = np.diff(np.r_[0, ends])
                before = []
                for s, k in zip(b.column("src").to_pylist(), n.tolist(), strict=True):
                    before.append(queue.get(s, 0))
                    queue[s] = before[-1] + k
                starts = pa.py_buffer((np.r_[0, ends] * lib.kind.itemsize).astype(np.int32))
                held = pa.Array.from_buffers(pa.binary(), len(n), [None, starts, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("src"), pa.array(np.full(len(n), me)), pa.array(before, pa.int64()), pa.array(n), held],
                    ["id", "src", "run", "before", "n", "ids"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, src string, run long, before long, n long, ids binary")


def mixture_phases(totals: Mapping, weights: Mapping | None) -> list[tuple[int, dict]]:
    """Stretches of the packed stream with one mixture each: (start, {source: (first token of
    its queue, tokens)}).

    Without weights every window has the sources' own proportions, and all queues end together.
    With weights the proportions hold until a queue runs dry; the others share on by weight.
    """
    used, start, phases = dict.fromkeys(totals, 0), 0, []
    while True:
        rest = {s: n - used[s] for s, n in totals.items() if n > used[s]}
        if not rest:
            return phases
        share = {s: weights.get(s, 0) for s in rest} if weights else rest
        if not any(share.values()):
            share = rest  # only sources of weight 0 are left: by their own sizes
        level = min(n / share[s] for s, n in rest.items() if share[s])
        take = {s: min(n, max(round(level * share[s]), 1)) for s, n in rest.items() if share[s]}
        phases.append((start, {s: (used[s], k) for s, k in take.items()}))
        for s, k in take.items():
            used[s] += k
        start += sum(take.values())


class Levels:
    """Deficit round-robin of one stretch of the stream in closed form.

    In a round every queue gets its share of a window as quantum, what is not a whole token stays
    as deficit for the next round. After w rounds a queue has sent
    floor(w * window * upto / total) - floor(w * window * low / total) tokens, where low and upto
    are the tokens of the queues up to it: a sum of quanta with carried deficits that depends on
    w alone. So any task can tell where any token goes without seeing other rounds.

    That needs a quantum of a token at least, but for the first queue. Sources of less than two
    tokens a window are the tail: its stream is the first queue of level 0, and is dealt out by
    rounds of its own, long enough for two to four tokens of its sources of most binary digits;
    sources of fewer digits are the tail of that level, and so on. So each source has its own
    deficit, however small it is, and a level has three numbers.
    """

    def __init__(self, start: int, tokens: Mapping[int, int], window: int):
        """``tokens``: tokens by level, DIRECT or the binary digits of the tail's sources."""
        self.start, self.total, self.window, self.tail = start, {}, {}, {}
        self.order, below = sorted(tokens), 0
        for level in self.order:
            self.tail[level], below = below, below + tokens[level]
            self.total[level] = below
            self.window[level] = window if level == DIRECT else -(-2 * below // (1 << (level - 1)))
        self.above = dict(zip(self.order, [*self.order[1:], None], strict=True))
        if self.order and self.order[-1] != DIRECT:  # all sources are small: the tail is all there is
            self.above[self.order[-1]] = DIRECT
            self.total[DIRECT], self.window[DIRECT], self.above[DIRECT] = below, window, None

    def turns(self, level: int, low: int, upto: int, t: int, n: int) -> Iterator[tuple[int, int, int]]:
        """Tokens t .. t+n of the queue low .. upto in the stream of its level."""
        total, window, size, done, w = self.total[level], self.window[level], upto - low, 0, 0
        while done < n:
            # No window before this one has the token; the first queue's is known.
            w = max(w, -(-(t + 1) * total // (size * window)) - 1 if low == 0 else t * total // (size * window))
            here, following = min(w * window, total), min((w + 1) * window, total)
            while following * upto // total - following * low // total <= t:
                w, here, following = w + 1, following, min(following + window, total)
            k = min(n - done, following * upto // total - following * low // total - t)
            yield done, k, here + following * low // total + t - here * upto // total
            t, done = t + k, done + k

    def pieces(self, level: int, low: int, upto: int, first: int, n: int) -> Iterator[tuple[int, int, int]]:
        """Tokens first .. first+n of a queue: (skip, length, position)."""
        above = self.above[level]
        for skip, k, pos in self.turns(level, low, upto, first, n):
            if above is None:
                yield skip, k, self.start + pos
            else:
                for more, m, at in self.pieces(above, 0, self.total[level], pos, k):
                    yield skip + more, m, at


def level_of(n: int, total: int, window: int) -> int:
    return DIRECT if n * window >= 2 * total else n.bit_length()


class Rounds:
    """The levels of one phase and the places of its sources in them."""

    def __init__(self, start: int, take: dict, window: int):
        total, tokens, self.queue = sum(n for _, n in take.values()), {}, {}
        by_name = sorted(take, key=lambda s: (s is None, s or ""))
        level = {s: level_of(take[s][1], total, window) for s in by_name}
        for s in by_name:
            low = tokens.get(level[s], 0)
            tokens[level[s]] = low + take[s][1]
            self.queue[s] = (level[s], low, low + take[s][1])
        self.levels = Levels(start, tokens, window)

    def pieces(self, source, first: int, n: int) -> Iterator[tuple[int, int, int]]:
        """Tokens first .. first+n of the source's part of this phase: (skip, length, position)."""
        level, low, upto = self.queue[source]
        tail = self.levels.tail[level]
        return self.levels.pieces(level, tail + low, tail + upto, first, n)


def own_places(queues: DataFrame, window: int) -> tuple[DataFrame, dict[int, int]]:
    """Sources in the proportions of their sizes: (src, level, low, upto), with low and upto
    counted inside the level, and the tokens of each level.

    Sources of a level stand in the order of a hash's buckets, so no task sees all of them; only
    the tokens of at most 64 levels reach the driver.
    """
    total = queues.agg(F.sum("n")).first()[0] or 0
    direct = F.col("n") >= -(-2 * total // window)
    sources = queues.groupBy("src").agg(F.sum("n").alias("n"))
    level = F.when(direct, DIRECT).otherwise(F.length(F.bin("n"))).cast("int")
    sources = stage(sources.withColumns({"level": level, "bucket": F.pmod(F.xxhash64("src"), F.lit(BUCKETS))}), "sources")
    ranges = stage(sources.groupBy("level", "bucket").agg(F.sum("n").alias("n")), "ranges")
    before = Window.partitionBy("level").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("level", "bucket").orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("level", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    low = F.col("begin") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    places = sources.join(ranges, ["level", "bucket"]).withColumn("low", low)
    tokens = {r.level: r.n for r in sources.groupBy("level").agg(F.sum("n").alias("n")).collect()}
    return places.select("src", "level", "low", (F.col("low") + F.col("n")).alias("upto")), tokens


def pack(
    docs: DataFrame, vocabulary: str, *, id: str = "doc_id", text: str = "text", source: str = "source",
    length: int = 1024, end_id: int = 0, window_sequences: int = 64, weights: Mapping | None = None, keep_ids: bool = False,
) -> DataFrame:
    """Pack the tokens of all documents into sequences of ``length`` with the mixture under control.

    Documents queue by source. Windows of ``window_sequences`` sequences are filled by deficit
    round-robin: each source adds its share of the window to within two tokens, deficits carry
    from window to window and over the limits of partitions; a source of less than two tokens a
    window gets two to four at a time, every few windows. Documents are cut at the ends of
    sequences and of their source's share of a window. Sequences are full but for the last.

    One pass writes ids and each document's place in its task's queue; sums per task and source
    become the offset of each task's queue; a last pass cuts the ids. Text is never shuffled, and
    the offsets and the sources' places are joined, by broadcast only if the planner finds them
    small. The driver sees the totals of levels, and of the sources that ``weights`` names.

    Returns one row per piece: ``id``, ``start``, ``length``, ``ids_crc32`` (of little-endian
    unsigned 32-bit ids), ``doc_tokens``, ``sequence_id``, ``offset``, ``source`` and, with
    ``keep_ids``, ``ids`` (array). Null and empty texts are their end id alone; a null source is
    a queue of its own; repeated rows and null ids are documents like any other; an empty table
    gives no piece. Other columns are ignored.
    """
    flat = docs.select(F.col(id).alias("id"), F.col(source).cast("string").alias("src"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = stage(tokenised(flat, vocabulary, end_id), "ids")
    sums = rows.groupBy("run", "src").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("src").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.withColumn("base", F.coalesce(F.sum("n").over(upto), F.lit(0))), "queues")
    window, kind_size = length * window_sequences, token_ids(vocabulary).kind
    named, phases, others = [s for s, w in (weights or {}).items() if w], [], sums
    if named:
        is_named = F.when(F.col("src").isNull(), F.lit(None in named)).otherwise(F.col("src").isin([s for s in named if s is not None]))
        totals = sums.where(is_named).groupBy("src").agg(F.sum("n").alias("n")).collect()
        phases, others = mixture_phases({r.src: r.n for r in totals}, weights), sums.where(~is_named)
    places, tokens = own_places(others, window)
    own_start = sum(n for _, take in phases for _, n in take.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = [(Rounds(start, take, window), take) for start, take in phases]
        own = Levels(own_start, tokens, window)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                out = []
                for r in b.to_pylist():
                    ids, queued = np.frombuffer(r["ids"], kind_size), r["base"] + r["before"]
                    stretches = []
                    if r["level"] is not None:
                        tail = own.tail[r["level"]]
                        stretches.append((0, own.pieces(r["level"], tail + r["low"], tail + r["upto"], queued, r["n"])))
                    for rounds, take in plans:
                        begin, count = take.get(r["src"], (0, 0))
                        lo, hi = max(queued, begin), min(queued + r["n"], begin + count)
                        if lo < hi:
                            stretches.append((lo - queued, rounds.pieces(r["src"], lo - begin, hi - lo)))
                    for first, parts in stretches:
                        for skip, k, pos in parts:
                            start = first + skip
                            while k:
                                m = min(k, length - pos % length)
                                own_ids = ids[start : start + m].astype("<u4")
                                out.append((r["id"], start, m, zlib.crc32(own_ids.tobytes()), r["n"], pos // length, pos % length, r["src"], own_ids.tolist() if keep_ids else None))
                                start, pos, k = start + m, pos + m, k - m
                cols = list(zip(*out, strict=True)) if out else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    kind = docs.schema[id].dataType.simpleString()
    longs = [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    id_type = flat.select("id").limit(0).toArrow().schema.field("id").type
    schema = pa.schema([("id", id_type), *longs, ("source", pa.string()), ("ids", pa.list_(pa.int64()))])
    places = places.withColumnRenamed("src", "p_src")
    sums = stage(sums.join(places, F.col("src").eqNullSafe(F.col("p_src")), "left").drop("p_src"), "places")
    sums = sums.select("run", F.col("src").alias("_src"), "base", "level", "low", "upto")
    placed = rows.join(sums, (rows["run"] == sums["run"]) & F.col("src").eqNullSafe(F.col("_src")))
    placed = placed.select("id", "src", "before", "base", "level", "low", "upto", "n", "ids")
    out = placed.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, ids array<long>")
    out = out.withColumnRenamed("id", id)
    return out if keep_ids else out.drop("ids")
