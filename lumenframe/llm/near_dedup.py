"""MinHash near-duplicates with sequential Bayesian verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.base import first_row, keyed, stage, texts, words
from lumenframe.llm.components import components

BATCH = 32  # signature values compared before each decision
SLICE, LEAD = 2048, 1024  # members and leaders of a block


@dataclass(frozen=True)
class Method:
    """Shingles of ``ngram`` words; links at ``percent`` or more Jaccard similarity; ``miss``
    bounds the chance to lose a linked pair in banding and in the comparison of signatures."""

    ngram: int = 5
    percent: int = 80
    miss: float = 1e-6
    rows: int = 5
    batches: int = 4

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))


def _odd(seed: int, n: int, kind) -> np.ndarray:
    r = np.random.default_rng(seed)
    return r.integers(0, np.iinfo(kind).max, n, dtype=kind, endpoint=True) | kind(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes | None, ngram: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than ``ngram`` make one."""
    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = min(ngram, len(w))
    factor = _odd(n, n, np.uint64)
    x = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        x += h[k : len(h) - n + 1 + k] * factor[k]
    return np.unique(_mixed(x))


class Sketcher:
    def __init__(self, m: Method):
        self.m, k = m, m.bands * m.rows + m.batches * BATCH
        self.times, self.flip = _odd(11, k, np.uint32), _odd(12, k, np.uint32)
        self.join = _odd(13, m.bands * m.rows, np.uint64).reshape(m.bands, m.rows)
        self.salt = _odd(14, m.bands, np.uint64)

    def __call__(self, s: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Band keys, and one byte of each signature value kept for the comparison."""
        v = (s >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.times), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(v), 512):
            x = v[at : at + 512, None] ^ self.flip
            x *= self.times
            np.minimum(low, x.min(axis=0), out=low)
        n = self.join.size
        keys = _mixed((low[:n].reshape(self.join.shape).astype(np.uint64) * self.join).sum(axis=1) + self.salt)
        return keys.view(np.int64), (low[n:] & np.uint32(0xFF)).astype(np.uint8).tobytes()


def sketches(docs: DataFrame, m: Method) -> DataFrame:
    """(id, text) to id, n_shingles, digest of the set, band keys and signature bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(m)
        for part, raw in texts(batches):
            n, digest, keys, sig = [], [], [], []
            for t in raw:
                s = shingles(t, m.ngram)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                k, g = sketch(s) if len(s) else (np.empty(0, np.int64), b"")
                keys.append(k)
                sig.append(g)
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(sig, pa.binary())],
                ["id", "n", "digest", "keys", "sig"],
            )

    return docs.mapInArrow(run, "id long, n long, digest binary, keys array<long>, sig binary")


def least_matches(m: Method) -> list[int]:
    """Fewest equal signature values, after each batch, at which a pair stays possible.

    With a uniform prior the similarity after ``k`` equal values of ``n`` is Beta(k+1, n-k+1);
    its chance to reach t is P(Binomial(n+1, t) <= k). A pair goes when that is below ``miss``.
    """
    t, out = m.percent / 100, []
    for n in range(BATCH, BATCH * m.batches + 1, BATCH):
        chance, k = 0.0, -1
        while chance < m.miss:
            k += 1
            chance += math.comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k)
        out.append(k)
    return out


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _compare(m: Method, verify: bool):
    """Rows of blocks, each block with its leaders first, to plausible pairs (leader, member), or
    to linked pairs where the rows carry their sets."""
    least, p = least_matches(m), m.percent
    names = ("id", "label", "n", "shared")

    def block(lead: dict, mem: dict) -> tuple[np.ndarray, np.ndarray]:
        need = p * (lead["n"][:, None] + mem["n"][None, :])
        open_ = (lead["id"][:, None] < mem["id"][None, :]) & (lead["label"][:, None] != mem["label"][None, :])
        i, j = np.nonzero(open_ & ((100 + p) * np.minimum(lead["shared"][:, None], mem["shared"][None, :]) >= need))
        equal = np.zeros(len(i), np.int64)
        for k, enough in enumerate(least):
            cols = slice(k * BATCH, (k + 1) * BATCH)
            for at in range(0, len(i), 1 << 16):
                part = slice(at, at + (1 << 16))
                equal[part] += (lead["sig"][i[part], cols] == mem["sig"][j[part], cols]).sum(axis=1)
            ok = equal >= enough
            i, j, equal = i[ok], j[ok], equal[ok]
        if verify:
            ok = np.fromiter((_similar(lead["set"][x], mem["set"][y], p) for x, y in zip(i, j, strict=True)), bool, len(i))
            i, j = i[ok], j[ok]
        return lead["id"][i], mem["id"][j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lead = None, None
        for b in batches:
            if not b.num_rows:
                continue
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in (*names, "bucket", "slice", "part", "member")}
            cols["sig"] = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            if verify:
                flat, off = b.column("set").values.to_numpy(), b.column("set").offsets.to_numpy()
                cols["set"] = np.empty(b.num_rows, object)
                cols["set"][:] = [flat[x:y].copy() for x, y in zip(off[:-1], off[1:], strict=True)]
            key = np.stack([cols["bucket"], cols["slice"], cols["part"], cols["member"]])
            ends = [*(np.nonzero((key[:, 1:] != key[:, :-1]).any(axis=0))[0] + 1), b.num_rows]
            at, found = 0, []
            for end in ends:
                here, is_member = tuple(key[:3, at]), key[3, at]
                rows = {c: cols[c][at:end] for c in (*names, "sig", *["set"] * verify)}
                at = end
                if not is_member:
                    lead = rows if here != now else {c: np.concatenate([lead[c], rows[c]]) for c in rows}
                    now = here
                elif here == now:
                    found.append(block(lead, rows))
            if found:
                x, y = (np.concatenate(z) for z in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    return run


def _linked(m: Method):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i in range(b.num_rows):
                x, y = (b.column(c)[i].values.to_numpy() for c in ("set_a", "set_b"))
                keep.append(_similar(x, y, m.percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], ["a", "b"])

    return run


def _sets(m: Method):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in texts(batches):
            sets = [shingles(t, m.ngram).view(np.int64) for t in raw]
            ends = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
            flat = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(ends, flat)], ["id", "set"])

    return run


def _both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Attach a value of each side to the pairs (a, b)."""
    for side in ("a", "b"):
        pairs = pairs.join(values.select(F.col("id").alias(side), F.col(name).alias(f"{name}_{side}")), side)
    return pairs


def row_groups(flat: DataFrame, method: Method) -> DataFrame:
    """(id, text) to id, n (size of its set), root (smallest id that is reachable); each row has
    an id of its own."""
    m = method
    sk = stage(sketches(flat, m), "sketches")
    full = sk.where("n > 0")
    first = full.groupBy("digest", "n").agg(F.min("id").alias("rep"))
    member = stage(full.select("id", "digest", "n").join(first, ["digest", "n"]).select("id", "rep"), "members")
    reps = sk.join(member.where("id = rep").select("id"), "id", "left_semi").where("n > 0")
    sig = stage(reps.select("id", "sig"), "signatures")
    rows = reps.select("id", F.explode(F.array_distinct("keys")).alias("bucket"))
    many = rows.groupBy("bucket").count().where("count > 1").select("bucket")
    rows = stage(rows.join(many, "bucket", "left_semi").select("bucket", "id"), "buckets")
    wanted = rows.select("id").distinct()
    sets = stage(flat.join(wanted, "id", "left_semi").mapInArrow(_sets(m), "id long, set array<long>"), "sets")

    # Shingles of one candidate only can't be part of any intersection.
    single = sets.select("id", F.explode("set").alias("s")).groupBy("s").agg(F.count("*").alias("c"), F.min("id").alias("id"))
    single = single.where("c = 1").groupBy("id").agg(F.count("*").alias("alone"))
    facts = sets.select("id", F.size("set").cast("long").alias("n")).join(single, "id", "left")
    facts = facts.select("id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))
    facts = stage(sig.join(facts, "id"), "facts")

    label = flat.sparkSession.createDataFrame([], "id long, label long")
    parts = int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    leaders = 1
    while True:
        act = rows.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
        act = stage(act, "active")
        mixed = act.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"))
        mixed = mixed.where("lo < hi").select("bucket", F.ceil(F.col("size") / SLICE).alias("slices"), F.least("size", F.lit(leaders)).alias("lead"))
        act = stage(act.join(mixed, "bucket"), "active")
        if act.isEmpty():
            break
        rank = F.expr("row_number() OVER (PARTITION BY bucket ORDER BY id)")
        lead = act.withColumn("k", rank).where(F.col("k") <= leaders)
        lead = stage(lead.withColumn("part", F.floor((F.col("k") - 1) / LEAD)), "leaders")
        every_slice = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
        every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("lead") - 1) / LEAD)))
        own_slice = F.pmod(F.xxhash64("id"), F.col("slices"))
        kept = ["bucket", "id", "label", "slice", "part"]
        block = lead.withColumn("slice", every_slice).select(*kept, F.lit(0).alias("member"))
        block = block.union(act.withColumn("slice", own_slice).withColumn("part", every_part).select(*kept, F.lit(1).alias("member")))
        place = ["bucket", "slice", "part"]
        block = block.join(facts, "id")
        # The first round has a row per member and few survivors: their sets are joined to them.
        # Later rounds have few rows but maybe many survivors: the rows bring their sets along.
        verify = leaders > 1
        block = (block.join(sets, "id") if verify else block).repartition(parts, *place).sortWithinPartitions(*place, "member")
        links = block.mapInArrow(_compare(m, verify), "a long, b long").distinct()
        if not verify:
            links = _both(links, sets, "set").mapInArrow(_linked(m), "a long, b long")
        links = stage(links, "verified")
        last = lead.groupBy("bucket").agg(F.max("id").alias("last"))
        rows = act.join(last, "bucket").where("id > last").select("bucket", "id")
        label = _relabel(label, links)
        leaders *= 32
    roots = member.join(label.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("label", "rep").alias("root"))
    return sk.select("id", "n").join(roots, "id", "left").select("id", "n", F.coalesce("root", "id").alias("root"))


def near_groups(docs: DataFrame, *, id: str = "doc_id", text: str = "text", method: Method = Method()) -> DataFrame:
    """Groups of documents linked, directly or in chains, by similar shingle sets.

    Rows are told apart by a number of their own. Equal sets collapse to their first row. Band
    keys propose pairs, but no bucket emits its pairs: in each round the smallest numbers of a
    bucket, 1, then 32, 1024, ... of them, lead. Blocks of at most SLICE members and LEAD leaders
    meet in a task, and a leader is compared with the members after it that are not yet in its
    component; then it leaves the bucket. Buckets of one component end, so a group of many near
    copies costs about one comparison per member, and no proposed pair between components is left
    out. A pair is dropped without loss when even all shingles that either document shares with
    any candidate would not do; else it is compared by batches of signature values and dropped
    when its posterior chance falls below ``method.miss``. Survivors are verified on their full
    sets of 64-bit shingle hashes.

    Returns one row per input row: ``id``, ``n_shingles``, ``component_id`` (smallest id that is
    reachable), ``kept``. Null, empty and blank texts have no shingles and link with nothing.
    Rows that repeat an id are linked each by its own text and then share the smallest component
    that any of them reaches. A row with a null id links with nothing, has a null component and is
    kept. An empty table gives an empty result; other columns are ignored.
    """
    rows, key = keyed(docs, "near-input")
    rows = rows.select(F.col(key).alias("id"), F.col(id).cast("long").alias("name"), F.col(text).alias("text"))
    named = rows.where("name IS NOT NULL").select("id", "name")
    groups = stage(row_groups(rows.where("name IS NOT NULL").select("id", "text"), method).join(named, "id"), "row-groups")
    least = groups.groupBy("root").agg(F.min("name").alias("least"))
    reached = groups.join(least, "root").groupBy("name").agg(F.min("least").alias("least"))
    out = groups.join(reached, "name").select("name", "n", "least")
    nameless = stage(sketches(rows.where("name IS NULL").select("id", "text"), method).select("n"), "nameless")
    out = out.unionByName(nameless.select(F.lit(None).cast("long").alias("name"), "n", F.lit(None).cast("long").alias("least")))
    return out.select(
        F.col("name").alias(id), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), F.coalesce(F.col("name") == F.col("least"), F.lit(True)).alias("kept")
    )


def _relabel(label: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the components that ``links`` joins have become one."""
    for side in ("a", "b"):
        to = label.select(F.col("id").alias(side), F.col("label").alias("_to"))
        links = links.join(to, side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
    moved = components(links)
    was = label.join(moved, F.col("label") == F.col("node"), "left").select("id", F.coalesce("root", "label").alias("label"))
    return stage(was.union(moved.toDF("id", "label")), "labels")


def drop_near_copies(docs: DataFrame, *, id: str = "doc_id", text: str = "text", method: Method = Method()) -> DataFrame:
    """One row of each group, that of the smallest id; columns are unchanged. Groups are made of
    rows: those with null or repeated ids link by their texts like any other. A row with a null
    id is left only if its group has no other; rows without shingles are all left."""
    rows, key = keyed(docs, "near-rows")
    ids = stage(rows.select(key, F.col(id).alias("_id")), "near-ids")
    groups = row_groups(rows.select(F.col(key).alias("id"), F.col(text).alias("text")), method)
    groups = stage(groups.select(F.col("id").alias(key), "root"), "near-groups")
    many = groups.groupBy("root").agg(F.count("*").alias("size")).where("size > 1").select("root")
    copies = stage(groups.join(many, "root").join(ids, key), "near-copies")
    left = copies.groupBy("root").agg(F.min(first_row("_id", key)).alias("least")).select(F.col("least.row").alias(key))
    gone = stage(copies.join(left, key, "left_anti").select(key), "near-gone")
    return rows.join(gone, key, "left_anti").select(docs.columns)
