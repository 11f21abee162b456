"""Approximate nearest neighbours with learned partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.base import stage

SAMPLE = 8192  # vectors, at most, that the partitions and the classifier are fitted on
VISITED, SPARE = 0.42, 5.6  # share of the parts that a query visits, and parts besides: few parts cut more neighbours off
SLICE = 4096  # candidates of a partition that a task holds at once


def as_matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as a float64 matrix, and which rows take part: those of the first
    usable row's length without null, zero or non-finite vectors."""
    rows = [None if x is None else np.array(x, np.float64) for x in column.to_pylist()]
    ok = np.array([r is not None and len(r) > 0 and bool(np.isfinite(r).all()) and bool(r.any()) for r in rows], bool)
    return rows, ok


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each unit row."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at : at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -2
        out[at : at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20, slack: float = 1.1) -> np.ndarray:
    """Parts of about equal size that cut few edges of the graph.

    Halving at the median along main directions gives a balanced start; then nodes move to the
    part of most of their neighbours while that part has room.
    """
    label = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        g = groups.pop()
        c = x[g] - x[g].mean(axis=0)
        v = np.ones(x.shape[1])
        for _ in range(10):
            v = c.T @ (c @ v)
            v /= np.linalg.norm(v) or 1
        order = np.argsort(c @ v, kind="stable")
        groups += [g[order[: len(g) // 2]], g[order[len(g) // 2 :]]]
    for i, g in enumerate(groups):
        label[g] = i
    room = int(np.ceil(slack * len(x) / parts))
    size = np.bincount(label, minlength=parts)
    edges = np.concatenate([np.stack([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()]), np.stack([graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])])], axis=1)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (edges[0], label[edges[1]]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


class Router:
    """A small classifier from unit vectors to the log chances of the parts: one layer, learned
    from the parts of each sampled vector's neighbours and its own."""

    def __init__(self, x: np.ndarray, target: np.ndarray, epochs: int = 30, seed: int = 9):
        r = np.random.default_rng(seed)
        d = x.shape[1]
        w = [np.zeros((d, target.shape[1])), np.zeros(target.shape[1])]
        m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        x = x * d**0.5
        for epoch in range(epochs):
            order, rate = r.permutation(len(x)), 0.01 * (1 - epoch / epochs) + 1e-4
            for at in range(0, len(x), 256):
                b = order[at : at + 256]
                z = x[b] @ w[0] + w[1]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p = (p / p.sum(axis=1, keepdims=True) - target[b]) / len(b)
                t += 1
                for i, g in enumerate((x[b].T @ p + 1e-4 * w[0], p.sum(axis=0))):
                    m[i] += 0.1 * (g - m[i])
                    v[i] += 0.001 * (g * g - v[i])
                    w[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.w, self.scale, self.dim, self.parts = w, d**0.5, d, target.shape[1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, the most probable first."""
        return np.argsort(-(unit(x) * self.scale @ self.w[0] + self.w[1]), axis=1, kind="stable")


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest entry first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(vectors: DataFrame, parts: int | None) -> Router | None:
    """Partitions and classifier from at most SAMPLE vectors, those of smallest hash of the id.
    Without a number of parts, they grow with the square root of the vectors' number."""
    if parts is None:
        parts = max(int(4 * vectors.count() ** 0.5), 16)
    some = vectors.where(F.col("vec").isNotNull()).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow()
    rows, ok = as_matrix(some.column("vec").combine_chunks()) if some.num_rows else ([], np.empty(0, bool))
    rows = [r for r, use in zip(rows, ok, strict=True) if use]
    if not rows:
        return None
    dims = [len(r) for r in rows]
    dim = max(sorted(set(dims)), key=dims.count)
    x = np.stack([r for r in rows if len(r) == dim])
    x = unit(x)
    parts = max(min(parts, len(x) // 16), 1)
    if parts == 1:
        return Router(x, np.ones((len(x), 1)), 0)
    graph = neighbour_graph(x, min(20, len(x) - 1))
    label = balanced_parts(x, graph[:, :10], parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 0.5 / graph.shape[1])
    target[np.arange(len(x)), label] += 0.5
    return Router(x, target)


def _assign(router: Router, every: int, homes: int, probes: int):
    """Rows of the index (query 0) in their parts, and queries (query 1) for each part they visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, ok = as_matrix(b.column("vec"))
            use = np.array([i for i, o in enumerate(ok) if o and len(rows[i]) == router.dim], np.int64)
            if not len(use):
                continue
            x = np.stack([rows[i] for i in use])
            route = router(x / np.abs(x).max(axis=1, keepdims=True))
            id_ = b.column("id").to_numpy(zero_copy_only=False)[use].astype(np.int64)
            stays, visits = min(homes, route.shape[1]), min(probes, route.shape[1])
            asks = np.nonzero(id_ % every == 0)[0]
            who = np.r_[np.repeat(np.arange(len(use)), stays), np.repeat(asks, visits)]
            part = np.r_[route[:, :stays].ravel(), route[asks, :visits].ravel()]
            query = np.r_[np.zeros(len(use) * stays, np.int64), np.ones(len(asks) * visits, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(id_[who]), pa.array(part), pa.array(query), pa.array(list(x[who]), pa.list_(pa.float64()))], ["id", "part", "query", "vec"])

    return run


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in one order of operations, so that equal vectors get equal values."""
    x, y = (_tamed(v) for v in (x, y))
    dot, xx, yy = (np.einsum("ij,ij->i", a, b) for a, b in ((x, y), (x, x), (y, y)))
    return dot / (np.sqrt(xx) * np.sqrt(yy))


def _tamed(x: np.ndarray) -> np.ndarray:
    """Rows whose squares would overflow or vanish, scaled by a power of two, which keeps every
    digit; other rows as they are."""
    most = np.abs(x).max(axis=1, initial=0.0)
    wild = (most > 1e100) | ((most < 1e-100) & (most > 0))
    return np.ldexp(x, np.where(wild, -np.frexp(most)[1], 0)[:, None])


def _rerank(k: int):
    """Slices of a part, candidates before queries, to the k best candidates of each query."""

    def best(ids, x, qid, q):
        rows = unit(x)
        for at in range(0, len(qid), 128):
            own, vec = qid[at : at + 128], q[at : at + 128]
            s = unit(vec) @ rows.T
            s[own[:, None] == ids[None, :]] = -np.inf
            n = min(k, s.shape[1])
            bar = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n]
            i, j = np.nonzero((s >= bar[:, None] - 1e-9) & np.isfinite(s))
            score = cosines(vec[i], x[j])
            order = np.lexsort((ids[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            first = np.searchsorted(i, np.arange(len(own)))
            top = np.arange(len(i)) - first[i] < k
            yield pa.RecordBatch.from_arrays([pa.array(own[i[top]]), pa.array(ids[j[top]]), pa.array(score[top])], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, x = None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            vec = np.stack(b.column("vec").to_numpy(zero_copy_only=False))
            id_, part, slice_, query = (b.column(c).to_numpy() for c in ("id", "part", "slice", "query"))
            change = (part[1:] != part[:-1]) | (slice_[1:] != slice_[:-1]) | (query[1:] != query[:-1])
            for rows in np.split(np.arange(len(id_)), np.nonzero(change)[0] + 1):
                i = rows[0]
                here = (part[i], slice_[i])
                if not query[i]:
                    more = here == now
                    ids = np.r_[ids, id_[rows]] if more else id_[rows]
                    x = np.concatenate([x, vec[rows]]) if more else vec[rows]
                    now = here
                elif here == now:
                    yield from best(ids, x, id_[rows], vec[rows])

    return run


def routed(flat: DataFrame, *, every: int, parts: int | None, homes: int, probes: int | None) -> DataFrame | None:
    """(id, vec) to (id, part, query, vec): the parts that candidates are in and queries visit."""
    router = fit(flat, parts)
    if router is None:
        return None
    if probes is None:
        probes = int(np.ceil(VISITED * router.parts + SPARE))
    return stage(flat.mapInArrow(_assign(router, every, homes, probes), "id long, part long, query long, vec array<double>"), "routed")


def search(
    vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, parts: int | None = None, homes: int = 1, probes: int | None = None
) -> DataFrame:
    """The ``k`` nearest rows by cosine of every row whose id is divisible by ``every``.

    A neighbour graph of a bounded sample is cut into balanced parts, and a small classifier
    learns where the neighbours of a vector are. It puts every row into its most probable part
    (``homes`` of them) and sends a query to its ``probes`` most probable ones, by default VISITED
    of the parts and SPARE more: a query is compared with about that share of all rows, each once. Parts are
    dealt out in slices of about SLICE candidates, so a part full of equal vectors spreads over
    many tasks; a task compares a slice with the queries that visit it and keeps ``k`` each.
    ``probes`` of at least ``parts`` makes the search exact.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller id.
    Vectors that are null, zero, of another length than most or hold null or non-finite values
    take no part; a null id takes no part either. Rows that repeat an id are one candidate, with
    the best of their scores, and never one for that id. An empty table gives an empty result; other columns are
    ignored.
    """
    flat = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vec")).where(F.col("id").isNotNull())
    schema = "query_id long, rank int, vec_id long, score double"
    rows = routed(flat, every=every, parts=parts, homes=homes, probes=probes)
    if rows is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size = rows.where("query = 0").groupBy("part").count().select("part", F.ceil(F.col("count") / SLICE).alias("slices"))
    rows = rows.join(size, "part")
    own = F.array(F.pmod(F.xxhash64("id"), F.col("slices")))
    every_slice = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
    rows = rows.withColumn("slice", F.explode(F.when(F.col("query") == 0, own).otherwise(every_slice)))
    shuffled = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = rows.select("id", "part", "slice", "query", "vec").repartition(shuffled, "part", "slice")
    rows = rows.sortWithinPartitions("part", "slice", "query")
    near = rows.mapInArrow(_rerank(k), "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
