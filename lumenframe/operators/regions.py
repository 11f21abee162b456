"""Neighbourhood jobs on grid points by tiles: components, components at many thresholds, and
greedy suppression.

Space is cut into tiles; a tile's points meet in one task, which settles what it can see, and only
what lies at the tiles' faces is joined. Tasks see a stretch of whole tiles as numpy arrays.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.functions.scale import cut
from lumenframe.operators.walk import components

HELD = 100_000  # rows after which the whole tiles that a task has gathered are settled
TILE = 16  # points of a tile along each axis, where nothing else is asked for

Shift = tuple[int, ...]


def half_ball(dims: int, *, reach: int = 1, near: Callable[[Shift], bool] = lambda s: True) -> list[Shift]:
    """One of each pair of opposite steps between neighbouring points."""
    steps = itertools.product(range(-reach, reach + 1), repeat=dims)
    return [s for s in steps if s > (0,) * dims and near(s)]


def _tile(keys: Sequence[str], places: Sequence[Column]) -> Column:
    """Name of a tile: its keys and its place, as text so that keys of any type tell tiles apart."""
    return F.to_json(F.struct(*[F.col(k) for k in keys], *[p.alias(f"_t{i}") for i, p in enumerate(places)]), {"ignoreNullFields": "false"})


def by_tiles(rows: DataFrame, settle: Callable[[pa.Table, np.ndarray], pa.Table | Iterator[pa.Table]], schema: T.StructType, *, parts: int | None = None) -> DataFrame:
    """``settle`` on stretches of whole tiles: it gets the rows, sorted by ``_tile``, and the number
    of each row's tile, and gives a table or, where that may be much longer, one after the other.
    ``parts`` fixes the number of tasks, where few bytes are much work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            name = table.column("_tile").combine_chunks()
            name = name.chunk(0) if isinstance(name, pa.ChunkedArray) else name
            if table.num_rows:
                got = settle(table, name.dictionary_encode().indices.to_numpy())
                for part in [got] if isinstance(got, pa.Table) else got:
                    yield from part.to_batches(max_chunksize=50_000)

        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= HELD:
                table = pa.Table.from_batches(held)
                name = table.column("_tile").to_pylist()
                end = size
                while end and name[end - 1] == name[-1]:  # the last tile may go on
                    end -= 1
                yield from out(table.slice(0, end))
                held = table.slice(end).to_batches()
                size -= end
        if size:
            yield from out(pa.Table.from_batches(held))

    # By a hash of the name: a shuffle by the name itself is left out after a join by it, and then
    # lost when that join turns into a broadcast.
    name = F.xxhash64("_tile")
    dealt = (rows.repartition(parts, name) if parts else rows.repartition(name)).sortWithinPartitions("_tile")
    return dealt.mapInArrow(run, schema)


class Joined:
    """Sets of points that grow together; the smallest member stands for a set."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        parent = self.parent
        while True:
            x, y = parent[a], parent[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent[:] = up


def _neighbours(at: np.ndarray, tile: np.ndarray, size: Sequence[int], shifts: Sequence[Shift]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one tile that are a shift apart; no two rows of a tile share a place."""
    reach = max((abs(v) for s in shifts for v in s), default=0)
    code = tile.astype(np.int64)
    strides = []
    for i, n in enumerate(size):
        code = code * (n + 2 * reach) + at[:, i] % n + reach
        strides = [x * (n + 2 * reach) for x in strides] + [1]
    order = np.argsort(code)
    code = code[order]
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in shifts:
        want = code + sum(v * x for v, x in zip(s, strides, strict=True))
        found = np.minimum(np.searchsorted(code, want), len(code) - 1)
        hit = code[found] == want
        a.append(order[hit])
        b.append(order[found[hit]])
    return np.concatenate(a), np.concatenate(b)


def _places(table: pa.Table, coords: Sequence[str]) -> np.ndarray:
    return np.stack([table.column(c).to_numpy().astype(np.int64) for c in coords], axis=1)


def _smallest(id: np.ndarray, root: np.ndarray) -> np.ndarray:
    least = id.copy()
    np.minimum.at(least, root, id)
    return least[root]


def _faces(rows: DataFrame, coords: Sequence[str], keys: Sequence[str], size: Sequence[int], shifts: Sequence[Shift], values: Sequence[str]) -> DataFrame:
    """Pairs of points of different tiles that are a shift apart, with the ``values`` of both
    (as a_ and b_): only points within reach of a face are probed, only into other tiles."""
    reach = max(abs(v) for s in shifts for v in s)
    at_face = F.lit(False)
    for c, n in zip(coords, size, strict=True):
        inside = F.pmod(F.col(c), F.lit(n))
        at_face = at_face | (inside < reach) | (inside >= n - reach)
    rim = rows.where(at_face).select(*keys, *coords, *values)
    steps = F.array(*[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate(s)]) for s in shifts])
    probe = rim.select(*keys, *coords, *[F.col(v).alias(f"a_{v}") for v in values], F.explode(steps).alias("_s"))
    leaves = F.lit(False)
    for i, (c, n) in enumerate(zip(coords, size, strict=True)):
        leaves = leaves | (F.floor((F.col(c) + F.col(f"_s.d{i}")) / n) != F.floor(F.col(c) / n))
    probe = probe.where(leaves).select(*keys, *[(F.col(c) + F.col(f"_s.d{i}")).alias(c) for i, c in enumerate(coords)], *[f"a_{v}" for v in values])
    other = rim.select(*keys, *coords, *[F.col(v).alias(f"b_{v}") for v in values])
    on = F.lit(True)
    other = other.select(*[F.col(c).alias(f"_o_{c}") for c in (*keys, *coords)], *[f"b_{v}" for v in values])
    for c in (*keys, *coords):
        same = F.col(c).eqNullSafe(F.col(f"_o_{c}")) if c in keys else F.col(c) == F.col(f"_o_{c}")
        on = on & same
    return probe.join(other, on).select(*[f"a_{v}" for v in values], *[f"b_{v}" for v in values])


def _sizes(tile: int | Sequence[int], dims: int, shifts: Sequence[Shift]) -> list[int]:
    size = [tile] * dims if isinstance(tile, int) else list(tile)
    reach = max(abs(v) for s in shifts for v in s)
    return [max(n, reach) for n in size]


def labelled(points: DataFrame, coords: Sequence[str], *, shifts: Sequence[Shift], id: str = "id", keys: Sequence[str] = (), tile: int | Sequence[int] = TILE) -> DataFrame:
    """``points`` with ``_label``, the smallest id of their component inside their tile."""
    size = _sizes(tile, len(coords), shifts)
    named = points.withColumn("_tile", _tile(keys, [F.floor(F.col(c) / n) for c, n in zip(coords, size, strict=True)]))

    def settle(table: pa.Table, of: np.ndarray) -> pa.Table:
        sets = Joined(table.num_rows)
        sets.join(*_neighbours(_places(table, coords), of, size, shifts))
        label = _smallest(table.column(id).to_numpy().astype(np.int64), sets.parent)
        return table.drop_columns("_tile").append_column("_label", pa.array(label))

    return by_tiles(named, settle, T.StructType([*points.schema.fields, T.StructField("_label", T.LongType())]))


def joined_labels(rows: DataFrame, coords: Sequence[str], *, shifts: Sequence[Shift], keys: Sequence[str] = (), tile: int | Sequence[int] = TILE) -> DataFrame:
    """(_label, comp) for the labels of ``labelled`` rows that meet others at a tile's face."""
    pairs = _faces(rows, coords, keys, _sizes(tile, len(coords), shifts), shifts, ["_label"])
    edges = cut(pairs.select(F.least("a__label", "b__label").alias("a"), F.greatest("a__label", "b__label").alias("b")).distinct())
    ends = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    return components(ends, edges).select(F.col("id").alias("_label"), "comp")


def tiled_components(points: DataFrame, coords: Sequence[str], *, shifts: Sequence[Shift], id: str = "id", keys: Sequence[str] = (), tile: int | Sequence[int] = TILE) -> DataFrame:
    """Connected components of points at whole-number places, no two of a key at one place:
    ``points`` with ``comp``, the smallest id of each point's component.

    Tiles are labelled on their own; what goes on is pairs of labels that meet on a face, so the
    rounds that follow shuffle rows in proportion to the tiles' surface, and points are shuffled
    once. Points are neighbours if a step of ``shifts`` leads from one to the other; ``keys`` tell
    grids apart.
    """
    rows = cut(labelled(points, coords, shifts=shifts, id=id, keys=keys, tile=tile))
    joined = joined_labels(rows, coords, shifts=shifts, keys=keys, tile=tile)
    out = rows.join(joined, "_label", "left")
    return out.select(*points.columns, F.coalesce("comp", "_label").alias("comp"))


def level_components(
    points: DataFrame, coords: Sequence[str], *, value: str, thresholds: Sequence[float], shifts: Sequence[Shift], id: str = "id", keys: Sequence[str] = (), tile: int | Sequence[int] = TILE
) -> DataFrame:
    """The components above every threshold, from one component tree: (keys, level, comp, peak
    place, ``value`` at the peak, npix).

    Points join in falling order of value, so the sets at one threshold grow from those at the
    next higher one and every edge is looked at once. A tile gives one row per level and set; the
    sets of all levels that meet on faces are joined in one run. ``level`` is the place in
    ``thresholds``; a point belongs to a level if it is above its threshold. The peak is the
    largest value, ties at the smallest place; ``comp`` is the smallest id.
    """
    marks = np.array(sorted(thresholds), float)
    place = {float(t): i for i, t in enumerate(thresholds)}
    order = F.array(*[F.lit(place[float(t)]) for t in marks])
    shifts = list(shifts)
    size = _sizes(tile, len(coords), shifts)
    above = points.where(F.col(value) > float(marks[0])).select(*keys, *coords, F.col(id).cast("long").alias("_id"), F.col(value).cast("double").alias("_v"))
    named = above.withColumn("_tile", _tile(keys, [F.floor(F.col(c) / n) for c, n in zip(coords, size, strict=True)]))
    fields = [*above.schema.fields, T.StructField("_labels", T.ArrayType(T.LongType()))]

    def settle(table: pa.Table, of: np.ndarray) -> pa.Table:
        v, ids = table.column("_v").to_numpy(), table.column("_id").to_numpy()
        levels = np.searchsorted(marks, v, "left")  # the thresholds below a point
        a, b = _neighbours(_places(table, coords), of, size, shifts)
        both, sets, labels = np.minimum(levels[a], levels[b]), Joined(table.num_rows), []
        for k in range(len(marks), 0, -1):
            sets.join(a[both == k], b[both == k])
            # Only members of the level count for its smallest id.
            own = np.where(levels >= k, ids, np.iinfo(np.int64).max)
            labels.append(_smallest(own, sets.parent))
        labels = np.stack(labels[::-1], axis=1)
        ends = np.cumsum(np.r_[0, levels]).astype(np.int32)
        flat = labels[np.arange(len(marks))[None, :] < levels[:, None]]
        return table.drop_columns("_tile").append_column("_labels", pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))

    rows = cut(by_tiles(named, settle, T.StructType(fields)))
    # A set of level k has the number label * levels + k in the run that joins all levels.
    many = len(marks)
    pairs = _faces(rows, coords, keys, size, shifts, ["_labels"])
    both = F.least(F.size("a__labels"), F.size("b__labels"))  # the levels that have both points
    shared = F.arrays_zip(F.slice("a__labels", 1, both).alias("a"), F.slice("b__labels", 1, both).alias("b"), F.sequence(F.lit(0), both - 1).alias("k"))
    pairs = pairs.select(F.explode(shared).alias("e"))
    low, high = F.least("e.a", "e.b"), F.greatest("e.a", "e.b")
    edges = cut(pairs.select((low * many + F.col("e.k")).alias("a"), (high * many + F.col("e.k")).alias("b")).distinct())
    ends = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    joined = components(ends, edges)
    sets = rows.select(*keys, *coords, "_v", F.posexplode("_labels").alias("_k", "_label"))
    peak = F.max(F.struct(F.col("_v"), *[(-F.col(c)).alias(f"_n{i}") for i, c in enumerate(coords)]))
    sets = sets.groupBy(*keys, "_k", "_label").agg(peak.alias("_p"), F.count("*").alias("npix"))
    sets = sets.withColumn("id", F.col("_label") * many + F.col("_k")).join(joined, "id", "left")
    sets = sets.groupBy(*keys, "_k", F.coalesce("comp", "id").alias("_c")).agg(F.max("_p").alias("_p"), F.sum("npix").alias("npix"))
    return sets.select(
        *keys, F.get(order, F.col("_k")).alias("level"), F.floor(F.col("_c") / many).alias("comp"),
        *[(-F.col(f"_p._n{i}")).alias(c) for i, c in enumerate(coords)], F.col("_p._v").alias(value), "npix",
    )


# --- suppression --------------------------------------------------------------------------

OPEN, KEPT, GONE = 0, 1, 2


def _greedy(at: np.ndarray, half: np.ndarray, step: np.ndarray, order: np.ndarray, state: np.ndarray, home: np.ndarray) -> None:
    """Go through the rows of a tile from strong to weak and settle those that can be: ``state``
    changes in place. A row of another tile stays open unless a kept one is near it."""
    cells: dict[tuple, list[int]] = {}
    cell = np.floor(at / step).astype(np.int64)
    around = list(itertools.product((-1, 0, 1), repeat=at.shape[1]))
    for i in np.flatnonzero(state == KEPT):
        cells.setdefault(tuple(cell[i]), []).append(i)
    for i in order:
        if state[i] != OPEN:
            continue
        c, waits = tuple(cell[i]), not home[i]
        for d in around:
            for j in cells.get(tuple(x + y for x, y in zip(c, d, strict=True)), ()):
                if (np.abs(at[j] - at[i]) <= half).all():
                    if state[j] == KEPT:
                        state[i] = GONE
                        break
                    waits = True
            if state[i] == GONE:
                break
        if state[i] == GONE:
            continue
        if not waits:
            state[i] = KEPT
        cells.setdefault(c, []).append(i)


def strongest_apart(cand: DataFrame, *, half: dict[str, float], strength: str, id: str, keys: Sequence[str] = (), tile: int = 8) -> DataFrame:
    """Ids of the candidates that going through all from strong to weak keeps: one is dropped if
    a kept one lies within ``half`` of it along every axis. Ties: the lower id is stronger.

    Tiles settle all candidates whose fate does not hang on an open stronger one of another tile;
    neighbours across the faces are copied to them. What stays open meets again in tiles of twice
    the size, so a chain of any length ends after a number of rounds that is logarithmic in its
    extent, and a round has only open candidates and kept ones near them.
    """
    axes = list(half)
    size = np.array([float(h) for h in half.values()])
    step = np.where(size > 0, size, 1.0)  # edge of a cell of neighbours
    rows = cand.select(F.col(id).cast("long").alias("_id"), *keys, *[F.col(a).cast("double").alias(a) for a in axes], F.col(strength).cast("double").alias("_s"))
    rows = cut(rows.withColumn("_state", F.lit(OPEN)))
    schema = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_state", T.IntegerType())])

    def settle(table: pa.Table, of: np.ndarray) -> pa.Table:
        ids, s = table.column("_id").to_numpy(), table.column("_s").to_numpy()
        at = np.stack([table.column(a).to_numpy() for a in axes], axis=1)
        state, home = table.column("_state").to_numpy().copy(), table.column("_home").to_numpy(zero_copy_only=False)
        for first, end in zip(*(lambda c: (c[:-1], c[1:]))(np.r_[0, np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)]), strict=True):
            part = slice(first, end)
            _greedy(at[part], size, step, np.lexsort((ids[part], -s[part])), state[part], home[part])
        was = table.column("_state").to_numpy()
        new = home & (was == OPEN) & (state != OPEN)
        return pa.table({"_id": pa.array(ids[new]), "_state": pa.array(state[new].astype(np.int32))})

    while True:
        open_ = rows.where(F.col("_state") == OPEN)
        if open_.isEmpty():
            return rows.where(F.col("_state") == KEPT).select(F.col("_id").alias(id))
        # A row goes to every tile that its box touches: its own one, and those across a face.
        spread = rows
        for i, (a, h) in enumerate(half.items()):
            edge = float(tile * step[i])
            spread = spread.withColumn(f"_t{i}", F.explode(F.sequence(F.floor((F.col(a) - h) / edge), F.floor((F.col(a) + h) / edge))))
            spread = spread.withColumn(f"_h{i}", F.col(f"_t{i}") == F.floor(F.col(a) / edge))
        home = F.lit(True)
        for i in range(len(axes)):
            home = home & F.col(f"_h{i}")
        spread = spread.withColumn("_home", home).withColumn("_tile", _tile(keys, [F.col(f"_t{i}") for i in range(len(axes))]))
        busy = spread.where((F.col("_state") == OPEN) & F.col("_home")).select("_tile").distinct()
        spread = spread.join(busy, "_tile", "left_semi").select("_id", *axes, "_s", "_state", "_home", "_tile")
        settled = cut(by_tiles(spread, settle, schema)).withColumnRenamed("_state", "_new")
        rows = cut(rows.join(settled, "_id", "left").withColumn("_state", F.coalesce("_new", "_state")).drop("_new").where(F.col("_state") != GONE))
        tile *= 2
