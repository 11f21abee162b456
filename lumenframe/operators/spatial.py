"""Sky and plane joins."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.functions.cells import plane_pairs, sky_cells
from lumenframe.functions.exprs import angular_distance_arcsec, usable
from lumenframe.functions.scale import all_of, cut, measured, on_keys, quantiles
from lumenframe.operators.regions import _tile, by_tiles
from lumenframe.operators.select import cover_join


def xmatch_sky(a: DataFrame, b: DataFrame, *, radius_arcsec: float, nearest: bool = False) -> DataFrame:
    """Pairs of ``a(id, ra, dec)`` and ``b(id, ra, dec)`` within a radius: ``id_a, id_b, sep``.

    ``b`` is copied to neighbouring zones and cells; put the smaller catalogue there. With
    ``nearest`` only the closest ``b`` of each ``a`` stays (ties: lowest id), chosen by an
    aggregate that combines before the shuffle.
    """
    left = a.select(F.col("id").alias("id_a"), F.col("ra").alias("ra_a"), F.col("dec").alias("dec_a"))
    right = b.select(F.col("id").alias("id_b"), F.col("ra").alias("ra_b"), F.col("dec").alias("dec_b"))
    left, right = sky_cells(left, right, big_radec=("ra_a", "dec_a"), small_radec=("ra_b", "dec_b"), radius_deg=radius_arcsec / 3600.0)
    on = ["_zone", "_racell"]
    left, right = _spread(left, right, on, ["id_a", "ra_a", "dec_a"])
    on.append("_part")
    # A fixed number of parts on both sides: few bytes of a field that is crowded make many pairs.
    parts = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    pairs = left.repartition(parts, *on).join(right.repartition(parts, *on), on)
    # Most pairs are told by the declination alone.
    pairs = pairs.where(F.abs(F.col("dec_a") - F.col("dec_b")) <= radius_arcsec / 3600.0 * (1 + 1e-9))
    sep = angular_distance_arcsec(F.col("ra_a"), F.col("dec_a"), F.col("ra_b"), F.col("dec_b"))
    pairs = pairs.withColumn("sep", sep).where(F.col("sep") <= radius_arcsec).select("id_a", "id_b", "sep")
    if not nearest:
        return pairs
    best = pairs.groupBy("id_a").agg(F.min(F.struct("sep", "id_b")).alias("m"))
    return best.select("id_a", "m.id_b", "m.sep")


LOAD, ROWS = 10_000_000, 50_000  # pairs to look at, rows of the dealt side, that meet in one tile
BLOCK = 250_000  # pairs that a task looks at together
LEAF, SPLIT, DEPTH = 32, 3, 10  # nodes of a leaf; a cell has 8 x 8 children; 30 bits a coordinate


def _node_tree(nodes: DataFrame, keys: Sequence[str]) -> list[DataFrame]:
    """Cells of nodes ``(keys, _n0, _n1, _node)``, level by level: (keys, cx, cy, inner, leaves).

    The rows of a level are the cells of the level above with more than LEAF nodes (the first has
    one row, all nodes of a key); ``inner`` are their children with more than LEAF nodes in turn
    and ``leaves`` the others, with the tight box of their nodes and, for leaves, the nodes. So the
    tree is as deep as the nodes crowd, and a row has 64 children of at most LEAF nodes.
    """
    keys = list(keys)
    ends = nodes.groupBy(*keys).agg(*[f(c).alias(f"_{n}{c}") for c in ("_n0", "_n1") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    rows = on_keys(nodes, ends, keys)
    for i in (0, 1):
        span = F.col(f"_hi_n{i}") - F.col(f"_lo_n{i}")
        part = F.when(span > 0, (F.col(f"_n{i}") - F.col(f"_lo_n{i}")) / span).otherwise(0.0)
        rows = rows.withColumn(f"_q{i}", F.floor(part * ((1 << SPLIT * DEPTH) - 1)))
    rows = cut(rows.select(*keys, "_n0", "_n1", "_node", "_q0", "_q1"))
    levels = []
    for level in range(1, DEPTH + 1):
        shift = SPLIT * (DEPTH - level)
        cell = [F.shiftright(f"_q{i}", shift).alias(f"c{i}") for i in (0, 1)]
        up = [F.shiftright(f"c{i}", SPLIT).alias(f"p{i}") for i in (0, 1)]
        box = [F.min("_n0").alias("x0"), F.max("_n0").alias("x1"), F.min("_n1").alias("y0"), F.max("_n1").alias("y1"), F.count("*").alias("n")]
        cells = cut(rows.groupBy(*keys, *cell).agg(*box).withColumn("leaf", (F.col("n") <= LEAF) | F.lit(level == DEPTH)))
        named = rows.withColumns({f"c{i}": F.shiftright(f"_q{i}", shift) for i in (0, 1)})
        at = [*keys, "c0", "c1"]
        full = named.join(cells.where("leaf").select(*at), at).groupBy(*at).agg(F.collect_list(F.struct("_n0", "_n1", "_node")).alias("nodes"))
        whole = cells.join(full, at, "left").select(*keys, *up, F.struct("c0", "c1", "x0", "x1", "y0", "y1", "n", "leaf", "nodes").alias("c"))
        levels.append(whole.groupBy(*keys, "p0", "p1").agg(F.collect_list("c").alias("cells")))
        inner = cells.where("NOT leaf").select(*at)
        if inner.isEmpty():
            break
        rows = cut(named.join(inner, at, "left_semi").drop("c0", "c1"))
    return levels


def _bounds(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances along one axis of points to the nearest place of cells' boxes, their nearer and
    their farther side: each side of a tight box has a node."""
    low, high = lo - v[:, None], v[:, None] - hi
    return np.maximum(np.maximum(low, high), 0.0), np.minimum(np.abs(low), np.abs(high)), np.maximum(np.abs(low), np.abs(high))


def _nearest(points: DataFrame, levels: Sequence[DataFrame], keys: Sequence[str], *, id: str, other: bool = False) -> DataFrame:
    """Nearest node of every point ``(id, keys, _p0, _p1)``: (id, keys, m) with m a struct
    (d2, node). With ``other``, nodes at the point itself do not count.

    In a level, the points that are in a cell meet its row of children in one task, which takes them
    as arrays; a cell with many points is dealt out. A point first goes straight down, in each level
    to one child that has a node near for certain, and so gets the distance of a real node. With
    this bound it goes down again and leaves each level with the children that may hold something
    nearer, and with the nearest node of those that are leaves. Copies of a point in several cells
    know nothing of each other; without the bound they all go on.
    """
    keys = list(keys)
    front = points.where(all_of([F.col(k).isNotNull() for k in keys])).withColumn("_bound", F.lit(float("inf")))
    led = _down(front, levels, keys, id=id, other=other, lead=True)
    out = _down(led.select(front.columns), levels, keys, id=id, other=other, lead=False).where("d2 IS NOT NULL")
    return out.groupBy(id, *keys).agg(F.min(F.struct("d2", "node")).alias("m"))


def _down(front: DataFrame, levels: Sequence[DataFrame], keys: Sequence[str], *, id: str, other: bool, lead: bool) -> DataFrame:
    """What leaves the tree when points ``(id, keys, _p0, _p1, _bound)`` go down all ``levels``: see
    ``_descend``."""
    parts = int(front.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    front = front.withColumns({"p0": F.lit(0).cast("long"), "p1": F.lit(0).cast("long")})
    at = [*keys, "p0", "p1"]
    found = []
    for cells in levels:
        here, tree = _spread(front, cells, at, [id])
        tile = _tile([*at, "_part"], [])
        rows = here.select(tile.alias("_tile"), *keys, id, "_p0", "_p1", "_bound").unionByName(tree.select(tile.alias("_tile"), "cells"), allowMissingColumns=True)
        node = cells.schema["cells"].dataType.elementType["nodes"].dataType.elementType["_node"].dataType
        fields = [rows.schema[c] for c in (*keys, id, "_p0", "_p1", "_bound")] + [T.StructField(c, T.LongType()) for c in ("p0", "p1")]
        schema = T.StructType([*fields, T.StructField("d2", T.DoubleType()), T.StructField("node", node)])
        met = cut(by_tiles(rows, _descend(schema.names, other, lead), schema, parts=parts))
        found.append(met.where("p0 IS NULL").drop("p0", "p1"))
        front = met.where("p0 IS NOT NULL").drop("d2", "node")
    return functools.reduce(DataFrame.unionByName, found)


def _descend(names: Sequence[str], other: bool, lead: bool) -> Callable[[pa.Table, np.ndarray], Iterator[pa.Table]]:
    """One level of ``_nearest`` for the points of a tile and the children of their cell. A box around
    the point itself is sure by its farthest corner, and only if it has a second node.

    Rows with ``p0`` go on to that cell. The others are done: nearest nodes of leaves, or with ``lead``,
    where every point has one row a level, the point with the bound that it has found."""
    own = [c for c in names if c not in ("_bound", "p0", "p1", "d2", "node")]

    def step(t: pa.Table, c: dict[str, np.ndarray], nodes: pa.StructArray, first: np.ndarray) -> Iterator[pa.Table]:
        x, y = (t.column(p).to_numpy() for p in ("_p0", "_p1"))
        (nx, sx, fx), (ny, sy, fy) = _bounds(x, c["x0"], c["x1"]), _bounds(y, c["y0"], c["y1"])
        sure = np.minimum(sx * sx + fy * fy, fx * fx + sy * sy)
        if other:
            sure = np.where((nx > 0) | (ny > 0), sure, np.where(c["n"] > 1, fx * fx + fy * fy, np.inf))
        # What is nearer than any sure distance: a hair more, so that ties are never lost.
        bound = np.minimum(t.column("_bound").to_numpy(), sure.min(axis=1)) * (1 + 1e-12)
        if lead:
            i, j = np.arange(len(x)), np.where(np.isfinite(sure), sure, np.finfo(float).max).argmin(axis=1)
        else:
            i, j = np.nonzero(nx * nx + ny * ny <= bound[:, None])
        down = ~c["leaf"][j]

        def rows(i: np.ndarray, **cols) -> pa.Table:
            base = t.take(pa.array(i))
            have = {**{k: base.column(k) for k in own}, "_bound": bound[i], **cols}
            return pa.table({k: have[k] if k in have else pa.nulls(len(i), kinds[k]) for k in names})

        kinds = {"p0": pa.int64(), "p1": pa.int64(), "d2": pa.float64(), "node": nodes.type.field("_node").type}
        if down.any():
            yield rows(i[down], p0=c["c0"][j[down]], p1=c["c1"][j[down]])
        i, j = i[~down], j[~down]
        ended = i
        size = first[j + 1] - first[j]
        at = np.repeat(first[j] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        i = np.repeat(i, size)
        dx, dy = (nodes.field(n).to_numpy()[at] - v[i] for n, v in (("_n0", x), ("_n1", y)))
        d2 = dx * dx + dy * dy
        if other:
            at, i, d2 = at[d2 > 0], i[d2 > 0], d2[d2 > 0]
        if lead:
            np.minimum.at(bound, i, d2)
            yield rows(ended)
            return
        # Nodes of a leaf are in order, leaves are not: of equally near ones, the lowest of each leaf stays.
        order = np.lexsort((d2, i))
        least = np.full(len(x), np.inf)
        top = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
        least[i[top]] = d2[top]
        tied = d2 == least[i]
        if tied.any():
            yield rows(i[tied], d2=d2[tied], node=nodes.field("_node").take(pa.array(at[tied])))

    def settle(table: pa.Table, tiles: np.ndarray) -> Iterator[pa.Table]:
        ends = [0, *(np.flatnonzero(np.diff(tiles)) + 1).tolist(), len(tiles)]
        for lo, hi in itertools.pairwise(ends):
            t = table.slice(lo, hi - lo)
            is_cell = t.column("cells").is_valid()
            points, cells = t.filter(pc.invert(is_cell)).drop_columns(["cells"]), t.filter(is_cell).column("cells")
            if not points.num_rows or not len(cells):
                continue
            cells = pa.concat_arrays(cells.chunks).flatten()
            c = {n: cells.field(n).to_numpy(zero_copy_only=False) for n in ("c0", "c1", "x0", "x1", "y0", "y1", "n", "leaf")}
            lists = cells.field("nodes")
            first = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
            for start in range(0, points.num_rows, BLOCK // 64):
                yield from step(points.slice(start, BLOCK // 64), c, lists.flatten(), first)

    return settle


def nearest_node(
    points: DataFrame, nodes: DataFrame, *, id: str, xy: Sequence[str], node_id: str, node_xy: Sequence[str], keys: Sequence[str] = (), radius: float | None = None
) -> DataFrame:
    """Nearest node of every point, whatever the distance: ``id, node_id, dist`` (ties: the lowest
    node).

    Nodes are counted in cells of falling size, each an eighth of the last along both axes, as
    long as a cell has many. A point goes down this tree and in each level meets only children of
    the cells it is still in; those that are farther than some node is for certain end there. So
    a point meets a few cells of each level, however far or crowded the nodes are, and the number
    of rounds is the logarithm of the crowding. Nodes at one place count once. Points of a key
    without any node get no row. Points and nodes without finite coordinates or number take no
    part. ``radius``, a guess of the distance, is no longer of use.
    """
    p = points.select(id, *keys, *[F.col(c).cast("double").alias(f"_p{i}") for i, c in enumerate(xy)]).where(usable(F.col("_p0")) & usable(F.col("_p1")))
    n = nodes.select(F.col(node_id).alias("_node"), *keys, *[F.col(c).cast("double").alias(f"_n{i}") for i, c in enumerate(node_xy)])
    n = n.where(F.col("_node").isNotNull() & usable(F.col("_n0")) & usable(F.col("_n1")))
    n = n.groupBy(*keys, "_n0", "_n1").agg(F.min("_node").alias("_node"))
    best = _nearest(p, _node_tree(n, keys), keys, id=id)
    return best.select(id, *keys, F.col("m.node").alias(node_id), F.sqrt("m.d2").alias("dist"))


def nearest_bin(spaxel: DataFrame, nodes: DataFrame, *, keys: Sequence[str] = ("field",), radius: float = 1.0) -> DataFrame:
    """Outside spaxels get the nearest bin node; a boolean marks them, since -0 cannot."""
    out = nearest_node(
        spaxel.where("NOT inside"), nodes, id="target_id", xy=("x", "y"), node_id="bin_id", node_xy=("bin_x", "bin_y"), keys=keys, radius=radius
    )
    return out.select(*keys, "target_id", "bin_id").withColumn("is_outside", F.lit(True))


def not_near_catalogue(candidates: DataFrame, objects: DataFrame, *, radius: float = 4.0, keys: Sequence[str] = ()) -> DataFrame:
    """Candidates ``(ix, iy)`` without an object ``(ox, oy)`` within ``radius`` pixels."""
    return plane_pairs(candidates, objects.select(*keys, "ox", "oy"), big_xy=("ix", "iy"), small_xy=("ox", "oy"), radius=radius, how="left_anti", keys=keys)


def bright_source_mask(
    px: DataFrame, objects: DataFrame, *, factor: float = 3.0, min_radius: float = 5.0, cell: float = 10.0, keep: bool = True, keys: Sequence[str] = ()
) -> DataFrame:
    """Pixels outside (or inside) max(min, factor * sqrt(a b)) of every object."""
    radius = F.greatest(F.lit(min_radius), F.sqrt(F.greatest(F.col("a") * F.col("b"), F.lit(0.0))) * factor)
    o = objects.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "ox", "oy", radius.alias("_r"))
    dx, dy = F.col("ix") - F.col("ox"), F.col("iy") - F.col("oy")
    exact = dx * dx + dy * dy <= F.col("_r") * F.col("_r")
    for k in keys:
        exact = exact & (F.col(k) == F.col(f"_k_{k}"))
    return cover_join(
        px, o, xy=("ix", "iy"), centre=(F.col("ox"), F.col("oy")), half=(F.col("_r"), F.col("_r")), cell=cell, exact=exact, how="left_anti" if keep else "left_semi"
    )


def _lens(d: np.ndarray, r1: float, r2: float) -> np.ndarray:
    """``lens_area`` of arrays."""
    safe = np.where(d == 0, 1.0, d)
    a1 = np.arccos(np.clip((safe * safe + (r1 * r1 - r2 * r2)) / (safe * (2 * r1)), -1.0, 1.0))
    a2 = np.arccos(np.clip((safe * safe + (r2 * r2 - r1 * r1)) / (safe * (2 * r2)), -1.0, 1.0))
    k = ((r1 + r2) - safe) * (safe + (r1 - r2)) * (safe - (r1 - r2)) * (safe + (r1 + r2))
    lens = a1 * (r1 * r1) + a2 * (r2 * r2) - np.sqrt(np.maximum(k, 0.0)) * 0.5
    return np.where(d >= r1 + r2, 0.0, np.where(d <= abs(r1 - r2), math.pi * min(r1, r2) ** 2, lens))


def _spread(big: DataFrame, small: DataFrame, on: Sequence[str], name: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_part``: what meets at one value of ``on`` is split into so many parts that
    none has more than LOAD pairs or ROWS rows of ``big``, which ``name`` deals out; ``small`` is copied
    to each. Only values that are split are kept in the table of parts."""
    on = list(on)
    many = big.groupBy(*on).agg(F.count("*").alias("_a")).join(small.groupBy(*on).agg(F.count("*").alias("_b")), on)
    parts = F.ceil(F.greatest(F.col("_a") * F.col("_b") / LOAD, F.col("_a") / ROWS))
    crowded = measured(many.select(*on, parts.alias("_parts")).where("_parts > 1"))
    big = big.join(crowded, on, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*name), F.col("_parts")), F.lit(0).cast("long"))).drop("_parts")
    small = small.join(crowded, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return big, small


def _lens_pairs(s: DataFrame, f: DataFrame, keys: Sequence[str], weigh: Callable[[np.ndarray], np.ndarray], *, reach: float, per: str | None, shares: bool) -> DataFrame:
    """Weights of fibres ``(keys, fibre_id, nspec, _x, _y)`` in spaxels ``(keys, spaxel_id, _x, _y)``, with
    ``shares`` divided by the spaxel's sum; summed as ``per`` says.

    Cells are as wide as the reach. A spaxel lies in one, where it meets copies of all fibres that it
    can reach, so that its sum needs no shuffle of pairs. A task looks at BLOCK pairs at a time.
    """
    keys = list(keys)
    size = max(reach, 1e-9) * (1 + 1e-9)
    home = [F.floor(F.col(c) / size) for c in ("_x", "_y")]
    s = s.withColumns({"_c0": home[0], "_c1": home[1]})
    f = f.withColumn("_c0", F.explode(F.array(home[0] - 1, home[0], home[0] + 1))).withColumn("_c1", F.explode(F.array(home[1] - 1, home[1], home[1] + 1)))
    s, f = _spread(s, f, [*keys, "_c0", "_c1"], ["spaxel_id", "_x", "_y"])
    tile = _tile([*keys, "_c0", "_c1", "_part"], [])
    rows = s.select(tile.alias("_tile"), *keys, F.lit(False).alias("_fibre"), "_x", "_y", "spaxel_id")
    rows = rows.unionByName(f.select(tile.alias("_tile"), *keys, F.lit(True).alias("_fibre"), "_x", "_y", "fibre_id", "nspec"), allowMissingColumns=True)
    own = {None: ["spaxel_id", "fibre_id", "nspec"], "nspec": ["spaxel_id", "nspec"], "spaxel_id": ["spaxel_id"]}[per]
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in [*keys, *own]] + [T.StructField("weight", T.DoubleType())])

    def one(t: pa.Table) -> Iterator[pa.Table]:
        fibre = t.column("_fibre").to_numpy()
        a, b = (t.filter(pa.array(side)).sort_by("_y").combine_chunks() for side in (~fibre, fibre))
        if not a.num_rows or not b.num_rows:
            return
        ax, ay, bx, by = (x.column(c).to_numpy() for x in (a, b) for c in ("_x", "_y"))
        if per == "nspec":
            kinds = pa.concat_arrays(b.column("nspec").chunks).dictionary_encode(null_encoding="encode")
            code, n_kinds = kinds.indices.to_numpy(), len(kinds.dictionary)
        step = max(1, BLOCK // b.num_rows)
        for lo in range(0, a.num_rows, step):
            sx, sy = ax[lo : lo + step, None], ay[lo : lo + step, None]
            first, last = np.searchsorted(by, (sy[0, 0] - size, sy[-1, 0] + size))
            x, y = sx - bx[first:last], sy - by[first:last]
            d2 = x * x + y * y
            i, j = np.nonzero(d2 <= reach * reach)
            w, j = weigh(np.sqrt(d2[i, j])), j + first
            i, j, w = i[w > 0], j[w > 0], w[w > 0]
            if shares:
                w = w / np.bincount(i, weights=w, minlength=len(x))[i]
            if per is not None:
                group = i * n_kinds + code[j] if per == "nspec" else i
                w, met = np.bincount(group, weights=w), np.bincount(group)
                i, w = np.flatnonzero(met), w[met > 0]
                if per == "nspec":
                    i, j = np.divmod(i, n_kinds)
            at = pa.array(i + lo)
            cols = {c: a.column(c).take(at) for c in [*keys, "spaxel_id"]}
            if per == "nspec":
                cols["nspec"] = kinds.dictionary.take(pa.array(j))
            elif per is None:
                cols |= {c: b.column(c).take(pa.array(j)) for c in ("fibre_id", "nspec")}
            yield pa.table({**{c: cols[c] for c in [*keys, *own]}, "weight": w})

    def settle(table: pa.Table, tiles: np.ndarray) -> Iterator[pa.Table]:
        ends = [0, *(np.flatnonzero(np.diff(tiles)) + 1).tolist(), len(tiles)]
        for lo, hi in itertools.pairwise(ends):
            yield from one(table.slice(lo, hi - lo))

    return by_tiles(rows, settle, schema, parts=int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def overlap_weights(
    spaxel: DataFrame, fibre: DataFrame, *, fibre_radius: float, spaxel_radius: float, weighting: str = "overlap", keys: Sequence[str] = (), per: str | None = None
) -> DataFrame:
    """Weight of each fibre position in each spaxel: area of the common lens, or 1/d^2.

    RA is scaled by cos of the mean declination of the spaxels. Rows sum to 1 per spaxel; a
    spaxel without fibres has no row. Only fibres within r1 + r2 meet a spaxel, and they do so in
    one task (``_lens_pairs``), where they are weighed and summed as arrays: pairs are neither
    shuffled nor sorted. ``per`` sums the weights: "nspec" gives a row per spaxel and fibre number,
    "spaxel_id" one per spaxel with any fibre. Spaxels that share a number share their sum, too.
    """
    keys = list(keys)
    mean = measured(spaxel.groupBy(*keys).agg(F.cos(F.radians(F.avg("dec"))).alias("_cos")))
    there = [F.abs(c) < F.lit(float("inf")) for c in ("_x", "_y")] + [F.col(k).isNotNull() for k in keys]
    place = [(F.col("ra") * F.col("_cos")).cast("double").alias("_x"), F.col("dec").cast("double").alias("_y")]
    s = on_keys(spaxel, mean, keys).select("spaxel_id", *keys, *place).where(all_of(there))
    f = on_keys(fibre, mean, keys).select("fibre_id", "nspec", *keys, *place).where(all_of(there))
    least = max(fibre_radius, spaxel_radius) * 1e-3

    def weigh(d: np.ndarray) -> np.ndarray:
        return _lens(d, fibre_radius, spaxel_radius) if weighting == "overlap" else 1.0 / np.maximum(d, least) ** 2

    how = {"keys": keys, "weigh": weigh, "reach": fibre_radius + spaxel_radius}
    name = [*keys, "spaxel_id"]
    again = measured(s.groupBy(*name).count().where("count > 1").select(*[F.col(c).alias(f"_n_{c}") for c in name]))
    if again.isEmpty():
        return _lens_pairs(s, f, per=per, shares=True, **how)
    same = all_of([F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in name])
    out = _lens_pairs(s.join(again, same, "left_anti"), f, per=None, shares=True, **how)
    # Bounded by the fibres that all spaxels of one number reach.
    shared = _lens_pairs(s.join(again, same, "left_semi"), f, per=None, shares=False, **how)
    out = out.unionByName(shared.withColumn("weight", F.col("weight") / F.sum("weight").over(Window.partitionBy(*name))))
    return out if per is None else out.groupBy(*dict.fromkeys([*name, per])).agg(F.sum("weight").alias("weight"))


def target_times_ephemeris(target: DataFrame, ephemeris: DataFrame, template: Sequence[tuple[float, float]], *, radius_arcsec: float = 1.0) -> DataFrame:
    """Pulsation phase and systemic velocity of targets that match an ephemeris entry.

    The phase is the fraction toward zero of (t - epoch) / period. The velocity template is a
    short configured list of (phase, value); its entry nearest in phase is used.
    """
    pairs = xmatch_sky(target, ephemeris, radius_arcsec=radius_arcsec)
    out = pairs.join(target.select(F.col("id").alias("id_a"), "jd", "rv"), "id_a")
    out = out.join(ephemeris.select(F.col("id").alias("id_b"), "epoch", "period", "amp"), "id_b")
    cycles = (F.col("jd") - F.col("epoch")) / F.col("period")
    out = out.withColumn("phase", cycles - F.when(cycles >= 0, F.floor(cycles)).otherwise(F.ceil(cycles)))
    entries = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.lit(float(v)).alias("v")) for p, v in template])
    gaps = F.transform(entries, lambda e, i: F.struct(F.abs(e["p"] - F.col("phase")).alias("d"), i.alias("i"), e["v"].alias("v")))
    out = out.withColumn("curve", F.array_min(gaps)["v"])
    return out.withColumn("v_sys", F.col("rv") - (F.col("amp") * 25.6 + 35.0) * F.col("curve"))


def central_item(items: DataFrame, *, keys: Sequence[str] = (), id: str = "id") -> DataFrame:
    """Item nearest to the mean position of its group, cos(dec) applied; items without a
    position are ignored (ties: lowest id). Two aggregates, no window over the group."""
    keys = list(keys)
    ok = items.where(usable(F.col("ra")) & usable(F.col("dec")))
    mean = measured(ok.groupBy(*keys).agg(F.avg("ra").alias("_ra0"), F.avg("dec").alias("_dec0")))
    rows = on_keys(ok, mean, keys)
    dx = (F.col("ra") - F.col("_ra0")) * F.cos(F.radians("_dec0"))
    dy = F.col("dec") - F.col("_dec0")
    best = rows.groupBy(*keys).agg(F.min(F.struct((dx * dx + dy * dy).alias("d2"), F.col(id))).alias("m"))
    return best.select(*keys, F.col("m")[id].alias(id), (F.sqrt("m.d2") * 3600.0).alias("dist_arcsec"))


def neighbour_spacing(items: DataFrame, *, fallback_parts: float = 60.0, id: str = "id") -> DataFrame:
    """Half the median distance (degrees) to the nearest other item, zero distances ignored;
    with fewer than two items the span divided by 60. One row.

    Positions are made unique first, then each finds its nearest other one down the tree of nodes.
    """
    ok = items.where(usable(F.col("ra")) & usable(F.col("dec")))
    stats = ok.agg(F.avg("dec").alias("d0"), F.count("*").alias("n"), (F.max("ra") - F.min("ra")).alias("sr"), (F.max("dec") - F.min("dec")).alias("sd")).first()
    cos = _cos_deg(stats["d0"] or 0.0)
    spot = ok.select((F.col("ra") * cos).alias("x"), F.col("dec").alias("y")).distinct()
    spot = cut(spot.withColumn("sid", F.struct("x", "y")))
    n = spot.count()
    span = max((stats["sr"] or 0.0) * cos, stats["sd"] or 0.0)
    spark = items.sparkSession
    if n < 2:
        return spark.createDataFrame([(span / fallback_parts if span else 0.0, int(n))], "spacing double, n bigint")
    nodes = spot.select(F.col("x").alias("_n0"), F.col("y").alias("_n1"), F.col("sid").alias("_node"))
    asked = spot.select("sid", F.col("x").alias("_p0"), F.col("y").alias("_p1"))
    found = _nearest(asked, _node_tree(nodes, []), [], id="sid", other=True).select("sid", F.sqrt("m.d2").alias("dist"))
    # Items sharing a position count once each: weight the distances by their number.
    per_item = ok.select(F.struct((F.col("ra") * cos).alias("x"), F.col("dec").alias("y")).alias("sid")).join(found, "sid")
    return quantiles(per_item, [], "dist", {"m": 0.5}).select((F.col("m") / 2).alias("spacing")).withColumn("n", F.lit(int(n)).cast("bigint"))


def _cos_deg(x: float) -> float:
    import math

    return math.cos(math.radians(x))
