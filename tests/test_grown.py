"""Steps that took time or memory out of proportion to larger tables."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions.exprs import lens_area
from lumenframe.operators import detect, ranges, spatial


def test_no_frame_to_the_end_of_a_partition(spark):
    """Such a frame is computed anew for each row: 30,000 rows of a partition read 450 million."""
    curve = spark.range(2000).select(F.lit(1).alias("curve_id"), (F.col("id") * 3.0).alias("wave"), F.sin("id").alias("value"))
    asked = spark.range(30_000).select("id", F.lit(1).alias("curve_id"), (F.col("id") * 0.25 - 100).alias("x"))
    out = ranges.interp_at(asked, curve, x="x", clamp=True)
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
    got = out.toPandas().sort_values("id")
    want = np.interp(got.x, np.arange(2000) * 3.0, np.sin(np.arange(2000)))
    assert len(got) == 30_000 and got.value.to_numpy() == pytest.approx(want, abs=1e-9)


def test_pairs_of_fibres_and_spaxels_are_not_shuffled(frame):
    """Weights of a crowded field: sums as over all pairs, a window or sort over none of them."""
    r = np.random.default_rng(5)
    s = [(None if i == 7 else i, i % 2, 10 + float(a), 20 + float(b)) for i, (a, b) in enumerate(r.uniform(0, 0.01, (300, 2)))]
    s += [(5, 1, 10.001, 20.001), (5, 1, 10.002, 20.001), (400, 0, None, 20.0), (401, 0, 50.0, 20.0), (402, None, 10.0, 20.0)]
    f = [(j, None if j % 5 == 0 else j % 5, j % 2, 10 + float(a), 20 + float(b)) for j, (a, b) in enumerate(r.uniform(0, 0.01, (200, 2)))]
    spaxel, fibre = frame(s, "spaxel_id long, k int, ra double, dec double"), frame(f, "fibre_id long, nspec int, k int, ra double, dec double")
    how = {"fibre_radius": 0.0015, "spaxel_radius": 0.001, "keys": ["k"]}
    plan = spatial.overlap_weights(spaxel.where("spaxel_id > 5"), fibre, **how)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    cos = {k: math.cos(math.radians(np.mean([x[3] for x in s if x[1] == k]))) for k in (0, 1)}
    pair = [(x, y, math.hypot((x[2] - y[3]) * cos[x[1]], x[3] - y[4])) for x in s if x[2] and x[1] is not None for y in f if x[1] == y[2]]
    d = frame([(z,) for _, _, z in pair], "d double")
    area = [t.a for t in d.coalesce(1).select(lens_area(F.col("d"), 0.0015, 0.001).alias("a")).collect()]
    total, want = defaultdict(float), {None: defaultdict(float), "nspec": defaultdict(float), "spaxel_id": defaultdict(float)}
    for (x, y, _), a in zip(pair, area, strict=True):
        total[x[1], x[0]] += a
    for (x, y, _), a in zip(pair, area, strict=True):
        if a > 0:
            share = a / total[x[1], x[0]]
            for per, name in ((None, (y[0], y[1])), ("nspec", (y[1],)), ("spaxel_id", ())):
                want[per][(x[1], x[0], *name)] += share
    for per, cols in ((None, ["fibre_id", "nspec"]), ("nspec", ["nspec"]), ("spaxel_id", [])):
        got = defaultdict(float)
        for t in spatial.overlap_weights(spaxel, fibre, per=per, **how).collect():
            got[(t.k, t.spaxel_id, *[t[c] for c in cols])] += t.weight
        assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want[per].items()}


def test_a_crowded_cell_is_dealt_out(frame, monkeypatch):
    monkeypatch.setattr(spatial, "LOAD", 500)
    monkeypatch.setattr(spatial, "BLOCK", 100)
    tiles, by = [], spatial.by_tiles
    monkeypatch.setattr(spatial, "by_tiles", lambda rows, *a, **k: tiles.append(rows.groupBy("_tile").count().count()) or by(rows, *a, **k))
    spaxel = frame([(i, 10.0 + i * 1e-7, 20.0) for i in range(100)], "spaxel_id int, ra double, dec double")
    fibre = frame([(j, j % 3, 10.0 + j * 1e-7, 20.0) for j in range(60)], "fibre_id int, nspec int, ra double, dec double")
    got = spatial.overlap_weights(spaxel, fibre, fibre_radius=0.0015, spaxel_radius=0.001, per="nspec").groupBy("spaxel_id").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    assert len(got) == 100 and all(t.n == 3 and t.w == pytest.approx(1.0) for t in got)
    assert tiles[0] >= 12


@pytest.mark.parametrize("rows", [50_000, 40])
def test_points_do_not_carry_cells(frame, monkeypatch, rows):
    """A point that carried its cell's children with all their nodes took 1 ms a level; points of one
    cell are dealt out."""
    monkeypatch.setattr(spatial, "ROWS", rows)
    seen, cut = [], spatial.cut
    monkeypatch.setattr(spatial, "cut", lambda df: seen.append(df.schema) or cut(df))
    r = np.random.default_rng(3)
    p = np.concatenate([r.uniform(0, 1, (400, 2)), r.integers(0, 9, (500, 2)) / 8.0, r.normal(size=(200, 2)) * 1e-5])
    n = np.concatenate([r.uniform(0, 1, (900, 2)), r.integers(0, 9, (300, 2)) / 8.0])
    points = frame([(f"p{i}", i % 2, float(a), float(b)) for i, (a, b) in enumerate(p)] + [("none", None, 0.5, 0.5)], "id string, k int, x double, y double")
    nodes = frame([(f"n{i:04d}", i % 2, float(a), float(b)) for i, (a, b) in enumerate(n)] + [("null", None, 0.5, 0.5)], "node string, k int, nx double, ny double")
    got = {t.id: (t.node, t.dist) for t in spatial.nearest_node(points, nodes, id="id", xy=("x", "y"), node_id="node", node_xy=("nx", "ny"), keys=["k"]).collect()}
    want = {}
    for i, (a, b) in enumerate(p):
        d2 = (n[:, 0] - a) * (n[:, 0] - a) + (n[:, 1] - b) * (n[:, 1] - b)
        j = min((j for j in range(len(n)) if j % 2 == i % 2), key=lambda j: (d2[j], j))
        want[f"p{i}"] = (f"n{j:04d}", math.sqrt(d2[j]))
    assert got == want
    met = [s for s in seen if "_bound" in s.names]
    assert met and all("array" not in f.dataType.simpleString() for s in met for f in s.fields)


def test_a_crowded_sky_is_dealt_out(frame, monkeypatch):
    """All items in one cell and one input split: pairs come from several tasks."""
    monkeypatch.setattr(spatial, "LOAD", 1000, raising=False)
    r = np.random.default_rng(4)
    a, b = (r.uniform(0, 0.004, (n, 2)) for n in (200, 150))
    left, right = (frame([(i, 10 + float(x), 20 + float(y)) for i, (x, y) in enumerate(p)] + [(999, None, 20.0)], "id long, ra double, dec double").coalesce(1) for p in (a, b))
    got = spatial.xmatch_sky(left, right, radius_arcsec=4.0).withColumn("part", F.spark_partition_id()).collect()
    assert len({t.part for t in got}) > 1
    x, y = np.radians(a + [10, 20])[:, None], np.radians(b + [10, 20])[None]
    h = np.sin((y[..., 1] - x[..., 1]) / 2) ** 2 + np.cos(x[..., 1]) * np.cos(y[..., 1]) * np.sin((y[..., 0] - x[..., 0]) / 2) ** 2
    sep = np.degrees(2 * np.arcsin(np.sqrt(h))) * 3600
    assert sorted((t.id_a, t.id_b) for t in got) == sorted((int(i), int(j)) for i, j in np.argwhere(sep <= 4.0))


def test_parts_of_the_filter_follow_the_voxels(spark, frame, monkeypatch):
    """Small shuffles are merged to few tasks, whose sums then grew with the table."""
    monkeypatch.setattr(detect, "PART", 40, raising=False)
    r = np.random.default_rng(6)
    data = r.normal(size=(3, 5, 8, 9))
    v = frame([(c, *(int(x) for x in p), float(data[(c, *p)]), 1.0) for c in range(3) for p in np.ndindex(5, 8, 9)], "cube int, iw int, iy int, ix int, data double, ivar double")
    how = {"spectral_sigmas": [0.7, 1.5], "spatial_sigma": 0.8, "bounds": {"iw": (0, 4), "iy": (0, 7), "ix": (0, 8)}, "keys": ["cube"]}
    seen, cut = [], detect.cut
    monkeypatch.setattr(detect, "cut", lambda df: seen.append((lambda out: out.rdd.getNumPartitions())(df)) or cut(df))
    few = detect.matched_filter_bank(v, **how)
    assert seen[0] >= 3 * 5 * 8 * 9 // 40
    monkeypatch.setattr(detect, "PART", 10**9, raising=False)
    many = detect.matched_filter_bank(v, **how)
    at = ["cube", "width", "iw", "iy", "ix"]
    a, b = (df.toPandas().sort_values(at).reset_index(drop=True)[[*at, "snr"]] for df in (few, many))
    assert len(a) == 3 * 5 * 8 * 9 * 2 and a[at].equals(b[at]) and a.snr.to_numpy() == pytest.approx(b.snr.to_numpy(), abs=1e-9)


def test_copies_of_a_point_end_early(spark, monkeypatch):
    """A copy in a neighbouring cell did not know how near a node is in the point's own cell: at a depth
    of three levels a point was in ten cells."""
    nodes = spark.range(20_000).select(F.col("id").alias("node"), F.rand(1).alias("nx"), F.rand(2).alias("ny"))
    points = spark.range(20_000).select("id", F.rand(3).alias("x"), F.rand(4).alias("y"))
    seen, cut = [], spatial.cut
    monkeypatch.setattr(spatial, "LEAF", 2)
    monkeypatch.setattr(spatial, "cut", lambda df: (lambda out: seen.append((out.columns, out.count())) or out)(cut(df)))
    got = spatial.nearest_node(points, nodes, id="id", xy=("x", "y"), node_id="node", node_xy=("nx", "ny")).toPandas().set_index("id")
    n, p = nodes.toPandas().to_numpy(), points.toPandas().to_numpy()
    for i, x, y in p[::97]:
        d2 = (n[:, 1] - x) ** 2 + (n[:, 2] - y) ** 2
        assert got.node[i] == n[d2.argmin(), 0] and got.dist[i] == pytest.approx(math.sqrt(d2.min()), rel=1e-9)
    met = [rows for c, rows in seen if "_bound" in c]
    assert len(got) == 20_000 and len(met) >= 3 and max(met) <= 3 * 20_000


def test_the_filter_makes_no_row_per_tap(frame, monkeypatch):
    """A row per voxel and tap was 14 rows per voxel in the last pass; lines cut by batches and slices."""
    r = np.random.default_rng(8)
    rows = [(c if c else None, *(int(x) for x in p), None if r.random() < 0.1 else float(r.normal()), float(r.random())) for c in range(3) for p in np.ndindex(6, 7, 5) if r.random() < 0.4]
    v = frame(rows, "cube int, iw long, iy int, ix long, data double, ivar double")
    plans, cut = [], detect.cut
    monkeypatch.setattr(detect, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    monkeypatch.setattr(detect, "HELD", 20, raising=False)
    monkeypatch.setattr(detect, "PLACES", 30, raising=False)
    bounds, widths = {"iw": (1, 5), "iy": (0, 6), "ix": (0, 5)}, (0.7, 1.5)
    got = detect.matched_filter_bank(v, spectral_sigmas=widths, spatial_sigma=0.8, bounds=bounds, coverage=0.0, keys=["cube"])
    assert "Generate" not in plans[0]
    n, d = defaultdict(lambda: None), defaultdict(float)
    space = detect.gauss_taps(0.8)
    for c, w, y, x, data, ivar in rows:
        for s in widths:
            for (o, a), (p, b), (q, e) in ((i, j, k) for i in detect.gauss_taps(s) for j in space for k in space):
                at = (c, s, w + o, y + p, x + q)
                if all(lo <= z <= hi for z, (lo, hi) in zip(at[2:], bounds.values(), strict=True)):
                    d[at] += ivar * (a * b * e) ** 2
                    n[at] = n[at] if data is None else (n[at] or 0.0) + ivar * data * a * b * e
    have = {(t.cube, t.width, t.iw, t.iy, t.ix): t.snr for t in got.collect()}
    # Places of a cube without a number meet no median and so are 0.
    assert have == {k: None if n[k] is None and k[0] is not None else pytest.approx(0.0 if k[0] is None else n[k] / math.sqrt(d[k]), abs=1e-9) for k in d}
