"""Jobs by tiles, trees and sorted partitions, against plain versions."""

import itertools
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import curves, detect, ranges, regions, spatial, spectra


def plain_components(places, near):
    root = {p: p for p in places}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for p in places:
        for s in near:
            q = tuple(a + b for a, b in zip(p, s, strict=True))
            if q in root:
                a, b = find(p), find(q)
                root[max(a, b)] = min(a, b)
    return {p: find(p) for p in places}


def test_component_over_many_tiles(frame):
    r = random.Random(4)
    rows, want, number = [], {}, 0
    for cube in (None, "a", "b"):
        # A winding path through many tiles, and noise around it.
        path = {(x, abs(x % 40 - 20), 0) for x in range(-150, 150)} | {(r.randrange(-160, 160), r.randrange(-5, 40), r.randrange(4)) for _ in range(1500)}
        ids = {p: number + i for i, p in enumerate(r.sample(sorted(path), len(path)))}
        number += len(path)
        groups = defaultdict(list)
        for p, g in plain_components(path, regions.half_ball(3)).items():
            groups[g].append(ids[p])
        for g in groups.values():
            want.update(dict.fromkeys(g, min(g)))
        rows += [(ids[p], cube, *p) for p in path]
    df = frame(rows, "id long, cube string, x int, y int, z int")
    got = regions.tiled_components(df, ("x", "y", "z"), shifts=regions.half_ball(3), keys=["cube"], tile=8)
    assert {row.id: row.comp for row in got.collect()} == want
    assert max(len(list(g)) for _, g in itertools.groupby(sorted(want.values()))) > 100
    labels = regions.labelled(df, ("x", "y", "z"), shifts=regions.half_ball(3), keys=["cube"], tile=8)
    assert labels.select("_label").distinct().count() > len(set(want.values()))
    assert regions.tiled_components(df.limit(0), ("x", "y", "z"), shifts=regions.half_ball(3), keys=["cube"]).collect() == []


def test_levels_are_as_each_threshold_alone(frame):
    r = np.random.default_rng(5)
    grid = r.normal(size=(3, 5, 30, 30))
    grid[:, :, 10:20, 10:20] += 1.5
    rows = [(c * 4500 + i, c, *(int(v) for v in p), float(grid[(c, *p)])) for c in range(3) for i, p in enumerate(np.ndindex(5, 30, 30))]
    df = frame(rows, "id long, cube int, iw int, iy int, ix int, snr double")
    marks = [2.0, 0.5, 1.2]
    got = regions.level_components(df, ("iw", "iy", "ix"), value="snr", thresholds=marks, shifts=regions.half_ball(3), keys=["cube"], tile=7)
    have = {(x.cube, x.level, x.comp, x.iw, x.iy, x.ix, x.snr, x.npix) for x in got.collect()}
    want = set()
    for k, mark in enumerate(marks):
        for c in range(3):
            ids = {x[2:5]: x[0] for x in rows if x[1] == c and x[5] > mark}
            groups = defaultdict(list)
            for p, g in plain_components(ids, regions.half_ball(3)).items():
                groups[g].append(p)
            for g in groups.values():
                peak = max(g, key=lambda p: (grid[(c, *p)], [-v for v in p]))
                want.add((c, k, min(ids[p] for p in g), *peak, float(grid[(c, *peak)]), len(g)))
    assert have == want


def test_purity_in_one_pass(frame):
    r = np.random.default_rng(6)
    data = r.normal(size=(2, 6, 20, 20))
    data[0, 2:5, 4:7, 4:7] += 3
    rows = [(c, *(int(v) for v in p), float(data[(c, *p)]), 1.0) for c in range(2) for p in np.ndindex(6, 20, 20)]
    v = frame(rows, "cube int, iw int, iy int, ix int, data double, ivar double")
    covered = v.where("NOT (ix = 3 AND iy = 3)").select("cube", "ix", "iy").distinct()
    bounds = {"iw": (0, 5), "iy": (0, 19), "ix": (0, 19)}
    bank = detect.matched_filter_bank(v, spectral_sigmas=[0.7, 1.5], spatial_sigma=0.8, bounds=bounds, keys=["cube"])
    bank = bank.withColumn("voxel_id", F.col("cube") * 10_000 + F.col("iw") * 400 + F.col("iy") * 20 + F.col("ix"))
    how = {"min_fraction": 0.1, "min_npix": 2, "max_npix": 60, "min_count": 2, "mad_k": 0.5, "min_distance": 2.0}
    marks = [1.5, 2.0, 2.6]
    got = {(x.cube, x.threshold): (x.n_pos, x.n_neg) for x in detect.post_veto_purity(bank, v, covered, thresholds=marks, nx=20, ny=20, keys=["cube"], **how).collect()}
    want = {(c, t): [0, 0] for c in range(2) for t in marks}
    for sign in (0, 1):
        one = v.withColumn("data", F.col("data") * (1 - 2 * sign))
        for t in marks:
            found = None
            for k, w in enumerate((0.7, 1.5)):
                cube = bank.where(F.col("width") == w).withColumn("snr", F.col("snr") * (1 - 2 * sign))
                part = detect.connected_voxels(cube, threshold=t, keys=["cube"]).withColumns({"width": F.lit(w), "cand_id": F.col("cand_id") * 2 + k})
                found = part if found is None else found.unionByName(part)
            kept = detect.dedupe_candidates(found, keys=["cube"])
            left = detect.resolved_only(kept, one, sigma="width", min_fraction=0.1, keys=["cube"]).where("npix BETWEEN 2 AND 60")
            left = detect.coincidence_veto(left, mad_k=0.5, min_count=2, keys=["cube"])
            left = detect.away_from_edge(left, covered, nx=20, ny=20, min_distance=2.0, keys=["cube"])
            for x in left.groupBy("cube").count().collect():
                want[x.cube, t][sign] = x["count"]
    assert got == {k: tuple(n) for k, n in want.items()}
    assert sum(map(sum, want.values())) > 0


def test_suppression_of_a_long_chain(spark, monkeypatch):
    n, rounds = 100_000, []
    cand = spark.range(n).select(F.col("id").alias("cand_id"), (F.lit(float(n)) - F.col("id")).alias("snr"), F.lit(1).alias("iw"), F.lit(1).alias("iy"), F.col("id").alias("ix"))
    by_tiles = regions.by_tiles
    monkeypatch.setattr(regions, "by_tiles", lambda *a: rounds.append(1) or by_tiles(*a))
    got = detect.dedupe_candidates(cand, dxy=3).agg(F.count("*"), F.sum("ix")).first()
    assert tuple(got) == (n // 4, sum(range(0, n, 4)))
    assert len(rounds) <= 2 + math.log2(n)


def test_suppression_is_greedy(frame):
    r = random.Random(9)
    rows = [(i, i % 3, r.choice([1.0, 2.0, r.random() * 3]), r.randrange(40), r.randrange(60), r.randrange(60)) for i in range(3000)]
    got = regions.strongest_apart(frame(rows, "id long, k int, s double, w int, y int, x int"), half={"w": 2, "y": 3, "x": 1.5}, strength="s", id="id", keys=["k"], tile=2)
    kept = []
    for c in sorted(rows, key=lambda c: (-c[2], c[0])):
        if not any(c[1] == k[1] and abs(c[3] - k[3]) <= 2 and abs(c[4] - k[4]) <= 3 and abs(c[5] - k[5]) <= 1.5 for k in kept):
            kept.append(c)
    assert {x.id for x in got.collect()} == {k[0] for k in kept}


def test_nearest_in_clusters_and_far_away(spark, frame):
    r = np.random.default_rng(2)
    nodes = np.concatenate([r.normal(size=(3000, 2)) * 1e-3 + c for c in ((0, 0), (5, 5), (5, 5.001))] + [r.uniform(-50, 50, (300, 2)), np.tile([[7.0, 7.0]], (60, 1))])
    points = np.concatenate([r.normal(size=(500, 2)) * 1e3, r.normal(size=(500, 2)) * 1e-2, nodes[:200], [[1e9, 0.0]]])
    nd = frame([(int(i % 2), int(i), float(x), float(y)) for i, (x, y) in enumerate(nodes)] + [(5, 1, 1.0, 1.0), (0, None, 0.0, 0.0), (0, 3, None, 0.0)], "k int, node long, nx double, ny double")
    pt = frame([(int(i % 2), int(i), float(x), float(y)) for i, (x, y) in enumerate(points)] + [(9, -1, 0.0, 0.0), (0, -2, None, 1.0)], "k int, id long, x double, y double")
    got = spatial.nearest_node(pt, nd, id="id", xy=("x", "y"), node_id="node", node_xy=("nx", "ny"), keys=["k"])
    have = {x.id: (x.node, x.dist) for x in got.collect()}
    assert set(have) == set(range(len(points)))
    for i, p in enumerate(points):
        own = np.arange(i % 2, len(nodes), 2)
        d2 = ((nodes[own] - p) ** 2).sum(axis=1)
        assert have[i][1] == pytest.approx(math.sqrt(d2.min()), rel=1e-9)
        assert d2[own == have[i][0]][0] == pytest.approx(d2.min(), rel=1e-12, abs=1e-300)


def test_far_points_meet_few_nodes(spark, monkeypatch):
    """Many points far from many nodes: rows in proportion to the points in every level."""
    nodes = spark.range(20_000).select(F.col("id").alias("node"), (F.rand(1)).alias("nx"), (F.rand(2)).alias("ny"))
    points = spark.range(20_000).select("id", (F.rand(3) * 100 + 1e4).alias("x"), (F.rand(4) * 100 - 1e4).alias("y"))
    seen, cut = [], spatial.cut
    monkeypatch.setattr(spatial, "cut", lambda df: (lambda out: seen.append((out.columns, out.count())) or out)(cut(df)))
    assert spatial.nearest_node(points, nodes, id="id", xy=("x", "y"), node_id="node", node_xy=("nx", "ny")).count() == 20_000
    met = [n for c, n in seen if "_bound" in c]
    assert met and max(met) <= 4 * 20_000


def test_spacing(frame):
    r = np.random.default_rng(7)
    p = np.concatenate([r.uniform(0, 1, (300, 2)), r.normal(size=(300, 2)) * 1e-4, [[50.0, 60.0]], np.tile([[0.5, 0.5]], (50, 1))])
    got = spatial.neighbour_spacing(frame([(int(i), float(a), float(b)) for i, (a, b) in enumerate(p)], "id long, ra double, dec double")).first()
    q = p * [math.cos(math.radians(p[:, 1].mean())), 1.0]
    d = np.sqrt(((q[:, None] - q[None]) ** 2).sum(axis=2))
    d[d == 0] = np.inf
    assert got.spacing == pytest.approx(np.median(d.min(axis=1)) / 2, rel=1e-6)


def test_clipping_by_key(spark, monkeypatch):
    r, rounds = np.random.default_rng(8), []
    x = r.normal(size=(1000, 40))
    x[::3, :3] += r.uniform(5, 500, (334, 3))
    rows = [(int(k), float(v)) for k in range(len(x)) for v in x[k]]
    df = spark.createDataFrame(rows, "k int, v double")
    cut = spectra.cut
    monkeypatch.setattr(spectra, "cut", lambda d: rounds.append(1) or cut(d))
    got = {t.k: t for t in spectra.clipped_centre(df, value="v", rounds=6, keys=["k"]).collect()}
    many = len(rounds)
    rounds.clear()
    one = spectra.clipped_centre(df.where("k = 0"), value="v", rounds=6).collect()
    assert many <= 14 and len(rounds) <= 14 and len(one) == 1 and one[0].median == pytest.approx(got[0].median)
    for k in range(len(x)):
        v, before = x[k], None
        for _ in range(6):
            if len(v) == before:
                break
            before = len(v)
            v = v[np.abs(v - np.median(v)) <= 3 * v.std()]
        assert (got[k].n, got[k].n_all) == (len(v), 40)
        assert got[k].median == pytest.approx(np.median(v)) and got[k].sigma == pytest.approx(v.std())


@pytest.mark.parametrize("small, crowd", [(10**6, 10**6), (0, 10**6), (0, 50)])
def test_bands_of_all_widths(frame, small, crowd):
    r = random.Random(3)
    rows = [(i, r.choice([r.uniform(-300, 300), 7.25, 7.25, 7.25, float(r.randrange(-20, 20))])) for i in range(800)] + [(900, None), (901, float("nan"))]
    bands = [(k, a, a + r.choice([0.0, 0.01, 1.0, 17.0, 400.0, 1e7])) for k in range(120) for a in [r.choice([r.uniform(-300, 300), 7.25, 7.0])]] + [(500, 5.0, 4.0)]
    got = ranges.band_join(frame(rows, "id int, wave double"), frame(bands, "band int, lo double, hi double"), width=1.0, small=small, crowd=crowd)
    assert got.columns == ["id", "wave", "band", "lo", "hi"]
    want = sorted((i, k) for i, x in rows for k, a, b in bands if x is not None and a <= x <= b)
    assert sorted((x.id, x.band) for x in got.collect()) == want


@pytest.mark.parametrize("clamp", [False, True])
def test_interpolation_over_long_gaps(frame, clamp):
    r = random.Random(11)
    curve = {k: sorted({r.choice([r.uniform(0, 10), r.uniform(0, 1e7), 5.0]) for _ in range(n)}) for k, n in (("a", 400), ("b", 7), ("c", 1), ("d", 2))}
    value = {(k, w): math.sin(w) for k, ws in curve.items() for w in ws}
    rows = [(k, w, v) for (k, w), v in value.items()] + [("a", 3.3, None), ("b", 3.3, float("nan"))]
    asked = [(i, r.choice("aaaabcde"), r.choice([r.uniform(-1, 11), r.uniform(0, 1.1e7), 5.0])) for i in range(1500)] + [(2000, "a", None)]
    got = ranges.interp_at(frame(asked, "id int, curve_id string, x double"), frame(rows, "curve_id string, wave double, value double"), x="x", clamp=clamp)
    assert got.columns == ["id", "curve_id", "x", "value"] and got.count() == len(asked)
    have = {t.id: t.value for t in got.collect()}
    for i, k, x in asked:
        ws = curve.get(k, [])
        if x is None or not ws or (not clamp and not ws[0] <= x <= ws[-1]):
            assert have[i] is None
        else:
            assert have[i] == pytest.approx(np.interp(x, ws, [value[k, w] for w in ws]), abs=1e-9)


def test_two_populations(spark):
    r = np.random.default_rng(1)
    v = np.concatenate([r.normal(2, 0.3, 700), r.normal(6, 0.8, 300)])
    rows = curves.two_populations(spark.createDataFrame([(float(x),) for x in v], "fwhm double"), "fwhm").collect()
    assert sum(x._c == (x.fwhm > 3.6) for x in rows) >= 990


def test_centres(spark):
    r = np.random.default_rng(1)
    rows = [(int(i), *map(float, r.normal(size=2) * 0.05 + [i % 4, 3 * (i % 4)])) for i in range(400)]
    out = curves.lloyd(spark.createDataFrame(rows, "i int, a double, b double"), ["a", "b"], k=4).collect()
    assert {(x.i % 4, x.bucket) for x in out} == {(k, k) for k in range(4)}
