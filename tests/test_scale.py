"""Helpers that must stay exact when one key holds most rows, and iterative jobs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions import scale
from lumenframe.operators import spatial, walk
from lumenframe.operators.detect import dedupe_candidates, group_candidates, neighbour_edges


@pytest.fixture
def skewed(frame):
    rng = random.Random(3)
    rows = [(0, rng.choice([1.0, 2.0, 2.0, rng.gauss(0, 5)]), i) for i in range(4000)]
    rows += [(k, rng.gauss(k, 1), 10_000 + k * 100 + i) for k in range(1, 30) for i in range(k % 7 + 1)]
    return frame(rows, "k int, v double, id bigint"), rows


def grouped(rows):
    out = {}
    for k, v, _ in rows:
        out.setdefault(k, []).append(v)
    return out


def test_bracketed_quantiles_are_exact(skewed):
    df, rows = skewed
    want = {"a": 0.0, "b": 0.16, "c": 0.5, "d": 0.975, "e": 1.0}
    got = {r["k"]: r for r in scale.quantiles(df, ["k"], "v", want, accuracy=200, direct_limit=0).collect()}
    for k, v in grouped(rows).items():
        for name, q in want.items():
            assert got[k][name] == pytest.approx(np.quantile(v, q), abs=1e-12)


def test_bracketed_quantiles_without_keys(skewed):
    df, rows = skewed
    got = scale.quantiles(df, [], "v", {"m": 0.5}, accuracy=100, direct_limit=0).first()["m"]
    assert got == pytest.approx(np.median([v for _, v, _ in rows]), abs=1e-12)


def test_top_rows(skewed, frame):
    df, rows = skewed
    counted = df.withColumn("n", F.when(F.col("k") == 0, 1234).otherwise(2))
    got = {(r["k"], r["id"]) for r in scale.top_rows(counted, ["k"], "v", "id", count="n").collect()}
    want = set()
    for k in grouped(rows):
        ranked = sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))
        want |= {(k, r[2]) for r in ranked[: 1234 if k == 0 else 2]}
    assert got == want


def test_next_value(skewed):
    df, rows = skewed
    got = {(r["k"], r["v"]): r["nxt"] for r in scale.next_value(df, ["k"], "v", parts=13).collect()}
    for k, v in grouped(rows).items():
        u = sorted(set(v))
        for a, b in zip(u, u[1:] + [None]):
            assert got[(k, a)] == b


def test_number_rows(skewed):
    df, rows = skewed
    got = scale.number_rows(df, [F.col("v").desc(), F.col("id")], "n", start=7).collect()
    order = [r["id"] for r in sorted(got, key=lambda r: r["n"])]
    assert order == [r[2] for r in sorted(rows, key=lambda r: (-r[1], r[2]))]
    assert [r["n"] for r in sorted(got, key=lambda r: r["n"])] == list(range(8, 8 + len(rows)))


def test_components_long_chain_and_star(frame):
    ids = list(range(300))
    random.Random(1).shuffle(ids)
    chain = list(zip(ids[:149], ids[1:150]))
    star = [(ids[150], x) for x in ids[151:290]]
    got = {r["id"]: r["comp"] for r in walk.components(frame([(i,) for i in ids], "id bigint"), frame(chain + star, "a bigint, b bigint")).collect()}
    assert {got[i] for i in ids[:150]} == {min(ids[:150])}
    assert {got[i] for i in ids[150:290]} == {min(ids[150:290])}
    assert all(got[i] == i for i in ids[290:])


def test_components_without_edges(frame):
    got = walk.components(frame([(1,), (2,)], "id bigint"), frame([], "a bigint, b bigint")).collect()
    assert {(r["id"], r["comp"]) for r in got} == {(1, 1), (2, 2)}


def test_nearest_node_far_away_and_missing_key(frame):
    points = frame([(1, 0, 0.0, 0.0), (2, 0, 900.0, 3.0), (3, 1, 5.0, 5.0), (4, 0, 10.0, 0.0)], "id int, k int, x double, y double")
    nodes = frame([(7, 0, 1.0, 0.0), (8, 0, 19.0, 0.0)], "node int, k int, nx double, ny double")
    got = spatial.nearest_node(points, nodes, id="id", xy=("x", "y"), node_id="node", node_xy=("nx", "ny"), keys=["k"], radius=0.5)
    assert {r["id"]: r["node"] for r in got.collect()} == {1: 7, 2: 8, 4: 7}
    none = spatial.nearest_node(points, nodes.limit(0), id="id", xy=("x", "y"), node_id="node", node_xy=("nx", "ny"), keys=["k"], radius=0.5)
    assert none.count() == 0


def test_sky_match_across_zero_and_at_the_pole(frame):
    a = frame([(1, 359.99995, 10.0), (2, 120.0, 89.9999), (3, 50.0, -89.9998)], "id int, ra double, dec double")
    b = frame([(11, 0.00005, 10.0), (12, 300.0, 89.9999), (13, 50.0, -89.9998)], "id int, ra double, dec double")
    got = spatial.xmatch_sky(a, b, radius_arcsec=1.0).collect()
    assert {(r["id_a"], r["id_b"]) for r in got} == {(1, 11), (2, 12), (3, 13)}


def test_sky_match_equals_brute_force(frame):
    rng = np.random.default_rng(5)
    ra, dec = rng.uniform(0, 360, 400), rng.uniform(-90, 90, 400)
    ra2, dec2 = (ra + rng.normal(0, 0.5, 400)) % 360, np.clip(dec + rng.normal(0, 0.3, 400), -90, 90)
    a = frame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(ra, dec))], "id int, ra double, dec double")
    b = frame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(ra2, dec2))], "id int, ra double, dec double")
    got = {(r["id_a"], r["id_b"]) for r in spatial.xmatch_sky(a, b, radius_arcsec=1800.0).collect()}
    r1, d1, r2, d2 = (np.radians(v) for v in (ra[:, None], dec[:, None], ra2[None, :], dec2[None, :]))
    h = np.sin((d2 - d1) / 2) ** 2 + np.cos(d1) * np.cos(d2) * np.sin((r2 - r1) / 2) ** 2
    want = set(map(tuple, np.argwhere(np.degrees(2 * np.arcsin(np.sqrt(h))) * 3600 <= 1800.0)))
    assert got == want


def test_empty_catalogue_keeps_all(frame):
    c = frame([(1, 2, 3)], "cand_id int, ix int, iy int")
    o = frame([], "ox double, oy double")
    assert spatial.not_near_catalogue(c, o).count() == 1


def test_dedupe_equals_greedy(frame):
    rng = random.Random(11)
    cand = [(i, round(rng.uniform(5, 9), 1), rng.randrange(30), rng.randrange(12), rng.randrange(12)) for i in range(300)]
    kept = []
    for c in sorted(cand, key=lambda c: (-c[1], c[0])):
        if not any(abs(c[4] - k[4]) <= 3 and abs(c[3] - k[3]) <= 3 and abs(c[2] - k[2]) <= 4 for k in kept):
            kept.append(c)
    got = dedupe_candidates(frame(cand, "cand_id int, snr double, iw int, iy int, ix int")).collect()
    assert {r["cand_id"] for r in got} == {c[0] for c in kept}


def test_groups_of_crowded_pixel(frame):
    rows = [(i, 5, 5) for i in range(500)] + [(1000, 6, 5), (1001, 20, 20)]
    df = frame(rows, "cand_id int, ix int, iy int")
    exact = {r["cand_id"]: r["group_id"] for r in group_candidates(df).collect()}
    assert {exact[i] for i in range(500)} == {0} and exact[1000] == 1000
    near = {r["cand_id"]: r["group_id"] for r in group_candidates(df, radius=1.0).collect()}
    assert near[1000] == 0 and near[1001] == 1001


def test_face_neighbours(frame):
    pts = frame([(1, 0, 0), (2, 1, 1), (3, 1, 0)], "id int, iy int, ix int")
    assert {tuple(sorted((r["a"], r["b"]))) for r in neighbour_edges(pts, ("iy", "ix"), faces_only=True).collect()} == {(1, 3), (2, 3)}
    assert neighbour_edges(pts, ("iy", "ix")).count() == 3


def test_bracketed_quantiles_of_views_and_working_names(spark):
    spark.range(1, 102).selectExpr("id % 2 AS _b", "CAST(id AS DOUBLE) AS v").createOrReplaceTempView("bracketed_rows")
    df = spark.sql("SELECT * FROM (SELECT * FROM bracketed_rows) AS s")
    got = {r["_b"]: (r.m, r.lo) for r in scale.quantiles(df, ["_b"], "v", {"m": 0.5, "lo": 0.25}, accuracy=50, direct_limit=0).collect()}
    assert got == {0: (51.0, 26.5), 1: (51.0, 26.0)}
