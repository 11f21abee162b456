"""Many cubes in one call equal each cube alone; every column of a fit moves with its rank."""

import pytest
from pyspark.sql import functions as F

from lumenframe.operators import classify, curves, detect
from lumenframe.sources import tables

CUBES = (0, 1, 2)


@pytest.fixture(scope="module")
def voxel(spark):
    n = spark.range(3 * 6 * 9 * 9).withColumn("cube_id", (F.col("id") % 3).cast("int"))
    at = F.floor(F.col("id") / 3)
    n = n.select(F.col("id").alias("voxel_id"), "cube_id", F.floor(at / 81).alias("iw"), (F.floor(at / 9) % 9).alias("iy"), (at % 9).alias("ix"))
    noise = (F.pmod(F.xxhash64("voxel_id"), F.lit(1000)) - 500) / 250.0 * (1 + F.col("cube_id"))
    out = n.withColumns({"data": noise, "ivar": 1.0 / (1 + F.col("cube_id"))}).withColumn("snr", F.col("data") * F.sqrt("ivar"))
    return out.persist()


def same(run, *inputs):
    """``run`` on all cubes with a key gives what it gives on each cube alone."""
    both = sorted(tuple(r[c] for c in sorted(r.asDict()) if c != "cube_id") + (r.cube_id,) for r in run(*inputs, keys=["cube_id"]).collect())
    alone = []
    for k in CUBES:
        for r in run(*[x.where(f"cube_id = {k}").drop("cube_id") for x in inputs], keys=()).collect():
            alone.append(tuple(r[c] for c in sorted(r.asDict())) + (k,))
    assert len(both) == len(alone) > 0
    for x, y in zip(both, sorted(alone), strict=True):
        assert x == pytest.approx(y, nan_ok=True) if all(isinstance(v, (int, float)) for v in x + y) else x == y


def cand(v):
    return v.where("snr > 1.2").withColumn("npix", 1 + F.col("voxel_id") % 7).withColumnRenamed("voxel_id", "cand_id").drop("data", "ivar")


def test_calibration(voxel):
    same(lambda v, keys: detect.noise_scale(v, keys=keys), voxel)
    same(lambda v, keys: detect.noise_scale(v, per_wave=True, smooth=3, keys=keys), voxel)
    neg = voxel.withColumn("snr", -F.col("snr"))
    same(lambda p, n, keys: detect.purity_scan(p, n, thresholds=[0.5, 1.5], keys=keys), voxel, neg)
    same(lambda p, n, keys: detect.choose_threshold(detect.purity_scan(p, n, thresholds=[0.5, 1.5], keys=keys), target=-9.0, keys=keys), voxel, neg)
    same(lambda n, keys: detect.loudest_event(n, keys=keys), neg)


def test_purity_of_a_cube_without_negatives(spark):
    pos = spark.createDataFrame([(0, 2.0), (1, 2.0)], "cube_id int, snr double")
    got = {(r.cube_id, r.n_pos, r.n_neg) for r in detect.purity_scan(pos, pos.where("cube_id = 0"), thresholds=[1.0], keys=["cube_id"]).collect()}
    assert got == {(0, 1, 1), (1, 1, 0)}


def test_candidates(voxel):
    same(lambda v, keys: detect.connected_voxels(v, threshold=1.2, keys=keys), voxel)
    same(lambda v, keys: detect.dedupe_candidates(cand(v), dxy=1, dw=1, keys=keys), voxel)
    same(lambda v, keys: detect.group_candidates(cand(v), radius=1.0, keys=keys).select(*keys, "cand_id", "group_id"), voxel)
    same(lambda v, keys: detect.footprint_size(v.where("iw = 0 AND snr > 0.3"), min_components=2, id="voxel_id", keys=keys), voxel)


def test_vetoes(voxel):
    covered = voxel.where("NOT (ix = 0 AND iy = cube_id)").select("cube_id", "ix", "iy").distinct()
    same(lambda v, keys: detect.coincidence_veto(cand(v), tolerance=1, mad_k=0.1, min_count=1, keys=keys), voxel)
    same(lambda v, c, keys: detect.candidate_vetoes(cand(v), v, c, nx=9, ny=9, min_fraction=-9.0, keys=keys), voxel, covered)


def test_all_columns_move_with_an_injected_rank(spark):
    rows = [(1, k, 0.1 * k, 0.0, 0, c, 10.0 + k, f"sub{k}", [float(k)]) for k, c in enumerate(("GALAXY", "GALAXY", "STAR"))]
    fits = spark.createDataFrame(rows, "target_id long, znum int, z double, zerr double, zwarn int, class string, chi2 double, subclass string, coeff array<double>")
    hints = spark.createDataFrame([(1, "STAR", "", "DISC")], "target_id long, targclass string, targprog string, targsrvy string")
    got = {r.znum: r for r in classify.inject_class(fits, hints, ntop=2).collect()}
    assert (got[1]["class"], got[1].subclass, got[1].coeff, got[1].injected) == ("STAR", "sub2", [2.0], True)
    assert (got[0].subclass, got[0].coeff) == ("sub0", [0.0])


def test_missing_arrays_get_the_shape_of_their_column(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0], [[1, 2], [3, 4]], None), (2, None, None, None)], "k long, v array<double>, m array<array<int>>, e array<int>")
    got = {r.k: r for r in tables.fill_product(df).collect()}
    assert len(got[2].v) == 3 and all(x != x for x in got[2].v)
    assert got[2].m == [[-999, -999], [-999, -999]] and got[2].e == [-999] and got[1].m == [[1, 2], [3, 4]]


def test_missing_fibres(spark):
    have = spark.createDataFrame([(n, 4000.0, float(n)) for n in (3, 6, 12)], "nspec long, wave double, value double")
    got = {r.nspec: r.copied_from for r in curves.fill_missing_fibres(have, max_nspec=10).collect()}
    assert got == {1: 3, 2: 3, 3: None, 4: 3, 5: 6, 6: None, 7: 6, 8: 6, 9: 6, 10: 12, 12: None}
    assert sorted(r.nspec for r in curves.fill_missing_fibres(have).collect()) == list(range(1, 13))
