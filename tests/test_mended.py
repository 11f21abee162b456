"""Faults that were found and mended."""

import pytest
from pyspark.sql import functions as F

from lumenframe.operators import detect, merge, spatial, spectra, walk
from lumenframe.sources import tables


def test_second_night_keeps_the_first(spark, tmp_path):
    for night, obs, v in (("n1", 1, 1.0), ("n2", 1, 2.0), ("n2", 2, 3.0), ("n2", 2, 4.0)):
        tables.write_product({"spec": spark.createDataFrame([(obs, v)], "obs_id long, v double")}, str(tmp_path), night)
    got = {(r.night, r.obs_id, r.v) for r in spark.read.parquet(f"{tmp_path}/spec").collect()}
    assert got == {("n1", 1, 1.0), ("n2", 1, 2.0), ("n2", 2, 4.0)}


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_nodes_without_place(spark, keys):
    points = spark.createDataFrame([(1, 0, 0.0, 0.0), (2, 0, 9.0, 0.0), (3, 1, 0.0, 0.0)], "id long, k int, x double, y double")
    nodes = spark.createDataFrame([(7, 0, None, 1.0), (8, 0, 1.0, float("nan")), (9, 0, 5.0, 0.0), (10, 1, None, None)], "node long, k int, nx double, ny double")
    out = spatial.nearest_node(points, nodes, id="id", xy=("x", "y"), node_id="node", node_xy=("nx", "ny"), keys=keys, radius=1.0)
    assert {(r.id, r.node) for r in out.collect()} == {(1, 9), (2, 9)} | ({(3, 9)} if not keys else set())
    none = spatial.nearest_node(points, nodes.limit(1), id="id", xy=("x", "y"), node_id="node", node_xy=("nx", "ny"), radius=1.0)
    assert none.collect() == []


def test_coverage_is_judged_per_key(spark):
    rows = [(k, w, 0, 0, 1.0, ivar) for k, ivar in ((0, 1.0), (1, 1000.0)) for w in range(5)]
    voxel = spark.createDataFrame(rows, "cube_id int, iw long, iy long, ix long, data double, ivar double")
    how = {"spectral_sigma": 1.0, "spatial_sigma": 1.0, "bounds": {"iw": (0, 4), "iy": (0, 0), "ix": (0, 0)}}
    both = {(r.cube_id, r.iw): r.snr for r in detect.matched_filter(voxel, keys=["cube_id"], **how).collect()}
    for k in (0, 1):
        alone = detect.matched_filter(voxel.where(f"cube_id = {k}"), **how).collect()
        assert {r.iw: pytest.approx(r.snr) for r in alone} == {w: v for (c, w), v in both.items() if c == k}
        assert all(r.snr > 0 for r in alone)


def test_provenance_of_any_depth(spark):
    chain = [(i, i + 1, 0) for i in range(1, 12)] + [(3, 100, -1), (2, 12, 9), (12, 13, 0), (13, 12, 1), (12, 200, 5)]
    edges = spark.createDataFrame(chain, "parent long, child long, ord long")
    roots = spark.createDataFrame([(1,), (11,)], "root long")
    got = {(r.root, r.node, r.position) for r in walk.provenance_leaves(edges, roots).collect()}
    assert got == {(1, 100, 1), (1, 200, 2), (11, 200, 1)}


def test_product_is_old_or_new(spark, tmp_path):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "obs_id long, v double")
    new = spark.createDataFrame([(2, 5.0), (3, 6.0)], "obs_id long, v double")
    broken = new.withColumn("v", F.when(F.col("obs_id") == 3, F.raise_error(F.lit("lost"))).cast("double"))
    read = lambda name: {(r.obs_id, r.v) for r in spark.read.parquet(f"{tmp_path}/{name}").collect()}
    tables.write_product({"a": old, "b": old}, str(tmp_path), "n1")
    with pytest.raises(Exception, match="lost"):
        tables.write_product({"a": new, "b": broken}, str(tmp_path), "n1")
    assert read("a") == read("b") == {(1, 1.0), (2, 2.0)}
    tables.write_product({"a": new}, str(tmp_path), "n1")  # and what the lost one left is gone
    assert read("a") == {(1, 1.0), (2, 5.0), (3, 6.0)} and read("b") == {(1, 1.0), (2, 2.0)}
    assert not list((tmp_path / "_switch").iterdir())


def test_a_switch_that_was_cut_short_goes_on(spark, tmp_path, monkeypatch):
    old = spark.createDataFrame([(1, 1.0)], "obs_id long, v double")
    tables.write_product({"a": old, "b": old}, str(tmp_path), "n1")
    move, calls = tables._move, []

    def once(*args):
        calls.append(args)
        if len(calls) > 3:
            raise RuntimeError("driver lost")
        return move(*args)

    monkeypatch.setattr(tables, "_move", once)
    new = old.withColumn("v", F.lit(7.0))
    with pytest.raises(RuntimeError):
        tables.write_product({"a": new, "b": new}, str(tmp_path), "n1")
    monkeypatch.setattr(tables, "_move", move)
    tables.finish_product(spark, str(tmp_path))
    assert [r.v for n in "ab" for r in spark.read.parquet(f"{tmp_path}/{n}").collect()] == [7.0, 7.0]


def test_missing_keys_in_turn(spark):
    a = spark.createDataFrame([(1, "x"), (None, "p"), (None, "q"), (None, "r")], "id long, a string")
    b = spark.createDataFrame([(1, 5), (None, 8), (None, 7), (2, 6)], "id long, b int")
    meet, _ = merge.outer_merge([a, b], ["id"])
    pair, _ = merge.outer_merge([a, b], ["id"], missing="pair")
    assert meet.count() == 2 + 6 and pair.columns == ["id", "a", "b"]
    assert {tuple(r) for r in pair.collect()} == {(1, "x", 5), (2, None, 6), (-999, "p", 7), (-999, "q", 8), (-999, "r", None)}


def test_columns_that_clash_are_told(spark):
    a = spark.createDataFrame([(1, 2, 3)], "id long, x int, x_1 int")
    with pytest.raises(ValueError, match="x_1"):
        merge.outer_merge([a, a.select("id", "x")], ["id"])


def test_arms_without_overlap_stay(spark):
    rows = [(1, arm, i, w + 10.0 * i, 1.0 + i, 1.0) for arm, w in (("B", 100.0), ("R", 300.0)) for i in range(4)]
    rows += [(2, "B", i, 100.0 + 10 * i, 2.0, 1.0) for i in range(4)] + [(2, "R", i, 110.0 + 10 * i, 2.0, 1.0) for i in range(6)]
    px = spark.createDataFrame(rows, "spec_id long, arm string, pix int, wave double, flux double, ivar double")
    got = spectra.join_arms(px, order=["B", "R"], split=True).orderBy("spec_id", "arm", "pix").collect()
    assert [(r.arm, r.wave, r.flux) for r in got if r.spec_id == 1] == [(a, w, f) for _, a, _, w, f, _ in rows[:8]]
    both = [r for r in got if r.spec_id == 2]
    assert {r.arm for r in both} == {"B", "R"} and max(r.wave for r in both if r.arm == "B") < min(r.wave for r in both if r.arm == "R")
    assert all(r.flux == pytest.approx(2.0) for r in both)
