"""Queries for sky, plane and provenance joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import spatial as spa
from lumenframe.operators import walk
from lumenframe.plans.registry import CUBE, query, shared

SEP = """3600 * degrees(2 * asin(sqrt(least(1, power(sin(radians(b.dec - a.dec) / 2), 2)
         + cos(radians(a.dec)) * cos(radians(b.dec)) * power(sin(radians(b.ra - a.ra) / 2), 2)))))"""

shared("pairs3_", f"SELECT * FROM (SELECT a.id AS id_a, b.id AS id_b, {SEP} AS sep FROM {{cat_a}} AS a, {{cat_b}} AS b WHERE abs(a.dec - b.dec) < 0.002) WHERE sep <= 3")


@query("xmatch_sky", fix="sep", sql="SELECT * FROM {pairs3_}")
def _(t):
    return spa.xmatch_sky(t.cat_a, t.cat_b, radius_arcsec=3.0)


@query("xmatch_nearest_fibre", fix="dist:9", sql="""
    SELECT id, node_id, sqrt(d2) AS dist FROM (SELECT a.id, b.id AS node_id, d2, row_number() OVER (PARTITION BY a.id ORDER BY d2, b.id) AS rn FROM (
      SELECT a.id, b.id AS bid, power((a.ra - b.ra) * cos(radians((SELECT avg(dec) FROM {cat_b}))), 2) + power(a.dec - b.dec, 2) AS d2 FROM {cat_a} AS a, {cat_b} AS b) AS p
      JOIN {cat_a} AS a ON a.id = p.id JOIN {cat_b} AS b ON b.id = bid) WHERE rn = 1""")
def _(t):
    import math

    dec0 = t.cat_b.agg(F.avg("dec")).first()[0]
    cos = math.cos(math.radians(dec0))
    a = t.cat_a.select("id", (F.col("ra") * cos).alias("px"), F.col("dec").alias("py"))
    b = t.cat_b.select(F.col("id").alias("node_id"), (F.col("ra") * cos).alias("nx"), F.col("dec").alias("ny"))
    return spa.nearest_node(a, b, id="id", xy=("px", "py"), node_id="node_id", node_xy=("nx", "ny"), radius=0.004)


@query(
    "not_near_catalogue",
    fix="snr",
    sql="""SELECT cube_id, iw, iy, ix, snr FROM {voxel} AS v WHERE snr > 1.2
           AND NOT EXISTS (SELECT 1 FROM {object} AS o WHERE o.cube_id = v.cube_id AND (ox - ix) * (ox - ix) + (oy - iy) * (oy - iy) <= 16)""",
)
def _(t):
    return spa.not_near_catalogue(t.voxel.where("snr > 1.2"), t.object, keys=CUBE).select("cube_id", "iw", "iy", "ix", "snr")


@query(
    "bright_source_mask",
    sql="""SELECT DISTINCT cube_id, ix, iy FROM {voxel} AS v WHERE NOT EXISTS (SELECT 1 FROM {object} AS o
           WHERE o.cube_id = v.cube_id AND power(ix - ox, 2) + power(iy - oy, 2) <= power(greatest(5, 3 * sqrt(a * b)), 2))""",
)
def _(t):
    px = t.voxel.select("cube_id", "ix", "iy").distinct()
    return spa.bright_source_mask(px, t.object, keys=CUBE)


shared("nodes_", "SELECT field, abs(bin_id) AS bin_id, avg(x) AS bin_x, avg(y) AS bin_y FROM {binmap} WHERE bin_id > 0 GROUP BY field, abs(bin_id)")


@query(
    "nearest_bin",
    sql="""SELECT field, target_id, bin_id, TRUE AS is_outside FROM (SELECT s.field, s.target_id, n.bin_id,
           row_number() OVER (PARTITION BY s.target_id ORDER BY power(x - bin_x, 2) + power(y - bin_y, 2), n.bin_id) AS rn
           FROM {binmap} AS s JOIN {nodes_} AS n ON n.field = s.field WHERE s.bin_id < 0) WHERE rn = 1""",
)
def _(t):
    nodes = t.binmap.where("bin_id > 0").groupBy("field", "bin_id").agg(F.avg("x").alias("bin_x"), F.avg("y").alias("bin_y"))
    spaxel = t.binmap.drop("bin_id").join(t.binmap.select("target_id", (F.col("bin_id") > 0).alias("inside")), "target_id")
    return spa.nearest_bin(spaxel, nodes, radius=1.0)


shared("spx_", "SELECT id AS spaxel_id, ra, dec FROM {cat_a}")
shared("fib_", "SELECT id AS fibre_id, id % 37 AS nspec, ra + (id % 3) * 0.0002 AS ra, dec FROM {cat_b}")
shared(
    "lens_",
    """SELECT spaxel_id, fibre_id, nspec, CASE WHEN d >= 0.0025 THEN 0 WHEN d <= 0.0005 THEN pi() * 0.001 * 0.001 ELSE
         0.0015 * 0.0015 * acos(greatest(-1, least(1, (d * d + 0.0015 * 0.0015 - 0.001 * 0.001) / (2 * d * 0.0015))))
         + 0.001 * 0.001 * acos(greatest(-1, least(1, (d * d + 0.001 * 0.001 - 0.0015 * 0.0015) / (2 * d * 0.001))))
         - 0.5 * sqrt(greatest(0, (-d + 0.0025) * (d + 0.0005) * (d - 0.0005) * (d + 0.0025))) END AS w
       FROM (SELECT spaxel_id, fibre_id, nspec, sqrt(power((s.ra - f.ra) * (SELECT cos(radians(avg(dec))) FROM {spx_}), 2) + power(s.dec - f.dec, 2)) AS d FROM {spx_} AS s, {fib_} AS f
       WHERE abs(s.dec - f.dec) <= 0.0025) WHERE d < 0.0025""",
)
shared("weights_", "SELECT spaxel_id, fibre_id, nspec, w / sum(w) OVER (PARTITION BY spaxel_id) AS weight FROM {lens_} WHERE w > 0")


def weights(t, per=None):
    spaxel = t.cat_a.select(F.col("id").alias("spaxel_id"), "ra", "dec")
    fibre = t.cat_b.select(F.col("id").alias("fibre_id"), (F.col("id") % 37).alias("nspec"), (F.col("ra") + (F.col("id") % 3) * 0.0002).alias("ra"), "dec")
    return spa.overlap_weights(spaxel, fibre, fibre_radius=0.0015, spaxel_radius=0.001, per=per)


@query("overlap_weights", fix="weight:5", sql="SELECT * FROM {weights_}")
def _(t):
    return weights(t)


@query(
    "provenance_leaves",
    sql="""WITH RECURSIVE w(root, node, path, depth) AS (
             SELECT child, child, CAST([] AS BIGINT[]), 0 FROM {prov} WHERE parent = 0
             UNION ALL SELECT root, e.child, list_append(path, e.ord), depth + 1 FROM w JOIN {prov} AS e ON e.parent = w.node),
           l AS (SELECT * FROM w WHERE node NOT IN (SELECT parent FROM {prov})),
           p AS (SELECT root, node, depth, row_number() OVER (PARTITION BY root ORDER BY path) AS position FROM l)
           SELECT * FROM p""",
)
def _(t):
    return walk.provenance_leaves(t.prov, t.prov.where("parent = 0").select(F.col("child").alias("root")))


PHASES = [(i / 20.0, ((i * 7) % 20) / 20.0) for i in range(20)]


@query(
    "target_times_ephemeris",
    fix="sep phase v_sys",
    sql="""WITH p AS (SELECT id_a, id_b, sep, (2459000 + id_a * 0.37 - epoch) / period AS cyc, id_a % 300 - 150 AS rv, amp FROM {pairs3_} JOIN {ephemeris} ON id = id_b WHERE sep <= 1),
           q AS (SELECT *, cyc - trunc(cyc) AS phase FROM p),
           r AS (SELECT q.*, i, row_number() OVER (PARTITION BY id_a, id_b ORDER BY abs(i / 20e0 - phase), i) AS rn FROM q, (SELECT unnest(range(20)) AS i))
           SELECT id_a, id_b, sep, phase, rv - (amp * 25.6 + 35) * ((i * 7) % 20) / 20e0 AS v_sys FROM r WHERE rn = 1""",
)
def _(t):
    targets = t.cat_a.withColumns({"jd": 2459000 + F.col("id") * F.lit(0.37), "rv": (F.col("id") % 300 - 150).cast("double")})
    return spa.target_times_ephemeris(targets, t.ephemeris, PHASES).select("id_a", "id_b", "sep", "phase", "v_sys")


@query(
    "central_item",
    fix="dist_arcsec",
    sql="""WITH m AS (SELECT id % 7 AS field, avg(ra) AS r, avg(dec) AS d FROM {cat_a} GROUP BY id % 7),
           x AS (SELECT field, id, power((ra - r) * cos(radians(d)), 2) + power(dec - d, 2) AS d2 FROM {cat_a} JOIN m ON field = id % 7)
           SELECT field, id, sqrt(d2) * 3600 AS dist_arcsec FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY d2, id) AS rn FROM x) WHERE rn = 1""",
)
def _(t):
    return spa.central_item(t.cat_a.withColumn("field", F.col("id") % 7), keys=["field"])


@query(
    "neighbour_spacing",
    fix="spacing:9",
    sql="""WITH c AS (SELECT cos(radians(avg(dec))) AS c FROM {cat_a}), p AS (SELECT id, ra * c AS x, dec AS y FROM {cat_a}, c),
           d AS (SELECT a.id, sqrt(min(power(a.x - b.x, 2) + power(a.y - b.y, 2))) AS dist FROM p AS a, p AS b WHERE a.x <> b.x OR a.y <> b.y GROUP BY a.id)
           SELECT median(dist) / 2 AS spacing, (SELECT count(*) FROM (SELECT DISTINCT x, y FROM p)) AS n FROM d""",
)
def _(t):
    return spa.neighbour_spacing(t.cat_a)


@query(
    "connected_components",
    sql="""WITH RECURSIVE v AS (SELECT cube_id * 1000000 + iw * 100000 + iy * 1000 + ix AS id, cube_id, iw, iy, ix FROM {voxel} WHERE snr > 1.5),
           e AS (SELECT a.id AS a, b.id AS b FROM v AS a JOIN v AS b ON a.cube_id = b.cube_id AND abs(a.iw - b.iw) <= 1 AND abs(a.iy - b.iy) <= 1 AND abs(a.ix - b.ix) <= 1),
           r(id, other) AS (SELECT a, b FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other)
           SELECT id, min(other) AS comp FROM r GROUP BY id""",
)
def _(t):
    from lumenframe.operators.detect import neighbour_edges

    v = t.voxel.where("snr > 1.5").withColumn("id", F.col("cube_id") * 1000000 + F.col("iw") * 100000 + F.col("iy") * 1000 + F.col("ix"))
    return walk.components(v, neighbour_edges(v, ("iw", "iy", "ix"), keys=CUBE))
