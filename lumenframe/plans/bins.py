"""Queries on spaxels and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import bins as bn
from lumenframe.plans.registry import CUBE, query, shared


@query(
    "bin_spectra_sum",
    fix="flux var",
    sql="SELECT arm, spec_id % 40 AS bin_id, pix, sum(flux) AS flux, sum(1 / ivar) AS var FROM {pixel} WHERE ivar > 0 GROUP BY arm, spec_id % 40, pix",
)
def _(t):
    px = t.pixel.where("ivar > 0").withColumn("var", 1 / F.col("ivar"))
    return bn.bin_spectra_sum(px, t.spec_class.select("spec_id", (F.col("spec_id") % 40).alias("bin_id")), keys=["arm"])


shared(
    "assigned_",
    """WITH v AS (SELECT * FROM {spaxel} WHERE snr >= 0.9 * 4 AND signal > 0 AND noise > 0),
       e AS (SELECT field, min(x) - 0.012 AS x0, max(x) + 0.012 AS x1, min(y) - 0.012 AS y0, max(y) + 0.012 AS y1 FROM v GROUP BY field),
       n AS (SELECT *, ceil((x1 - x0) / 1.2) AS nx, ceil((y1 - y0) / 1.2) AS ny FROM e)
       SELECT v.*, CAST(least(floor((y - y0) / 1.2), ny - 1) * nx + least(floor((x - x0) / 1.2), nx - 1) AS BIGINT) AS bin_id FROM v JOIN n USING (field)""",
)


@query(
    "grid_bin",
    fix="x y signal noise snr",
    sql="""SELECT field, bin_id, avg(x) AS x, avg(y) AS y, sum(signal) AS signal, sqrt(sum(noise * noise)) AS noise, count(*) AS n_members, max(target_id) AS last_member,
           arg_max(ix, target_id) AS ix, sum(signal) / sqrt(sum(noise * noise)) AS snr FROM {assigned_} GROUP BY field, bin_id""",
)
def _(t):
    return bn.grid_bin(bn.grid_assign(t.spaxel, size=1.2, min_snr=4.0), last=["ix"])


@query(
    "bin_provenance",
    sql="""SELECT s.target_id, CASE WHEN s.signal < 15 THEN -1 ELSE COALESCE(bin_id, -999) END AS bin_id FROM {spaxel} AS s LEFT JOIN {assigned_} AS a USING (target_id)""",
)
def _(t):
    return bn.bin_provenance(t.spaxel, t.spaxel.where("signal >= 15"), bn.grid_assign(t.spaxel, size=1.2, min_snr=4.0))


@query(
    "bin_sn_covariance",
    fix="sn",
    sql="SELECT bin_raw, sum(signal) / sqrt(sum(noise * noise)) / (1 + 0.3 * log10(count(*))) AS sn, count(*) AS n FROM {binmap} GROUP BY bin_raw",
)
def _(t):
    return bn.bin_sn_covariance(t.binmap, covariance=0.3, keys=["bin_raw"])


@query("spaxels_per_bin", sql="SELECT bin_id, count(*) AS n_spaxels FROM {binmap} GROUP BY bin_id")
def _(t):
    return bn.spaxels_per_bin(t.binmap)


@query(
    "cube_block_bin",
    fix="data ivar",
    sql="""WITH g AS (SELECT cube_id, iw, iy // 3 AS bin_y, ix // 3 AS bin_x, sum(data) AS f, sum(1 / ivar) AS v, count(*) AS n FROM {voxel} WHERE iy < 24 AND ix < 39 GROUP BY cube_id, iw, iy // 3, ix // 3)
           SELECT cube_id, iw, bin_y, bin_x, CASE WHEN n >= 5.9 THEN f ELSE 0 END AS data, CASE WHEN n >= 5.9 THEN 1 / v ELSE 0 END AS ivar, n AS n_valid FROM g""",
)
def _(t):
    return bn.cube_block_bin(t.voxel, block=3, nx=40, ny=25, min_valid=5.9 / 9, keys=CUBE)


@query(
    "lambda_r",
    fix="lambda_r",
    sql="""WITH r AS (SELECT bin_id, v - (SELECT median(v) FROM {bin_result}) AS v, sigma FROM {bin_result})
           SELECT bin_id, sum(signal * sqrt(x * x + y * y) * abs(v)) / nullif(sum(signal * sqrt(x * x + y * y) * sqrt(v * v + sigma * sigma)), 0) AS lambda_r
           FROM {binmap} JOIN r USING (bin_id) GROUP BY bin_id""",
)
def _(t):
    return bn.lambda_r(t.binmap, t.bin_result)


def flux_filter_sql(mode_zones: str) -> str:
    return f"""WITH s AS (SELECT *, abs(snr - 9) AS off FROM {{spaxel}}),
       th AS (SELECT field, count(*) AS n, greatest(floor(count(*) * 0.3), 1) AS mk, median(signal) FILTER (off <= 2) AS t0, count(*) FILTER (off <= 2) AS n0,
              median(signal) FILTER (off <= 3) AS t1, count(*) FILTER (off <= 3) AS n1, median(signal) FILTER (off <= 5) AS t2, count(*) FILTER (off <= 5) AS n2,
              quantile_cont(signal, 0.75) FILTER (signal > 0) AS tp FROM s GROUP BY field),
       k AS (SELECT field, sum(CASE WHEN signal >= t0 THEN 1 ELSE 0 END) AS k0, sum(CASE WHEN signal >= t1 THEN 1 ELSE 0 END) AS k1,
             sum(CASE WHEN signal >= t2 THEN 1 ELSE 0 END) AS k2, sum(CASE WHEN signal >= tp THEN 1 ELSE 0 END) AS kp FROM s JOIN th USING (field) GROUP BY field),
       c AS (SELECT field, mk, {mode_zones} FROM th JOIN k USING (field)),
       r AS (SELECT s.target_id, s.field, s.signal, c.*, row_number() OVER (PARTITION BY s.field ORDER BY s.signal DESC, s.target_id) AS rn FROM s JOIN c ON c.field = s.field)
       SELECT target_id, method FROM r WHERE CASE WHEN kept >= mk THEN signal >= t ELSE rn <= mk END"""


SAFE = """CASE WHEN n0 >= 90 AND k0 >= mk THEN 'zone_2' WHEN n1 >= 90 AND k1 >= mk THEN 'zone_3' WHEN n2 >= 90 AND k2 >= mk THEN 'zone_5' ELSE 'percentile' END AS method,
  CASE WHEN n0 >= 90 AND k0 >= mk THEN t0 WHEN n1 >= 90 AND k1 >= mk THEN t1 WHEN n2 >= 90 AND k2 >= mk THEN t2 ELSE tp END AS t,
  CASE WHEN n0 >= 90 AND k0 >= mk THEN k0 WHEN n1 >= 90 AND k1 >= mk THEN k1 WHEN n2 >= 90 AND k2 >= mk THEN k2 ELSE kp END AS kept"""


@query("adaptive_flux_filter", sql=flux_filter_sql(SAFE))
def _(t):
    return bn.adaptive_flux_filter(t.spaxel, snr=9.0, percentile=75.0, min_zone=90, min_keep=0.3).select("target_id", "method")


@query("adaptive_flux_percentile", sql=flux_filter_sql("'percentile' AS method, tp AS t, kp AS kept"))
def _(t):
    return bn.adaptive_flux_filter(t.spaxel, mode="percentile", percentile=75.0, min_keep=0.3).select("target_id", "method")


PCTS = """quantile_cont(snr, 0.02) AS p2, quantile_cont(snr, 0.25) AS p25, median(snr) AS p50, quantile_cont(snr, 0.98) AS p98"""


@query(
    "adaptive_min_snr",
    fix="min_snr p2 p50 p98",
    sql=f"SELECT field, least(greatest(p2, 0.1), 2.2) AS min_snr, p2, p50, p98 FROM (SELECT field, {PCTS} FROM {{spaxel}} WHERE snr > 0 GROUP BY field)",
)
def _(t):
    return bn.adaptive_min_snr(t.spaxel, ceiling=2.2)


@query(
    "adaptive_min_snr_gap",
    fix="min_snr p2 p50 p98",
    sql=f"""WITH q AS (SELECT field, {PCTS} FROM {{spaxel}} WHERE snr > 0 GROUP BY field),
            l AS (SELECT DISTINCT s.field, snr FROM {{spaxel}} AS s JOIN q ON q.field = s.field WHERE snr > 0 AND snr < p25),
            g AS (SELECT field, snr, lead(snr) OVER (PARTITION BY field ORDER BY snr) AS nxt FROM l),
            w AS (SELECT field, nxt FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY nxt - snr DESC, snr) AS rn FROM g WHERE nxt IS NOT NULL) WHERE rn = 1)
            SELECT q.field, least(greatest(nxt, 0.1), 30) AS min_snr, p2, p50, p98 FROM q LEFT JOIN w ON w.field = q.field""",
)
def _(t):
    return bn.adaptive_min_snr(t.spaxel, method="snr_gap", ceiling=30.0)


def _clip_step(a: str, b: str) -> str:
    return f"""{b} AS (SELECT {a}.field, snr FROM {a} JOIN (SELECT field, median(snr) AS m, stddev_pop(snr) AS s FROM {a} GROUP BY field) AS q ON q.field = {a}.field
               WHERE abs(snr - m) <= 3 * s)"""


@query(
    "adaptive_min_snr_clip",
    fix="min_snr p2 p50 p98",
    sql=f"""WITH c0 AS (SELECT field, power(snr, 3) AS snr FROM {{spaxel}} WHERE snr > 0), {_clip_step('c0', 'c1')}, {_clip_step('c1', 'c2')}, {_clip_step('c2', 'c3')},
            {_clip_step('c3', 'c4')}, {_clip_step('c4', 'c5')}
            SELECT field, least(greatest(any_value(r), 0.1), 1e6) AS min_snr, {PCTS.replace('quantile_cont(snr, 0.25) AS p25,', '')} FROM c0
            JOIN (SELECT field, median(snr) - 2 * stddev_pop(snr) AS r FROM c5 GROUP BY field) USING (field) GROUP BY field""",
)
def _(t):
    return bn.adaptive_min_snr(t.spaxel.withColumn("snr", F.pow("snr", 3)), method="sigma_clip", ceiling=1e6)


@query(
    "raster_map",
    fix="value",
    sql="""WITH m AS (SELECT min(x) AS x0, min(y) AS y0 FROM {spaxel})
           SELECT CAST(round_even((x - x0 + 6) / 1.3, 0) AS BIGINT) AS i, CAST(round_even((y - y0 + 6) / 1.3, 0) AS BIGINT) AS j, arg_max(signal, target_id) AS value
           FROM {spaxel}, m GROUP BY 1, 2""",
)
def _(t):
    return bn.raster_map(t.spaxel.withColumn("value", F.col("signal")), pixel=1.3)


@query(
    "colour_buckets",
    sql="""WITH q AS (SELECT quantile_cont(signal, 0.01) AS lo, quantile_cont(signal, 0.99) AS hi FROM {spaxel})
           SELECT target_id, CAST(least(floor(asinh(least(greatest((signal - lo) / (hi - lo), 0), 1) / 0.1) / asinh(10.0) * 16), 15) AS INT) AS bucket FROM {spaxel}, q""",
)
def _(t):
    return bn.colour_buckets(t.spaxel, value="signal", scale="asinh").select("target_id", "bucket")


@query(
    "bin_centres",
    fix="x y",
    sql="""SELECT field, abs(bin_id) AS bin_id, avg(x) FILTER (bin_id >= 0) AS x, avg(y) FILTER (bin_id >= 0) AS y, count(*) FILTER (bin_id >= 0) AS n_inside,
           count(*) FILTER (bin_id < 0) AS n_outside FROM {binmap} GROUP BY field, abs(bin_id)""",
)
def _(t):
    return bn.bin_centres(t.binmap)


@query(
    "bin_detail",
    fix="value",
    sql="""SELECT 'v' AS parameter, v AS value FROM {bin_result} WHERE bin_id = 27 UNION ALL SELECT 'sigma', sigma FROM {bin_result} WHERE bin_id = 27
           UNION ALL SELECT 'h3', h3 FROM {bin_result} WHERE bin_id = 27 UNION ALL SELECT 'spaxel', target_id FROM {binmap} WHERE abs(bin_id) = 27""",
)
def _(t):
    spaxels, params = bn.bin_detail(t.binmap, t.bin_result, bin_id=27)
    return params.select("parameter", "value").unionByName(spaxels.select(F.lit("spaxel").alias("parameter"), F.col("target_id").cast("double").alias("value")))


@query(
    "wave_slices",
    fix="flux centre",
    sql="""WITH p AS (SELECT spec_id, arm, CASE WHEN arm = 'RED' THEN 28 ELSE 0 END AS o, pix - CASE WHEN arm = 'RED' THEN 28 ELSE 0 END AS pix, flux FROM {pixel}),
           e AS (SELECT i AS slice, round_even(i * 36 / 7e0, 0) AS a, round_even((i + 1) * 36 / 7e0, 0) AS b FROM (SELECT unnest(range(7)) AS i))
           SELECT spec_id, arm, CAST(slice AS INT) AS slice, sum(COALESCE(flux, 0)) AS flux, any_value((4000 + (o + a) * 10 + 4000 + (o + b) * 10) / 2) AS centre
           FROM p JOIN e ON pix >= a AND pix < b GROUP BY spec_id, arm, slice""",
)
def _(t):
    # Each arm has a grid of its own.
    blue, red = (bn.wave_slices(t.pixel.where(F.col("arm") == a), item="spec_id", width=50.0).withColumn("arm", F.lit(a)) for a in ("BLUE", "RED"))
    return blue.unionByName(red)


@query(
    "ebv_spread",
    fix="median smallest largest",
    sql="SELECT c_nationkey AS batch, median(c_acctbal / 1e5) AS median, min(c_acctbal / 1e5) AS smallest, max(c_acctbal / 1e5) AS largest FROM {customer} GROUP BY c_nationkey",
)
def _(t):
    return bn.ebv_spread(t.customer.select(F.col("c_nationkey").alias("batch"), (F.col("c_acctbal") / 1e5).alias("ebv")), keys=["batch"])
