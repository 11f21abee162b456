"""Queries on resolution curves and arc points."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import curves as cv
from lumenframe.plans.registry import query, shared
from lumenframe.plans.spatial import weights

shared("global_", "SELECT wave, median(value) AS value FROM {curve} GROUP BY wave")


@query("median_curve", fix="value", sql="SELECT * FROM {global_}")
def _(t):
    return cv.median_curve(t.curve)


@query(
    "median_curve_per_arm",
    fix="value",
    sql="""WITH c AS (SELECT CASE WHEN wave < 4300 THEN 'BLUE' ELSE 'RED' END AS arm, wave, value FROM {curve_gaps}),
           m AS (SELECT arm, wave, median(value) AS value FROM c GROUP BY arm, wave)
           SELECT * FROM m WHERE arm IN (SELECT arm FROM m GROUP BY arm HAVING count(*) >= 12)""",
)
def _(t):
    c = t.curve_gaps.withColumn("arm", F.when(F.col("wave") < 4300, "BLUE").otherwise("RED"))
    return cv.median_curve(c, keys=["arm"], min_points=12)


shared("w1_", "SELECT spaxel_id, nspec, sum(weight) AS weight FROM {weights_} GROUP BY spaxel_id, nspec")
shared("known_", "SELECT DISTINCT nspec FROM {curve_gaps}")
shared("stand_in_", "SELECT wave, median(value) AS value FROM {curve_gaps} GROUP BY wave")
shared(
    "wcurve_",
    """SELECT spaxel_id, wave, sum(weight * value) AS value, count(*) AS n_fibres FROM (
         SELECT spaxel_id, weight, wave, value FROM {w1_} AS w JOIN {curve_gaps} AS c ON c.nspec = w.nspec
         UNION ALL SELECT spaxel_id, weight, wave, value FROM {w1_} AS w, {stand_in_} AS g WHERE w.nspec NOT IN (SELECT nspec FROM {known_})) GROUP BY spaxel_id, wave""",
)


def spaxel_curves(t):
    return cv.weighted_curves(weights(t, per="nspec"), t.curve_gaps, cv.median_curve(t.curve_gaps))


@query("weighted_curves", fix="value:4", sql="SELECT * FROM {wcurve_}")
def _(t):
    return spaxel_curves(t)


@query(
    "bin_curves",
    fix="value:4",
    sql="""WITH s AS (SELECT c_custkey AS spaxel_id, c_custkey % 40 AS bin_id, c_acctbal AS signal FROM {customer} WHERE c_acctbal > 0)
           SELECT bin_id, wave, sum(signal * value) / sum(signal) AS value, count(*) AS n_spaxels FROM s JOIN {wcurve_} USING (spaxel_id) GROUP BY bin_id, wave""",
)
def _(t):
    spaxel = t.customer.select(F.col("c_custkey").alias("spaxel_id"), (F.col("c_custkey") % 40).alias("bin_id"), F.col("c_acctbal").alias("signal"))
    return cv.bin_curves(spaxel, spaxel_curves(t))


FEATURES = """p AS (SELECT nspec, wave, value, lead(value) OVER (PARTITION BY nspec ORDER BY wave) AS nxt FROM {curve}),
  w AS (SELECT nspec, sum(CASE WHEN wave = 4000 THEN value END) AS f0, sum(CASE WHEN wave = 4150 THEN value + (nxt - value) * 0.25 END) AS f1, sum(CASE WHEN wave = 4300 THEN value + (nxt - value) * 0.5 END) AS f2,
        sum(CASE WHEN wave = 4450 THEN value + (nxt - value) * 0.75 END) AS f3, sum(CASE WHEN wave = 4630 THEN value END) AS f4 FROM p GROUP BY nspec),
  x AS (SELECT nspec, [f0 / (SELECT stddev_pop(f0) FROM w), f1 / (SELECT stddev_pop(f1) FROM w), f2 / (SELECT stddev_pop(f2) FROM w), f3 / (SELECT stddev_pop(f3) FROM w), f4 / (SELECT stddev_pop(f4) FROM w)] AS f FROM w)"""
START = ", ".join("[" + ", ".join(f"quantile_cont(f[{j + 1}], {(i + 0.5) / 6})" for j in range(5)) + "]" for i in range(6))
NEAREST = "[list_sum([(f[j] - q[j]) * (f[j] - q[j]) FOR j IN range(1, 6)]) FOR q IN c]"


@query(
    "curve_buckets",
    sql=f"""WITH RECURSIVE {FEATURES},
            r(i, c) AS (SELECT 0, [{START}] FROM x
              UNION ALL SELECT any_value(i) + 1, list(coalesce(m, any_c[g + 1]) ORDER BY g) FROM (
                SELECT any_value(i) AS i, g, any_value(any_c) AS any_c, CASE WHEN count(b) > 0 THEN [avg(f[1]), avg(f[2]), avg(f[3]), avg(f[4]), avg(f[5])] END AS m FROM (
                  SELECT r.i, r.c AS any_c, unnest(range(6)) AS g FROM r WHERE i < 30) AS k
                LEFT JOIN (SELECT f, list_position(d, list_min(d)) - 1 AS b FROM (SELECT f, {NEAREST} AS d FROM x, r)) AS y ON y.b = k.g GROUP BY g) HAVING count(*) > 0)
            SELECT nspec, CAST(list_position(d, list_min(d)) - 1 AS INT) AS bucket FROM (SELECT nspec, {NEAREST} AS d FROM x, (SELECT c FROM r WHERE i = 30))""",
)
def _(t):
    member, _ = cv.curve_buckets(t.curve, id="nspec", max_buckets=6)
    return member


@query(
    "curve_buckets_quantile",
    fix="value",
    sql="""WITH p AS (SELECT nspec, wave, value, lead(value) OVER (PARTITION BY nspec ORDER BY wave) AS nxt FROM {curve}),
           f AS (SELECT nspec, sum(CASE WHEN wave IN (4000, 4630) THEN value WHEN wave = 4150 THEN value + (nxt - value) * 0.25 WHEN wave = 4300 THEN value + (nxt - value) * 0.5 WHEN wave = 4450 THEN value + (nxt - value) * 0.75 ELSE 0 END) / 5 AS m FROM p GROUP BY nspec),
           q AS (SELECT quantile_cont(m, 0.25) AS q1, quantile_cont(m, 0.5) AS q2, quantile_cont(m, 0.75) AS q3 FROM f),
           b AS (SELECT nspec, CAST(CASE WHEN m > q1 THEN 1 ELSE 0 END + CASE WHEN m > q2 THEN 1 ELSE 0 END + CASE WHEN m > q3 THEN 1 ELSE 0 END AS INT) AS bucket FROM f, q)
           SELECT bucket, wave, avg(value) AS value FROM {curve} JOIN b USING (nspec) GROUP BY bucket, wave""",
)
def _(t):
    _, shape = cv.curve_buckets(t.curve, id="nspec", max_buckets=4, fallback=True)
    return shape


@query(
    "arc_outliers",
    fix="fwhm",
    sql="""WITH e AS (SELECT min(wave) AS a, max(wave) AS b, greatest(1, CAST(floor((max(wave) - min(wave)) / 50) AS INT)) AS n FROM {arc}),
           r AS (SELECT arc.*, least(floor((wave - a) / ((b - a) / n)), n - 1) AS bin FROM {arc}, e),
           s AS (SELECT bin, median(fwhm) AS m, stddev_pop(fwhm) AS s, count(*) AS n FROM r GROUP BY bin),
           k AS (SELECT r.*, NOT (s.n >= 5 AND s > 0 AND abs(fwhm - m) > 3 * s) AS ok FROM r JOIN s ON s.bin = r.bin)
           SELECT point_id, nspec, fwhm FROM (SELECT *, bool_or(ok) OVER (PARTITION BY nspec) AS any_ok FROM k) WHERE ok OR NOT any_ok""",
)
def _(t):
    return cv.arc_outliers(t.arc).select("point_id", "nspec", "fwhm")


@query(
    "fibre_clean",
    fix="wave fwhm",
    sql="""WITH r AS (SELECT nspec, floor(wave) AS wave, fwhm FROM {arc} WHERE live = 1 AND fit_flag = 0),
           d AS (SELECT *, abs(fwhm - median(fwhm) OVER (PARTITION BY nspec)) AS d FROM r),
           m AS (SELECT *, median(d) OVER (PARTITION BY nspec) AS mad FROM d),
           k AS (SELECT * FROM m WHERE mad = 0 OR d <= 5 * 1.4826 * mad)
           SELECT nspec, CAST(wave AS DOUBLE) AS wave, median(fwhm) AS fwhm FROM k WHERE nspec IN (SELECT nspec FROM k GROUP BY nspec HAVING count(DISTINCT wave) >= 5) GROUP BY nspec, wave""",
)
def _(t):
    return cv.fibre_clean(t.arc.withColumn("wave", F.floor("wave").cast("double")))


@query(
    "dominant_population",
    fix="fwhm wave",
    sql="""WITH RECURSIVE d AS (SELECT * REPLACE (fwhm + CASE WHEN point_id % 4 = 0 THEN 5 ELSE 0 END AS fwhm) FROM {arc}),
           e(i, m1, m2, v1, v2, s1, s2, l, was) AS (
             SELECT 0, quantile_cont(fwhm, 0.25), quantile_cont(fwhm, 0.75), var_pop(fwhm), var_pop(fwhm), 0.5e0, 0.5e0, NULL::DOUBLE, NULL::DOUBLE FROM d
             UNION ALL SELECT i + 1, rx / r, (x - rx) / (n - r), greatest(rxx / r - power(rx / r, 2), 0) + 1e-6, greatest((xx - rxx) / (n - r) - power((x - rx) / (n - r), 2), 0) + 1e-6,
               r / n, (n - r) / n, lw / n, l FROM (
               SELECT i, any_value(l) AS l, count(*) AS n, sum(w) AS lw, sum(p) AS r, sum(fwhm) AS x, sum(p * fwhm) AS rx, sum(fwhm * fwhm) AS xx, sum(p * fwhm * fwhm) AS rxx FROM (
                 SELECT i, l, fwhm, w, exp(a - w) AS p FROM (SELECT *, greatest(a, b) + ln(exp(a - greatest(a, b)) + exp(b - greatest(a, b))) AS w FROM (
                   SELECT i, l, fwhm, ln(s1) - 0.5 * ln(2 * pi() * v1) - power(fwhm - m1, 2) / (2 * v1) AS a, ln(s2) - 0.5 * ln(2 * pi() * v2) - power(fwhm - m2, 2) / (2 * v2) AS b
                   FROM d, e WHERE i < 50 AND (was IS NULL OR abs(l - was) >= 1e-3)))) GROUP BY i)),
           f AS (SELECT * FROM e ORDER BY i DESC LIMIT 1),
           c AS (SELECT d.*, CASE WHEN ln(s1) - 0.5 * ln(2 * pi() * v1) - power(fwhm - m1, 2) / (2 * v1) >= ln(s2) - 0.5 * ln(2 * pi() * v2) - power(fwhm - m2, 2) / (2 * v2) THEN 0 ELSE 1 END AS c FROM d, f),
           z AS (SELECT c, count(*) AS n FROM c GROUP BY c),
           k AS (SELECT abs(avg(power((fwhm - (SELECT avg(fwhm) FROM d)) / (SELECT stddev_pop(fwhm) FROM d), 3))) >= 0.5 AND count(*) >= 20
                   AND (SELECT count(*) FROM z) = 2 AND (SELECT min(n) FROM z) / count(*) >= 0.2 AS split FROM d),
           g AS (SELECT c.*, c.c = (SELECT c FROM z ORDER BY n DESC, c LIMIT 1) AS main FROM c)
           SELECT * EXCLUDE (c, main, any_main, split) FROM (SELECT *, bool_or(main) OVER (PARTITION BY nspec) AS any_main FROM g), k WHERE NOT split OR main OR NOT any_main""",
)
def _(t):
    # A quarter of the points moved up makes a second population.
    second = F.when(F.col("point_id") % 4 == 0, 5.0).otherwise(0.0)
    return cv.dominant_population(t.arc.withColumn("fwhm", F.col("fwhm") + second))


@query(
    "fill_missing_fibres", fill="copied_from",
    fix="value",
    sql="""WITH n AS (SELECT unnest(range(1, (SELECT max(nspec) + 1 FROM {known_}))) AS nspec UNION SELECT nspec FROM {known_}),
           d AS (SELECT n.nspec, k.nspec AS src, row_number() OVER (PARTITION BY n.nspec ORDER BY abs(n.nspec - k.nspec), k.nspec) AS rn FROM n, {known_} AS k)
           SELECT d.nspec, CASE WHEN d.nspec <> src THEN src END AS copied_from, wave, value FROM d JOIN {curve_gaps} AS c ON c.nspec = src WHERE rn = 1""",
)
def _(t):
    return cv.fill_missing_fibres(t.curve_gaps).select("nspec", "copied_from", "wave", "value")


@query(
    "merge_curves",
    fix="value",
    sql="""WITH b AS (SELECT * FROM {curve_gaps} WHERE wave BETWEEN 4060 AND 4240), r AS (SELECT nspec, wave, value * 1.1 AS value FROM {curve} WHERE wave BETWEEN 4330 AND 4570),
           e AS (SELECT b.nspec, arg_min(b.value, b.wave) AS v0, arg_max(b.value, b.wave) AS v1 FROM b GROUP BY b.nspec),
           f AS (SELECT nspec, arg_min(value, wave) AS v0, arg_max(value, wave) AS v1, min(wave) AS w0, max(wave) AS w1 FROM r GROUP BY nspec),
           h AS (SELECT nspec, max(wave) AS b1 FROM b GROUP BY nspec),
           g AS (SELECT e.nspec, 4000 + i * 15e0 AS wave, e.v0 AS bv0, e.v1 AS bv1, f.v0 AS rv0, f.v1 AS rv1, b1, w0, w1 FROM e JOIN f ON f.nspec = e.nspec JOIN h ON h.nspec = e.nspec, (SELECT unnest(range(43)) AS i)),
           p AS (SELECT g.*, (SELECT avg(value) FROM b WHERE b.nspec = g.nspec AND abs(b.wave - g.wave) <= 15) AS bi, (SELECT avg(value) FROM r WHERE r.nspec = g.nspec AND abs(r.wave - g.wave) <= 15) AS ri FROM g)
           SELECT nspec, wave, greatest(0.1, CASE WHEN wave < 4060 THEN bv0 WHEN wave > w1 THEN rv1 WHEN wave <= b1 THEN bi WHEN wave >= w0 THEN ri
             ELSE bv1 + (rv0 - bv1) * (wave - b1) / (w0 - b1) END) AS value FROM p""",
)
def _(t):
    blue = t.curve_gaps.where("wave BETWEEN 4060 AND 4240")
    red = t.curve.where("wave BETWEEN 4330 AND 4570").withColumn("value", F.col("value") * 1.1)
    return cv.merge_curves(blue, red, start=4000.0, stop=4630.0, step=15.0)


@query(
    "smooth_curves",
    fix="value",
    sql="""WITH c AS (SELECT nspec, list(value + 0.3 * (CAST(wave AS BIGINT) // 30 % 4) ORDER BY wave) AS v, list(wave ORDER BY wave) AS w FROM {curve} GROUP BY nspec),
           p AS (SELECT *, unnest(range(len(v))) AS i FROM c),
           k AS (SELECT o, exp(-0.5 * power(o / (5 / 6e0), 2)) AS k FROM (SELECT unnest(range(-2, 3)) AS o))
           SELECT nspec, w[i + 1] AS wave, sum(k * v[CASE WHEN abs(i + o) > len(v) - 1 THEN 2 * (len(v) - 1) - abs(i + o) ELSE abs(i + o) END + 1]) / sum(k) AS value FROM p, k GROUP BY nspec, w, i""",
)
def _(t):
    c = t.curve.withColumn("value", F.col("value") + 0.3 * (F.floor(F.col("wave") / 30) % 4))
    return cv.smooth_curves(c, size=5, kind="gaussian")


@query(
    "curve_lookup", fill="curve_key",
    sql="""SELECT t.target_id, t.target_id % 120 AS nspec, CASE WHEN w.spaxel_id IS NOT NULL THEN 'spaxel' WHEN k.nspec IS NOT NULL THEN 'fibre' ELSE 'global' END AS source,
           CASE WHEN w.spaxel_id IS NOT NULL THEN t.target_id WHEN k.nspec IS NOT NULL THEN k.nspec END AS curve_key FROM {target} AS t
           LEFT JOIN (SELECT DISTINCT spaxel_id FROM {weights_}) AS w ON w.spaxel_id = t.target_id LEFT JOIN {known_} AS k ON k.nspec = t.target_id % 120""",
)
def _(t):
    target = t.target.select("target_id", (F.col("target_id") % 120).alias("nspec"))
    return cv.curve_lookup(target, weights(t, per="spaxel_id"), t.curve_gaps)
