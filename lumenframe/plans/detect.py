"""Queries on detections, patches and calibration of thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions.scale import cut
from lumenframe.operators import detect as dt
from lumenframe.operators import patches as pt
from lumenframe.plans.registry import CUBE, query, shared
from lumenframe.plans.spatial import SEP

VID = "cube_id * 1000000 + iw * 100000 + iy * 1000 + ix"


def voxels(t):
    return t.voxel.withColumn("voxel_id", F.col("cube_id") * 1000000 + F.col("iw") * 100000 + F.col("iy") * 1000 + F.col("ix"))


def _clip(a: str, b: str) -> str:
    return f"""{b} AS (SELECT {a}.field, x FROM {a} JOIN (SELECT field, median(x) AS m, stddev_pop(x) AS s FROM {a} GROUP BY field) AS q ON q.field = {a}.field
               WHERE abs(x - m) <= 3 * s)"""


@query(
    "robust_sky",
    fix="level rms rejected",
    sql=f"""WITH c0 AS (SELECT p_partkey // 100 AS field, CASE WHEN p_partkey % 41 = 0 THEN p_retailprice * 5 ELSE p_retailprice END AS x FROM {{part}}), {', '.join(_clip(f'c{i}', f'c{i + 1}') for i in range(10))}
            SELECT field, median(x) AS level, stddev_pop(x) AS rms, 1 - count(*) / any_value(n_all) AS rejected, count(*) AS n
            FROM c10 JOIN (SELECT field, count(*) AS n_all FROM c0 GROUP BY field) AS a USING (field) GROUP BY field""",
)
def _(t):
    px = t.part.select(F.floor(F.col("p_partkey") / 100).alias("field"), F.when(F.col("p_partkey") % 41 == 0, F.col("p_retailprice") * 5).otherwise(F.col("p_retailprice")).alias("data"))
    return dt.robust_sky(px, keys=["field"])


@query("noise_scale", fix="k", sql="SELECT cube_id, (quantile_cont(data * sqrt(ivar), 0.84) - quantile_cont(data * sqrt(ivar), 0.16)) / 1.988915766419506 AS k FROM {voxel} WHERE ivar > 0 GROUP BY cube_id")
def _(t):
    return dt.noise_scale(t.voxel, keys=CUBE)


@query(
    "noise_scale_per_wave",
    fix="k",
    sql="""WITH q AS (SELECT cube_id, iw, CASE WHEN count(*) >= 50 THEN greatest(1, (quantile_cont(data * sqrt(ivar), 0.84) - quantile_cont(data * sqrt(ivar), 0.16)) / 1.988915766419506) ELSE 1 END AS k
                 FROM (SELECT cube_id, iw, data * (1 + iw % 3) AS data, ivar FROM {voxel}) WHERE ivar > 0 GROUP BY cube_id, iw),
           l AS (SELECT cube_id, list(k ORDER BY iw) AS k, list(iw ORDER BY iw) AS w FROM q GROUP BY cube_id), p AS (SELECT *, unnest(range(1, len(k) + 1)) AS i FROM l)
           SELECT cube_id, w[i] AS iw, (k[greatest(1, i - 1)] + k[i] + k[least(len(k), i + 1)]) / 3 AS k FROM p""",
)
def _(t):
    return dt.noise_scale(t.voxel.withColumn("data", F.col("data") * (1 + F.col("iw") % 3)), per_wave=True, smooth=3, keys=CUBE)


THRESHOLDS = [0.5, 1.0, 1.5, 2.0, 2.5]
shared(
    "purity_",
    """SELECT *, 1 - n_neg / greatest(n_pos, 1) AS purity FROM (
       SELECT cube_id, t AS threshold, count(*) FILTER (snr + 0.3 >= t) AS n_pos, count(*) FILTER (-snr >= t) AS n_neg
       FROM {voxel}, (VALUES (0.5e0), (1e0), (1.5e0), (2e0), (2.5e0)) AS v(t) GROUP BY cube_id, t)""",
)


def purity(t):
    pos = t.voxel.select("cube_id", (F.col("snr") + 0.3).alias("snr"))
    return dt.purity_scan(pos, t.voxel.select("cube_id", (-F.col("snr")).alias("snr")), thresholds=THRESHOLDS, keys=CUBE)


@query("purity_scan", fix="threshold purity", sql="SELECT * FROM {purity_}")
def _(t):
    return purity(t)


@query(
    "choose_threshold",
    fix="min_snr",
    sql="SELECT cube_id, CASE WHEN min(threshold) FILTER (purity >= 0.55 AND n_pos >= 15) IS NOT NULL THEN greatest(1.2, min(threshold) FILTER (purity >= 0.55 AND n_pos >= 15)) END AS min_snr FROM {purity_} GROUP BY cube_id",
)
def _(t):
    return dt.choose_threshold(purity(t), target=0.55, min_n=15, floor=1.2, keys=CUBE)


@query("loudest_event", fix="loudest threshold", sql="SELECT cube_id, max(-snr) AS loudest, max(-snr) * 1.1 AS threshold FROM {voxel} GROUP BY cube_id")
def _(t):
    return dt.loudest_event(t.voxel.select("cube_id", (-F.col("snr")).alias("snr")), keys=CUBE)


def bank_sql(sigmas) -> str:
    """The filter for several spectral widths, as three sums over taps."""
    taps = " UNION ALL ".join(f"SELECT {s}e0 AS width, o, exp(-0.5 * power(o / {s}e0, 2)) AS k FROM (SELECT unnest(range(-{r}, {r} + 1)) AS o)" for s, r in sigmas)
    return f"""WITH kw AS ({taps}), ks AS (SELECT o, exp(-0.5 * power(o / 0.6, 2)) AS k FROM (SELECT unnest(range(-2, 3)) AS o)),
           b AS (SELECT cube_id, iw, iy + o AS iy, ix, sum(ivar * data * k) AS n, sum(ivar * k * k) AS d FROM {{voxel}}, ks WHERE iy + o BETWEEN 0 AND 24 GROUP BY ALL),
           c AS (SELECT cube_id, iw, iy, ix + o AS ix, sum(n * k) AS n, sum(d * k * k) AS d FROM b, ks WHERE ix + o BETWEEN 0 AND 39 GROUP BY ALL),
           a AS (SELECT cube_id, width, iw + o AS iw, iy, ix, sum(n * k) AS n, sum(d * k * k) AS d FROM c, kw WHERE iw + o BETWEEN 1 AND 7 GROUP BY ALL),
           m AS (SELECT cube_id, width, median(d) AS m FROM a WHERE d > 0 GROUP BY cube_id, width)
           SELECT cube_id, width, iw, iy, ix, CASE WHEN d > 0 AND d >= 0.9 * m THEN n / sqrt(d) ELSE 0 END AS snr FROM a JOIN m USING (cube_id, width)"""


FRAME = {"iw": (1, 7), "iy": (0, 24), "ix": (0, 39)}
shared("bank_", bank_sql([(0.8, 3), (1.6, 6)]))


@query("matched_filter", fix="snr", sql="SELECT * EXCLUDE (width) FROM {bank_} WHERE width = 0.8")
def _(t):
    return dt.matched_filter(t.voxel, spectral_sigma=0.8, spatial_sigma=0.6, bounds=FRAME, coverage=0.9, keys=CUBE)


def bank(t, voxel=None):
    return dt.matched_filter_bank(t.voxel if voxel is None else voxel, spectral_sigmas=[0.8, 1.6], spatial_sigma=0.6, bounds=FRAME, coverage=0.9, keys=CUBE)


@query("matched_filter_bank", fix="snr width", sql="SELECT * FROM {bank_}")
def _(t):
    return bank(t)


shared(
    "conn_",
    f"""WITH RECURSIVE v AS (SELECT {VID} AS id, cube_id, iw, iy, ix, snr FROM {{voxel}} WHERE snr > 1.5),
        e AS (SELECT a.id AS a, b.id AS b FROM v AS a JOIN v AS b ON a.cube_id = b.cube_id AND abs(a.iw - b.iw) <= 1 AND abs(a.iy - b.iy) <= 1 AND abs(a.ix - b.ix) <= 1),
        r(id, other) AS (SELECT a, b FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
        c AS (SELECT id, min(other) AS comp FROM r GROUP BY id)
        SELECT any_value(cube_id) AS cube_id, comp AS cand_id, arg_max(iw, (snr, -iw, -iy, -ix)) AS iw, arg_max(iy, (snr, -iw, -iy, -ix)) AS iy, arg_max(ix, (snr, -iw, -iy, -ix)) AS ix, max(snr) AS snr, count(*) AS npix
        FROM v JOIN c ON c.id = v.id GROUP BY comp""",
)


@query("connected_voxels", fix="snr", sql="SELECT * FROM {conn_}")
def _(t):
    return dt.connected_voxels(voxels(t), threshold=1.5, keys=CUBE)


shared("cand_", f"SELECT {VID} AS cand_id, cube_id, iw, iy, ix, snr, CAST(1 + ({VID}) % 7 AS BIGINT) AS npix FROM {{voxel}} WHERE snr > 1.5")


def candidates(t):
    v = voxels(t).where("snr > 1.5").withColumnRenamed("voxel_id", "cand_id")
    return v.select("cand_id", "cube_id", "iw", "iy", "ix", "snr", (1 + F.col("cand_id") % 7).alias("npix"))


@query(
    "dedupe_candidates",
    fix="snr",
    sql="""WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY snr DESC, cand_id) AS rn, * FROM {cand_}),
           g(n, kept) AS (SELECT 1, [{'id': cand_id, 'c': cube_id, 'w': iw, 'y': iy, 'x': ix}] FROM r WHERE rn = 1
             UNION ALL SELECT n + 1, CASE WHEN len(list_filter(kept, lambda k: k.c = cube_id AND abs(k.w - iw) <= 4 AND abs(k.y - iy) <= 3 AND abs(k.x - ix) <= 3)) > 0 THEN kept
               ELSE list_append(kept, {'id': cand_id, 'c': cube_id, 'w': iw, 'y': iy, 'x': ix}) END FROM g JOIN r ON rn = n + 1),
           k AS (SELECT unnest(kept) AS s FROM (SELECT kept FROM g ORDER BY n DESC LIMIT 1))
           SELECT c.* FROM {cand_} AS c JOIN k ON k.s.id = c.cand_id""",
)
def _(t):
    return dt.dedupe_candidates(candidates(t), keys=CUBE)


shared(
    "covered_",
    "SELECT DISTINCT cube_id, ix, iy FROM {voxel} WHERE (ix * 7 + iy * 13) % 61 <> 0",
)
shared(
    "resolved_",
    """SELECT c.* FROM {cand_} AS c JOIN {voxel} AS p ON p.cube_id = c.cube_id AND p.iw = c.iw AND p.iy = c.iy AND p.ix = c.ix
       JOIN (SELECT c.cand_id, avg(v.data) AS m FROM {cand_} AS c JOIN {voxel} AS v ON v.cube_id = c.cube_id AND abs(v.iw - c.iw) = 1 AND v.iy = c.iy AND v.ix = c.ix GROUP BY c.cand_id) AS n ON n.cand_id = c.cand_id
       WHERE p.data <> 0 AND m / p.data >= 0.05 * exp(-0.5)""",
)


@query(
    "candidate_vetoes",
    fix="snr",
    sql="""WITH s AS (SELECT * FROM {resolved_} WHERE npix BETWEEN 2 AND 6),
           b AS (SELECT cube_id, iw // 5 AS wb, count(*) AS n FROM s GROUP BY cube_id, iw // 5),
           m AS (SELECT cube_id, median(n) AS med FROM b GROUP BY cube_id), d AS (SELECT cube_id, median(abs(n - med)) AS mad FROM b JOIN m USING (cube_id) GROUP BY cube_id),
           k AS (SELECT s.* FROM s JOIN b ON wb = iw // 5 AND b.cube_id = s.cube_id JOIN m ON m.cube_id = s.cube_id JOIN d ON d.cube_id = s.cube_id
                 WHERE NOT n > greatest(8, med + 6 * 1.4826 * CASE WHEN mad = 0 THEN 1 ELSE mad END)),
           u AS (SELECT q.cube_id, x AS bx, y AS by_ FROM (SELECT DISTINCT cube_id FROM {voxel}) AS q, (SELECT unnest(range(40)) AS x), (SELECT unnest(range(25)) AS y)
                 WHERE NOT EXISTS (SELECT 1 FROM {covered_} AS c WHERE c.cube_id = q.cube_id AND c.ix = x AND c.iy = y))
           SELECT k.* FROM k WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.cube_id = k.cube_id AND power(ix - bx, 2) + power(iy - by_, 2) < 4)""",
)
def _(t):
    return dt.candidate_vetoes(candidates(t), t.voxel, covered(t), nx=40, ny=25, min_fraction=0.05, min_npix=2, max_npix=6, min_distance=2.0, keys=CUBE)


def covered(t, voxel=None):
    return (t.voxel if voxel is None else voxel).where("(ix * 7 + iy * 13) % 61 <> 0").select("cube_id", "ix", "iy").distinct()


@query(
    "coincidence_veto",
    fix="snr",
    sql="""WITH s AS (SELECT event_id AS cand_id, CAST(floor(value) AS BIGINT) AS iw, value AS snr FROM {events}),
           b AS (SELECT iw // 5 AS wb, count(*) AS n FROM s GROUP BY iw // 5), m AS (SELECT median(n) AS med FROM b), d AS (SELECT median(abs(n - med)) AS mad FROM b, m)
           SELECT s.* FROM s JOIN b ON wb = iw // 5, m, d WHERE NOT n > greatest(8, med + 2 * 1.4826 * CASE WHEN mad = 0 THEN 1 ELSE mad END)""",
)
def _(t):
    c = t.events.select(F.col("event_id").alias("cand_id"), F.floor("value").alias("iw"), F.col("value").alias("snr"))
    return dt.coincidence_veto(c, mad_k=2.0)


PURITY_AT = [1.8, 2.1, 2.4]
shared(
    "found_",
    f"""WITH RECURSIVE t AS (SELECT * FROM (VALUES (0, 1.8e0), (1, 2.1e0), (2, 2.4e0)) AS v(k, thr)),
        s AS (SELECT *, 0 AS neg FROM {{bank_}} UNION ALL SELECT * REPLACE (-snr AS snr), 1 AS neg FROM {{bank_}}),
        v AS (SELECT ((({VID}) * 2 + neg) * 64 + CASE WHEN width < 1 THEN 0 ELSE 1 END) * 4 + k AS id, s.*, k FROM s JOIN t ON snr > thr),
        e AS (SELECT a.id AS a, b.id AS b FROM v AS a JOIN v AS b ON a.cube_id = b.cube_id AND a.neg = b.neg AND a.k = b.k AND a.width = b.width
              AND abs(a.iw - b.iw) <= 1 AND abs(a.iy - b.iy) <= 1 AND abs(a.ix - b.ix) <= 1),
        r(id, other) AS (SELECT a, b FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
        c AS (SELECT id, min(other) AS comp FROM r GROUP BY id)
        SELECT comp AS cand_id, any_value(cube_id) AS cube_id, any_value(neg) AS neg, any_value(k) AS k, any_value(width) AS width, arg_max(iw, (snr, -iw, -iy, -ix)) AS iw,
               arg_max(iy, (snr, -iw, -iy, -ix)) AS iy, arg_max(ix, (snr, -iw, -iy, -ix)) AS ix, max(snr) AS snr, count(*) AS npix FROM v JOIN c ON c.id = v.id GROUP BY comp""",
)
shared(
    "thin_",
    """WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY snr DESC, cand_id) AS rn, * FROM {found_}),
       g(n, kept) AS (SELECT 1, [{'id': cand_id, 'c': cube_id, 's': neg, 'k': k, 'w': iw, 'y': iy, 'x': ix}] FROM r WHERE rn = 1
         UNION ALL SELECT n + 1, CASE WHEN len(list_filter(kept, lambda q: q.c = cube_id AND q.s = neg AND q.k = r.k AND abs(q.w - iw) <= 4 AND abs(q.y - iy) <= 3 AND abs(q.x - ix) <= 3)) > 0 THEN kept
           ELSE list_append(kept, {'id': cand_id, 'c': cube_id, 's': neg, 'k': r.k, 'w': iw, 'y': iy, 'x': ix}) END FROM g JOIN r ON rn = n + 1),
       k AS (SELECT unnest(kept) AS s FROM (SELECT kept FROM g ORDER BY n DESC LIMIT 1))
       SELECT c.* FROM {found_} AS c JOIN k ON k.s.id = c.cand_id""",
)


@query(
    "post_veto_purity",
    fix="threshold purity",
    sql="""WITH d AS (SELECT cube_id, iw, iy, ix, data, 0 AS neg FROM {voxel} UNION ALL SELECT cube_id, iw, iy, ix, -data, 1 FROM {voxel}),
           n AS (SELECT c.cand_id, avg(d.data) AS m FROM {thin_} AS c JOIN d ON d.cube_id = c.cube_id AND d.neg = c.neg AND abs(d.iw - c.iw) = 1 AND d.iy = c.iy AND d.ix = c.ix GROUP BY c.cand_id),
           s AS (SELECT c.* FROM {thin_} AS c JOIN d ON d.cube_id = c.cube_id AND d.neg = c.neg AND d.iw = c.iw AND d.iy = c.iy AND d.ix = c.ix JOIN n ON n.cand_id = c.cand_id
                 WHERE d.data <> 0 AND m / d.data >= 0.05 * exp(-0.5 / (width * width)) AND npix BETWEEN 2 AND 200),
           b AS (SELECT cube_id, neg, k, iw // 5 AS wb, count(*) AS n FROM s GROUP BY ALL),
           med AS (SELECT cube_id, neg, k, median(n) AS med FROM b GROUP BY ALL),
           dev AS (SELECT cube_id, neg, k, median(abs(n - med)) AS mad FROM b JOIN med USING (cube_id, neg, k) GROUP BY ALL),
           f AS (SELECT s.* FROM s JOIN b ON wb = iw // 5 AND b.cube_id = s.cube_id AND b.neg = s.neg AND b.k = s.k JOIN med ON med.cube_id = s.cube_id AND med.neg = s.neg AND med.k = s.k
                 JOIN dev ON dev.cube_id = s.cube_id AND dev.neg = s.neg AND dev.k = s.k WHERE NOT b.n > greatest(8, med + 6 * 1.4826 * CASE WHEN mad = 0 THEN 1 ELSE mad END)),
           u AS (SELECT q.cube_id, x AS bx, y AS by_ FROM (SELECT DISTINCT cube_id FROM {voxel}) AS q, (SELECT unnest(range(40)) AS x), (SELECT unnest(range(25)) AS y)
                 WHERE NOT EXISTS (SELECT 1 FROM {covered_} AS c WHERE c.cube_id = q.cube_id AND c.ix = x AND c.iy = y)),
           l AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.cube_id = f.cube_id AND power(ix - bx, 2) + power(iy - by_, 2) < 2.25))
           SELECT *, 1 - n_neg / greatest(n_pos, 1) AS purity FROM (
             SELECT q.cube_id, thr AS threshold, count(l.cand_id) FILTER (l.neg = 0) AS n_pos, count(l.cand_id) FILTER (l.neg = 1) AS n_neg
             FROM (SELECT DISTINCT cube_id FROM {voxel}) AS q CROSS JOIN (VALUES (0, 1.8e0), (1, 2.1e0), (2, 2.4e0)) AS t(k, thr) LEFT JOIN l ON l.cube_id = q.cube_id AND l.k = t.k GROUP BY q.cube_id, thr)""",
)
def _(t):
    voxel = cut(t.voxel)  # read by the filter, the vetoes and the coverage
    v = bank(t, voxel).withColumn("voxel_id", F.col("cube_id") * 1000000 + F.col("iw") * 100000 + F.col("iy") * 1000 + F.col("ix"))
    return dt.post_veto_purity(
        v, voxel, covered(t, voxel), thresholds=PURITY_AT, nx=40, ny=25, min_fraction=0.05, min_npix=2, max_npix=200, min_distance=1.5, keys=CUBE
    )


shared(
    "grouped_",
    """WITH RECURSIVE p AS (SELECT cube_id, ix, iy, min(cand_id) AS id FROM {cand_} GROUP BY cube_id, ix, iy),
       e AS (SELECT a.id AS a, b.id AS b FROM p AS a JOIN p AS b ON a.cube_id = b.cube_id AND power(a.ix - b.ix, 2) + power(a.iy - b.iy, 2) <= 2.25),
       r(id, other) AS (SELECT a, b FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
       g AS (SELECT id, min(other) AS group_id FROM r GROUP BY id)
       SELECT c.cube_id, c.cand_id, c.snr, group_id FROM {cand_} AS c JOIN p ON p.cube_id = c.cube_id AND p.ix = c.ix AND p.iy = c.iy JOIN g ON g.id = p.id""",
)


@query("group_candidates", fix="snr", sql="SELECT * FROM {grouped_}")
def _(t):
    return dt.group_candidates(candidates(t), radius=1.5, keys=CUBE).select("cube_id", "cand_id", "snr", "group_id")


shared("same_pixel_", "SELECT *, min(cand_id) OVER (PARTITION BY cube_id, ix, iy) AS group_id FROM {cand_}")


@query(
    "group_significance",
    fix="group_snr",
    sql="SELECT group_id, sqrt(sum(snr * snr)) AS group_snr, count(*) AS n_lines FROM {same_pixel_} GROUP BY group_id HAVING count(*) >= 2",
)
def _(t):
    return dt.group_significance(dt.group_candidates(candidates(t), keys=CUBE), min_lines=2)


GROUP_THRESHOLDS = [2.0, 2.3, 2.6, 3.0]


@query(
    "group_purity",
    fix="threshold purity",
    sql="""WITH s AS (SELECT cube_id, iw, iy, ix, snr, 0 AS neg FROM {voxel} WHERE snr > 1.2 UNION ALL SELECT cube_id, iw, iy, ix, -snr, 1 FROM {voxel} WHERE -snr > 1.2),
           g AS (SELECT neg, cube_id, sqrt(sum(snr * snr)) AS snr FROM s GROUP BY neg, cube_id, iy, ix HAVING count(*) >= 2),
           n AS (SELECT cube_id, t AS threshold, count(*) FILTER (neg = 0 AND snr >= t) AS n_pos, count(*) FILTER (neg = 1 AND snr >= t) AS n_neg
                 FROM g, (VALUES (2e0), (2.3e0), (2.6e0), (3e0)) AS v(t) GROUP BY cube_id, t)
           SELECT *, 1 - n_neg / greatest(n_pos, 1) AS purity FROM n""",
)
def _(t):
    v = voxels(t).withColumnRenamed("voxel_id", "cand_id")
    neg = v.withColumn("snr", -F.col("snr"))
    return dt.group_purity(v.where("snr > 1.2"), neg.where("snr > 1.2"), thresholds=GROUP_THRESHOLDS, keys=CUBE)


@query(
    "footprint_size",
    fix="footprint",
    sql="""WITH RECURSIVE v AS (SELECT target_id AS id, ix, iy FROM {spaxel} WHERE noise <= 3),
           e AS (SELECT a.id AS a, b.id AS b FROM v AS a JOIN v AS b ON abs(a.iy - b.iy) + abs(a.ix - b.ix) <= 1),
           r(id, other) AS (SELECT a, b FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
           s AS (SELECT comp, count(*) AS size FROM (SELECT id, min(other) AS comp FROM r GROUP BY id) GROUP BY comp)
           SELECT count(*) AS n_components, CASE WHEN count(*) >= 100 AND median(size) <= 200 THEN median(size) END AS footprint FROM s""",
)
def _(t):
    px = t.spaxel.where("noise <= 3").select(F.col("target_id").alias("id"), "ix", "iy")
    return dt.footprint_size(px)


PATCHES = """SELECT id AS patch_id, ra, dec, 0.001e0 + id % 5 / 5000e0 AS a, 0.001e0 AS b, 0e0 AS angle, 0e0 AS flag,
  CASE WHEN id % 6 = 0 THEN 'M' WHEN id = 1 THEN 'C' ELSE 'T' END AS type FROM {cat_b}"""
shared("patch_", PATCHES)


@query(
    "promote_candidates",
    fix="ra dec a b",
    sql=f"""WITH c AS (SELECT s.cand_id, s.snr, s.group_id, 10 + s.ix / 800e0 + s.cube_id / 20e0 AS ra, 20 + s.iy / 500e0 AS dec, NOT EXISTS (SELECT 1 FROM {{object}} AS o
                 WHERE o.cube_id = s.cube_id AND power(o.ox - s.ix, 2) + power(o.oy - s.iy, 2) <= 16) AS lone FROM {{same_pixel_}} AS s),
            g AS (SELECT group_id FROM c WHERE lone GROUP BY group_id HAVING count(*) >= 2 AND sqrt(sum(snr * snr)) >= 2.6),
            p AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY snr DESC, cand_id) AS rn FROM c WHERE lone AND (snr >= 2.3 OR group_id IN (SELECT group_id FROM g) OR snr >= 3.3)),
            k AS (SELECT a.* FROM p AS a WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM {{patch_}} AS b WHERE b.type <> 'M' AND abs(a.dec - b.dec) < 0.002 AND {SEP} <= 3))
            SELECT patch_id, ra, dec, a, b, angle, flag, type FROM {{patch_}}
            UNION ALL SELECT (SELECT max(patch_id) FROM {{patch_}}) + row_number() OVER (ORDER BY snr DESC, cand_id), ra, dec, 2 / 3600e0, 2 / 3600e0, 0, 3, 'T' FROM k""",
)
def _(t):
    cand = dt.group_candidates(candidates(t), keys=CUBE)
    cand = dt.line_only(cand, t.object, keys=CUBE)
    cand = cand.withColumns({"ra": 10 + F.col("ix") / 800.0 + F.col("cube_id") / 20.0, "dec": 20 + F.col("iy") / 500.0})
    return dt.promote_candidates(cand, t.sql(PATCHES), min_snr=2.3, group_min_lines=2, group_min_snr=2.6, extreme_snr=3.3)


@query(
    "make_patches",
    fix="ra dec a:8 b:8 angle flag",
    sql="""WITH o AS (SELECT obj_id, 10 + ox / 1000 AS ra, 20 + oy / 1000 AS dec, a, b, obj_id % 7 / 5e0 AS theta, row_number() OVER (ORDER BY flux DESC, obj_id) AS patch_id FROM {object})
           SELECT 0 AS patch_id, 10.02 AS ra, 20.01 AS dec, 0.05 AS a, 0.04 AS b, 0 AS angle, 0 AS flag, 'C' AS type
           UNION ALL SELECT patch_id, ra, dec, a * 7 * 0.0002, b * 7 * 0.0002, degrees(theta), 0, 'T' FROM o
           UNION ALL SELECT (SELECT count(*) FROM {object}) + row_number() OVER (ORDER BY c_custkey), 10 + c_custkey / 1e5, 20, 8 / 3600e0, 8 / 3600e0, 0, 0, 'M' FROM {customer}""",
)
def _(t):
    objects = t.object.select("obj_id", (10 + F.col("ox") / 1000).alias("ra"), (20 + F.col("oy") / 1000).alias("dec"), "a", "b", (F.col("obj_id") % 7 / 5.0).alias("theta"), "flux", F.lit(0).alias("flag"))
    masks = t.customer.select(F.col("c_custkey").alias("mask_id"), (10 + F.col("c_custkey") / 1e5).alias("ra"), F.lit(20.0).alias("dec"))
    return pt.make_patches(objects, (10.02, 20.01, 0.05, 0.04), masks, pixel_scale=0.0002, mask_radius=4.0)


@query(
    "split_patches",
    fix="z",
    sql="""WITH r AS (SELECT target_id AS patch_id, znum, class, z, zwarn FROM {zfit}),
           g AS (SELECT 0 AS grp, ['GALAXY', 'QSO'] AS cls UNION ALL SELECT 1, ['STAR', 'WD']),
           m AS (SELECT patch_id, grp, min(znum) FILTER (list_contains(cls, class)) AS hit FROM r, g GROUP BY patch_id, grp),
           x AS (SELECT p.*, g.grp, m.hit, v.class, v.z FROM {patch_} AS p CROSS JOIN g LEFT JOIN m ON m.patch_id = p.patch_id AND m.grp = g.grp
                 LEFT JOIN r AS v ON v.patch_id = p.patch_id AND v.znum = COALESCE(m.hit, 0) WHERE m.hit IS NOT NULL OR type = 'M')
           SELECT row_number() OVER (ORDER BY a * b DESC, CASE class WHEN 'GALAXY' THEN 0 WHEN 'QSO' THEN 1 WHEN 'STAR' THEN 2 ELSE 4 END, patch_id, grp) - 1 AS patch_id, patch_id AS old_id, grp, type, class, z FROM x""",
)
def _(t):
    ranks = t.zfit.select(F.col("target_id").alias("patch_id"), F.col("znum").alias("rank"), "class", "z", "zerr", "zwarn")
    return pt.split_patches(t.sql(PATCHES), ranks).select("patch_id", "old_id", "grp", "type", "class", "z")


@query(
    "patch_checks", fill="patch_id",
    sql="""WITH r AS (SELECT target_id AS patch_id, znum, class, CASE WHEN target_id % 4 = 0 THEN NULL ELSE z END AS z, zwarn FROM {zfit}),
           p AS (SELECT patch_id, CASE WHEN patch_id % 23 = 0 THEN 0 ELSE a END AS a, b, type FROM {patch_} UNION ALL SELECT patch_id, a, b, type FROM {patch_} WHERE patch_id % 29 = 0),
           z AS (SELECT patch_id, bool_or(z IS NOT NULL) AS ok, max(zwarn) AS w FROM r GROUP BY patch_id)
           SELECT 'duplicate_id' AS rule, patch_id FROM p GROUP BY patch_id HAVING count(*) > 1
           UNION ALL SELECT 'no_redshift', p.patch_id FROM p LEFT JOIN z ON z.patch_id = p.patch_id WHERE type <> 'M' AND NOT COALESCE(ok, FALSE)
           UNION ALL SELECT 'redshift_warning', p.patch_id FROM p JOIN z ON z.patch_id = p.patch_id WHERE w > 0
           UNION ALL SELECT 'zero_size', patch_id FROM p WHERE a = 0 OR b = 0
           UNION ALL SELECT 'no_wanted_class', NULL""",
)
def _(t):
    ranks = t.zfit.select(F.col("target_id").alias("patch_id"), F.col("znum").alias("rank"), "class", F.when(F.col("target_id") % 4 != 0, F.col("z")).alias("z"), "zwarn")
    p = t.sql(PATCHES)
    bad = p.withColumn("a", F.when(F.col("patch_id") % 23 == 0, 0.0).otherwise(F.col("a")))
    return pt.patch_checks(bad.unionByName(p.where("patch_id % 29 = 0")), ranks, wanted=["WD"])
