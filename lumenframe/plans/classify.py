"""Queries on classes and redshift ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import classify as cl
from lumenframe.plans.registry import query, shared

CODES = [("STAR", "DISC"), ("GALAXY", "DEE"), ("QSO", "DEEP")]

STAR = "('STAR|WD|CV|MS|STELLAR|OB|GIANTS|DWARFS')"
QSO = "('QSO|QUASAR|AGN|BLAZAR|SEYFERT')"
GAL = "('GALAXY|GALAXIES|ELG|LRG|BCG|NEBULA|NEBULAE|HII|EMISSION|EXTRAGAL')"


def kw(col: str) -> str:
    return (
        f"CASE WHEN regexp_matches(upper({col}), {STAR}) THEN 'STAR' WHEN regexp_matches(upper({col}), {QSO}) THEN 'QSO' "
        f"WHEN regexp_matches(upper({col}), {GAL}) THEN 'GALAXY' END"
    )


HINT = f"COALESCE({kw('targclass')}, {kw('targprog')}, {kw('targsrvy')})"


@query(
    "survey_class",
    sql=f"""SELECT target_id, COALESCE({kw('targclass')}, {kw('targprog')}, CASE targsrvy WHEN 'DISC' THEN 'STAR' WHEN 'DEEP' THEN 'QSO' END, 'none') AS srvy_class FROM {{zhint}}""",
)
def _(t):
    return cl.survey_class(t.zhint.withColumn("class", F.lit("none")), codes=CODES, default="class").select("target_id", "srvy_class")


@query("star_prior_table", fix="z sigma", sql=f"SELECT target_id, 0e0 AS z, 0.003 AS sigma, 'gaussian' AS function FROM {{zhint}} WHERE {HINT} = 'STAR'")
def _(t):
    return cl.star_prior_table(t.zhint, sigma=0.003)


@query(
    "rank_best",
    fix="z0 z2 chi1",
    sql="""SELECT target_id, max(z) FILTER (znum = 0) AS z0, max(z) FILTER (znum = 2) AS z2, max(chi2) FILTER (znum = 1) AS chi1, max(class) FILTER (znum = 2) AS class2
           FROM {zfit} GROUP BY target_id HAVING count(*) > 3""",
)
def _(t):
    b = cl.rank_best(t.zfit, ntop=3)
    at = lambda c, i: F.get(c, F.lit(i))
    return b.select("target_id", at("z", 0).alias("z0"), at("z", 2).alias("z2"), at("chi2", 1).alias("chi1"), at("class", 2).alias("class2"))


@query(
    "rank_rows", fill="extra",
    fix="z",
    sql="""SELECT target_id, znum AS rank, z, class, CASE WHEN znum = 0 THEN target_id * 2 END AS extra FROM {zfit}
           WHERE znum < 3 AND target_id IN (SELECT target_id FROM {zfit} GROUP BY target_id HAVING count(*) > 3)""",
)
def _(t):
    b = cl.rank_best(t.zfit, ntop=3).withColumn("extra", F.col("target_id") * 2)
    return cl.rank_rows(b, ranked=["z", "class"], single=["extra"])


@query(
    "inject_class",
    fix="z zerr chi2",
    sql=f"""WITH h AS (SELECT target_id, {HINT} AS hint FROM {{zhint}}),
            f AS (SELECT f.*, h.hint FROM {{zfit}} AS f LEFT JOIN h ON h.target_id = f.target_id),
            p AS (SELECT target_id FROM f WHERE hint IS NOT NULL GROUP BY target_id HAVING NOT bool_or(class = hint AND znum < 3)),
            c AS (SELECT f.*, row_number() OVER (PARTITION BY f.target_id ORDER BY CASE WHEN znum >= 3 THEN 0 ELSE 1 END, chi2 * CASE WHEN zwarn = 0 THEN 1 ELSE 1.5 END, znum) AS rn
                  FROM f JOIN p ON p.target_id = f.target_id WHERE class = hint),
            b AS (SELECT * FROM c WHERE rn = 1)
            SELECT f.target_id, f.znum, CASE WHEN b.target_id IS NULL THEN f.z ELSE b.z END AS z, CASE WHEN b.target_id IS NULL THEN f.zerr ELSE b.zerr END AS zerr,
            CASE WHEN b.target_id IS NULL THEN f.zwarn ELSE b.zwarn END AS zwarn, CASE WHEN b.target_id IS NULL THEN f.class ELSE b.class END AS class,
            CASE WHEN b.target_id IS NULL THEN f.chi2 ELSE b.chi2 END AS chi2, b.target_id IS NOT NULL AS injected
            FROM f LEFT JOIN b ON b.target_id = f.target_id AND f.znum = 2 WHERE f.znum < 3""",
)
def _(t):
    return cl.inject_class(t.zfit, t.zhint, ntop=3)


shared("scan_", "SELECT *, split_part(template, ':::', 1) AS class FROM {zscan}")
shared(
    "best_",
    """SELECT target_id, class, chi2 AS best_chi2, template, z AS z0 FROM (SELECT *, row_number() OVER (PARTITION BY target_id, class ORDER BY chi2, template, i) AS rn FROM {scan_}) WHERE rn = 1""",
)
shared(
    "sums_",
    """SELECT target_id, class, z0, best_chi2, count(*) AS n, min(z) AS zlo, max(z) AS zhi, sum(u) AS s1, sum(u * u) AS s2, sum(u * u * u) AS s3, sum(u * u * u * u) AS s4,
       sum(chi2) AS t0, sum(u * chi2) AS t1, sum(u * u * chi2) AS t2 FROM (SELECT s.target_id, b.class, z0, best_chi2, s.z, s.chi2, (s.z - z0) / 0.05 AS u FROM {scan_} AS s
       JOIN {best_} AS b ON b.target_id = s.target_id AND b.template = s.template WHERE s.z >= z0 - 0.05 AND s.z <= z0 + 0.05) GROUP BY target_id, class, z0, best_chi2""",
)
shared(
    "refine_",
    """WITH d AS (SELECT *, CASE WHEN n >= 5 AND abs(n * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)) > 1e-12
             THEN n * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2) END AS det FROM {sums_}),
       c AS (SELECT *, (n * (s2 * t2 - s3 * t1) - s1 * (s1 * t2 - s2 * t1) + t0 * (s1 * s3 - s2 * s2)) / det AS c2,
             (n * (t1 * s4 - t2 * s3) - t0 * (s1 * s4 - s2 * s3) + s2 * (s1 * t2 - s2 * t1)) / det AS c1,
             (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - t2 * s3) + s2 * (t1 * s3 - t2 * s2)) / det AS c0 FROM d),
       v AS (SELECT *, -c1 / nullif(c2 * 2, 0) AS vx FROM c),
       w AS (SELECT target_id, class, z0 AS z_scan, best_chi2, n, zlo, zhi, COALESCE(z0 + vx * 0.05, z0) AS z_fit, COALESCE(c0 + c1 * vx + c2 * vx * vx, best_chi2) AS chi2_fit,
             COALESCE(c2 / 0.0025, 0) AS curvature FROM v)
       SELECT target_id, class, z_scan, best_chi2, n, z_fit, chi2_fit, CASE WHEN curvature > 0 THEN 1 / sqrt(curvature) END AS z_sigma, curvature,
       abs(z_fit - z_scan) / (1 + z_scan) * 299792.458 AS dv,
       n >= 5 AND curvature > 0 AND z_fit BETWEEN zlo AND zhi AND abs(chi2_fit - best_chi2) / greatest(best_chi2, 1) <= 0.05 AND curvature / greatest(best_chi2, 1) >= 1e-5 AS reliable FROM w""",
)


@query("refine_minimum", fix="z_scan best_chi2 z_fit:5 chi2_fit:3 z_sigma curvature:2 dv:1", sql="SELECT * FROM {refine_}")
def _(t):
    return cl.refine_minimum(t.zscan)


ZFIT_NEAR = "SELECT target_id, znum, z, zerr, zwarn, class, 60 + (chi2 - floor(chi2 / 100) * 100) AS chi2 FROM {zfit}"
shared("zf_", ZFIT_NEAR)
shared(
    "dec_",
    f"""WITH co AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY best_chi2, class) AS rn FROM {{refine_}}) WHERE rn = 1 AND best_chi2 > 0),
        h AS (SELECT target_id, {HINT} AS hint FROM {{zhint}}),
        a AS (SELECT f.target_id, f.z, f.zerr, f.zwarn, f.class, f.chi2, co.class AS sc, co.best_chi2, co.z_scan, co.z_fit, co.reliable, co.reliable AND co.dv < 1000 AS confirms,
              f.class = co.class AS same, f.class = co.class AND f.chi2 <= co.best_chi2 AS improved, COALESCE(f.class = hint AND co.class <> hint, FALSE) AS override
              FROM {{zf_}} AS f JOIN co ON co.target_id = f.target_id LEFT JOIN h ON h.target_id = f.target_id WHERE f.znum = 0),
        b AS (SELECT *, CASE WHEN improved THEN z WHEN confirms THEN z_fit ELSE z_scan END AS z_ref,
              CASE WHEN same THEN FALSE WHEN (class = 'GALAXY' AND sc = 'QSO') OR (class = 'QSO' AND sc = 'GALAXY') THEN abs(z - z_scan) >= 0.01 WHEN override THEN FALSE ELSE TRUE END AS mismatch,
              chi2 / best_chi2 > CASE WHEN override THEN 4.5 ELSE 1.5 END AS too_bad, same AND NOT improved AND abs(z - z_scan) / (1 + z_scan) * 299792.458 > 3000 AS shifted FROM a)
        SELECT *, mismatch OR too_bad OR shifted AS trig,
        CASE WHEN confirms THEN 4194304 + 8388608 ELSE 0 END + CASE WHEN reliable THEN 0 ELSE 2097152 END AS base,
        CASE WHEN mismatch THEN 65536 ELSE 0 END + CASE WHEN too_bad THEN 131072 ELSE 0 END + CASE WHEN shifted THEN 262144 ELSE 0 END AS tb,
        CASE WHEN override THEN 16777216 ELSE 0 END + CASE WHEN improved THEN 33554432 ELSE 0 END AS ex FROM b""",
)


@query(
    "fallback_redshift",
    fix="z zerr chi2",
    sql="""WITH c AS (SELECT f.target_id, f.znum, f.z, f.zerr, f.zwarn, f.class, f.chi2, CASE WHEN f.zwarn & 65535 <= 2 THEN 0 ELSE 1 END AS tier,
              row_number() OVER (PARTITION BY f.target_id ORDER BY CASE WHEN f.zwarn & 65535 <= 2 THEN 0 ELSE 1 END, abs(f.z - d.z_ref) + CASE WHEN f.zwarn & 65535 = 0 THEN 0 ELSE 0.5 END, f.znum) AS rn
              FROM {zf_} AS f JOIN {dec_} AS d ON d.target_id = f.target_id WHERE d.trig AND f.class = d.sc
              AND (f.zwarn & 65535 <= 2 OR (d.mismatch AND NOT d.override AND ((f.zwarn & 65535) & ~1024) <= 2))),
           r AS (SELECT * FROM c WHERE rn = 1),
           x AS (SELECT f.*, d.target_id IS NOT NULL AS seen, d.trig, d.base, d.tb, d.ex, d.z AS z_0, d.zerr AS e_0, d.zwarn AS w_0, d.class AS c_0, d.chi2 AS x_0,
                 COALESCE(r.znum > 0, FALSE) AS swap, r.znum AS rk, r.z AS rz, r.zerr AS re, r.zwarn AS rw, r.class AS rc, r.chi2 AS rx, r.tier
                 FROM {zf_} AS f LEFT JOIN {dec_} AS d ON d.target_id = f.target_id LEFT JOIN r ON r.target_id = f.target_id)
           SELECT target_id, znum, CASE WHEN swap AND znum = 0 THEN rz WHEN swap AND znum = rk THEN z_0 ELSE z END AS z,
           CASE WHEN swap AND znum = 0 THEN re WHEN swap AND znum = rk THEN e_0 ELSE zerr END AS zerr,
           CASE WHEN swap AND znum = 0 THEN (rw & 65535) | (base + tb + 524288 + CASE WHEN tier = 1 THEN 67108864 ELSE 0 END) WHEN swap AND znum = rk THEN w_0 | (base + tb + ex)
             WHEN znum = 0 AND seen THEN w_0 | (base + tb + ex) | CASE WHEN trig THEN 1048576 ELSE 0 END ELSE zwarn END AS zwarn,
           CASE WHEN swap AND znum = 0 THEN rc WHEN swap AND znum = rk THEN c_0 ELSE class END AS class,
           CASE WHEN swap AND znum = 0 THEN rx WHEN swap AND znum = rk THEN x_0 ELSE chi2 END AS chi2 FROM x""",
)
def _(t):
    return cl.fallback_redshift(t.sql(ZFIT_NEAR), t.zscan, t.zhint)


@query(
    "target_availability",
    sql="""WITH s AS (SELECT s_suppkey AS target_id, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS vrad, CASE WHEN s_suppkey % 3 = 0 THEN 1 END AS teff FROM {supplier}),
           g AS (SELECT bin_id AS target_id, V_L1 AS v, abs(FLUX_L1) AS e FROM {line_wide} WHERE bin_id % 5 <> 0),
           a AS (SELECT t.target_id, vrad IS NOT NULL AS rvs, teff IS NOT NULL AS grid, v IS NOT NULL AS kin, COALESCE(e > 5000, FALSE) AS emi FROM {target} AS t
                 LEFT JOIN s ON s.target_id = t.target_id LEFT JOIN g ON g.target_id = t.target_id)
           SELECT *, CASE WHEN (rvs OR grid) AND (kin OR emi) THEN 'both' WHEN rvs OR grid THEN 'gal' WHEN kin OR emi THEN 'exgal' ELSE 'none' END AS results FROM a""",
)
def _(t):
    star = t.supplier.select(
        F.col("s_suppkey").alias("target_id"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal")).alias("vrad"), F.when(F.col("s_suppkey") % 3 == 0, 1).alias("teff")
    )
    galaxy = t.line_wide.where("bin_id % 5 <> 0").select(
        F.col("bin_id").alias("target_id"), F.col("V_L1").alias("v"), F.greatest(F.abs("FLUX_L1") - 5000, F.lit(0.0)).alias("emission_peak")
    )
    return cl.target_availability(t.target, star, galaxy)


GRID_FITS = """SELECT l_suppkey AS obj_id, CAST(l_linenumber AS INT) AS grid, CASE WHEN l_partkey % 19 = 0 THEN -1000e0 ELSE l_extendedprice / 1000e0 END AS chi2,
  4000e0 + l_partkey % 3000 AS teff, 3900e0 + 50e0 * l_linenumber AS teff_limit, l_orderkey AS fit_id FROM {lineitem}"""
shared("grids_", GRID_FITS)


@query(
    "best_grid",
    fix="chi2 teff",
    sql="""SELECT obj_id, grid, chi2, teff FROM (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY chi2, grid, teff) AS rn FROM {grids_}
           WHERE chi2 <> -1000 AND (grid = 1 OR teff > 1.01 * teff_limit)) WHERE rn = 1""",
)
def _(t):
    return cl.best_grid(t.sql(GRID_FITS).drop("fit_id")).select("obj_id", "grid", "chi2", "teff")


STARS = """SELECT p_partkey AS id, p_retailprice / 1000e0 AS chi2, p_size * 0.4e0 AS snr, p_partkey % 90 * 1e0 AS dchi2, p_partkey * 3.1e0 - 2000e0 AS vrad, p_partkey % 131 * 1e0 AS vrad_err,
  2000e0 + p_partkey * 7e0 AS teff, p_partkey % 50 / 10e0 - 4e0 AS feh, p_partkey % 72 / 10e0 - 0.55e0 AS logg, p_partkey % 25 * 1e0 AS vsini, CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END AS bad_hessian FROM {part}"""
shared("stars_", STARS)


@query(
    "stellar_flags",
    sql="""SELECT id, CASE WHEN chi2 < 1 AND snr > 5 THEN 1 ELSE 0 END AS flag, CASE WHEN dchi2 < 50 THEN 1 ELSE 0 END + CASE WHEN vrad < -1495 OR vrad > 1495 THEN 2 ELSE 0 END
           + CASE WHEN vrad_err > 100 THEN 4 ELSE 0 END + CASE WHEN teff < 2310 OR teff > 14990 OR feh < -3.99 OR feh > 0.99 OR logg < -0.49 OR logg > 6.49 THEN 8 ELSE 0 END
           + CASE WHEN vsini > 20 THEN 16 ELSE 0 END + CASE WHEN bad_hessian = 1 THEN 64 ELSE 0 END AS warn FROM {stars_}""",
)
def _(t):
    return cl.stellar_flags(t.sql(STARS)).select("id", "flag", "warn")
