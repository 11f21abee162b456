"""Queries on pixels and spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import ranges as rg
from lumenframe.operators import spectra as sp
from lumenframe.plans.registry import query, shared

TELLURIC = [(4095.0, 4112.0), (4388.0, 4401.0)]
IN_TELLURIC = "(wave BETWEEN 4095 AND 4112 OR wave BETWEEN 4388 AND 4401)"
W = "PARTITION BY spec_id, arm ORDER BY pix"
ALL = "PARTITION BY spec_id, arm"


@query("spectra_to_pixels", fix="v", sql="SELECT vec_id, label, CAST(pix AS INT) AS pix, v FROM {px0} JOIN {embeddings} USING (vec_id)")
def _(t):
    return sp.spectra_to_pixels(t.embeddings, ["embedding"]).withColumnRenamed("embedding", "v")


@query(
    "pixels_to_spectra",
    fix="first_flux last_flux tenth_ivar",
    sql="""SELECT spec_id, arm, count(*) AS n, max(flux) FILTER (pix = lo) AS first_flux, max(flux) FILTER (pix = hi) AS last_flux,
           max(ivar) FILTER (pix = lo + 9) AS tenth_ivar
           FROM (SELECT *, min(pix) OVER (PARTITION BY spec_id, arm) AS lo, max(pix) OVER (PARTITION BY spec_id, arm) AS hi FROM {pixel})
           GROUP BY spec_id, arm""",
)
def _(t):
    s = sp.pixels_to_spectra(t.pixel, ["flux", "ivar"])
    return s.select(
        "spec_id", "arm", F.size("flux").alias("n"), F.get("flux", F.lit(0)).alias("first_flux"),
        F.get("flux", F.size("flux") - 1).alias("last_flux"), F.get("ivar", F.lit(9)).alias("tenth_ivar"),
    )


shared("valid", "SELECT spec_id, arm, pix, wave, flux, CASE WHEN flux IS NULL OR ivar IS NULL OR ivar < 0 THEN 0 ELSE ivar END AS ivar FROM {pixel}")
shared(
    "grown1",
    f"SELECT spec_id, arm, pix, wave, flux, CASE WHEN bool_or(ivar = 0) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) THEN 0 ELSE ivar END AS ivar FROM {{valid}}",
)


@query("mask_invalid", fix="flux ivar", sql="SELECT * FROM {valid}")
def _(t):
    return sp.mask_invalid(t.pixel)


@query("dilate_mask", fix="flux ivar", sql="SELECT * FROM {grown1}")
def _(t):
    return sp.dilate_mask(sp.mask_invalid(t.pixel), k=1)


@query(
    "mask_edges",
    fix="flux ivar",
    sql=f"""SELECT spec_id, arm, pix, wave, flux, CASE WHEN pix < min(pix) OVER ({ALL}) + 5 OR pix > max(pix) OVER ({ALL}) - 5
            THEN 0 ELSE ivar END AS ivar FROM {{pixel}}""",
)
def _(t):
    return sp.mask_edges(t.pixel, n=5)


shared(
    "spike",
    f"""SELECT *, COALESCE(abs(flux - CASE WHEN pa IS NULL OR pc IS NULL OR a IS NULL OR c IS NULL OR flux IS NULL THEN flux
          ELSE list_sort([a, flux, c])[2] END) * sqrt(med) > 2.5, FALSE) AS spike
        FROM (SELECT *, lag(flux) OVER ({W}) AS a, lead(flux) OVER ({W}) AS c, lag(pix) OVER ({W}) AS pa, lead(pix) OVER ({W}) AS pc,
              median(ivar) OVER ({ALL}) AS med FROM {{valid}})""",
)


@query(
    "cosmic_ray_mask",
    fix="flux ivar",
    sql=f"""SELECT spec_id, arm, pix, wave, flux,
            CASE WHEN bool_or(spike) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) THEN 0 ELSE ivar END AS ivar FROM {{spike}}""",
)
def _(t):
    return sp.cosmic_ray_mask(sp.mask_invalid(t.pixel), cut=2.5, wing=1)


def filled_sql(src: str, good: str) -> str:
    return f"""SELECT spec_id, arm, pix, wave, ivar, CASE WHEN ({good}) AND flux IS NOT NULL THEN flux
            WHEN w0 IS NULL AND w1 IS NULL THEN flux WHEN w0 IS NULL THEN f1 WHEN w1 IS NULL THEN f0
            ELSE f0 + (f1 - f0) * (wave - w0) / (w1 - w0) END AS flux FROM (
            SELECT *, last_value(CASE WHEN ({good}) AND flux IS NOT NULL THEN wave END IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w0,
            last_value(CASE WHEN ({good}) THEN flux END IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f0,
            first_value(CASE WHEN ({good}) AND flux IS NOT NULL THEN wave END IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w1,
            first_value(CASE WHEN ({good}) THEN flux END IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f1
            FROM {src})"""


shared("filled", filled_sql("{valid}", "ivar > 0"))


@query("fill_gaps", fix="flux ivar", sql="SELECT * FROM {filled}")
def _(t):
    return sp.fill_gaps(sp.mask_invalid(t.pixel))


@query(
    "gap_islands",
    sql=f"""WITH f AS (SELECT *, min(pix) OVER ({ALL}) AS lo, max(pix) OVER ({ALL}) AS hi FROM {{grown1}}),
            r AS (SELECT *, pix - row_number() OVER ({W}) AS run FROM f WHERE ivar = 0),
            g AS (SELECT spec_id, arm, min(pix) AS first_pix, max(pix) AS last_pix, count(*) AS length,
                  min(pix) > min(lo) AND max(pix) < max(hi) AS interior FROM r GROUP BY spec_id, arm, run)
            SELECT *, interior AND row_number() OVER (PARTITION BY spec_id, arm, interior ORDER BY length DESC, first_pix) = 1 AS detector_gap FROM g""",
)
def _(t):
    return sp.gap_islands(sp.dilate_mask(sp.mask_invalid(t.pixel), k=1))


def mean_sql(x: str, size: int) -> str:
    """Mean over a clamped index range, written as a self-contained list expression."""
    h = size // 2
    return (
        f"(SELECT avg(({x})[greatest(1, least(len({x}), i + o))]) FROM (SELECT unnest(range(-{h}, {h} + 1)) AS o))"
    )


shared(
    "flist",
    """SELECT spec_id, arm, list(COALESCE(flux, 0) ORDER BY pix) AS f, list(ivar ORDER BY pix) AS v, list(pix ORDER BY pix) AS p
       FROM {filled} GROUP BY spec_id, arm""",
)
shared("fpos", "SELECT *, unnest(range(1, len(f) + 1)) AS i FROM {flist}")


def clamp_mean(col: str, size: int, src: str) -> str:
    h = size // 2
    return f"""SELECT q.spec_id, q.arm, q.i, avg(q.{col}[greatest(1, least(len(q.{col}), q.i + o.o))]) AS m
               FROM {src} AS q, (SELECT unnest(range(-{h}, {h} + 1)) AS o) AS o GROUP BY q.spec_id, q.arm, q.i"""


shared("mean9", clamp_mean("f", 9, "{fpos}"))
shared("ivmean5", clamp_mean("v", 5, "{fpos}"))


@query("continuum_subtract", fix="continuum resid", sql="SELECT spec_id, arm, p[i] AS pix, m AS continuum, f[i] - m AS resid FROM {mean9} JOIN {fpos} USING (spec_id, arm, i)")
def _(t):
    px = sp.fill_gaps(sp.mask_invalid(t.pixel))
    return sp.continuum_subtract(px, window=9).select("spec_id", "arm", "pix", "continuum", "resid")


shared("r1", "SELECT spec_id, arm, i, f[i] AS y, f[i] - m AS resid FROM {mean9} JOIN {fpos} USING (spec_id, arm, i)")
shared("r1d", "SELECT *, abs(resid - median(resid) OVER (PARTITION BY spec_id, arm)) AS dev FROM {r1}")
shared(
    "r1m",
    """SELECT spec_id, arm, list(y ORDER BY i) AS f, list(k ORDER BY i) AS k FROM (
       SELECT *, CASE WHEN dev < 4 * (1.4826 * median(dev) OVER (PARTITION BY spec_id, arm) + 1e-6) THEN 1e0 ELSE 0e0 END AS k FROM {r1d})
       GROUP BY spec_id, arm""",
)


@query(
    "continuum_robust",
    fix="continuum resid",
    sql="""WITH pos AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM {r1m}),
           c AS (SELECT spec_id, arm, i, any_value(f[i]) AS y, sum(f[j] * k[j]) AS num, sum(k[j]) AS den FROM (
                 SELECT q.*, greatest(1, least(len(f), i + o)) AS j FROM pos AS q, (SELECT unnest(range(-4, 5)) AS o) AS o) GROUP BY spec_id, arm, i),
           d AS (SELECT spec_id, arm, i, y, CASE WHEN den > 0 THEN num / den ELSE 0 END AS continuum FROM c)
           SELECT d.spec_id, d.arm, p[d.i] AS pix, continuum, y - continuum AS resid FROM d JOIN {flist} AS l ON d.spec_id = l.spec_id AND d.arm = l.arm""",
)
def _(t):
    px = sp.fill_gaps(sp.mask_invalid(t.pixel))
    return sp.continuum_robust(px, window=9).select("spec_id", "arm", "pix", "continuum", "resid")


@query("despike_ivar", fix="ivar", sql="SELECT spec_id, arm, p[i] AS pix, least(v[i], 1.1 * m) AS ivar FROM {ivmean5} JOIN {fpos} USING (spec_id, arm, i)")
def _(t):
    return sp.despike_ivar(sp.mask_invalid(t.pixel), cap=1.1).select("spec_id", "arm", "pix", "ivar")


VALLEY = {"pixel_scale": 350 / 36, "start": 4030.0, "min_narrow": 3, "min_wide": 5, "threshold": 0.95, "wing": 1}
VALLEY_SQL = f"""WITH red AS (SELECT *, ivar AS keep FROM {{valid}} WHERE wave >= 4030),
            src AS (SELECT spec_id, arm, pix, pix AS wave, keep AS ivar, keep AS flux FROM red),
            fil AS ({filled_sql("src", "ivar > 0")}),
            l AS (SELECT spec_id, arm, list(flux ORDER BY pix) AS f, list(pix ORDER BY pix) AS p, list(ivar ORDER BY pix) AS v FROM fil GROUP BY spec_id, arm),
            pos AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM l),
            n AS ({clamp_mean("f", 5, "pos")}), w AS ({clamp_mean("f", 31, "pos")}),
            bg AS (SELECT pos.spec_id, pos.arm, p[pos.i] AS pix, v[pos.i] AS ivar, greatest(n.m, w.m) AS bg, len(f) AS cnt FROM pos
                   JOIN n ON pos.spec_id = n.spec_id AND pos.arm = n.arm AND pos.i = n.i
                   JOIN w ON pos.spec_id = w.spec_id AND pos.arm = w.arm AND pos.i = w.i),
            m AS (SELECT *, bool_or(ivar > 0 AND bg > 1e-10 AND ivar < 0.95 * bg AND cnt >= 31) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS bad FROM bg)
            SELECT v.spec_id, v.arm, v.pix, v.wave, v.flux, CASE WHEN m.bad THEN 0 ELSE v.ivar END AS ivar
            FROM {{valid}} AS v LEFT JOIN m ON v.spec_id = m.spec_id AND v.arm = m.arm AND v.pix = m.pix"""


@query("sky_valley_mask", fix="flux ivar", sql=VALLEY_SQL)
def _(t):
    return sp.sky_valley_mask(sp.mask_invalid(t.pixel), **VALLEY)


@query(
    "clean_spectra_tail",
    fix="flux ivar snr ivar_weight",
    sql=f"""WITH v AS ({VALLEY_SQL}),
            s AS (SELECT arm, sum(ivar) FILTER (ivar > 0) AS s FROM v GROUP BY arm), w AS (SELECT arm, avg(s) OVER () / s AS ivar_weight FROM s),
            n AS (SELECT spec_id, arm, pix, CASE WHEN 2 * count(*) FILTER (ivar > 0) OVER ({ALL}) >= count(*) OVER ({ALL})
                  THEN avg(flux * sqrt(ivar)) FILTER (ivar > 0) OVER ({ALL}) END AS snr FROM {{valid}})
            SELECT spec_id, arm, pix, wave, flux, ivar * ivar_weight AS ivar, snr, ivar_weight FROM v JOIN w USING (arm) JOIN n USING (spec_id, arm, pix)""",
)
def _(t):
    out = sp.clean_spectra(t.pixel, fill=False, cosmic=False, valley=VALLEY, balance="balanced")
    return out.select("spec_id", "arm", "pix", "wave", "flux", "ivar", "snr", "ivar_weight")


@query(
    "broaden_variable",
    fix="flux",
    sql="""WITH s AS (SELECT *, 0.5 + ((p[i] + 1) % 5) * 0.3 AS sg FROM {fpos}),
           k AS (SELECT s.*, unnest(range(-CAST(floor(4 * sg) AS BIGINT), CAST(floor(4 * sg) AS BIGINT) + 1)) AS o FROM s)
           SELECT spec_id, arm, any_value(p[i]) AS pix, sum(exp(-0.5 * (o / sg) * (o / sg)) * f[greatest(1, least(len(f), i + o))]) / sum(exp(-0.5 * (o / sg) * (o / sg))) AS flux
           FROM k GROUP BY spec_id, arm, i""",
)
def _(t):
    px = sp.fill_gaps(sp.mask_invalid(t.pixel)).withColumn("sigma", 0.5 + ((F.col("pix") + 1) % 5) * 0.3)
    first = px.groupBy("spec_id", "arm").agg(F.min("pix").alias("first"))
    out = sp.broaden_variable(sp.pixels_to_spectra(px, ["flux", "sigma"], keys=["spec_id", "arm"])).join(first, ["spec_id", "arm"])
    out = sp.spectra_to_pixels(out.select("spec_id", "arm", "first", "flux"), ["flux"])
    return out.select("spec_id", "arm", (F.col("pix") + F.col("first")).alias("pix"), "flux")


@query("spectrum_snr", fix="snr", sql="SELECT spec_id, arm, snr, CAST(n_good AS BIGINT) AS n_good FROM {arm_meta}")
def _(t):
    return sp.spectrum_snr(t.pixel)


@query(
    "signal_noise",
    fix="signal noise snr",
    sql="""SELECT *, signal / noise AS snr FROM (SELECT spec_id, avg(flux) AS signal, sqrt(avg(1 / ivar)) AS noise
           FROM {pixel} WHERE ivar > 0 AND flux IS NOT NULL GROUP BY spec_id)""",
)
def _(t):
    return sp.signal_noise(t.pixel)


@query(
    "coadd_ivar",
    fix="wave ivar flux snr",
    sql="""WITH c AS (SELECT grp, arm, pix, avg(wave) AS wave, sum(ivar) AS ivar,
                CASE WHEN sum(ivar) <> 0 THEN sum(COALESCE(flux, 0) * ivar) / sum(ivar) ELSE 0 END AS flux
                FROM {grown1} JOIN {spec_class} USING (spec_id) GROUP BY grp, arm, pix)
           SELECT *, CASE WHEN 2 * sum(CASE WHEN ivar > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY grp, arm) >= count(*) OVER (PARTITION BY grp, arm)
                     THEN avg(CASE WHEN ivar > 0 THEN flux * sqrt(ivar) END) OVER (PARTITION BY grp, arm) END AS snr FROM c""",
)
def _(t):
    stack = sp.coadd_ivar(sp.dilate_mask(sp.mask_invalid(t.pixel), k=1), t.spec_class)
    return sp.with_snr(stack, keys=["grp", "arm"])


@query(
    "ivar_balance",
    fix="ivar ivar_weight",
    sql="""WITH s AS (SELECT arm, sum(ivar) FILTER (ivar > 0) AS s, count(*) FILTER (ivar > 0) AS n FROM {pixel} GROUP BY arm),
           w AS (SELECT arm, sqrt(avg(s) OVER () / s * (avg(s / n) OVER () * n / s)) AS ivar_weight FROM s)
           SELECT spec_id, arm, pix, ivar * ivar_weight AS ivar, ivar_weight FROM {pixel} JOIN w USING (arm)""",
)
def _(t):
    return sp.ivar_balance(t.pixel, mode="hybrid").select("spec_id", "arm", "pix", "ivar", "ivar_weight")


# Red fluxes with a spread of scales and a few outliers.
SCALED = """SELECT spec_id, arm, pix, wave, ivar, CASE WHEN arm = 'RED'
  THEN flux * (1e0 + (spec_id % 13) / 100e0 + CASE WHEN spec_id % 50 = 0 THEN 0.5e0 ELSE 0e0 END) ELSE flux END AS flux FROM {pixel}"""
shared("scaled_", SCALED)


@query(
    "arms_ratio",
    fix="median sigma",
    sql="""WITH m AS (SELECT spec_id FROM {arm_meta} GROUP BY spec_id HAVING min(snr) >= 5 AND count(snr) = 2),
           p AS (SELECT spec_id, sum(flux * ivar) FILTER (arm = 'BLUE') / sum(ivar) FILTER (arm = 'BLUE') AS fb,
                 sum(flux * ivar) FILTER (arm = 'RED') / sum(ivar) FILTER (arm = 'RED') AS fr,
                 count(*) FILTER (arm = 'BLUE') AS nb, count(*) FILTER (arm = 'RED') AS nr
                 FROM {scaled_} WHERE wave BETWEEN 4280 AND 4350 AND ivar > 0 AND flux IS NOT NULL GROUP BY spec_id),
           r0 AS (SELECT spec_id // 50 AS obs, fb / fr AS x FROM p JOIN m USING (spec_id) WHERE least(nb, nr) >= 5 AND fb > 0 AND fr > 0 AND fb / fr BETWEEN 0.3 AND 10),
           r1 AS (SELECT r0.obs, x FROM r0 JOIN (SELECT obs, median(x) AS m, stddev_pop(x) AS s FROM r0 GROUP BY obs) AS q ON q.obs = r0.obs WHERE abs(x - m) <= 3 * s),
           r2 AS (SELECT r1.obs, x FROM r1 JOIN (SELECT obs, median(x) AS m, stddev_pop(x) AS s FROM r1 GROUP BY obs) AS q ON q.obs = r1.obs WHERE abs(x - m) <= 3 * s),
           r3 AS (SELECT r2.obs, x FROM r2 JOIN (SELECT obs, median(x) AS m, stddev_pop(x) AS s FROM r2 GROUP BY obs) AS q ON q.obs = r2.obs WHERE abs(x - m) <= 3 * s)
           SELECT obs, median(x) AS median, stddev_pop(x) AS sigma, count(*) AS n, any_value(n_all) AS n_all,
           CASE WHEN stddev_pop(x) < 0.02 THEN 'excellent' WHEN stddev_pop(x) < 0.04 THEN 'good' WHEN stddev_pop(x) < 0.06 THEN 'fair' ELSE 'poor' END AS quality
           FROM r3 JOIN (SELECT obs, count(*) AS n_all FROM r0 GROUP BY obs) AS a USING (obs) GROUP BY obs""",
)
def _(t):
    px = t.sql(SCALED).withColumn("obs", F.floor(F.col("spec_id") / 50))
    return sp.arms_ratio(px, t.arm_meta, trim=0.0, keys=["obs"])


@query(
    "apply_sensitivity",
    fix="flux ivar",
    sql="""SELECT spec_id, arm, pix, CASE WHEN pix % 29 = 0 THEN NULL ELSE flux * (1 + pix / 100.0) END AS flux,
           CASE WHEN pix % 29 = 0 THEN 0 ELSE ivar / ((1 + pix / 100.0) * (1 + pix / 100.0)) END AS ivar FROM {pixel}""",
)
def _(t):
    sens = t.pixel.select("arm", "pix").distinct().withColumn("sens", F.when(F.col("pix") % 29 != 0, 1 + F.col("pix") / 100.0))
    return sp.apply_sensitivity(t.pixel, sens).select("spec_id", "arm", "pix", "flux", "ivar")


@query(
    "apply_arms_ratio",
    fix="flux ivar",
    sql="""SELECT spec_id, arm, pix, flux * CASE WHEN arm = 'RED' THEN 1.11 ELSE 1 END AS flux,
           ivar / CASE WHEN arm = 'RED' THEN 1.11 * 1.11 ELSE 1 END AS ivar FROM {pixel}""",
)
def _(t):
    return sp.apply_arms_ratio(t.pixel, {"RED": 1.11}).select("spec_id", "arm", "pix", "flux", "ivar")


@query(
    "deredden",
    fix="flux ivar",
    sql="""WITH tr AS (SELECT spec_id, arm, pix, flux, ivar, CASE WHEN spec_id % 10 = 0 THEN NULL ELSE
             exp(-(1 + spec_id % 5) / 50e0) + (wave - 4000) / 630e0 * 0.1 END AS t FROM {pixel})
           SELECT spec_id, arm, pix, CASE WHEN t IS NULL THEN flux ELSE flux / t END AS flux, CASE WHEN t IS NULL THEN ivar ELSE ivar * t * t END AS ivar FROM tr""",
)
def _(t):
    steps = F.explode(F.array(*[F.lit(4000.0 + 63.0 * i) for i in range(11)])).alias("wave")
    tr = t.embeddings.where("vec_id % 10 <> 0").select(F.col("vec_id").alias("spec_id"), steps)
    tr = tr.withColumn("t", F.exp(-(1 + F.col("spec_id") % 5) / 50.0) + (F.col("wave") - 4000) / 630 * 0.1)
    return sp.deredden(t.pixel, tr, step=63.0).select("spec_id", "arm", "pix", "flux", "ivar")


@query("to_rest_frame", fix="wave", sql="SELECT spec_id, arm, pix, wave / (1 + grp / 100e0) AS wave FROM {pixel} JOIN {spec_class} USING (spec_id)")
def _(t):
    z = t.spec_class.select("spec_id", (F.col("grp") / 100.0).alias("z"))
    return sp.to_rest_frame(t.pixel, z).select("spec_id", "arm", "pix", "wave")


@query(
    "line_mask_pixels",
    sql="""WITH p AS (SELECT spec_id, arm, pix, ivar, grp / 1000e0 AS z, 2 + (spec_id % 5) * 0.1 AS lsf FROM {pixel} JOIN {spec_class} USING (spec_id)),
           l(name, w, b) AS (VALUES ('Hd', 4101.7, 5.0), ('sky1', 4210.0, 3.0), ('telluric2', 4320.0, 4.0)),
           c AS (SELECT spec_id, arm, pix, bool_or(pix BETWEEN mid - reach AND mid + reach) AS hit FROM (
             SELECT *, ceil((ln(cw) - ln(4000)) / 0.0024) AS mid, 3 * sqrt(b * b + lsf * lsf) * 2.5 / 2.355 / cw / 0.0024 AS reach FROM (
             SELECT *, CASE WHEN name LIKE '%sky%' OR name LIKE '%telluric%' THEN w / (1 + z) ELSE w END AS cw FROM p, l)) GROUP BY spec_id, arm, pix)
           SELECT p.spec_id, p.arm, p.pix FROM p JOIN c ON p.spec_id = c.spec_id AND p.arm = c.arm AND p.pix = c.pix WHERE NOT hit AND ivar > 0 AND 1 / sqrt(ivar) < 0.95 * sqrt(0.041)""",
)
def _(t):
    import math

    px = t.pixel.join(t.spec_class, "spec_id").withColumn("z", F.col("grp") / 1000.0)
    lines = [("Hd", 4101.7, 5.0), ("sky1", 4210.0, 3.0), ("telluric2", 4320.0, 4.0)]
    out = sp.line_mask_pixels(px, lines, lsf=2 + (F.col("spec_id") % 5) * 0.1, log_start=math.log(4000.0), log_step=0.0024, error_limit=0.041)
    return out.select("spec_id", "arm", "pix")


@query(
    "broadening_needed",
    fix="sigma_pix",
    sql="""WITH p AS (SELECT spec_id, arm, pix, sqrt(power(2 + (spec_id % 5) * 0.5, 2) + power((50 + spec_id % 400) * wave / 299792.458 * 2.355, 2)) AS total
                 FROM {pixel}),
           q AS (SELECT *, max(total) OVER (PARTITION BY spec_id, arm) AS mx FROM p),
           r AS (SELECT *, sqrt(greatest(power(CASE WHEN mx > 8.4 THEN ceil(mx * 1.1) ELSE 8.4 END, 2) - total * total, 0)) / 2.355 / 0.02 AS sigma_pix FROM q)
           SELECT spec_id, arm, pix, sigma_pix, CASE WHEN max(sigma_pix) OVER (PARTITION BY spec_id, arm) > 100 THEN 2 WHEN mx > 8.4 THEN 1 ELSE 0 END AS flag FROM r""",
)
def _(t):
    px = t.pixel.withColumns({"lsf": 2 + (F.col("spec_id") % 5) * 0.5, "sigma_v": 50.0 + F.col("spec_id") % 400})
    return sp.broadening_needed(px, target=8.4, step=0.02, adaptive=True, keys=("spec_id", "arm")).select("spec_id", "arm", "pix", "sigma_pix", "flag")


shared("bo", "SELECT spec_id, pix, wave, flux, ivar FROM {filled} WHERE arm = 'BLUE'")
shared("ro", "SELECT spec_id, pix, wave, flux, ivar FROM {filled} WHERE arm = 'RED'")
shared(
    "joined",
    """WITH o AS (SELECT b.spec_id, b.wave, b.flux AS fb, r.flux AS fr, CASE WHEN b.ivar = 0 THEN 1e-36 ELSE b.ivar END AS vb,
         CASE WHEN r.ivar = 0 THEN 1e-36 ELSE r.ivar END AS vr FROM {bo} AS b JOIN {ro} AS r ON b.spec_id = r.spec_id AND b.pix = r.pix),
       d AS (SELECT *, abs(mb - mr) / greatest(mb, mr, 1e-10) > 0.15 AS bad FROM (
         SELECT *, median(fb) OVER (PARTITION BY spec_id) AS mb, median(fr) OVER (PARTITION BY spec_id) AS mr FROM o)),
       u AS (SELECT spec_id, wave, CASE WHEN bad THEN 0 ELSE (fb * vb + fr * vr) / (vb + vr) END AS flux, CASE WHEN bad THEN 0 ELSE vb + vr END AS ivar, bad FROM d
         UNION ALL SELECT spec_id, wave, flux, ivar, FALSE FROM {bo} WHERE pix < 28
         UNION ALL SELECT spec_id, wave, flux, ivar, FALSE FROM {ro} WHERE pix >= 36)
       SELECT spec_id, wave, flux, CASE WHEN wave BETWEEN 4100 AND 4500 AND bool_or(bad) OVER (PARTITION BY spec_id) THEN 0 ELSE ivar END AS ivar,
       row_number() OVER (PARTITION BY spec_id ORDER BY wave) - 1 AS pix FROM u""",
)


@query("join_arms", fix="wave flux ivar", sql="SELECT * FROM {joined}")
def _(t):
    px = sp.fill_gaps(sp.mask_invalid(t.pixel))
    return sp.join_arms(px, order=["BLUE", "RED"], max_jump=0.15, bad_mask=(4100.0, 4500.0))


shared(
    "split_",
    """WITH o AS (SELECT b.spec_id, b.wave, b.flux AS fb, r.flux AS fr, CASE WHEN b.ivar = 0 THEN 1e-36 ELSE b.ivar END AS vb,
         CASE WHEN r.ivar = 0 THEN 1e-36 ELSE r.ivar END AS vr FROM {bo} AS b JOIN {ro} AS r ON b.spec_id = r.spec_id AND b.pix = r.pix),
       d AS (SELECT *, abs(mb - mr) / greatest(mb, mr, 1e-10) > 0.15 AS bad FROM (
         SELECT *, median(fb) OVER (PARTITION BY spec_id) AS mb, median(fr) OVER (PARTITION BY spec_id) AS mr FROM o)),
       u AS (SELECT spec_id, wave, CASE WHEN bad THEN 0 ELSE (fb * vb + fr * vr) / (vb + vr) END AS flux, CASE WHEN bad THEN 0 ELSE vb + vr END AS ivar, bad FROM d
         UNION ALL SELECT spec_id, wave, flux, ivar, FALSE FROM {bo} WHERE pix < 28
         UNION ALL SELECT spec_id, wave, flux, ivar, FALSE FROM {ro} WHERE pix >= 36),
       m AS (SELECT spec_id, CASE WHEN u.wave < mid THEN 'BLUE' ELSE 'RED' END AS arm, wave, flux,
         CASE WHEN wave BETWEEN 4100 AND 4500 AND bool_or(bad) OVER (PARTITION BY spec_id) THEN 0 ELSE ivar END AS ivar
         FROM u JOIN (SELECT spec_id, avg(wave) AS mid FROM o GROUP BY spec_id) AS c USING (spec_id))
       SELECT *, row_number() OVER (PARTITION BY spec_id, arm ORDER BY wave) - 1 AS pix FROM m""",
)


@query("join_arms_split", fix="wave flux ivar", sql="SELECT * FROM {split_}")
def _(t):
    px = sp.fill_gaps(sp.mask_invalid(t.pixel))
    return sp.join_arms(px, order=["BLUE", "RED"], max_jump=0.15, bad_mask=(4100.0, 4500.0), split=True)


shared("crop_", "SELECT * FROM {valid} WHERE wave >= 4010 AND wave < 4620")
shared("cut1_", f"SELECT spec_id, arm, pix, wave, flux, CASE WHEN bool_or(ivar = 0) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) THEN 0 ELSE ivar END AS ivar FROM {{crop_}}")
shared(
    "cut2_",
    f"""SELECT spec_id, arm, pix, wave, flux, CASE WHEN {IN_TELLURIC} OR pix < min(pix) OVER ({ALL}) + 2 OR pix > max(pix) OVER ({ALL}) - 2
        THEN 0 ELSE ivar END AS ivar FROM {{cut1_}}""",
)
shared("cut3_", filled_sql("{cut2_}", "ivar > 0"))
shared(
    "cut4_",
    f"""SELECT *, COALESCE(abs(flux - CASE WHEN pa IS NULL OR pc IS NULL OR a IS NULL OR c IS NULL OR flux IS NULL THEN flux
        ELSE list_sort([a, flux, c])[2] END) * sqrt(med) > 2.5, FALSE) AS spike
        FROM (SELECT *, lag(flux) OVER ({W}) AS a, lead(flux) OVER ({W}) AS c, lag(pix) OVER ({W}) AS pa, lead(pix) OVER ({W}) AS pc,
        median(ivar) OVER ({ALL}) AS med FROM {{cut3_}})""",
)


@query(
    "clean_spectra",
    fix="wave flux ivar snr",
    sql=f"""WITH c AS (SELECT spec_id, arm, pix, wave, flux, CASE WHEN bool_or(spike) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) THEN 0 ELSE ivar END AS ivar FROM {{cut4_}}),
            s AS (SELECT spec_id, arm, pix, wave, flux * (1 + pix / 100.0) * CASE WHEN arm = 'RED' THEN 1.11 ELSE 1 END AS flux,
                  ivar / power((1 + pix / 100.0) * CASE WHEN arm = 'RED' THEN 1.11 ELSE 1 END, 2) AS ivar FROM c)
            SELECT *, CASE WHEN 2 * count(*) FILTER (ivar > 0) OVER ({ALL}) >= count(*) OVER ({ALL})
                THEN avg(flux * sqrt(ivar)) FILTER (ivar > 0) OVER ({ALL}) END AS snr FROM s""",
)
def _(t):
    sens = t.pixel.select("arm", "pix").distinct().withColumn("sens", 1 + F.col("pix") / 100.0)
    crop = {"BLUE": (4010.0, 4620.0), "RED": (4010.0, 4620.0)}
    import lumenframe.operators.spectra as ops

    px = ops.clean_spectra(t.pixel, crop=crop, gap_wing=1, edge=2, tellurics=TELLURIC, fill=True, cosmic=False)
    px = ops.cosmic_ray_mask(px.drop("snr"), cut=2.5)
    return ops.clean_spectra(px, fill=False, cosmic=False, sens=sens, ratios={"RED": 1.11}).select("spec_id", "arm", "pix", "wave", "flux", "ivar", "snr")


@query(
    "interp_at",
    fix="value",
    sql="""SELECT p.spec_id, p.arm, p.pix, a.value + (b.value - a.value) * (p.wave + 3.7 - a.wave) / 30 AS value
           FROM (SELECT spec_id, arm, pix, wave, spec_id % 100 AS nspec FROM {pixel}) AS p
           LEFT JOIN {curve} AS a ON a.nspec = p.nspec AND a.wave = 4000 + 30 * floor((p.wave + 3.7 - 4000) / 30)
           LEFT JOIN {curve} AS b ON b.nspec = p.nspec AND b.wave = a.wave + 30""",
)
def _(t):
    asked = t.pixel.select("spec_id", "arm", "pix", (F.col("wave") + 3.7).alias("x"), (F.col("spec_id") % 100).alias("curve_id"))
    curves = t.curve.select(F.col("nspec").alias("curve_id"), "wave", "value")
    return rg.interp_at(asked, curves, x="x", step=30.0).select("spec_id", "arm", "pix", "value")


@query(
    "interp_sorted",
    fix="value",
    sql="""WITH c AS (SELECT nspec, wave, value FROM {curve} WHERE CAST(wave AS BIGINT) // 30 % 7 <> nspec % 7),
           p AS (SELECT spec_id, arm, pix, wave + 3.7 AS x, spec_id % 100 AS nspec FROM {pixel}),
           lo AS (SELECT p.*, c.wave AS w0, c.value AS v0 FROM p ASOF LEFT JOIN c ON c.nspec = p.nspec AND p.x >= c.wave),
           hi AS (SELECT lo.*, c.wave AS w1, c.value AS v1 FROM lo ASOF LEFT JOIN c ON c.nspec = lo.nspec AND lo.x < c.wave)
           SELECT spec_id, arm, pix, coalesce(v0 + (v1 - v0) * (x - w0) / (w1 - w0), v0, v1) AS value FROM hi""",
)
def _(t):
    asked = t.pixel.select("spec_id", "arm", "pix", (F.col("wave") + 3.7).alias("x"), (F.col("spec_id") % 100).alias("curve_id"))
    gaps = t.curve.where(F.floor(F.col("wave") / 30) % 7 != F.col("nspec") % 7).select(F.col("nspec").alias("curve_id"), "wave", "value")
    return rg.interp_at(asked, gaps, x="x", clamp=True).select("spec_id", "arm", "pix", "value")


@query(
    "band_join",
    sql="""SELECT spec_id, arm, pix, lo AS band FROM {pixel}
           JOIN (VALUES (4095e0, 4112e0), (4388e0, 4401e0), (4600e0, 4700e0), (4100e0, 4350e0)) AS b(lo, hi) ON wave BETWEEN lo AND hi""",
)
def _(t):
    bands = t.spark.createDataFrame([(4095.0, 4112.0), (4388.0, 4401.0), (4600.0, 4700.0), (4100.0, 4350.0)], "lo double, hi double")
    return rg.band_join(t.pixel, bands).select("spec_id", "arm", "pix", F.col("lo").alias("band"))


@query(
    "overlap_rebin",
    fix="wave flux",
    sql="""WITH o AS (SELECT spec_id, arm, ln(4000) + pix * 0.0024 AS logw, COALESCE(flux, 0) AS flux FROM {pixel}),
           e AS (SELECT spec_id, arm, count(*) AS n, min(logw) - 0.0012 AS a, max(logw) + 0.0012 AS b FROM o GROUP BY spec_id, arm),
           g AS (SELECT *, unnest(range(n)) AS j FROM e),
           w AS (SELECT spec_id, arm, j, n, exp(a) + (exp(b) - exp(a)) * (j + 0.5) / n AS wave, ln(exp(a) + (exp(b) - exp(a)) * j / n) AS lo,
                 ln(exp(a) + (exp(b) - exp(a)) * (j + 1) / n) AS hi, (b - a) / n AS mw FROM g)
           SELECT w.spec_id, w.arm, CAST(j AS INT) AS new_pix, any_value(wave) AS wave, CASE WHEN j = any_value(n) - 1 THEN 0 ELSE
             sum(flux * greatest(0, least(hi, logw + 0.0012) - greatest(lo, logw - 0.0012)) / 0.0024) / any_value(hi - lo) * any_value(mw) END AS flux
           FROM w JOIN o ON w.spec_id = o.spec_id AND w.arm = o.arm AND logw + 0.0012 > lo AND logw - 0.0012 < hi GROUP BY w.spec_id, w.arm, j""",
)
def _(t):
    import math

    px = t.pixel.withColumn("logw", math.log(4000.0) + F.col("pix") * 0.0024)
    return rg.log_to_linear(px, keys=["spec_id", "arm"])
