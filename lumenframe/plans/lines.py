"""Queries on indices and emission lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import lines as ln
from lumenframe.operators import spectra as sp
from lumenframe.plans.registry import query, shared

BANDS = [
    ("A", 4105.0, 4165.0, 4175.0, 4235.0, 4245.0, 4305.0, 1),
    ("B", 4322.0, 4371.0, 4380.0, 4433.0, 4440.0, 4498.0, 2),
    ("C", 4503.0, 4531.0, 4537.0, 4562.0, 4570.0, 4611.0, 1),
    ("D", 5142.0, 5160.0, 5165.0, 5180.0, 5190.0, 5206.0, 1),
]
VALUES = ", ".join(f"('{b[0]}', {', '.join(f'{v}e0' for v in b[1:7])}, {b[7]})" for b in BANDS)


def bands(t):
    return t.spark.createDataFrame(BANDS, "name string, b1 double, b2 double, b3 double, b4 double, b5 double, b6 double, kind int")


def whole_range(t):
    """Both arms of every spectrum side by side, without the shared pixels of the second."""
    return t.pixel.where("arm = 'BLUE' OR pix >= 36")


def index_sql(pixel: str, key: str = "spec_id") -> str:
    """Indices of the spectra that ``key`` tells apart; ``pixel`` is (key, wave, flux)."""
    return f"""WITH b(name, b1, b2, b3, b4, b5, b6, kind) AS (VALUES {VALUES}),
       p AS (SELECT {key}, wave, flux FROM {pixel} WHERE flux IS NOT NULL),
       i AS (SELECT {key}, min(wave) AS vmin, max(wave) AS vmax, list_sort(list(wave))[2] - min(wave) AS dw FROM p GROUP BY {key}),
       t AS (SELECT name, 1 AS part, b1 AS lo, b2 AS hi FROM b UNION ALL SELECT name, 2, b3, b4 FROM b UNION ALL SELECT name, 3, b5, b6 FROM b),
       s AS (SELECT {key}, name, part,
             CASE WHEN sum(CASE WHEN wave >= lo + dw / 2 AND wave <= hi - dw / 2 THEN 1 ELSE 0 END) > 0 AND any_value(vmin) <= any_value(hi) AND any_value(vmax) >= any_value(lo) THEN
             sum(flux * (CASE WHEN wave >= lo + dw / 2 AND wave <= hi - dw / 2 THEN 1 ELSE 0 END
               + CASE WHEN abs(wave - lo) < dw / 2 THEN (wave + dw / 2 - lo) / dw ELSE 0 END + CASE WHEN abs(wave - hi) < dw / 2 THEN (hi - wave + dw / 2) / dw ELSE 0 END)) END AS s
             FROM p JOIN i USING ({key}) CROSS JOIN t GROUP BY {key}, name, part),
       c AS (SELECT {key}, s.name, any_value(kind) AS kind, max(s) FILTER (part = 1) / any_value(b2 - b1) AS cb, max(s) FILTER (part = 2) AS f, max(s) FILTER (part = 3) / any_value(b6 - b5) AS cr,
             any_value((b1 + b2) / 2) AS lb, any_value((b5 + b6) / 2) AS lr, any_value(b3) AS b3, any_value(b4) AS b4, any_value(b6) AS b6 FROM s JOIN b ON b.name = s.name GROUP BY {key}, s.name),
       d AS (SELECT *, 0.5 * (((cr - cb) / (lr - lb) * (b3 - lb) + cb) + ((cr - cb) / (lr - lb) * (b4 - lb) + cb)) * (b4 - b3) AS cont FROM c)
       SELECT {key}, name, CASE WHEN b6 <= 4630 AND cb > 0 AND cr > 0 AND cont > 0 THEN CASE WHEN kind = 1 THEN (1 - f / cont) * (b4 - b3) WHEN f > 0 THEN -2.5 * log10(f / cont) END END AS "index" FROM d"""


WHOLE = "(SELECT * FROM {pixel} WHERE arm = 'BLUE' OR pix >= 36)"
shared("index_", index_sql(WHOLE))


@query("line_indices", fix="index_value", sql='SELECT spec_id, name, "index" AS index_value FROM {index_}')
def _(t):
    return ln.line_indices(whole_range(t), bands(t)).withColumnRenamed("index", "index_value")


def uniform(salt: int) -> str:
    return f"(CAST('0x' || left(md5(concat_ws('|', spec_id, pix, replica, 7, {salt})), 13) AS BIGINT) + 0.5e0) / 4503599627370496e0"


NOISY = f"""(SELECT spec_id, replica, wave, flux + sqrt(-2 * ln({uniform(0)})) * cos({uniform(1)} * 2 * pi()) * CASE WHEN ivar > 0 THEN 1 / sqrt(ivar) ELSE 0 END AS flux
  FROM {WHOLE}, (SELECT unnest(range(1, 9)) AS replica))"""
shared("noisy_index_", index_sql(NOISY, "spec_id, replica"))


@query(
    "line_index_errors",
    fix="index_error",
    sql="""SELECT spec_id, b.name, e.index_error FROM (SELECT DISTINCT spec_id FROM {pixel}) CROSS JOIN (SELECT DISTINCT name FROM {noisy_index_}) AS b
           LEFT JOIN (SELECT spec_id, name, CASE WHEN count("index") > 5 THEN stddev_pop("index") END AS index_error FROM {noisy_index_} GROUP BY spec_id, name) AS e USING (spec_id, name)""",
)
def _(t):
    px = whole_range(t).withColumn("noise", F.when(F.col("ivar") > 0, 1 / F.sqrt("ivar")))
    return ln.line_index_errors(px, bands(t), replicas=8, seed=7)


@query(
    "equivalent_width",
    fix="ew ew_err continuum",
    sql="""WITH l AS (SELECT bin_id, line, flux, abs(flux) / 10 AS e, 4000 + line * 150e0 + bin_id AS rest, (bin_id % 7) / 100e0 AS z FROM {lines_long}),
           c AS (SELECT l.*, a.value + (b.value - a.value) * (rest * (1 + z) - a.wave) / 30 AS raw FROM l
                 LEFT JOIN {curve} AS a ON a.nspec = bin_id AND a.wave = 4000 + 30 * floor((rest * (1 + z) - 4000) / 30)
                 LEFT JOIN {curve} AS b ON b.nspec = bin_id AND b.wave = a.wave + 30)
           SELECT bin_id AS target_id, line, raw AS continuum, flux / raw AS ew, e / raw AS ew_err FROM c""",
)
def _(t):
    lines = t.lines_long.select(
        F.col("bin_id").alias("target_id"), "line", "flux", (F.abs("flux") / 10).alias("flux_err"),
        (4000 + F.col("line") * 150.0 + F.col("bin_id")).alias("rest_wave"), ((F.col("bin_id") % 7) / 100.0).alias("z"),
    )
    out = ln.equivalent_width(lines, t.curve.select(F.col("nspec").alias("target_id"), "wave", "value"), step=30.0)
    return out.select("target_id", "line", "continuum", "ew", "ew_err")


@query(
    "line_detect",
    fix="aon",
    sql="""SELECT l.bin_id, l.arm, line, amplitude / noise AS aon, CASE WHEN amplitude / noise >= 8 THEN 'strong' WHEN amplitude / noise >= 4 THEN 'detected' ELSE 'none' END AS status
           FROM (SELECT bin_id, arm, line, aon * 0.2 AS amplitude, CAST(round_even((4000 + line * 83e0 + bin_id * 0.9 - 4000) / 10, 0) AS INT) AS pix FROM {lines_long}, (VALUES ('BLUE'), ('RED')) AS arms(arm)) AS l
           LEFT JOIN (SELECT spec_id, arm, pix, 1 / sqrt(ivar) AS noise FROM {pixel} WHERE ivar > 0) AS n ON n.spec_id = l.bin_id AND n.arm = l.arm AND n.pix = l.pix""",
)
def _(t):
    lines = t.lines_long.select("bin_id", "line", (F.col("aon") * 0.2).alias("amplitude"), (4000 + F.col("line") * 83.0 + F.col("bin_id") * 0.9).alias("wave"))
    lines = lines.withColumn("arm", F.explode(F.array(F.lit("BLUE"), F.lit("RED"))))
    noise = t.pixel.where("ivar > 0").select(F.col("spec_id").alias("bin_id"), "arm", "pix", (1 / F.sqrt("ivar")).alias("noise"))
    return ln.line_detect(lines, noise, start=4000.0, step=10.0, keys=["bin_id", "arm"]).select("bin_id", "arm", "line", "aon", "status")


@query(
    "invalidate_nonpositive_lines",
    fix="flux v sigma",
    sql="SELECT bin_id, line, flux, CASE WHEN flux > 0 THEN v END AS v, CASE WHEN flux > 0 THEN sigma END AS sigma FROM {lines_long}",
)
def _(t):
    return ln.invalidate_nonpositive_lines(t.lines_long).select("bin_id", "line", "flux", "v", "sigma")


QUANTITIES = ["FLUX", "AON", "V", "SIGMA"]


@query(
    "line_table_melt",
    fix="value",
    sql=" UNION ALL ".join(f"SELECT bin_id, 'L{n}' AS line, '{q.lower()}' AS quantity, {q}_L{n} AS value FROM {{line_wide}}" for q in QUANTITIES for n in range(1, 8)),
)
def _(t):
    return ln.line_table_melt(t.line_wide, quantities=QUANTITIES)


@query("line_table_pivot", fix=" ".join(f"{q}_L{n}" for q in QUANTITIES for n in range(1, 8)), sql="SELECT * FROM {line_wide}")
def _(t):
    long = t.sql(
        " UNION ALL ".join(f"SELECT bin_id, concat('L', line) AS line, '{q.lower()}' AS quantity, {q.lower()} AS value FROM {{lines_long}}" for q in QUANTITIES)
    )
    return ln.line_table_pivot(long, lines=[f"L{n}" for n in range(1, 8)], quantities=QUANTITIES)


@query(
    "line_summary",
    fix="velocity_range sigma_range median_v median_sigma",
    sql="""SELECT line, count(v) AS n_velocity, count(flux) AS n_flux, max(v) - min(v) AS velocity_range, max(sigma) - min(sigma) AS sigma_range, median(v) AS median_v, median(sigma) AS median_sigma
           FROM (SELECT line, flux, CASE WHEN flux > 0 THEN v END AS v, CASE WHEN flux > 0 THEN sigma END AS sigma FROM {lines_long}) GROUP BY line""",
)
def _(t):
    return ln.line_summary(ln.invalidate_nonpositive_lines(t.lines_long))


shared(
    "category_",
    """WITH l AS (SELECT p_partkey AS name, CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE 3900 + p_partkey * 0.4e0 END AS wave FROM {part}),
       m AS (SELECT 4000 + s_suppkey * 5.3e0 AS c, 0.5e0 + s_suppkey % 4 AS w FROM {supplier})
       SELECT name, CASE WHEN wave IS NULL THEN 'missing_wavelength' WHEN name % 3 = 0 AND wave > 4000 AND wave < 4550 THEN 'fitted'
         WHEN EXISTS (SELECT 1 FROM m WHERE abs(wave - c) <= w / 2) THEN 'masked' ELSE 'out_of_range' END AS category FROM l""",
)


def categories(t):
    lines = t.part.select(F.col("p_partkey").alias("name"), F.when(F.col("p_partkey") % 31 != 0, 3900 + F.col("p_partkey") * 0.4).alias("wave"))
    masks = t.supplier.select((4000 + F.col("s_suppkey") * 5.3).alias("centre"), (0.5 + F.col("s_suppkey") % 4).alias("width"))
    return ln.line_categories(lines, lines.where("name % 3 = 0").select("name"), masks, fit_range=(4020.0, 4500.0), config_range=(4000.0, 5000.0))


@query("line_categories", sql="SELECT * FROM {category_}")
def _(t):
    return categories(t)


@query(
    "product_consistency",
    fix="velocity_range",
    sql="""WITH x AS (SELECT (SELECT count(DISTINCT bin_id) FROM {bin_result}) AS bins, (SELECT count(DISTINCT bin_id) FROM {lines_long}) AS line_bins,
             (SELECT max(v) - min(v) FROM {lines_long}) AS velocity_range, (SELECT count(*) FROM {category_} WHERE category = 'fitted') AS n_fitted,
             (SELECT count(*) FROM {category_} WHERE category = 'masked') AS n_masked),
           y AS (SELECT *, CASE WHEN n_fitted = 0 THEN 1 ELSE 0 END AS issues, CASE WHEN bins <> line_bins THEN 1 ELSE 0 END + CASE WHEN n_fitted > 0 AND n_fitted < 5 THEN 1 ELSE 0 END
             + CASE WHEN n_masked > n_fitted THEN 1 ELSE 0 END + CASE WHEN n_fitted > 1 AND velocity_range > 500 THEN 1 ELSE 0 END AS warnings FROM x)
           SELECT *, CASE WHEN issues > 0 THEN 'ERROR' WHEN warnings > 0 THEN 'WARNING' ELSE 'GOOD' END AS status FROM y""",
)
def _(t):
    return ln.product_consistency(t.bin_result, t.lines_long, categories(t))


@query(
    "index_report",
    sql="""WITH f AS (SELECT spec_id, 50 + spec_id % 400 AS sigma, sqrt(power(2 + (spec_id % 5) * 0.5, 2) + power((50 + spec_id % 400) * 4630 / 299792.458 * 2.355, 2)) > 8.4 AS bad FROM {spec_class}),
           g AS (SELECT *, CASE WHEN bad THEN 1 ELSE 0 END AS flag FROM f)
           SELECT 'flag' AS section, CAST(flag AS VARCHAR) AS item, count(*) AS n FROM g GROUP BY flag
           UNION ALL SELECT 'high_sigma', CAST(flag AS VARCHAR), count(*) FROM g WHERE sigma > 300 GROUP BY flag
           UNION ALL SELECT 'index', name, count("index") FROM {index_} GROUP BY name""",
)
def _(t):
    px = t.pixel.withColumns({"lsf": 2 + (F.col("spec_id") % 5) * 0.5, "sigma_v": 50.0 + F.col("spec_id") % 400})
    flags = sp.broadening_needed(px, target=8.4, step=10.0).groupBy("spec_id").agg(F.max("flag").alias("flag"), F.max("sigma_v").alias("sigma"))
    return ln.index_report(flags, ln.line_indices(whole_range(t), bands(t)))
