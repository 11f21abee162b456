"""Queries for reports and file lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import quality as ql
from lumenframe.plans.registry import query, shared

ATTEMPTS = """SELECT CAST(user_id AS BIGINT) AS run, event_type AS stage,
  CASE WHEN user_id % 10 = 3 THEN 'failed' WHEN value < 30 THEN 'written' WHEN event_id % 3 = 0 THEN 'no_valid_spaxels' ELSE 'failed' END AS outcome FROM {events}"""
shared("attempts_", ATTEMPTS)


@query(
    "patch_yield",
    fix="yield",
    sql="""SELECT run, stage, count(*) AS attempted, count(*) FILTER (outcome = 'written') AS written, count(*) FILTER (outcome = 'no_valid_spaxels') AS no_valid_spaxels,
           count(*) FILTER (outcome = 'failed') AS failed, round(count(*) FILTER (outcome = 'written') / count(*), 3) AS yield,
           count(*) FILTER (outcome = 'written') / count(*) < 0.5 AS low_yield, count(*) >= 10 AND count(*) FILTER (outcome = 'written') = 0 AS run_failed FROM {attempts_} GROUP BY run, stage""",
)
def _(t):
    return ql.patch_yield(t.sql(ATTEMPTS))


@query(
    "killed_jobs",
    sql="""SELECT job_id, name, split_part(state, ' ', 1) AS state FROM {job} WHERE name LIKE '%\\_7' ESCAPE '\\' AND split_part(state, ' ', 1) IN ('TIMEOUT', 'CANCELLED', 'OUT_OF_MEMORY', 'NODE_FAIL', 'PREEMPTED')""",
)
def _(t):
    return ql.killed_jobs(t.job, tag="7").select("job_id", "name", "state")


FLAGS = [f"flag{i}" for i in range(20)]


@query(
    "flag_counts",
    sql="""SELECT CAST(k AS INT) AS bit, concat('flag', k) AS flag, (SELECT CAST(sum((flags >> k) & 1) AS BIGINT) FROM {flagrow}) AS n_rows FROM (SELECT unnest(range(20)) AS k)""",
)
def _(t):
    return ql.flag_counts(t.flagrow, names=FLAGS)


@query("flag_names", sql="SELECT id, flags AS encoded, bit_count(flags) AS n_set FROM {flagrow}")
def _(t):
    names = t.flagrow.withColumn("names", ql.decode_flags(F.col("flags"), FLAGS))
    return names.select("id", ql.encode_flags(F.col("names"), FLAGS).alias("encoded"), F.size("names").alias("n_set"))


@query(
    "observation_summary",
    fix="wmin wmax",
    sql="""SELECT cname AS obs_id, min(mode) AS mode, min(resolution) AS resolution, concat_ws(',', CASE WHEN bool_or(arm = 'BLUE') THEN 'BLUE' END, CASE WHEN bool_or(arm = 'GREEN') THEN 'GREEN' END, CASE WHEN bool_or(arm = 'RED') THEN 'RED' END) AS arms,
           COALESCE(string_agg(DISTINCT survey, ',' ORDER BY survey) FILTER (survey <> ''), '') AS surveys, min(wmin) AS wmin, max(wmax) AS wmax, count(DISTINCT mode) = 1 AS one_mode,
           count(DISTINCT resolution) = 1 AS one_resolution, count(DISTINCT arm) = count(*) AS distinct_arms FROM {exposure} GROUP BY cname""",
)
def _(t):
    return ql.observation_summary(t.exposure.withColumnRenamed("cname", "obs_id"))


@query(
    "file_changes",
    sql="""SELECT COALESCE(a.path, b.path) AS path, COALESCE(a.component, b.component) AS component, CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'extra'
           WHEN a.size <> b.size OR a.hash <> b.hash THEN 'changed' ELSE 'same' END AS status FROM {manifest_a} AS a FULL JOIN {manifest_b} AS b ON a.path = b.path""",
)
def _(t):
    return ql.file_changes(t.manifest_a, t.manifest_b)


def digest_sql(src: str) -> str:
    return f"""SELECT component, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, sum(CAST('0x' || substr(h, 1, 8) AS BIGINT)) AS da, sum(CAST('0x' || substr(h, 9, 8) AS BIGINT)) AS db
               FROM (SELECT *, md5(concat_ws('|', path, size, hash)) AS h FROM {src}) GROUP BY component"""


@query(
    "manifest_diff", fill="files files_b bytes bytes_b",
    sql=f"""WITH a AS ({digest_sql('{manifest_a}')}), b AS ({digest_sql('{manifest_b}')}),
            f AS (SELECT COALESCE(x.component, y.component) AS component, CASE WHEN y.path IS NULL THEN 'missing' WHEN x.path IS NULL THEN 'extra' WHEN x.size <> y.size OR x.hash <> y.hash THEN 'changed' ELSE 'same' END AS s
                  FROM {{manifest_a}} AS x FULL JOIN {{manifest_b}} AS y ON x.path = y.path)
            SELECT COALESCE(a.component, b.component) AS component, CASE WHEN b.files IS NULL THEN 'removed' WHEN a.files IS NULL THEN 'added' WHEN a.da = b.da AND a.db = b.db AND a.files = b.files AND a.bytes = b.bytes THEN 'same' ELSE 'changed' END AS status,
            a.files, b.files AS files_b, a.bytes, b.bytes AS bytes_b, (SELECT count(*) FROM f WHERE f.component = COALESCE(a.component, b.component) AND s = 'same') AS n_same,
            (SELECT count(*) FROM f WHERE f.component = COALESCE(a.component, b.component) AND s = 'changed') AS n_changed, (SELECT count(*) FROM f WHERE f.component = COALESCE(a.component, b.component) AND s = 'missing') AS n_missing,
            (SELECT count(*) FROM f WHERE f.component = COALESCE(a.component, b.component) AND s = 'extra') AS n_extra FROM a FULL JOIN b ON a.component = b.component""",
)
def _(t):
    return ql.manifest_diff(t.manifest_a, t.manifest_b)


@query(
    "template_grid",
    sql="""SELECT count(DISTINCT p_size) AS n_age, count(DISTINCT p_brand) AS n_metal, count(DISTINCT p_type) AS n_alpha, count(DISTINCT (p_size, p_brand, p_type)) AS n_combinations FROM {part} WHERE p_partkey % 4 <> 0""",
)
def _(t):
    rows = t.part.select(F.col("p_size").alias("age"), F.col("p_brand").alias("metal"), F.col("p_type").alias("alpha"), F.when(F.col("p_partkey") % 4 == 0, 1).otherwise(0).alias("flag"))
    return ql.template_grid(rows)


@query(
    "split_ranges",
    fix="lo hi overlap",
    sql="""WITH r AS (SELECT spec_id, arm, min(wave) AS lo, max(wave) + spec_id % 5 * 1.3 AS hi FROM {pixel} WHERE ivar > 0 GROUP BY spec_id, arm),
           b AS (SELECT * FROM r WHERE arm = 'BLUE'), d AS (SELECT * FROM r WHERE arm = 'RED')
           SELECT b.spec_id, 'BLUE' AS arm, b.lo, CASE WHEN d.lo < b.hi THEN round((b.hi + d.lo) / 2, 1) ELSE b.hi END AS hi, greatest(b.hi - d.lo, 0) AS overlap, d.lo < b.hi AS open_end FROM b JOIN d ON d.spec_id = b.spec_id
           UNION ALL SELECT d.spec_id, 'RED', CASE WHEN b.hi > d.lo THEN round((b.hi + d.lo) / 2, 1) ELSE d.lo END, d.hi, 0, FALSE FROM b JOIN d ON d.spec_id = b.spec_id""",
)
def _(t):
    return ql.split_ranges(ranges(t))


def ranges(t):
    r = t.pixel.where("ivar > 0").groupBy("spec_id", "arm").agg(F.min("wave").alias("lo"), F.max("wave").alias("hi"))
    return r.withColumn("hi", F.col("hi") + F.col("spec_id") % 5 * F.lit(1.3))


@query(
    "split_at",
    sql="""WITH r AS (SELECT spec_id, arm, min(wave) AS lo, max(wave) + spec_id % 5 * 1.3 AS hi FROM {pixel} WHERE ivar > 0 GROUP BY spec_id, arm),
           s AS (SELECT b.spec_id, b.lo AS a, CASE WHEN d.lo < b.hi THEN round((b.hi + d.lo) / 2, 1) END AS c, b.hi AS bh, d.lo AS dl, d.hi AS z FROM r AS b JOIN r AS d ON d.spec_id = b.spec_id WHERE b.arm = 'BLUE' AND d.arm = 'RED'),
           p AS (SELECT DISTINCT spec_id, pix, wave FROM {pixel})
           SELECT p.spec_id, p.pix, 'BLUE' AS arm FROM p JOIN s ON s.spec_id = p.spec_id WHERE wave >= a AND CASE WHEN c IS NULL THEN wave <= bh ELSE wave < c END
           UNION ALL SELECT p.spec_id, p.pix, 'RED' FROM p JOIN s ON s.spec_id = p.spec_id WHERE wave >= COALESCE(c, dl) AND wave <= z""",
)
def _(t):
    joined = t.pixel.select("spec_id", "pix", "wave").distinct()
    return ql.split_at(joined, ranges(t)).select("spec_id", "pix", "arm")
