"""Queries for sources, selection and merging."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lumenframe.functions.scale import shared_folder
from lumenframe.operators import merge as mg
from lumenframe.operators import select as sel
from lumenframe.plans.registry import query, shared
from lumenframe.sources import tables as src


@query(
    "read_survey_tables",
    fix="c_acctbal",
    sql="""SELECT CAST(c_custkey AS INT) AS c_custkey, trim(c_name) AS c_name, c_nationkey, c_acctbal, upper(trim(c_mktsegment)) AS c_mktsegment FROM {customer}""",
)
def _(t):
    return src.read_survey_tables(t.spark, t.folder, ["customer"], upper=["c_mktsegment"], ids=["c_custkey"])["customer"]


def fresh(t) -> str:
    """A new folder that all executors share, for sinks that are written and read back."""
    return f"{shared_folder(t.spark)}/lumenframe-sinks/{uuid.uuid4().hex}"


def written(df):
    """Schema of a product table of ``df``."""
    return df.withColumn("night", F.lit("")).schema


def _product(t):
    return {
        "class_table": t.customer.select(F.col("c_nationkey").alias("obs_id"), "c_custkey"),
        "star_table": t.supplier.where("s_suppkey % 3 = 0").select(F.col("s_nationkey").alias("obs_id"), "s_suppkey"),
        "galaxy_table": t.supplier.where("s_acctbal > 8500").select(F.col("s_nationkey").alias("obs_id"), "s_suppkey"),
        "class_spec": t.customer.where("c_acctbal > 9700").select(F.col("c_nationkey").alias("obs_id"), "c_custkey"),
    }


shared(
    "components_",
    """SELECT c_nationkey AS obs_id, 'class_table' AS extension FROM {customer}
       UNION ALL SELECT s_nationkey, 'star_table' FROM {supplier} WHERE s_suppkey % 3 = 0
       UNION ALL SELECT s_nationkey, 'galaxy_table' FROM {supplier} WHERE s_acctbal > 8500
       UNION ALL SELECT c_nationkey, 'class_spec' FROM {customer} WHERE c_acctbal > 9700""",
)


@query("write_product", sql="SELECT obs_id, extension, count(*) AS n_rows FROM {components_} GROUP BY obs_id, extension")
def _(t):
    tables, path = _product(t), fresh(t)
    src.write_product(tables, path, "20300101")
    return src.product_rows({name: t.spark.read.schema(written(df)).parquet(f"{path}/{name}") for name, df in tables.items()})


@query("export_csv", sql="SELECT s_suppkey AS id, s_name AS name FROM {supplier}")
def _(t):
    columns, names, path = ["s_suppkey", "not_there", "s_name"], {"s_suppkey": "id", "s_name": "name"}, fresh(t)
    view = src.export_view(t.supplier, columns, names)
    src.export_csv(t.supplier, path, columns, names)
    return t.spark.read.schema(view.schema).option("header", True).csv(path)


@query(
    "pivot_cube",
    fix="data ivar",
    sql="""SELECT spec_id + 1 AS target_id, spec_id % 25 AS ix, CAST(floor(spec_id / 25) AS BIGINT) AS iy, avg(f) AS data, sum(v) AS ivar FROM (
           SELECT spec_id, arm, avg(flux) AS f, sum(ivar) AS v FROM {pixel} GROUP BY spec_id, arm) GROUP BY spec_id""",
)
def _(t):
    images = t.pixel.groupBy("spec_id", "arm").agg(F.avg("flux").alias("data"), F.sum("ivar").alias("ivar"))
    images = images.withColumn("target_id", F.col("spec_id") + 1)
    return mg.pivot_cube(images, images, nx=25)[1]


@query(
    "select_targets",
    sql="""SELECT target_id, cname, targsrvy, targclass FROM {target} WHERE targsrvy = 'DISC' AND targclass IN ('STAR', 'ELG')
           AND target_id IN (SELECT c_custkey FROM {customer} WHERE c_acctbal > 0) AND target_id NOT IN (SELECT s_suppkey FROM {supplier} WHERE s_suppkey % 2 = 0)
           AND power(ra - 150.05, 2) + power(dec - 2.05, 2) < power(270 / 2e0 / 3600, 2)
           AND NOT power(ra - 150.04, 2) + power(dec - 2.04, 2) < power(40 / 2e0 / 3600, 2)""",
)
def _(t):
    out = sel.select_targets(
        t.target,
        ids=t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("target_id")),
        surveys=["disc"],
        classes=["star", "elg"],
        mask_ids=t.supplier.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("target_id")),
        area=(150.05, 2.05, 270.0, 100.0, 0.0),
        mask_areas=[(150.04, 2.04, 40.0, 40.0, 0.0)],
    )
    return out.select("target_id", "cname", "targsrvy", "targclass")


shared(
    "region_",
    """SELECT s_suppkey AS region_id, 150 + (s_suppkey * 61 % 400) / 4000e0 AS ra0, 2 + (s_suppkey * 17 % 400) / 4000e0 AS dec0,
       10e0 + s_suppkey % 30 AS a, 10e0 + s_suppkey % 7 AS b, s_suppkey * 13e0 % 180 AS angle FROM {supplier}""",
)


def _regions(t):
    return t.sql(
        """SELECT s_suppkey AS region_id, 150 + (s_suppkey * 61 % 400) / 4000e0 AS ra0, 2 + (s_suppkey * 17 % 400) / 4000e0 AS dec0,
           10e0 + s_suppkey % 30 AS a, 10e0 + s_suppkey % 7 AS b, s_suppkey * 13e0 % 180 AS angle FROM {supplier}"""
    )


@query(
    "in_circle",
    sql="""SELECT target_id, region_id FROM {target} JOIN {region_}
           ON (ra - ra0) * (ra - ra0) + (dec - dec0) * (dec - dec0) < (greatest(a, b) / 2 / 3600e0) * (greatest(a, b) / 2 / 3600e0)""",
)
def _(t):
    return sel.in_circle(t.target, _regions(t)).select("target_id", "region_id")


@query(
    "in_ellipse",
    sql="""SELECT target_id, region_id FROM (
           SELECT *, -(ra - ra0) * cos(radians(dec0)) * 3600 AS dx, (dec - dec0) * 3600 AS dy, radians(angle) AS th FROM {target}, {region_})
           WHERE power((dx * cos(th) + dy * sin(th)) / (a / 2), 2) + power((-dx * sin(th) + dy * cos(th)) / (b / 2), 2) <= 1""",
)
def _(t):
    return sel.in_ellipse(t.target, _regions(t)).select("target_id", "region_id")


@query(
    "best_repeat",
    fix="mean_snr",
    sql="""WITH s AS (SELECT spec_id, avg(snr) AS mean_snr FROM {arm_meta} GROUP BY spec_id)
           SELECT cname, target_id, mean_snr FROM (
           SELECT cname, target_id, mean_snr, row_number() OVER (PARTITION BY cname ORDER BY mean_snr DESC, spec_id) AS rn
           FROM {target} JOIN s ON spec_id = target_id - 1 WHERE targuse IN ('T', 'C') AND mean_snr >= 9.8 AND cname NOT LIKE '%7') WHERE rn = 1""",
)
def _(t):
    targets = t.target.withColumn("spec_id", F.col("target_id") - 1)
    names = targets.select("cname").where("cname NOT LIKE '%7'").distinct()
    return sel.best_repeat(targets, t.arm_meta, min_snr=9.8, cnames=names).select("cname", "target_id", "mean_snr")


def _ranks(t):
    z = t.zfit.withColumnRenamed("znum", "rank")
    return z.join(t.zhint.select("target_id", F.col("targclass").alias("srvy_class")), "target_id")


@query(
    "ids_in_class",
    sql="""SELECT DISTINCT target_id FROM {zfit} JOIN {zhint} USING (target_id)
           WHERE znum < 2 AND (lower(substr(class, 1, 2)) = 'st' OR lower(substr(targclass, 1, 2)) = 'st')
           AND target_id IN (SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F')""",
)
def _(t):
    ids = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("target_id"))
    return sel.ids_in_class(_ranks(t), ["STAR"], rank=2, ids=ids)


@query(
    "first_class_rank", fill="rank zwarn",
    fix="z zerr",
    sql="""WITH m AS (SELECT target_id, min(znum) AS r FROM {zfit} WHERE class IN ('QSO', 'STAR') GROUP BY target_id),
           k AS (SELECT DISTINCT target_id, COALESCE(r, 0) AS rank, CASE WHEN r IS NULL THEN -1 ELSE 0 END AS flag FROM {zfit} LEFT JOIN m USING (target_id))
           SELECT o_orderkey AS target_id, k.rank, class, z, zerr, zwarn, COALESCE(flag, -2) AS flag FROM {orders}
           LEFT JOIN k ON k.target_id = o_orderkey LEFT JOIN {zfit} AS f ON f.target_id = o_orderkey AND f.znum = k.rank""",
)
def _(t):
    ids = t.orders.select(F.col("o_orderkey").alias("target_id"))
    return sel.first_class_rank(t.zfit.withColumnRenamed("znum", "rank"), ["qso", "Stellar"], ids=ids)


@query(
    "deepest_product",
    sql="""SELECT cname, arm, file, level FROM (SELECT *, row_number() OVER (PARTITION BY cname, arm ORDER BY level DESC, file_id) AS rn FROM (
           SELECT *, CASE WHEN file LIKE '%wve_%' THEN 4 WHEN file LIKE '%super%' THEN 3 WHEN file LIKE '%stack%' THEN 1 WHEN file LIKE '%single%' THEN 0 ELSE 4 END AS level FROM {exposure})) WHERE rn = 1""",
)
def _(t):
    return sel.deepest_product(t.exposure).select("cname", "arm", "file", "level")


@query("drop_parked", sql="SELECT target_id, status FROM {target} WHERE status = 'A'")
def _(t):
    return sel.drop_parked(t.target).select("target_id", "status")


@query(
    "quality_catalogue",
    fix="prob z sigma",
    sql="""SELECT id, c.target_id, prob, z, 0.1 AS sigma, 'gaussian' AS function FROM {candidate} AS c JOIN {zfit} AS f ON f.target_id = c.target_id AND znum = 0
           WHERE duplicated = 0 AND prob >= 0.3""",
)
def _(t):
    cat = sel.quality_catalogue(t.candidate, t.zfit.where("znum = 0"), min_prob=0.3)
    prior = cat.select("id", F.lit(0.1).alias("sigma"), F.lit("gaussian").alias("function"))
    assert sel.prior_table(cat, sigma=0.1).columns == ["target_id", "z", "sigma", "function"]
    return cat.join(prior, "id").select("id", "target_id", "prob", "z", "sigma", "function")


@query(
    "append_tables",
    fix="flux",
    sql="""SELECT obj_id, flux FROM {object} UNION ALL SELECT (SELECT max(obj_id) FROM {object}) + row_number() OVER (ORDER BY c_acctbal DESC, c_custkey), c_acctbal
           FROM {customer}""",
)
def _(t):
    base = t.object.select("obj_id", "flux")
    extra = t.customer.select(F.lit(None).cast("bigint").alias("obj_id"), F.col("c_acctbal").alias("flux"), F.col("c_custkey").alias("k"))
    extra = extra.withColumn("neg", -F.col("flux"))
    return sel.append_tables(base, [extra], id="obj_id", order=["neg", "k"])


@query(
    "defunct_filter",
    sql="""WITH g AS (SELECT spec_id, arm FROM {pixel} GROUP BY spec_id, arm HAVING count(*) = count(flux) AND avg(flux) > 0),
           s AS (SELECT spec_id, arm, spec_id % 5 AS field, avg(flux) AS signal, avg(flux) / sqrt(avg(1 / ivar)) AS snr FROM {pixel}
                 WHERE ivar > 0 AND flux IS NOT NULL GROUP BY spec_id, arm),
           l AS (SELECT arm, field, avg(CASE WHEN abs(snr - 10) < 2 THEN signal END) AS level FROM s JOIN g USING (spec_id, arm) GROUP BY arm, field)
           SELECT s.spec_id, s.arm, s.field, g.spec_id IS NOT NULL AND (level IS NULL OR signal >= level) AS inside
           FROM s LEFT JOIN g USING (spec_id, arm) LEFT JOIN l USING (arm, field)""",
)
def _(t):
    from lumenframe.operators.spectra import signal_noise

    # Each arm of a spectrum is a spaxel of its own.
    px = t.pixel.withColumn("arm_id", F.concat_ws(":", "spec_id", "arm"))
    spaxel = signal_noise(px, keys=("arm_id", "spec_id", "arm")).withColumn("field", F.col("spec_id") % 5)
    return sel.defunct_filter(px, spaxel, min_snr=10.0, keys=("arm", "field"), id="arm_id").select("spec_id", "arm", "field", "inside")


# --- joins ---


@query(
    "outer_merge",
    fix="v_a v_b v_c",
    sql="""SELECT target_id, v_a, COALESCE(s_a, 'nan') AS s_a, v_b, v_c, COALESCE(n_c, -1) AS n_c FROM {merge_a} FULL JOIN {merge_b} USING (target_id) FULL JOIN {merge_c} USING (target_id)""",
)
def _(t):
    merged, flag = mg.outer_merge([t.merge_a, t.merge_b, t.merge_c], ["target_id"], exclude_prefix=["n_b"])
    assert flag == 0
    return merged.withColumns({"s_a": F.coalesce("s_a", F.lit("nan")), "n_c": F.coalesce("n_c", F.lit(-1))})


@query(
    "merge_quality_flag",
    sql="""WITH c AS (SELECT obs_id, extension, count(*) AS n FROM {components_} GROUP BY obs_id, extension),
           w AS (SELECT n_nationkey AS obs_id, COALESCE(max(n) FILTER (extension = 'class_table'), 0) AS a, COALESCE(max(n) FILTER (extension = 'star_table'), 0) AS b,
                 COALESCE(max(n) FILTER (extension = 'galaxy_table'), 0) AS c, COALESCE(max(n) FILTER (extension = 'class_spec'), 0) AS d
                 FROM {nation} LEFT JOIN c ON obs_id = n_nationkey GROUP BY n_nationkey)
           SELECT obs_id, CAST(CASE WHEN a = 0 THEN 1 ELSE 0 END + CASE WHEN b = 0 THEN 2 ELSE 0 END + CASE WHEN c = 0 THEN 4 ELSE 0 END + CASE WHEN d = 0 THEN 8 ELSE 0 END AS BIGINT) AS quality_flag,
           a > 0 AND b + c > 0 AS written FROM w""",
)
def _(t):
    obs = t.nation.select(F.col("n_nationkey").alias("obs_id"))
    return mg.merge_quality_flag(obs, _product(t), class_table="class_table", star="star_table", galaxy="galaxy_table")


@query(
    "add_extra_columns",
    fix="v_a v_b",
    sql="SELECT target_id, v_a, s_a, v_b FROM {merge_a} FULL JOIN {merge_b} USING (target_id)",
)
def _(t):
    return mg.add_extra_columns(t.merge_a, t.merge_b, keys=["target_id"], columns=["v_b"])


@query(
    "attach_scan", fill="n_star n_galaxy2",
    fix="z0 c0 zlast",
    sql="""WITH s AS (SELECT target_id, template, count(*) AS n, min(z) AS z0, max(z) AS zl, arg_min(chi2, (z, i)) AS c0 FROM {zscan} GROUP BY target_id, template)
           SELECT t.target_id, a.n AS n_star, b.n AS n_galaxy2, a.z0, a.c0, b.zl AS zlast FROM (SELECT target_id FROM {zfit} WHERE znum = 0) AS t
           LEFT JOIN s AS a ON a.target_id = t.target_id AND a.template = 'STAR' LEFT JOIN s AS b ON b.target_id = t.target_id AND b.template = 'GALAXY:::2'""",
)
def _(t):
    best = t.zfit.where("znum = 0").select("target_id")
    out = mg.attach_scan(best, t.zscan, templates=["STAR", "GALAXY", "QSO", "STAR:::2", "GALAXY:::2"])
    n = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).cast("bigint")
    return out.select(
        "target_id", n("CZZ_STAR").alias("n_star"), n("CZZ_GALAXY_2").alias("n_galaxy2"), F.get("CZZ_STAR", F.lit(0)).alias("z0"),
        F.get("CZZ_CHI2_STAR", F.lit(0)).alias("c0"), F.get("CZZ_GALAXY_2", F.size("CZZ_GALAXY_2") - 1).alias("zlast"),
    )


@query(
    "broadcast_bin_values",
    fix="v sigma h3",
    sql="SELECT s.target_id, s.bin_id, v, sigma, h3 FROM {binmap} AS s LEFT JOIN {bin_result} AS r ON r.bin_id = abs(s.bin_id)",
)
def _(t):
    return mg.broadcast_bin_values(t.binmap, t.bin_result).select("target_id", "bin_id", "v", "sigma", "h3")


@query(
    "arm_of_exposure",
    sql="""WITH r AS (SELECT cname, arm, file, row_number() OVER (PARTITION BY cname, arm ORDER BY file_id) - 1 AS n FROM {exposure})
           SELECT a.cname, a.n, a.file, b.arm AS other_arm, b.file AS other_file FROM r AS a LEFT JOIN r AS b ON b.cname = a.cname AND b.n = a.n AND b.arm <> 'BLUE'
           WHERE a.arm = 'BLUE'""",
)
def _(t):
    return mg.arm_of_exposure(t.exposure, obs="cname", arm="arm", order="file_id", first="BLUE")


@query(
    "target_summary_join",
    fix="z vrad flux_l1",
    sql="""SELECT t.target_id, cname, COALESCE(class, '000') AS class, COALESCE(z, -999) AS z, COALESCE(v_b, -999) AS vrad, COALESCE(FLUX_L1, -999) AS flux_l1
           FROM {target} AS t LEFT JOIN (SELECT * FROM {zfit} WHERE znum = 0) AS f ON f.target_id = t.target_id
           LEFT JOIN {merge_b} AS b ON b.target_id = t.target_id LEFT JOIN {line_wide} AS l ON l.bin_id = t.target_id""",
)
def _(t):
    best = t.zfit.where("znum = 0").select("target_id", "class", "z")
    star = t.merge_b.select("target_id", F.col("v_b").alias("vrad"))
    galaxy = t.line_wide.select(F.col("bin_id").alias("target_id"), F.col("FLUX_L1").alias("flux_l1"))
    return mg.target_summary_join(t.target.select("target_id", "cname"), best, star, galaxy)


@query(
    "align_to_grid",
    fix="wave value",
    sql="""SELECT n.nspec, CAST(4000 + g * 15e0 AS DOUBLE) AS wave, c.value FROM (SELECT DISTINCT nspec FROM {curve}) AS n CROSS JOIN (SELECT unnest(range(43)) AS g) AS g
           LEFT JOIN {curve} AS c ON c.nspec = n.nspec AND c.wave = 4000 + g * 15""",
)
def _(t):
    return mg.align_to_grid(t.curve, keys=["nspec"], start=4000.0, stop=4630.0, step=15.0)
