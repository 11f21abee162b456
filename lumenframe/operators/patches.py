"""Aperture (patch) tables ``(patch_id, ra, dec, a, b, angle, flag, type)``; type C is the field
centre, T a target, M a mask."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.scale import number_rows
from lumenframe.operators.select import class_match

# Order of classes among patches of equal area.
CLASS_PRIORITY = (("GALAXY", 0), ("QSO", 1), ("STAR", 2), ("WD", 3))
CLASS_GROUPS = (("GALAXY", "QSO"), ("STAR", "WD"))
PATCH_COLUMNS = ("patch_id", "ra", "dec", "a", "b", "angle", "flag", "type")


def make_patches(objects: DataFrame, centre: tuple[float, float, float, float], masks: DataFrame, *, pixel_scale: float, factor: float = 7.0, mask_radius: float, cap: int | None = None) -> DataFrame:
    """The field centre as id 0, objects by flux from 1 with scaled axes, then mask stars.

    ``cap`` is the survey's own limit: the brightest N objects. Numbering sorts in parallel.
    """
    spark = objects.sparkSession
    ra, dec, width, height = (float(v) for v in centre)
    schema = "patch_id bigint, ra double, dec double, a double, b double, angle double, flag double, type string"
    field = spark.createDataFrame([(0, ra, dec, width, height, 0.0, 0.0, "C")], schema)
    ranked = number_rows(objects, [F.col("flux").desc(), F.col("obj_id")], "patch_id")
    if cap is not None:
        ranked = ranked.where(F.col("patch_id") <= cap)
    scale = factor * pixel_scale
    ranked = ranked.select(
        "patch_id", "ra", "dec", (F.col("a") * scale).alias("a"), (F.col("b") * scale).alias("b"), F.degrees("theta").alias("angle"), F.col("flag").cast("double").alias("flag"), F.lit("T").alias("type")
    )
    start = ranked.agg(F.max("patch_id")).first()[0] or 0
    size = mask_radius * 2.0 / 3600.0
    stars = number_rows(masks, [F.col("mask_id")], "patch_id", start=start)
    stars = stars.select("patch_id", "ra", "dec", F.lit(size).alias("a"), F.lit(size).alias("b"), F.lit(0.0).alias("angle"), F.lit(0.0).alias("flag"), F.lit("M").alias("type"))
    return field.unionByName(ranked).unionByName(stars)


def split_patches(patches: DataFrame, ranks: DataFrame, *, groups: Sequence[Sequence[str]] = CLASS_GROUPS, n_chars: int = 2, first_id: int = 0) -> DataFrame:
    """One row per class group that occurs among the ranks of a patch, with the values at its
    first rank; masks are kept for every group. Largest area first, then class priority.

    ``ranks`` is ``(patch_id, rank, class, z, zerr, zwarn)``. All groups are found in one
    aggregation over the ranks.
    """
    picks = []
    for g in groups:
        hit = class_match("class", g, n_chars)
        picks.append(F.min(F.struct(F.when(hit, 0).otherwise(1).alias("miss"), "rank", "class", "z", "zerr", "zwarn")))
    found = ranks.groupBy("patch_id").agg(F.array(*picks).alias("_g"))
    rows = patches.join(found, "patch_id", "left")
    blank = F.array(*[F.lit(None).cast("struct<miss:int,rank:int,class:string,z:double,zerr:double,zwarn:int>") for _ in groups])
    rows = rows.select(*patches.columns, F.posexplode(F.coalesce(F.col("_g").cast("array<struct<miss:int,rank:int,class:string,z:double,zerr:double,zwarn:int>>"), blank)).alias("grp", "_v"))
    rows = rows.where((F.col("_v.miss") == 0) | (F.col("type") == "M"))
    rows = rows.select(F.col("patch_id").alias("old_id"), *[c for c in patches.columns if c != "patch_id"], "grp", "_v.class", "_v.z", "_v.zerr", "_v.zwarn")
    priority = F.lit(4)
    for name, p in CLASS_PRIORITY:
        priority = F.when(F.upper(F.trim("class")) == name, p).otherwise(priority)
    order = [(F.col("a") * F.col("b")).desc(), priority, F.col("old_id"), F.col("grp")]
    return number_rows(rows, order, "patch_id", start=first_id - 1)


def patch_checks(patches: DataFrame, ranks: DataFrame, *, wanted: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(rule, patch_id)`` for everything wrong with a patch table; table-wide rules have
    a NULL id."""
    missing = [c for c in PATCH_COLUMNS if c not in patches.columns]
    rules = []
    for c in missing:
        rules.append(patches.sparkSession.range(1).select(F.lit(f"missing_column:{c}").alias("rule"), F.lit(None).cast("bigint").alias("patch_id")))
    if "patch_id" in patches.columns:
        dup = patches.groupBy("patch_id").count().where("count > 1")
        rules.append(dup.select(F.lit("duplicate_id").alias("rule"), "patch_id"))
        z = ranks.groupBy("patch_id").agg(
            F.bool_or(F.col("z").isNotNull() & ~F.isnan("z")).alias("_z"), F.max("zwarn").alias("_w"), F.max_by("class", -F.col("rank")).alias("_c")
        )
        rows = patches.join(z, "patch_id", "left")
        real = F.upper(F.trim("type")) != "M"
        tests = {
            "no_redshift": real & ~F.coalesce(F.col("_z"), F.lit(False)),
            "redshift_warning": F.col("_w") > 0,
            "zero_size": (F.col("a") == 0) | (F.col("b") == 0),
        }
        names = F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()])
        hits = rows.select("patch_id", F.explode(F.array_compact(names)).alias("rule"))
        rules.append(hits.select("rule", "patch_id"))
        if wanted is not None:
            n = rows.where(real & F.col("_c").isin(list(wanted))).agg(F.count("*").alias("n")).where("n = 0")
            rules.append(n.select(F.lit("no_wanted_class").alias("rule"), F.lit(None).cast("bigint").alias("patch_id")))
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out
