"""Selection of targets, repeats, classes and products."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.exprs import usable
from lumenframe.functions.scale import measured, number_rows, on_keys


def circle_test(ra: Column, dec: Column, area: Sequence[float], *, flat: bool = True) -> Column:
    """Inside a circle of diameter max(A, B) arcsec. The flat form ignores cos(dec)."""
    ra0, dec0, a, b = area[:4]
    r = max(a, b) / 2.0 / 3600.0
    scale = 1.0 if flat else math.cos(math.radians(dec0))
    dx, dy = (ra - float(ra0)) * scale, dec - float(dec0)
    return dx * dx + dy * dy < r * r


def ellipse_test(dx: Column, dy: Column, a: Column, b: Column, angle: Column) -> Column:
    """(u/a)^2 + (v/b)^2 <= 1 for full axis lengths a, b; offsets towards west and north, the
    angle counter-clockwise from the first."""
    t = F.radians(angle)
    u = dx * F.cos(t) + dy * F.sin(t)
    v = -dx * F.sin(t) + dy * F.cos(t)
    ua, vb = u / (a / 2), v / (b / 2)
    return ua * ua + vb * vb <= 1


def select_targets(
    target: DataFrame,
    *,
    ids: DataFrame | None = None,
    surveys: Sequence[str] | None = None,
    classes: Sequence[str] | None = None,
    mask_ids: DataFrame | None = None,
    area: Sequence[float] | None = None,
    mask_areas: Sequence[Sequence[float]] = (),
) -> DataFrame:
    """Intersection of the six filters, by id. Lists of ids are tables of any size, joined as
    semi and anti joins; surveys, classes and areas are short configured lists."""
    out = target

    def plain(values: Sequence[str]) -> list[str]:
        return [v.upper().replace(" ", "") for v in values]

    if surveys is not None:
        out = out.where(F.col("targsrvy").isin(plain(surveys)))
    if classes is not None:
        out = out.where(F.col("targclass").isin(plain(classes)))
    if area is not None:
        out = out.where(circle_test(F.col("ra"), F.col("dec"), area))
    for m in mask_areas:
        out = out.where(~F.coalesce(circle_test(F.col("ra"), F.col("dec"), m), F.lit(False)))
    if ids is not None:
        out = out.join(ids.select("target_id"), "target_id", "left_semi")
    if mask_ids is not None:
        out = out.join(mask_ids.select("target_id"), "target_id", "left_anti")
    return out.orderBy("target_id")


def cover_join(points: DataFrame, regions: DataFrame, *, xy: Sequence[str], centre: Sequence[Column], half: Sequence[Column], cell: float, exact: Column, how: str = "inner") -> DataFrame:
    """Points with the regions that contain them.

    A region is copied to every cell its bounding box touches, so regions of very different
    size work; a point stays in one cell and is never copied.
    """
    p = points.withColumns({"_cx": F.floor(F.col(xy[0]) / cell), "_cy": F.floor(F.col(xy[1]) / cell)})
    r = regions
    for name, c, h in (("_kx", centre[0], half[0]), ("_ky", centre[1], half[1])):
        r = r.withColumn(name, F.explode(F.sequence(F.floor((c - h) / cell), F.floor((c + h) / cell))))
    on = (F.col("_cx") == F.col("_kx")) & (F.col("_cy") == F.col("_ky")) & exact
    return p.join(r, on, how).drop("_cx", "_cy", "_kx", "_ky")


def in_circle(target: DataFrame, regions: DataFrame, *, cell: float = 0.01, how: str = "inner") -> DataFrame:
    """Fibre-mode aperture test against a region table ``(region_id, ra0, dec0, a, b)``; flat."""
    r = F.greatest("a", "b") / 2 / 3600.0
    dx, dy = F.col("ra") - F.col("ra0"), F.col("dec") - F.col("dec0")
    return cover_join(
        target, regions, xy=("ra", "dec"), centre=(F.col("ra0"), F.col("dec0")), half=(r, r), cell=cell, exact=dx * dx + dy * dy < r * r, how=how
    )


def in_ellipse(target: DataFrame, regions: DataFrame, *, cell: float = 0.01, how: str = "inner") -> DataFrame:
    """Cube-mode aperture test against ``(region_id, ra0, dec0, a, b, angle)``, axes in arcsec."""
    cosd = F.cos(F.radians("dec0"))
    h = F.greatest("a", "b") / 2 / 3600.0
    dx = -(F.col("ra") - F.col("ra0")) * cosd * 3600.0
    dy = (F.col("dec") - F.col("dec0")) * 3600.0
    exact = ellipse_test(dx, dy, F.col("a"), F.col("b"), F.col("angle"))
    return cover_join(target, regions, xy=("ra", "dec"), centre=(F.col("ra0"), F.col("dec0")), half=(h / cosd, h), cell=cell, exact=exact, how=how)


def best_repeat(target: DataFrame, arm_snr: DataFrame, *, min_snr: float = 0.0, cnames: DataFrame | None = None, uses: Sequence[str] = ("T", "C")) -> DataFrame:
    """Per CNAME the repeat with the highest mean SNR over arms (ties: lowest id).

    Without a CNAME list the result is empty, as in the original rule. ``max_by`` combines
    before the shuffle, so a name with very many repeats is no hot key.
    """
    if cnames is None:
        return target.withColumn("mean_snr", F.lit(None).cast("double")).limit(0)
    snr = arm_snr.groupBy("spec_id").agg(F.avg("snr").alias("mean_snr"))
    rows = target.where(F.col("targuse").isin(list(uses))).join(snr, "spec_id")
    rows = rows.where(F.col("mean_snr") >= min_snr).join(cnames.select("cname"), "cname", "left_semi")
    cols = [c for c in rows.columns if c != "cname"]
    best = rows.groupBy("cname").agg(F.max_by(F.struct(*cols), F.struct("mean_snr", -F.col("spec_id"))).alias("b"))
    return best.select("cname", "b.*")


def class_match(column: str | Column, wanted: Sequence[str], n: int) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.substring(F.lower(F.trim(c)), 1, n).isin([w.lower()[:n] for w in wanted])


def ids_in_class(ranks: DataFrame, wanted: Sequence[str], *, rank: int = 1, n_chars: int = 2, ids: DataFrame | None = None) -> DataFrame:
    """Targets with a wanted class among the first ``rank`` entries of class or survey class."""
    hit = class_match("class", wanted, n_chars) | class_match("srvy_class", wanted, n_chars)
    out = ranks.where((F.col("rank") < rank) & hit).select("target_id").distinct()
    return out if ids is None else out.join(ids.select("target_id"), "target_id", "left_semi")


def first_class_rank(ranks: DataFrame, wanted: Sequence[str], *, n_chars: int = 2, ids: DataFrame | None = None) -> DataFrame:
    """First matching rank per target and its values. Flag 0 found, -1 no match (rank 0 is
    used), -2 the target is not in the table."""
    hit = class_match("class", wanted, n_chars)
    # Matches sort before non-matches; among either, the lowest rank wins.
    pick = F.min(F.struct(F.when(hit, 0).otherwise(1).alias("miss"), F.col("rank"), "class", "z", "zerr", "zwarn"))
    out = ranks.groupBy("target_id").agg(pick.alias("p")).select("target_id", "p.*")
    out = out.withColumn("flag", -F.col("miss")).drop("miss")
    if ids is not None:
        out = ids.select("target_id").join(out, "target_id", "left").withColumn("flag", F.coalesce("flag", F.lit(-2)))
    return out


# File-name keywords and their stacking level, tested in this order.
STACK_LEVELS = (("wve_", 4), ("super", 3), ("stack", 1), ("single", 0))


def stack_level(file: Column, levels: Sequence[tuple[str, int]] = STACK_LEVELS) -> Column:
    name = F.lower(F.element_at(F.split(file, "/"), -1))
    out = F.lit(4)
    for word, level in reversed(levels):
        out = F.when(F.contains(name, F.lit(word)), level).otherwise(out)
    return out


def deepest_product(exposure: DataFrame, *, keys: Sequence[str] = ("cname", "arm"), levels: Sequence[tuple[str, int]] = STACK_LEVELS) -> DataFrame:
    """Per object and arm the file of the highest stacking level (ties: lowest file id)."""
    rows = exposure.withColumn("level", stack_level(F.col("file"), levels))
    cols = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct("level", -F.col("file_id"))).alias("b"))
    return best.select(*keys, "b.*")


def drop_parked(target: DataFrame, *, active: Sequence[str] = ("A",)) -> DataFrame:
    return target.where(F.upper(F.trim("status")).isin(list(active)))


def prior_table(df: DataFrame, *, id: str = "target_id", z: str = "z", sigma: float) -> DataFrame:
    return df.select(F.col(id), F.col(z).alias("z"), F.lit(float(sigma)).alias("sigma"), F.lit("gaussian").alias("function"))


def quality_catalogue(candidates: DataFrame, best_z: DataFrame, *, min_prob: float) -> DataFrame:
    """Unique candidates above a probability, with the redshift of the redshift table."""
    keep = candidates.where((F.col("duplicated") == 0) & (F.col("prob") >= min_prob))
    return keep.join(best_z.select("target_id", "z"), "target_id")


def append_tables(base: DataFrame, more: Sequence[DataFrame], *, id: str, order: Sequence[str]) -> DataFrame:
    """Vertical concatenation with one schema; ids of the appended rows continue after the
    maximum, in ``order``, which must be total over the appended rows."""
    start = base.agg(F.max(id)).first()[0] or 0
    extra = more[0]
    for df in more[1:]:
        extra = extra.unionByName(df)
    extra = number_rows(extra.drop(id), [F.col(c) for c in order], id, start=start)
    return base.unionByName(extra.select(*base.columns))


def isophote(spaxel: DataFrame, *, min_snr: float, keys: Sequence[str] = ("field",), near: float = 2.0) -> DataFrame:
    """Inside = signal at or above the mean signal of spaxels with an SNR near the limit; a
    field without such spaxels is kept whole."""
    keys = list(keys)
    level = measured(spaxel.groupBy(*keys).agg(F.avg(F.when(F.abs(F.col("snr") - min_snr) < near, F.col("signal"))).alias("_level")))
    out = on_keys(spaxel, level, keys)
    return out.withColumn("inside", F.col("_level").isNull() | (F.col("signal") >= F.col("_level"))).drop("_level")


def defunct_filter(pixel: DataFrame, spaxel: DataFrame, *, min_snr: float, keys: Sequence[str] = ("field",), id: str = "spec_id") -> DataFrame:
    """Spaxels with a complete spectrum and a positive mean, then the isophote test among them."""
    good = pixel.groupBy(id).agg(F.bool_and(usable(F.col("flux"))).alias("_c"), F.avg("flux").alias("_m")).where("_c AND _m > 0")
    ok = isophote(spaxel.join(good.select(id), id, "left_semi"), min_snr=min_snr, keys=keys).select(id, "inside")
    return spaxel.join(ok, id, "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
