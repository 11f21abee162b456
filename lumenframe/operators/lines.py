"""Absorption indices, emission lines and their tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.exprs import ratio, usable
from lumenframe.functions.scale import quantiles
from lumenframe.operators.ranges import band_join, interp_at

PARTS = ("blue", "feature", "red")


def line_indices(pixel: DataFrame, bands: DataFrame, *, keys: Sequence[str] = ("spec_id",), flux: str = "flux", width: float = 50.0) -> DataFrame:
    """Line-strength index of every band triplet ``(name, b1..b6, kind)`` for every spectrum.

    Bands are summed with fractional pixels at their edges; kind 1 is an equivalent width,
    kind 2 a magnitude. NULL where the spectrum does not cover the triplet, a part has no full
    pixel, or a continuum is not positive; spectra with less than 10 % valid pixels give none.

    The bands, a small table, are copied to wavelength buckets and joined to the pixels; the
    aggregation keys are (spectrum, index).
    """
    keys = list(keys)
    valid = usable(F.col("wave")) & usable(F.col(flux))
    whole = Window.partitionBy(*keys)
    seen = pixel.select(*keys, "wave", F.col(flux).alias("_f"), valid.alias("_ok"))
    # Numbers per spectrum as windows: the pixels are shuffled by spectrum once, and the sums
    # per (spectrum, index) below stay in the same partitions.
    next_wave = F.lead("wave").over(Window.partitionBy(*keys, "_ok").orderBy("wave"))
    seen = seen.withColumns(
        {
            "_step": F.when(F.col("_ok"), next_wave - F.col("wave")),
            "_wmin": F.min("wave").over(whole),
            "_wmax": F.max("wave").over(whole),
            "_all": F.count(F.lit(1)).over(whole),
            "_valid": F.sum(F.when(F.col("_ok"), 1).otherwise(0)).over(whole),
            "_vmin": F.min(F.when(F.col("_ok"), F.col("wave"))).over(whole),
            "_vmax": F.max(F.when(F.col("_ok"), F.col("wave"))).over(whole),
        }
    )
    # The pixel width is the distance of the first two valid pixels.
    seen = seen.withColumn("_dw", F.max(F.when(F.col("_ok") & (F.col("wave") == F.col("_vmin")), F.col("_step"))).over(whole))
    good = seen.where(F.col("_ok") & (F.col("_valid") >= F.col("_all") * 0.1) & (F.col("_valid") >= 3))
    pad = (good.agg(F.max("_dw")).first()[0] or 0.0) / 2
    pieces = [F.struct(F.lit(p).alias("part"), F.col(f"b{2 * i + 1}").alias("lo"), F.col(f"b{2 * i + 2}").alias("hi")) for i, p in enumerate(PARTS)]
    parts = bands.select("name", F.explode(F.array(*pieces)).alias("p")).select(
        "name", "p.part", "p.lo", "p.hi", (F.col("p.lo") - pad).alias("_plo"), (F.col("p.hi") + pad).alias("_phi")
    )
    info = ("_wmin", "_wmax", "_vmin", "_vmax")
    px = band_join(good.select(*keys, "wave", "_f", "_dw", *info), parts, lo="_plo", hi="_phi", width=width)
    h = F.col("_dw") / 2
    full = (F.col("wave") >= F.col("lo") + h) & (F.col("wave") <= F.col("hi") - h)
    left = (F.col("wave") < F.col("lo") + h) & (F.col("wave") > F.col("lo") - h)
    right = (F.col("wave") < F.col("hi") + h) & (F.col("wave") > F.col("hi") - h)
    share = (
        F.when(full, 1.0).otherwise(0.0)
        + F.when(left, (F.col("wave") + h - F.col("lo")) / F.col("_dw")).otherwise(0.0)
        + F.when(right, (F.col("hi") - (F.col("wave") - h)) / F.col("_dw")).otherwise(0.0)
    )
    sums = px.groupBy(*keys, "name").agg(
        *[F.sum(F.when(F.col("part") == p, F.col("_f") * share)).alias(f"_s_{p}") for p in PARTS],
        *[F.max(F.when((F.col("part") == p) & full, 1)).alias(f"_n_{p}") for p in PARTS],
        *[F.first(c).alias(c) for c in info],
    )
    # Every spectrum with every index, measured or not: the index list is configuration.
    wanted = bands.select(F.collect_list(F.struct(*bands.columns)).alias("l")).scalar()
    every = pixel.select(*keys).distinct().withColumn("_b", F.explode(wanted)).select(*keys, "_b.*")
    out = every.join(sums, [*keys, "name"], "left")

    def total(p: str, lo: str, hi: str) -> Column:
        reached = (F.col("_vmin") <= F.col(hi)) & (F.col("_vmax") >= F.col(lo))
        return F.when((F.col(f"_n_{p}") == 1) & reached, F.col(f"_s_{p}"))

    b = {i: F.col(f"b{i}") for i in range(1, 7)}
    cb = ratio(total("blue", "b1", "b2"), b[2] - b[1])
    cr = ratio(total("red", "b5", "b6"), b[6] - b[5])
    out = out.withColumns({"_cb": cb, "_cr": cr, "_s": total("feature", "b3", "b4")})
    lb, lr = (b[1] + b[2]) / 2, (b[5] + b[6]) / 2
    slope = ratio(F.col("_cr") - F.col("_cb"), lr - lb)
    cont = 0.5 * ((slope * (b[3] - lb) + F.col("_cb")) + (slope * (b[4] - lb) + F.col("_cb"))) * (b[4] - b[3])
    out = out.withColumn("_cont", cont)
    atomic = (F.lit(1.0) - ratio(F.col("_s"), F.col("_cont"))) * (b[4] - b[3])
    molecular = F.when(F.col("_s") > 0, F.log10(ratio(F.col("_s"), F.col("_cont"))) * -2.5)
    covered = (F.col("_wmin") <= b[1]) & (F.col("_wmax") >= b[6])
    ok = covered & (F.col("_cb") > 0) & (F.col("_cr") > 0) & (F.col("_cont") > 0)
    index = F.when(ok, F.when(F.col("kind") == 1, atomic).when(F.col("kind") == 2, molecular))
    return out.select(*keys, "name", index.alias("index"))


def line_index_errors(
    pixel: DataFrame, bands: DataFrame, *, replicas: int, seed: int = 0, z: str | None = None, z_err: str | None = None, keys: Sequence[str] = ("spec_id",)
) -> DataFrame:
    """Standard deviation of each index over noise replicas of its spectrum (more than 5 valid).

    The noise is a function of (key, pixel, replica, seed), not of the partitioning, so a
    recomputed task draws the same numbers. ``noise`` is the error per pixel.
    """
    keys = list(keys)
    wide = pixel.withColumn("replica", F.explode(F.sequence(F.lit(1), F.lit(replicas))))

    def uniform(salt: int, *cols: str) -> Column:
        # 52 bits of a digest that any other tool can draw as well.
        h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)), F.lit(str(salt))).cast("binary"))
        return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)

    def normal(salt: int, *cols: str) -> Column:
        return F.sqrt(F.log(uniform(salt, *cols)) * -2.0) * F.cos(uniform(salt + 1, *cols) * (2 * math.pi))

    noisy = F.col("flux") + normal(0, *keys, "pix", "replica") * F.coalesce("noise", F.lit(0.0))
    wide = wide.withColumn("flux", noisy)
    if z is not None:
        dz = normal(10, *keys, "replica") * (F.col(z_err) if z_err else 0.0)
        wide = wide.withColumn("wave", F.col("wave") / (F.col(z) + dz + 1.0))
    found = line_indices(wide, bands, keys=[*keys, "replica"])
    return found.groupBy(*keys, "name").agg(F.when(F.count("index") > 5, F.stddev_pop("index")).alias("index_error"))


def equivalent_width(lines: DataFrame, continuum: DataFrame, *, step: float) -> DataFrame:
    """Line flux over the continuum interpolated at the observed wavelength.

    ``lines`` is ``(target_id, line, flux, flux_err, rest_wave, z)``, ``continuum`` is
    ``(target_id, wave, value)``. NULL outside the range or on a continuum that is not positive.
    """
    asked = lines.withColumns({"curve_id": F.col("target_id"), "_x": F.col("rest_wave") * (F.col("z") + 1.0)})
    out = interp_at(asked, continuum.withColumnRenamed("target_id", "curve_id"), x="_x", step=step, name="continuum")
    level = F.when(usable(F.col("continuum")) & (F.col("continuum") > 0) & usable(F.col("flux")), F.col("continuum"))
    out = out.withColumn("continuum", level)
    return out.withColumns({"ew": F.col("flux") / F.col("continuum"), "ew_err": F.col("flux_err") / F.col("continuum")}).drop("curve_id", "_x")


def detection(aon: Column, threshold: float = 4.0) -> Column:
    return F.when(aon >= 2 * threshold, "strong").when(aon >= threshold, "detected").otherwise("none")


def line_detect(lines: DataFrame, noise: DataFrame, *, start: float, step: float, threshold: float = 4.0, keys: Sequence[str] = ("bin_id",)) -> DataFrame:
    """Amplitude over noise at the pixel nearest to the line, and its status.

    On a regular grid the nearest pixel is a number, so this is an equi-join on the keys, such as
    bin and arm, and the pixel.
    """
    rows = lines.withColumn("pix", F.rint((F.col("wave") - start) / step).cast("int"))
    out = rows.join(noise.select(*keys, "pix", "noise"), [*keys, "pix"], "left").withColumn("aon", ratio(F.col("amplitude"), F.col("noise")))
    return out.withColumn("status", detection(F.col("aon"), threshold))


def invalidate_nonpositive_lines(lines: DataFrame, *, flux: str = "flux", columns: Sequence[str] = ("v", "sigma")) -> DataFrame:
    ok = usable(F.col(flux)) & (F.col(flux) > 0)
    return lines.withColumns({c: F.when(ok, F.col(c)) for c in columns})


def line_table_melt(wide: DataFrame, *, key: str = "bin_id", quantities: Sequence[str]) -> DataFrame:
    """Columns ``QUANTITY_line`` to rows (key, line, quantity, value)."""
    cols = [c for c in wide.columns if any(c.startswith(q + "_") for q in quantities)]
    out = wide.select(key, *cols).unpivot([key], cols, "_c", "value")
    q = F.substring_index("_c", "_", 1)
    return out.select(key, F.expr("substring(_c, locate('_', _c) + 1)").alias("line"), F.lower(q).alias("quantity"), "value")


def line_table_pivot(long: DataFrame, *, key: str = "bin_id", lines: Sequence[str], quantities: Sequence[str]) -> DataFrame:
    """The inverse; line names and quantities are configured, so no job looks for them."""
    cells = [F.max(F.when((F.col("line") == ln) & (F.col("quantity") == q.lower()), F.col("value"))).alias(f"{q}_{ln}") for q in quantities for ln in lines]
    return long.groupBy(key).agg(*cells)


def line_summary(lines: DataFrame) -> DataFrame:
    """Per line: valid velocities and fluxes, medians and ranges of velocity and sigma."""
    out = lines.groupBy("line").agg(
        F.count("v").alias("n_velocity"),
        F.count("flux").alias("n_flux"),
        (F.max("v") - F.min("v")).alias("velocity_range"),
        (F.max("sigma") - F.min("sigma")).alias("sigma_range"),
    )
    for c in ("v", "sigma"):
        out = out.join(quantiles(lines, ["line"], c, {f"median_{c}": 0.5}), "line", "left")
    return out


def line_categories(
    lines: DataFrame, fitted: DataFrame, masks: DataFrame, *, fit_range: tuple[float, float], config_range: tuple[float, float], tolerance: float = 50.0
) -> DataFrame:
    """Every configured line ``(name, wave)`` as fitted, masked, out_of_range or
    missing_wavelength. ``masks`` is ``(centre, width)``."""
    lo, hi = max(fit_range[0] - tolerance, config_range[0]), min(fit_range[1] + tolerance, config_range[1])
    spans = masks.select((F.col("centre") - F.col("width") / 2).alias("lo"), (F.col("centre") + F.col("width") / 2).alias("hi"))
    hit = band_join(lines.where("wave IS NOT NULL").select("name", "wave"), spans, how="left_semi").select("name", F.lit(True).alias("_masked"))
    out = lines.join(fitted.select("name", F.lit(True).alias("_fitted")), "name", "left").join(hit, "name", "left")
    category = (
        F.when(F.col("wave").isNull(), "missing_wavelength")
        .when(F.col("_fitted") & (F.col("wave") > lo) & (F.col("wave") < hi), "fitted")
        .when(F.col("_masked"), "masked")
        .otherwise("out_of_range")
    )
    return out.select("name", category.alias("category"))


def product_consistency(kinematics: DataFrame, lines: DataFrame, categories: DataFrame) -> DataFrame:
    """One row: counts, issues, warnings and the overall status of a product."""
    counts = lines.agg(F.countDistinct("bin_id").alias("line_bins"), (F.max("v") - F.min("v")).alias("velocity_range"))
    cats = categories.agg(
        F.sum(F.when(F.col("category") == "fitted", 1).otherwise(0)).alias("n_fitted"), F.sum(F.when(F.col("category") == "masked", 1).otherwise(0)).alias("n_masked")
    )
    out = kinematics.agg(F.countDistinct("bin_id").alias("bins"))
    for side in (counts, cats):
        packed = side.select(F.struct(*side.columns).alias("p")).scalar()
        out = out.withColumn("_p", packed).select(*out.columns, *[F.col("_p")[c].alias(c) for c in side.columns])
    fit, masked = F.col("n_fitted"), F.col("n_masked")
    issues = F.when(fit == 0, 1).otherwise(0)
    warnings = (
        F.when(F.col("bins") != F.col("line_bins"), 1).otherwise(0)
        + F.when((fit > 0) & (fit < 5), 1).otherwise(0)
        + F.when(masked > fit, 1).otherwise(0)
        + F.when((fit > 1) & (F.col("velocity_range") > 500), 1).otherwise(0)
    )
    out = out.withColumns({"issues": issues, "warnings": warnings})
    return out.withColumn("status", F.when(F.col("issues") > 0, "ERROR").when(F.col("warnings") > 0, "WARNING").otherwise("GOOD"))


def index_report(bins: DataFrame, indices: DataFrame, *, high_sigma: float = 300.0) -> DataFrame:
    """Rows (section, item, n): bins per broadening flag, valid values per index, and the flags
    of bins with a high velocity dispersion."""
    flags = bins.groupBy(F.col("flag").cast("string").alias("item")).agg(F.count("*").alias("n")).withColumn("section", F.lit("flag"))
    high = bins.where(F.col("sigma") > high_sigma).groupBy(F.col("flag").cast("string").alias("item")).agg(F.count("*").alias("n"))
    high = high.withColumn("section", F.lit("high_sigma"))
    valid = indices.groupBy(F.col("name").alias("item")).agg(F.count("index").alias("n")).withColumn("section", F.lit("index"))
    return flags.unionByName(high).unionByName(valid).select("section", "item", "n")
