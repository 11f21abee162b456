"""Operators on the long pixel table ``(spec_id, arm, pix, wave, flux, ivar)``.

Windows run within one spectrum of one arm, a group bounded by the number of detector
pixels. All of them share one hash partitioning by ``(spec_id, arm)``, so a chain of
cleaning steps costs a single shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.exprs import C_KMS, MAD_TO_SIGMA, ratio, usable
from lumenframe.functions.scale import cut, on_keys, quantiles

SPECTRUM = ("spec_id", "arm")
# Error assigned to unusable pixels; its square is the floor of a usable variance.
LARGE_ERROR = 1.0e18
IVAR_FLOOR = 10.0 / LARGE_ERROR**2


def along(keys: Sequence[str] = SPECTRUM, order: str = "pix") -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def whole(keys: Sequence[str] = SPECTRUM) -> Window:
    return Window.partitionBy(*keys)


# --- array form and long form -------------------------------------------------------------


def spectra_to_pixels(df: DataFrame, arrays: Sequence[str], *, index: str = "pix") -> DataFrame:
    """One row per array element; arrays of one row are parallel."""
    others = [c for c in df.columns if c not in arrays]
    zipped = F.posexplode(F.arrays_zip(*[F.col(a) for a in arrays])).alias(index, "_e")
    return df.select(*others, zipped).select(*others, index, *[F.col("_e")[a].alias(a) for a in arrays])


def pixels_to_spectra(pixel: DataFrame, values: Sequence[str], *, keys: Sequence[str] = SPECTRUM, index: str = "pix") -> DataFrame:
    """Back to one row per spectrum, elements in pixel order."""
    packed = F.array_sort(F.collect_list(F.struct(index, *values)))
    out = pixel.groupBy(*keys).agg(packed.alias("_s"))
    return out.select(*keys, *[F.col("_s")[v].alias(v) for v in values])


# --- masks --------------------------------------------------------------------------------


def mask_invalid(pixel: DataFrame) -> DataFrame:
    """ivar 0 where flux or ivar is missing or ivar is negative."""
    ok = usable(F.col("flux")) & usable(F.col("ivar")) & (F.col("ivar") >= 0)
    return pixel.withColumn("ivar", F.when(ok, F.col("ivar")).otherwise(0.0))


def grown(flag: Column, k: int, keys: Sequence[str] = SPECTRUM) -> Column:
    """Flag within ``k`` rows of a flagged row."""
    if k <= 0:
        return F.coalesce(flag, F.lit(False))
    return F.coalesce(F.bool_or(flag).over(along(keys).rowsBetween(-k, k)), F.lit(False))


def dilate_mask(pixel: DataFrame, *, k: int = 3) -> DataFrame:
    return pixel.withColumn("ivar", F.when(grown(F.col("ivar") == 0, k), 0.0).otherwise(F.col("ivar")))


def mask_edges(pixel: DataFrame, *, n: int = 5) -> DataFrame:
    first, last = F.min("pix").over(whole()), F.max("pix").over(whole())
    edge = (F.col("pix") < first + n) | (F.col("pix") > last - n)
    return pixel.withColumn("ivar", F.when(edge, 0.0).otherwise(F.col("ivar")))


def in_bands(x: Column, bands: Sequence[tuple[float, float]]) -> Column:
    inside = F.lit(False)
    for lo, hi in bands:
        inside = inside | x.between(lo, hi)
    return inside


def mask_bands(pixel: DataFrame, bands: Sequence[tuple[float, float]]) -> DataFrame:
    """Zero ivar inside a fixed, short list of wavelength bands (gaps, tellurics)."""
    return pixel.withColumn("ivar", F.when(in_bands(F.col("wave"), bands), 0.0).otherwise(F.col("ivar")))


def cosmic_ray_mask(pixel: DataFrame, *, cut: float = 9.0, wing: int = 1) -> DataFrame:
    """Reject pixels far from the median of three; an edge pixel is its own median."""
    w = along()
    a, b, c = F.lag("flux").over(w), F.col("flux"), F.lead("flux").over(w)
    at_edge = F.lag("pix").over(w).isNull() | F.lead("pix").over(w).isNull()
    med3 = F.greatest(F.least(a, b), F.least(F.greatest(a, b), c))
    # greatest/least skip NULL: a missing neighbour leaves the pixel untested.
    med3 = F.when(at_edge, b).when(a.isNull() | b.isNull() | c.isNull(), b).otherwise(med3)
    spike = F.abs(b - med3) * F.sqrt(F.median("ivar").over(whole())) > cut
    out = pixel.withColumn("_spike", F.coalesce(spike, F.lit(False)))
    return out.withColumn("ivar", F.when(grown(F.col("_spike"), wing), 0.0).otherwise(F.col("ivar"))).drop("_spike")


def neighbours(good: Column, packed: Column, keys: Sequence[str], order: str, tie: Sequence[str] = ()) -> tuple[Column, Column]:
    """Nearest good row at or before, and at or after, each row; ``tie`` puts good rows first
    among rows at one place.

    The second uses a descending window: a frame open to the right would be quadratic.
    """
    value = F.when(good, packed)
    part = Window.partitionBy(*keys)
    frame = (Window.unboundedPreceding, 0)
    before = F.last(value, ignorenulls=True).over(part.orderBy(F.col(order), *tie).rowsBetween(*frame))
    after = F.last(value, ignorenulls=True).over(part.orderBy(F.col(order).desc(), *tie).rowsBetween(*frame))
    return before, after


def interpolated(x: Column, before: Column, after: Column, x_name: str, y_name: str) -> Column:
    """Straight line between two neighbours; the nearest one where only one exists."""
    x0, y0, x1, y1 = before[x_name], before[y_name], after[x_name], after[y_name]
    line = y0 + (y1 - y0) * ratio(x - x0, x1 - x0)
    return F.when(before.isNull(), y1).when(after.isNull(), y0).when(x1 == x0, y0).otherwise(line)


def fill_gaps(
    df: DataFrame, *, value: str = "flux", x: str = "wave", good: Column | None = None, keys: Sequence[str] = SPECTRUM
) -> DataFrame:
    """Linear interpolation across bad rows, the nearest good value at the ends."""
    good = (F.col("ivar") > 0) if good is None else good
    good = good & F.col(value).isNotNull()
    before, after = neighbours(good, F.struct(F.col(x), F.col(value)), keys, x)
    out = df.withColumns({"_before": before, "_after": after})
    filled = interpolated(F.col(x), F.col("_before"), F.col("_after"), x, value)
    any_good = F.col("_before").isNotNull() | F.col("_after").isNotNull()
    return out.withColumn(value, F.when(~good & any_good, filled).otherwise(F.col(value))).drop("_before", "_after")


def gap_islands(pixel: DataFrame, *, flag: Column | None = None, keys: Sequence[str] = SPECTRUM) -> DataFrame:
    """Runs of flagged pixels: first, last, length, whether it touches an end, whether it is
    the largest interior run (the detector gap; the first of equals)."""
    flag = (F.col("ivar") == 0) if flag is None else flag
    rows = pixel.select(*keys, "pix", flag.alias("_f"))
    rows = rows.withColumns({"_lo": F.min("pix").over(whole(keys)), "_hi": F.max("pix").over(whole(keys))}).where("_f")
    rows = rows.withColumn("_run", F.col("pix") - F.row_number().over(along(keys)))
    runs = rows.groupBy(*keys, "_run").agg(
        F.min("pix").alias("first_pix"),
        F.max("pix").alias("last_pix"),
        F.count("*").alias("length"),
        ((F.min("pix") > F.min("_lo")) & (F.max("pix") < F.max("_hi"))).alias("interior"),
    )
    best = Window.partitionBy(*keys, "interior").orderBy(F.col("length").desc(), "first_pix")
    largest = F.col("interior") & (F.row_number().over(best) == 1)
    return runs.select(*keys, "first_pix", "last_pix", "length", "interior", largest.alias("detector_gap"))


# --- moving windows -----------------------------------------------------------------------


def running_mean(value: Column, size: int, keys: Sequence[str] = SPECTRUM) -> Column:
    """Centred mean over ``size`` (odd) rows, the end value repeated beyond the ends."""
    h = size // 2
    w = along(keys)
    inside = F.sum(value).over(w.rowsBetween(-h, h))
    rank, n = F.row_number().over(w), F.count(F.lit(1)).over(whole(keys))
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.greatest(F.lit(0), F.lit(h + 1) - rank)
    right = F.greatest(F.lit(0), rank + h - n)
    return (inside + left * F.first(value).over(full) + right * F.last(value).over(full)) / float(size)


def continuum_subtract(pixel: DataFrame, *, value: str = "flux", window: int = 151, keys: Sequence[str] = SPECTRUM) -> DataFrame:
    return pixel.withColumn("continuum", running_mean(F.col(value), window, keys)).withColumn("resid", F.col(value) - F.col("continuum"))


def continuum_robust(
    pixel: DataFrame, *, value: str = "flux", window: int = 151, rounds: int = 2, clip: float = 4.0, keys: Sequence[str] = SPECTRUM
) -> DataFrame:
    """Running mean refitted after clipping residuals at ``clip`` robust sigmas."""
    out = pixel.withColumn("_m", F.lit(1.0))
    for _ in range(rounds):
        num = running_mean(F.col(value) * F.col("_m"), window, keys)
        den = running_mean(F.col("_m"), window, keys)
        out = out.withColumns({"_num": num, "_den": den})
        cont = F.when(F.col("_den") > 0, F.col("_num") / F.col("_den")).otherwise(0.0)
        out = out.withColumn("continuum", cont).withColumn("resid", F.col(value) - F.col("continuum"))
        out = out.withColumn("_dev", F.abs(F.col("resid") - F.median("resid").over(whole(keys))))
        sigma = F.median("_dev").over(whole(keys)) * MAD_TO_SIGMA + 1e-6
        out = out.withColumn("_m", F.when(F.col("_dev") < sigma * clip, 1.0).otherwise(0.0))
    return out.drop("_m", "_num", "_den", "_dev")


def despike_ivar(pixel: DataFrame, *, window: int = 5, cap: float = 3.0, keys: Sequence[str] = SPECTRUM) -> DataFrame:
    return pixel.withColumn("ivar", F.least(F.col("ivar"), running_mean(F.col("ivar"), window, keys) * cap))


def sky_valley_mask(
    pixel: DataFrame,
    *,
    pixel_scale: float,
    start: float = 8200.0,
    narrow_width: float = 50.0,
    wide_width: float = 300.0,
    min_narrow: int = 51,
    min_wide: int = 151,
    threshold: float = 0.5,
    wing: int = 5,
) -> DataFrame:
    """Mask valleys of the inverse variance redward of ``start``.

    ``pixel_scale`` is the wavelength step of the arm. The background is the larger of two
    running means over the gap-filled inverse variance. Arms with fewer red pixels than the
    wide window stay unchanged.
    """
    narrow = max(min_narrow, int(narrow_width / pixel_scale)) | 1
    wide = max(min_wide, int(wide_width / pixel_scale)) | 1
    # The part redward of the start is a group of its own within each spectrum, so the mask
    # needs no second pass over the pixels.
    keys = (*SPECTRUM, "_red")
    out = pixel.withColumn("_red", F.coalesce(F.col("wave") >= start, F.lit(False)))
    out = out.withColumns({"_n": F.count(F.lit(1)).over(whole(keys)), "_fill": F.col("ivar")})
    out = fill_gaps(out, value="_fill", x="pix", good=F.col("ivar") > 0, keys=keys)
    out = out.withColumn("_bg", F.greatest(running_mean(F.col("_fill"), narrow, keys), running_mean(F.col("_fill"), wide, keys)))
    valley = (F.col("ivar") > 0) & (F.col("_bg") > 1e-10) & (F.col("ivar") < F.col("_bg") * threshold)
    out = out.withColumn("_valley", F.col("_red") & valley & (F.col("_n") >= wide))
    out = out.withColumn("ivar", F.when(grown(F.col("_valley"), wing, keys), 0.0).otherwise(F.col("ivar")))
    return out.select(*pixel.columns)


def broaden_variable(spectra: DataFrame, *, truncate: float = 4.0, value: str = "flux", sigma: str = "sigma") -> DataFrame:
    """Gaussian of a width per pixel over parallel arrays, one spectrum per row.

    Kernel cut at ``truncate`` sigma and renormalised, end value repeated, NULL spreads only
    inside a kernel; sigma of 0.001 pixel or less leaves the pixel as it is.
    """
    v, s = F.col(value), F.col(sigma)
    n = F.size(v)

    def one(i: Column) -> Column:
        sg = F.get(s, i)
        reach = F.floor(sg * truncate).cast("int")
        offsets = F.sequence(-reach, reach)

        def weight(o: Column) -> Column:
            return F.exp(-0.5 * (o / sg) * (o / sg))

        def sample(o: Column) -> Column:
            return F.get(v, F.greatest(F.lit(0), F.least(n - 1, i + o)))

        # Each tap as (weight * sample, weight), summed together so that the weight is computed once.
        taps = F.transform(offsets, lambda o: F.struct(weight(o).alias("w"), sample(o).alias("f")))
        start = F.struct(F.lit(0.0).alias("top"), F.lit(0.0).alias("low"))
        both = F.aggregate(
            taps, start, lambda acc, p: F.struct((acc["top"] + p["w"] * p["f"]).alias("top"), (acc["low"] + p["w"]).alias("low")), lambda acc: acc["top"] / acc["low"]
        )
        return F.when(sg > 1e-3, both).otherwise(F.get(v, i))

    return spectra.withColumn(value, F.transform(F.sequence(F.lit(0), n - 1), one))


# --- corrections --------------------------------------------------------------------------


def apply_sensitivity(pixel: DataFrame, sens: DataFrame, *, on: Sequence[str] = ("arm", "pix")) -> DataFrame:
    """flux * s, ivar / s^2; a missing sensitivity masks the pixel."""
    out = pixel.join(sens, list(on), "left")
    ok = usable(F.col("sens"))
    flux = F.when(ok, F.col("flux") * F.col("sens"))
    ivar = F.when(ok, ratio(F.col("ivar"), F.col("sens") * F.col("sens"))).otherwise(0.0)
    return out.withColumns({"flux": flux, "ivar": ivar}).drop("sens")


def apply_arms_ratio(pixel: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """flux * r, ivar / r^2 with one ratio per arm; arms not named stay unchanged."""
    r = F.lit(1.0)
    for arm, value in ratios.items():
        r = F.when(F.col("arm") == arm, float(value)).otherwise(r)
    return pixel.withColumns({"flux": F.col("flux") * r, "ivar": F.col("ivar") / (r * r)})


def deredden(pixel: DataFrame, transmission: DataFrame, *, step: float) -> DataFrame:
    """flux / T, ivar * T^2 with T interpolated in a transmission table.

    ``transmission`` has ``(spec_id, wave, t)`` on a grid of spacing ``step``; pixels whose T
    is missing or not positive stay unchanged.
    """
    from lumenframe.operators.ranges import interp_at

    curves = transmission.select(F.col("spec_id").alias("curve_id"), "wave", F.col("t").alias("value"))
    asked = pixel.withColumn("curve_id", F.col("spec_id"))
    out = interp_at(asked, curves, x="wave", step=step, name="_t")
    ok = F.coalesce(usable(F.col("_t")) & (F.col("_t") > 0), F.lit(False))
    return out.withColumns(
        {
            "flux": F.when(ok, F.col("flux") / F.nullif(F.col("_t"), F.lit(0.0))).otherwise(F.col("flux")),
            "ivar": F.when(ok, F.col("ivar") * F.col("_t") * F.col("_t")).otherwise(F.col("ivar")),
        }
    ).select(*pixel.columns)


def to_rest_frame(pixel: DataFrame, redshift: DataFrame, *, fwhm: str | None = None) -> DataFrame:
    """Wavelength, and FWHM where given, divided by 1 + z; spectra without z are dropped."""
    out = pixel.join(redshift.select("spec_id", "z"), "spec_id")
    cols = {"wave": F.col("wave") / (F.col("z") + 1.0)}
    if fwhm:
        cols[fwhm] = F.col(fwhm) / (F.col("z") + 1.0)
    return out.withColumns(cols)


def line_mask_pixels(
    pixel: DataFrame,
    lines: Sequence[tuple[str, float, float]],
    *,
    lsf: Column,
    z: str = "z",
    log_start: float,
    log_step: float,
    safety: float = 2.5,
    error_limit: float | None = None,
) -> DataFrame:
    """Pixels outside all line masks.

    ``lines`` is the configured list (name, wavelength, base width). Sky and telluric lines
    move to the rest frame. The width is sqrt(base^2 + LSF^2) * safety, and pixels within
    three sigma of the centre, in log-wavelength pixels, are dropped. The list is part of the
    configuration, so each row tests it directly and nothing is shuffled.
    """
    masked = F.lit(False)
    for name, wave, width in lines:
        sky = "sky" in name.lower() or "telluric" in name.lower()
        centre = (F.lit(float(wave)) / (F.col(z) + 1.0)) if sky else F.lit(float(wave))
        total = F.sqrt(F.lit(float(width) ** 2) + lsf * lsf) * safety
        # log_step * c is the velocity scale of a pixel, so c cancels.
        reach = 3.0 * (total / 2.355) / centre / log_step
        middle = F.ceil((F.log(centre) - log_start) / log_step)
        masked = masked | F.col("pix").between(middle - reach, middle + reach)
    out = pixel.where(~masked)
    if error_limit is not None:
        error = F.when(F.col("ivar") > 0, 1.0 / F.sqrt(F.col("ivar")))
        out = out.where(error < 0.95 * error_limit**0.5)
    return out


def broadening_needed(
    pixel: DataFrame, *, target: float, sigma_v: str = "sigma_v", lsf: str = "lsf", step: float, adaptive: bool = False, keys: Sequence[str] = ("spec_id",)
) -> DataFrame:
    """Extra Gaussian width in pixels to reach the target resolution, and a flag per spectrum:
    1 if the target is already exceeded somewhere, 2 if more than 100 pixels are needed."""
    losvd = F.col(sigma_v) * F.col("wave") / C_KMS * 2.355
    out = pixel.withColumn("total", F.sqrt(F.col(lsf) * F.col(lsf) + losvd * losvd))
    out = out.withColumn("_max", F.max("total").over(whole(keys)))
    exceeded = F.col("_max") > target
    goal = F.when(exceeded, F.ceil(F.col("_max") * 1.1)).otherwise(target) if adaptive else F.lit(target)
    diff = F.sqrt(F.greatest(goal * goal - F.col("total") * F.col("total"), F.lit(0.0)))
    out = out.withColumn("sigma_pix", diff / 2.355 / step)
    most = F.max("sigma_pix").over(whole(keys))
    flag = F.when(most > 100, 2).when(exceeded, 1).otherwise(0)
    return out.withColumn("flag", flag).drop("_max")


# --- per-spectrum numbers and stacks ------------------------------------------------------


def spectrum_snr(pixel: DataFrame, *, keys: Sequence[str] = SPECTRUM) -> DataFrame:
    """Mean of flux * sqrt(ivar) over usable pixels; NULL unless half of the pixels are good."""
    usable_px = (F.col("ivar") > IVAR_FLOOR) & F.col("flux").isNotNull()
    return pixel.groupBy(*keys).agg(
        F.when(
            F.sum(F.when(F.col("ivar") > 0, 1).otherwise(0)) * 2 >= F.count("*"),
            F.avg(F.when(usable_px, F.col("flux") * F.sqrt("ivar"))),
        ).alias("snr"),
        F.sum(F.when(usable_px, 1).otherwise(0)).alias("n_good"),
    )


def with_snr(pixel: DataFrame, *, keys: Sequence[str] = SPECTRUM) -> DataFrame:
    """The same SNR as a column of every pixel; no second pass and no join."""
    good = F.sum(F.when(F.col("ivar") > 0, 1).otherwise(0)).over(whole(keys))
    mean = F.avg(F.when(F.col("ivar") > IVAR_FLOOR, F.col("flux") * F.sqrt("ivar"))).over(whole(keys))
    return pixel.withColumn("snr", F.when(good * 2 >= F.count(F.lit(1)).over(whole(keys)), mean))


def signal_noise(pixel: DataFrame, *, keys: Sequence[str] = ("spec_id",)) -> DataFrame:
    """Mean flux, root mean square error and their ratio over usable pixels."""
    ok = (F.col("ivar") > IVAR_FLOOR) & F.col("flux").isNotNull()
    out = pixel.groupBy(*keys).agg(
        F.avg(F.when(ok, F.col("flux"))).alias("signal"), F.sqrt(F.avg(F.when(ok, 1.0 / F.col("ivar")))).alias("noise")
    )
    return out.withColumn("snr", ratio(F.col("signal"), F.col("noise")))


def coadd_ivar(pixel: DataFrame, groups: DataFrame, *, group: str = "grp") -> DataFrame:
    """Inverse-variance stack of the spectra of each group, per arm and pixel.

    Keys are (group, arm, pixel): one huge group spreads over all its pixels, and partial sums
    leave one row per task and key for the shuffle.
    """
    f = F.coalesce(F.col("flux"), F.lit(0.0)) * F.col("ivar")
    out = (
        pixel.join(groups.select("spec_id", group), "spec_id")
        .groupBy(group, "arm", "pix")
        .agg(F.avg("wave").alias("wave"), F.sum(f).alias("_fw"), F.sum("ivar").alias("ivar"))
    )
    flux = F.when(F.col("ivar") != 0, F.col("_fw") / F.nullif(F.col("ivar"), F.lit(0.0))).otherwise(0.0)
    return out.withColumn("flux", flux).drop("_fw")


def ivar_balance(pixel: DataFrame, *, mode: str = "balanced", obs: Sequence[str] = ()) -> DataFrame:
    """Weight per arm so that arms contribute equally, applied to ivar.

    One row per (observation, arm) remains after the first aggregation, so the averages over
    arms are taken on a table of a few rows per observation.
    """
    keys = [*obs, "arm"]
    good = F.col("ivar") > 0
    totals = pixel.groupBy(*keys).agg(F.sum(F.when(good, F.col("ivar"))).alias("s"), F.sum(F.when(good, 1)).alias("n"))
    arms = Window.partitionBy(*(obs or [F.lit(0)]))
    balanced = F.avg("s").over(arms) / F.col("s")
    pixels = F.avg(F.col("s") / F.col("n")).over(arms) * F.col("n") / F.col("s")
    weight = {"balanced": balanced, "pixels": pixels, "hybrid": F.sqrt(balanced * pixels)}[mode]
    weight = F.when(F.count("*").over(arms) < 2, 1.0).otherwise(weight)
    table = totals.select(*keys, weight.alias("ivar_weight"))
    return pixel.join(table, keys, "left").withColumn("ivar", F.col("ivar") * F.col("ivar_weight"))


def join_arms(pixel: DataFrame, *, order: Sequence[str], max_jump: float = 0.2, bad_mask: tuple[float, float] | None = None, split: bool = False) -> DataFrame:
    """Arms joined from blue to red into one spectrum per ``spec_id``: own pixels outside the overlap,
    inside both are interpolated to a common grid and averaged by inverse variance; if their median
    fluxes differ by more than ``max_jump`` the overlap is zeroed (and ``bad_mask`` masked). A gap
    is filled with zeros.

    With ``split`` the arms stay apart (column ``arm``): they are cut at the mean wavelength of the
    common grid, so both sides carry the combined overlap; arms that do not overlap stay as they are.
    """
    columns = ["spec_id", "wave", "flux", "ivar"]
    done, finished = pixel.where(F.col("arm") == order[0]).select(*columns), []
    for before, arm in zip(order, order[1:]):
        joined = _join_two(done, pixel.where(F.col("arm") == arm).select(*columns), max_jump, bad_mask)
        if split:
            # Cut here: both sides are read, and the red one goes on to the next arm.
            joined = cut(joined.where("_side IS NOT NULL"))
            finished.append(joined.where("_side = 'b'").select(F.lit(before).alias("arm"), *columns))
            joined = joined.where("_side = 'r'")
        done = joined.select(*columns)
    by = ["spec_id"]
    if split:
        by, done = ["spec_id", "arm"], done.select(F.lit(order[-1]).alias("arm"), *columns)
        for part in finished:
            done = part.unionByName(done)
    w = Window.partitionBy(*by).orderBy("wave")
    return done.withColumn("pix", (F.row_number().over(w) - 1).cast("int"))


def _join_two(blue: DataFrame, red: DataFrame, max_jump: float, bad_mask: tuple[float, float] | None) -> DataFrame:
    """One shuffle by spectrum: windows find the arm ends, the first row of each spectrum
    brings the grid points of both arms along, and further windows interpolate and combine."""
    both = blue.withColumn("side", F.lit("b")).unionByName(red.withColumn("side", F.lit("r")))
    is_b, is_r = F.col("side") == "b", F.col("side") == "r"
    spec = Window.partitionBy("spec_id")
    wave = F.col("wave")
    both = both.withColumns(
        {
            "_bhi": F.max(F.when(is_b, wave)).over(spec),
            "_rlo": F.min(F.when(is_r, wave)).over(spec),
            "_blo": F.min(F.when(is_b, wave)).over(spec),
            "_rhi": F.max(F.when(is_r, wave)).over(spec),
            "_nb": F.sum(F.when(is_b, 1).otherwise(0)).over(spec),
            "_nr": F.sum(F.when(is_r, 1).otherwise(0)).over(spec),
            "_first": F.row_number().over(spec.orderBy("side", "wave")) == 1,
        }
    )
    step = 0.5 * (
        ratio(F.col("_bhi") - F.col("_blo"), (F.col("_nb") - 1).cast("double")) + ratio(F.col("_rhi") - F.col("_rlo"), (F.col("_nr") - 1).cast("double"))
    )
    both = both.withColumns(
        {
            "_start": F.max(F.when(is_b & (wave < F.col("_rlo")), wave)).over(spec),
            "_end": F.min(F.when(is_r & (wave > F.col("_bhi")), wave)).over(spec),
            "_step": step,
            "_over": F.coalesce(F.col("_bhi") > F.col("_rlo"), F.lit(False)),
        }
    )
    # Own pixels keep k = -1; samples of the overlap have k = -2 and serve the interpolation.
    own = F.coalesce((is_b & (wave < F.col("_rlo"))) | (is_r & (wave > F.col("_bhi"))), F.lit(True))
    none = F.lit(None).cast("double")
    row = F.struct("side", F.when(own, -1).otherwise(-2).alias("k"), wave.alias("wave"), F.col("flux").cast("double").alias("flux"), F.col("ivar").cast("double").alias("ivar"))
    n = F.floor((F.col("_end") - F.col("_start")) / F.col("_step") + 0.5).cast("int") - 1
    lo, hi = F.col("_start") + F.col("_step"), F.col("_end") - F.col("_step")
    at = lambda k: lo + F.when(n > 1, (hi - lo) * k / F.nullif(n - 1, F.lit(0))).otherwise(0.0)

    def points(name: str) -> Column:
        return F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda k: F.struct(F.lit(name).alias("side"), k.alias("k"), at(k).alias("wave"), none.alias("flux"), none.alias("ivar")),
        )

    more = F.when(F.col("_first") & (n >= 1), F.concat(points("b"), points("r")))
    rows = both.select("spec_id", "_over", F.explode(F.concat(F.array(row), F.coalesce(more, F.array().cast("array<struct<side:string,k:int,wave:double,flux:double,ivar:double>>")))).alias("e"))
    rows = rows.select("spec_id", "_over", "e.*")
    good = (F.col("k") == -2) & F.col("flux").isNotNull()
    before, after = neighbours(good, F.struct("wave", "flux", "ivar"), ("spec_id", "side"), "wave", tie=("k",))
    rows = rows.withColumns({"_bf": before, "_af": after}).where("k >= -1")
    grid = F.col("k") >= 0
    rows = rows.withColumns(
        {
            "flux": F.when(grid, interpolated(wave, F.col("_bf"), F.col("_af"), "wave", "flux")).otherwise(F.col("flux")),
            "ivar": F.when(grid, interpolated(wave, F.col("_bf"), F.col("_af"), "wave", "ivar")).otherwise(F.col("ivar")),
        }
    )
    weight = F.when(F.col("ivar") == 0, 1.0 / LARGE_ERROR**2).otherwise(F.col("ivar"))
    single = F.when(F.col("k") == -1, wave)
    out = rows.withColumn("_own", single).groupBy("spec_id", "k", "_own", "_over").agg(
        F.min("wave").alias("wave"),
        ratio(F.sum(F.col("flux") * weight), F.sum(weight)).alias("_mix"),
        F.sum(weight).alias("_sum"),
        F.max("flux").alias("_flux"),
        F.max("ivar").alias("_ivar"),
        F.max(F.when(grid & is_b, F.col("flux"))).alias("_fb"),
        F.max(F.when(grid & is_r, F.col("flux"))).alias("_fr"),
        F.min("side").alias("_from"),
    )
    # The side of a spectrum cut in two: at the middle of an overlap, else as it was; the points
    # that fill a gap belong to none.
    middle = F.avg(F.when(grid, wave)).over(spec)
    side = F.when(F.col("_over"), F.when(wave < middle, "b").otherwise("r")).when(~grid, F.col("_from"))
    out = out.withColumn("_side", side)
    mb, mr = F.median("_fb").over(spec), F.median("_fr").over(spec)
    bad = F.col("_over") & (F.abs(mb - mr) / F.greatest(mb, mr, F.lit(1e-10)) > max_jump)
    out = out.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    keep = F.col("_over") & ~F.col("_bad")
    flux = F.when(~grid, F.col("_flux")).when(keep, F.col("_mix")).otherwise(0.0)
    ivar = F.when(~grid, F.col("_ivar")).when(keep, F.col("_sum")).otherwise(0.0)
    if bad_mask is not None:
        ivar = F.when(F.col("_bad") & wave.between(*bad_mask), 0.0).otherwise(ivar)
    return out.select("spec_id", "wave", flux.alias("flux"), ivar.alias("ivar"), "_side")


def clean_spectra(
    pixel: DataFrame,
    *,
    crop: dict[str, tuple[float, float]] | None = None,
    gap_wing: int = 0,
    fixed_gaps: Sequence[tuple[float, float]] = (),
    edge: int = 0,
    tellurics: Sequence[tuple[float, float]] = (),
    fill: bool = True,
    cosmic: bool = True,
    sens: DataFrame | None = None,
    transmission: DataFrame | None = None,
    transmission_step: float = 100.0,
    ratios: dict[str, float] | None = None,
    valley: dict | None = None,
    balance: str | None = None,
) -> DataFrame:
    """The fixed order of cleaning: crop, invalid, gaps, fixed gaps, edges, tellurics, fill,
    cosmic rays, sensitivity, extinction, arms ratio; the SNR follows as a column. Then the valleys
    of sky residuals (``valley``: the arguments of ``sky_valley_mask``) and the ivar balance of the
    arms (``balance``: the mode of ``ivar_balance``), which sees what the valleys left."""
    out = pixel
    if crop:
        keep = F.lit(False)
        for arm, (lo, hi) in crop.items():
            keep = keep | ((F.col("arm") == arm) & (F.col("wave") >= lo) & (F.col("wave") < hi))
        out = out.where(keep)
    out = mask_invalid(out)
    if gap_wing:
        out = dilate_mask(out, k=gap_wing)
    if fixed_gaps:
        out = mask_bands(out, fixed_gaps)
    if edge:
        out = mask_edges(out, n=edge)
    if tellurics:
        out = mask_bands(out, tellurics)
    if fill:
        out = fill_gaps(out)
    if cosmic:
        out = cosmic_ray_mask(out)
    if sens is not None:
        out = apply_sensitivity(out, sens)
    if transmission is not None:
        out = deredden(out, transmission, step=transmission_step)
    if ratios:
        out = apply_arms_ratio(out, ratios)
    out = with_snr(out)
    if valley is not None:
        out = sky_valley_mask(out, **valley)
    if balance is not None:
        out = ivar_balance(out, mode=balance)
    return out


def _centre(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Median, standard deviation and number of the values ``_x`` of each key."""
    spread = rows.groupBy(*keys).agg(F.stddev_pop("_x").alias("sigma"), F.count("*").alias("n"))
    return cut(quantiles(rows, keys, "_x", {"median": 0.5}).join(spread, list(keys)))


def clipped_centre(values: DataFrame, *, value: str, sigma: float = 3.0, rounds: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, median, sigma, n, n_all)`` after clipping about the median, a row per key.

    All keys go through a round in one plan. A key whose clip removed nothing is done and leaves
    the loop with its rows, so the rounds work on what is still moving, and their number is that
    of the slowest key, not of the keys. Medians are distributed order statistics: one key may
    hold all values.
    """
    names = [*keys] or ["_one"]
    rows = values.select(*[F.col(k) for k in keys], *([F.lit(0).alias("_one")] if not keys else []), F.col(value).alias("_x")).where(F.col("_x").isNotNull())
    rows = cut(rows)
    every, done, before = rows.groupBy(*names).agg(F.count("*").alias("n_all")), [], None
    for _ in range(rounds):
        now = _centre(rows, names)
        going = now
        if before is not None:
            seen = now.join(before.select(*names, F.col("n").alias("_before")), names)
            done.append(seen.where(F.col("n") == F.col("_before")).drop("_before"))
            going = seen.where(F.col("n") != F.col("_before")).drop("_before")
            if going.isEmpty():
                break
        kept = rows.join(going.select(*names, "median", "sigma"), names)
        rows = cut(kept.where(F.abs(F.col("_x") - F.col("median")) <= F.col("sigma") * sigma).select(*names, "_x"))
        before = now
    else:
        done.append(_centre(rows, names))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.join(every, names).select(*keys, "median", "sigma", "n", "n_all")


def arm_ratios(
    pixel: DataFrame, snr: DataFrame, *, blue: str = "BLUE", red: str = "RED", lo: float | Column, hi: float | Column, min_snr: float = 5.0, min_pixels: int = 5, keys: Sequence[str] = ()
) -> DataFrame:
    """Ratio of the inverse-variance mean fluxes of two arms inside the trimmed overlap; a
    spectrum belongs to one of the ``keys``."""
    worst = snr.where(F.col("arm").isin(blue, red)).groupBy("spec_id").agg(F.min("snr").alias("min_snr"), F.count("snr").alias("_k"))
    worst = worst.where((F.col("min_snr") >= min_snr) & (F.col("_k") == 2))
    good = (F.col("ivar") > 0) & F.col("flux").isNotNull()
    part = pixel.where(F.col("wave").between(lo, hi) & good)

    def total(arm: str, x: Column) -> Column:
        return F.sum(F.when(F.col("arm") == arm, x))

    w = F.col("ivar")
    sums = part.groupBy(*keys, "spec_id").agg(
        ratio(total(blue, F.col("flux") * w), total(blue, w)).alias("fb"),
        ratio(total(red, F.col("flux") * w), total(red, w)).alias("fr"),
        F.sum(F.when(F.col("arm") == blue, 1).otherwise(0)).alias("nb"),
        F.sum(F.when(F.col("arm") == red, 1).otherwise(0)).alias("nr"),
    )
    out = sums.join(worst, "spec_id").where((F.least("nb", "nr") >= min_pixels) & (F.col("fb") > 0) & (F.col("fr") > 0))
    out = out.withColumn("ratio", F.col("fb") / F.nullif(F.col("fr"), F.lit(0.0)))
    return out.where(F.col("ratio").between(0.3, 10.0)).select(*keys, "spec_id", "ratio")


def arms_ratio(
    pixel: DataFrame, snr: DataFrame, *, clip: float = 3.0, trim: float = 50.0, blue: str = "BLUE", red: str = "RED", keys: Sequence[str] = (), **kw
) -> DataFrame:
    """Final flux ratio of two arms with its spread and a quality grade, for each observation that
    ``keys`` tell apart."""
    keys = list(keys)
    lowest, highest = F.min(F.when(F.col("arm") == red, F.col("wave"))), F.max(F.when(F.col("arm") == blue, F.col("wave")))
    ends = pixel.groupBy(*keys).agg((lowest + trim).alias("_from"), (highest - trim).alias("_to"))
    ratios = arm_ratios(on_keys(pixel, ends, keys), snr, blue=blue, red=red, lo=F.col("_from"), hi=F.col("_to"), keys=keys, **kw)
    out = clipped_centre(ratios, value="ratio", sigma=clip, keys=keys)
    grade = F.when(F.col("sigma") < 0.02, "excellent").when(F.col("sigma") < 0.04, "good").when(F.col("sigma") < 0.06, "fair").otherwise("poor")
    return out.withColumn("quality", grade)
