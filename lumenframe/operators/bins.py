"""Binning of spaxels ``(target_id, field, x, y, signal, noise, snr)`` and bin statistics.

Group keys are (field, bin) or (bin, pixel): a bright field spreads over its bins. Statistics
of a whole field come from combinable aggregates or distributed order statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.exprs import ratio, usable
from lumenframe.functions.scale import cut, measured, next_value, number_rows, on_keys, quantiles, top_rows


def bin_spectra_sum(pixel: DataFrame, bins: DataFrame | None = None, *, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of flux and of variance per bin and pixel, for each of ``keys`` (such as the arm);
    without a map every spectrum is a bin."""
    rows = pixel.withColumn("bin_id", F.col("spec_id")) if bins is None else pixel.join(bins.select("spec_id", "bin_id"), "spec_id")
    return rows.groupBy(*keys, "bin_id", "pix").agg(F.sum("flux").alias("flux"), F.sum("var").alias("var"))


def grid_assign(spaxel: DataFrame, *, size: float, min_snr: float, keys: Sequence[str] = ("field",)) -> DataFrame:
    """Valid spaxels with the number of their square bin, row by row over the padded extent."""
    keys = list(keys)
    ok = (F.col("snr") >= 0.9 * min_snr) & (F.col("signal") > 0) & (F.col("noise") > 0) & usable(F.col("signal")) & usable(F.col("noise"))
    rows = spaxel.where(ok)
    pad = 0.01 * size
    extent = measured(
        rows.groupBy(*keys).agg(
            (F.min("x") - pad).alias("_x0"), (F.max("x") + pad).alias("_x1"), (F.min("y") - pad).alias("_y0"), (F.max("y") + pad).alias("_y1")
        )
    )
    rows = on_keys(rows, extent, keys)
    nx, ny = F.ceil((F.col("_x1") - F.col("_x0")) / size), F.ceil((F.col("_y1") - F.col("_y0")) / size)
    ix = F.least(F.floor((F.col("x") - F.col("_x0")) / size), nx - 1)
    iy = F.least(F.floor((F.col("y") - F.col("_y0")) / size), ny - 1)
    return rows.withColumn("bin_id", iy * nx + ix).drop("_x0", "_x1", "_y0", "_y1")


def grid_bin(assigned: DataFrame, *, keys: Sequence[str] = ("field",), id: str = "target_id", last: Sequence[str] = ()) -> DataFrame:
    """One row per filled bin: mean position, summed signal, quadratic noise, members, and the
    metadata of the last member. The members themselves are the rows of ``grid_assign``."""
    out = assigned.groupBy(*keys, "bin_id").agg(
        F.avg("x").alias("x"),
        F.avg("y").alias("y"),
        F.sum("signal").alias("signal"),
        F.sqrt(F.sum(F.col("noise") * F.col("noise"))).alias("noise"),
        F.count("*").alias("n_members"),
        F.max(id).alias("last_member"),
        *[F.max_by(c, id).alias(c) for c in last],
    )
    return out.withColumn("snr", ratio(F.col("signal"), F.col("noise")))


def bin_provenance(spaxel: DataFrame, kept_by_flux: DataFrame, assigned: DataFrame, *, id: str = "target_id") -> DataFrame:
    """Every original spaxel with its bin, -1 if the flux filter removed it, -999 if the SNR
    filter did."""
    out = spaxel.select(id).join(kept_by_flux.select(id, F.lit(1).alias("_f")), id, "left")
    out = out.join(assigned.select(id, "bin_id"), id, "left")
    code = F.when(F.col("_f").isNull(), -1).otherwise(F.coalesce("bin_id", F.lit(-999)))
    return out.select(id, code.cast("bigint").alias("bin_id"))


def bin_sn_covariance(spaxel: DataFrame, *, covariance: float, keys: Sequence[str] = ("bin_id",)) -> DataFrame:
    """Bin SNR with the empirical correction for correlated noise."""
    sn = F.sum("signal") / F.sqrt(F.sum(F.col("noise") * F.col("noise")))
    return spaxel.groupBy(*keys).agg((sn / (F.log10(F.count("*").cast("double")) * covariance + 1.0)).alias("sn"), F.count("*").alias("n"))


def spaxels_per_bin(spaxel: DataFrame, *, keys: Sequence[str] = ("bin_id",)) -> DataFrame:
    return spaxel.groupBy(*keys).agg(F.count("*").alias("n_spaxels"))


def cube_block_bin(voxel: DataFrame, *, block: int, nx: int, ny: int, min_valid: float = 0.8, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of flux over block x block pixels; ivar from summed variances; blocks with too few
    valid pixels are masked, partial trailing blocks dropped."""
    rows = voxel.where((F.col("iy") < ny - ny % block) & (F.col("ix") < nx - nx % block))
    ok = F.col("ivar") > 0
    out = rows.groupBy(*keys, "iw", F.floor(F.col("iy") / block).alias("bin_y"), F.floor(F.col("ix") / block).alias("bin_x")).agg(
        F.sum(F.when(ok, F.col("data"))).alias("f"), F.sum(F.when(ok, 1.0 / F.col("ivar"))).alias("v"), F.sum(F.when(ok, 1).otherwise(0)).alias("n_valid")
    )
    good = F.col("n_valid") >= min_valid * block * block
    ivar = F.when(good & (F.col("v") > 0), 1.0 / F.nullif(F.col("v"), F.lit(0.0))).otherwise(0.0)
    return out.select(*keys, "iw", "bin_y", "bin_x", F.when(good, F.coalesce("f", F.lit(0.0))).otherwise(0.0).alias("data"), ivar.alias("ivar"), "n_valid")


def lambda_r(spaxel: DataFrame, result: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Specific angular momentum proxy per bin; velocities relative to their median over bins."""
    keys = list(keys)
    rel = on_keys(result, measured(quantiles(result, keys, "v", {"_vm": 0.5})), keys).withColumn("_v", F.col("v") - F.col("_vm"))
    rows = spaxel.join(rel.select(*keys, "bin_id", "_v", "sigma"), [*keys, "bin_id"])
    weight = F.col("signal") * F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    top = F.sum(weight * F.abs("_v"))
    low = F.sum(weight * F.sqrt(F.col("_v") * F.col("_v") + F.col("sigma") * F.col("sigma")))
    return rows.groupBy(*keys, "bin_id").agg(F.when(low > 0, top / F.nullif(low, F.lit(0.0))).alias("lambda_r"))


def adaptive_flux_filter(
    spaxel: DataFrame,
    *,
    mode: str = "safe",
    snr: float = 3.0,
    percentile: float = 2.0,
    delta: float = 2.0,
    min_zone: int = 10,
    min_keep: float = 0.1,
    keys: Sequence[str] = ("field",),
    id: str = "target_id",
) -> DataFrame:
    """Spaxels kept by the flux filter, with the ``method`` that decided for their field.

    All candidate thresholds of a field (medians inside SNR zones, a percentile of positive
    signal) are computed together; the first that has enough zone members, and in safe mode
    keeps enough spaxels, wins. If the winner keeps too few, the brightest are kept instead.
    """
    keys = list(keys)
    if mode == "none":
        return spaxel.withColumn("method", F.lit("none"))
    zones = {"safe": (2.0, 3.0, 5.0), "transition": (delta,), "percentile": ()}[mode]
    off = F.abs(F.col("signal") / F.col("noise") - snr)
    table = spaxel.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.sum(F.when(off <= z, 1).otherwise(0)).alias(f"_n{i}") for i, z in enumerate(zones)])
    if zones:
        # A spaxel belongs to every zone it is close enough for; one call gives all medians.
        member = F.array_compact(F.array(*[F.when(off <= z, F.lit(i)) for i, z in enumerate(zones)]))
        mid = quantiles(spaxel.select(*keys, "signal", F.explode(member).alias("_z")), [*keys, "_z"], "signal", {"_t": 0.5})
        mid = mid.groupBy(*keys).agg(*[F.max(F.when(F.col("_z") == i, F.col("_t"))).alias(f"_t{i}") for i in range(len(zones))])
        table = table.join(mid, keys, "left")
    table = table.join(quantiles(spaxel.where("signal > 0"), keys, "signal", {"_tp": percentile / 100.0}), keys, "left")
    table = measured(table)
    rows = on_keys(spaxel, table, keys)
    names = [f"_t{i}" for i in range(len(zones))] + ["_tp"]
    kept = rows.groupBy(*keys).agg(*[F.sum(F.when(F.col("signal") >= F.col(t), 1).otherwise(0)).alias("_k" + t) for t in names])
    choice = table.join(kept, keys).withColumn("_min", F.greatest(F.floor(F.col("_n") * min_keep), F.lit(1)))
    pick = F.when(F.col("_tp").isNull(), F.struct(F.lit("keep_all").alias("m"), F.lit(float("-inf")).alias("t"), F.col("_n").alias("k"))).otherwise(
        F.struct(F.lit("percentile").alias("m"), F.col("_tp").alias("t"), F.col("_k_tp").alias("k"))
    )
    for i in reversed(range(len(zones))):
        ok = F.col(f"_n{i}") >= min_zone
        if mode == "safe":
            ok = ok & (F.col(f"_k_t{i}") >= F.col("_min"))
        entry = F.struct(F.lit(f"zone_{zones[i]:g}").alias("m"), F.col(f"_t{i}").alias("t"), F.col(f"_k_t{i}").alias("k"))
        pick = F.when(ok, entry).otherwise(pick)
    choice = measured(choice.select(*keys, pick.alias("p"), "_min").select(*keys, F.col("p.m").alias("method"), F.col("p.t").alias("_t"), F.col("p.k").alias("_k"), "_min"))
    rows = on_keys(spaxel, choice, keys)
    enough = rows.where((F.col("_k") >= F.col("_min")) & (F.col("signal") >= F.col("_t")))
    short = rows.where(F.col("_k") < F.col("_min"))
    return enough.unionByName(top_rows(short, keys, "signal", id, count="_min")).drop("_t", "_k", "_min")


def adaptive_min_snr(
    spaxel: DataFrame, *, method: str = "percentile", percentile: float = 2.0, floor: float = 0.1, ceiling: float = 1.5, keys: Sequence[str] = ("field",)
) -> DataFrame:
    """SNR limit per field from its positive SNR values, clamped, with their p2, p50 and p98.

    ``percentile``: the given percentile. ``sigma_clip``: median - 2 sigma after clipping.
    ``snr_gap``: upper end of the widest gap in the lowest quarter (at least 10 values).
    """
    keys = list(keys)
    pos = spaxel.where(usable(F.col("snr")) & (F.col("snr") > 0)).select(*keys, "snr")
    base = measured(quantiles(pos, keys, "snr", {"raw": percentile / 100.0, "p2": 0.02, "p25": 0.25, "p50": 0.5, "p98": 0.98}))
    out = base
    if method == "sigma_clip":
        keep = pos
        for _ in range(5):
            stats = quantiles(keep, keys, "snr", {"_m": 0.5}).join(keep.groupBy(*keys).agg(F.stddev_pop("snr").alias("_s")), keys)
            keep = cut(on_keys(keep, stats, keys).where(F.abs(F.col("snr") - F.col("_m")) <= F.col("_s") * 3).select(*keys, "snr"))
        final = quantiles(keep, keys, "snr", {"_m": 0.5}).join(keep.groupBy(*keys).agg(F.stddev_pop("snr").alias("_s")), keys)
        out = out.join(final, keys, "left").withColumn("raw", F.col("_m") - F.col("_s") * 2).drop("_m", "_s")
    elif method == "snr_gap":
        lower = on_keys(pos, base.select(*keys, "p25"), keys).where("snr < p25").select(*keys, "snr")
        n = lower.groupBy(*keys).agg(F.count("*").alias("_n"))
        gaps = next_value(lower, keys, "snr").where("nxt IS NOT NULL")
        widest = gaps.groupBy(*keys).agg(F.max_by("nxt", F.struct(F.col("nxt") - F.col("snr"), -F.col("snr"))).alias("_g"))
        out = out.join(n, keys, "left").join(widest, keys, "left")
        out = out.withColumn("raw", F.when((F.col("_n") >= 10) & F.col("_g").isNotNull(), F.col("_g")).otherwise(F.col("raw"))).drop("_n", "_g")
    limit = F.least(F.greatest(F.col("raw"), F.lit(floor)), F.lit(ceiling))
    if keys:
        out = spaxel.select(*keys).distinct().join(out, keys, "left")
    return out.select(*keys, F.coalesce(limit, F.lit(floor)).alias("min_snr"), "p2", "p50", "p98")


def raster_map(points: DataFrame, *, pixel: float, pad: float = 6.0, order: str = "target_id", value: str = "value") -> DataFrame:
    """Scattered values on a pixel grid; of several points in one pixel the last row wins."""
    low = points.agg(F.min("x").alias("x0"), F.min("y").alias("y0"))
    rows = on_keys(points, low, [])
    i = F.rint((F.col("x") - F.col("x0") + pad) / pixel).cast("bigint")
    j = F.rint((F.col("y") - F.col("y0") + pad) / pixel).cast("bigint")
    return rows.groupBy(i.alias("i"), j.alias("j")).agg(F.max_by(value, order).alias(value))


def stretched(frac: Column, scale: str) -> Column:
    """A fraction in [0, 1] through a display stretch."""
    if scale == "log":
        return F.log(frac * 1000.0 + 1.0) / F.log(F.lit(1001.0))
    if scale == "sqrt":
        return F.sqrt(frac)
    if scale == "power":
        return frac * frac
    if scale == "asinh":
        return F.asinh(frac / 0.1) / F.asinh(F.lit(10.0))
    return frac


def colour_buckets(df: DataFrame, *, value: str, buckets: int = 16, scale: str = "linear", lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Display bucket of every row: clip to the 1st to 99th percentile or given limits, stretch."""
    q = quantiles(df, [], value, {"_lo": 0.01, "_hi": 0.99})
    rows = on_keys(df, q, [])
    low = F.lit(float(lo)) if lo is not None else F.coalesce("_lo", F.lit(0.0))
    high = F.lit(float(hi)) if hi is not None else F.coalesce("_hi", F.lit(1.0))
    span = F.when(high == low, 1.0).otherwise(high - low)
    frac = F.coalesce(stretched(F.least(F.greatest((F.col(value) - low) / span, F.lit(0.0)), F.lit(1.0)), scale), F.lit(0.0))
    return rows.withColumn("bucket", F.least(F.floor(frac * buckets), F.lit(buckets - 1)).cast("int")).drop("_lo", "_hi")


def bin_centres(spaxel: DataFrame, *, keys: Sequence[str] = ("field",)) -> DataFrame:
    """Nodes of an existing bin map from members with a number >= 0; spaxels in and out."""
    inside = F.col("bin_id") >= 0
    return spaxel.groupBy(*keys, F.abs("bin_id").alias("bin_id")).agg(
        F.avg(F.when(inside, F.col("x"))).alias("x"),
        F.avg(F.when(inside, F.col("y"))).alias("y"),
        F.sum(F.when(inside, 1).otherwise(0)).alias("n_inside"),
        F.sum(F.when(inside, 0).otherwise(1)).alias("n_outside"),
    )


def bin_detail(spaxel: DataFrame, results: DataFrame, *, bin_id: int) -> tuple[DataFrame, DataFrame]:
    """All spaxels of one bin, and every fitted parameter of it as (parameter, value) rows."""
    values = [c for c in results.columns if c != "bin_id"]
    one = results.where(F.col("bin_id") == bin_id).select("bin_id", *[F.col(c).cast("double").alias(c) for c in values])
    return spaxel.where(F.abs("bin_id") == bin_id), one.unpivot(["bin_id"], values, "parameter", "value")


def wave_slices(
    pixel: DataFrame, *, item: str, width: float, max_slices: int | None = None, max_items: int | None = None, lo: float | None = None, hi: float | None = None, value: str = "flux"
) -> DataFrame:
    """Flux sum per item in slices of equal sample count; missing flux counts as 0.

    The slice edges follow from the number of samples, so they are computed once; each pixel
    finds its slice by an expression over the edges. ``max_slices`` and ``max_items`` are optional
    limits of a display: fewer, wider slices, and an evenly spaced choice of items in order.
    """
    rows = pixel
    if lo is not None:
        rows = rows.where(F.col("wave") >= lo)
    if hi is not None:
        rows = rows.where(F.col("wave") <= hi)
    grid = rows.agg(F.min("wave").alias("a"), F.max("wave").alias("b"), F.countDistinct("wave").alias("n"), F.min("pix").alias("p")).first()
    n = int(grid["n"] or 0)
    if n == 0:
        return rows.select(item).limit(0)
    step = (grid["b"] - grid["a"]) / (n - 1) if n > 1 else 0.0
    k = max(1, min(max_slices or n, round((grid["b"] - grid["a"]) / width), n)) if n > 1 else 1
    edges = sorted({round(i * n / k) for i in range(k + 1)})
    centre = [(grid["a"] + e0 * step + grid["a"] + e1 * step) / 2 for e0, e1 in zip(edges, edges[1:])]
    bounds = F.array(*[F.lit(e) for e in edges[1:]])
    index = F.size(F.filter(bounds, lambda e: e <= F.col("pix") - int(grid["p"])))
    if max_items is not None:
        items = number_rows(rows.select(item).distinct(), [F.col(item)], "_r", start=-1)
        total = items.count()
        if total > max_items:
            # Rows of the sample are round(k (n-1)/(m-1)); test each row number against it.
            guess = F.col("_r") * float(max_items - 1) / float(total - 1)
            back = lambda g: F.rint(g * float(total - 1) / float(max_items - 1)) == F.col("_r")
            items = items.where(back(F.floor(guess)) | back(F.ceil(guess)))
        rows = rows.join(items.select(item), item, "left_semi")
    out = rows.groupBy(item, index.alias("slice")).agg(F.sum(F.coalesce(value, F.lit(0.0))).alias(value))
    return out.withColumn("centre", F.get(F.array(*[F.lit(float(c)) for c in centre]), F.col("slice")))


def ebv_spread(df: DataFrame, *, keys: Sequence[str], value: str = "ebv") -> DataFrame:
    """Median, smallest and largest applied reddening per batch."""
    mid = quantiles(df, keys, value, {"median": 0.5})
    return df.groupBy(*keys).agg(F.min(value).alias("smallest"), F.max(value).alias("largest")).join(mid, list(keys))


def running_mean_by(df: DataFrame, value: str, size: int, *, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Centred mean over a short ordered table (one row per channel), ends repeated."""
    from lumenframe.operators.spectra import running_mean

    rows = df.withColumns({"pix": F.col(order), "_one": F.lit(0)})
    return rows.withColumn(value, running_mean(F.col(value), size, [*keys, "_one"])).drop("_one", *([] if order == "pix" else ["pix"]))


