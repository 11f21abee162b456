"""Detection of emission-line candidates in a voxel table ``(iw, iy, ix, data, ivar, snr)``.

``keys`` name the columns, such as a cube number, that tell cubes apart: every operator that takes
them treats each cube as if it were alone, all in one plan. Ids are unique over all cubes.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.functions.cells import plane_pairs
from lumenframe.functions.exprs import MAD_TO_SIGMA
from lumenframe.functions.scale import cut, measured, number_rows, on_keys, quantiles
from lumenframe.operators.bins import running_mean_by
from lumenframe.operators.regions import HELD, TILE, half_ball, level_components, strongest_apart, tiled_components
from lumenframe.operators.spatial import not_near_catalogue, xmatch_sky
from lumenframe.operators.spectra import clipped_centre
from lumenframe.operators.walk import components

AXES = ("iw", "iy", "ix")
PART = 250_000  # voxels that one task spreads over the kernel
PLACES = 500_000  # places of whole lines that a task sums together
# Fixed value: standard normal quantiles at 84 % minus 16 %.
NORMAL_SPREAD = 1.988915766419506


def neighbour_edges(points: DataFrame, coords: Sequence[str], *, id: str = "id", keys: Sequence[str] = (), faces_only: bool = False) -> DataFrame:
    """Edges ``(a, b)`` between points whose integer coordinates differ by at most 1 (or in one
    coordinate only).

    Each point is copied to one half of its neighbour positions, then met by an equi-join, so
    every edge appears once and a point takes part in a bounded number of rows.
    """
    shifts = [s for s in itertools.product((-1, 0, 1), repeat=len(coords)) if s > (0,) * len(coords)]
    if faces_only:
        shifts = [s for s in shifts if sum(abs(v) for v in s) == 1]
    offsets = F.array(*[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate(s)]) for s in shifts])
    probe = points.select(F.col(id).alias("a"), *keys, *coords, F.explode(offsets).alias("o"))
    probe = probe.select("a", *keys, *[(F.col(c) + F.col(f"o.d{i}")).alias(c) for i, c in enumerate(coords)])
    return probe.join(points.select(F.col(id).alias("b"), *keys, *coords), [*keys, *coords]).select("a", "b")


# --- calibration --------------------------------------------------------------------------


def robust_sky(px: DataFrame, *, value: str = "data", sigma: float = 3.0, rounds: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Level, rms and rejected fraction after clipping about the median, for each image."""
    out = clipped_centre(px, value=value, sigma=sigma, rounds=rounds, keys=keys)
    return out.select(*keys, F.col("median").alias("level"), F.col("sigma").alias("rms"), (1 - F.col("n") / F.col("n_all")).alias("rejected"), "n")


def noise_scale(voxel: DataFrame, *, per_wave: bool = False, min_good: int = 50, smooth: int = 51, keys: Sequence[str] = ()) -> DataFrame:
    """Width of residual * sqrt(ivar) in units of a normal one, overall or per channel (at least
    1, and 1 with few voxels, then smoothed over channels)."""
    pull = voxel.where(F.col("ivar") > 0).select(*keys, "iw", (F.col("data") * F.sqrt("ivar")).alias("pull"))
    if not per_wave:
        return quantiles(pull, keys, "pull", {"lo": 0.16, "hi": 0.84}).select(*keys, ((F.col("hi") - F.col("lo")) / NORMAL_SPREAD).alias("k"))
    channel = [*keys, "iw"]
    n = pull.groupBy(*channel).agg(F.count("*").alias("n"))
    k = quantiles(pull, channel, "pull", {"lo": 0.16, "hi": 0.84}).join(n, channel)
    scale = F.when(F.col("n") >= min_good, F.greatest((F.col("hi") - F.col("lo")) / NORMAL_SPREAD, F.lit(1.0))).otherwise(1.0)
    # One row per channel from here on.
    return running_mean_by(k.select(*channel, scale.alias("k")), "k", smooth, order="iw", keys=keys)


def purity_scan(pos: DataFrame, neg: DataFrame, *, thresholds: Sequence[float], value: str = "snr", keys: Sequence[str] = ()) -> DataFrame:
    """Counts of real and sign-flipped detections at each configured threshold, and the purity.
    All thresholds are counted in one pass over each side."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        wide = df.groupBy(*keys).agg(F.array(*[F.sum(F.when(F.col(value) >= float(t), 1).otherwise(0)) for t in thresholds]).alias("c"))
        return wide.select(*keys, F.posexplode("c").alias("k", name))

    marks = F.array(*[F.lit(float(t)) for t in thresholds])
    out = counts(pos, "n_pos").join(counts(neg, "n_neg"), [*keys, "k"], "full")
    out = out.select(*keys, F.get(marks, F.col("k")).alias("threshold"), F.coalesce("n_pos", F.lit(0)).alias("n_pos"), F.coalesce("n_neg", F.lit(0)).alias("n_neg"))
    return out.withColumn("purity", 1 - F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1)))


def choose_threshold(scan: DataFrame, *, target: float = 0.8, min_n: int = 15, floor: float | None = None, min_excess: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """The smallest threshold that is pure enough and trustworthy, raised to the floor; NULL
    when there is none, which disables the path."""
    ok = (F.col("purity") >= target) & (F.col("n_pos") >= min_n)
    if min_excess is not None:
        ok = ok & (F.col("n_pos") - F.col("n_neg") >= min_excess)
    best = F.min(F.when(ok, F.col("threshold")))
    chosen = best if floor is None else F.when(best.isNotNull(), F.greatest(best, F.lit(float(floor))))
    return scan.groupBy(*keys).agg(chosen.alias("min_snr"))


def loudest_event(neg: DataFrame, *, margin: float = 1.1, value: str = "snr", keys: Sequence[str] = ()) -> DataFrame:
    """The loudest sign-flipped voxel and the extreme threshold that follows."""
    top = neg.groupBy(*keys).agg(F.max(value).alias("loudest"))
    return top.withColumn("threshold", F.when(F.col("loudest") != 0, F.col("loudest") * margin))


# --- filtering and extraction -------------------------------------------------------------


def gauss_taps(sigma: float, truncate: float = 4.0) -> list[tuple[int, float]]:
    r = max(1, int(truncate * sigma + 0.5))
    return [(o, math.exp(-0.5 * (o / sigma) ** 2)) for o in range(-r, r + 1)]


def matched_filter(
    voxel: DataFrame, *, spectral_sigma: float, spatial_sigma: float, bounds: dict[str, tuple[int, int]], coverage: float = 0.5, keys: Sequence[str] = ()
) -> DataFrame:
    """SNR of a separable Gaussian template, sum(w d k) / sqrt(sum(w k^2)); 0 where coverage is
    below half of the median of its own ``keys``."""
    out = matched_filter_bank(voxel, spectral_sigmas=[spectral_sigma], spatial_sigma=spatial_sigma, bounds=bounds, coverage=coverage, keys=keys)
    return out.drop("width")


def matched_filter_bank(
    voxel: DataFrame, *, spectral_sigmas: Sequence[float], spatial_sigma: float, bounds: dict[str, tuple[int, int]], coverage: float = 0.5, keys: Sequence[str] = ()
) -> DataFrame:
    """The matched filter for several line widths (column ``width``, the spectral sigma).

    One pass per axis; the two spatial ones are shared by all widths. Rows are partitioned and sorted
    by the two other coordinates, so a task has whole lines and spreads them over the kernel as
    arrays: a pass shuffles every voxel once, not once per kernel tap and width. The number of parts
    follows the number of voxels, which is counted before: a task sums few bytes to many places.
    """
    keys = list(keys)
    parts = max(int(voxel.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), voxel.count() // PART)
    out = voxel.select(*keys, *AXES, (F.col("ivar") * F.col("data")).cast("double").alias("wd"), F.col("ivar").cast("double").alias("w"))
    for axis in ("iy", "ix", "iw"):
        others = [*keys, *[a for a in AXES if a != axis]]
        lines = out.where(F.col(axis).isNotNull()).repartition(parts, *others).sortWithinPartitions(*others)
        fields = [out.schema[c] for c in (*others, axis)] + [T.StructField(c, T.DoubleType()) for c in ("wd", "w")]
        sigmas = spectral_sigmas if axis == "iw" else [spatial_sigma]
        if axis == "iw":
            fields.append(T.StructField("width", T.DoubleType()))
        out = lines.mapInArrow(_over_kernel(others, axis, bounds[axis], sigmas, T.StructType(fields).names), T.StructType(fields))
    # Read several times below; a checkpoint is cheaper than three more shuffles each time.
    out = cut(out)
    every = [*keys, "width"]
    out = on_keys(out, quantiles(out.where("w > 0"), every, "w", {"m": 0.5}), every, "left")
    ok = (F.col("w") > 0) & (F.col("w") >= F.col("m") * coverage)
    return out.select(*every, *AXES, F.when(ok, F.col("wd") / F.sqrt(F.nullif(F.col("w"), F.lit(0.0)))).otherwise(0.0).alias("snr"))


def _over_kernel(others: Sequence[str], axis: str, bounds: tuple[int, int], sigmas: Sequence[float], names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(others, axis, wd, w)``, sorted by ``others``, spread over the kernel of each sigma and
    summed per place. As in a sum of rows, a place that nothing reaches has no row and a sum of
    nothing but NULL is NULL."""
    lo, hi = bounds
    n = hi - lo + 1
    taps = {s: gauss_taps(s) for s in sigmas}

    def spread(t: pa.Table, line: np.ndarray, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = t.column(axis).to_numpy().astype(np.int64) - lo
        known = {c: t.column(c).is_valid().to_numpy() for c in ("wd", "w")}
        value = {c: np.where(known[c], t.column(c).to_numpy(), 0.0) for c in ("wd", "w")}
        size = len(first) * n
        for s in sigmas:
            met, has = np.zeros(size, bool), {c: np.zeros(size, bool) for c in ("wd", "w")}
            total = {c: np.zeros(size) for c in ("wd", "w")}
            for o, k in taps[s]:
                ok = (at + o >= 0) & (at + o < n)
                place = line[ok] * n + at[ok] + o
                met[place] = True
                for c, by in (("wd", k), ("w", k * k)):
                    has[c][place[known[c][ok]]] = True
                    total[c] += np.bincount(place, weights=value[c][ok] * by, minlength=size)
            found = np.flatnonzero(met)
            base = t.select(others).take(pa.array(first[found // n]))
            cols = {c: base.column(c) for c in others}
            cols[axis] = pa.array(found % n + lo).cast(t.schema.field(axis).type)
            cols |= {c: pa.array(total[c][found], mask=~has[c][found]) for c in total}
            cols["width"] = pa.array(np.full(len(found), float(s)))
            yield from pa.table({c: cols[c] for c in names}).to_batches(max_chunksize=50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in itertools.chain(batches, [None]):
            if b is not None:
                held.append(b)
                size += b.num_rows
            if not size or (b is not None and size < HELD):
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            new = np.zeros(t.num_rows, bool)
            new[0] = True
            for c in others:
                kinds = pa.concat_arrays(t.column(c).chunks).dictionary_encode(null_encoding="encode")
                new[1:] |= np.diff(kinds.indices.to_numpy()) != 0
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], t.num_rows)
            last = len(starts) if b is None else len(starts) - 1  # the last line may go on
            line = np.cumsum(new) - 1
            step = max(1, PLACES // n)
            for i in range(0, last, step):
                j = min(i + step, last)
                rows = slice(starts[i], ends[j - 1])
                yield from spread(t.slice(starts[i], ends[j - 1] - starts[i]), line[rows] - i, starts[i:j] - starts[i])
            rest = t.slice(starts[last] if last < len(starts) else t.num_rows)
            held, size = rest.to_batches(), rest.num_rows

    return run


def connected_voxels(voxel: DataFrame, *, threshold: float, id: str = "voxel_id", keys: Sequence[str] = ()) -> DataFrame:
    """Connected groups of voxels above the threshold: peak position and value, and size."""
    out = level_components(voxel, AXES, value="snr", thresholds=[threshold], shifts=half_ball(3), id=id, keys=keys)
    return out.select(*keys, F.col("comp").alias("cand_id"), *AXES, "snr", "npix")


def dedupe_candidates(cand: DataFrame, *, dxy: int = 3, dw: int = 4, id: str = "cand_id", keys: Sequence[str] = ()) -> DataFrame:
    """Drop candidates close to a kept stronger one (ties: the lower id is stronger), as going
    through all of them by strength does; rounds grow with the logarithm of the extent."""
    kept = strongest_apart(cand, half={"iw": dw, "iy": dxy, "ix": dxy}, strength="snr", id=id, keys=keys)
    return cand.join(kept, id, "left_semi")


def coincidence_veto(cand: DataFrame, *, tolerance: int = 2, mad_k: float = 6.0, min_count: int = 8, keys: Sequence[str] = ()) -> DataFrame:
    """Drop candidates in wavelength bins that hold far more of them than usual. The candidates
    are evaluated once; what follows works on the count per bin."""
    keys = list(keys)
    width = 2 * tolerance + 1
    rows = cut(cand.withColumn("_wb", F.floor(F.col("iw") / width)))
    counts = rows.groupBy(*keys, "_wb").agg(F.count("*").alias("_n"))
    counts = on_keys(counts, quantiles(counts, keys, "_n", {"_med": 0.5}), keys).withColumn("_d", F.abs(F.col("_n") - F.col("_med")))
    counts = on_keys(counts, quantiles(counts, keys, "_d", {"_dev": 0.5}), keys)
    spread = F.when(F.col("_dev") == 0, 1.0).otherwise(F.col("_dev")) * (mad_k * MAD_TO_SIGMA)
    bad = counts.where(F.col("_n") > F.greatest(F.lit(float(min_count)), F.col("_med") + spread)).select(*keys, "_wb")
    return rows.join(bad, [*keys, "_wb"], "left_anti").select(*cand.columns)


def resolved_only(cand: DataFrame, voxel: DataFrame, *, sigma: float | str = 1.0, min_fraction: float = 0.3, id: str = "cand_id", keys: Sequence[str] = ()) -> DataFrame:
    """Keep candidates whose neighbouring channels hold enough of the peak for a real line of the
    width ``sigma``, a number or the column with the width of each candidate's template."""
    off = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_o")
    probe = cand.select(id, *keys, "iw", "iy", "ix", off).withColumn("iw", F.col("iw") + F.col("_o"))
    near = probe.join(voxel.select(*keys, "iw", "iy", "ix", "data"), [*keys, "iw", "iy", "ix"])
    s = near.groupBy(id).agg(F.max(F.when(F.col("_o") == 0, F.col("data"))).alias("p"), F.avg(F.when(F.col("_o") != 0, F.col("data"))).alias("m"))
    width = F.col(sigma) if isinstance(sigma, str) else F.lit(float(sigma))
    s = cand.join(s, id).withColumn("_least", F.exp(-0.5 / (width * width)) * min_fraction)
    return s.where((F.col("p") != 0) & (F.col("m") / F.nullif(F.col("p"), F.lit(0.0)) >= F.col("_least"))).select(*cand.columns)


def away_from_edge(cand: DataFrame, covered: DataFrame, *, nx: int, ny: int, min_distance: float = 3.0, keys: Sequence[str] = ()) -> DataFrame:
    """Keep candidates at least ``min_distance`` from every pixel without coverage, in cubes of
    ``nx`` by ``ny`` pixels."""
    keys = list(keys)
    cubes = cand.select(*keys).distinct() if keys else cand.sparkSession.range(1).select()
    pixel = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nx * ny - 1).cast("long"))).alias("_i")
    grid = cubes.select(*keys, pixel).select(*keys, (F.col("_i") % nx).alias("ix"), F.floor(F.col("_i") / nx).alias("iy"))
    blank = grid.join(covered.select(*keys, "ix", "iy"), [*keys, "ix", "iy"], "left_anti").select(*keys, F.col("ix").alias("bx"), F.col("iy").alias("by"))
    dx, dy = F.col("ix") - F.col("bx"), F.col("iy") - F.col("by")
    return plane_pairs(cand, blank, big_xy=("ix", "iy"), small_xy=("bx", "by"), radius=min_distance, how="left_anti", exact=dx * dx + dy * dy < min_distance**2, keys=keys)


def candidate_vetoes(
    cand: DataFrame, voxel: DataFrame, covered: DataFrame, *, nx: int, ny: int, sigma: float | str = 1.0, min_fraction: float = 0.3, min_npix: int = 3, max_npix: int = 5000, min_count: int = 8, min_distance: float = 3.0, keys: Sequence[str] = ()
) -> DataFrame:
    """Resolved width, size, coincidence in wavelength, distance to the coverage edge."""
    out = resolved_only(cand, voxel, sigma=sigma, min_fraction=min_fraction, keys=keys)
    out = out.where(F.col("npix").between(min_npix, max_npix))
    out = coincidence_veto(out, min_count=min_count, keys=keys)
    return away_from_edge(out, covered, nx=nx, ny=ny, min_distance=min_distance, keys=keys)


def bank_candidates(bank: DataFrame, *, thresholds: Sequence[float], id: str = "voxel_id", dxy: int = 3, dw: int = 4, keys: Sequence[str] = ()) -> DataFrame:
    """Candidates of a filter bank (``width``, voxel id, place, snr) above each threshold, the
    strongest of those close together over all widths: (keys, level, cand_id, width, place, snr,
    npix). All levels come from one component tree and are thinned out in one run."""
    keys = list(keys)
    found = level_components(bank, AXES, value="snr", thresholds=thresholds, shifts=half_ball(3), id=id, keys=[*keys, "width"])
    # A group is known by its strongest voxel's rank among all: level, width and smallest voxel.
    widths = found.select("width").distinct()
    # One row per width of the bank.
    rank = F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("width")) - 1
    found = found.join(measured(widths.withColumn("_w", rank)), "width")
    many = F.lit(len(thresholds)) * F.lit(64)
    found = found.withColumn("cand_id", F.col("comp") * many + F.col("level") * 64 + F.col("_w")).drop("_w")
    found = cut(found)
    return dedupe_candidates(found, dxy=dxy, dw=dw, keys=[*keys, "level"])


def post_veto_purity(
    bank: DataFrame, voxel: DataFrame, covered: DataFrame | None, *, thresholds: Sequence[float], nx: int, ny: int, min_fraction: float = 0.3,
    min_npix: int = 3, max_npix: int = 5000, min_count: int = 8, mad_k: float = 6.0, min_distance: float = 3.0, dxy: int = 3, dw: int = 4, keys: Sequence[str] = (),
) -> DataFrame:
    """Real and sign-flipped candidates left after all vetoes at each threshold, and the purity.

    ``bank`` has the SNR of each width (with a voxel id), ``voxel`` the data. Both signs and all
    thresholds go through extraction, thinning and vetoes at once: they are further keys."""
    keys, both = list(keys), [*keys, "_neg"]
    flip = lambda df, *cols: df.withColumn("_neg", F.lit(False)).unionByName(df.withColumns({c: -F.col(c) for c in cols}).withColumn("_neg", F.lit(True)))
    # A voxel takes part under two numbers, one for each sign.
    signs = F.explode(F.array(F.lit(False), F.lit(True))).alias("_neg")
    signed = bank.where(F.abs("snr") > float(min(thresholds))).select("*", signs).withColumn("snr", F.when(F.col("_neg"), -F.col("snr")).otherwise(F.col("snr")))
    signed = signed.withColumn("voxel_id", F.col("voxel_id") * 2 + F.col("_neg").cast("long"))
    cand = bank_candidates(signed, thresholds=thresholds, dxy=dxy, dw=dw, keys=both)
    cand = resolved_only(cand, flip(voxel, "data"), sigma="width", min_fraction=min_fraction, keys=both)
    cand = cand.where(F.col("npix").between(min_npix, max_npix))
    cand = coincidence_veto(cand, mad_k=mad_k, min_count=min_count, keys=[*both, "level"])
    if covered is not None:
        cand = away_from_edge(cand, covered, nx=nx, ny=ny, min_distance=min_distance, keys=keys)
    counts = cand.groupBy(*keys, "level").agg(F.count_if(~F.col("_neg")).alias("n_pos"), F.count_if("_neg").alias("n_neg"))
    every = voxel.select(*keys).distinct() if keys else voxel.sparkSession.range(1).select()
    every = every.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(len(thresholds) - 1))).alias("level"))
    marks = F.array(*[F.lit(float(t)) for t in thresholds])
    out = every.join(counts, [*keys, "level"], "left").fillna(0, ["n_pos", "n_neg"])
    return out.select(*keys, F.get(marks, F.col("level")).alias("threshold"), "n_pos", "n_neg", (1 - F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1))).alias("purity"))


def group_purity(pos: DataFrame, neg: DataFrame, *, thresholds: Sequence[float], radius: float = 0.0, min_lines: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """Real and sign-flipped groups of at least ``min_lines`` candidates at each threshold of
    their combined SNR, and the purity. The candidates have passed all vetoes already."""

    def combined(cand: DataFrame) -> DataFrame:
        groups = group_candidates(cand, radius=radius, keys=keys).groupBy(*keys, "group_id")
        out = groups.agg(F.sqrt(F.sum(F.col("snr") * F.col("snr"))).alias("group_snr"), F.count("*").alias("n_lines"))
        return out.where(F.col("n_lines") >= min_lines)

    return purity_scan(combined(pos), combined(neg), thresholds=thresholds, value="group_snr", keys=keys)


def group_candidates(cand: DataFrame, *, radius: float = 0.0, id: str = "cand_id", keys: Sequence[str] = ()) -> DataFrame:
    """Add ``group_id``, the smallest candidate id of its spatial single-linkage group.

    Candidates at one pixel collapse to one position first, so a crowded pixel makes no pairs.
    """
    spots = cand.groupBy(*keys, "ix", "iy").agg(F.min(id).alias("id"))
    if radius <= 0:
        return cand.join(spots.withColumnRenamed("id", "group_id"), [*keys, "ix", "iy"])
    if all(isinstance(spots.schema[c].dataType, T.IntegralType) for c in ("iy", "ix")):
        reach = half_ball(2, reach=int(radius), near=lambda d: d[0] * d[0] + d[1] * d[1] <= radius * radius) if radius >= 1 else []
        comp = tiled_components(spots, ("iy", "ix"), shifts=reach, keys=keys, tile=max(TILE, 4 * int(radius))) if reach else spots.withColumn("comp", F.col("id"))
    else:
        spots = cut(spots)
        other = spots.select(*keys, F.col("id").alias("b"), F.col("ix").alias("bx"), F.col("iy").alias("by"))
        edges = plane_pairs(spots, other, big_xy=("ix", "iy"), small_xy=("bx", "by"), radius=radius, keys=keys).where("id < b").select(F.col("id").alias("a"), "b")
        comp = spots.join(components(spots, edges), "id")
    return cand.join(comp.select(*keys, "ix", "iy", F.col("comp").alias("group_id")), [*keys, "ix", "iy"])


def group_significance(grouped: DataFrame, *, min_lines: int = 1) -> DataFrame:
    """Combined SNR (root of the sum of squares) and member count per group."""
    out = grouped.groupBy("group_id").agg(F.sqrt(F.sum(F.col("snr") * F.col("snr"))).alias("group_snr"), F.count("*").alias("n_lines"))
    return out.where(F.col("n_lines") >= min_lines)


def footprint_size(px: DataFrame, *, min_components: int = 100, max_size: float = 200.0, id: str = "id", keys: Sequence[str] = ()) -> DataFrame:
    """Median size of the connected footprints of unmasked pixels, NULL if it is no mosaic."""
    v = px.select(F.col(id).alias("id"), *keys, "iy", "ix")
    faces = half_ball(2, near=lambda d: abs(d[0]) + abs(d[1]) == 1)
    comp = tiled_components(v, ("iy", "ix"), shifts=faces, keys=keys, tile=64)
    sizes = comp.groupBy(*keys, "comp").agg(F.count("*").alias("size"))
    n = on_keys(sizes.groupBy(*keys).agg(F.count("*").alias("n_components")), quantiles(sizes, keys, "size", {"m": 0.5}), keys)
    mosaic = (F.col("n_components") >= min_components) & (F.col("m") <= max_size)
    return n.select(*keys, "n_components", F.when(mosaic, F.col("m")).alias("footprint"))


def promote_candidates(
    cand: DataFrame,
    patches: DataFrame,
    *,
    min_snr: float | None,
    group_min_lines: int | None = 2,
    group_min_snr: float | None = 10.0,
    extreme_snr: float | None = None,
    radius_arcsec: float = 3.0,
    aperture_arcsec: float = 2.0,
    flag: float = 3.0,
) -> DataFrame:
    """Patches with the reliable line-only candidates appended.

    A candidate without a continuum counterpart is promoted by its own SNR, by its group or by
    an extreme SNR; a threshold of None disables that path. One per group, the strongest, and
    none within the radius of a patch that is not a mask. Appended rows carry the provenance
    flag and ids after the largest one.
    """
    lone = cand.where("no_counterpart")
    promoted = F.lit(False)
    if min_snr is not None:
        promoted = promoted | (F.col("snr") >= min_snr)
    if extreme_snr is not None:
        promoted = promoted | (F.col("snr") >= extreme_snr)
    if group_min_lines is not None and group_min_snr is not None:
        strong = group_significance(lone, min_lines=group_min_lines).where(F.col("group_snr") >= group_min_snr)
        lone = lone.join(strong.select("group_id", F.lit(True).alias("_g")), "group_id", "left")
        promoted = promoted | F.coalesce(F.col("_g"), F.lit(False))
    best = lone.where(promoted).groupBy("group_id").agg(F.max_by(F.struct("cand_id", "ra", "dec", "snr"), F.struct("snr", -F.col("cand_id"))).alias("b"))
    best = best.select("b.*")
    real = patches.where("type <> 'M'").select(F.col("patch_id").alias("id"), "ra", "dec")
    taken = xmatch_sky(best.select(F.col("cand_id").alias("id"), "ra", "dec"), real, radius_arcsec=radius_arcsec).select(F.col("id_a").alias("cand_id"))
    new = best.join(taken, "cand_id", "left_anti")
    start = patches.agg(F.max("patch_id")).first()[0] or 0
    new = number_rows(new, [F.col("snr").desc(), F.col("cand_id")], "patch_id", start=start)
    size = aperture_arcsec / 3600.0
    new = new.select(
        "patch_id", "ra", "dec", F.lit(size).alias("a"), F.lit(size).alias("b"), F.lit(0.0).alias("angle"), F.lit(flag).alias("flag"), F.lit("T").alias("type")
    )
    return patches.select(*new.columns).unionByName(new)


def line_only(cand: DataFrame, objects: DataFrame, *, radius: float = 4.0, id: str = "cand_id", keys: Sequence[str] = ()) -> DataFrame:
    """Mark candidates without a continuum object nearby."""
    free = not_near_catalogue(cand, objects, radius=radius, keys=keys).select(id, F.lit(True).alias("_free"))
    return cand.join(free, id, "left").withColumn("no_counterpart", F.coalesce("_free", F.lit(False))).drop("_free")


