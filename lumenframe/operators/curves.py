"""Resolution curves ``(nspec, wave, value)`` on a shared grid, and the arc points behind them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.exprs import MAD_TO_SIGMA, ratio, usable
from lumenframe.functions.scale import cut, measured, next_value, on_keys, quantiles
from lumenframe.operators.ranges import interp_at

PART = 500_000  # weights of spaxels that one task spreads over the waves


def median_curve(curves: DataFrame, *, keys: Sequence[str] = (), min_points: int = 0) -> DataFrame:
    """Median over fibres per grid wavelength (and per arm with ``keys``); an arm with fewer
    than ``min_points`` wavelengths is dropped."""
    out = quantiles(curves, [*keys, "wave"], "value", {"value": 0.5})
    if min_points and keys:
        enough = out.groupBy(*keys).count().where(F.col("count") >= min_points).select(*keys)
        out = out.join(enough, list(keys), "left_semi")
    return out


def weighted_curves(weights: DataFrame, curves: DataFrame, overall: DataFrame) -> DataFrame:
    """Curve of each spaxel: sum of weight times the fibre's curve. The same fibre in several
    exposures is summed first; a fibre without a curve takes the overall one.

    Fibres without a curve go by the number NULL, the overall curve's. Only curves that weights
    ask for are kept, as a table of known size; all else stays in the partitions of the spaxels.
    """
    known = curves.select("nspec").distinct().withColumn("_known", F.lit(True))
    w = weights.groupBy("spaxel_id", "nspec").agg(F.sum("weight").alias("weight"))
    w = cut(w)
    # A spaxel's few rows meet all waves: parts by the number of rows, not by their few bytes.
    parts = max(int(w.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), w.count() // PART)
    used = measured(w.select("nspec").distinct().join(known, "nspec"))
    shapes = curves.join(used, "nspec", "left_semi").select(F.col("nspec").alias("_own"), "wave", "value")
    shapes = measured(shapes.unionByName(overall.select(F.lit(None).cast(shapes.schema["_own"].dataType).alias("_own"), "wave", "value")))
    w = w.join(used, "nspec", "left").repartition(parts, "spaxel_id").withColumn("n_fibres", F.count("*").over(Window.partitionBy("spaxel_id")))
    w = w.groupBy("spaxel_id", F.when(F.col("_known"), F.col("nspec")).alias("_asks")).agg(F.sum("weight").alias("weight"), F.first("n_fibres").alias("n_fibres"))
    rows = w.join(shapes, F.col("_asks").eqNullSafe(F.col("_own")))
    return rows.groupBy("spaxel_id", "wave").agg(F.sum(F.col("weight") * F.col("value")).alias("value"), F.first("n_fibres").alias("n_fibres"))


def bin_curves(spaxel: DataFrame, curves: DataFrame) -> DataFrame:
    """Flux-weighted mean curve per bin. Spaxels without a curve or a positive weight add
    nothing; a bin without any is absent."""
    ok = spaxel.where(usable(F.col("signal")) & (F.col("signal") > 0)).select("spaxel_id", "bin_id", "signal")
    rows = ok.join(curves.select("spaxel_id", "wave", "value"), "spaxel_id")
    return rows.groupBy("bin_id", "wave").agg((F.sum(F.col("signal") * F.col("value")) / F.sum("signal")).alias("value"), F.count("*").alias("n_spaxels"))


def curve_buckets(curves: DataFrame, *, id: str = "bin_id", max_buckets: int = 6, n_features: int = 5, fallback: bool = False) -> tuple[DataFrame, DataFrame]:
    """Curves in at most ``max_buckets`` groups: ``(id, bucket)`` and ``(bucket, wave, value)``.

    Up to ``max_buckets`` curves keep a bucket each. Beyond that, k-means on the curve at
    ``n_features`` wavelengths divided by their spread, from fixed starts, or with ``fallback``
    quantile classes of the mean. The bucket's curve is the mean of its members.
    """
    ids = curves.select(id).distinct()
    few = ids.limit(max_buckets + 1).count() <= max_buckets
    if few:
        # At most ``max_buckets`` rows.
        member = ids.withColumn("bucket", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(id)) - 1).cast("int"))
    else:
        ends = curves.agg(F.min("wave").alias("a"), F.max("wave").alias("b"), F.countDistinct("wave").alias("n")).first()
        step = (ends["b"] - ends["a"]) / max(ends["n"] - 1, 1)
        points = [ends["a"] + (ends["b"] - ends["a"]) * i / (n_features - 1) for i in range(n_features)]
        asked = ids.select(F.col(id).alias("curve_id"), F.posexplode(F.array(*[F.lit(p) for p in points])).alias("k", "x"))
        at = interp_at(asked, curves.withColumnRenamed(id, "curve_id"), x="x", step=step, clamp=True)
        feats = [f"f{i}" for i in range(n_features)]
        wide = measured(at.groupBy("curve_id").agg(*[F.max(F.when(F.col("k") == i, F.col("value"))).alias(f) for i, f in enumerate(feats)]))
        if fallback:
            mean = sum((F.col(f) for f in feats), F.lit(0.0)) / n_features
            wide = wide.withColumn("_m", mean)
            q = quantiles(wide, [], "_m", {f"q{i}": i / max_buckets for i in range(1, max_buckets)})
            cut = on_keys(wide, q, [])
            bucket = sum((F.when(F.col("_m") > F.col(f"q{i}"), 1).otherwise(0) for i in range(1, max_buckets)), F.lit(0))
            member = cut.select(F.col("curve_id").alias(id), bucket.cast("int").alias("bucket"))
        else:
            sd = wide.agg(*[F.stddev_pop(f).alias(f) for f in feats]).first()
            scaled = wide.select("curve_id", *[(F.col(f) / (sd[f] if sd[f] else 1.0)).alias(f) for f in feats])
            member = lloyd(measured(scaled), feats, k=max_buckets).select(F.col("curve_id").alias(id), "bucket")
    member = measured(member)
    shape = curves.join(member, id).groupBy("bucket", "wave").agg(F.avg("value").alias("value"))
    return member, shape


def lloyd(rows: DataFrame, features: Sequence[str], *, k: int, rounds: int = 30) -> DataFrame:
    """``rows`` with ``bucket``, the nearest of ``k`` centres (ties: the lower number).

    Centres start at the (i + 1/2) / k quantiles of every feature and become the means of their
    members until none changes or ``rounds`` are over; one without members stays. A round is one
    aggregate of sums that combine before the shuffle; ``k`` centres reach the driver.
    """
    spread = [quantiles(rows, [], f, {f"q{i}": (i + 0.5) / k for i in range(k)}).first() for f in features]
    centres = [[float(q[f"q{i}"]) for q in spread] for i in range(k)]

    def nearest() -> Column:
        away = [sum(((F.col(f) - v) * (F.col(f) - v) for f, v in zip(features, c, strict=True)), F.lit(0.0)) for c in centres]
        return F.array_position(F.array(*away), F.array_min(F.array(*away))).cast("int") - 1

    for _ in range(rounds):
        found = rows.groupBy(nearest().alias("bucket")).agg(*[F.avg(f).alias(f) for f in features]).collect()  # k rows
        new = list(centres)
        for r in found:
            new[r["bucket"]] = [float(r[f]) for f in features]
        moved = max(abs(x - y) for a, b in zip(new, centres, strict=True) for x, y in zip(a, b, strict=True))
        centres = new
        if moved <= 1e-9:
            break
    return rows.withColumn("bucket", nearest())


def two_populations(points: DataFrame, value: str, *, rounds: int = 50, tolerance: float = 1e-3) -> DataFrame:
    """``points`` with ``_c``, 0 or 1: the likelier of two normal populations of ``value``.

    Expectation maximisation from the quartiles as means, equal shares and the whole variance,
    until the mean log likelihood gains less than ``tolerance``. A round is one aggregate of
    sufficient statistics; seven numbers reach the driver.
    """
    x = F.col(value).cast("double")
    start = points.agg(F.var_pop(x).alias("v")).first()["v"]
    q = quantiles(points, [], value, {"a": 0.25, "b": 0.75}).first()
    mean, var, share = [q["a"], q["b"]], [start, start], [0.5, 0.5]

    def chances() -> list[Column]:
        return [F.lit(math.log(s) - 0.5 * math.log(2 * math.pi * v)) - (x - m) * (x - m) / (2 * v) for m, v, s in zip(mean, var, share, strict=True)]

    before = None
    for _ in range(rounds):
        a, b = chances()
        top = F.greatest(a, b)
        whole = top + F.log(F.exp(a - top) + F.exp(b - top))
        part = F.exp(a - whole)
        got = points.where(x.isNotNull()).select(x.alias("x"), part.alias("r"), whole.alias("l"))
        got = got.agg(
            F.count("*").alias("n"), F.sum("l").alias("l"), F.sum("r").alias("r"), F.sum("x").alias("x"), F.sum(F.col("r") * F.col("x")).alias("rx"),
            F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("r") * F.col("x") * F.col("x")).alias("rxx"),
        ).first()
        weight = [got["r"], got["n"] - got["r"]]
        if min(weight) <= 0:
            break
        first = [got["rx"], got["x"] - got["rx"]]
        second = [got["rxx"], got["xx"] - got["rxx"]]
        mean = [f / w for f, w in zip(first, weight, strict=True)]
        var = [max(s / w - m * m, 0.0) + 1e-6 for s, w, m in zip(second, weight, mean, strict=True)]
        share = [w / got["n"] for w in weight]
        level = got["l"] / got["n"]
        if before is not None and abs(level - before) < tolerance:
            break
        before = level
    a, b = chances()
    return points.withColumn("_c", F.when(a >= b, 0).otherwise(1))


def arc_outliers(points: DataFrame, *, width: float = 50.0, clip: float = 3.0, min_points: int = 5) -> DataFrame:
    """Points ``(point_id, nspec, wave, fwhm)`` that survive the clip in their wavelength bin.

    Bins hold points of all fibres, so their medians are distributed order statistics. A fibre
    that would lose every point keeps them all.
    """
    ends = points.agg(F.min("wave").alias("a"), F.max("wave").alias("b")).first()
    if ends["a"] is None:
        return points
    n = max(1, int((ends["b"] - ends["a"]) / width))
    size = (ends["b"] - ends["a"]) / n or 1.0
    rows = points.withColumn("_b", F.least(F.floor((F.col("wave") - ends["a"]) / size), F.lit(n - 1)))
    stats = rows.groupBy("_b").agg(F.stddev_pop("fwhm").alias("_s"), F.count("*").alias("_n")).join(quantiles(rows, ["_b"], "fwhm", {"_m": 0.5}), "_b")
    rows = rows.join(measured(stats), "_b")
    bad = (F.col("_n") >= min_points) & (F.col("_s") > 0) & (F.abs(F.col("fwhm") - F.col("_m")) > F.col("_s") * clip)
    rows = rows.withColumn("_ok", ~bad)
    fibres = measured(rows.groupBy("nspec").agg(F.bool_or("_ok").alias("_any")))
    return rows.join(fibres, "nspec").where(F.col("_ok") | ~F.col("_any")).select(*points.columns)


def fibre_clean(points: DataFrame, *, clip: float = 5.0, min_points: int = 5) -> DataFrame:
    """Per fibre: live fibres and good fits, clip by the median absolute deviation, median of
    points at one wavelength; fibres with too few points are dropped."""
    rows = points.where("live = 1 AND fit_flag = 0").select("nspec", "wave", "fwhm")
    mid = measured(quantiles(rows, ["nspec"], "fwhm", {"_m": 0.5}))
    rows = rows.join(mid, "nspec").withColumn("_d", F.abs(F.col("fwhm") - F.col("_m")))
    mad = measured(quantiles(rows, ["nspec"], "_d", {"_mad": 0.5}))
    rows = rows.join(mad, "nspec").where((F.col("_mad") == 0) | (F.col("_d") <= F.col("_mad") * (clip * MAD_TO_SIGMA)))
    kept = rows.groupBy("nspec").agg(F.count("*").alias("_n"), F.max("_mad").alias("_mad"), F.countDistinct("wave").alias("_u"))
    kept = kept.where((F.col("_u") >= min_points) & ((F.col("_n") >= min_points) | (F.col("_mad") == 0))).select("nspec")
    out = quantiles(rows, ["nspec", "wave"], "fwhm", {"fwhm": 0.5})
    return out.join(kept, "nspec", "left_semi")


def dominant_population(points: DataFrame, *, min_share: float = 0.2, min_skew: float = 0.5) -> DataFrame:
    """Drop the minority of two populations of widths, if the distribution is skewed and the
    minority is large enough; a fibre that would lose every point keeps them all."""
    s = points.agg(F.count("fwhm").alias("n"), F.skewness("fwhm").alias("k")).first()
    if s["n"] < 20 or s["k"] is None or math.isnan(s["k"]) or abs(s["k"]) < min_skew:
        return points
    rows = measured(two_populations(points, "fwhm"))
    sizes = {r["_c"]: r["count"] for r in rows.groupBy("_c").count().collect()}
    if len(sizes) < 2 or min(sizes.values()) / s["n"] < min_share:
        return points
    main = max(sizes, key=lambda c: (sizes[c], -c))
    fibres = measured(rows.groupBy("nspec").agg(F.bool_or(F.col("_c") == main).alias("_any")))
    return rows.join(fibres, "nspec").where((F.col("_c") == main) | ~F.col("_any")).select(*points.columns)


def fill_missing_fibres(curves: DataFrame, *, max_nspec: int | None = None) -> DataFrame:
    """Every fibre number from 1 to ``max_nspec``, or to the largest one, with a curve; missing
    ones copy the nearest existing fibre (the lower of two equally near) and say so in
    ``copied_from``. Fibres outside that range stay.

    Each fibre spreads over the missing numbers up to the next one, which it knows from
    ``next_value``: no window sees all fibre numbers.
    """
    have = curves.where(F.col("nspec").isNotNull()).select(F.col("nspec").alias("src")).distinct()
    ends = have.agg(F.struct(F.min("src").alias("first"), F.max("src").alias("last")).alias("e")).scalar()
    gaps = next_value(have, [], "src").select("src", "nxt", ends.alias("_e"))
    last = F.col("_e.last") if max_nspec is None else F.lit(max_nspec)
    low = F.when(F.col("src") == F.col("_e.first"), F.least(F.col("src"), F.lit(1))).otherwise(F.col("src"))
    high = F.coalesce(F.col("nxt") - 1, F.greatest(F.col("src"), last))
    numbers = gaps.withColumn("last", last).withColumn("nspec", F.explode(F.sequence(low, high)))
    numbers = numbers.where((F.col("nspec") == F.col("src")) | F.col("nspec").between(F.lit(1), F.col("last")))
    below = F.col("nxt").isNull() | (F.col("nspec") - F.col("src") <= F.col("nxt") - F.col("nspec"))
    source = numbers.select("nspec", F.when(below, F.col("src")).otherwise(F.col("nxt")).alias("_from"))
    picked = source.withColumn("copied_from", F.when(F.col("nspec") != F.col("_from"), F.col("_from")))
    data = curves.withColumnRenamed("nspec", "_from")
    return picked.join(data, "_from").drop("_from")


def merge_curves(blue: DataFrame, red: DataFrame, *, start: float, stop: float, step: float, floor: float = 0.1) -> DataFrame:
    """Two arms in one curve per fibre on a common grid: own curve inside each range, a straight
    line between the two ends, flat outside, never below ``floor``. Fibres of both arms only."""

    def ends(c: DataFrame, p: str) -> DataFrame:
        return c.groupBy("nspec").agg(
            F.min("wave").alias(p + "0"), F.max("wave").alias(p + "1"), F.min_by("value", "wave").alias(p + "v0"), F.max_by("value", "wave").alias(p + "v1")
        )

    n = int(round((stop - start) / step))
    grid = ends(blue, "b").join(ends(red, "r"), "nspec").withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n))))
    grid = grid.withColumn("wave", F.col("_i") * step + start).withColumn("curve_id", F.col("nspec"))
    for name, c in (("_blue", blue), ("_red", red)):
        grid = interp_at(grid, c.withColumnRenamed("nspec", "curve_id"), x="wave", step=step, name=name)
    w = F.col("wave")
    alpha = F.when(F.col("r0") > F.col("b1"), ratio(w - F.col("b1"), F.col("r0") - F.col("b1"))).otherwise(0.5)
    value = (
        F.when(w < F.col("b0"), F.col("bv0"))
        .when(w > F.col("r1"), F.col("rv1"))
        .when(w <= F.col("b1"), F.coalesce("_blue", "bv1"))
        .when(w >= F.col("r0"), F.coalesce("_red", "rv0"))
        .otherwise(F.col("bv1") + (F.col("rv0") - F.col("bv1")) * alpha)
    )
    return grid.select("nspec", "wave", F.greatest(value, F.lit(floor)).alias("value"))


def kernel(size: int, kind: str = "boxcar") -> list[float]:
    """Normalised smoothing kernel of odd length."""
    size = size if size % 2 else size + 1
    h = size // 2
    if kind == "boxcar":
        k = [1.0] * size
    elif kind == "gaussian":
        k = [math.exp(-0.5 * ((i - h) / (size / 6.0)) ** 2) for i in range(size)]
    elif kind == "hanning":
        k = [0.5 - 0.5 * math.cos(2 * math.pi * i / (size - 1)) for i in range(size)] if size > 1 else [1.0]
    else:
        raise ValueError(f"unknown kernel {kind!r}")
    total = sum(k)
    return [v / total for v in k]


def smooth_curves(curves: DataFrame, *, size: int, kind: str = "boxcar", keys: Sequence[str] = ("nspec",)) -> DataFrame:
    """Curves convolved with a short kernel, mirrored at the ends (end point not repeated).

    A curve is gathered once as an array of its grid, whose length is fixed, and smoothed by
    array functions; a window per kernel tap would sort the same rows again and again.
    """
    keys = list(keys)
    k = kernel(size, kind)
    h = len(k) // 2
    taps = F.array(*[F.lit(v) for v in k])
    arr = curves.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("wave", "value"))).alias("_c"))
    arr = arr.withColumns({"_v": F.col("_c")["value"], "_n": F.size("_c")})

    def mirrored(j: Column) -> Column:
        j = F.abs(j)
        return F.when(j > F.col("_n") - 1, (F.col("_n") - 1) * 2 - j).otherwise(j)

    def one(i: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(-h), F.lit(h)), F.lit(0.0), lambda acc, o: acc + F.get(taps, o + h) * F.get(F.col("_v"), F.greatest(F.lit(0), mirrored(i + o)))
        )

    smooth = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), one)
    out = arr.select(*keys, F.explode(F.arrays_zip(F.col("_c")["wave"].alias("wave"), smooth.alias("value"))).alias("e"))
    return out.select(*keys, "e.wave", "e.value")


def curve_lookup(target: DataFrame, spaxel_ids: DataFrame, fibre_ids: DataFrame) -> DataFrame:
    """Where the curve of a target comes from: its own spaxel, its fibre number, or overall."""
    a = spaxel_ids.select(F.col("spaxel_id").alias("target_id"), F.lit(True).alias("_s")).distinct()
    b = fibre_ids.select("nspec", F.lit(True).alias("_f")).distinct()
    out = target.join(a, "target_id", "left").join(b, "nspec", "left")
    kind = F.when(F.col("_s"), "spaxel").when(F.col("_f"), "fibre").otherwise("global")
    key = F.when(F.col("_s"), F.col("target_id")).when(F.col("_f"), F.col("nspec"))
    return out.select("target_id", "nspec", kind.alias("source"), key.alias("curve_key"))
