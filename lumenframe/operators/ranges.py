"""Interval and interpolation joins: equality on a bucket of the axis, then the exact test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.exprs import ratio, usable
from lumenframe.functions.scale import cut, measured

LEVELS = 40  # doublings of a cell
SMALL_CELLS = 20_000  # cells of bands that go to all tasks
CROWD = 100_000  # rows of a cell that meet in one task


def segments(curves: DataFrame, *, keys: Sequence[str] = ("curve_id",)) -> DataFrame:
    """Consecutive points of each curve as segments ``_x0,_y0,_x1,_y1``; the last point stands alone.

    A curve is a sampled grid, so the window group is bounded by the grid size.
    """
    w = Window.partitionBy(*keys).orderBy("wave")
    return curves.where(usable(F.col("value"))).select(
        *keys,
        F.col("wave").alias("_x0"),
        F.col("value").alias("_y0"),
        F.lead("wave").over(w).alias("_x1"),
        F.lead("value").over(w).alias("_y1"),
    )


def asof(asked: DataFrame, curves: DataFrame, *, x: str, keys: Sequence[str] = ("curve_id",)) -> DataFrame:
    """``asked`` with the curve points around ``x`` within the keys: ``_below`` and ``_above``, structs
    (wave, value) of the last point at or before ``x`` and the first one after it.

    Curve points and asked rows are sorted together in range partitions of (keys, x). A partition
    fills its rows from its own points; what it lacks at its ends comes from the last point of the
    partitions before it and the first of those after it, a table of one row per partition. So a
    curve that everyone asks for spreads over partitions, and no point is copied however far it
    is to the next one.
    """
    keys, names = list(keys), asked.columns
    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    point = curves.where(usable(F.col("value")) & usable(F.col("wave")))
    own = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    place = [*[f"_k{i}" for i in range(len(keys))], "_x"]
    at = F.struct(*place[:-1], F.col("_x").alias("wave"), F.col("_y").alias("value"))
    empty = [F.lit(None).cast(asked.schema[c].dataType).alias(f"_a_{c}") for c in names]
    rows = point.select(*own, F.col("wave").cast("double").alias("_x"), F.col("value").cast("double").alias("_y"), F.lit(0).alias("_asks"), *empty)
    asks = asked.select(*own, F.col(x).cast("double").alias("_x"), F.lit(None).cast("double").alias("_y"), F.lit(1).alias("_asks"), *[F.col(c).alias(f"_a_{c}") for c in names])
    order = [*place, "_asks"]
    rows = rows.unionByName(asks).repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    rows = cut(rows.withColumn("_p", F.when(F.col("_asks") == 0, at)))
    # One row per partition.
    ends = rows.groupBy("_part").agg(F.min("_p").alias("_first"), F.max("_p").alias("_last"))
    line, back_line = (Window.partitionBy(F.lit(0)).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_part"), F.col("_part").desc()))
    before, after = F.last("_last", ignorenulls=True).over(line), F.last("_first", ignorenulls=True).over(back_line)
    ends = measured(ends.select("_part", before.alias("_before"), after.alias("_after")))
    # Windows over a range partition, which is as large as any other. Both run from the start to the
    # row, one in falling order: a frame from the row to the end is computed anew for each row.
    here, back = (Window.partitionBy("_part").orderBy(*o).rowsBetween(Window.unboundedPreceding, 0) for o in (order, [F.col(c).desc() for c in order]))
    rows = rows.withColumns({"_lo": F.last("_p", ignorenulls=True).over(here), "_hi": F.last("_p", ignorenulls=True).over(back)})
    rows = rows.where("_asks = 1").join(ends, "_part")
    for name, own_side, carried in (("_below", "_lo", "_before"), ("_above", "_hi", "_after")):
        near = F.coalesce(own_side, carried)
        same = F.lit(True)
        for i in range(len(keys)):
            same = same & (near[f"_k{i}"] == F.col(f"_k{i}"))
        rows = rows.withColumn(name, F.when(same & F.col("_x").isNotNull(), F.struct(near["wave"].alias("wave"), near["value"].alias("value"))))
    return rows.select(*[F.col(f"_a_{c}").alias(c) for c in names], "_below", "_above")


def interp_at(
    asked: DataFrame,
    curves: DataFrame,
    *,
    x: str,
    step: float | None = None,
    name: str = "value",
    clamp: bool = False,
    keys: Sequence[str] = ("curve_id",),
) -> DataFrame:
    """Linear interpolation of ``curves`` (keys, wave, value) at ``asked.x``.

    NULL outside the curve, or the end value with ``clamp``. With the ``step`` of regular curves,
    segments are copied to the few buckets of that width they touch; a query row looks into one
    bucket, so one popular curve is spread over all its buckets. Without it, or for curves with
    gaps of any length, points and rows are sorted together (``asof``) and nothing is copied.
    """
    if step is None:
        out = asof(asked, curves, x=x, keys=keys)
        lo, hi, at = F.col("_below"), F.col("_above"), F.col(x)
        line = lo["value"] + (hi["value"] - lo["value"]) * ratio(at - lo["wave"], hi["wave"] - lo["wave"])
        value = F.when(lo.isNotNull() & hi.isNotNull(), line).when(at == lo["wave"], lo["value"])
        if clamp:
            value = F.coalesce(value, F.when(at.isNotNull(), F.coalesce(lo["value"], hi["value"])))
        return out.withColumn(name, value).select(*asked.columns, name)
    seg = segments(curves, keys=keys)
    last = F.coalesce(F.col("_x1"), F.col("_x0"))
    seg = seg.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_x0") / step), F.floor(last / step))))
    seg = seg.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_key_bucket"), "_x0", "_y0", "_x1", "_y1")
    q = asked.withColumn("_bucket", F.floor(F.col(x) / step))
    on = (F.col("_bucket") == F.col("_key_bucket")) & (F.col(x) >= F.col("_x0"))
    on = on & F.when(F.col("_x1").isNull(), F.col(x) == F.col("_x0")).otherwise(F.col(x) < F.col("_x1"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    out = q.join(seg, on, "left")
    line = F.col("_y0") + (F.col("_y1") - F.col("_y0")) * ratio(F.col(x) - F.col("_x0"), F.col("_x1") - F.col("_x0"))
    out = out.withColumn(name, F.when(F.col("_x1").isNull(), F.col("_y0")).otherwise(line))
    out = out.select(*asked.columns, name)
    if clamp:
        ends = (
            curves.where(usable(F.col("value")))
            .groupBy(*keys)
            .agg(
                F.min("wave").alias("_lo"),
                F.max("wave").alias("_hi"),
                F.min_by("value", "wave").alias("_vlo"),
                F.max_by("value", "wave").alias("_vhi"),
            )
        )
        out = out.join(ends, list(keys), "left")
        held = F.when(F.col(x) <= F.col("_lo"), F.col("_vlo")).when(F.col(x) >= F.col("_hi"), F.col("_vhi")).otherwise(F.col(name))
        out = out.withColumn(name, held).select(*asked.columns, name)
    return out


def dyadic_cells(lo: Column, hi: Column, unit: float) -> Column:
    """The fewest cells (level, cell) of ``unit`` times powers of two that cover ``lo`` to ``hi``: at
    most two a level, however long the interval is."""
    first, end = F.floor(lo / unit), F.floor(hi / unit) + 1
    found = []
    for k in range(LEVELS):
        a, b = -F.shiftright(-first, k), F.shiftright(end, k)
        odd = (F.pmod(a, F.lit(2)) == 1) & (a < b)
        found.append(F.when(odd, F.struct(F.lit(k).alias("level"), a.alias("cell"))))
        rest = F.when(odd, a + 1).otherwise(a)
        found.append(F.when((F.pmod(b, F.lit(2)) == 1) & (rest < b), F.struct(F.lit(k).alias("level"), (b - 1).alias("cell"))))
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def band_join(
    df: DataFrame, bands: DataFrame, *, x: str = "wave", lo: str = "lo", hi: str = "hi", width: float = 50.0, how: str = "inner",
    small: int = SMALL_CELLS, crowd: int = CROWD,
) -> DataFrame:
    """Rows with the bands that contain ``x`` (ends included).

    A band lies in the dyadic cells that cover it, two a level at most; a row looks into one cell
    of each level that bands use. Up to ``small`` cells of bands go to all tasks. More are dealt out
    by cell, and cells with more than ``crowd`` rows, counted before, are split into as many parts
    as it takes, to each of which the bands there are copied. ``how`` other than "inner" copies the
    bands to every cell of ``width`` instead.
    """
    if how != "inner":
        b = bands.withColumn("_key_bucket", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))
        on = (F.col("_bucket") == F.col("_key_bucket")) & (F.col(x) >= F.col(lo)) & (F.col(x) <= F.col(hi))
        return df.withColumn("_bucket", F.floor(F.col(x) / width)).join(b, on, how).drop("_bucket", "_key_bucket")
    b = bands.where(F.col(lo) <= F.col(hi)).withColumn("_c", F.explode(dyadic_cells(F.col(lo), F.col(hi), width)))
    b = measured(b.select("*", F.col("_c.level").alias("_blevel"), F.col("_c.cell").alias("_bcell")).drop("_c"))
    used = sorted(r[0] for r in b.select("_blevel").distinct().collect())  # at most LEVELS
    if not used:
        return df.join(bands, F.lit(False))
    probes = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(F.floor(F.col(x) / width), k).alias("cell")) for k in used])
    inside = (F.col(x) >= F.col(lo)) & (F.col(x) <= F.col(hi))
    rows = df.where(usable(F.col(x))).withColumn("_c", F.explode(probes)).select("*", F.col("_c.level").alias("_level"), F.col("_c.cell").alias("_cell")).drop("_c")
    on = (F.col("_level") == F.col("_blevel")) & (F.col("_cell") == F.col("_bcell")) & inside
    if b.count() <= small:
        return rows.join(F.broadcast(b), on).drop("_level", "_cell", "_blevel", "_bcell")
    crowded = df.where(usable(F.col(x))).groupBy(F.floor(F.col(x) / width).alias("_x")).agg(F.count("*").alias("_n"))
    levels = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("_x", k).alias("cell")) for k in used])
    crowded = crowded.select(F.explode(levels).alias("_c"), "_n").groupBy(F.col("_c.level").alias("_clevel"), F.col("_c.cell").alias("_ccell")).agg(F.sum("_n").alias("_n"))
    crowded = measured(crowded.where(F.col("_n") > crowd).select("_clevel", "_ccell", F.ceil(F.col("_n") / crowd).alias("_parts")))
    rows = rows.join(crowded, (F.col("_level") == F.col("_clevel")) & (F.col("_cell") == F.col("_ccell")), "left").drop("_clevel", "_ccell")
    rows = rows.withColumn("_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*df.columns), F.col("_parts")))).drop("_parts")
    b = b.join(crowded, (F.col("_blevel") == F.col("_clevel")) & (F.col("_bcell") == F.col("_ccell")), "left").drop("_clevel", "_ccell")
    b = b.withColumn("_bpart", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return rows.join(b, on & (F.col("_part") == F.col("_bpart"))).drop("_level", "_cell", "_blevel", "_bcell", "_part", "_bpart")


def overlap_pairs(old: DataFrame, new: DataFrame, *, keys: Sequence[str], width: float) -> DataFrame:
    """Pairs of intervals ``[lo, hi)`` of both sides that overlap, with the length ``overlap``.

    A pair sharing several buckets is kept in the first common one only. Columns of ``old``
    are ``lo, hi``, of ``new`` ``new_lo, new_hi``.
    """
    a = old.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    b = new.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("new_lo") / width), F.floor(F.col("new_hi") / width))))
    pairs = a.join(b, [*keys, "_bucket"])
    first = F.greatest(F.floor(F.col("lo") / width), F.floor(F.col("new_lo") / width))
    length: Column = F.least("hi", "new_hi") - F.greatest("lo", "new_lo")
    return pairs.where((F.col("_bucket") == first) & (length > 0)).withColumn("overlap", length).drop("_bucket")


def overlap_rebin(old: DataFrame, new: DataFrame, *, keys: Sequence[str], new_id: str, width: float, value: str = "flux") -> DataFrame:
    """Flux-conserving change of grid: each new pixel sums the overlapping fractions of old ones."""
    pairs = overlap_pairs(old, new, keys=keys, width=width)
    part = F.col(value) * F.col("overlap") / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    return pairs.groupBy(*keys, new_id).agg(F.sum(part).alias(value))


def log_to_linear(pixel: DataFrame, *, keys: Sequence[str] = ("spec_id", "arm"), value: str = "flux") -> DataFrame:
    """Rebin a spectrum that is uniform in log wavelength (``logw``) to a linear grid of as many
    pixels, rescaled to flux density. The last new pixel is 0, as the published routine leaves it.
    """
    ends = pixel.groupBy(*keys).agg(F.min("logw").alias("l0"), F.max("logw").alias("l1"), F.count("*").alias("n"))
    d = (F.col("l1") - F.col("l0")) / F.nullif(F.col("n") - 1, F.lit(0))
    ends = ends.withColumn("d", d).withColumns({"a": F.col("l0") - F.col("d") / 2, "b": F.col("l1") + F.col("d") / 2})
    span = F.exp("b") - F.exp("a")
    new = ends.withColumn("new_pix", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
    edge0 = F.log(F.exp("a") + span * F.col("new_pix") / F.col("n"))
    edge1 = F.log(F.exp("a") + span * (F.col("new_pix") + 1) / F.col("n"))
    wave = F.exp("a") + span * (F.col("new_pix") + 0.5) / F.col("n")
    mean_width = (F.col("b") - F.col("a")) / F.col("n")
    new = new.select(*keys, "new_pix", edge0.alias("new_lo"), edge1.alias("new_hi"), wave.alias("wave"), mean_width.alias("_mw"), "n")
    old = pixel.join(ends.select(*keys, "d"), list(keys)).select(
        *keys, (F.col("logw") - F.col("d") / 2).alias("lo"), (F.col("logw") + F.col("d") / 2).alias("hi"), F.coalesce(value, F.lit(0.0)).alias(value)
    )
    binned = overlap_rebin(old, new.select(*keys, "new_pix", "new_lo", "new_hi"), keys=keys, new_id="new_pix", width=0.01, value=value)
    out = new.join(binned, [*keys, "new_pix"], "left")
    scaled = F.coalesce(F.col(value), F.lit(0.0)) / (F.col("new_hi") - F.col("new_lo")) * F.col("_mw")
    return out.select(*keys, "new_pix", "wave", F.when(F.col("new_pix") == F.col("n") - 1, 0.0).otherwise(scaled).alias(value))
