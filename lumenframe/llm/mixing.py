"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.base import stage

HASH_BITS, STEP_BITS = 60, 12


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def source_targets(totals: DataFrame, *, weights: Sequence[float], share: float, max_repeat: float) -> DataFrame:
    """Target size per source: ``totals`` (src, source_size) gets ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times
    the whole size. A target stops at ``max_repeat`` times its source; the excess goes to the
    others by weight until none is above. That fixed point is min(cap, level * weight), whose
    level follows from one pass over the sources by cap per weight. The window has one row per
    source of the mixture.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("src").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    capped = totals.withColumn("w", w).withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    capped = capped.withColumn("ratio", F.col("cap") / F.col("w"))
    order = everything.orderBy("ratio", F.col("src").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    capped = capped.withColumns({
        "budget": F.lit(float(share)) * F.sum("source_size").over(everything),
        "before": F.coalesce(F.sum("cap").over(upto), F.lit(0.0)),
        "rest_w": F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    level = (F.col("budget") - F.col("before")) / F.col("rest_w")
    # The first source whose cap lies at or above the level ends the capped ones.
    fits = F.when(level <= F.col("ratio"), level)
    capped = capped.withColumn("level", F.min_by(fits, F.when(fits.isNotNull(), F.col("ratio"))).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap")))
    return capped.select("src", "source_size", target.alias("target"))


def _hash(id: str) -> Column:
    """60 bits of the hash of an id; a null id hashes as the empty string."""
    digits = HASH_BITS // 4
    h = F.conv(F.substring(F.md5(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")), 1, digits), 16, 10)
    return h.cast("long")


def _thresholds(sized: DataFrame, *, weights: Sequence[float], share: float, max_repeat: float) -> DataFrame:
    """(src, size, h) to one row per source: (p_src, source_size, target, passes, cut_h, with_cut)."""
    totals = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights=weights, share=share, max_repeat=max_repeat)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = targets.withColumn("passes", passes)
    plan = stage(targets.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "targets")

    cut = plan.select("src", F.lit(0).cast("long").alias("prefix"), F.col("rest").alias("left"))
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        c = cut.select(F.col("src").alias("c_src"), "prefix", "left")
        inside = sized.join(c, F.col("src").eqNullSafe(F.col("c_src")) & (F.shiftright("h", shift + STEP_BITS) == F.col("prefix")))
        bins = inside.groupBy("src", "left", F.shiftright("h", shift).alias("prefix")).agg(F.sum("size").alias("bin"))
        # At most 4,096 rows per source.
        upto = Window.partitionBy("src").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        bins = bins.withColumn("upto", F.sum("bin").over(upto))
        holds = (F.col("upto") > F.col("left")) & (F.col("upto") - F.col("bin") <= F.col("left"))
        cut = bins.where(holds).select("src", "prefix", (F.col("left") - F.col("upto") + F.col("bin")).alias("left"), "bin")
        cut = stage(cut, "cut")
    last = cut.select(F.col("src").alias("c_src"), F.col("prefix").alias("cut_h"), (F.col("bin") <= 2 * F.col("left")).alias("with_cut"))
    p = plan.join(last, F.col("src").eqNullSafe(F.col("c_src")), "left").drop("c_src").withColumnRenamed("src", "p_src")
    return stage(p, "mixture")


def _copies(h: Column, p: str = "") -> Column:
    """How often the mix takes a row, from the hash of its id and its source's row, whose columns
    have the prefix ``p``."""
    cut = F.col(f"{p}cut_h")
    extra = (h < cut) | ((h == cut) & F.col(f"{p}with_cut"))
    return F.when(F.col(f"{p}source_size") > 0, F.col(f"{p}passes") + F.coalesce(extra, F.lit(False)).cast("int")).otherwise(0)


def _sized(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    sized = docs.select(F.col(id).alias("id"), F.col(source).alias("src"), word_count(F.col(text)).cast("long").alias("size"), _hash(id).alias("h"))
    return stage(sized, "sized")


def mix_sources(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_repeat: float = 2.0,
) -> DataFrame:
    """Copies of each document that make every source meet its target size.

    A target is a whole number of passes over its source plus a rest. Whole passes take every
    document; the rest takes the documents whose 60-bit hash of the id lies below a threshold.
    The threshold comes from histograms: sizes summed by source and the next 12 hash bits, the
    one bucket per source that holds the cut refined by the next 12 bits, five times in all.
    Nothing is sorted by hash, and only boundary buckets are read again. Documents of one source
    with equal hash (repeated ids) are taken together; at the cut they are taken when that comes
    nearer to the target. The choice depends on ids, sizes and sources only: reruns agree.

    Returns one row per input row: ``id``, ``size``, ``source``, ``source_size``, ``target``,
    ``copies``, ``taken``. Null text has size 0; a null source is a source of its own, last in
    order; a null id hashes as the empty string. A source without words has target 0, and its
    documents are taken 0 times. An empty table gives an empty result. Other columns are ignored.
    """
    sized = _sized(docs, id, text, source)
    p = _thresholds(sized, weights=weights, share=share, max_repeat=max_repeat)
    out = sized.join(p, F.col("src").eqNullSafe(F.col("p_src")))
    copies = _copies(F.col("h"))
    return out.select(
        F.col("id").alias(id), "size", F.col("src").alias(source), "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_repeat: float = 2.0,
) -> DataFrame:
    """The documents as ``mix_sources`` takes them: a document taken twice appears twice, one not
    taken is missing; their columns are unchanged. What a row is taken for follows from its id and
    source and a table of sources alone, so rows of null or repeated ids are told apart."""
    p = _thresholds(_sized(docs, id, text, source), weights=weights, share=share, max_repeat=max_repeat)
    mark = "_mix"  # for names that the documents do not have
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark += "_"
    p = p.select(*[F.col(c).alias(mark + c) for c in p.columns])
    rows = docs.withColumns({f"{mark}h": _hash(id), f"{mark}src": F.col(source)})
    out = rows.join(p, F.col(f"{mark}src").eqNullSafe(F.col(f"{mark}p_src")))
    copies = _copies(F.col(f"{mark}h"), mark)
    return out.withColumn(f"{mark}copy", F.explode(F.array_repeat(F.lit(0), copies))).select(docs.columns)
