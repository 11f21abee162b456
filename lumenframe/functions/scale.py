"""Helpers that keep a plan safe when one key holds a large share of all rows.

* ``measured`` lets Catalyst see the true size of a derived side table, so that the
  planner itself decides between a broadcast and a shuffle join.
* ``quantiles`` gives exact order statistics without bringing a group into one task.
* ``number_rows`` numbers a whole table in order without a single-partition window.
* ``cut`` ends the lineage of an iterative job in the reliable checkpoint folder.
"""

from __future__ import annotations

import functools
import operator
import tempfile
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def measured(df: DataFrame) -> DataFrame:
    """Cache a derived side table and count it once.

    After the count its real size is known to the planner: it is broadcast only when it is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled otherwise. Lost blocks are
    recomputed from lineage, so an executor loss only costs time.
    """
    df = df.persist()
    df.count()
    return df


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="lumenframe-shared-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, the folder all executors share; only a local master without
    that setting (tests) gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def all_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.and_, conditions, F.lit(True))


def on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join, or a one-row scalar attach when there are no keys."""
    if keys:
        return left.join(right, list(keys), how)
    packed = right.select(F.struct(*right.columns).alias("p")).scalar()
    return left.withColumn("_p", packed).select("*", *[F.col("_p")[c].alias(c) for c in right.columns]).drop("_p")


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    wanted: Mapping[str, float],
    *,
    accuracy: int | None = None,
    direct_limit: int = 1_000_000,
) -> DataFrame:
    """Exact interpolated quantiles per key, one row per key with a column for each name.

    Groups are counted first. When the largest is at most ``direct_limit`` the built-in
    percentile holds it easily. Beyond that a mergeable sketch brackets each quantile, one
    pass counts the rows outside the bracket, and only the distinct values inside it are
    ranked. Sketch and bracket both grow with the square root of the largest group, so no
    task ever holds a whole group.
    """
    keys = list(keys)
    v = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(
        *keys, F.col(value).cast("double").alias("_v")
    )
    largest = v.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= direct_limit:
        return v.groupBy(*keys).agg(*[F.percentile("_v", F.lit(float(q))).alias(n) for n, q in wanted.items()])
    accuracy = accuracy or int(min(max(4 * largest**0.5, 10_000), 1_000_000))
    return _bracketed_quantiles(v, keys, wanted, accuracy)


def _bracketed_quantiles(v: DataFrame, keys: list[str], wanted: Mapping[str, float], accuracy: int) -> DataFrame:
    names = list(wanted)
    margin = 2.0 / accuracy
    marks = []
    for name in names:
        marks += [max(0.0, wanted[name] - margin), min(1.0, wanted[name] + margin)]
    sketch = measured(
        v.groupBy(*keys).agg(
            F.count("*").alias("_total"),
            F.percentile_approx("_v", [float(m) for m in marks], accuracy).alias("_marks"),
        )
    )
    spec = F.array(
        *[
            F.struct(
                F.lit(i).alias("_q"),
                F.col("_marks")[2 * i].alias("_lo"),
                F.col("_marks")[2 * i + 1].alias("_hi"),
                (F.lit(float(wanted[name])) * (F.col("_total") - 1)).alias("_pos"),
            )
            for i, name in enumerate(names)
        ]
    )
    tagged = on_keys(v, sketch, keys).select(*keys, "_v", F.explode(spec).alias("_span"))
    tagged = tagged.select(*keys, "_v", *[F.col("_span")[c].alias(c) for c in ("_q", "_lo", "_hi", "_pos")])
    # Below and above the bracket only the count and the value next to it matter.
    zone = F.when(F.col("_v") < F.col("_lo"), F.lit(-1)).when(F.col("_v") > F.col("_hi"), F.lit(1)).otherwise(F.lit(0))
    counted = (
        tagged.withColumn("_zone", zone)
        .groupBy(*keys, "_q", "_pos", "_zone", F.when(F.col("_zone") == 0, F.col("_v")).alias("_inside"))
        .agg(F.count("*").alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
        .withColumn("_val", F.when(F.col("_zone") < 0, F.col("_mx")).when(F.col("_zone") > 0, F.col("_mn")).otherwise(F.col("_inside")))
    )
    run = Window.partitionBy(*keys, "_q").orderBy("_val").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.sum("_c").over(run))
    low, high = F.floor("_pos"), F.ceil("_pos")
    picked = upto.groupBy(*keys, "_q", "_pos").agg(
        F.min(F.when(F.col("_upto") > low, F.col("_val"))).alias("_v0"),
        F.min(F.when(F.col("_upto") > high, F.col("_val"))).alias("_v1"),
    )
    out = picked.withColumn("_x", F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col("_pos") - F.floor("_pos")))
    return out.groupBy(*keys).agg(*[F.max(F.when(F.col("_q") == i, F.col("_x"))).alias(n) for i, n in enumerate(names)])


def number_rows(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Number all rows in ``order`` (which must be total), starting after ``start``.

    Range partitioning sorts in parallel; the position inside a partition plus the sizes of
    the partitions before it give the number. The sorted rows are checkpointed so that both
    uses see the same partitions even if an executor is lost in between.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = cut(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_m", F.monotonically_increasing_id())
    )
    shift = 33
    sizes = ranged.groupBy(F.shiftright("_m", shift).alias("_part")).agg(F.count("*").alias("_c"))
    # One row per partition: the only unpartitioned window, over at most ``parts`` rows.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = measured(sizes.select("_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off")))
    inside = F.col("_m").bitwiseAND(F.lit((1 << shift) - 1))
    return (
        ranged.withColumn("_part", F.shiftright("_m", shift))
        .join(offsets, "_part")
        .withColumn(name, F.col("_off") + inside + 1 + start)
        .drop("_m", "_part", "_off")
    )


def bucketed(df: DataFrame, keys: Sequence[str], value: str, *, parts: int = 100) -> DataFrame:
    """Add ``_b``, the number of per-key splitters below the value: buckets of about equal
    row counts that are ordered by value and never split equal values."""
    keys = list(keys)
    marks = [i / parts for i in range(1, parts)]
    split = measured(df.groupBy(*keys).agg(F.percentile_approx(F.col(value).cast("double"), marks, 1000).alias("_s")))
    out = on_keys(df, split, keys)
    return out.withColumn("_b", F.size(F.filter("_s", lambda m: m < F.col(value)))).drop("_s")


def top_rows(df: DataFrame, keys: Sequence[str], value: str, id: str, *, count: str) -> DataFrame:
    """The ``count`` (a column, constant per key) rows of largest ``value`` per key, ties by id.

    Whole buckets above the cut are kept by their counts; only the one bucket that holds the
    cut is ranked, so a huge key never sits in one task.
    """
    keys = list(keys)
    b = bucketed(df, keys, value)
    sizes = b.groupBy(*keys, "_b").agg(F.count("*").alias("_c"))
    above = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = measured(sizes.withColumn("_above", F.coalesce(F.sum("_c").over(above), F.lit(0))))
    rows = b.join(sizes, [*keys, "_b"])
    whole = rows.where(F.col("_above") + F.col("_c") <= F.col(count))
    cut_in = rows.where((F.col("_above") < F.col(count)) & (F.col("_above") + F.col("_c") > F.col(count)))
    rank = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(F.col(value).desc(), F.col(id)))
    part = cut_in.withColumn("_r", rank).where(F.col("_above") + F.col("_r") <= F.col(count)).drop("_r")
    return whole.unionByName(part).drop("_b", "_c", "_above")


def next_value(df: DataFrame, keys: Sequence[str], value: str, *, parts: int = 100) -> DataFrame:
    """Distinct values per key with the next larger one (``nxt``), without one window per key:
    neighbours inside a bucket, and bucket ends through the small table of bucket minima."""
    keys = list(keys)
    b = bucketed(df.select(*keys, value).distinct(), keys, value, parts=parts)
    inner = F.lead(value).over(Window.partitionBy(*keys, "_b").orderBy(value))
    mins = b.groupBy(*keys, "_b").agg(F.min(value).alias("_mn"))
    after = F.lead("_mn").over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_b"))
    mins = measured(mins.select(*keys, "_b", after.alias("_after")))
    out = b.withColumn("_in", inner).join(mins, [*keys, "_b"])
    return out.select(*keys, value, F.coalesce("_in", "_after").alias("nxt"))
