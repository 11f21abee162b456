"""Reports on runs, flags, observations and file lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OUTCOMES = ("written", "no_valid_spaxels", "failed")
# Job states that count as killed.
KILLED = ("TIMEOUT", "CANCELLED", "OUT_OF_MEMORY", "NODE_FAIL", "BOOT_FAIL", "DEADLINE", "PREEMPTED")
ARM_ORDER = ("BLUE", "GREEN", "RED")


def patch_yield(attempts: DataFrame, *, keys: Sequence[str] = ("run", "stage"), low: float = 0.5, min_attempts: int = 10) -> DataFrame:
    """Counts per outcome, the yield, and whether the run is poor or has failed."""
    out = attempts.groupBy(*keys).agg(
        F.count("*").alias("attempted"), *[F.sum(F.when(F.col("outcome") == o, 1).otherwise(0)).alias(o) for o in OUTCOMES]
    )
    share = F.col("written") / F.col("attempted")
    return out.withColumns(
        {"yield": F.round(share, 3), "low_yield": share < low, "run_failed": (F.col("attempted") >= min_attempts) & (F.col("written") == 0)}
    )


def killed_jobs(jobs: DataFrame, *, tag: str, states: Sequence[str] = KILLED) -> DataFrame:
    """Jobs of a tag (suffix of the name) whose first state word is a bad one."""
    first = F.upper(F.element_at(F.split(F.trim("state"), " +"), 1))
    return jobs.withColumn("state", first).where(F.endswith("name", F.lit("_" + tag)) & F.col("state").isin(list(states)))


def flag_counts(rows: DataFrame, *, names: Sequence[str], flags: str = "flags") -> DataFrame:
    """How many rows have each named bit, bits in the order of the names."""
    counts = rows.agg(F.array(*[F.sum(F.shiftright(F.col(flags), k).bitwiseAND(F.lit(1).cast("bigint"))) for k in range(len(names))]).alias("c"))
    return counts.select(F.posexplode("c").alias("bit", "n_rows")).withColumn("flag", F.get(F.array(*[F.lit(n) for n in names]), F.col("bit")))


def decode_flags(flags: Column, names: Sequence[str]) -> Column:
    """Names of the set bits."""
    return F.array_compact(F.array(*[F.when(F.shiftright(flags, k).bitwiseAND(F.lit(1).cast("bigint")) == 1, F.lit(n)) for k, n in enumerate(names)]))


def encode_flags(set_names: Column, names: Sequence[str]) -> Column:
    known = F.array(*[F.lit(n) for n in names])
    one = F.lit(1).cast("bigint")
    return F.aggregate(set_names, F.lit(0).cast("bigint"), lambda acc, n: acc.bitwiseOR(F.call_function("shiftleft", one, (F.array_position(known, n) - 1).cast("int"))))


def observation_summary(exposures: DataFrame, *, by: str = "obs_id") -> DataFrame:
    """One line per observation and its consistency: one mode and resolution, distinct arms.

    The sets hold at most the few modes, arms and surveys that exist.
    """
    arms = F.collect_set("arm")
    surveys = F.collect_set(F.when(F.trim("survey") != "", F.trim("survey")))
    return exposures.groupBy(by).agg(
        F.min("mode").alias("mode"),
        F.min("resolution").alias("resolution"),
        F.array_join(F.filter(F.array(*[F.lit(a) for a in ARM_ORDER]), lambda a: F.array_contains(arms, a)), ",").alias("arms"),
        F.array_join(F.array_sort(surveys), ",").alias("surveys"),
        F.min("wmin").alias("wmin"),
        F.max("wmax").alias("wmax"),
        (F.min("mode") == F.max("mode")).alias("one_mode"),
        (F.min("resolution") == F.max("resolution")).alias("one_resolution"),
        (F.size(arms) == F.count("*")).alias("distinct_arms"),
    )


def file_changes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Status of every path of two lists ``(path, component, size, hash)``."""
    left = a.select("path", F.col("component").alias("ca"), F.col("size").alias("sa"), F.col("hash").alias("ha"))
    right = b.select("path", F.col("component").alias("cb"), F.col("size").alias("sb"), F.col("hash").alias("hb"))
    both = left.join(right, "path", "full_outer")
    status = (
        F.when(F.col("cb").isNull(), "missing")
        .when(F.col("ca").isNull(), "extra")
        .when((F.col("sa") != F.col("sb")) | (F.col("ha") != F.col("hb")), "changed")
        .otherwise("same")
    )
    return both.select("path", F.coalesce("ca", "cb").alias("component"), status.alias("status"))


def component_digest(files: DataFrame) -> DataFrame:
    """Files, bytes and two order-free digests per component.

    The digests are sums of parts of the hash of each line, so they combine before the
    shuffle; a digest of the sorted list would need a component's files in one task.
    """
    line = F.md5(F.concat_ws("|", "path", F.col("size").cast("string"), "hash"))
    part = lambda at: F.sum(F.conv(F.substring(line, at, 8), 16, 10).cast("bigint"))
    return files.groupBy("component").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), part(1).alias("digest_a"), part(9).alias("digest_b"))


def manifest_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Status per component of two file lists, with the file counts of each status."""
    da, db = component_digest(a), component_digest(b)
    right = db.select("component", *[F.col(c).alias(c + "_b") for c in db.columns if c != "component"])
    both = da.join(right, "component", "full_outer")
    same = (F.col("digest_a") == F.col("digest_a_b")) & (F.col("digest_b") == F.col("digest_b_b")) & (F.col("files") == F.col("files_b")) & (F.col("bytes") == F.col("bytes_b"))
    status = F.when(F.col("files_b").isNull(), "removed").when(F.col("files").isNull(), "added").when(same, "same").otherwise("changed")
    counts = file_changes(a, b).groupBy("component").agg(*[F.sum(F.when(F.col("status") == s, 1).otherwise(0)).alias("n_" + s) for s in ("same", "changed", "missing", "extra")])
    return both.select("component", status.alias("status"), "files", F.col("files_b"), "bytes", "bytes_b").join(counts, "component", "left")


def template_grid(templates: DataFrame, *, axes: Sequence[str] = ("age", "metal", "alpha")) -> DataFrame:
    """Distinct values of each axis among good templates, and of their combinations."""
    good = templates.where("flag = 0")
    return good.agg(*[F.countDistinct(a).alias("n_" + a) for a in axes], F.countDistinct(*axes).alias("n_combinations"))


def split_ranges(ranges: DataFrame, *, keys: Sequence[str] = ("spec_id",)) -> DataFrame:
    """Arm ranges ``(keys, arm, lo, hi)`` shortened to the rounded centre of each overlap, and
    the length of the overlap with the next arm. A few arms per key."""
    w = Window.partitionBy(*keys).orderBy("lo")
    prev_hi, next_lo = F.lag("hi").over(w), F.lead("lo").over(w)
    rows = ranges.withColumns({"_ph": prev_hi, "_nl": next_lo})
    lo = F.when(F.col("_ph") > F.col("lo"), F.round((F.col("_ph") + F.col("lo")) / 2, 1)).otherwise(F.col("lo"))
    hi = F.when(F.col("_nl") < F.col("hi"), F.round((F.col("_nl") + F.col("hi")) / 2, 1)).otherwise(F.col("hi"))
    overlap = F.greatest(F.col("hi") - F.col("_nl"), F.lit(0.0))
    out = rows.select(*keys, "arm", lo.alias("lo"), hi.alias("hi"), F.coalesce(overlap, F.lit(0.0)).alias("overlap"), (F.col("_nl") < F.col("hi")).alias("open_end"))
    return out.withColumn("open_end", F.coalesce("open_end", F.lit(False)))


def split_at(spectrum: DataFrame, ranges: DataFrame, *, keys: Sequence[str] = ("spec_id",)) -> DataFrame:
    """Arm of every pixel of a joined spectrum. At the centre of an overlap the first arm ends
    before it and the second starts at it; elsewhere both ends of a range belong to it."""
    r = split_ranges(ranges, keys=keys)
    on = [F.col(f"p.{k}") == F.col(f"r.{k}") for k in keys]
    inside = (F.col("p.wave") >= F.col("r.lo")) & F.when(F.col("r.open_end"), F.col("p.wave") < F.col("r.hi")).otherwise(F.col("p.wave") <= F.col("r.hi"))
    cond = inside
    for c in on:
        cond = cond & c
    return spectrum.alias("p").join(r.alias("r"), cond).select("p.*", F.col("r.arm").alias("arm"))
