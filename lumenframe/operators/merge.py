"""Joins of result tables into one product."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.functions.scale import all_of, number_rows


def fill_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Missing join keys as -999, NaN or 'nan', so that they meet each other in the join."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in keys:
            if isinstance(f.dataType, T.StringType):
                c = F.coalesce(c, F.lit("nan"))
            elif isinstance(f.dataType, T.IntegralType):
                c = F.coalesce(c, F.lit(-999).cast(f.dataType))
            else:
                c = F.coalesce(c, F.lit(float("nan")).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _outer_join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join; columns of one name on both sides get the suffixes _1 and _2."""
    both = [c for c in a.columns if c in b.columns and c not in keys]
    a = a.withColumnsRenamed({c: c + "_1" for c in both})
    b = b.withColumnsRenamed({c: c + "_2" for c in both})
    return a.join(b, keys, "full_outer")


def _in_turn(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``name`` is 0 for rows with all keys; the others are numbered from 1, in the order of all
    their columns. They may be many and have one key: they are numbered over range partitions."""
    whole = all_of([F.col(k).isNotNull() for k in keys])
    lone = number_rows(df.where(~whole), [F.col(c).asc_nulls_first() for c in df.columns], name)
    return df.where(whole).withColumn(name, F.lit(0).cast("bigint")).unionByName(lone.withColumn(name, F.col(name).cast("bigint")))


def outer_merge(
    tables: Sequence[DataFrame | None], keys: Sequence[str], *, exclude: Sequence[str] = (), exclude_prefix: Sequence[str] = (), keys_first: bool = True, missing: str = "meet"
) -> tuple[DataFrame | None, int]:
    """Left fold of full outer joins; returns the table and -1 if any input is missing, else 0.

    All joins use the same keys, so after the first one each further join shuffles only its
    new side. Rows whose keys are missing all meet each other, as published (``missing="meet"``),
    or in turn, the first with the first (``"pair"``): then k and m of them make the larger number
    of rows and not k times m. Columns have to be as many as in the inputs, keys counted once, and
    their names unique, else a ValueError says which are not.
    """
    if missing not in ("meet", "pair"):
        raise ValueError(f"missing is 'meet' or 'pair', not {missing!r}")
    turn = "_turn"
    flag = -1 if any(t is None for t in tables) else 0
    ready = []
    for t in tables:
        if t is None:
            continue
        drop = [c for c in t.columns if c not in keys and (c in exclude or any(c.startswith(p) for p in exclude_prefix))]
        t = t.drop(*drop)
        ready.append(fill_keys(_in_turn(t, keys, turn) if missing == "pair" else t, keys))
    if not ready:
        return None, -1
    on = [*keys, turn] if missing == "pair" else list(keys)
    out = functools.reduce(lambda a, b: _outer_join(a, b, on), ready)
    want = sum(len(t.columns) for t in ready) - len(on) * (len(ready) - 1)
    twice = sorted({c for c in out.columns if out.columns.count(c) > 1})
    if len(out.columns) != want or twice:
        raise ValueError(f"{want} columns come in and {len(out.columns)} go out; repeated names: {twice}")
    out = out.drop(turn)
    if keys_first:
        out = out.select(*keys, *[c for c in out.columns if c not in keys])
    return out, flag


def merge_quality_flag(observations: DataFrame, components: Mapping[str, DataFrame], *, by: str = "obs_id", class_table: str, star: str, galaxy: str) -> DataFrame:
    """Sum of 2^k for every absent component, in the order given, and whether a product can be
    made: the class table must not be empty, nor star and galaxy tables both.

    Every component shrinks to one row per observation before the joins.
    """
    names = list(components)
    out = observations.select(by)
    for n in names:
        out = out.join(components[n].groupBy(by).agg(F.count("*").alias(f"n_{n}")), by, "left")
    counts = {n: F.coalesce(F.col(f"n_{n}"), F.lit(0)) for n in names}
    flag = sum((F.when(counts[n] == 0, 2**k).otherwise(0) for k, n in enumerate(names)), F.lit(0))
    ok = (counts[class_table] > 0) & (counts[star] + counts[galaxy] > 0)
    return out.select(by, flag.cast("bigint").alias("quality_flag"), ok.alias("written"))


def add_extra_columns(df: DataFrame, side: DataFrame, *, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Outer join of the requested columns of a side table."""
    return df.join(side.select(*keys, *columns), list(keys), "full_outer")


def attach_scan(best: DataFrame, scan: DataFrame, *, templates: Sequence[str]) -> DataFrame:
    """One pair of arrays per template (redshifts, chi2), ordered by redshift and index.

    The pivot values are given, so no extra job looks for them; an array is as long as the
    redshift grid of its template.
    """
    packed = scan.groupBy("target_id", "template").agg(F.array_sort(F.collect_list(F.struct("z", "i", "chi2"))).alias("s"))
    wide = packed.groupBy("target_id").agg(
        *[F.first(F.when(F.col("template") == t, F.col("s")), ignorenulls=True).alias(f"_s{k}") for k, t in enumerate(templates)]
    )
    cols = []
    for k, t in enumerate(templates):
        name = t.replace(":::", "_")
        cols += [F.col(f"_s{k}")["z"].alias(f"CZZ_{name}"), F.col(f"_s{k}")["chi2"].alias(f"CZZ_CHI2_{name}")]
    return best.join(wide.select("target_id", *cols), "target_id", "left")


def broadcast_bin_values(spaxel: DataFrame, result: DataFrame) -> DataFrame:
    """Results of a bin for every spaxel whose \\|bin_id\\| equals it; NULL where there is none."""
    return spaxel.withColumn("_bin", F.abs("bin_id")).join(result.withColumnRenamed("bin_id", "_bin"), "_bin", "left").drop("_bin")


def arm_of_exposure(chain: DataFrame, *, obs: str, arm: str, order: str, first: str) -> DataFrame:
    """The n-th provenance entry of the first arm with the n-th entry of every other arm.

    A chain has at most as many entries as an observation has exposures.
    """
    w = Window.partitionBy(obs, arm).orderBy(order)
    rows = chain.withColumn("n", F.row_number().over(w) - 1)
    a = rows.where(F.col(arm) == first).select(obs, "n", F.col("file").alias("file"))
    b = rows.where(F.col(arm) != first).select(obs, "n", F.col(arm).alias("other_arm"), F.col("file").alias("other_file"))
    return a.join(b, [obs, "n"], "left")


def target_summary_join(target: DataFrame, best_class: DataFrame, star: DataFrame, galaxy: DataFrame) -> DataFrame:
    """One line per target: survey row, class at rank 0, star row and galaxy row; missing
    numbers -999 and missing text '000'."""
    out = target.join(best_class, "target_id", "left").join(star, "target_id", "left").join(galaxy, "target_id", "left")
    cols = []
    for f in out.schema.fields:
        c = F.col(f.name)
        if f.name != "target_id":
            c = F.coalesce(c, F.lit("000") if isinstance(f.dataType, T.StringType) else F.lit(-999).cast(f.dataType))
        cols.append(c.alias(f.name))
    return out.select(*cols)


def pivot_cube(spectra: DataFrame, images: DataFrame, *, nx: int) -> tuple[DataFrame, DataFrame]:
    """Spectra at their cube position and the collapsed image: mean of data, sum of ivar."""

    def place(df: DataFrame) -> DataFrame:
        return df.withColumns({"ix": (F.col("target_id") - 1) % nx, "iy": F.floor((F.col("target_id") - 1) / nx)})

    image = place(images.groupBy("target_id").agg(F.avg("data").alias("data"), F.sum("ivar").alias("ivar")))
    return place(spectra), image


def align_to_grid(result: DataFrame, *, keys: Sequence[str], start: float, stop: float, step: float, x: str = "wave", digits: int = 3) -> DataFrame:
    """A sparse result on a fixed wavelength grid; missing points NULL.

    The grid is generated per key, which bounds the output by keys times grid length.
    """
    n = int(round((stop - start) / step))
    grid = result.select(*keys).distinct().withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n))))
    grid = grid.withColumn(x, F.round(F.col("_i") * step + start, digits)).drop("_i")
    return grid.join(result.withColumn(x, F.round(x, digits)), [*keys, x], "left")
