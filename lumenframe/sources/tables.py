"""Survey tables in, products out."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.functions.exprs import clean_text

ID_COLUMN = "target_id"


def normalised(df: DataFrame, *, upper: Sequence[str] = (), ids: Sequence[str] = (ID_COLUMN,)) -> DataFrame:
    """Trim strings, upper-case the named ones, 32-bit ids. A pure projection: pruning and
    pushdown of the scan are kept."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in ids:
            c = c.cast("int")
        elif isinstance(f.dataType, T.StringType):
            c = clean_text(c) if f.name in upper else F.trim(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_survey_tables(
    spark: SparkSession, folder: str, names: Sequence[str], *, schemas: Mapping[str, T.StructType] | None = None, upper: Sequence[str] = (), ids: Sequence[str] = (ID_COLUMN,)
) -> dict[str, DataFrame]:
    """Typed survey tables by extension name; a missing column of a given schema is an error at read."""
    out = {}
    for name in names:
        reader = spark.read if not schemas or name not in schemas else spark.read.schema(schemas[name])
        out[name] = normalised(reader.parquet(f"{folder}/{name}.parquet"), upper=upper, ids=ids)
    return out


def fill_product(df: DataFrame) -> DataFrame:
    """Missing values as the product stores them: NaN, -1, 'nan'. A missing array gets as many
    such elements, in each of its dimensions, as the largest array of its column (one if the
    column has none)."""
    arrays = [f for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    known = df.agg(F.struct(*[F.array(*_extents(F.col(f.name), f.dataType)).alias(f.name) for f in arrays])).scalar() if arrays else None

    def missing(t: T.DataType, extents: Sequence[Column] = ()):
        if isinstance(t, (T.FloatType, T.DoubleType)):
            return F.lit(float("nan")).cast(t)
        if isinstance(t, T.StringType):
            return F.lit("nan")
        if isinstance(t, T.IntegralType):
            return F.lit(-1).cast(t)
        if isinstance(t, T.ArrayType):
            one = F.lit(-999).cast(t.elementType) if isinstance(t.elementType, T.IntegralType) else missing(t.elementType, extents[1:])
            return F.array_repeat(one, F.coalesce(extents[0], F.lit(1)))
        return F.lit(None)

    def extents(f: T.StructField) -> list[Column]:
        return [known[f.name][k] for k in range(len(_extents(F.lit(None), f.dataType)))] if f in arrays else []

    return df.select(*[F.coalesce(F.col(f.name), missing(f.dataType, extents(f))).alias(f.name) for f in df.schema.fields])


def _extents(c: Column, t: T.DataType) -> list[Column]:
    """Largest extent of an array column in each dimension, as aggregates."""
    out = [F.max(F.array_size(c))]
    while isinstance(t.elementType, T.ArrayType):
        out.append(F.max(F.array_max(F.transform(c, F.array_size))))
        c, t = F.flatten(c), t.elementType
    return out


SWITCH, READY = "_switch", "_ready"


def _folders(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and its path class."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_product(tables: Mapping[str, DataFrame], path: str, night: str, *, by: str = "obs_id", mode: str = "overwrite") -> list[str]:
    """One Parquet table per extension, partitioned by night and observation.

    Rows are clustered by observation before the write, so each task opens few files; large
    observations are split by the writer's ``maxRecordsPerFile``. Only the nights and
    observations that ``tables`` holds are replaced (or added to, with ``mode="append"``); others
    of the product stay.

    All extensions are written beside the product first. When the last one is whole, a mark says
    so and their folders are moved into place. Before the mark a failure leaves the old product as
    it is; after it, ``finish_product``, which every write calls first, moves what is left.
    """
    spark = next(iter(tables.values())).sparkSession
    finish_product(spark, path)
    run = f"{path}/{SWITCH}/{uuid.uuid4().hex}"
    for name, df in tables.items():
        out = fill_product(df).withColumn("night", F.lit(night))
        parts = ["night", by] if by in df.columns else ["night"]
        if by in df.columns:
            out = out.hint("rebalance", by)
        out.write.option("maxRecordsPerFile", 5_000_000).partitionBy(*parts).parquet(f"{run}/{name}")
    files, at = _folders(spark, path)
    files.create(at(f"{run}/{READY}.{mode}")).close()
    finish_product(spark, path)
    return [f"{path}/{name}" for name in tables]


def finish_product(spark: SparkSession, path: str) -> None:
    """Bring a product into one state after a lost writer: written runs with the mark are moved
    into place, others are deleted. A move replaces a whole night and observation of an extension,
    and moving again what has been moved does nothing."""
    files, at = _folders(spark, path)
    if not files.exists(at(f"{path}/{SWITCH}")):
        return
    for run in sorted(s.getPath().toString() for s in files.listStatus(at(f"{path}/{SWITCH}"))):
        append = files.exists(at(f"{run}/{READY}.append"))
        if append or files.exists(at(f"{run}/{READY}.overwrite")):
            for extension in files.listStatus(at(run)):
                if extension.isDirectory():
                    _move(files, at, extension.getPath().toString(), f"{path}/{extension.getPath().getName()}", append)
        files.delete(at(run), True)


def _move(files, at, source: str, target: str, append: bool) -> None:
    """Move the partitions below ``source``: a folder of files replaces its target, or with
    ``append`` its files join those there."""
    inside = [s for s in files.listStatus(at(source)) if not s.getPath().getName().startswith(("_", "."))]
    if any(s.isDirectory() for s in inside):
        for s in inside:
            _move(files, at, s.getPath().toString(), f"{target}/{s.getPath().getName()}", append)
        return
    if not inside:
        files.mkdirs(at(target))
        return
    if append:
        files.mkdirs(at(target))
        for s in inside:
            files.rename(s.getPath(), at(f"{target}/{s.getPath().getName()}"))
        return
    files.delete(at(target), True)
    files.mkdirs(at(target).getParent())
    if not files.rename(at(source), at(target)):
        raise OSError(f"could not move {source} to {target}")


def product_rows(tables: Mapping[str, DataFrame], *, by: str = "obs_id") -> DataFrame:
    """Rows per extension and observation of a product, without writing it."""
    out = None
    for name, df in tables.items():
        part = df.groupBy(by).agg(F.count("*").alias("n_rows")).withColumn("extension", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def export_view(df: DataFrame, columns: Sequence[str], names: Mapping[str, str] | None = None) -> DataFrame:
    """The requested columns that exist, renamed."""
    names = names or {}
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in columns if c in df.columns])


def export_csv(df: DataFrame, path: str, columns: Sequence[str], names: Mapping[str, str] | None = None) -> bool:
    """Write the current view as CSV; nothing is written for an empty one."""
    view = export_view(df, columns, names)
    if not view.columns or view.isEmpty():
        return False
    view.write.mode("overwrite").option("header", True).csv(path)
    return True
