"""What the operators of this subpackage share: staged tables, words, learned splits."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# In staged writes shuffle files go at their end, and Python gets rows in smaller batches: a
# batch of long texts is held several times over.
STAGED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2048"}
_own: dict[str, str] = {}
_open: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, the folder all executors share; only a local master without
    that setting (tests) gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own.setdefault("folder", tempfile.mkdtemp(prefix="lumenframe-shared-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lumenframe/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Writes made here have the settings STAGED."""
    was = {k: spark.conf.get(k, None) for k in STAGED}
    for k, v in STAGED.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables staged in here are deleted at the end, by when what was made of them is written.
    Paths that are put into the list it gives go as well."""
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open.remove(made)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in made:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on with the written table.

    This cuts the lineage, survives lost executors and gives the planner true sizes. The shuffle
    files of the write are deleted as soon as it is done: nothing reads them again. The table
    itself stays, unless a ``scratch`` is open.
    """
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, name)
    for made in _open[-1:]:
        made.append(path)
    with releasing(spark):
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def place_in_files(docs: DataFrame) -> Column | None:
    """A number for each row of a table of files, from its file and its place there; None if
    ``docs`` is anything else. The rows keep their numbers whenever the files are read again.

    The upper bits are a hash of the file's path under the first seed that tells all files apart.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        return None
    try:
        meta = docs.metadataColumn("_metadata")
        path, at = meta.getField("file_path"), meta.getField("row_index")
        files = docs.groupBy(path.alias("path")).agg(F.max(at).alias("last"))
        seeds = [F.xxhash64("path", F.lit(i)) for i in range(8)]
        low = max((files.agg(F.max("last")).first()[0] or 0).bit_length(), 1)
        mark = lambda h: F.shiftleft(F.shiftrightunsigned(h, low + 1), low)
        kinds = files.agg(F.count("*"), *[F.count_distinct(mark(h)) for h in seeds]).first()
    except AnalysisException:  # a format without places
        return None
    for i in range(len(seeds)):
        if kinds[i + 1] == kinds[0]:
            return mark(F.xxhash64(path, F.lit(i))).bitwiseOR(at)
    return None


def keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows with a number of their own that stays, and its column's name: their place in
    their files, or for other tables a number that is written once together with them.

    Decisions per row go by this number: ids may be null or repeated."""
    key = "_row"
    while key.lower() in (c.lower() for c in docs.columns):
        key += "_"
    place = place_in_files(docs)
    if place is not None:
        return docs.withColumn(key, place), key
    return stage(docs.withColumn(key, F.monotonically_increasing_id()), name), key


def first_row(id: str, key: str, keep: str = "smallest") -> Column:
    """What the smallest (or largest) id has the smallest (or largest) of, with its row's number
    as ``row``; rows with a null id come after all others."""
    known = F.col(id).isNull() if keep == "smallest" else F.col(id).isNotNull()
    return F.struct(known.alias("known"), F.col(id).alias("id"), F.col(key).alias("row"))


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null is the empty text."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def learns(id: Column, modulus: int, held: int) -> Column:
    """True for rows that a model may learn from; the other rows are held out."""
    return F.crc32(id.cast("string").cast("binary")) % modulus != held


def texts(batches: Iterator[pa.RecordBatch], column: str = "text", rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Small slices of the batches, each with its texts as UTF-8 bytes (null stays None)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).cast(pa.binary()).to_pylist()
    pa.default_memory_pool().release_unused()  # a worker may go on to other work


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+``: what bytes.split() calls white space."""
    return text.lower().split() if text else []
