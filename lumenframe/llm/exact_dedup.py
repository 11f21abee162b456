"""Exact de-duplication by a tree merge of sorted digest runs, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.base import first_row, keyed, lowered, stage

KEY = ["digest", "n_bytes", "proof"]


def digest_rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """One row per document: id, digest of the normalised text, and an independent proof."""
    flat = docs.select(F.col(id).alias("id"), lowered(F.col(text)).alias("flat"))
    return flat.select(
        "id",
        F.unhex(F.sha2(F.col("flat").cast("binary"), 256)).alias("digest"),
        F.octet_length("flat").alias("n_bytes"),
        F.xxhash64("flat").alias("proof"),
        F.spark_partition_id().alias("run"),
    )


def _merge(runs: DataFrame, run, best) -> DataFrame:
    """Merge runs that get the same number: every pair (run, digest range) meets in one task and
    is read there in digest order. Entries that agree in all of KEY stand next to each other; the
    first has the identifier to retain and takes the count, the followers go. A run holds a digest
    once, so no digest can crowd a task."""
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = runs.withColumn("run", run).withColumn("range", F.substring("digest", 1, 2)).repartition(parts, "run", "range")
    same = Window.partitionBy("run", "range", *KEY)
    merged = dealt.withColumns({"place": F.row_number().over(same.orderBy(best)), "total": F.sum("size").over(same.orderBy(best).rowsBetween(0, Window.unboundedFollowing))})
    return merged.where("place = 1").select("run", *KEY, "keep", F.col("total").alias("size"))


def exact_groups(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", keep: str = "smallest", fan_in: int = 2
) -> DataFrame:
    """Groups of documents whose texts are equal after lower-casing A-Z.

    Each input partition makes a run: its distinct digests with the identifier to retain and a
    count. Runs then merge in binomial rounds: ``fan_in`` neighbours become one run, until one is
    left after log(partitions) rounds; a larger ``fan_in`` saves rounds. Merging reads the runs of
    a digest range in sorted order. In every merge entries are one only if SHA-256, byte length
    and an independent 64-bit hash agree, so a retained identifier is verified at every level.
    Every fourth round is written, so that a lost executor costs a few rounds and not all.

    Returns one row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.
    ``keep`` is "smallest" or "largest". Null text is the empty text, which is a text like any
    other. Rows that repeat an id and its text are all counted and share their decision. A null
    id is retained only if its group has no other. An empty table gives an empty result; columns
    beyond id and text are ignored.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    rows = stage(digest_rows(docs, id, text), "digests")
    left = (rows.agg(F.max("run")).first()[0] or 0) + 1
    runs = rows.groupBy("run", *KEY).agg(pick("id").alias("keep"), F.count("*").alias("size"))
    best, level = (F.asc_nulls_last if keep == "smallest" else F.desc_nulls_last)("keep"), 0
    while left > 1:
        runs = _merge(runs, F.floor(F.col("run") / fan_in).cast("int"), best)
        left, level = -(-left // fan_in), level + 1
        if level % 4 == 0 and left > 1:
            runs = stage(runs, "runs")
    root = stage(runs.drop("run"), "digest-root")
    return rows.join(root, KEY).select(
        F.col("id").alias(id),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, *, id: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """One row of each group of ``exact_groups``, that of the smallest (or largest) id; columns
    are unchanged. Of rows that repeat id and text one is left; a row with a null id is left only
    if its group has no other. Rows that share an id and have different texts are told apart."""
    rows, key = keyed(docs, "exact-rows")
    flat = rows.select(first_row(id, key, keep).alias("id"), F.col(text).alias("text"))
    groups = exact_groups(flat, id="id", text="text", keep=keep)
    dropped = stage(groups.where(~F.col("kept")).select(F.col("id.row").alias(key)), "copies")
    return rows.join(dropped, key, "left_anti").select(docs.columns)
