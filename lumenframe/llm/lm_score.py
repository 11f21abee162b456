"""Language-model scores of documents: byte PPM, and a unigram base to compare with."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.base import keyed, stage, texts, words
from lumenframe.llm.ppm import COUNTED, Index, Tree, gram_counts, grams, summed, text_sums

SHARD_GRAMS = 250_000  # grams of the model that a task holds at once, about
BATCH = 4096  # neighbouring documents that ask for values together; a power of two
BLOB, BLOB_ROWS = 1 << 16, "shard long, batch long, codes binary, more binary"
HOT_WORDS = 100_000  # at most so many words occur in more than 1 of HOT_WORDS tokens
HELD_WORDS = 400_000  # distinct words a task counts before it hands them on


def word_counts(docs: DataFrame) -> DataFrame:
    """(text) to word, n in partial sums; the word null is the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends = Counter(), 0

        def out(c):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], ["word", "n"])

        for _, raw in texts(batches):
            ends += len(raw)
            for t in raw:
                held.update(words(t))
            if len(held) > HELD_WORDS:
                yield from out(held)
                held = Counter()
        yield from out(held | ({None: ends} if ends else {}))

    return docs.mapInArrow(run, "word binary, n long")


# --- values of grams -----------------------------------------------------------------------
#
# A gram's value needs the counts of its contexts. Those of up to two bytes are few and go to all
# tasks; the longer ones of a gram end alike, in its last three context bytes, so the model is
# dealt out by these. Texts ask for the distinct grams of a batch of documents and get them back
# with values: no task holds more of the model than a shard, or than a batch asks for.


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    x = (codes >> np.uint64(8) & np.uint64(0xFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def packed(codes: np.ndarray) -> bytes:
    """Ascending codes as differences, byte by byte, which compresses well."""
    return np.diff(codes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


BLOBS = pa.schema([("shard", pa.int64()), ("batch", pa.int64()), ("codes", pa.binary()), ("more", pa.binary())])


def blobs(codes: np.ndarray, more: np.ndarray | None, batch: int | None, shards: int) -> Iterator[pa.RecordBatch]:
    """Ascending distinct codes, with a number each or none, by shard: at most BLOB in a row."""
    of = shard_of(codes, shards)
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], np.arange(shards + 1))
    rows = []
    for k in np.flatnonzero(np.diff(ends)):
        for at in range(ends[k], ends[k + 1], BLOB):
            own = order[at : min(at + BLOB, ends[k + 1])]
            rows.append((int(k), batch, packed(codes[own]), None if more is None else more[own].tobytes()))
    for at in range(0, len(rows), 64):
        cols = zip(*rows[at : at + 64], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, BLOBS, strict=True)], schema=BLOBS)


def asked(docs: DataFrame, order: int, shards: int) -> DataFrame:
    """(batch, text) to the distinct grams of each batch of documents, as blobs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        for part, raw in texts(batches):
            of = part.column("batch").to_numpy()
            for at, end in runs(of):
                if of[at] != now or size > 4 * COUNTED:
                    if held:
                        yield from blobs(np.unique(np.concatenate(held)), None, now, shards)
                    now, held, size = int(of[at]), [], 0
                held.append(np.unique(grams(raw[at:end], order)[0]))
                size += len(held[-1])
        if held:
            yield from blobs(np.unique(np.concatenate(held)), None, now, shards)

    return docs.mapInArrow(run, BLOB_ROWS)


def runs(of: np.ndarray) -> list[tuple[int, int]]:
    """First and last + 1 of each stretch of equal values."""
    cut = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
    return list(zip(cut[:-1], cut[1:], strict=True)) if len(of) else []


def gram_values(docs: DataFrame, learn: DataFrame, order: int) -> DataFrame:
    """(batch, text) and the texts to learn from to (batch, codes, values): log10 probabilities of
    all grams of each batch, as blobs."""
    spark = docs.sparkSession
    counts = gram_counts(learn.select(F.lit("").alias("key"), "text"), order)
    top = stage(counts.groupBy("code").agg(F.sum("n").alias("n")), "grams")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    shards = max(parts, -(-top.count() // SHARD_GRAMS))
    low = []
    for j in range(min(order, 2) + 1):  # at most 2**24 rows, the strings of three bytes
        mask = F.lit((1 << 8 * (j + 1)) - 1)
        rows = top.groupBy(top["code"].bitwiseAND(mask).alias("code")).agg(F.sum("n").alias("n")).toArrow()
        low.append(summed(rows.column("code").to_numpy().view(np.uint64), rows.column("n").to_numpy()))
    known = spark.sparkContext.broadcast(low)

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, n = b.column("code").to_numpy().view(np.uint64), b.column("n").to_numpy()
            order_ = np.argsort(codes)
            yield from blobs(codes[order_], n[order_], None, shards)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, tree = None, [], None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["shard"] != now:
                    now, parts, tree = r["shard"], [], None
                if r["batch"] is None:
                    parts.append((unpacked(r["codes"]), np.frombuffer(r["more"], np.int64)))
                    continue
                if tree is None:
                    codes, n = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, t) for i, t in enumerate((np.uint64, np.int64)))
                    tree, parts = Tree(codes, n, order, known.value[0], known.value[1:]), []
                out.append((r["batch"], r["codes"], tree.log10(unpacked(r["codes"])).astype(np.float32).tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["batch", "codes", "values"])

    both = top.mapInArrow(model, BLOB_ROWS).unionByName(asked(docs, order, shards))
    both = both.repartition(parts, "shard").sortWithinPartitions("shard", F.col("batch").asc_nulls_first())
    return stage(both.mapInArrow(settle, "batch long, codes binary, values binary"), "gram-values")


def score_documents(docs: DataFrame, *, learn: Column, id: str = "doc_id", text: str = "text", order: int = 5) -> DataFrame:
    """log10 probability of each text under byte PPM and under add-one word unigrams.

    Both models learn from all rows where ``learn`` holds. Their statistics are counted by Spark
    and grow with the data; no driver and no task holds them whole. The grams of the context tree
    are dealt out to shards of about SHARD_GRAMS; each batch of BATCH documents asks for its
    distinct grams, and gets back their code lengths, with which its texts are scored. A task
    holds a shard, or what one batch asks for. Word counts reach the texts in two ways: words in
    more than 1 of HOT_WORDS tokens, of which there can't be more than HOT_WORDS, by broadcast;
    all others by a join on the word, which has no hot keys.

    A text is its lower-cased words and one end. Returns one row per input row: ``id``,
    ``learned``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``. Null,
    empty and blank texts are the end alone. Repeated rows and null ids are scored like any
    other; with nothing to learn from all words are unknown and every byte has 1 chance in 256.
    An empty table gives an empty result; other columns are ignored.
    """
    rows, key = keyed(docs, "score-rows")
    flat = rows.select(
        F.shiftright(key, BATCH.bit_length() - 1).alias("batch"), F.col(id).alias("id"),
        F.coalesce(learn, F.lit(False)).alias("learned"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    lessons = flat.where("learned").select("text")
    vocab = stage(word_counts(lessons).groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct, ends = vocab.agg(F.sum("n"), F.count("*"), F.max(F.when(F.col("word").isNull(), F.col("n")))).first()
    total, ends = total or 0, ends or 0
    hot = vocab.where(F.col("word").isNotNull() & (F.col("n") * HOT_WORDS > total)).toArrow()
    hot = dict(zip(hot.column("word").to_pylist(), np.log10(hot.column("n").to_numpy() + 1.0).tolist(), strict=True))
    hot_words = docs.sparkSession.sparkContext.broadcast(hot)  # at most HOT_WORDS entries
    values = gram_values(flat.select("batch", "text"), lessons, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, now, given, index, value = hot_words.value, None, [], None, None
        for part, raw in texts(batches, rows=128):
            of = part.column("batch").to_numpy()
            for at, end in runs(of):
                if of[at] != now:
                    now, given, index, value = of[at], [], None, None
                own = part.slice(at, end - at)
                n = own.column("text").null_count  # values come before their batch's texts
                for c, v in zip(own.column("codes").to_pylist()[:n], own.column("values").to_pylist()[:n], strict=True):
                    given.append((unpacked(c), np.frombuffer(v, np.float32)))
                if n == end - at:
                    continue
                if index is None:
                    codes, first = np.unique(np.concatenate([c for c, _ in given]), return_index=True)
                    value, index, given = np.concatenate([v for _, v in given])[first], Index(codes), []
                own, docs_ = own.slice(n), raw[at + n : end]
                code, begin, split = grams(docs_, order)
                score = text_sums(value[index.find(code)[0]], begin)
                base, known, rare = [], [], []
                for w in split:
                    got = [x for x in map(common.get, w) if x is not None]
                    base.append(sum(got))
                    known.append(len(got))
                    rare.append(list(Counter(x for x in w if x not in common).items()) if len(got) < len(w) else [])
                k = [len(w) + 1 for w in split]
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("learned"), pa.array(k, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score), pa.array(rare, pa.list_(entry))],
                    schema=out,
                )

    entry = pa.struct([("word", pa.binary()), ("k", pa.int64())])
    kind = docs.schema[id].dataType.simpleString()
    id_type = flat.select("id").limit(0).toArrow().schema.field("id").type
    out = pa.schema([("id", id_type), ("learned", pa.bool_()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(entry))])
    spark_schema = f"id {kind}, learned boolean, n long, known long, base double, score double, rare array<struct<word: binary, k: bigint>>"
    none = [F.lit(None).cast(t).alias(c) for c, t in (("codes", "binary"), ("values", "binary"))]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    both = flat.select("batch", "id", "learned", "text", *none).unionByName(values, allowMissingColumns=True)
    both = both.repartition(parts, "batch").sortWithinPartitions("batch", F.col("text").isNotNull())
    rows = both.mapInArrow(run, spark_schema).withColumn("row", F.monotonically_increasing_id())
    rows = stage(rows, "scores")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.k")
    rare = rare.join(vocab.where(F.col("word").isNotNull()), "word")
    rare = rare.groupBy("row").agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("add"))
    out = rows.drop("rare").join(rare, "row", "left")
    spread = float(np.log10(total + distinct + 1))
    return out.select(
        F.col("id").alias(id), "learned", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("add", F.lit(0.0)) + F.lit(float(np.log10(ends + 1))) - F.col("n") * F.lit(spread)).alias("base_score"),
        "score",
    )
