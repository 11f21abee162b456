"""Importance resampling towards a target distribution of hashed word runs.

The bucket of a feature is the CRC-32 of its bytes. A CRC is linear but for its start value: the
CRC of n bytes is a constant for n, XORed with one contribution for each byte, which depends on
the byte and its distance from the end alone. So the CRCs of all features of a slice are XORs over
spans of one table's entries.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.scale import number_rows
from lumenframe.llm.base import stage
from lumenframe.llm.token_ids import slices

REACH = 32  # distances from the end in the table; a longer span is folded from such blocks
SPAN_BYTES = 1 << 20  # bytes of features whose contributions are held at once

# Bytes in words, after lower-casing A-Z: digits, letters and all of non-ASCII characters.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20
IN_WORD = np.zeros(256, bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True


@functools.cache
def positions() -> np.ndarray:
    """Contribution of each byte at each distance from the end."""
    blank = [zlib.crc32(bytes(d + 1)) for d in range(REACH)]
    return np.array([[zlib.crc32(bytes([b]) + bytes(d)) ^ blank[d] for b in range(256)] for d in range(REACH)], np.uint32)


def _moved(value: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Contributions after more bytes follow them: ``table`` has those of each byte of a value."""
    out = np.zeros_like(value)
    for i in range(4):
        out ^= table[i][value >> np.uint32(8 * i) & np.uint32(255)]
    return out


@functools.cache
def further(k: int) -> np.ndarray:
    """The table that moves contributions by 2**k bytes: one byte for k = 0, then twice the last."""
    if k:
        half = further(k - 1)
        return np.stack([_moved(t, half) for t in half])
    byte = np.arange(256, dtype=np.uint32)
    state = [byte << np.uint32(8 * i) for i in range(4)]
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    return np.stack([step[s & np.uint32(255)] ^ (s >> np.uint32(8)) for s in state])


def constants(length: np.ndarray) -> np.ndarray:
    """What the start value leaves of itself after so many bytes."""
    out = np.full(len(length), 0xFFFFFFFF, np.uint32)
    for k in range(int(length.max(initial=0)).bit_length()):
        on = length >> k & 1 == 1
        out[on] = _moved(out[on], further(k))
    return out ^ np.uint32(0xFFFFFFFF)


def _short(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XOR of the contributions of spans of 1 to REACH bytes."""
    table, out = positions(), np.empty(len(start), np.uint32)
    upto = np.cumsum(end - start)
    at = 0
    while at < len(start):
        stop = max(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SPAN_BYTES, "right")), at + 1)
        s, e = start[at:stop], end[at:stop]
        size = e - s
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(s - first, size)
        out[at:stop] = np.bitwise_xor.reduceat(table[np.repeat(e - 1, size) - place, buf[place]], first)
        at = stop
    return out


def _long(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same for spans of any length: blocks of REACH bytes from the end, folded in pairs."""
    number = -(-(end - start) // REACH)
    span = np.repeat(np.arange(len(start)), number)
    block = np.arange(len(span)) - np.repeat(np.cumsum(number) - number, number)  # 0 is the last one
    stop = end[span] - block * REACH
    value = _short(buf, np.maximum(stop - REACH, start[span]), stop)
    k = REACH.bit_length() - 1
    while len(span) > len(start):
        value = np.where(block & 1 == 1, _moved(value, further(k)), value)
        first = np.flatnonzero(block & 1 == 0)
        value, span, block, k = np.bitwise_xor.reduceat(value, first), span[first], block[first] >> 1, k + 1
    return value


def crcs(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each span ``buf[start:end]`` (none empty)."""
    size = end - start
    out, far = np.empty(len(start), np.uint32), size > REACH
    out[~far] = _short(buf, start[~far], end[~far])
    if far.any():
        out[far] = _long(buf, start[far], end[far])
    return out ^ constants(size)


def features(texts: pa.Array, ngram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRCs of the runs of 1 to ``ngram`` words of all texts (no nulls), the text of each, and
    the number of words of each text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    buf = LOWERED[np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]] if raw is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = IN_WORD[buf]
    head = np.zeros(len(buf) + 1, bool)  # where a text begins, no word goes on
    head[offsets] = True
    begins = inside & (~np.r_[False, inside[:-1]] | head[:-1]) if len(buf) else inside
    ends = inside & (~np.r_[inside[1:], False] | head[1:]) if len(buf) else inside
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    if ngram > 1:  # words with one space between them
        size = end - start
        put = np.cumsum(size + 1) - size - 1
        joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
        joined[np.arange(int(size.sum())) + np.repeat(put - (np.cumsum(size) - size), size)] = buf[inside]
        buf, start, end = joined, put, put + size
    out, of = [], []
    for n in range(1, ngram + 1):
        first = np.flatnonzero(doc[n - 1 :] == doc[: len(doc) - n + 1]) if len(doc) >= n else np.empty(0, np.int64)
        out.append(crcs(buf, start[first], end[first + n - 1]))
        of.append(doc[first])
    return np.concatenate(out), np.concatenate(of), np.bincount(doc, minlength=len(texts))


def bucket_counts(docs: DataFrame, buckets: int, ngram: int) -> DataFrame:
    """(text) to bucket, n: how often features fall into each bucket, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for b in slices(batch):
                crc, _, _ = features(b.column("text"), ngram)
                n += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    return docs.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int, ngram: int) -> np.ndarray:
    """Gain of each bucket: a thousand times the log of its smoothed share in the target over
    that in the documents, floored. ``buckets`` numbers of either side reach the driver."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for into, table in ((s, docs), (t, target)):
        got = bucket_counts(table, buckets, ngram).toArrow()
        into[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    ratio = (t + 1.0) * float(s.sum() + buckets) / ((s + 1.0) * float(t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def resample(
    docs: DataFrame, target: DataFrame, *, id: str = "doc_id", text: str = "text", target_text: str = "text",
    buckets: int = 10_000, ngram: int = 2, seed: int = 0, percent: int = 10, min_words: int = 20,
) -> DataFrame:
    """Draw the documents whose words are most like the target's, by Gumbel top-k.

    Features are all runs of 1 to ``ngram`` words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the
    lower-cased (A-Z) text, joined by a space; a feature's bucket is its CRC-32 modulo
    ``buckets``. Bucket counts cover all documents and all of the target. A document's weight is
    the floored mean gain of its features, its score the weight plus Gumbel noise from the hash of
    seed and id. Of the documents with ``min_words`` words at least, ``percent`` in a hundred with
    the highest scores are drawn, ties by the smaller id: reruns agree.

    Ranks come from a count per score (scores are whole numbers of a bounded range) that tells
    which score the draw ends in, and a range-partitioned numbering of the documents from that
    score upward; no task sees them all. A worker holds a slice of texts and one word array of the
    longest text.

    Returns one row per input row: ``id``, ``n_features``, ``weight``, ``score``, ``rank`` (1, 2,
    ... of those drawn, else null). Null and empty texts have no feature and weight 0. Rows that
    repeat an id share its noise; a null id counts as the empty string and loses ties, rows that
    are alike take turns. An empty table gives an empty result, an empty target has equal shares.
    Other columns are ignored.
    """
    flat = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    wanted = target.select(F.coalesce(F.col(target_text), F.lit("")).alias("text"))
    gain = gains(flat.select("text"), wanted, buckets, ngram)  # ``buckets`` numbers go to each task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                crc, doc, words = features(b.column("text"), ngram)
                n = np.bincount(doc, minlength=b.num_rows)
                # Whole numbers below 2**53: sums of doubles are exact.
                total = np.bincount(doc, gain[crc % np.uint32(buckets)], minlength=b.num_rows).astype(np.int64)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n), pa.array(words), pa.array(weight)], ["id", "n_features", "words", "weight"])

    kind = docs.schema[id].dataType.simpleString()
    rows = flat.mapInArrow(run, f"id {kind}, n_features long, words long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = rows.select("id", "n_features", "weight", (F.col("weight") + noise).alias("score"), (F.col("words") >= min_words).alias("fit"))
    rows = stage(rows, "weights")
    # One row per score from here on.
    scores = rows.where("fit").groupBy("score").agg(F.count("*").alias("n"))
    upto = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    every = F.sum("n").over(Window.partitionBy(F.lit(0)))
    scores = scores.select("score", F.sum("n").over(upto).alias("upto"), F.floor(every * percent / 100).alias("draw"))
    draw, last = scores.agg(F.max("draw"), F.max(F.when(F.col("upto") >= F.col("draw"), F.col("score")))).first()
    fields = [F.col("id").alias(id), "n_features", "weight", "score"]
    if not draw:
        return rows.select(*fields, F.lit(None).cast("long").alias("rank"))
    near = F.col("fit") & (F.col("score") >= last)
    top = number_rows(rows.where(near), [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight")], "rank")
    top = top.select(*fields, F.when(F.col("rank") <= draw, F.col("rank")).cast("long").alias("rank"))
    return top.unionByName(rows.where(~near).select(*fields, F.lit(None).cast("long").alias("rank")))
