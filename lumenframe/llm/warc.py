"""WARC archives: writing, normalising monolithic gzip, and reading back by index."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.base import new_path, releasing, stage

END_OF_RECORD = "\r\n\r\n"
CHUNK = 1 << 20
LEVEL = 6


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each five hex digits are four base32 digits."""
    hexed = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_texts(pages: DataFrame, *, id: str, url: str, html: str, keep: str, min_bytes: int, date: str) -> DataFrame:
    """Each page as a WARC record (a string, without the blank lines at its end)."""
    body = F.coalesce(F.col(html), F.lit(""))
    flat = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), body.alias("body"))
    flat = flat.withColumn("n", F.octet_length("body")).withColumn("digest", base32_sha1(F.col("body")))
    facts = flat.where((F.col("n") >= min_bytes) & F.col("id").isNotNull()).select("id", "digest")
    pick = {"smallest": F.min, "largest": F.max}[keep]
    groups = facts.groupBy("digest").agg(pick("id").alias("of"), F.count("*").alias("size")).where("size > 1")
    again = stage(facts.join(groups, "digest").where("id <> of").select("id", "digest", "of").distinct(), "revisits")
    flat = flat.join(again, ["id", "digest"], "left")
    head = [
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("of").isNull(), "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]+", " ")), F.lit("")),
        F.coalesce(F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("of").cast("string"), F.lit(">")), F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nPayload-Length: "), F.col("n").cast("string"),
        F.lit("\r\nContent-Length: "), F.when(F.col("of").isNull(), F.col("n")).otherwise(0).cast("string"), F.lit("\r\n\r\n"),
        F.when(F.col("of").isNull(), F.col("body")).otherwise(""),
    ]
    return flat.select(F.concat(*head).alias("value"))


def write_monolithic(records: DataFrame, path: str) -> None:
    """One gzip stream per partition, as careless crawlers leave them: Spark's text writer with
    the end of a record as its line end."""
    with releasing(records.sparkSession):
        records.write.option("lineSep", END_OF_RECORD).option("compression", "gzip").text(path)


def inflated(data: bytes) -> Iterator[bytes]:
    """A gzip stream, or several after each other, in chunks of bounded size."""
    view, at = memoryview(data), 0
    while at < len(data) and data[at : at + 1] != b"\0":
        z, tail = zlib.decompressobj(31), b""
        while not z.eof:
            piece = tail or view[at : at + CHUNK]
            if not tail:
                at += len(piece)
            if not len(piece):
                raise ValueError("the gzip stream breaks off")
            out = z.decompress(piece, CHUNK)
            tail = z.unconsumed_tail
            if out:
                yield out
        at -= len(z.unused_data)


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict, bytes, bytes]]:
    """Headers, head and body of each record of an inflated stream."""
    buffer = bytearray()
    chunks = iter(chunks)

    def need(n: int) -> bool:
        while len(buffer) < n:
            more = next(chunks, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while need(1):
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", seen)) < 0:
            seen = max(len(buffer) - 3, 0)
            if not need(len(buffer) + 1):
                raise ValueError("a record head breaks off")
        head = bytes(buffer[: end + 4])
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}
        size = int(fields["content-length"])
        if not need(end + 4 + size + 4):
            raise ValueError("a record breaks off")
        body = bytes(buffer[end + 4 : end + 4 + size])
        del buffer[: end + 4 + size + 4]
        yield fields, head, body


INDEX = "archive string, record long, offset long, length long, type string, uri string, record_id string, digest string"


def members_of(archives: DataFrame) -> DataFrame:
    """(path, content) of gzip archives to one gzip member per record with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in INDEX.split(", ")] + ["member"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for b in batches:
            for i in range(b.num_rows):
                archive = b.column("path")[i].as_py().rsplit("/", 1)[-1].partition(".")[0]
                at, rows, held = 0, [], 0
                for k, (f, head, body) in enumerate(records(inflated(b.column("content")[i].as_py()))):
                    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = z.compress(head) + z.compress(body) + z.compress(END_OF_RECORD.encode()) + z.flush()
                    rows.append((archive, k, at, len(member), f["warc-type"], f.get("warc-target-uri"), f["warc-record-id"], f.get("warc-payload-digest"), member))
                    at += stored(member)
                    held += len(member)
                    if held > 8 * CHUNK:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return archives.select("path", "content").mapInArrow(run, f"{INDEX}, member binary")


def stored(member: bytes) -> int:
    """Bytes a member takes in a file: a member of 16 MiB or more gets a padding zero."""
    return len(member) + (member[-1:] != b"\0")


def normalise(spark: SparkSession, monolithic: str, out: str, *, remove: bool = False) -> DataFrame:
    """Rewrite monolithic archives with each record as a gzip member of its own.

    Every archive is inflated once, as a stream. Members go to ``out/archive=NAME/``, one file per
    archive, and the sidecar index (archive, record, offset, length, type, uri, record id, digest)
    to ``out.index`` as Parquet; it is returned. The files come from Spark's text writer, so any
    file system will do: a member below 16 MiB ends with a zero byte (the top byte of its size),
    and that byte is the line end; larger members get a zero more, which gzip readers skip. With
    ``remove`` the monolithic archives go as soon as their members are in the shared folder.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(monolithic)
    members = stage(members_of(archives), "members")
    if remove:
        path = spark._jvm.org.apache.hadoop.fs.Path(monolithic)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    inside = F.when(F.substring("member", -1, 1) == F.unhex(F.lit("00")), F.col("member").substr(F.lit(1), F.octet_length("member") - 1)).otherwise(F.col("member"))
    rows = members.repartition(parts, "archive").sortWithinPartitions("archive", "record")
    with releasing(spark):
        rows.select("archive", inside.cast("string").alias("value")).write.option("lineSep", "\0").partitionBy("archive").text(out)
    members.drop("member").write.parquet(f"{out}.index")
    return spark.read.parquet(f"{out}.index")


def read_records(spark: SparkSession, normalised: str, index: DataFrame) -> DataFrame:
    """Records of normalised archives, each inflated from its place in the index alone.

    Returns record_id, type, uri, digest, payload_bytes, refers_to, body. The payload of a response
    is checked against its digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "type", "uri", "digest", "payload_bytes", "refers_to", "body"]
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
        for b in batches:
            for i in range(b.num_rows):
                data, places = b.column("content")[i].as_py(), b.column("places")[i].as_py()
                for at in range(0, len(places), 256):
                    rows = []
                    for p in places[at : at + 256]:
                        (f, _, body), *more = records(inflated(data[p["offset"] : p["offset"] + p["length"]]))
                        digest = f["warc-payload-digest"].removeprefix("sha1:")
                        if more or f["warc-type"] == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                            raise ValueError(f"record {f['warc-record-id']} is damaged")
                        rows.append((f["warc-record-id"], f["warc-type"], f.get("warc-target-uri"), digest, int(f["payload-length"]), f.get("warc-refers-to"), body))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    # One row per archive, and an archive has a bounded size: that of a partition of pages.
    places = index.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(normalised)
    files = files.select(F.regexp_extract("path", "archive=([^/]+)/", 1).alias("archive"), "content")
    kind = "record_id string, type string, uri string, digest string, payload_bytes long, refers_to string, body binary"
    return files.join(places, "archive").mapInArrow(run, kind)


def archive_pages(
    pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html",
    keep: str = "largest", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write pages as WARC, normalise the archives and read them back.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest (or
    smallest) id is a response and the others revisit it. Returns one row per page: ``id``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``. Null html is an empty
    payload; a null url leaves its header out; line ends in a url become a space. Pages with a
    null id are responses of their own. Rows that repeat an id with equal payload are each a
    record of the same type. An empty table gives an empty result; other columns are ignored.
    """
    spark, kind = pages.sparkSession, pages.schema[id].dataType
    mono, out = new_path(spark, "warc-monolithic"), new_path(spark, "warc")
    write_monolithic(record_texts(pages, id=id, url=url, html=html, keep=keep, min_bytes=min_bytes, date=date), mono)
    back = read_records(spark, out, normalise(spark, mono, out, remove=True))
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)
    return back.select(
        number("record_id").alias(id), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )
