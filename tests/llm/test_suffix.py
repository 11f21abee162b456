"""Repeated strings against a brute-force count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lumenframe.llm import suffix_dedup
from lumenframe.llm.suffix_dedup import bucket_of, cut_repeats, multikey_order


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, copy = prose(40), prose(120)
    texts = [None, "", "short", "a" * 700, "ab" * 300, shared, copy, copy, copy[3:], copy[:-5] + "!"]
    for _ in range(40):
        texts.append(prose(r.randint(0, 60)) + " " + shared[r.randint(0, 30) : r.randint(60, len(shared))] + " " + prose(r.randint(0, 60)))
    for _ in range(30):
        w = copy.split(" ")
        w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts.append(prose(50) + shared + prose(30) + shared)
    return texts


@pytest.mark.parametrize(("length", "choose"), [(200, 128), (40, 20), (60, 33)])
def test_against_brute_force(spark, length, choose):
    texts = corpus()
    rows = [(i if i % 7 else None, t, -1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes long").repartition(3)
    got = cut_repeats(docs, length=length, choose=choose).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    have = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=key)
    want = sorted(((i, *b) for (i, _, _), b in zip(rows, brute(texts, length), strict=True)), key=key)
    assert have == want


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert cut_repeats(docs).collect() == []


def test_order_and_buckets():
    r = np.random.default_rng(0)
    cols = [r.integers(0, 4, 500).astype(np.uint64) for _ in range(4)]
    order = multikey_order(cols)
    rows = [tuple(int(c[i]) for c in cols) for i in order]
    assert rows == sorted(rows)
    splitters = [rows[100], rows[250], rows[400]]
    assert bucket_of(splitters, cols).tolist() == [sum(s <= tuple(int(c[i]) for c in cols) for s in splitters) for i in range(500)]


def test_samples_are_bounded_in_keys(spark, monkeypatch):
    """Few long documents, of which some blocks are open, among many short ones."""
    r, seen = random.Random(3), []
    long = ["".join(r.choice("abcdefgh ") for _ in range(30_000)) for _ in range(3)]
    for i in range(2):  # copies with a byte changed here and there: equal anchors, blocks that differ
        b = list(long[i])
        for at in range(0, len(b), 400):
            b[at] = "#"
        long.append("".join(b))
    texts = long + ["a" * 3000] + [f"short {i}" for i in range(5000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_dedup, "KEYS", 8, raising=False)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2048, raising=False)
    order = suffix_dedup.multikey_order
    monkeypatch.setattr(suffix_dedup, "multikey_order", lambda cols: seen.append(len(cols[0])) or order(cols))
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in cut_repeats(docs).collect()}
    assert got == dict(enumerate(brute(texts, 200)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(seen) == 2 and all(parts <= n <= 8 * parts for n in seen)


def test_rows_alike_are_documents_of_their_own(spark):
    r = random.Random(8)
    text = "".join(r.choice("abcdefgh ") for _ in range(900))
    rows = [(1, text), (1, text), (None, text[100:500]), (None, text[100:500]), (2, text[:150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in cut_repeats(docs).collect())
    assert got == Counter((i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], 200), strict=True))


def test_one_fingerprint_is_not_enough():
    rows = lambda second: pa.RecordBatch.from_pydict({"lead": [7, 7], "core": [5, 5], "block": [3, 3], "second": second, "key": [1, 2], "first": [10, 20], "shape": [4, 4]})
    settled = lambda second: [r["open"] for b in suffix_dedup._settle(200)(iter([rows(second)])) for r in b.to_pylist()]
    assert settled([9, 9]).count(0) == 2 and settled([9, 8]).count(0) == 0
    rows = lambda second: pa.RecordBatch.from_pydict({"lead": [7, 7], "print": [3, 3], "second": second, "key": [1, 2], "at": [10, 20], "bucket": [0, 0]})
    settled = lambda second: [r["edge"] for b in suffix_dedup._settle_windows(iter([rows(second)])) for r in b.to_pylist()]
    assert settled([9, 9]).count(0) == 2 and settled([9, 8]).count(0) == 0
