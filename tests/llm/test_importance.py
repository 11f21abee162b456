"""Position-table CRCs against zlib, and resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenframe.llm.importance import crcs, features, resample

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def runs(text, ngram):
    w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return [b" ".join(w[i : i + n]) for n in range(1, ngram + 1) for i in range(len(w) - n + 1)], len(w)


@given(st.lists(st.binary(min_size=1, max_size=200), min_size=1, max_size=20))
@settings(max_examples=200, deadline=None)
def test_crc(spans):
    ends = np.cumsum(list(map(len, spans)))
    got = crcs(np.frombuffer(b"".join(spans), np.uint8), ends - list(map(len, spans)), ends)
    assert got.tolist() == list(map(zlib.crc32, spans))


def test_crc_of_long_spans():
    r = np.random.default_rng(1)
    size = np.array([1, 31, 32, 33, 64, 65, 1000, 4097, 100_000, 3_000_001, 7])
    buf = r.integers(0, 256, int(size.sum()), np.uint8)
    ends = np.cumsum(size)
    assert crcs(buf, ends - size, ends).tolist() == [zlib.crc32(buf[e - n : e].tobytes()) for n, e in zip(size, ends, strict=True)]


TEXT = st.text(st.sampled_from(list("aZ09é日 \n.,-\x00\x7f")), max_size=30)


@given(st.lists(TEXT, max_size=8), st.integers(1, 3))
@settings(max_examples=300, deadline=None)
def test_features(texts, ngram):
    crc, doc, words = features(pa.array(["skipped", *texts], pa.string())[1:], ngram)
    got = [sorted(crc[doc == i].tolist()) for i in range(len(texts))]
    want = [runs(t, ngram) for t in texts]
    assert got == [sorted(map(zlib.crc32, f)) for f, _ in want]
    assert words.tolist() == [n for _, n in want]


def plain(rows, goal, buckets, ngram, seed, percent, min_words):
    fs = [runs(t, ngram) for _, t in rows]
    s = Counter(zlib.crc32(f) % buckets for x, _ in fs for f in x)
    t = Counter(zlib.crc32(f) % buckets for g in goal for f in runs(g, ngram)[0])
    ss, tt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets))))
    out = []
    for (i, _), (x, n) in zip(rows, fs, strict=True):
        weight = sum(gain(zlib.crc32(f) % buckets) for f in x) // len(x) if x else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n >= min_words])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    drawn = Counter()
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        drawn[*r[:4], k + 1] += 1
    for r in fit[percent * len(fit) // 100 :] + [r for r in out if not r[4]]:
        drawn[*r[:4], None] += 1
    return drawn


def test_resample(spark):
    r = np.random.default_rng(3)
    stock = ["alpha", "Beta", "gamma9", "délta", "x" * 40, "日本", "z" * 500]
    rows = [(i % 150 if i % 41 else None, " ".join(r.choice(stock, r.integers(0, 9)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "..., --"), (1003, "alpha " * 5000), (7, "beta beta"), (7, "beta beta"), (2000, "a" * 100_000)]
    goal = ["Alpha beta.", "délta délta", None, ""]
    docs = spark.createDataFrame([(i, t, 1, "r", 0) for i, t in rows], "doc_id long, text string, rank int, score string, words int").repartition(5)
    target = spark.createDataFrame([(t, 0) for t in goal], "text string, doc_id int")
    for ngram, percent, min_words in ((1, 10, 3), (2, 37, 1), (1, 100, 0), (2, 0, 2)):
        got = resample(docs, target, buckets=50, ngram=ngram, seed=5, percent=percent, min_words=min_words).collect()
        assert Counter(map(tuple, got)) == plain(rows, goal, 50, ngram, 5, percent, min_words)
    assert resample(docs.limit(0), target).collect() == []
    assert len(resample(docs, target.limit(0)).collect()) == len(rows)
