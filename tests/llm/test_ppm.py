"""Byte PPM against a plain recursive version; word statistics and languages against counting."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import language_id, lm_score
from lumenframe.llm.base import learns
from lumenframe.llm.ppm import Scorer, Tree, grams, summed

TEXTS = ["abracadabra abra", "the cat sat on the mat", "The Cat  sat", "", None, "x", "a" * 300, "zebra quagga", "the the the\nthe"]


def stream(text):
    return b" ".join((text or "").encode().lower().split()) + b"\n"


class Plain:
    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            s = b"\n" * order + stream(t)
            for i in range(order, len(s)):
                for j in range(order + 1):
                    self.seen[s[i - j : i]][s[i]] += 1

    def chance(self, context, symbol):
        p, excluded = 1.0, set()
        for j in range(self.order, -1, -1):
            c = self.seen.get(context[len(context) - j :])
            if not c:
                continue
            c = {s: n for s, n in c.items() if s not in excluded}
            if not c:
                continue
            whole = sum(c.values()) + len(c)
            if symbol in c:
                return p * c[symbol] / whole
            p *= len(c) / whole
            excluded |= set(c)
        return p / (256 - len(excluded))

    def log10(self, text):
        s = b"\n" * self.order + stream(text)
        return sum(math.log10(self.chance(s[i - self.order : i], s[i])) for i in range(self.order, len(s)))


@pytest.mark.parametrize("order", [0, 1, 3, 4])
def test_tree_is_exact(order):
    plain = Plain(TEXTS[:3], order)
    code, _, _ = grams([t.encode() for t in TEXTS[:3]], order)
    c, n = np.unique(code, return_counts=True)
    scorer = Scorer([Tree(c, n, order, summed(c & np.uint64(255), n))])
    new = [t.encode() if t is not None else None for t in TEXTS]
    code, begin, _ = grams(new, order)
    got = np.add.reduceat(scorer(code)[:, 0], begin, dtype=float)
    np.testing.assert_allclose(got, [plain.log10(t) for t in TEXTS], rtol=1e-5)
    total = [plain.chance(b"\n" * order, s) for s in range(256)]
    assert math.isclose(sum(total), 1)


@pytest.mark.parametrize("shard", [4_000_000, 5])
def test_scores(spark, monkeypatch, shard):
    monkeypatch.setattr(lm_score, "SHARD_GRAMS", shard)
    monkeypatch.setattr(lm_score, "HOT_WORDS", 8)
    rows = [(i, t, 0) for i, t in enumerate(TEXTS * 4)] + [(None, "the", 0), (3, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int").repartition(3)
    got = lm_score.score_documents(docs, learn=learns(F.col("doc_id"), 7, 2)).collect()
    train = [t for i, t, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    plain, count = Plain(train, 5), Counter()
    for t in train:
        count.update([*stream(t).split(), None])
    total, kinds = sum(count.values()), len(count)
    want = []
    for i, t, _ in rows:
        w = [*stream(t).split(), None]
        base = sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w)
        want.append((i is None, i or 0, len(w), sum(count[x] > 0 for x in w), total, round(base, 6), round(plain.log10(t), 3)))
    have = [(r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3)) for r in got]
    for a, b in zip(sorted(have), sorted(want), strict=True):
        assert a == pytest.approx(b, rel=1e-4)
    assert lm_score.score_documents(docs.limit(0), learn=F.lit(True)).collect() == []


def test_languages(spark):
    import random

    rng = random.Random(3)
    stock = {"xx": ["lorem", "dolor", "amet", "sit"], "yy": ["und", "der", "nicht", "über"], "zz": ["κατα", "γραφω"]}
    rows = [(i, " ".join(rng.choices(stock[k], k=rng.randint(1, 30))), k, "s") for i, k in enumerate(rng.choices(list(stock), k=300))]
    rows += [(900, None, "xx", "s"), (901, "", None, "s"), (902, "12 -- 3", "yy", "s"), (903, "nicht nicht", None, "s"), (None, "amet", "xx", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in language_id.identify(docs, learn=~language_id.held_out()).collect()}
    assert len(got) == len(rows)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "yy"]
    assert got[None].lang_pred == "xx" and got[900].score == 0
    assert all(got[i].lang_pred == k and 0.5 < got[i].score <= 1 for i, _, k, _ in rows[:300])
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert language_id.identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language_id.identify(docs, learn=F.lit(False)).collect()} == {"und"}


def test_language_against_plain(spark):
    lessons = {"aa": ["the cat sat", "the mat", "a cat and a mat"], "bb": ["der hund lief", "der hof", "ein hund und ein hof"], "cc": ["the cat sat", "the mat", "a cat and a mat"]}
    rows = [(i, t, k, 0.5) for k, ts in lessons.items() for i, t in enumerate(ts)]
    asked = ["the hund", "cat cat cat", "Hof und Hund", "der der", "zzz qqq", "the " * 6000 + "hund", "the hund", "ÉÉ ss", "1 2 3", "", None]
    rows += [(100 + i, t, None, 0.5) for i, t in enumerate(asked)] + [(106, "the hund", None, 0.5), (None, "mat", None, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred double").repartition(3)
    plain = {k: Plain(ts, 3) for k, ts in lessons.items()}
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    text = {(i, k): t for i, t, k, _ in rows}
    for r in got:
        if r.doc_id is not None and r.doc_id >= 100:
            t = text[r.doc_id, None]
            if not t or not any(c.isalpha() for c in t):
                assert (r.lang_pred, r.score) == ("und", 0.0)
                continue
            cost = {k: p.log10(t) for k, p in plain.items()}
            best = max(cost.values())
            # aa and cc learn the same: ties go to the one that sorts first.
            assert r.lang_pred == min(k for k, v in cost.items() if v >= best - 1e-9)
            assert r.score == pytest.approx(1 / sum(10 ** max(v - best, -300) for v in cost.values()), rel=1e-3)
