"""Token counts and packing against the library itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lumenframe.llm.packing import Rounds, mixture_phases, pack
from lumenframe.llm.token_count import PairMerger, token_counts
from lumenframe.llm.token_ids import TokenIds

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB, OWN, IDS = Tokenizer.from_file(PATH), PairMerger(PATH), TokenIds(PATH)
TEXTS = [
    None, "", " ", "  ", "a", " a  b ", "it's we'll\n\n x\n y \n", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
    "naïve Éé 日本語 ١٢٣ ½²", "tab\there\r\nthere  end\x1cx\x85y z", "x" * 5000, "ab " * 3000, "don't DON'T", "12345 67.8 !!!?? …", "é\n",
]
CHARS = st.text(st.sampled_from(list("ab'sltT09.,!?éß日 \n\t\r\x1c\x85\xa0 　²½_-<|>")) | st.characters(codec="utf-8"), max_size=60)


@given(CHARS)
@settings(max_examples=600, deadline=None)
def test_like_the_library(text):
    want = LIB.encode(text, add_special_tokens=False).ids
    assert OWN.count(text) == len(want)
    assert np.frombuffer(IDS([text])[0], IDS.kind).tolist() == want


WORDS = st.text(st.sampled_from(list("abcdefghorstuvßñéóäüèŁ.,!?'9")), min_size=1, max_size=9)


@given(st.lists(st.lists(st.tuples(WORDS, st.sampled_from([" ", " ", " ", "\n", "\n\n", "  ", "\t"])), max_size=12), max_size=6), st.lists(CHARS, max_size=4))
@settings(max_examples=400, deadline=None)
def test_slices_like_the_library(rows, odd):
    texts = ["".join(w + s for w, s in r).strip() for r in rows] + odd
    want = [e.ids for e in LIB.encode_batch(texts, add_special_tokens=False)]
    for end in (None, 7):
        ids, ends = IDS.flat(pa.array(texts, pa.string()), end)
        got = [x.tolist() for x in np.split(ids, ends)][: len(texts)]
        assert got == [w + [end] * (end is not None) for w in want]


def test_all_words_like_the_library():
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].combine_chunks()
    ids, ends = IDS.flat(texts)
    assert [x.tolist() for x in np.split(ids, ends)][: len(texts)] == [e.ids for e in LIB.encode_batch(texts.to_pylist(), add_special_tokens=False)]


def test_counts(spark):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(None, "a", 0), (3, "  ", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, PATH).collect())
    want = sorted((i is None, i or 0, len((t or "").encode()), n := len(LIB.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t, _ in rows)
    assert got == want
    assert token_counts(docs.limit(0), PATH).collect() == []


def check_pieces(rows, got, length):
    docs, seqs = {}, {}
    for r in got:
        docs.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == {i for i, _, _ in rows}
    for i, t, _ in rows:
        ids = [*LIB.encode(t or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            own = np.array(ids[at : at + r.length], "<u4")
            assert zlib.crc32(own.tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    last = max(seqs)
    for k, parts in seqs.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == length or k == last and at <= length
    assert sorted(seqs) == list(range(last + 1))


@pytest.mark.parametrize("weights", [None, {"a": 3, "b": 1}])
def test_pack(spark, weights):
    rows = [(i, t, "ab"[i % 2] if i % 5 else None) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    check_pieces(rows, pack(docs, PATH, length=64, window_sequences=4, weights=weights).collect(), 64)
    assert pack(docs.limit(0), PATH).collect() == []


@given(st.dictionaries(st.sampled_from("abcdefg"), st.integers(1, 3000), min_size=1), st.sampled_from([8, 64, 500]))
@settings(max_examples=60, deadline=None)
def test_windows_hold_the_mixture(totals, window):
    rounds = Rounds(0, {s: (0, n) for s, n in totals.items()}, window)
    total, taken = sum(totals.values()), np.zeros(sum(totals.values()), int)
    counts = {}
    for s, n in totals.items():
        for _, k, pos in rounds.pieces(s, 0, n):
            taken[pos : pos + k] += 1
            assert pos // window == (pos + k - 1) // window
            counts[s, pos // window] = counts.get((s, pos // window), 0) + k
    assert (taken == 1).all()
    for w in range(total // window):
        for s, n in totals.items():
            if n * window >= 2 * total and max(sorted(totals), key=totals.get) != s:
                assert abs(counts.get((s, w), 0) - n * window / total) <= 2


def test_phases_use_everything():
    phases = mixture_phases({"a": 100, "b": 10, None: 7, "z": 0}, {"a": 1, "b": 1, None: 2})
    used = {}
    for _, take in phases:
        for s, (first, n) in take.items():
            assert first == used.get(s, 0)
            used[s] = first + n
    assert used == {"a": 100, "b": 10, None: 7}


def test_joined_words_have_their_own_ids():
    import public_tokenizers

    from lumenframe.llm.token_ids import TokenIds

    lib = TokenIds(public_tokenizers.path("byte_bpe_50k.json"))
    words = [" a", "a", " ", "  ", "\n", "'s", " '", " 12", "12", " é", " ́x", " ​", "　", " ß!", " 中文", " …", ".", " x"] * 3
    assert lib.encode_words(words) == lib.encode(words)
    texts = ["plain words, with marks. and é", "x  y\n z", "", " lead", "á b​ c!", "<|endoftext|> a b"]
    assert lib(texts) == lib.encode(texts)


@pytest.mark.parametrize("totals", [
    {f"s{i}": 40 for i in range(3000)},
    {"large": 200_000, **{f"s{i}": 30 + i % 50 for i in range(300)}},
    {"large": 200_000, "one": 40},
    {f"s{i}": max(100_000 // (i + 1), 1) for i in range(1000)},
])
def test_small_and_largest_sources_keep_their_share(totals):
    window, total = 512, sum(totals.values())
    rounds, at = Rounds(0, {s: (0, n) for s, n in totals.items()}, window), np.full(total, -1)
    names = sorted(totals)
    for j, s in enumerate(names):
        for skip, k, pos in rounds.pieces(s, 0, totals[s]):
            assert (at[pos : pos + k] == -1).all()
            at[pos : pos + k] = j
    assert (at >= 0).all()
    for j, s in enumerate(names):
        ends = np.arange(window, total, window)
        sent = np.searchsorted(np.flatnonzero(at == j), ends)
        assert np.abs(sent - ends * (totals[s] / total)).max() <= (2 if totals[s] * window >= 2 * total else 12)


@pytest.mark.parametrize("weights", [None, {"s1": 2, "s2": 1}])
def test_pack_many_small_sources(spark, weights):
    rows = [(i, "word " * (i % 7) * 3, f"s{i % 500}" if i % 11 else None) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = pack(docs, PATH, length=16, window_sequences=2, weights=weights).collect()
    check_pieces(rows, got, 16)
    # No source is dealt out in one run: each of the unweighted ones spreads over the stream.
    seqs = {}
    for r in got:
        seqs.setdefault(r.source, []).append(r.sequence_id)
    last = max(max(x) for x in seqs.values())
    assert all(max(x) - min(x) > last / 2 for s, x in seqs.items() if s not in (weights or {}) and len(x) > 20)


def test_more_sources_than_the_driver_should_see(spark):
    n = 120_000
    docs = spark.range(n).selectExpr("id AS doc_id", "'a' AS text", "concat('s', id) AS source")
    got = pack(docs, PATH).agg({"length": "sum", "doc_id": "count"}).first()
    assert tuple(sorted(got)) == (n, 2 * n)


def test_packing_again_is_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5, "doc_id")
    first, again = (sorted(map(tuple, pack(docs, PATH).collect()), key=str) for _ in range(2))
    assert first == again
