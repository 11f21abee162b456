"""Dominance reduction against exhaustive packing, and whole packings against the library."""

import functools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lumenframe.llm.best_fit import best_fit, pack_best_fit, places, reduce_instance

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(sizes, room):
    """Fewest sequences, by trying every set with the longest document."""

    @functools.cache
    def best(items):
        if not items:
            return 0
        first, rest = items[0], items[1:]
        out = len(items)
        seen = set()
        for mask in range(1 << len(rest)):
            own = tuple(x for i, x in enumerate(rest) if mask >> i & 1)
            if first + sum(own) <= room and own not in seen:
                seen.add(own)
                out = min(out, 1 + best(tuple(x for i, x in enumerate(rest) if not mask >> i & 1)))
        return out

    return best(tuple(sorted(sizes, reverse=True)))


@given(st.integers(4, 20).flatmap(lambda room: st.tuples(st.just(room), st.lists(st.integers(1, room), max_size=9))))
@settings(max_examples=400, deadline=None)
def test_reduction_loses_no_sequence(case):
    room, sizes = case
    count = np.bincount(np.array(sizes, int), minlength=room + 1)
    fixed, left = reduce_instance(count, room)
    rest = np.repeat(np.arange(room + 1), left).tolist()
    assert sum(n for _, n in fixed) + fewest(rest, room) == fewest(sizes, room)
    for contents, _ in fixed:
        assert sum(s * k for s, k in contents.items()) <= room
    # Equal documents in batches pack as one by one.
    free = []
    for s in sorted(rest, reverse=True):
        fits = [f for f in free if f >= s]
        if fits:
            free.remove(min(fits))
        free.append((min(fits) if fits else room) - s)
    assert sum(n for _, n in best_fit(left, room)) == len(free)


@given(st.integers(3, 12).flatmap(lambda room: st.tuples(st.just(room), st.lists(st.integers(1, room), max_size=60))))
@settings(max_examples=300, deadline=None)
def test_places_are_gapless(case):
    room, sizes = case
    count = np.bincount(np.array(sizes, int), minlength=room + 1)
    table, spans = places(count, room), defaultdict(list)
    for s in np.flatnonzero(count):
        own = table[table[:, 0] == s]
        for k in range(count[s]):
            _, first, each, seq, offset = own[np.searchsorted(own[:, 1], k, "right") - 1]
            spans[seq + (k - first) // each].append((offset + (k - first) % each * s, s))
    for seq in spans.values():
        at = 0
        for offset, s in sorted(seq):
            assert offset == at
            at += s
        assert at <= room
    assert sorted(spans) == list(range(len(spans)))


@pytest.mark.parametrize("length", [16, 1024])
def test_packing_is_whole(spark, length):
    lib = Tokenizer.from_file(PATH)
    texts = ["", None, "a", "word " * 40, "x" * 300, "a b c d e", "é\n\n日本 ", "one two three four"] * 6
    rows = [(i // 2 if i % 5 else None, t, i, 1, "s") for i, t in enumerate(texts)] + [(7, "again", 0, 0, "")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece long, run int, length string").repartition(5)
    got = pack_best_fit(docs, PATH, length=length, keep_ids=True).collect()
    want = []
    for i, t, *_ in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % length + 1
        starts = [0, *range(first, len(ids), length)]
        for p, (x, y) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append((i, p, x, y - x, zlib.crc32(np.array(ids[x:y], "<u4").tobytes()), ids[x:y]))
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got), key=key) == sorted(want, key=key)
    spans = defaultdict(list)
    for r in got:
        spans[r.sequence_id].append((r.offset, r.length))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(x + n == y for (x, n), (y, _) in zip(s, s[1:], strict=False))
        assert sum(n for _, n in s) <= length
    assert len(spans) <= 1.25 * -(-sum(r.length for r in got) // length) + 1
    assert pack_best_fit(docs.limit(0), PATH).collect() == []
