"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from lumenframe.llm.prefix_trie import digests_of_lists, prefix_trie


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, own_turns in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = tuple(turns.get(base, [])[:h] + own_turns[h:])
    members = defaultdict(list)
    for c, s in full.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(list)
    for s in members:
        if s:
            children[s[:-1]].append(s)
    out, below = Counter(), {}
    for s in sorted(members, key=len, reverse=True):
        words = len(s[-1][1].encode().split()) if s else 0
        leaves = sum(below[k][0] for k in children[s]) or 1
        saved = (len(members[s]) - 1) * words + sum(below[k][1] for k in children[s])
        below[s] = leaves, saved
        ends = ",".join(map(str, sorted(c for c in members[s] if full[c] == s)))
        out[min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(children[s]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def conversations(seed, many, stock, longest):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-60, 400), many):
        for t in range(r.randrange(1, longest)):
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", "user", "user", None]), r.choice(stock)))
    return rows


@pytest.mark.parametrize("seed, block", [(1, 1), (2, 2), (3, 4), (4, 7)])
def test_trie(spark, seed, block):
    stock = ["a b", "a b", "a b", "A b", "", None, "c d  e", "é x "]
    rows = conversations(seed, 150, stock[: 2 + 2 * seed], 9)
    rows += [(500, t, "u", "one word more") for t in range(40)] + [(501, t, "u", "one word more") for t in range(37)] + [(502, 0, "u", "x" * 20_000)]
    rows += [(None, 0, "u", "nobody's")] + rows[:20]
    table = spark.createDataFrame([(*x, 1, "p") for x in rows], "conv_id long, turn int, role string, text string, depth int, parent string").repartition(6)
    got = Counter(map(tuple, prefix_trie(table, block=block).collect()))
    assert got == plain(rows)


def test_few_conversations(spark):
    schema = "conv_id long, turn int, role string, text string"
    for rows in ([(7, 0, "u", "a b")], [(7, 0, None, None), (9, 1, None, None)], [(20, 0, "a", "b"), (20, 1, "a", "c"), (21, 0, "a", "b")]):
        got = prefix_trie(spark.createDataFrame(rows, schema)).collect()
        assert Counter(map(tuple, got)) == plain(rows)
    assert prefix_trie(spark.createDataFrame([], schema)).collect() == []
    assert prefix_trie(spark.createDataFrame([(None, 0, "a", "b")], schema)).collect() == []


def test_long_lists(spark):
    ids = list(range(-5000, 20_000, 3))
    rows = [("x", i) for i in ids] + [("y", 5)]
    got = dict(map(tuple, digests_of_lists(spark.createDataFrame(rows, "end string, conv long").repartition(7)).collect()))
    assert got == {"x": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), "y": hashlib.sha256(b"5").hexdigest()}
