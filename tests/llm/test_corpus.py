"""De-duplication, mixing, archives, search and the pipeline on small tables with odd rows."""

import base64
import gzip
import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check import compare, duck
from lumenframe.llm import ann, exact_dedup, language_id, mixing, near_dedup, registry, warc
from lumenframe.llm.base import keyed, new_path, shared_folder

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, name):
    got = registry.QUERIES[name](spark, FOLDER).toPandas()
    assert compare(got, duck(FOLDER).execute(registry.ORACLES[name]).fetchdf()).startswith("ok")


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact(spark, fan_in):
    rows = [(i, ["A b", "a B", None, "", "É", "é", "x" * 5000][i % 7], "k") for i in range(70)] + [(3, "", "k"), (None, "É", "k"), (None, "only", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(6)
    norm = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[norm(t)].append(i)
    want = Counter()
    for i, t, _ in rows:
        g = groups[norm(t)]
        keep = max((x for x in g if x is not None), default=None)
        want[i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    got = exact_dedup.exact_groups(docs, keep="largest", fan_in=fan_in).collect()
    assert Counter(tuple(r) for r in got) == want
    assert exact_dedup.exact_groups(docs.limit(0)).collect() == []


def test_near(spark):
    r = random.Random(1)
    stock = [f"w{i}" for i in range(800)]
    base, rows = [r.choice(stock) for _ in range(90)], []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
            w[r.randrange(len(w))] = r.choice(stock)
        rows.append((i, " ".join(w)))
    rows += [(i, " ".join(r.choices(stock, k=r.choice([0, 1, 2, 3, 40])))) for i in range(150, 200)]
    rows += [(200, None), (201, "  "), (202, "A b"), (203, "a\tB"), (None, "a b"), (204, "x " * 9000)]
    method = near_dedup.Method(ngram=3, percent=85)
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, component_id int")
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_dedup.near_groups(docs, method=method).collect()}
    sets, root = {}, {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j : j + 3]) for j in range(max(1, len(w) - 2))} if w else set()
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {i: got[i] for i in root} == {i: (len(sets[i]), find(i), find(i) == i) for i in root}
    assert got[None] == (1, None, True)
    assert near_dedup.near_groups(docs.limit(0), method=method).collect() == []


def test_mix_odd_rows(spark):
    rows = [(i, "w " * (i % 50), "s" if i % 3 else None, 1) for i in range(300)] + [(None, "a b", "z", 1), (7, "c", "z", 1), (8, None, "empty", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    taken, source = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        source[r.source] = r
        assert 0 <= r.taken <= 2 * r.size
    for s, r in source.items():
        assert abs(taken[s] - r.target) <= 50 and r.target <= 2 * r.source_size
    assert abs(sum(r.target for r in source.values()) - 1.5 * sum(r.source_size for r in source.values())) < 1e-6
    assert mixing.mix_sources(docs.limit(0)).collect() == []


def test_archives(spark):
    rows = [(i, f"http://x/{i}", ["<p>é</p>", None, "", "a\r\n\r\nWARC/1.1\r\n\r\n", "y" * 300_000][i % 5], "t") for i in range(20)]
    rows += [(30, None, "only", "t"), (31, "bad\r\nurl: x", "more", "t"), (None, "u", "<p>é</p>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(3)
    got = {r.page_id: tuple(r)[1:] for r in warc.archive_pages(pages).collect()}
    last = {}
    for i, _, h, _ in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        keep = last[h or ""] if i is not None else None
        want = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == keep else "revisit", None if i == keep else keep)
        assert got[i] == want
    assert warc.archive_pages(pages.limit(0)).collect() == []


def test_normalised_files_are_gzip_members(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 50) for i in range(9)], "page_id long, url string, html string").repartition(2)
    mono, out = new_path(spark, "mono"), str(tmp_path / "out")
    how = {"id": "page_id", "url": "url", "html": "html", "keep": "largest", "min_bytes": 0, "date": "2020-01-01T00:00:00Z"}
    warc.write_monolithic(warc.record_texts(pages, **how), mono)
    index = warc.normalise(spark, mono, out).collect()
    assert len(index) == 9
    for r in index:
        (path,) = (tmp_path / "out" / f"archive={r.archive}").glob("part-*")
        data = path.read_bytes()
        record = gzip.decompress(data[r.offset : r.offset + r.length])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert record in gzip.decompress(data)


def test_search(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 16)) + 3 * r.normal(size=(8, 16))[r.integers(0, 8, 3000)]
    x[100:400] = x[100]  # ties
    rows = [(i, v.tolist(), 0.0) for i, v in enumerate(x)]
    rows += [(5000, None, 0.0), (5050, [0.0] * 16, 0.0), (5100, [float("nan")] * 16, 0.0), (5150, [None] * 16, 0.0), (5200, [1.0], 0.0), (None, [1.0] * 16, 0.0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))

    def exact(q):
        s = ann.cosines(np.repeat(x[q : q + 1], len(x), 0), x)
        order = [i for i in np.lexsort((ids, -s)) if i != q][:5]
        return [(i, float(s[i])) for i in order]

    full = ann.search(table, parts=8, homes=1, probes=8).collect()
    by = defaultdict(list)
    for h in sorted(full, key=lambda h: (h.query_id, h.rank)):
        by[h.query_id].append((h.vec_id, h.score))
    assert set(by) == set(range(0, 3000, 50))
    assert all(by[q] == exact(q) for q in by)
    some = {(h.query_id, h.vec_id) for h in ann.search(table).collect()}
    assert np.mean([(q, i) in some for q in by for i, _ in exact(q)]) >= 0.9
    assert len(unit) == 3000 and ann.search(table.limit(0)).collect() == []


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = docs.limit(3).selectExpr("doc_id + 100000 AS doc_id", "upper(text) AS text", "lang", "source", "n_chars")
    bad = spark.createDataFrame([(200000, None, None, None, 0), (200001, "123 --", "en", "src1", 6)], docs.schema)
    docs.union(extra).union(bad).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        columns, docs = docs.columns, spark.read.parquet(path)
        seen[name] = docs.toPandas()
        assert name == "packing" or docs.columns == columns
    assert not {200000, 200001} & set(seen["language_id"].doc_id)
    ascii_only = {i for i, t in zip(seen["exact_dedup"].doc_id, seen["exact_dedup"].text, strict=True) if t.isascii()}
    assert not {i for i in ascii_only if i >= 100000}
    assert seen["exact_dedup"].text.str.lower().nunique() >= len(set(seen["near_dedup"].doc_id))
    assert set(seen["near_dedup"].doc_id) <= set(seen["exact_dedup"].doc_id)
    times = Counter(seen["mixing"].doc_id)
    assert set(times) <= set(seen["near_dedup"].doc_id) and max(times.values()) <= 2
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(lib.encode(t, add_special_tokens=False).ids) + 1 for t in seen["mixing"].text)
    assert seen["packing"].length.sum() == want
    fill = seen["packing"].groupby("sequence_id").length.sum()
    assert (fill.iloc[:-1] == 1024).all()
    folder = f"{shared_folder(spark)}/lumenframe"
    had = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])
    (left_over,) = set(os.listdir(folder)) - had
    assert left_over.startswith("pipeline-packing")


def test_pipeline_with_odd_tables(spark, tmp_path):
    names = ["id", "key", "_row", "_ROW_", "h", "src", "size", "copies", "_mixh", "rep", "root", "n", "digest", "run", "keep", "row", "label", "bucket", "lang_pred", "score", "kept", "ids", "start"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    docs.withColumns({n: F.lit(i) for i, n in enumerate(names)}).write.parquet(f"{tmp_path}/a/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/a/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, table, "")
        assert out.columns == table.columns and out.count() > 0
        assert out.where(" OR ".join(f"`{n}` <> {i}" for i, n in enumerate(names))).isEmpty()
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_numbers_of_rows_stay(spark, tmp_path):
    table = spark.range(1000).repartition(7)
    table.write.parquet(str(tmp_path / "t"))
    again, once = spark.read.parquet(str(tmp_path / "t")), spark.createDataFrame([(1,), (1,)], "_row long")
    rows, key = keyed(again, "rows")
    assert rows.select(key).distinct().count() == 1000
    assert rows.where("id % 3 = 0").select(F.col("id").alias("a"), key).join(rows, key).where("a <> id").isEmpty()
    rows, key = keyed(once, "rows")
    assert key == "_row_" and rows.select(key).distinct().count() == 2


def test_unknown_languages_go(spark):
    r = random.Random(5)
    words = "the of and to in is was that for with his they be at one have this from".split()
    prose = [(i, " ".join(r.choices(words, k=r.randint(1, 60))), "en", "s") for i in range(300)]
    coded = [(1000 + i, "".join(chr(r.randrange(0x21, 0x7F)) for _ in range(400)), None, "s") for i in range(5)]
    short = [(2000, "Qzx!", None, "s"), (2001, "Zebra", "en", "s")]
    kept = {x.doc_id for x in language_id.keep_identified(odd_ids(spark, prose + coded + short)).collect()}
    assert kept == {x[0] for x in prose + short}


PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix a jug of bitter liquid potions in the old barn"


def odd_ids(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


def left(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_language_judges_rows(spark):
    rows = [(1, "some words", "en", "s"), (1, "12 34", "en", "s"), (None, "more words", "en", "s"), (None, "--", "en", "s"), (2, None, "en", "s"), (1, "some words", "en", "s")]
    got = left(corpus_pipeline.identify(spark, odd_ids(spark, rows), ""))
    assert got == {(1, "some words"): 2, (None, "more words"): 1}


def test_exact_leaves_one_row(spark):
    rows = [(5, "A b"), (5, "A b"), (3, "a b"), (3, "other"), (5, "clean"), (None, "a b"), (None, "lone"), (None, "Lone"), (7, "twice"), (7, "twice"), (7, "twice")]
    docs = odd_ids(spark, [(*r, "en", "s") for r in rows])
    got = left(exact_dedup.drop_copies(docs))
    assert {k: n for k, n in got.items() if k[0] is not None} == {(3, "a b"): 1, (3, "other"): 1, (5, "clean"): 1, (7, "twice"): 1}
    assert sum(n for k, n in got.items() if k[0] is None) == 1 and len(got) == 5
    assert {i for (i, t) in left(exact_dedup.drop_copies(docs, keep="largest")) if t.lower() == "a b"} == {5}


def test_near_leaves_one_row(spark):
    rows = [(9, PROSE), (9, PROSE), (4, PROSE + " end"), (9, "a text of its own that nothing else here is like"), (None, "Late " + PROSE)]
    rows += [(None, "two rows without an id and with the same words"), (None, "two rows without an id and with the same words"), (None, " "), (8, None)]
    got = left(near_dedup.drop_near_copies(odd_ids(spark, [(*r, "en", "s") for r in rows])))
    assert got == {(4, PROSE + " end"): 1, (9, rows[3][1]): 1, (None, rows[5][1]): 1, (None, " "): 1, (8, None): 1}


def test_mix_takes_rows(spark):
    rows = [(i, "w " * (i % 9 + 1), "en", f"s{i % 3}") for i in range(90)] + [(None, "null id", "en", "s0"), (None, "null id too", "en", None), (5, "same id", "en", "s1"), (5, "same id", "en", "s1")]
    docs = odd_ids(spark, rows)
    want = Counter()
    for r in mixing.mix_sources(docs).collect():
        want[r.doc_id, r.size, r.source] += r.copies
    got = Counter((r.doc_id, len(r.text.split()), r.source) for r in corpus_pipeline.mix(spark, docs, "").collect())
    assert got == +want and any(i is None for i, _, _ in got)
    assert corpus_pipeline.mix(spark, docs, "").columns == docs.columns


def test_packing_takes_rows(spark):
    rows = [(None, "a b", "en", "s"), (None, "a b", "en", None), (1, "c", "en", "s"), (1, "c", "en", "s")]
    assert corpus_pipeline.pack(spark, odd_ids(spark, rows), "").groupBy("doc_id").count().count() == 2
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(lib.encode(r[1], add_special_tokens=False).ids) + 1 for r in rows)
    assert corpus_pipeline.pack(spark, odd_ids(spark, rows), "").agg({"length": "sum"}).first()[0] == want


def test_near_links_of_repeated_ids(spark):
    p = " ".join(f"w{i}" for i in range(32))
    for rows in (
        [(1, p), (1, p), (2, p), (3, "xxxxxxxxxx"), (3, p + " end")],
        [(3, p + " end"), (3, "xxxxxxxxxx"), (2, p), (1, p), (1, p), (4, "xxxxxxxxxx")],
    ):
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        got = near_dedup.near_groups(docs, method=near_dedup.Method(ngram=3, percent=85)).collect()
        assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), *[(i, 3) for i, _ in rows if i == 4]}
        assert len(got) == len(rows)


def test_merges_read_sorted_runs(spark):
    rows = spark.createDataFrame([(i, "d", 1, 1, 1) for i in range(4)], "keep long, digest string, n_bytes long, proof long, size long").withColumn("digest", F.col("digest").cast("binary"))
    plan = exact_dedup._merge(rows.withColumn("run", F.col("keep").cast("int")), F.floor(F.col("run") / 2).cast("int"), F.asc_nulls_last("keep"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Sort" in plan and plan.count("Exchange") == 1 and "HashAggregate" not in plan


def test_search_on_the_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    flat = table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    rows = ann.routed(flat, every=50, parts=None, homes=1, probes=None).select("id", "part", "query").toPandas()
    size, asked = rows[rows["query"] == 0].part.value_counts(), rows[rows["query"] == 1]
    n = table.count()
    assert len(rows[rows["query"] == 0]) == n and asked.part.map(size).fillna(0).sum() / asked.id.nunique() <= 0.5 * n
    x = np.array(table.orderBy("vec_id").toPandas().embedding.tolist(), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.array([r.vec_id for r in table.select("vec_id").orderBy("vec_id").collect()])
    got = {(r.query_id, r.vec_id) for r in ann.search(table).collect()}
    want = set()
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        s[q] = -2
        want |= {(int(ids[q]), int(ids[i])) for i in np.argsort(-s)[:5]}
    assert len(got & want) >= 0.9 * len(want)


def test_search_of_huge_and_tiny_vectors(spark):
    rows = [(i, [(i % 7 - 3.5) * s, (i % 5 - 2.5) * s, s]) for i, s in enumerate([1e200, 1.0, 1e-200, 5e-320] * 30)] + [(200, [1.0, 0.0, 0.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), parts=1, probes=1).collect()
    assert len(got) == 20 and all(-1.0000001 <= r.score <= 1.0000001 for r in got)


def test_search_of_repeated_ids(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (1, [0.1, 1.0]), (2, [1.0, 1.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), parts=1, probes=1).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(50, 1, 1), (50, 2, 2)]


def test_archives_of_repeated_ids(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (1, "v", "<p>b</p>"), (2, "u", "<p>a</p>"), (2, "w", "<p>b</p>")]
    got = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)).collect()
    assert len(got) == len(rows) and {(r.page_id, r.payload_bytes) for r in got} == {(1, 8), (2, 8)}
    assert {r.page_id for r in got if r.record_type == "response"} == {2}


def test_packing_of_clashing_columns(spark):
    names = ["start", "length", "offset", "sequence_id", "ids", "src", "run", "before", "base", "level", "low", "upto", "p_src", "n", "bucket"]
    docs = spark.createDataFrame([(i, "a b c " * i, f"s{i % 2}", *range(len(names))) for i in range(20)], ["doc_id", "text", "source", *names])
    plain = docs.select("doc_id", "text", "source")
    rows = lambda d: sorted(tuple(r) for r in corpus_pipeline.pack(spark, d.coalesce(1), "").collect())
    assert rows(docs) == rows(plain)
