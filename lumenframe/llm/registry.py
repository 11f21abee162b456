"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import ann, best_fit, exact_dedup, importance, language_id, lm_score, mixing, near_dedup, packing, prefix_trie, suffix_dedup, token_count, warc
from lumenframe.llm.base import learns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_minhash_near_dedup")
def _near(spark, folder):
    method = near_dedup.Method(ngram=3, percent=85)
    return near_dedup.near_groups(table(spark, folder, "documents"), method=method)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_packing")
def _packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), vocabulary())


@query("op3_token_count")
def _tokens(spark, folder):
    return token_count.token_counts(table(spark, folder, "documents"), vocabulary())


_FLAT = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op4_exact_dedup", f"""
WITH d AS (SELECT doc_id, sha256({_FLAT}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def _exact(spark, folder):
    return exact_dedup.exact_groups(table(spark, folder, "documents"), keep="largest")


@query("op5_lm_score")
def _score(spark, folder):
    out = lm_score.score_documents(table(spark, folder, "documents"), learn=learns(F.col("doc_id"), 7, 2))
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op7_warc", """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, payload_bytes, h, array_to_string(
        [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)
         FOR i IN range(32)], '') AS payload_digest FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = max(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = max(page_id) OVER g THEN NULL ELSE max(page_id) OVER g END AS refers_to
FROM b WINDOW g AS (PARTITION BY h)""")
def _warc(spark, folder):
    return warc.archive_pages(table(spark, folder, "pages"))


@query("op9_nearest_neighbours")
def _nearest(spark, folder):
    return ann.search(table(spark, folder, "embeddings"))


@query("op8_suffix_array_dedup")
def _suffixes(spark, folder):
    return suffix_dedup.cut_repeats(table(spark, folder, "documents")).drop("kept")


@query("op10_language_id")
def _language(spark, folder):
    docs = table(spark, folder, "documents")
    out = language_id.identify(docs, learn=learns(F.col("doc_id"), 4, 2))
    return out.select("doc_id", (~learns(F.col("doc_id"), 4, 2)).alias("held_out"), "lang_pred", "score")


@query("op6_mixing", r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 15) AS BIGINT) AS h
  FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INT) + 1]::DOUBLE AS w FROM t),
c AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / w AS ratio FROM w),
l AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
             coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_cap,
             sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w
      FROM c WINDOW o AS (ORDER BY ratio, source ASC NULLS LAST)),
v AS (SELECT min((budget - before_cap) / rest_w) AS level FROM (
        SELECT *, row_number() OVER (ORDER BY ratio, source ASC NULLS LAST) AS k FROM l WHERE (budget - before_cap) / rest_w <= ratio) WHERE k = 1),
p AS (SELECT source, source_size, least(cap, coalesce(level * w, cap)) AS target FROM c, v),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM p),
u AS (SELECT source, h, sum(size) AS unit FROM d GROUP BY source, h),
x AS (SELECT source, h, unit, sum(unit) OVER (PARTITION BY source ORDER BY h) - unit AS below FROM u)
SELECT d.doc_id, d.size, q.source_size, q.target,
       CAST(CASE WHEN q.source_size = 0 THEN 0
            ELSE d.size * (q.passes + CASE WHEN x.below + x.unit / 2.0::DOUBLE <= q.target - q.passes * q.source_size THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h""")
def _mixing(spark, folder):
    out = mixing.mix_sources(table(spark, folder, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query("op13_best_fit_packing")
def _best_fit(spark, folder):
    return best_fit.pack_best_fit(table(spark, folder, "documents"), vocabulary())


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PAIRS = "[CAST('0x' || substr(hex({x}), 2 * i + 1, 2) AS BIGINT) FOR i IN range(strlen({x}))]"


def crc32_sql(x: str) -> str:
    """CRC-32 of the UTF-8 bytes of ``x``, where ``tab`` is the list of the 256 values of a byte."""
    steps = f"list_reduce(list_concat([4294967295], {_PAIRS.format(x=x)}), lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


CRC_TABLE = """tab AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) AS r(i))"""


@query("op12_importance_resampling", rf"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS word FROM d),
bw AS (SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
k AS (SELECT word, {crc32_sql('word')} % 10000 AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw) AS u, tab),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN k USING (word) GROUP BY bucket),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000 AS ss, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + 10000 AS tt),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ss / ((s + 1)::DOUBLE * tt)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), n),
v AS (SELECT doc_id, sum(gain)::BIGINT AS total FROM dw JOIN k USING (word) JOIN g USING (bucket) GROUP BY doc_id),
x AS (SELECT doc_id, len(w) AS n_features, CASE WHEN len(w) = 0 THEN 0 ELSE floor(total / len(w)::DOUBLE)::BIGINT END AS weight,
             CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) AS h FROM d LEFT JOIN v USING (doc_id)),
y AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM x),
z AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS fit FROM y WHERE n_features >= 20)
SELECT y.*, z.rank FROM y LEFT JOIN z ON z.doc_id = y.doc_id AND z.rank <= 10 * z.fit // 100""")
def _importance(spark, folder):
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ngram=1, seed=2024)


@query("op11_conversation_prefix_trie", rf"""
WITH {CRC_TABLE},
t AS (SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k) AS ms FROM t GROUP BY conv_id),
h AS (SELECT conv_id, ms, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM l, tab),
r AS (SELECT c.conv_id, list_concat(coalesce(b.ms[1:c.h], []), c.ms[c.h + 1:]) AS ms FROM h AS c LEFT JOIN h AS b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, len(ms) AS n, ms, unnest(range(len(ms) + 1)) AS depth FROM r),
q AS (SELECT conv_id, n, depth, [x.k FOR x IN ms[1:depth]] AS pre, CASE WHEN depth = 0 THEN 0 ELSE ms[depth].w END AS w FROM p),
v AS (SELECT depth, array_to_string(pre, ',') AS path, any_value(pre) AS pre, min(conv_id) AS conv_id, count(*) AS n_convs, min(w) AS w,
             sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
      FROM q GROUP BY depth, array_to_string(pre, ',')),
e AS (SELECT c.*, u.conv_id AS parent_conv_id FROM v AS c LEFT JOIN v AS u ON u.depth = c.depth - 1 AND u.path = array_to_string(c.pre[1:c.depth - 1], ',')),
n AS (SELECT e.*, coalesce(k.n_children, 0) AS n_children FROM e LEFT JOIN (SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children
      FROM e WHERE depth > 0 GROUP BY 1, 2) AS k ON k.depth = e.depth AND k.conv_id = e.conv_id),
a AS (SELECT n_children, (n_convs - 1) * w AS saved, pre, unnest(range(depth + 1)) AS up FROM n),
s AS (SELECT up AS depth, array_to_string(pre[1:up], ',') AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM a GROUP BY 1, 2)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256 FROM n JOIN s ON s.depth = n.depth AND s.path = n.path""")
def _trie(spark, folder):
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))
