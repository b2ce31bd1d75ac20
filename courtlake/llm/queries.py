"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm import decontaminate, line_dedup, masked_lm, quality, simhash, surrogates
from courtlake.llm.common import documents
from courtlake.llm.minhash import minhash_groups
from courtlake.llm.packing import pack
from courtlake.llm.repetition import repetition
from courtlake.llm.runs import periodic_runs, runs_text, strongest
from courtlake.llm.token_file import token_digests, write_tokens
from courtlake.llm.trie import number_turns, prefix_trie, with_shared_openings
from courtlake.llm.warc import look_up, write_archive
from courtlake.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(spark, documents(spark, sf_dir), simhash.TWO_BITS)
    return found.select(
        "doc_id", simhash.fingerprint_hex(found.sketch).alias("fingerprint"), "component_id")


@query
def op5_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "op5")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"),
                 keeps_space=False, end_id=2)
    return token_digests(spark, path)


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                keeps_space=True, end_id=2, capacity=1024, with_ids=False)


@query
def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


@query
def op10_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(documents(spark, sf_dir))


@query
def op1_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archive = write_archive(spark, pages, shared_dir(spark, "op1"), min_bytes=0)
    return look_up(spark, archive, pages.select("url")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLES["op1_warc_capture_index"] = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS original FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', CAST(1 + (
    CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) % 32 AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM f
"""


@query
def op2_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    state = line_dedup.insert_parts(spark, line_dedup.state_for(spark, docs), docs)
    # The last part is taken out and put in again: counts and filters come out as they were.
    last = line_dedup.of_part(docs, line_dedup.PARTS - 1)
    state = line_dedup.insert(spark, line_dedup.delete(spark, state, last), last)
    pairs = line_dedup.postings(spark, state, range(line_dedup.PARTS))
    kept = line_dedup.drop_repeated(spark, state, docs, pairs)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLES["op2_cuckoo_line_dedup"] = """
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
    unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, i, line, coalesce(k.doc_id <> last_doc, false) AS dropped FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op4_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return masked_lm.score(docs, *masked_lm.train(spark, docs))


@query
def op8_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return surrogates.replace_entities(spark, docs, key="op6")


def planted_cycle(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words; of each tenth document or so, by its checksum, a tail that repeats its own start."""
    h, n = (1 if doc_id is None else zlib.crc32(str(doc_id).encode())), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % period] for i in range(a, n)]


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(spark, sf_dir), planted_cycle)
    best = F.col("best")
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"),
        best.length.alias("length"), best.period.alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(runs_text(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_groups(spark, documents(spark, sf_dir))


ORACLES["op12_minhash_near_dedup"] = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle FROM d),
n AS MATERIALIZED (
  SELECT d.doc_id, count(shingle) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b
  WHERE 100 * i.n >= 80 * (x.n + y.n - i.n)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id, doc_id AS root FROM n
  UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(root) AS component_id, min(root) = n.doc_id AS kept
FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = number_turns(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie(spark, *with_shared_openings(spark, turns))


ORACLES["op13_prefix_trie"] = """
WITH o AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 100 AS source, xor(4294967295, list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda crc, x: list_reduce(range(8), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)), xor(crc, x)),
    4294967295)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
t AS MATERIALIZED (
  SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN o ON o.conv_id = c.source AND p < h
  UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN o USING (conv_id) WHERE p >= h),
q AS MATERIALIZED (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS depth FROM t),
k AS MATERIALIZED (
  SELECT conv_id, depth, length(text) AS chars,
    list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM q
  UNION ALL SELECT conv_id, 0, 0, [] FROM c),
m AS MATERIALIZED (
  SELECT conv_id, depth, chars, min(conv_id) OVER w AS node, count(*) OVER w AS n,
    max(depth) OVER (PARTITION BY conv_id) AS size
  FROM k WINDOW w AS (PARTITION BY depth, path)),
v AS MATERIALIZED (
  SELECT node, depth, any_value(n) AS n, any_value(chars) AS chars,
    string_agg(CASE WHEN size = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
  FROM m GROUP BY node, depth),
u AS MATERIALIZED (
  SELECT v.*, a.node AS parent FROM v LEFT JOIN m a ON a.conv_id = v.node AND a.depth = v.depth - 1),
x AS MATERIALIZED (
  SELECT u.*, count(b.node) AS n_children FROM u LEFT JOIN u b ON b.parent = u.node AND b.depth = u.depth + 1
  GROUP BY ALL),
z AS (
  SELECT a.node, a.depth, count(*) FILTER (x.n_children = 0) AS n_leaves, sum((x.n - 1) * x.chars) AS saved
  FROM x JOIN m a ON a.conv_id = x.node AND a.depth <= x.depth GROUP BY a.node, a.depth)
SELECT node AS conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n AS n_convs, n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM x JOIN z USING (node, depth)
"""
