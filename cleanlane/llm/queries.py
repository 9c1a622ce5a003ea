"""The operators' queries over the given tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, chat, collocate, decontam, langid, neardup, pii, repeats, sharding, topk, urlfilter, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and number -7, formatted and read back."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    messages = said.unionByName(more).withColumn("content", chat.text_part(F.col("text")))
    return chat.digests(chat.format_conversations(messages))


ORACLES["op1_chat_format"] = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\b'), '<(/?turn|image|audio|document)>', '<12\1>', 'g')) AS text_len,
    length(replace(regexp_replace(replace(role, '\', '\b'), '<(/?turn|image|audio|document)>', '<12\1>', 'g'), chr(10), '12')) AS role_len
  FROM m)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn>') + role_len + 1 + text_len + length('</turn>')) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
FROM e GROUP BY conv_id
"""


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against all 10-word windows of the benchmark."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op2_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[a:a + 9], ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS a FROM b WHERE len(ws) > 0)),
v AS (
  SELECT doc_id, a, n, array_to_string(ws[a:a + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS a FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)),
m AS (SELECT doc_id, item, a, n FROM v JOIN w USING (n, win)),
hits AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS i FROM m) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)
"""


#: Where the vocabulary files are; their folder is a parameter.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and decoded text."""
    return bpe.digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of nearly equal bytes; equal texts share a shard."""
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Rules of the URL query, and the host labels whose pages make up its list. Fixed values.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
LISTED_LABELS = ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x")


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, else by the list: the canonical URLs of pages under listed host labels."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(F.arrays_overlap(F.split(urlfilter.host_of(F.col("url")), r"\."), F.array(*map(F.lit, LISTED_LABELS)))).select("url")
    return urlfilter.judge(pages, listed, URL_RULES)


ORACLES["op7_url_filter"] = rf"""
WITH u AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(verdict, rule, rh, rp) AS (VALUES {", ".join(f"('{v}', '{r}', '{r[:r.index('/')]}', '{r[r.index('/'):]}')" for v, r in URL_RULES)}),
fit AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL),
j AS (
  SELECT u.*, len(list_intersect(string_split(u.host, '.'), [{", ".join(f"'{x}'" for x in LISTED_LABELS)}])) > 0 AS listed FROM u)
SELECT j.page_id, j.host, j.path, fit.rule,
  coalesce(fit.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM j LEFT JOIN fit ON j.page_id IS NOT DISTINCT FROM fit.page_id AND j.host = fit.host AND j.path = fit.path
"""


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLES["op8_warc"] = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS hex FROM p),
b AS (
  SELECT page_id, n, hex, max(page_id) OVER (PARTITION BY hex) AS top,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS digest
  FROM h)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM b
"""


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every twentieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLES["op9_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under similarity 0.8 of their 4-word shingle sets."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


ORACLES["op10_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM d),
p AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM p AS a JOIN p AS b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT doc_id AS v, doc_id AS r FROM d UNION SELECT e.y, reach.r FROM reach JOIN e ON e.x = reach.v),
c AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM s JOIN c ON c.v = s.doc_id
"""


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, by a text model fitted on labelled documents and the pages' own evidence."""
    return langid.identify_pages(table(spark, sf_dir, "pages"), langid.fit(table(spark, sf_dir, "documents")))


#: Key of the pseudonyms in the queries; a deployment brings its own.
PII_KEY = "cleanlane"


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and the number of values replaced."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, count="n_replaced")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language of all documents."""
    return collocate.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


ORACLES["op11_collocations"] = r"""
WITH p AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, array_to_string(ws[a:a + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS a FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS HUGEINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 100),
cuts AS (SELECT *, unnest(range(1, k)) AS j FROM c),
s AS (
  SELECT c.lang, c.k, c.phrase, c.a, j, h.f AS l, r.f AS r, t.n, (1000 * CAST(c.a AS HUGEINT) * t.n) // (CAST(h.f AS HUGEINT) * r.f) AS score
  FROM cuts AS c JOIN t ON t.lang = c.lang
  JOIN f AS h ON h.lang = c.lang AND h.phrase = array_to_string(c.ws[1:j], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[j + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, j) = 1),
inside AS (
  SELECT DISTINCT x.lang, x.phrase FROM c AS x JOIN c AS y ON x.lang = y.lang AND y.k > x.k AND y.a >= x.a AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')),
kept AS (SELECT * FROM s WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM inside))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers, aligned by their bytes."""
    return align.alignment_digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


@query
def op13_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 400-byte strings."""
    return repeats.removal_digests(table(spark, sf_dir, "documents"))
