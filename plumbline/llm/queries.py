"""Registered queries of the corpus operators over the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import table
from plumbline.llm.decontamination import leaked_items
from plumbline.llm.embedding_dedup import embedding_near_duplicates
from plumbline.llm.fill_in_middle import fill_in_middle, restored
from plumbline.llm.licenses import license_scan
from plumbline.llm.line_dedup import without_repeated_lines
from plumbline.llm.lm_scoring import lm_scores
from plumbline.llm.near_dedup import near_duplicates
from plumbline.llm.packing import packed
from plumbline.llm.sharding import first_map, grown_map, sharded, store_map, stored_map
from plumbline.llm.source_audit import source_divergences
from plumbline.llm.substring_dedup import without_repeated_spans
from plumbline.llm.toxicity import toxic_passages
from plumbline.llm.warc import archived
from plumbline.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, threshold=80)


@_query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("id").cast("string")) % 5 == 0
    found = toxic_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_tokens", "passages")


SHARDS = 40


@_query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = scratch_dir(spark, "slot-maps")
    slot_map = store_map(first_map(spark, SHARDS), maps)
    grown = store_map(grown_map(stored_map(spark, maps)), maps)
    found = sharded(table(spark, sf_dir, "documents"), slot_map, grown)
    names = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "slot_bytes")
    return found.withColumn("law", F.lit("key")).select(*names)


@_query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), word_tokenizer(), with_ids=False)


def word_tokenizer() -> str:
    """The path of the public tokenizer that the packing query is bound to."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query
def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


@_query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tag")


@_query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archived(table(spark, sf_dir, "pages"), least_revisit=0)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length")


@_query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@_query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("id").cast("string")) % 7 == 2
    found = lm_scores(table(spark, sf_dir, "documents"), ~held_out)
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    return found.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held_out"), *names)


@_query
def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergences(table(spark, sf_dir, "documents"))


@_query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    again = restored(F.col("output"), F.col("form"))
    digests = (F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@_query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op3_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN ws ELSE ws[k:k + 3] END AS shingle
  FROM (SELECT doc_id, ws, UNNEST(range(1, GREATEST(len(ws) - 2, 2))) AS k FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT b, low FROM reach JOIN links ON node = a)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, MIN(low) AS component_id, MIN(low) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON node = d.doc_id GROUP BY d.doc_id, n.n
"""

ORACLES["op7_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
  WHERE list_cosine_similarity(p.e, q.e) >= 0.93),
reach AS (SELECT vec_id AS node, vec_id AS low FROM embeddings UNION SELECT b, low FROM reach JOIN links ON node = a),
degree AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, MIN(low) AS component_id, MIN(low) = vec_id AS kept
FROM embeddings LEFT JOIN degree ON a = vec_id JOIN reach ON node = vec_id GROUP BY vec_id, n
"""

ORACLES["op11_source_divergence_audit"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
    regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT doc, lang, source, UNNEST(ts) AS term FROM d),
kept AS (SELECT lang, term, COUNT(*) AS c FROM t GROUP BY 1, 2 HAVING COUNT(DISTINCT doc) >= 3),
grp AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, COUNT(*) AS c FROM t GROUP BY 1, 2, 3),
cells AS (SELECT g.lang, g.source, k.term, COALESCE(n.c, 0) AS c, k.c AS lc FROM grp g JOIN kept k USING (lang) LEFT JOIN n USING (lang, source, term)),
sums AS (SELECT *, CAST(SUM(c) OVER s + COUNT(*) OVER s AS HUGEINT) AS gn, CAST(SUM(lc) OVER s + COUNT(*) OVER s AS HUGEINT) AS ln
  FROM cells WINDOW s AS (PARTITION BY lang, source)),
p AS (SELECT lang, source, term, c, 1 + 1000000000::HUGEINT * (c + 1) // gn AS p, 1 + 1000000000::HUGEINT * (lc + 1) // ln AS q FROM sums),
sides AS (SELECT a.lang, a.source, b.source AS item FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
gaps AS (SELECT a.lang, a.source, b.source AS item, SUM((a.p - b.p) * (a.p - b.p) // b.p) AS v FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
found AS (
  SELECT lang, source, 'pair' AS part, item, COALESCE(v, 0) AS value FROM sides LEFT JOIN gaps USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""

ORACLES["op12_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, sha256('42:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us, [CAST('0x' || h[8 * k + 1:8 * k + 8] AS BIGINT) FOR k IN [0, 1, 2, 3]] AS r FROM d),
c AS (SELECT doc_id, t, us, len(us) AS n, LEAST(r[1] % (len(us) + 1), r[2] % (len(us) + 1)) AS i, GREATEST(r[1] % (len(us) + 1), r[2] % (len(us) + 1)) AS j,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT *, array_to_string(us[1:i], '') AS p, array_to_string(us[i + 1:j], '') AS m, array_to_string(us[j + 1:], '') AS x FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM s
"""

ORACLES["op13_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, UNNEST(ls) AS line, UNNEST(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, MIN(doc_id) AS low FROM k WHERE length(key) >= 10 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, k.pos, k.line, g.key IS NOT NULL AND k.doc_id > g.low AS gone FROM k LEFT JOIN g ON g.key = k.key)
SELECT doc_id, CAST(COUNT(*) AS BIGINT) AS n_lines, CAST(COUNT(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
