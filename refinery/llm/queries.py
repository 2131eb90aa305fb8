"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from refinery.llm import (
    bpe, cws, decontam, fim, paragraphs, secret_scan, simhash, substrings, token_counts, toxicity, turns, urlfilter,
    warc,
)
from refinery.llm.common import table, written
from refinery.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    @wraps(f)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = shipped
    return shipped


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 2 bits)."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", 3, 2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole document and the bytes they decode to, as digests."""
    vocab = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe.round_trip(table(spark, sf_dir, "documents"), "doc_id", "text", vocab, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose passage lies within an edit budget of 5 % of the item."""
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    manifest = warc.write(warc.plan(table(spark, sf_dir, "pages")))
    return warc.summaries(warc.read(manifest, payload=False)).withColumnRenamed("id", "page_id")


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]


@query
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the rules, then the list of canonical URLs found on hosts named as spam."""
    pages = table(spark, sf_dir, "pages")
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    listed = pages.where(host.contains("spam")).select(urlfilter.canonical(host, path).alias("url"))
    return urlfilter.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op8_url_filters"] = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages),
keyed AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') AS key FROM parts),
judged AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM keyed)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN key IN (SELECT key FROM keyed WHERE contains(host, 'spam')) THEN 'block'
            ELSE 'allow' END AS verdict
FROM judged
"""

ORACLE["op5_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100
"""


@query
def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every kind of secret in every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = secret_scan.BASE + secret_scan.FURTHER
    found = secret_scan.scan(docs, "text", rules)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("found", lambda x: x["kind"] < len(secret_scan.BASE))
    return found.select("doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(secret_scan.BASE)],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


ORACLE["op1_secret_scans"] = r"""
WITH rules(kind, pattern, grp, least, no) AS (VALUES
  ('assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6, 0),
  ('access', 'AKIA[A-Z0-9]+', 0, 20, 1),
  ('hex', '[0-9a-f]+', 0, 24, 2),
  ('pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 1, 3),
  ('github', 'gh[opsu]_[A-Za-z0-9]+', 0, 40, 4),
  ('slack', 'xox[abprs]-[A-Za-z0-9-]+', 0, 15, 5),
  ('jwt', 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+', 0, 20, 6)),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT r, kind, no, least,
         CASE kind
           WHEN 'assign' THEN regexp_split_to_array(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
           WHEN 'access' THEN regexp_split_to_array(text, 'AKIA[A-Z0-9]+')
           WHEN 'hex' THEN regexp_split_to_array(text, '[0-9a-f]+')
           WHEN 'pem' THEN regexp_split_to_array(text, '-----BEGIN [A-Z ]*PRIVATE KEY-----')
           WHEN 'github' THEN regexp_split_to_array(text, 'gh[opsu]_[A-Za-z0-9]+')
           WHEN 'slack' THEN regexp_split_to_array(text, 'xox[abprs]-[A-Za-z0-9-]+')
           ELSE regexp_split_to_array(text, 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+') END AS gaps,
         CASE kind
           WHEN 'assign' THEN regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
           WHEN 'access' THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+')
           WHEN 'hex' THEN regexp_extract_all(text, '[0-9a-f]+')
           WHEN 'pem' THEN regexp_extract_all(text, '-----BEGIN [A-Z ]*PRIVATE KEY-----')
           WHEN 'github' THEN regexp_extract_all(text, 'gh[opsu]_[A-Za-z0-9]+')
           WHEN 'slack' THEN regexp_extract_all(text, 'xox[abprs]-[A-Za-z0-9-]+')
           ELSE regexp_extract_all(text, 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+') END AS hits,
         CASE kind WHEN 'assign' THEN regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) END AS vals
  FROM docs, rules),
each AS (
  SELECT r, kind, no, least, i, length(gaps[i]) AS gap, length(hits[i]) AS len, length(coalesce(vals[i], hits[i])) AS val
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut)),
placed AS (
  SELECT r, kind, no, least, val, sum(gap + len) OVER (PARTITION BY r, no ORDER BY i) AS e, len FROM each),
kept AS (SELECT r, kind, no, CAST(e - len AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed WHERE val >= least),
told AS (
  SELECT r, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) FILTER (no < 3), '') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) AS spans
  FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (r)
"""


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole document by a network trained on the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.train(*toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, net).select(
        "doc_id", (toxicity.bucket(F.col("doc_id")) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted-sampling fingerprints of every whole document and of its edited text."""
    return cws.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of the documents that repeats elsewhere, exactly or nearly, with its class and the one kept."""
    found = paragraphs.duplicates(table(spark, sf_dir, "documents"))
    return found.drop("unit").withColumnRenamed("kept_id", "kept_doc_id")


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every whole document keeps once 50-byte strings of documents with smaller ids are removed."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


#: a document with more tokens is over the limit
TOKEN_LIMIT = 512


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_counts.count(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired turns of every damaged conversation."""
    rows = turns.damaged(table(spark, sf_dir, "conversations"))
    found = written(turns.audits(rows), "conversation-audits")
    told = turns.digests(rows, found).select(F.col("conv").alias("conv_id"), F.col("sha256").alias("repaired_sha256"))
    return found.join(told, F.col("conv").eqNullSafe(F.col("conv_id"))).select("conv_id", *turns.AUDIT, "repaired_sha256")


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document cut at two line ends and put into its fill-in-middle form, and rebuilt from it."""
    made = fim.transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", F.col("first_cut").alias("prefix_chars"),
                       (F.col("second_cut") - F.col("first_cut")).alias("middle_chars"),
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines FROM d),
k AS (
  SELECT *, len(lines) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
c AS (
  SELECT doc_id, text, n, form, array_to_string(lines[1:least(x, y)], '') AS prefix,
         array_to_string(lines[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(lines[greatest(x, y) + 1:], '') AS suffix
  FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""
