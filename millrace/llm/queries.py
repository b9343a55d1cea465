"""The registered queries of this package: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.compact_windows import repeated_passages
from millrace.llm.decontamination import contaminated
from millrace.llm.divergence import source_divergence
from millrace.llm.fertility import quality_rules
from millrace.llm.language_id import language_id
from millrace.llm.license_scan import license_notices
from millrace.llm.near_dedup import near_duplicates
from millrace.llm.packing import pack_documents
from millrace.llm.recurrent_lm import score_documents
from millrace.llm.tables import read
from millrace.llm.token_counts import count_tokens, over_limit
from millrace.llm.url_templates import judge_urls
from millrace.llm.warc import archived_pages, read_warc, write_warc
from millrace.llm.whitening import whiten
from millrace.session import full_uri, run_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by the 32k piece vocabulary."""
    return over_limit(count_tokens(read(spark, folder, "documents")))


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and fertility verdict of every document."""
    return quality_rules(read(spark, folder, "documents"))


@query
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack_documents(read(spark, folder, "documents"))


@query
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents on four-word shingles."""
    return near_duplicates(read(spark, folder, "documents"), length=4)


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words and more that documents share with earlier ones."""
    return repeated_passages(read(spark, folder, "documents"))


@query
def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold an item of the benchmark."""
    return contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, by which documents are held out of learning."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(divisor))


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    documents = read(spark, folder, "documents").withColumn("held_out", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)))
    documents = documents.withColumn("learned", ~F.col("held_out"))
    return language_id(documents, "learned", keep=["held_out"])


@query
def op8_recurrent_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document, learned from four fifths of them."""
    documents = read(spark, folder, "documents").withColumn("held_out", F.coalesce(remainder("doc_id", 5) == 1, F.lit(False)))
    return score_documents(documents, "held_out")


RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


@query
def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the url of every page."""
    return judge_urls(read(spark, folder, "pages"), RULES)


@query
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in all documents."""
    return license_notices(read(spark, folder, "documents"))


@query
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened coordinates of every embedding."""
    return whiten(read(spark, folder, "embeddings"))


@query
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far the sources of each language differ in their words."""
    return source_divergence(read(spark, folder, "documents"))


ORACLE["op13_source_divergence"] = r"""
WITH rows_ AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
words AS (
  SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM rows_
),
counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT k) AS documents FROM words GROUP BY ALL
),
kept AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING sum(documents) >= 30),
langs AS (SELECT lang, count(*) AS size, sum(n) AS total FROM kept GROUP BY lang),
groups_ AS (SELECT DISTINCT lang, source FROM rows_),
cells AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS lang_n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, langs.total AS lang_total, langs.size
  FROM groups_ g JOIN kept ON kept.lang = g.lang JOIN langs ON langs.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
),
shares AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * size) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * size) AS q
  FROM cells
),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source
  GROUP BY ALL
),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(d.value, 0) AS value
  FROM groups_ g JOIN groups_ h ON g.lang = h.lang AND g.source != h.source
  LEFT JOIN distances d ON d.lang = g.lang AND d.source = g.source AND d.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query
def op11_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records and read back by byte ranges."""
    place = full_uri(spark, run_folder(spark, "warc"))
    write_warc(read(spark, folder, "pages"), place)
    return archived_pages(read_warc(spark, place)).withColumnRenamed("key", "page_id")


ORACLE["op11_warc_archive"] = """
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
sized AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM bodies),
headed AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS head FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < head THEN head END AS refers_to
FROM headed
"""
