"""The registered queries of the corpus operators: thin digests of their results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.ann import PermutationIndex
from creditloom.llm.chat import canonical_turns, chat_digests, format_chats
from creditloom.llm.divergence import audit
from creditloom.llm.langid import identify_language
from creditloom.llm.mixing import mix
from creditloom.llm.neardup import near_duplicates
from creditloom.llm.packing import pack
from creditloom.llm.passages import repeated_passages
from creditloom.llm.quality_rules import quality_rules
from creditloom.llm.resampling import resample
from creditloom.llm.rule_ensemble import classify_quality
from creditloom.llm.secrets import BASE_KINDS, joined, scan_secrets
from creditloom.llm.tables import stored, table
from creditloom.llm.token_files import read_token_files, write_token_files
from creditloom.session import scratch_dir


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = PermutationIndex(table(spark, sf_dir, "embeddings"))
    return index.search(index.rows.filter("vec_id % 50 = 0"))


def op2_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return classify_quality(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4).select("doc_id", "n_shingles", "component_id", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "held_out", "lang_pred", "score")


def _count_of(kind: str) -> Column:
    return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    counts = [_count_of(kind.name) for kind in BASE_KINDS]
    base = F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, joined(F.col("spans")).alias("spans"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    formatted = stored(format_chats(canonical_turns(rows.unionByName(more))), "chats")
    return chat_digests(formatted)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


LLM_QUERIES = {
    "op1_permutation_index": op1_permutation_index,
    "op2_rule_ensemble": op2_rule_ensemble,
    "op3_harmonic_packing": op3_harmonic_packing,
    "op4_pivotal_mixing": op4_pivotal_mixing,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_quality_rules": op6_quality_rules,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_language_id": op8_language_id,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_files": op10_token_files,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_source_divergence": op12_source_divergence,
    "op13_importance_resampling": op13_importance_resampling,
}

# Exact links by shared shingles and their closure, for the registered near-duplicate query.
OP7_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
), least_reached AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached ON a = d.doc_id
"""

# The digests of each conversation's turns. Escaping adds a character per backslash and control string.
OP11_SQL = """
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 20 + length(role) + length(replace(replace(replace(replace(text, '\\', '\\\\'), '<turn>', '<_turn>'), '<text>', '<_text>'), '</turn>', '<_/turn>')) AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

# Dense: each kept term of a language for each of its groups.
OP12_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), counted AS (
  SELECT d, lang, source, term, count(*) AS n FROM (SELECT d, lang, source, unnest(w) AS term FROM docs) GROUP BY ALL
), terms AS (
  SELECT lang, term, sum(n) AS n FROM counted GROUP BY ALL HAVING count(*) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM terms GROUP BY lang
), counts AS (
  SELECT c.lang, c.source, c.term, sum(c.n) AS n FROM counted c JOIN terms t ON c.lang = t.lang AND c.term = t.term GROUP BY ALL
), totals AS (
  SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), shares AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.total, 0) + l.v) AS p,
    1 + (1000000000::HUGEINT * (t.n + 1)) // (l.total + l.v) AS lang_p
  FROM groups g JOIN terms t ON g.lang = t.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN totals s ON g.lang = s.lang AND g.source = s.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - lang_p) * (p - lang_p)) // lang_p AS BIGINT) FROM shares WHERE n > 0 AND p > lang_p
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found
)
SELECT lang, source, part, item, value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= 200
"""

LLM_ORACLES: dict[str, str] = {"op7_near_duplicates": OP7_SQL, "op11_chat_formatting": OP11_SQL, "op12_source_divergence": OP12_SQL}
