"""The operators over the given tables: one query each, whole tables, whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokenizers
from .common import table
from .dedup import near_duplicates
from .fingerprint import edited_fingerprints
from .language import identify
from .licenses import scan
from .mixing import mix_sources
from .multi_index import neighbours
from .packing import pack_documents
from .resampling import importance_resample
from .substrings import remove_repeats
from .surrogates import replace_personal_data
from .toxicity import toxicity
from .url_filter import judge


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_replaced")


def op2_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, top=10)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"), k=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), max_repeat=2.0)
    return mixed.select("doc_id", "source", "tokens", "epoch", "block", "slot")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), URL_RULES)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizer())


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = edited_fingerprints(table(spark, sf_dir, "documents"))
    return marks.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizer(), public_tokenizer("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_inverted_multi_index": op2_inverted_multi_index,
    "op3_license_scan": op3_license_scan,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_temperature_mixing": op5_temperature_mixing,
    "op6_near_dedup": op6_near_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_document_fingerprints": op9_document_fingerprints,
    "op10_language_id": op10_language_id,
    "op11_toxicity": op11_toxicity,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

#: Words of every document, as lists; RE2 reads the class as the operators do.
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_OP6 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce({_WORDS.format(text=_FOLDED)}, []) AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4
    THEN [array_to_string(ws[i:i+3], ' ') FOR i IN range(1, len(ws) - 2)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), near AS (
  SELECT a, b FROM links JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * same >= 80 * (p.n + q.n - same)
), reach(a, b) AS (
  SELECT a, b FROM near UNION SELECT r.a, l.b FROM reach r JOIN near l ON r.b = l.a
), best AS (
  SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(b, w.doc_id)) AS component_id,
  w.doc_id = least(w.doc_id, coalesce(b, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN best USING (doc_id)
"""

ORACLE_OP4 = f"""
WITH w AS (
  SELECT doc_id, coalesce({_WORDS.format(text='text')}, []) AS ws FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i,
    unnest([array_to_string(ws[j:j+12], ' ') FOR j IN range(1, len(ws) - 11)]) AS win FROM w WHERE len(ws) >= 13
), least AS (
  SELECT win, min(doc_id) AS first_doc FROM g GROUP BY win
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM g JOIN least USING (win) WHERE first_doc < doc_id
), lost AS (
  SELECT doc_id, list(pos) AS pos FROM gone GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(pos), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string([ws[i] FOR i IN range(1, len(ws) + 1) IF pos IS NULL OR NOT list_contains(pos, i)], ' '), '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id)
"""

#: Lists hold the CRC table (made by its rule) and each distinct word's bytes.
ORACLE_OP12 = """
WITH crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT unnest(range(256)) AS i)
), words AS (
  SELECT 0 AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), met AS (
  SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM words)
), crcs AS (
  SELECT w, xor(list_reduce([4294967295::BIGINT] || [('0x' || x[2*i-1:2*i])::BIGINT FOR i IN range(1, len(x) // 2 + 1)],
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM met, crc_table
), counts AS (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM words JOIN crcs USING (w) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts
), weights AS (
  SELECT id AS doc_id, count(*) AS n_features, sum(gain) AS weight FROM words JOIN crcs USING (w) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op4_substring_dedup": ORACLE_OP4,
    "op6_near_dedup": ORACLE_OP6,
    "op12_importance_resampling": ORACLE_OP12,
}
