"""Registered queries of the training-data operators, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.exact_dedup import exact_groups
from rankflow.llm.fingerprints import compare_with_next
from rankflow.llm.lexical_search import search
from rankflow.llm.license_scan import TEMPLATES, license_report
from rankflow.llm.merkle import tampered_manifest
from rankflow.llm.mixing import mix_sources
from rankflow.llm.ngram_join import ngram_join
from rankflow.llm.packing import pack, packed_digest
from rankflow.llm.quality import judge_quality
from rankflow.llm.secret_scan import secret_report
from rankflow.llm.token_counts import count_tokens
from rankflow.llm.token_files import read_token_files, write_token_files
from rankflow.llm.url_filter import judge_urls
from rankflow.sources.workspace import new_folder, tidy

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _register(query):
    LLM_QUERIES[query.__name__] = tidy(query)
    return query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents")).drop("row_mark")


LLM_ORACLES["op1_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_register
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(_table(spark, sf_dir, "documents"))


@_register
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents")).drop("row_mark")


@_register
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_table(spark, sf_dir, "documents"))


@_register
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return packed_digest(pack(documents, public_tokenizers.path("word_bpe_49k.json")))


@_register
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


@_register
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


@_register
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).drop("row_mark")


@_register
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_manifest(_table(spark, sf_dir, "documents"))


_VALUE = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


def _row_digest(n_chars: str) -> str:
    return "sha256(" + " || ".join(_VALUE.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# Places of nodes are numbered level by level; a step holds a sibling and on which side it goes.
LLM_ORACLES["op11_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_row_digest("n_chars")} AS leaf, {_row_digest("(n_chars + 1)")} AS changed, n_chars IS NOT NULL AS changed_known,
         xor(list_reduce(
           list_concat([4294967295::UBIGINT], list_transform(range(8 * octet_length(encode(CAST(doc_id AS VARCHAR)))),
             lambda i: CAST((ascii(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 AS INTEGER) + 1, 1)) >> CAST(i % 8 AS INTEGER)) & 1 AS UBIGINT))),
           lambda crc, b: xor(crc >> 1, CASE WHEN (xor(crc, b) & 1) = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)
         ), 4294967295::UBIGINT) % 7 = 0 AS hit,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place
  FROM documents
),
tree AS (
  SELECT lang, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, any_value(level) + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY lang, place // 2
),
subroots AS (
  SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM tree WHERE n = 1
),
top AS (
  SELECT 0 AS level, place, node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM top WHERE n > 1 GROUP BY place // 2
),
steps AS (
  SELECT l.doc_id, t.level AS level, CASE WHEN t.place % 2 = 1 THEN '<' ELSE '>' END || coalesce(u.node, '') AS step
  FROM leaves l JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.n > 1 AND t.place = l.place // (1::BIGINT << t.level)
  LEFT JOIN tree u ON u.lang IS NOT DISTINCT FROM l.lang AND u.level = t.level AND u.place = xor(t.place, 1::BIGINT)
  UNION ALL
  SELECT l.doc_id, 1000 + t.level, CASE WHEN t.place % 2 = 1 THEN '<' ELSE '>' END || coalesce(u.node, '')
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN top t ON t.n > 1 AND t.place = s.place // (1::BIGINT << t.level)
  LEFT JOIN top u ON u.level = t.level AND u.place = xor(t.place, 1::BIGINT)
),
proofs AS (SELECT doc_id, list(step ORDER BY level) AS path FROM steps GROUP BY doc_id),
proved AS (
  SELECT l.doc_id, leaf, s.node AS subroot, (SELECT node FROM top WHERE n = 1) AS root, coalesce(path, []) AS path,
         CASE WHEN hit AND changed_known THEN changed ELSE leaf END AS start
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proofs p ON p.doc_id = l.doc_id
),
seen AS (
  SELECT *, list_reduce(list_concat([start], path),
                        lambda acc, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || acc ELSE acc || s[2:] END)) AS folded_root
  FROM proved
)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_concat([''], list_transform(path, lambda s: s[2:])), 'string_agg', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM seen
"""


@_register
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERMS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

LLM_ORACLES["op12_search"] = f"""
WITH doc_terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
corpus AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts CROSS JOIN corpus GROUP BY term, nn
),
item_terms AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))::BIGINT AS score
  FROM item_terms JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id) CROSS JOIN corpus
  GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@_register
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(_table(spark, sf_dir, "documents"))


_GRAMS = ", ".join(
    f"({number}, '{t.label}', {t.phrase}, {len(t.grams)}, {q}, [{', '.join(repr(w) for w in gram)}])"
    for number, t in enumerate(TEMPLATES)
    for q, gram in enumerate(t.grams)
)

LLM_ORACLES["op13_licenses"] = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
grams(number, label, phrase, total, q, words) AS (VALUES {_GRAMS}),
places AS (SELECT doc_id, words, unnest(range(len(words))) AS p FROM texts),
hits AS (
  SELECT doc_id, number, label, phrase, total, p, q, p - q AS diagonal, p + len(g.words) AS stop
  FROM places t JOIN grams g ON t.words[p + 1] = g.words[1] AND t.words[p + 1:p + len(g.words)] = g.words
),
marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER along > CASE WHEN phrase THEN 0 ELSE 4 END THEN 1 ELSE 0 END AS far
  FROM hits WINDOW along AS (PARTITION BY doc_id, number ORDER BY diagonal, p)
),
islands AS (SELECT *, sum(far) OVER (PARTITION BY doc_id, number ORDER BY diagonal, p) AS island FROM marked),
spans AS (
  SELECT doc_id, label, phrase, min(p) AS start, count(DISTINCT q) / CAST(any_value(total) AS DOUBLE) AS share
  FROM islands GROUP BY doc_id, number, label, phrase, island HAVING count(DISTINCT q) / CAST(any_value(total) AS DOUBLE) >= 0.8
)
SELECT t.doc_id, len(any_value(t.words)) AS n_words, count(*) FILTER (phrase) AS n_base,
       min(start) FILTER (phrase) AS first_word, max(start) FILTER (phrase) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0) AS score
FROM texts t LEFT JOIN spans s USING (doc_id)
GROUP BY t.doc_id
"""
