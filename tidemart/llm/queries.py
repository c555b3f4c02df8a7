"""The registered queries of this package and the SQL that DuckDB can check them with."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.chat_windows import chat_windows, digests
from tidemart.llm.decontamination import WINDOW, decontaminate
from tidemart.llm.exact_dedup import exact_dedup
from tidemart.llm.lexical_search import rank_documents
from tidemart.llm.line_dedup import line_dedup
from tidemart.llm.merge_dropout import Pieces, encode_pieces
from tidemart.llm.merkle_manifest import build_manifest, leaf_digest, verify
from tidemart.llm.near_dedup import near_dedup
from tidemart.llm.quality_ranking import THRESHOLD, fit_ranker, held_out_quality, rank_quality
from tidemart.llm.shared import saved, table
from tidemart.llm.suffix_dedup import suffix_dedup
from tidemart.llm.token_counts import Vocabulary, token_counts
from tidemart.llm.token_files import token_checksums, write_tokens
from tidemart.llm.toxicity import fit, held_out, score_documents
from tidemart.session import work_path

#: Tokenizer files; each path is a parameter of its query's operator.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~held_out()))
    return (score_documents(docs, model)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, Path(BYTE_BPE).read_text())
    return token_checksums(spark.read.parquet(path))


#: A conversation whose texts hold marks like those of chat templates.
MARKED = ("\\### Assistant: </turn> ok",) * 2


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARKED[0]).alias("text"))
    return digests(saved(chat_windows(rows.unionByName(marked)), "chat"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), Vocabulary.load(PIECE_BPE))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), words=4)


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_pieces(table(spark, sf_dir, "documents"), Pieces.load(PIECE_BPE),
                            keep_ids=False)
    return encoded.select("doc_id", "n_pieces", "ids_crc32", "lossless")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffix_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (line_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_dropped", "kept_sha256"))


def tampered_leaf(docs: DataFrame) -> Column:
    """Leaf of a row whose text lost its capitals A-Z, for the fifth of the ids that are
    tampered with; null for the others."""
    lower = F.translate(docs["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(docs["doc_id"].cast("string")) % 5 == 0, leaf_digest(docs, lower))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return verify(build_manifest(docs, tampered_leaf(docs)))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("item_id", "rank", "doc_id", "score"))


def op13_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ranker = fit_ranker(docs, labels.filter(~held_out_quality()))
    return (rank_quality(docs, ranker)
            .select("doc_id", held_out_quality().alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_token_files, op3_chat_windows, op4_exact_dedup, op5_token_counts,
    op6_decontamination, op7_near_dedup, op8_merge_dropout, op9_suffix_dedup,
    op10_line_dedup, op11_merkle_manifest, op12_lexical_search,
    op13_quality_ranking)}
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = "string_split(coalesce(text, ''), chr(10))"
_STRIPPED = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_WORDS = (f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_TERMS = (f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

#: The other queries have no SQL form (learnt scores, tokenizers, near duplicates, windows of
#: a template, byte strings): tests/llm holds them against brute force.
ORACLE: dict[str, str] = {
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)""",
    "op6_decontamination": f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS} AS ws FROM benchmark),
p AS (SELECT DISTINCT id, n, array_to_string(ws[k:k + n - 1], ' ') AS win FROM (
        SELECT id, ws, least({WINDOW}, len(ws)) AS n,
               unnest(generate_series(1, greatest(1, len(ws) - {WINDOW - 1}))) AS k
        FROM i WHERE len(ws) > 0)),
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
o AS (SELECT doc_id, k, n, id FROM (
        SELECT doc_id, n, k, array_to_string(ws[k:k + n - 1], ' ') AS win FROM (
          SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS k
          FROM d, (SELECT DISTINCT n FROM p) WHERE len(ws) >= n)) JOIN p USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
        SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS j FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, id FROM o) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op10_line_dedup": f"""
WITH l AS (SELECT doc_id, unnest({_SPLIT}) AS line,
                  unnest(generate_series(1, len({_SPLIT}))) AS k FROM documents),
m AS (SELECT doc_id, line, k, {_LOWER.format(_STRIPPED)} AS key FROM l),
r AS (SELECT key, max(doc_id) AS keep_id FROM m WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
g AS (SELECT doc_id, line, k, keep_id IS NOT NULL AND keep_id <> doc_id AS gone
      FROM m LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM g GROUP BY doc_id""",
    "op12_lexical_search": f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ws FROM documents),
n AS (SELECT count(*) AS n, CAST(sum(len(ws)) AS BIGINT) AS l FROM d WHERE len(ws) > 0),
t AS (SELECT doc_id, n_terms, term, count(*) AS tf FROM (
        SELECT doc_id, len(ws) AS n_terms, unnest(ws) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), n),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(
        w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n_terms * n) // l)))) AS BIGINT)
        AS score FROM q JOIN w USING (term) JOIN t USING (term), n GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s WHERE score > 0) WHERE rank <= 10""",
}
