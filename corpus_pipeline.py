"""Corpus pipeline: toxicity, exact dedup, near dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``; all but the last keep the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.decontamination import decontaminate
from tidemart.llm.exact_dedup import drop_copies
from tidemart.llm.merge_dropout import Pieces, encode_pieces
from tidemart.llm.near_dedup import drop_near_copies
from tidemart.llm.queries import PIECE_BPE
from tidemart.llm.shared import if_small, saved, table
from tidemart.llm.toxicity import fit, held_out, score_documents

#: Ids of dropped documents are broadcast up to this many bytes; beyond it joins shuffle.
BROADCAST_BYTES = 32 << 20


def without(docs: DataFrame, dropped: DataFrame, label: str) -> DataFrame:
    """``docs`` without the rows of the doc_ids in ``dropped`` (a null id by itself)."""
    ids = saved(dropped.select(F.col("doc_id").alias("drop_id")).distinct(), label)
    ids = if_small(ids, F.lit(16), BROADCAST_BYTES)
    return docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("drop_id")), "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from this stage's input."""
    labels = table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~held_out()))
    return without(docs, score_documents(docs, model).filter("score >= 0.5"), "toxic")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 the smallest doc_id stays."""
    return drop_near_copies(docs, words=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark windows go."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.filter("contaminated"), "contaminated")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document that is left, with merge-dropout."""
    return encode_pieces(docs, Pieces.load(PIECE_BPE)).select(
        "doc_id", "n_pieces", "ids_crc32", "lossless", "ids")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
          ("decontamination", benchmark), ("merge_dropout", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: A learnt score, near duplicates and merge-dropout have no SQL form.
ORACLE_SQL = None
