"""The corpus pipeline: classify, drop near copies, cut repeated passages, mix, pack.

Each stage takes what the one before it kept, written as Parquet and read again.  All but
the last return the columns of ``documents``, with further columns of the input, whatever
their names.  Every stage gives an empty table for an empty one and reads whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import mixing, near_dedup, packing, quality_classifier, suffix_dedup
from evidentia.llm.common import read, stored


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that importance resampling keeps, by the labels of ``sf_dir``.

    Null and empty texts weigh 0 and stay.  Rows with equal ids and texts share their lot,
    and rows that tie for the last place all stay; rows without id share one draw.
    """
    return quality_classifier.kept_rows(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the least id, of each group linked on 5-word shingles at 0.8.

    Null and empty texts link with nothing and stay, and so do rows without id.  Rows that
    share an id stay together, if any of them is kept.
    """
    gone = near_dedup.link(docs, n=5, percent=80).groupBy(F.col("doc_id").alias("gone")).agg(F.max("kept").alias("kept")).filter("not kept").drop("kept")
    return docs.join(gone, docs["doc_id"] == F.col("gone"), "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without the bytes of 200-byte strings that occur twice or more; n_chars follows the text.

    Null texts become empty.  Repeated rows repeat each other's strings, so all of them lose theirs.
    """
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as the sources' weights 5, 2, 1 ask, thrice at most; no row is lost, as the total covers every source once.

    Rows without words stay once.  A null source is a source of its own, last in order.
    Rows that share an id are repeated as the one that the mix takes most of.
    """
    return mixing.mixed_rows(docs, weights=(5, 2, 1), cap=3, cover=True)


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in 16 buckets by length, in batches of 65,536 words: doc_id, n_tokens, bucket, padded_length, batch_id, place.

    Rows without words are in no batch (nulls).  Repeated rows each take a place; ties of the
    hashed order are broken by id.
    """
    return packing.pack(docs).rows


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify),
    ("MinHash near-dedup", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_lengths),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage{i}")
    return docs
