"""Provenance bound to chunks: which excerpt stands where, and how well it matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.functions.similarity import similarity
from evidentia.operators.packets import provenance_rows
from evidentia.operators.validation import set_differences


def bindings(packets: DataFrame, chunks: DataFrame) -> DataFrame:
    """A row for each provenance of ``packets`` that meets its chunk's pages, with its similarity (null if retold).

    Chunks are joined by paper and id, pages by overlap.
    """
    p = provenance_rows(packets).select("paper_id", "source_json_path", "p.*")
    c = chunks.select("paper_id", "chunk_id", F.col("page_start").alias("from_page"), F.col("page_end").alias("to_page"), F.col("text").alias("source_text"))
    d = p.join(c, ["paper_id", "chunk_id"]).filter("from_page <= page_end and to_page >= page_start")
    told, quoted = d.filter("paraphrased").withColumn("text_similarity", F.lit(None).cast("double")), similarity(d.filter("not paraphrased"))
    d = told.unionByName(quoted).withColumn("text_similarity", F.round("text_similarity", 6))
    return d.select("paper_id", "source_json_path", F.col("chunk_id").alias("upstream_chunk_id"), F.col("chunk_id").alias("resolved_chunk_id"), "page_start", "page_end", "paraphrased", F.lit("explicit_chunk_id").alias("binding"), "text_similarity")


def crosswalk(packets: DataFrame, chunks: DataFrame) -> DataFrame:
    """(paper_id, bindings, reference_count, minimum_similarity): a row for each paper with provenance, bindings by path."""
    b = bindings(packets, chunks)
    row = F.struct("source_json_path", "upstream_chunk_id", "resolved_chunk_id", "page_start", "page_end", "paraphrased", "binding", "text_similarity")
    return b.groupBy("paper_id").agg(F.array_sort(F.collect_list(row)).alias("bindings"), F.count("*").alias("reference_count"), F.min("text_similarity").alias("minimum_similarity"))


def problems(packets: DataFrame, chunks: DataFrame) -> DataFrame:
    """(rule, paper_id, detail): provenance that meets no chunk, ledgers that differ from the chunks."""
    bound = bindings(packets, chunks).select("paper_id", "source_json_path")
    lost = provenance_rows(packets).join(bound, ["paper_id", "source_json_path"], "left_anti").select(F.lit("unbound").alias("rule"), "paper_id", F.col("source_json_path").alias("detail"))
    ledger = packets.select("paper_id", F.explode("coverage_ledger").alias("chunk_id", "status"))
    gaps = set_differences(chunks, ledger, ["paper_id", "chunk_id"])
    return lost.unionByName(gaps.select(F.concat(F.lit("coverage_"), "side").alias("rule"), "paper_id", F.col("chunk_id").alias("detail")))
