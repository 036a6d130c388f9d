"""Rules as tables of violations: a table that is empty says that all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.text import collapse
from evidentia.operators.packets import entity_rows, unit_rows
from evidentia.schemas import COVERAGE, POLARITIES


def containment(provenance: DataFrame, chunks: DataFrame) -> DataFrame:
    """``provenance`` (paper_id, chunk_id, page_start, page_end, ...) with how it meets ``chunks``.

    ``problem`` is null where the pages lie within the chunk's; ``overlaps`` asks only that
    they meet.
    """
    known = chunks.select("paper_id", "chunk_id", F.col("page_start").alias("from_page"), F.col("page_end").alias("to_page"))
    d = provenance.join(known, ["paper_id", "chunk_id"], "left")
    within = (F.col("page_start") >= F.col("from_page")) & (F.col("page_end") <= F.col("to_page"))
    problem = F.when(F.col("from_page").isNull(), "unknown_chunk").when(F.col("page_end") < F.col("page_start"), "inverted_range").when(~within, "outside_chunk")
    overlaps = F.coalesce((F.col("from_page") <= F.col("page_end")) & (F.col("to_page") >= F.col("page_start")), F.lit(False))
    return d.withColumns({"problem": problem, "overlaps": overlaps})


def broken_references(edges: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """Rows of ``edges`` whose target isn't in ``targets``."""
    return edges.join(targets.select(*by).distinct(), by, "left_anti")


def set_differences(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """(by, side): keys that only one of two sets has; empty if they are equal."""
    a, b = left.select(*by).distinct().withColumn("l", F.lit(1)), right.select(*by).distinct().withColumn("r", F.lit(1))
    d = a.join(b, by, "full_outer").filter("l is null or r is null")
    return d.select(*by, F.when(F.col("r").isNull(), "missing").otherwise("extra").alias("side"))


def repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """Keys with several rows, and how many."""
    return rows.groupBy(*by).agg(F.count("*").alias("n")).filter("n > 1")


def truncated_collisions(ids: DataFrame) -> DataFrame:
    """Short ids of ``ids`` (canonical_id, digest) that stand for several digests."""
    return ids.groupBy("canonical_id").agg(F.count_distinct("digest").alias("n")).filter("n > 1")


def verified_excerpt(excerpt: Column, source: Column) -> Column:
    """Whether an excerpt stands in its source, white space aside."""
    return F.contains(collapse(source), collapse(excerpt))


def packet_violations(packets: DataFrame, chunks: DataFrame) -> DataFrame:
    """(rule, paper_id, entity_id) of nested packets against their chunks (paper_id, chunk_id, page_start, page_end, selected)."""
    u = unit_rows(packets)
    results, claims = entity_rows(u, "results", "e"), entity_rows(u, "claims", "e")
    say = lambda d, rule, entity: d.select(F.lit(rule).alias("rule"), "paper_id", entity.cast("string").alias("entity_id"))
    out = []
    for field, name in (("results", "result_id"), ("claims", "claim_id"), ("evidence_spans", "span_id"), ("methods", "method_id"), ("datasets", "dataset_id")):
        twice = repeated(entity_rows(u, field, "e").select("paper_id", F.col(f"e.{name}").alias("id")), ["paper_id", "id"])
        out.append(say(twice, f"{name}_repeats", F.col("id")))
    out.append(say(repeated(u.select("paper_id", F.col("unit.unit_id").alias("id")), ["paper_id", "id"]), "unit_id_repeats", F.col("id")))
    basis = claims.select("paper_id", "unit_id", F.col("e.claim_id").alias("claim_id"), F.explode("e.inference_basis_ids").alias("result_id"))
    known = results.select("paper_id", "unit_id", F.col("e.result_id").alias("result_id"))
    out.append(say(broken_references(basis, known, ["paper_id", "unit_id", "result_id"]), "basis_unknown", F.col("claim_id")))
    out.append(say(claims.filter(~F.col("e.polarity").isin(*POLARITIES)), "polarity", F.col("e.claim_id")))
    bad = ~F.coalesce(F.col("e.p_value").between(0, 1), F.lit(True)) | (F.coalesce(F.col("e.n_sample_size"), F.lit(1)) < 1) | F.isnan(F.coalesce(F.col("e.quantitative_value"), F.lit(0.0)))
    out.append(say(results.filter(bad), "statistic_out_of_range", F.col("e.result_id")))
    ledger = packets.select("paper_id", F.explode("coverage_ledger").alias("chunk_id", "status"))
    out.append(say(set_differences(chunks, ledger, ["paper_id", "chunk_id"]), "coverage_differs", F.col("chunk_id")))
    out.append(say(ledger.filter(~F.col("status").isin(*COVERAGE)), "coverage_status", F.col("chunk_id")))
    wrong = ledger.join(chunks.select("paper_id", "chunk_id", "selected"), ["paper_id", "chunk_id"]).filter((F.col("status") == "not_selected") == F.col("selected"))
    out.append(say(wrong, "coverage_selection", F.col("chunk_id")))
    out.append(say(packets.filter(F.col("status") != F.when(F.col("requires_reconciliation"), "provisional").otherwise("accepted")), "admission", F.lit(None)))
    merges = packets.select("paper_id", F.explode("merge_decisions").alias("m"))
    broken = F.array_contains("m.merged_ids", F.col("m.surviving_id")) | (F.size("m.merged_ids") == 0) | (F.size(F.array_distinct("m.merged_ids")) < F.size("m.merged_ids"))
    out.append(say(merges.filter(broken), "merge_decision", F.col("m.surviving_id")))
    first, *rest = out
    for d in rest:
        first = first.unionByName(d)
    return first


def require_empty(violations: DataFrame, what: str) -> None:
    """Raises ValueError that names up to ten violations."""
    rows = violations.limit(10).collect()
    if rows:
        raise ValueError(f"{what}: {', '.join(str(r.asDict()) for r in rows)}")
