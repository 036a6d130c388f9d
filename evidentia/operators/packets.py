"""Packets taken apart: rows for questions, units, results, claims, spans, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EMPTY = lambda c: F.coalesce(c, F.array())


def units(questions: Column) -> Column:
    return F.flatten(F.transform(_EMPTY(questions), lambda q: _EMPTY(q["study_units"])))


def of_units(units_: Column, field: str) -> Column:
    return F.flatten(F.transform(units_, lambda u: _EMPTY(u[field])))


def unit_rows(packets: DataFrame) -> DataFrame:
    """paper_id, question_id, statement, question_at, unit_at, unit."""
    q = packets.select("paper_id", F.posexplode("research_questions").alias("question_at", "q"))
    return q.select("paper_id", F.col("q.question_id").alias("question_id"), F.col("q.statement").alias("statement"), "question_at", F.posexplode("q.study_units").alias("unit_at", "unit"))


def entity_rows(units_: DataFrame, field: str, alias: str) -> DataFrame:
    """A row for each member of a list of the units, with its place."""
    return units_.select("paper_id", "question_id", "question_at", "unit_at", F.col("unit.unit_id").alias("unit_id"), F.posexplode(F.col(f"unit.{field}")).alias("at", alias))


def atomic_items(packets: DataFrame) -> DataFrame:
    """(paper_id, item_id, kind, text): what a judge may call wrong.  Of equal ids the last one counts, so each is there once."""
    u = unit_rows(packets)
    key = lambda kind, e: F.concat_ws(":", F.lit(kind), "unit_id", e)
    parts = [packets.select("paper_id", F.explode("research_questions").alias("q")).select("paper_id", F.concat(F.lit("question:"), F.col("q.question_id")).alias("item_id"), F.lit("research_question").alias("kind"), F.col("q.statement").alias("text"))]
    tasks = entity_rows(u, "experiments_or_tasks", "e")
    parts.append(tasks.select("paper_id", key("task", (F.col("at") + 1).cast("string")).alias("item_id"), F.lit("experiment_or_task").alias("kind"), F.col("e").alias("text")))
    for field, kind, name in (("datasets", "dataset", "dataset_id"), ("methods", "method", "method_id"), ("results", "result", "result_id"), ("claims", "claim", "claim_id")):
        e = entity_rows(u, field, "e")
        parts.append(e.select("paper_id", key(kind, F.col(f"e.{name}")).alias("item_id"), F.lit(kind).alias("kind"), F.to_json("e").alias("text")))
    bounds = packets.select("paper_id", F.posexplode("limitations_and_boundaries").alias("at", "e"))
    parts.append(bounds.select("paper_id", F.concat(F.lit("boundary:"), (F.col("at") + 1).cast("string")).alias("item_id"), F.lit("limitation_or_boundary").alias("kind"), F.col("e").alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("paper_id", "item_id").agg(F.last("kind").alias("kind"), F.last("text").alias("text"))


def evidence_entities(questions: Column) -> Column:
    """Array of (entity_id, provenances) of results, claims and spans, by id."""
    u = units(questions)
    whole = lambda e: F.concat(F.array(e["provenance"]), _EMPTY(e["additional_provenance"]))
    entity = lambda name, prov: lambda e: F.struct(e[name].alias("entity_id"), prov(e).alias("provenances"))
    parts = [
        F.transform(of_units(u, "results"), entity("result_id", whole)),
        F.transform(of_units(u, "claims"), entity("claim_id", whole)),
        F.transform(of_units(u, "evidence_spans"), entity("span_id", lambda e: F.array(e["provenance"]))),
    ]
    return F.array_sort(F.concat(*parts), lambda a, b: F.when(a["entity_id"] < b["entity_id"], -1).when(a["entity_id"] > b["entity_id"], 1).otherwise(0))


def provenance_rows(packets: DataFrame) -> DataFrame:
    """(paper_id, entity_type, entity_id, source_json_path, p): every provenance with its path."""
    u = unit_rows(packets)
    at = lambda c: F.concat(F.lit("["), F.col(c).cast("string"), F.lit("]"))
    out = None
    for field, kind, name in (("results", "result", "result_id"), ("claims", "claim", "claim_id"), ("evidence_spans", "span", "span_id")):
        path = F.concat(F.lit("$.research_questions"), at("question_at"), F.lit(".study_units"), at("unit_at"), F.lit(f".{field}"), at("at"))
        e = entity_rows(u, field, "e").select("paper_id", F.lit(kind).alias("entity_type"), F.col(f"e.{name}").alias("entity_id"), path.alias("path"), "e")
        own = e.select("paper_id", "entity_type", "entity_id", F.concat("path", F.lit(".provenance")).alias("source_json_path"), F.col("e.provenance").alias("p"))
        out = own if out is None else out.unionByName(own)
        if field != "evidence_spans":
            more = e.select("paper_id", "entity_type", "entity_id", "path", F.posexplode("e.additional_provenance").alias("n", "p"))
            out = out.unionByName(more.select("paper_id", "entity_type", "entity_id", F.concat("path", F.lit(".additional_provenance"), at("n")).alias("source_json_path"), "p"))
    return out.filter("p is not null")
