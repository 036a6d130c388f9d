"""What canonicalisation will do, as a table with digests, and what must hold before and after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.text import canonical_json
from evidentia.operators import canonical as K
from evidentia.operators.packets import entity_rows, unit_rows
from evidentia.operators.validation import broken_references, repeated, truncated_collisions
from evidentia.sources.shared import stored

REFERENCE = ("entity_type", "question_id", "source_unit_id", "source_entity_id", "content_sha256")


def entities(packets: DataFrame) -> DataFrame:
    """(paper_id, REFERENCE..., scope_digest, digest, canonical_id, standing): every unit, result and claim with its key."""
    u = stored(K.unit_keys(packets), "units")
    r = stored(K.result_keys(u), "results")
    c = K.claim_keys(u, r)
    lists = ("experiments_or_tasks", "datasets", "methods", "results", "claims", "evidence_spans")
    filled = sum((F.size(F.coalesce(f"e.{x}", F.array())) for x in lists), F.lit(0))
    units = u.withColumnsRenamed({"unit": "e", "norm": "n"}).withColumn("unit_id", F.col("e.unit_id"))
    parts = ((units, "unit_id", K.standing(filled, F.col("n.name"), "unit_id", provenance=False)), (r, "result_id", K.result_standing()), (c, "claim_id", K.claim_standing()))
    out = []
    for d, own_id, standing in parts:
        sha = F.sha2(canonical_json(F.to_json("e", {"ignoreNullFields": "false"})), 256)
        out.append(d.select("paper_id", "entity_type", "question_id", F.col("unit_id").alias("source_unit_id"), F.col(f"e.{own_id}").alias("source_entity_id"), sha.alias("content_sha256"), "scope_digest", "digest", "canonical_id", standing.alias("standing")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def plan(packets: DataFrame) -> DataFrame:
    """(paper_id, entity_type, canonical_id, digest, scope_digest, representative, members): a row for each canonical entity.  Members are references in order; the first by standing represents them."""
    reference = F.struct(*REFERENCE)
    d = entities(packets).groupBy("paper_id", "entity_type", "canonical_id", "digest", "scope_digest")
    return d.agg(F.min_by(reference, "standing").alias("representative"), F.array_sort(F.collect_list(reference)).alias("members"))


def plan_violations(packets: DataFrame, planned: DataFrame) -> DataFrame:
    """(rule, paper_id, entity_id) of a plan: short ids that stand for several digests, members that ``packets`` no longer have as they were, entities that no row has."""
    members = planned.select("paper_id", F.explode("members").alias("m")).select("paper_id", "m.*")
    now = entities(packets).select("paper_id", *REFERENCE)
    by = ["paper_id", *REFERENCE]
    short = truncated_collisions(planned).select(F.lit("id_collides").alias("rule"), F.lit(None).cast("string").alias("paper_id"), F.col("canonical_id").alias("entity_id"))
    gone = members.join(now, by, "left_anti").select(F.lit("member_changed").alias("rule"), "paper_id", F.col("source_entity_id").alias("entity_id"))
    lost = now.join(members, by, "left_anti").select(F.lit("entity_unplanned").alias("rule"), "paper_id", F.col("source_entity_id").alias("entity_id"))
    return short.unionByName(gone).unionByName(lost)


def _rows(d: DataFrame, rule: str, entity: Column) -> DataFrame:
    return d.select(F.lit(rule).alias("rule"), "paper_id", entity.cast("string").alias("entity_id"))


def _ids(packets: DataFrame) -> dict[str, DataFrame]:
    """(paper_id, unit_id, id) of units, results and claims."""
    u = unit_rows(packets)
    of = lambda field, name: entity_rows(u, field, "e").select("paper_id", "unit_id", F.col(f"e.{name}").alias("id"), *([F.col("e.inference_basis_ids").alias("basis")] if field == "claims" else []))
    return {"unit": u.select("paper_id", F.col("unit.unit_id").alias("unit_id"), F.col("unit.unit_id").alias("id")), "result": of("results", "result_id"), "claim": of("claims", "claim_id")}


def _basis(ids: dict[str, DataFrame]) -> DataFrame:
    basis = ids["claim"].select("paper_id", "unit_id", F.col("id").alias("claim_id"), F.explode("basis").alias("id"))
    return _rows(broken_references(basis, ids["result"].select("paper_id", "unit_id", "id"), ["paper_id", "unit_id", "id"]), "basis_outside_unit", F.col("claim_id"))


def input_violations(packets: DataFrame) -> DataFrame:
    """(rule, paper_id, entity_id) of what keeps packets from being canonicalised: ids of a kind that repeat, bases outside their unit."""
    questions = packets.select("paper_id", F.explode("research_questions").alias("q")).select("paper_id", F.col("q.question_id").alias("id"))
    ids = _ids(packets)
    out = _rows(repeated(questions, ["paper_id", "id"]), "question_id_repeats", F.col("id"))
    for kind, d in ids.items():
        out = out.unionByName(_rows(repeated(d.select("paper_id", "id"), ["paper_id", "id"]), f"{kind}_id_repeats", F.col("id")))
    return out.unionByName(_basis(ids))


def output_violations(packets: DataFrame) -> DataFrame:
    """(rule, paper_id, entity_id) of canonical packets: ids that repeat or aren't canonical, bases outside their unit."""
    ids = _ids(packets)
    out = _basis(ids)
    for kind, name in (("unit", "study_unit"), ("result", "result"), ("claim", "claim")):
        prefix = f"{K.PREFIX[name]}_"
        out = out.unionByName(_rows(repeated(ids[kind].select("paper_id", "id"), ["paper_id", "id"]), f"{kind}_id_repeats", F.col("id")))
        out = out.unionByName(_rows(ids[kind].filter(~F.coalesce(F.startswith("id", F.lit(prefix)), F.lit(False))), f"{kind}_id_not_canonical", F.col("id")))
    return out
