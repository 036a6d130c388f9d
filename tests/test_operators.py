import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidentia.operators import canonical, chunks, clusters, crosswalk, ledger, merging, planning, quality, recovery, repair, reporting, validation
from evidentia.schemas import PACKET


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def cut(spark, *texts):
    return chunks.papers(docs(spark, *texts), "id", "text", chunks.feed_pages(F.coalesce("text", F.lit(""))))


def test_pages_skip_blanks_and_keep_numbers(spark):
    c = chunks.chunk_rows(cut(spark, "Abstract a\f \f b\n")).orderBy("ordinal").collect()
    assert [(r.ordinal, r.page_start, r.text, r.section_hint) for r in c] == [(1, 1, "Abstract a", "abstract"), (2, 3, "b", "page")]
    assert len({r.chunk_id for r in c}) == 2 and all(len(r.chunk_id) == 20 for r in c)


def test_empty_and_null_papers_are_reported(spark):
    p = cut(spark, None, "", "x")
    assert {(r.rule, r.paper_id) for r in chunks.violations(p).collect()} == {("no_text", 0), ("no_text", 1)}
    assert chunks.chunk_rows(p).count() == 1


def test_equal_content_has_equal_ids_and_colliding_stems_differ(spark):
    a, b = chunks.chunk_rows(cut(spark, "x", "x")).collect()
    assert a.chunk_id == b.chunk_id
    ids = {r.path: r.paper_id for r in chunks.paper_ids(spark.createDataFrame([("a/x y.pdf",), ("b/x-y.pdf",), ("b/z.pdf",)], "path string")).collect()}
    assert ids["b/z.pdf"] == "z" and ids["a/x y.pdf"].startswith("x-y-") and len(set(ids.values())) == 3


def test_changed(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2")], "paper_id string, source_sha256 string")
    assert [r.paper_id for r in chunks.changed(now, now.filter("paper_id = 'a'")).collect()] == ["b"]


@pytest.mark.parametrize(
    "text, domain, mode",
    [
        ("nothing here", "general_method", "methodological"),
        ("a clinical trial of a cell line", "clinical_trial", "methodological"),
        ("bioinformatics, framework algorithm benchmark", "general_method", "methodological"),
        ("the assay shows microscopy", "wet_lab_molecular", "phenomenological"),
        ("assay microscopy with an opposite effect and knockout", "wet_lab_molecular", "contrastive"),
        ("assay microscopy microscopy colocalization knockout", "wet_lab_molecular", "causal_validation"),
        ("an unnecessary assay", "wet_lab_molecular", "causal_validation"),
    ],
)
def test_classify(spark, text, domain, mode):
    c = planning.classify(cut(spark, text)).first().classification
    assert (c.domain, c.mode) == (domain, mode)


def test_selection_keeps_the_first_and_takes_the_best(spark):
    p = planning.plan(cut(spark, "\f".join(["References only", "x", "references knockout", "result result", "knockout", "method"])), max_chunks=3).first()
    assert p.selected == [1, 4, 5] or p.selected == [1, 5, 6]
    assert p.scores[2] == -1000 and p.selected[0] == 1


def test_selection_by_ordinals(spark):
    s = planning.scored(planning.classify(cut(spark, "a\fb\fc")))
    assert planning.select(s, ordinals=(3, 1, 3)).first().selected == [3, 1]
    assert planning.select(s, ordinals=(9,)).first().selected is None
    with pytest.raises(ValueError):
        planning.select(s, 0)


def test_labels_name_domains_and_modes(spark):
    d = spark.createDataFrame([("Biomedical-AI",), ("a study of Cell_Biology",), (None,), ("clinical_trial",), ("odd",)], "x string")
    assert [r[0] for r in d.select(planning.domain_of(F.col("x"))).collect()] == ["computational_biology", "wet_lab_molecular", "general_method", "clinical_trial", "general_method"]
    m = spark.createDataFrame([("Causal-Validation ",), ("x",), (None,)], "x string")
    assert [r[0] for r in m.select(planning.mode_of(F.col("x"))).collect()] == ["causal_validation", None, None]


def prov(chunk="c1", first=1, last=1, text="exact words", retold=False):
    return {"chunk_id": chunk, "page_start": first, "page_end": last, "text_excerpt": text, "paraphrased": retold}


def packet(**changes):
    unit = {
        "unit_id": "U1", "name": "trial", "experiments_or_tasks": ["measure"], "datasets": [], "methods": [],
        "results": [{"result_id": "R1", "metric_name": "m", "value_raw_text": "1", "provenance": prov(), "additional_provenance": []}],
        "claims": [{"claim_id": "C1", "statement": "s", "polarity": "positive", "inference_basis_ids": ["R1"], "provenance": prov(), "additional_provenance": []}], "evidence_spans": [],
    }
    p = {
        "schema_version": "2.2", "paper_id": "p", "metadata": {}, "coverage_ledger": {"c1": "extracted"}, "research_questions": [{"question_id": "Q1", "statement": "why", "study_units": [unit]}],
        "limitations_and_boundaries": [f"Boundary {i} is long enough to count as substantial." for i in "abc"], "quality_score": 0.0, "status": "accepted", "requires_reconciliation": False, "validation_warnings": [], "merge_decisions": [],
    }
    return p | changes


def table(spark, *packets):
    return spark.read.schema(PACKET).json(spark.sparkContext.parallelize([json.dumps(p) for p in packets]))


def test_full_score(spark):
    r = quality.rule_quality(table(spark, packet())).first()
    assert r.score == 1.0 and r.warnings == []


def test_blank_boundary_costs_a_fifth(spark):
    r = quality.rule_quality(table(spark, packet(limitations_and_boundaries=packet()["limitations_and_boundaries"] + [" "]))).first()
    assert r.components[2].ratio == 0.8 and [w.code for w in r.warnings] == ["boundaries.blank"]


def test_broken_packet_is_warned_about_in_order(spark):
    p = packet(coverage_ledger={"c1": "failed"}, limitations_and_boundaries=["short"])
    u = p["research_questions"][0]["study_units"][0]
    u["results"][0] |= {"metric_name": " ", "provenance": prov("c9", retold=True)}
    u["claims"][0] |= {"inference_basis_ids": [], "provenance": prov("c9", retold=True)}
    r = quality.rule_quality(table(spark, p)).first()
    assert r.score < 0.7
    assert [w.code for w in r.warnings] == [
        "structure.results_without_metrics", "structure.claims_without_evidence", "coverage.no_extracted_chunks", "provenance.paraphrased_only", "provenance.untracked_chunks", "coverage.failed_chunks",
        "boundaries.too_few", "boundaries.shallow",
    ]


def test_empty_packet_has_a_score(spark):
    r = quality.rule_quality(table(spark, packet(research_questions=[], coverage_ledger={}, limitations_and_boundaries=[]))).first()
    assert [w.code for w in r.warnings] == ["structure.no_research_questions", "coverage.missing_ledger", "provenance.no_evidence_entities", "boundaries.none"] and 0 <= r.score < 0.2


def test_scores_of_empty_sets(spark):
    d = spark.createDataFrame([(0, 0, 0), (0, 0, 2), (4, 4, 0), (4, 1, 1)], "e int, i int, m int")
    got = [tuple(r) for r in d.select(*(quality.prf(F.col("e"), F.col("i"), F.col("m"))[k].alias(k) for k in ("precision", "recall", "f1"))).collect()]
    assert got == [(1, 1, 1), (1, 0, 0), (0, 1, 0), (0.75, 0.75, 0.75)]
    stored = spark.createDataFrame([(4, 1, 1, 0.75, 0.75, 0.75), (4, 1, 1, 0.75, 0.75, 0.8)], "extracted_item_count int, incorrect_item_count int, missed_core_item_count int, precision double, recall double, f1 double")
    assert quality.score_violations(stored).count() == 1


def test_packet_rules(spark):
    known = spark.createDataFrame([("p", "c1", 1, 1, True)], "paper_id string, chunk_id string, page_start int, page_end int, selected boolean")
    assert validation.packet_violations(table(spark, packet()), known).count() == 0
    p = packet(coverage_ledger={"c2": "odd"}, status="provisional")
    p["research_questions"][0]["study_units"][0]["claims"][0] |= {"inference_basis_ids": ["R9"], "polarity": "maybe"}
    p["research_questions"][0]["study_units"] *= 2
    rules = {r.rule for r in validation.packet_violations(table(spark, p), known).collect()}
    assert rules == {"result_id_repeats", "claim_id_repeats", "unit_id_repeats", "basis_unknown", "polarity", "coverage_differs", "coverage_status", "admission"}
    with pytest.raises(ValueError):
        validation.require_empty(validation.packet_violations(table(spark, p), known), "packet")


def test_ids_that_lose_their_difference(spark):
    d = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "1")], "canonical_id string, digest string")
    assert [r.canonical_id for r in validation.truncated_collisions(d).collect()] == ["a"]


def test_repairs_go_one_way():
    texts, pages = {"c1": "the exact words of a chunk", "c2": "other"}, {"c1": (2, 3), "c2": (1, 1)}
    payload = {"a": prov("c1", 2, 9, "the exact words"), "b key": [prov("c1", 2, 2, "unlike anything at all"), prov("c2", 9, 1, "other", True), prov("c9", 5, 6)]}
    fixed, done = repair.repaired(payload, texts, pages)
    assert [(r.kind, r.json_path) for r in done] == [("paraphrase", '$["b key"][0].paraphrased'), ("page_range", "$.a")]
    assert fixed["a"]["page_start"] == 2 and fixed["a"]["page_end"] == 3 and fixed["b key"][1] == payload["b key"][1] and payload["a"]["page_end"] == 9
    assert [w["code"] for w in repair.warnings(done * 2, flat=True)] == ["extraction.flat_fallback", "extraction.provenance_page_range_corrected", "extraction.provenance_paraphrase_corrected"]


@pytest.mark.parametrize("names, want", [("MMM", ["M", "M__dup2", "M__dup3"]), (["M", "M__dup2", "M"], ["M", "M__dup2", "M__dup3"]), (["M__dup2", "M", "M", "M"], ["M__dup2", "M", "M__dup3", "M__dup4"])])
def test_methods_get_suffixes(names, want):
    fixed, _ = repair.repaired({"research_questions": [{"study_units": [{"methods": [{"method_id": n} for n in names]}]}]}, {}, {})
    assert [m["method_id"] for m in fixed["research_questions"][0]["study_units"][0]["methods"]] == want


def test_complete_link_does_not_chain(spark):
    pairs = spark.createDataFrame([("x", "a", "b", 900_000), ("x", "c", "b", 900_000), ("x", "a", "c", 700_000)], "block string, a string, b string, score_ppm int")
    items = spark.createDataFrame([("x", k) for k in "cab"] + [("y", "a")], "block string, key string")
    got = {(r.block, r.key): r.cluster for r in clusters.complete_link(items, pairs, 800_000).collect()}
    assert got == {("x", "a"): "a", ("x", "b"): "a", ("x", "c"): "c", ("y", "a"): "a"}
    assert clusters.merge_complete(["b", "a"], np.array([[0, 5], [5, 0]]), 6) == [["a"], ["b"]]


def test_canonical_keys_ignore_order_and_ids(spark):
    p = packet()
    u = p["research_questions"][0]["study_units"][0]
    u["results"] = [u["results"][0], u["results"][0] | {"result_id": "R2", "value_raw_text": " 1 "}, u["results"][0] | {"result_id": "R3", "value_raw_text": "2", "quantitative_value": 2.0}]
    rows = canonical.canonical_results(table(spark, p)).collect()
    assert sorted(r.source_ids for r in rows) == [["R1", "R2"], ["R3"]] and all(r.canonical_id.startswith("res_") and len(r.canonical_id) == 28 for r in rows)
    u["results"].reverse()
    assert {r.canonical_id for r in canonical.canonical_results(table(spark, p)).collect()} == {r.canonical_id for r in rows}
    k = canonical.unit_keys(table(spark, p))
    c = canonical.claim_keys(k, canonical.result_keys(k)).collect()
    assert len(c) == 1 and c[0].canonical_id.startswith("clm_")


def test_crosswalk_binds_by_overlap(spark):
    known = spark.createDataFrame([("p", "c1", 1, 2, "some exact words here")], "paper_id string, chunk_id string, page_start int, page_end int, text string")
    r = crosswalk.crosswalk(table(spark, packet()), known).first()
    assert r.reference_count == 2 and r.minimum_similarity == 1.0 and [b.source_json_path for b in r.bindings] == sorted(b.source_json_path for b in r.bindings)
    assert crosswalk.problems(table(spark, packet()), known).count() == 0
    bad = packet()
    bad["research_questions"][0]["study_units"][0]["results"][0]["provenance"] = prov("c1", 5, 6)
    assert [r.rule for r in crosswalk.problems(table(spark, bad), known).collect()] == ["unbound"]


def test_costs_are_null_strict(spark):
    s = spark.createDataFrame([("a", 20, 10, True, 0.5, 0.1), ("a", 5, 5, True, 0.5, None), ("b", 20, 40, False, 1.0, 0.2)], "paper_id string, prompt_tokens long, completion_tokens long, usage_complete boolean, latency_seconds double, estimated_cost_usd double")
    s = s.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))
    p = spark.createDataFrame([("a", "succeeded", 0.5), ("b", "succeeded", 1.0), ("c", "failed", None)], "paper_id string, status string, quality_score double")
    r = reporting.records(s, p)
    assert {x.paper_id: (x.total_tokens, x.estimated_cost_usd, x.usage_complete) for x in r.collect()} == {"a": (40, None, True), "b": (60, 0.2, False), "c": (0, None, True)}
    t = reporting.run_summary(r).first()
    assert (t.input_count, t.succeeded, t.failed, t.total_tokens, t.estimated_cost_usd, t.mean_quality_score, t.estimated_cost_is_lower_bound) == (3, 2, 1, 100, None, 0.75, True)
    assert reporting.run_summary(r.filter("false")).first().usage_complete is True


def test_cost_golden(spark):
    calls = spark.createDataFrame([(1, 20, 25, 0.1, True), (1, 20, 25, 0.2, True)], "paper_id int, prompt_tokens int, completion_tokens int, latency_seconds double, usage_complete boolean")
    r = reporting.stage_metrics(calls, ["paper_id"], 1.0, 2.0).first()
    assert (r.prompt_tokens, r.completion_tokens, r.total_tokens, r.estimated_cost_usd, r.attempts) == (40, 50, 90, 0.00014, 2)
    with pytest.raises(ValueError):
        reporting.pricing(1.0, None, "2026-01-01")
    with pytest.raises(ValueError):
        reporting.pricing(1.0, 1.0)


def test_recovery(spark):
    f = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], "paper_id string, source_sha256 string")
    now = spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4")], "paper_id string, source_sha256 string")
    got = {r.paper_id: r.action for r in recovery.split(f, now, f.filter("paper_id = 'd'")).collect()}
    assert got == {"a": "retry", "b": "changed", "c": "missing", "d": "present"}
    assert {r.paper_id: r.action for r in recovery.split(f, now, f.filter("false"), True).collect()}["b"] == "retry"
    records = f.withColumn("status", F.when(F.col("paper_id") < "c", "failed").otherwise("succeeded"))
    assert recovery.failed(records, ["a"]).count() == 1
    with pytest.raises(ValueError):
        recovery.failed(records, ["c"])
    assert [r.paper_id for r in recovery.append_new(now, f).collect()] == ["b"]


def test_ledger(spark):
    schema = "ledger_id int, sequence int, revision int, kind string"
    good = [(1, 1, 1, "assertion_added"), (1, 2, 1, "batch_committed"), (1, 3, 2, "evidence_added"), (1, 4, 2, "batch_committed")]
    assert ledger.sequence_violations(spark.createDataFrame(good, schema)).count() == 0
    bad = [good[0], (1, 3, 3, "evidence_added"), (1, 4, 2, "batch_committed")]
    assert {r.rule for r in ledger.sequence_violations(spark.createDataFrame(bad, schema)).collect()} == {"gap", "revision_skips", "revision_falls", "commit_not_last"}
    s = spark.createDataFrame([(1, 0, "d0", None), (1, 1, "d1", "d0"), (1, 3, "d3", "d1"), (2, 1, "x", None)], "ledger_id int, revision int, digest string, parent_digest string")
    assert {(r.ledger_id, r.rule) for r in ledger.chain_violations(s).collect()} == {(1, "revision"), (2, "genesis")}
    e = spark.createDataFrame([("a", "accepted", 1_000_000), ("b", "provisional", 500_001), ("c", "accepted", 1)], "assertion_id string, status string, weight_ppm int")
    assert {r.assertion_id for r in ledger.weight_violations(e).collect()} == {"b", "c"}
    r = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "z")], "src string, dst string")
    assert ledger.endpoint_violations(r, e.select("assertion_id")).count() == 2
    assert ledger.lost_rows(e, e.filter("assertion_id <> 'b'"), ["assertion_id"]).count() == 1


def test_object_digest_ignores_key_order(spark):
    d = spark.createDataFrame([('{"b": 1, "a": [1, 2]}',), ('{"a":[1,2],"b":1}',), (None,)], "x string").select(canonical.object_digest()("x").alias("d"))
    a, b, c = (r.d for r in d.collect())
    assert a == b and c is None


def test_attempts(spark):
    d = reporting.attempts(spark.createDataFrame([(1, 5), (1, 2), (2, 1)], "c int, t int"), ["c"], "t")
    assert sorted((r.c, r.t, r.attempt, r.is_last) for r in d.collect()) == [(1, 2, 1, False), (1, 5, 2, True), (2, 1, 1, True)]


def test_keys_compose_their_texts(spark):
    """The micro sign, full-width letters and ligatures split no identity, and doses are found in them."""
    def ids(value, name, statement):
        p = packet()
        u = p["research_questions"][0]["study_units"][0]
        u["results"][0]["value_raw_text"], u["name"], u["claims"][0]["statement"] = value, name, statement
        k = canonical.unit_keys(table(spark, p))
        r = canonical.result_keys(k)
        return [d.first().canonical_id for d in (k, r, canonical.claim_keys(k, r))]

    assert ids("5 µg daily", "ﬁrst trial", "ＡＢＣ") == ids("5 μg daily", "first trial", "abc") == ids("5 ug daily", "First Trial", "abc")


def test_plans_name_their_members(spark):
    from evidentia.operators import canonical_plan as C

    p = packet()
    u = p["research_questions"][0]["study_units"][0]
    u["results"].append(u["results"][0] | {"result_id": "R2"})
    u["claims"].append(u["claims"][0] | {"claim_id": "C2", "inference_basis_ids": ["R2"]})
    d = table(spark, p)
    planned = C.plan(d).cache()
    assert sorted((r.entity_type, [m.source_entity_id for m in sorted(r.members, key=lambda m: m.source_entity_id)], r.representative.source_entity_id) for r in planned.collect()) == [("claim", ["C1", "C2"], "C1"), ("result", ["R1", "R2"], "R1"), ("study_unit", ["U1"], "U1")]
    assert C.input_violations(d).count() == 0 and C.plan_violations(d, planned).count() == 0
    u["results"][1]["unit"] = "mm"
    assert {(r.rule, r.entity_id) for r in C.plan_violations(table(spark, p), planned).collect()} >= {("member_changed", "R2"), ("entity_unplanned", "R2")}
    done = merging.canonicalize(d)
    assert C.output_violations(done).count() == 0 and {r.rule for r in C.output_violations(d).collect()} == {"unit_id_not_canonical", "result_id_not_canonical", "claim_id_not_canonical"}
    u["results"][1]["result_id"], u["claims"][0]["inference_basis_ids"] = "R1", ["R9"]
    assert {(r.rule, r.entity_id) for r in C.input_violations(table(spark, p)).collect()} == {("result_id_repeats", "R1"), ("basis_outside_unit", "C1"), ("basis_outside_unit", "C2")}


def test_equal_reasons_are_one_decision(spark):
    m = [{"surviving_id": "a", "merged_ids": ["c", "b"], "reason": r} for r in ('{"x": 1, "a": 2}', '{"a":2,"x":1}', "plain")]
    got = merging.canonicalize(table(spark, packet(merge_decisions=m))).first().merge_decisions
    assert [(x.merged_ids, x.reason) for x in got] == [(["b", "c"], "plain"), (["b", "c"], '{"a":2,"x":1}')]


def test_signatures_and_pointers(spark):
    d = spark.createDataFrame([("At E14.5, not >= 5 µg of p53-ko",)], "t string")
    s = d.select(canonical.signature(F.col("t")).alias("s")).first().s
    assert s.normalized_text == "at e14.5 not >= 5 ug of p53-ko" and s.tokens == ["at", "e14.5", "not", ">=", "5", "ug", "of", "p53", "-", "ko"]
    assert s.protected_conditions == ["development_stage:e14.5", "development_stage:p53", "dose:5 ug", "negation:not", "perturbation:p53-ko"]
    q = spark.createDataFrame([(prov() | {"text_excerpt": "One, two"},)], "p struct<chunk_id:string,page_start:int,page_end:int,text_excerpt:string,paraphrased:boolean>")
    r = q.select(canonical.pointer(F.col("p")).alias("p")).first().p
    assert r.excerpt_sha256 == hashlib.sha256(b"one two").hexdigest() and r.chunk_id == prov()["chunk_id"]


def test_merging_keeps_everything_and_settles(spark):
    p = packet()
    u = p["research_questions"][0]["study_units"][0]
    r = u["results"][0]
    u["results"] = [r, r | {"result_id": "R2", "value_raw_text": " 1 ", "provenance": prov("c2", retold=True)}, r | {"result_id": "R3", "value_raw_text": "2"}]
    u["claims"].append(u["claims"][0] | {"claim_id": "C2", "inference_basis_ids": ["R2"], "provenance": prov("c3")})
    twin = json.loads(json.dumps(u)) | {"unit_id": "U2", "experiments_or_tasks": [" measure "]}
    p["research_questions"][0]["study_units"].append(twin)
    once = merging.canonicalize(table(spark, p)).first()
    (unit,) = once.research_questions[0].study_units
    assert len(unit.results) == 2 and len(unit.claims) == 1 and sorted(unit.experiments_or_tasks) == [" measure ", "measure"]
    first = next(x for x in unit.results if x.value_raw_text.strip() == "1")
    assert [q.chunk_id for q in (first.provenance, *first.additional_provenance)] == ["c1", "c2"] and unit.claims[0].inference_basis_ids == [first.result_id]
    assert {len(m.merged_ids) for m in once.merge_decisions} == {1, 2} and len(once.merge_decisions) == 4
    again = merging.canonicalize(merging.canonicalize(table(spark, p))).first()
    assert again.research_questions == once.research_questions and again.merge_decisions == once.merge_decisions
    p["research_questions"][0]["study_units"].reverse()
    u["results"].reverse()
    assert merging.canonicalize(table(spark, p)).first().research_questions == once.research_questions
    bare = merging.canonicalize(table(spark, packet(research_questions=[]))).first()
    assert bare.research_questions == [] and bare.merge_decisions == []


def test_merging_within_rows_shuffles_and_stores_nothing(spark):
    """Ids are those of the plan, which takes packets apart; texts and numbers that only Python writes alike are among them."""
    from evidentia.operators import canonical_plan as C
    from evidentia.sources import shared

    p = packet(paper_id='a"\x1f\\')
    u = p["research_questions"][0]["study_units"][0]
    r = u["results"][0]
    u["results"] = [r, r | {"result_id": "R2", "value_raw_text": "５ µg", "p_value": 1.5e-8}, r | {"result_id": "R3", "value_raw_text": "5 ug", "p_value": 1.5e-8, "provenance": prov("c2", retold=True)}, r | {"result_id": "R4", "quantitative_value": 0.125, "unit": "hours"}]
    u["claims"].append(u["claims"][0] | {"claim_id": "C2", "inference_basis_ids": ["R2", "R3"], "polarity": "neutral", "statement": "Not ﬁrst, no change"})
    d = table(spark, p)
    before = len(shared._written)
    done = merging.canonicalize(d)
    assert len(shared._written) == before and "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    row, planned = done.first(), C.plan(d).collect()
    units = row.research_questions[0].study_units
    assert sorted(x.canonical_id for x in planned) == sorted([u.unit_id for u in units] + [x.result_id for u in units for x in u.results] + [x.claim_id for u in units for x in u.claims])
    (m,) = row.merge_decisions
    digest = next(x.digest for x in planned if x.canonical_id == m.surviving_id)
    assert m.merged_ids == ["R2", "R3"] and m.reason == json.dumps(json.loads(m.reason), ensure_ascii=False, sort_keys=True, separators=(",", ":")) and json.loads(m.reason)["canonical_key_digest"] == digest


def test_unknown_basis_stops_the_merge(spark):
    p = packet()
    p["research_questions"][0]["study_units"][0]["claims"][0]["inference_basis_ids"] = ["R9"]
    with pytest.raises(Exception, match="unknown basis"):
        merging.canonicalize(table(spark, p)).collect()


def test_missing_rescue_is_noted_once(spark):
    d = spark.createDataFrame([("causal_validation", "x", ["b"]), ("causal_validation", "a Rescue", []), ("contrastive", "x", []), ("causal_validation", "x", [merging.NO_RESCUE])], "m string, t string, b array<string>")
    assert [len(r[0]) for r in d.select(merging.note_missing_rescue(F.col("b"), F.col("m"), F.col("t"))).collect()] == [2, 0, 0, 1]


def test_complete_link_of_a_large_part_takes_quadratic_time():
    import time

    v = np.random.default_rng(0).normal(size=(2500, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    score = np.maximum(0, np.round(v @ v.T * 1e6)).astype(np.int64)
    began = time.time()
    found = clusters.merge_complete([f"{i:04}" for i in range(2500)], score, 200_000)
    assert time.time() - began < 15  # with a search of the whole matrix for every merge: over half a minute
    for c in found:
        at = [int(k) for k in c]
        assert (score[np.ix_(at, at)] >= 200_000).all()
    assert sorted(k for c in found for k in c) == [f"{i:04}" for i in range(2500)]


def test_complete_link_by_parts_equals_whole_blocks(spark):
    import random

    import numpy as np

    random.seed(6)
    items, pairs, want = [], [], set()
    for block in range(4):
        keys = [f"k{i:02d}" for i in range(25)]
        score = np.zeros((25, 25), int)
        for i in range(25):
            for j in range(i + 1, 25):
                if random.random() < 0.25:
                    score[i, j] = score[j, i] = random.choice((100, 500, 700, 900))
                    pairs.append((block, *((keys[i], keys[j]) if random.random() < 0.5 else (keys[j], keys[i])), int(score[i, j])))
        items += [(block, k) for k in keys]
        want |= {(block, k, c[0]) for c in clusters.merge_complete(keys, score, 500) for k in c}
    d = clusters.complete_link(spark.createDataFrame(items, "block int, key string"), spark.createDataFrame(pairs, "block int, a string, b string, score_ppm int"), 500)
    assert set(map(tuple, d.collect())) == want and len({c for _, _, c in want}) < 25
