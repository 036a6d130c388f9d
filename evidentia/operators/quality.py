"""Rule quality of packets, and precision, recall and F1 of judged ones; all within a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.text import collapse, fold, let, ratio4
from evidentia.operators.packets import evidence_entities, of_units, units

#: Weights of the components and the length of a substantial boundary (fixed values).
WEIGHTS = {"structural_completeness": 0.50, "provenance_coverage": 0.35, "boundary_richness": 0.15}
SUBSTANTIAL = 40
_NONE = lambda: F.array().cast("array<string>")


def _warnings(*found: tuple[str, Column | None, Column]) -> Column:
    """(code, entity_ids) of those that apply: (code, ids, when)."""
    each = [F.when(when, F.struct(F.lit(code).alias("code"), (F.array_sort(F.array_distinct(ids)) if ids is not None else _NONE()).alias("entity_ids"))) for code, ids, when in found]
    return F.filter(F.array(*each), lambda w: w.isNotNull())


def _listed(code: str, ids: Column) -> tuple[str, Column, Column]:
    return code, ids, F.size(ids) > 0


def _ids(values: Column, name: str, keep) -> Column:
    return F.transform(F.filter(values, keep), lambda v: v[name])


def _component(name: str, passed: Column, total: Column, warnings: Column) -> Column:
    ratio = F.bround(passed / total, 6)
    return F.struct(
        F.lit(name).alias("name"), passed.cast("int").alias("passed"), total.cast("int").alias("total"), ratio.alias("ratio"), F.bround(ratio * WEIGHTS[name], 6).alias("weighted"), warnings.alias("warnings")
    )


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def structure(questions: Column) -> Column:
    def of(q: Column, u: Column) -> Column:
        r, c = of_units(u, "results"), of_units(u, "claims")
        size = F.size
        none = lambda field: lambda x: F.size(F.coalesce(x[field], F.array())) == 0
        idle = _ids(q, "question_id", none("study_units"))
        no_tasks = _ids(u, "unit_id", lambda x: ~F.exists(F.coalesce(x["experiments_or_tasks"], _NONE()), lambda t: ~_blank(t)))
        no_results = _ids(u, "unit_id", none("results"))
        no_claims = _ids(u, "unit_id", none("claims"))
        no_metric, no_value = _ids(r, "result_id", lambda x: _blank(x["metric_name"])), _ids(r, "result_id", lambda x: _blank(x["value_raw_text"]))
        no_basis = _ids(c, "claim_id", none("inference_basis_ids"))

        def invalid(x: Column) -> Column:
            known = F.transform(F.coalesce(x["results"], F.array()), lambda y: y["result_id"])
            b = lambda y: F.coalesce(y["inference_basis_ids"], _NONE())
            return _ids(F.coalesce(x["claims"], F.array()), "claim_id", lambda y: (F.size(b(y)) > 0) & ((F.size(F.array_distinct(b(y))) < F.size(b(y))) | (F.size(F.array_except(b(y), known)) > 0)))

        bad_basis = F.flatten(F.transform(u, invalid))
        lists = [idle, no_tasks, no_results, no_claims, no_metric, no_value, no_basis, bad_basis]
        total = 1 + size(q) + 3 * size(u) + 2 * size(r) + 2 * size(c)
        lost = sum((size(x) for x in lists), F.lit(0)) + size(no_basis)  # a claim without basis fails both its checks
        passed = total - lost - F.when(size(q) == 0, 1).otherwise(0)
        codes = ("empty_research_questions", "units_without_tasks", "units_without_results", "units_without_claims", "results_without_metrics", "results_without_values", "claims_without_evidence", "claims_with_invalid_evidence")
        warnings = _warnings(("structure.no_research_questions", None, size(q) == 0), *(_listed(f"structure.{n}", x) for n, x in zip(codes, lists, strict=True)))
        return _component("structural_completeness", passed, total, warnings)

    return let(F.coalesce(questions, F.array()), lambda q: let(units(q), lambda u: of(q, u)))


def provenance(questions: Column, ledger: Column) -> Column:
    usable = lambda p: ~_blank(p["chunk_id"]) & ~_blank(p["text_excerpt"]) & (p["page_start"] >= 1) & (p["page_end"] >= p["page_start"])
    with_status = lambda s: F.map_keys(F.map_filter(ledger, lambda _, v: v == s))

    def of(entities: Column, extracted: Column) -> Column:
        good = lambda e: F.filter(e["provenances"], usable)
        sound = lambda e: (F.size(good(e)) > 0) & (F.size(good(e)) == F.size(e["provenances"]))
        exact = lambda e: F.exists(good(e), lambda p: ~p["paraphrased"])
        tracked = lambda e: (F.size(good(e)) > 0) & F.forall(good(e), lambda p: F.array_contains(extracted, p["chunk_id"]))
        some = lambda e: F.size(good(e)) > 0
        cited = F.flatten(F.transform(F.filter(entities, sound), lambda e: F.transform(e["provenances"], lambda p: p["chunk_id"])))
        missing, retold = _ids(entities, "entity_id", lambda e: ~sound(e)), _ids(entities, "entity_id", lambda e: some(e) & ~exact(e))
        untracked = _ids(entities, "entity_id", lambda e: some(e) & ~tracked(e))
        unused = F.array_except(extracted, cited)
        audited = F.size(F.map_filter(ledger, lambda _, v: v.isin("extracted", "irrelevant")))
        count = lambda t: F.when(t, 1).otherwise(0)
        passed = count(F.size(extracted) > 0) + audited + F.size(F.filter(entities, sound)) + F.size(F.filter(entities, tracked)) + F.size(extracted) - F.size(unused) + count(F.exists(entities, exact))
        total = 2 + F.size(ledger) + 2 * F.size(entities) + F.size(extracted)
        warnings = _warnings(
            ("coverage.missing_ledger", None, F.size(ledger) == 0),
            ("coverage.no_extracted_chunks", None, (F.size(ledger) > 0) & (F.size(extracted) == 0)),
            ("provenance.no_evidence_entities", None, F.size(entities) == 0),
            _listed("provenance.missing", missing),
            _listed("provenance.paraphrased_only", retold),
            _listed("provenance.untracked_chunks", untracked),
            _listed("coverage.failed_chunks", with_status("failed")),
            _listed("coverage.not_selected_chunks", with_status("not_selected")),
            _listed("coverage.unused_extracted_chunks", unused),
        )
        return _component("provenance_coverage", passed, total, warnings)

    return let(evidence_entities(questions), lambda e: let(with_status("extracted"), lambda x: of(e, x)))


def boundaries(values: Column) -> Column:
    def of(all_: Column) -> Column:
        blank = F.size(F.filter(all_, _blank))

        def rest(kept: Column) -> Column:
            n, unique = F.size(kept), F.size(F.array_distinct(F.transform(kept, fold)))
            shallow = F.exists(kept, lambda b: F.length(b) < SUBSTANTIAL)
            checks = [n > 0, unique >= 3, (n > 0) & (unique == n), (n > 0) & ~shallow, blank == 0]
            passed = sum((F.when(c, 1).otherwise(0) for c in checks), F.lit(0))
            warnings = _warnings(
                ("boundaries.none", None, n == 0), ("boundaries.too_few", None, (n > 0) & (unique < 3)), ("boundaries.duplicates", None, (n > 0) & (unique != n)), ("boundaries.shallow", None, shallow), ("boundaries.blank", None, blank > 0)
            )
            return _component("boundary_richness", passed, F.lit(5), warnings)

        return let(F.transform(F.filter(all_, lambda b: ~_blank(b)), collapse), rest)

    return let(F.coalesce(values, F.array()), of)


def rule_quality(packets: DataFrame) -> DataFrame:
    """paper_id, score, components, warnings of packets."""
    parts = F.array(structure(F.col("research_questions")), provenance(F.col("research_questions"), F.coalesce("coverage_ledger", F.create_map().cast("map<string,string>"))), boundaries(F.col("limitations_and_boundaries")))
    d = packets.select("paper_id", parts.alias("components"))
    score = F.bround(F.aggregate("components", F.lit(0.0), lambda a, c: a + c["weighted"]), 4)
    return d.select("paper_id", score.alias("score"), "components", F.flatten(F.transform("components", lambda c: c["warnings"])).alias("warnings"))


def prf(extracted: Column, incorrect: Column, missed: Column) -> dict[str, Column]:
    """Precision, recall and F1 to 4 places; nothing extracted or nothing to find counts as 1."""
    correct = extracted - incorrect
    p = F.when(extracted == 0, 1.0).otherwise(correct.cast("double") / extracted)
    r = F.when(correct + missed == 0, 1.0).otherwise(correct.cast("double") / (correct + missed))
    return {
        "correct_item_count": correct, "precision": ratio4(correct, extracted), "recall": ratio4(correct, correct + missed), "f1": F.bround(F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r)), 4),
    }


def score_violations(assessments: DataFrame) -> DataFrame:
    """Assessments whose stored precision, recall or F1 isn't what their counts give."""
    want = prf(F.col("extracted_item_count"), F.col("incorrect_item_count"), F.col("missed_core_item_count"))
    return assessments.filter(~(F.col("precision").eqNullSafe(want["precision"]) & F.col("recall").eqNullSafe(want["recall"]) & F.col("f1").eqNullSafe(want["f1"])))


def evidence_strength(results: DataFrame, by: str) -> DataFrame:
    """Of ``results`` (by, p_value, n_sample_size): shares with either, and the mean capped log size; null without results."""
    size = F.least(F.lit(1.0), F.log1p("n_sample_size") / F.log1p(F.lit(1000.0)))
    share = lambda c: F.bround(F.count(c).cast("double") / F.count("*"), 4)
    return results.groupBy(by).agg(share("p_value").alias("statistical_support_coverage"), share("n_sample_size").alias("sample_size_coverage"), F.bround(F.avg(size), 4).alias("sample_size_log_score"))
