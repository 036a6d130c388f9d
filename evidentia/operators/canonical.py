"""Canonical identities: keys from content, groups of equal keys, merges with an audit.

Two entities are one if they are of a kind, in a scope, and equal in every component of
their key; equality is transitive, so grouping by digest is clustering.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from evidentia.functions.conditions import conditions, unit_name
from evidentia.functions.text import canonical_json, composed, decimal_text, json_text, scientific, tokens
from evidentia.operators.packets import unit_rows

#: Names of canonical ids and length of their digests (fixed values).
PREFIX = {"study_unit": "su", "result": "res", "claim": "clm"}
DIGITS = 24


def digest(namespace: str = "paper-local", version: str = "1"):
    """A UDF: digest of a canonical key from (kind, paper_id, scope, components map)."""

    @F.pandas_udf(StringType())
    def run(kind: pd.Series, paper: pd.Series, scope: pd.Series, components: pd.Series) -> pd.Series:
        out = []
        for k, p, s, c in zip(kind, paper, scope, components, strict=True):
            pairs = c.items() if isinstance(c, dict) else c
            parts = [{"name": n, "values": sorted({v for v in vs if v})} for n, vs in sorted(pairs)]
            payload = {"components": [x for x in parts if x["values"]], "entity_type": k, "namespace": namespace, "normalization_version": version, "paper_id": p, "scope_digest": s}
            if not payload["components"]:
                raise ValueError("a canonical key needs a component")
            out.append(hashlib.sha256(json_text(payload).encode()).hexdigest())
        return pd.Series(out)

    return run


@F.pandas_udf(StringType())
def number(c: pd.Series) -> pd.Series:
    return c.map(lambda x: "not_reported" if pd.isna(x) else decimal_text(x))


def object_digest():
    """A UDF: sha256 of JSON text, keys sorted and compact."""

    @F.pandas_udf(StringType())
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda x: hashlib.sha256(json_text(json.loads(x)).encode()).hexdigest(), na_action="ignore")

    return run


def _named(**components: Column) -> Column:
    return F.create_map(*(x for n, c in components.items() for x in (F.lit(n), c)))


def _keyed(d: DataFrame, kind: str, scope: Column, components: Column) -> DataFrame:
    d = d.withColumn("entity_type", F.lit(kind)).withColumn("scope_digest", scope)
    d = d.withColumn("digest", digest()("entity_type", "paper_id", "scope_digest", components))
    return d.withColumn("canonical_id", F.concat(F.lit(f"{PREFIX[kind]}_"), F.substring("digest", 1, DIGITS)))


def signature(text: Column) -> Column:
    """normal, tokens and conditions of a scientific text: a struct."""
    normal = scientific(text)
    return F.struct(normal.alias("normalized_text"), tokens(normal).alias("tokens"), conditions(normal).alias("protected_conditions"))


def pointer(provenance: Column) -> Column:
    """Where a provenance points: chunk, pages, digest of the normalised excerpt, and whether it is retold.

    For a column of its own, not inside arrays: the excerpt's composition runs in Python.
    """
    excerpt = F.sha2(scientific(provenance["text_excerpt"]), 256)
    return F.struct(provenance["chunk_id"].alias("chunk_id"), provenance["page_start"].alias("page_start"), provenance["page_end"].alias("page_end"), excerpt.alias("excerpt_sha256"), provenance["paraphrased"].alias("paraphrased"))


def _members(field: str) -> Column:
    """Members of a list of a unit beside their composed forms, exploded as at, m (e, n)."""
    return F.posexplode(F.transform(f"unit.{field}", lambda e, i: F.struct(e.alias("e"), F.get(f"norm.{field}", i).alias("n")))).alias("at", "m")


def unit_keys(packets: DataFrame) -> DataFrame:
    """Unit rows with norm (the unit, its texts composed), digest and canonical_id: question, names, tasks, methods, datasets, metrics, conditions."""
    u = unit_rows(packets)
    u = u.withColumns({"norm": composed(u, "unit"), "asked": scientific(F.col("statement"))})
    each = lambda field, f: F.transform(F.col(f"norm.{field}"), f)
    pair = lambda a, b: lambda x: F.concat_ws(" | ", F.nullif(scientific(x[a], False), F.lit("")), F.nullif(scientific(F.coalesce(x[b], F.lit("")), False), F.lit("")))
    words = F.concat(
        F.array("norm.name"), F.col("norm.experiments_or_tasks"), each("methods", lambda m: m["name"]), each("methods", lambda m: m["protocol_description"]), each("datasets", lambda x: x["name"]),
        each("datasets", lambda x: F.coalesce(x["version_or_split"], F.lit(""))),
    )
    parts = _named(
        dataset=each("datasets", pair("name", "version_or_split")), method=each("methods", pair("name", "protocol_description")), name=F.array(scientific(F.col("norm.name"), False)),
        protected_condition=conditions(scientific(F.array_join(words, " "), False)), result_metric=each("results", lambda r: scientific(r["metric_name"], False)),
        task=each("experiments_or_tasks", lambda t: scientific(t, False)),
    )
    scope = F.sha2(F.concat_ws("\u0000", "question_id", "asked"), 256)
    return _keyed(u, "study_unit", scope, parts).drop("asked")


_OF_UNIT = ("paper_id", "question_id", "question_at", "unit_at")


def result_keys(units: DataFrame) -> DataFrame:
    """Result rows of keyed units: metric, raw text, numbers, unit and conditions."""
    r = units.select(*_OF_UNIT, F.col("unit.unit_id").alias("unit_id"), F.col("digest").alias("unit_digest"), _members("results")).select("*", "m.*").drop("m")
    shown = scientific(F.concat_ws(" ", F.col("n.metric_name"), F.col("n.value_raw_text"), F.coalesce("n.unit", F.lit(""))), False)
    parts = _named(
        metric=F.array(scientific(F.col("n.metric_name"), False)), observation=F.array(scientific(F.col("n.value_raw_text"), False)), p_value=F.array(number("e.p_value")), protected_condition=conditions(shown),
        quantitative_value=F.array(number("e.quantitative_value")), sample_size=F.array(F.coalesce(F.col("e.n_sample_size").cast("string"), F.lit("not_reported"))),
        unit=F.array(unit_name(scientific(F.coalesce("n.unit", F.lit("")), False))),
    )
    return _keyed(r, "result", F.col("unit_digest"), parts)


def claim_keys(units: DataFrame, results: DataFrame) -> DataFrame:
    """Claim rows of keyed units: polarity, proposition, conditions, and canonical ids of the results they rest on.

    A basis that no result of the unit has raises an error in the row's task.
    """
    c = units.select(*_OF_UNIT, F.col("unit.unit_id").alias("unit_id"), F.col("digest").alias("unit_digest"), _members("claims")).select("*", "m.*").drop("m")
    key = ["paper_id", "question_at", "unit_at"]
    known = results.groupBy(*key).agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct(F.col("e.result_id"), F.col("canonical_id"))))).alias("ids"))
    c = c.join(known, key, "left")
    lookup = lambda b: F.coalesce(F.try_element_at("ids", b), F.raise_error(F.concat(F.lit("unknown basis "), b)).cast("string"))
    c = c.withColumn("basis", F.transform("e.inference_basis_ids", lookup))
    words = scientific(F.col("n.statement"), False)
    parts = _named(
        basis=F.when(F.size("basis") == 0, F.array(F.lit("no_result_basis"))).otherwise(F.col("basis")), polarity=F.array("e.polarity"), proposition=F.array(words), protected_condition=conditions(words),
    )
    return _keyed(c, "claim", F.col("unit_digest"), parts).drop("ids")


def representatives(rows: DataFrame, by: list[str], order: list[Column], value: str) -> DataFrame:
    """The value of each group that comes first by ``order``; partial minima, no sort of groups."""
    key = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order)))
    return rows.groupBy(*by).agg(F.min_by(value, key).alias("surviving"), F.count("*").alias("n"))


def merge_decisions(rows: DataFrame, by: list[str], order: list[Column], value: str) -> DataFrame:
    """(by, surviving, merged): groups of several, their first by ``order`` and the sorted others."""
    best = representatives(rows, by, order, value).filter("n > 1").select(*(F.col(c).alias(f"__{c}") for c in by), "surviving")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    rest = rows.join(best, same).filter(F.col(value) != F.col("surviving"))
    return rest.groupBy(*by, "surviving").agg(F.array_sort(F.collect_set(value)).alias("merged"))


def standing(filled: Column, words: Column, own_id: str, provenance: bool = True) -> Column:
    """What sorts entities ``e``: quoted provenance first, then most filled fields, then the longest text, then JSON without ids and provenance, then the id.

    ``words`` is composed already.
    """
    prov = F.concat(F.array("e.provenance"), F.coalesce("e.additional_provenance", F.array())) if provenance else None
    retold = F.forall(prov, lambda p: p["paraphrased"]).cast("int") if provenance else F.lit(0)
    rest = F.col("e").dropFields(own_id, "provenance", "additional_provenance") if provenance else F.col("e").dropFields(own_id)
    told = canonical_json(F.to_json(rest, {"ignoreNullFields": "false"}))
    return F.struct(retold.alias("a"), (-filled).alias("b"), (-F.length(scientific(words, False))).alias("c"), told.alias("d"), F.col(f"e.{own_id}").alias("i"))


def result_standing() -> Column:
    filled = sum((F.when(F.col(f"e.{c}").isNotNull(), 1).otherwise(0) for c in ("quantitative_value", "unit", "p_value", "n_sample_size")), F.lit(0))
    return standing(filled, F.col("n.value_raw_text"), "result_id")


def claim_standing() -> Column:
    return standing(F.size(F.array_distinct("e.inference_basis_ids")), F.col("n.statement"), "claim_id")


def canonical_results(packets: DataFrame) -> DataFrame:
    """(paper_id, canonical_id, source_ids, representative): results by canonical identity."""
    r = result_keys(unit_keys(packets)).withColumn("standing", result_standing())
    return r.groupBy("paper_id", "canonical_id").agg(F.array_sort(F.collect_set("e.result_id")).alias("source_ids"), F.min_by("e", "standing").alias("representative"))
