"""Canonical keys within the row of a packet: those of ``canonical``, without taking packets apart.

Texts and numbers that built-in functions don't write as Python does are put beside the
packet by ``composed_texts``; packets without such don't go to Python.
"""

from __future__ import annotations

import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from evidentia.functions.conditions import conditions, unit_name
from evidentia.functions.text import decimal_text, json_string, json_text, let, scientific_short, sorted_keys
from evidentia.operators.canonical import DIGITS, PREFIX

#: Packets' texts, composed, and their numbers in digits.
_RESULT = "struct<metric_name:string,value_raw_text:string,unit:string,quantitative_value:string,p_value:string>"
_UNIT = (
    "struct<name:string,experiments_or_tasks:array<string>,datasets:array<struct<name:string,version_or_split:string>>,methods:array<struct<name:string,protocol_description:string>>,"
    f"results:array<{_RESULT}>,claims:array<struct<statement:string>>,told:string>"
)
COMPOSED = f"array<struct<statement:string,study_units:array<{_UNIT}>>>"
_EMPTY = lambda c: F.coalesce(c, F.array())
_NONE = "not_reported"


def _composed(x: object) -> object:
    if isinstance(x, str):
        return unicodedata.normalize("NFKC", x)
    return [_composed(v) for v in x] if isinstance(x, list) else x


def _texts(x: dict, *names: str) -> dict:
    return {n: _composed(x[n]) for n in names}


def _digits(x: float | str | None) -> str:
    return _NONE if x is None or x == "NaN" else decimal_text(x)


def _unit_texts(u: dict) -> dict:
    each = lambda field, *names: u[field] and [x and _texts(x, *names) for x in u[field]]
    results = each("results", "metric_name", "value_raw_text", "unit")
    for r, x in zip(results or [], u["results"] or [], strict=True):
        if r:
            r |= {n: _digits(x[n]) for n in ("quantitative_value", "p_value")}
    lists = {"datasets": each("datasets", "name", "version_or_split"), "methods": each("methods", "name", "protocol_description"), "results": results, "claims": each("claims", "statement")}
    return _texts(u, "name", "experiments_or_tasks") | lists | {"told": json_text({k: v for k, v in u.items() if k != "unit_id"})}


@F.pandas_udf(StringType())
def _compose(text: pd.Series) -> pd.Series:
    def run(x: str) -> str:
        return json.dumps([q and {"statement": _composed(q["statement"]), "study_units": q["study_units"] and [u and _unit_texts(u) for u in q["study_units"]]} for q in json.loads(x)], ensure_ascii=False)

    return text.map(run, na_action="ignore")


def _wide(*texts: Column) -> Column:
    return let(F.concat_ws("", *texts), lambda t: F.octet_length(t) != F.length(t))


def _plain(x: Column) -> Column:
    """Whether a number is one of 15 digits at most that all write alike."""
    return x.isNull() | ((F.abs(x) < 1_000_000) & (x.cast("decimal(15,8)").cast("double") == x) & ((x == 0) | (F.abs(x) >= 0.001)))


def composed_texts(questions: str) -> Column:
    """COMPOSED of packets that have texts beyond ASCII or numbers that aren't plain; null for the others."""
    odd_result = lambda r: _wide(r["metric_name"], r["value_raw_text"], r["unit"]) | ~_plain(r["quantitative_value"]) | ~_plain(r["p_value"])
    some = lambda c, f: F.exists(_EMPTY(c), lambda x: F.coalesce(f(x), F.lit(True)))
    odd_unit = lambda u: (
        _wide(u["name"], F.concat_ws("", u["experiments_or_tasks"]))
        | some(u["datasets"], lambda x: _wide(x["name"], x["version_or_split"]))
        | some(u["methods"], lambda x: _wide(x["name"], x["protocol_description"]))
        | some(u["results"], odd_result)
        | some(u["claims"], lambda x: _wide(x["statement"]))
    )
    odd = some(F.col(questions), lambda q: _wide(q["statement"]) | some(q["study_units"], odd_unit))
    return F.from_json(_compose(F.when(odd, F.to_json(questions, {"ignoreNullFields": "false"}))), COMPOSED)


def _digits_of(e: Column, n: Column, field: str) -> Column:
    x = e[field].cast("decimal(15,8)").cast("string")
    usual = F.when(e[field].isNull(), _NONE).when(e[field] == 0, "0").otherwise(F.regexp_replace(x, r"\.?0+$", ""))
    return F.coalesce(n[field], usual)


def _one(name: str, value: Column) -> Column:
    """A component of one value, which has no marks to escape; null if it is empty."""
    return F.when(value != "", F.concat(F.lit(f'{{"name":"{name}","values":["'), value, F.lit('"]}')))


def _many(name: str, values: Column) -> Column:
    joined = F.array_join(F.array_sort(F.array_distinct(F.filter(values, lambda v: v != ""))), '","')
    return let(joined, lambda j: _one(name, j))


def _digest(kind: str, paper: Column, scope: Column, *parts: Column) -> Column:
    head = F.concat_ws(",", *parts)
    if kind == "study_unit":  # others always have a component
        head = let(head, lambda h: F.when(h == "", F.raise_error(F.lit("a canonical key needs a component")).cast("string")).otherwise(h))
    tail = f'],"entity_type":"{kind}","namespace":"paper-local","normalization_version":"1","paper_id":'
    return F.sha2(F.concat(F.lit('{"components":['), head, F.lit(tail), paper, F.lit(',"scope_digest":"'), scope, F.lit('"}')), 256)


def _id(kind: str, digest: Column) -> Column:
    return F.concat(F.lit(f"{PREFIX[kind]}_"), F.substring(digest, 1, DIGITS))


def question_scope(q: Column, n: Column) -> Column:
    asked = scientific_short(F.coalesce(n["statement"], q["statement"]))
    return F.sha2(F.concat_ws("\u0000", q["question_id"], asked), 256)


def _result_texts(e: Column, n: Column) -> Column:
    text = lambda f: scientific_short(F.coalesce(n[f], e[f]))
    return F.struct(
        e.alias("e"), text("metric_name").alias("metric"), text("value_raw_text").alias("value"), F.coalesce(text("unit"), F.lit("")).alias("unit"),
        _digits_of(e, n, "quantitative_value").alias("q"), _digits_of(e, n, "p_value").alias("p"),
    )


def _keyed_result(paper: Column, unit_digest: Column, t: Column) -> Column:
    """id, digest, at, e, value of a result with its texts."""
    shown = F.concat_ws(" ", *(F.nullif(t[c], F.lit("")) for c in ("metric", "value", "unit")))
    digest = _digest(
        "result", paper, unit_digest, _one("metric", t["metric"]), _one("observation", t["value"]), _one("p_value", t["p"]), _many("protected_condition", conditions(shown)), _one("quantitative_value", t["q"]),
        _one("sample_size", F.coalesce(t["e"]["n_sample_size"].cast("string"), F.lit(_NONE))), _one("unit", unit_name(t["unit"])),
    )
    return let(digest, lambda g: F.struct(_id("result", g).alias("id"), g.alias("digest"), t["e"].alias("e"), t["value"].alias("value")))


def _keyed_claim(paper: Column, unit_digest: Column, e: Column, n: Column, ids: Column) -> Column:
    """id, digest, e, value, basis of a claim; a basis that no result of the unit has raises an error."""
    found = lambda b: F.coalesce(F.try_element_at(ids, b), F.raise_error(F.concat(F.lit("unknown basis "), b)).cast("string"))

    def of(words: Column, basis: Column) -> Column:
        said = F.when(e["polarity"] != "", F.concat(F.lit('{"name":"polarity","values":['), json_string(e["polarity"]), F.lit("]}")))
        rests = F.when(F.size(basis) == 0, _one("basis", F.lit("no_result_basis"))).otherwise(_many("basis", basis))
        digest = _digest("claim", paper, unit_digest, rests, said, _one("proposition", words), _many("protected_condition", conditions(words)))
        return let(digest, lambda g: F.struct(_id("claim", g).alias("id"), g.alias("digest"), e.alias("e"), words.alias("value"), basis.alias("basis")))

    words = scientific_short(F.coalesce(n["statement"], e["statement"]))
    return let(words, lambda w: let(F.transform(e["inference_basis_ids"], found), lambda b: of(w, b)))


def _unit_digest(paper: Column, scope: Column, u: Column, n: Column, texts: Column) -> Column:
    each = lambda field, f: F.transform(_EMPTY(u[field]), lambda e, i: f(e, F.get(n[field], i)))
    text = lambda f: lambda e, m: F.coalesce(m[f], e[f])
    pair = lambda a, b: lambda e, m: F.concat_ws(" | ", *(F.nullif(scientific_short(text(f)(e, m)), F.lit("")) for f in (a, b)))
    task = lambda e, m: F.coalesce(m, e)
    name = F.coalesce(n["name"], u["name"])
    words = F.concat(F.array(name), each("experiments_or_tasks", task), each("methods", text("name")), each("methods", text("protocol_description")), each("datasets", text("name")), each("datasets", lambda e, m: F.coalesce(text("version_or_split")(e, m), F.lit(""))))
    return _digest(
        "study_unit", paper, scope, _many("dataset", each("datasets", pair("name", "version_or_split"))), _many("method", each("methods", pair("name", "protocol_description"))), _one("name", scientific_short(name)),
        _many("protected_condition", conditions(scientific_short(F.array_join(words, " ")))), _many("result_metric", F.transform(texts, lambda t: t["metric"])), _many("task", each("experiments_or_tasks", lambda e, m: scientific_short(task(e, m)))),
    )


def keyed_units(paper: Column, scope: Column, q: Column, n: Column) -> Column:
    """(id, at, digest, e, told, value, results, claims) of the units of a question; ``n`` is its COMPOSED, ``paper`` the paper's id as JSON."""

    def unit(u: Column, at: Column) -> Column:
        def of(m: Column, texts: Column, digest: Column, results: Column) -> Column:
            pairs = F.array_distinct(F.transform(results, lambda r: F.struct(r["e"]["result_id"].alias("k"), r["id"].alias("v"))))
            claims = let(F.map_from_entries(pairs), lambda ids: F.transform(_EMPTY(u["claims"]), lambda e, i: _keyed_claim(paper, digest, e, F.get(m["claims"], i), ids)))
            return F.struct(_id("study_unit", digest).alias("id"), at.alias("at"), digest.alias("digest"), u.alias("e"), m["told"].alias("told"), F.coalesce(m["name"], u["name"]).alias("value"), results.alias("results"), claims.alias("claims"))

        def texts(m: Column) -> Column:
            return F.transform(_EMPTY(u["results"]), lambda e, i: _result_texts(e, F.get(m["results"], i)))

        keyed = lambda ts, g: F.transform(ts, lambda t: _keyed_result(paper, g, t))
        return let(F.get(n["study_units"], at), lambda m: let(texts(m), lambda ts: let(_unit_digest(paper, scope, u, m, ts), lambda g: let(keyed(ts, g), lambda rs: of(m, ts, g, rs)))))

    return F.transform(_EMPTY(q["study_units"]), unit)


def _standing(filled: Column, x: Column, words: Column, told: Column, own_id: str, retold: Column) -> Column:
    """As ``canonical.standing``."""
    return F.struct(retold.alias("a"), (-filled).alias("b"), (-F.length(words)).alias("c"), told.alias("d"), x["e"][own_id].alias("i"))


def _retold(e: Column) -> Column:
    return F.forall(F.concat(F.array(e["provenance"]), _EMPTY(e["additional_provenance"])), lambda p: p["paraphrased"]).cast("int")


def _told(e: Column, *fields: str) -> Column:
    return F.to_json(F.struct(*(e[f].alias(f) for f in sorted(fields))), {"ignoreNullFields": "false"})


def result_standing(x: Column) -> Column:
    own = ("quantitative_value", "unit", "p_value", "n_sample_size")
    filled = sum((F.when(x["e"][c].isNotNull(), 1).otherwise(0) for c in own), F.lit(0))
    return _standing(filled, x, x["value"], _told(x["e"], "metric_name", "value_raw_text", *own), "result_id", _retold(x["e"]))


def claim_standing(x: Column) -> Column:
    return _standing(F.size(F.array_distinct(x["e"]["inference_basis_ids"])), x, x["value"], _told(x["e"], "statement", "polarity", "inference_basis_ids"), "claim_id", _retold(x["e"]))


def unit_standing(x: Column, kind: StructType) -> Column:
    lists = ("experiments_or_tasks", "datasets", "methods", "results", "claims", "evidence_spans")
    filled = sum((F.size(_EMPTY(x["e"][f])) for f in lists), F.lit(0))
    rest = StructType([f for f in kind.fields if f.name != "unit_id"])
    told = F.coalesce(x["told"], F.to_json(sorted_keys(x["e"], rest), {"ignoreNullFields": "false"}))
    return _standing(filled, x, scientific_short(x["value"]), told, "unit_id", F.lit(0))
