"""Packets rewritten with canonical identities: equal entities merged, nothing they say lost, each merge recorded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evidentia.functions.text import canonical_jsons, collapse, fold, json_string, let, lower_escapes, scientific_short
from evidentia.operators import nested_keys as N
from evidentia.schemas import MERGE

#: What a causal argument's last rung is called, and what to note where it is missing.
RESCUE = ("rescue", "reconstitution", "reversal", "epistasis")
#: The note is the text that delivered packets are known by (fixed value).
NO_RESCUE = "The selected source chunks do not report a rescue, reconstitution, reversal, or epistasis experiment; that rung of the causal evidence chain remains untested within this extraction scope."


def provenance_union(lists: Column) -> Column:
    """Distinct provenance of several lists: quoted ones first, then by chunk, pages and digest of their JSON, keys sorted."""
    told = lambda p: F.sha2(F.to_json(F.struct(*(p[c].alias(c) for c in ("chunk_id", "page_end", "page_start", "paraphrased", "text_excerpt")))), 256)
    keyed = lambda ps: F.transform(ps, lambda p: F.struct(p["paraphrased"].alias("r"), p["chunk_id"].alias("c"), p["page_start"].alias("s"), p["page_end"].alias("e"), told(p).alias("t"), p.alias("p")))
    in_order = lambda ps: F.transform(F.array_sort(keyed(ps)), lambda x: x["p"])
    return let(F.array_distinct(F.flatten(lists)), lambda ps: F.when(F.size(ps) > 1, in_order(ps)).otherwise(ps))


def _union(lists: Column) -> Column:
    """Distinct structs of several lists, by their JSON."""
    keyed = F.transform(F.array_distinct(F.flatten(lists)), lambda x: F.struct(F.to_json(x).alias("j"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda y: y["x"])


def _groups(rows: Column) -> Column:
    """Structs as lists of those with one ``id``, in its order; one sort, then slices between the places where it changes."""

    def cut(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (F.get(s, i - 1)["id"] != F.get(s, i - 2)["id"]))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.slice(s, i, F.coalesce(F.get(at, k + 1), F.size(s) + 1) - i)))

    return let(F.array_sort(rows), lambda s: F.when(F.size(s) > 1, cut(s)).when(F.size(s) == 1, F.array(s)).otherwise(F.slice(F.array(s), 1, 0)))


def _first(rows: Column, standing: Callable[[Column], Column]) -> Column:
    """The entity that stands first; alone, it isn't compared."""
    best = F.array_min(F.transform(rows, lambda x: F.struct(standing(x).alias("s"), x["e"].alias("e"))))["e"]
    return F.when(F.size(rows) == 1, F.get(rows, F.lit(0))["e"]).otherwise(best)


def _decision(rows: Column, kind: str, scope: Column, name: str, prov: bool) -> Column:
    """What is recorded of a group: null if nothing is merged."""
    id_ = F.get(rows, F.lit(0))["id"]
    lost = F.filter(F.array_sort(F.array_distinct(F.transform(rows, lambda x: x["e"][name]))), lambda i: i != id_)
    told = F.array_sort(F.transform(rows, lambda x: F.struct(x["e"][name].alias("id"), (F.to_json(_provenance(x["e"])) if prov else F.lit(None).cast("string")).alias("provenance"))))
    reason = F.to_json(F.struct(F.lit("exact-key").alias("algorithm"), F.get(rows, F.lit(0))["digest"].alias("canonical_key_digest"), scope.alias("canonical_scope_digest"), F.lit(kind).alias("entity_type"), told.alias("sources")))
    return F.when(F.size(rows) > 1, let(lost, lambda x: F.when(F.size(x) > 0, F.struct(id_.alias("surviving_id"), x.alias("merged_ids"), lower_escapes(reason).alias("reason")))))


def _provenance(e: Column) -> Column:
    return F.concat(F.array(e["provenance"]), F.coalesce(e["additional_provenance"], F.array()))


def _merged(rows: Column, name: str, kind: str, scope: Column, standing: Callable[[Column], Column], more: Callable[[Column], dict[str, Column]]) -> Column:
    """Entities of a unit by canonical id: the first by ``standing`` with the id, all provenance, and ``more`` fields (e); and what was merged (m)."""

    def one(g: Column) -> Column:
        def of(p: Column, e: Column) -> Column:
            e = e.withField(name, F.get(g, F.lit(0))["id"]).withField("provenance", F.get(p, F.lit(0))).withField("additional_provenance", F.slice(p, 2, F.greatest(F.size(p), F.lit(1))))
            for n, c in more(g).items():
                e = e.withField(n, c)
            return F.struct(e.alias("e"), _decision(g, kind, scope, name, True).alias("m"))

        return let(provenance_union(F.transform(g, lambda x: _provenance(x["e"]))), lambda p: let(_first(g, standing), lambda e: of(p, e)))

    return F.transform(_groups(rows), one)


def _members(group: Column) -> Column:
    """A group of units (g) beside what their results and claims become (rs, cs: structs of e and m)."""
    scope = F.get(group, F.lit(0))["digest"]
    most = lambda g, f: F.array_max(F.transform(g, lambda x: x["e"][f]))  # noqa: E731  equal in all members, being in the key
    bases = lambda g: F.array_sort(F.array_distinct(F.flatten(F.transform(g, lambda x: x["basis"]))))
    results = _merged(F.flatten(F.transform(group, lambda x: x["results"])), "result_id", "result", scope, N.result_standing, lambda g: {"p_value": most(g, "p_value"), "n_sample_size": most(g, "n_sample_size")})
    claims = _merged(F.flatten(F.transform(group, lambda x: x["claims"])), "claim_id", "claim", scope, N.claim_standing, lambda g: {"inference_basis_ids": bases(g)})
    return F.struct(group.alias("g"), results.alias("rs"), claims.alias("cs"))


def _unit(members: Column, scope: Column, kind: StructType) -> Column:
    """A unit of all members of a group, with their merged results and claims (e); and what was merged (m)."""
    group, rs, cs = members["g"], members["rs"], members["cs"]
    gathered = lambda f: F.transform(group, lambda x: F.coalesce(x["e"][f], F.array()))
    tasks = F.transform(F.array_sort(F.transform(F.array_distinct(F.flatten(gathered("experiments_or_tasks"))), lambda t: F.struct(scientific_short(t).alias("n"), t.alias("t")))), lambda x: x["t"])
    id_ = F.get(group, F.lit(0))["id"]

    def whole(e: Column) -> Column:
        e = e.withField("unit_id", id_).withField("experiments_or_tasks", tasks)
        for f in ("datasets", "methods", "evidence_spans"):
            e = e.withField(f, _union(gathered(f)))
        return e.withField("results", F.transform(rs, lambda x: x["e"])).withField("claims", F.transform(cs, lambda x: x["e"]))

    e = let(_first(group, lambda x: N.unit_standing(x, kind)), whole)
    m = F.concat(F.array(_decision(group, "study_unit", scope, "unit_id", False)), F.transform(rs, lambda x: x["m"]), F.transform(cs, lambda x: x["m"]))
    return F.struct(F.array_min(F.transform(group, lambda x: x["at"])).alias("first"), id_.alias("id"), e.alias("e"), F.filter(m, lambda x: x.isNotNull()).alias("m"))


def _earlier() -> Column:
    """Decisions that packets come with, their ids in order and reasons that are JSON in its canonical form, so that equal ones are one."""
    had = F.when(F.size("merge_decisions") > 0, F.transform("merge_decisions", lambda m: F.when(F.try_parse_json(m["reason"]).isNotNull(), m["reason"])))
    told = lambda m, r: F.struct(m["surviving_id"].alias("surviving_id"), F.array_sort(m["merged_ids"]).alias("merged_ids"), F.coalesce(r, m["reason"]).alias("reason"))
    return F.zip_with(F.coalesce("merge_decisions", F.array()), F.coalesce(canonical_jsons(had), F.array()), told)


def canonicalize(packets: DataFrame) -> DataFrame:
    """``packets`` with canonical ids: units of equal key become one, then their results, then their claims.

    Results come before claims, whose keys and bases are canonical results.  Tasks, data
    sets, methods, spans and provenance are united.  Merges of several are added to
    ``merge_decisions``.  Doing it twice changes nothing more.  Identities are local to a
    paper, so each packet is settled within its row: nothing is shuffled or stored.
    """
    kind = packets.schema["research_questions"].dataType.elementType["study_units"].dataType.elementType
    name = lambda n: f"__{n}"
    # a filter that holds for all rows keeps what made the packets, Python functions too, from being written into the expressions below
    d = packets.withColumn(name("row"), F.monotonically_increasing_id()).filter(F.col(name("row")) >= 0)
    d = d.withColumns({name("norm"): N.composed_texts("research_questions"), name("earlier"): _earlier(), name("paper"): json_string(F.col("paper_id").cast("string"))})

    def groups(q: Column, n: Column) -> Column:
        return let(N.question_scope(q, n), lambda s: F.struct(s.alias("scope"), _groups(N.keyed_units(F.col(name("paper")), s, q, n)).alias("groups")))

    def question(q: Column, x: Column) -> Column:
        units = F.array_sort(F.transform(x["groups"], lambda g: _unit(g, x["scope"], kind)))
        fresh = lambda us: q.withField("study_units", F.when(F.size(q["study_units"]) > 0, F.transform(us, lambda u: u["e"])).otherwise(q["study_units"]))
        return let(units, lambda us: F.struct(fresh(us).alias("q"), F.flatten(F.transform(us, lambda u: u["m"])).alias("m")))

    d = d.withColumn(name("groups"), F.zip_with("research_questions", F.coalesce(name("norm"), F.array()), groups))
    d = d.withColumn(name("members"), F.transform(name("groups"), lambda x: F.struct(x["scope"].alias("scope"), F.transform(x["groups"], _members).alias("groups"))))
    d = d.withColumn(name("done"), F.zip_with("research_questions", name("members"), question))
    new = F.coalesce(F.flatten(F.transform(name("done"), lambda x: x["m"])), F.array())
    d = d.select(*(c for c in packets.columns if c not in ("research_questions", "merge_decisions")), F.transform(name("done"), lambda x: x["q"]).alias("research_questions"), new.alias(name("new")), name("earlier"))
    merged = F.array_sort(F.array_distinct(F.concat(name("earlier"), name("new")))).cast(f"array<{MERGE}>")
    return d.withColumn("merge_decisions", merged).select(*packets.columns)


def note_missing_rescue(boundaries: Column, mode: Column, selected_text: Column) -> Column:
    """Boundaries of a causal paper whose selected text names no rescue get a note of that, once."""
    text = fold(collapse(selected_text))
    named = F.lit(False)
    for term in RESCUE:
        named = named | F.contains(text, F.lit(term))
    missing = (mode == "causal_validation") & ~named & ~F.array_contains(boundaries, NO_RESCUE)
    return F.when(missing, F.array_append(boundaries, NO_RESCUE)).otherwise(boundaries)
