"""Queries of provenance, rule quality, semantic scores and canonical groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.catalog.planning import PAGES_SQL, PROSE, papers, plan_sql, table
from evidentia.functions.conditions import DOSE, GENOTYPE, STAGE, TIME, UNITS, conditions
from evidentia.functions.similarity import ratio_udf
from evidentia.functions.text import collapse, scientific
from evidentia.operators import canonical as K
from evidentia.operators import clusters as L
from evidentia.operators import planning as P
from evidentia.operators import quality as Q
from evidentia.operators import validation as V
from evidentia.operators.chunks import chunk_rows
from evidentia.operators.merging import canonicalize
from evidentia.schemas import CLAIM, DATASET, MERGE, METHOD, PROVENANCE, RESULT, SPAN


def _provenance(spark, sf_dir):
    """A made-up page range for each chunk: its own page, one page on, or reaching back."""
    c = chunk_rows(papers(spark, sf_dir)).select("paper_id", "chunk_id", "ordinal", "page_start", "page_end")
    turn = (F.col("paper_id") + F.col("ordinal")) % 3
    made = c.select("paper_id", "chunk_id", (F.col("page_start") - F.when(turn == 2, 1).otherwise(0)).alias("page_start"), (F.col("page_start") + F.when(turn == 1, 1).otherwise(0)).alias("page_end"))
    return V.containment(made, c)


def provenance_containment(spark, sf_dir):
    return _provenance(spark, sf_dir).groupBy(F.coalesce("problem", F.lit("ok")).alias("problem")).agg(F.count("*").alias("n"), F.count_if("overlaps").alias("n_overlapping"))


def provenance_overlap(spark, sf_dir):
    return _provenance(spark, sf_dir).filter("overlaps and problem is not null").select("paper_id", "chunk_id", "page_start", "page_end")


#: Passages that one literal may hold; with more, words are joined.
MOST_PASSAGES = 5000


def excerpt_verified(spark, sf_dir):
    """Documents that hold each benchmark passage.

    A passage of three words or more is looked for in the documents that have its longest inner word, which is a whole
    word there, too; shorter ones in all, being a set of queries of checked size.
    """
    item = table(spark, sf_dir, "benchmark").select("item_id", collapse("text").alias("excerpt"))
    docs = table(spark, sf_dir, "documents").select("doc_id", collapse("text").alias("source"))
    inner = F.expr("slice(split(excerpt, ' '), 2, greatest(size(split(excerpt, ' ')) - 2, 0))")
    longest = F.aggregate(inner, F.lit(""), lambda a, w: F.when(F.length(w) > F.length(a), w).otherwise(a))
    keyed = item.filter("excerpt is not null").withColumn("word", longest)
    words = [r[0] for r in keyed.filter("word <> ''").select("word").distinct().limit(MOST_PASSAGES + 1).collect()]
    short = keyed.filter("word = ''").drop("word")
    if len(words) <= MOST_PASSAGES:
        # few words: each document is cut into words once, and only those wanted leave its row
        wanted = F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")
        near = docs.withColumn("word", F.explode(F.array_intersect(F.split("source", " "), wanted))).join(F.broadcast(keyed), "word")
    else:
        each = docs.select("doc_id", F.explode(F.array_distinct(F.split("source", " "))).alias("word"))
        near = each.join(keyed.filter("word <> ''"), "word").select("doc_id", "item_id", "excerpt").join(docs, "doc_id")
    hits = near.filter(F.contains("source", F.col("excerpt"))).select("item_id")
    if n := short.limit(MOST_PASSAGES + 1).count():
        if n > MOST_PASSAGES:
            raise ValueError(f"over {MOST_PASSAGES} passages of one or two words")
        hits = hits.unionByName(docs.join(F.broadcast(short), F.contains("source", F.col("excerpt"))).select("item_id"))
    hits = hits.groupBy("item_id").agg(F.count("*").alias("n_documents"))
    return item.select("item_id").join(hits, "item_id", "left").fillna(0, ["n_documents"])


def semantic_prf(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    g = d.groupBy("source", "lang").agg(F.count("quality").alias("extracted"), F.count_if(F.col("quality") == 0).alias("incorrect"), F.count_if(F.col("quality").isNull()).alias("missed"))
    return g.select("source", "lang", "extracted", "incorrect", "missed", *(c.alias(n) for n, c in Q.prf(F.col("extracted"), F.col("incorrect"), F.col("missed")).items()))


def evidence_strength(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "user_id", F.when(F.col("event_type") == "purchase", F.col("value") / 200).alias("p_value"), F.get_json_object("props", "$.k").cast("int").alias("n_sample_size")
    )
    return Q.evidence_strength(e, "user_id")


def rule_quality_boundaries(spark, sf_dir):
    """The lines of each document as boundaries."""
    d = table(spark, sf_dir, "documents").select("doc_id", Q.boundaries(F.split("text", "\n")).alias("c"))
    return d.select("doc_id", "c.passed", "c.ratio", F.array_join(F.transform("c.warnings", lambda w: w["code"]), ",").alias("codes"))


_PROV = lambda chunk: F.struct(chunk.alias("chunk_id"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end"), F.lit("x").alias("text_excerpt"), F.lit(False).alias("paraphrased"))


def order_packets(spark, sf_dir):
    """Customers as papers, order states as questions, orders as units, lines as results and claims."""
    li = table(spark, sf_dir, "lineitem")
    prov = _PROV(F.col("l_returnflag"))
    none = F.array().cast("array<struct<chunk_id:string,page_start:int,page_end:int,text_excerpt:string,paraphrased:boolean>>")
    result = F.struct(
        F.col("l_linenumber").cast("string").alias("result_id"), F.when(F.col("l_discount") == 0, "").otherwise("quantity").alias("metric_name"), F.when(F.col("l_tax") == 0, " ").otherwise(F.col("l_quantity").cast("string")).alias("value_raw_text"),
        F.col("l_quantity").alias("quantitative_value"), F.lit("pieces").alias("unit"), F.lit(None).cast("double").alias("p_value"), F.col("l_linenumber").alias("n_sample_size"), prov.alias("provenance"), none.alias("additional_provenance"),
    )
    basis = F.when(F.col("l_linenumber") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array((F.col("l_linenumber") + 1).cast("string")))
    claim = F.struct(F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("claim_id"), F.lit("shipped").alias("statement"), F.lit("neutral").alias("polarity"), basis.alias("inference_basis_ids"), prov.alias("provenance"), none.alias("additional_provenance"))
    lines = li.groupBy("l_orderkey").agg(F.collect_list(result).alias("results"), F.collect_list(F.when(F.col("l_linestatus") == "F", claim)).alias("claims"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    unit = F.struct(
        F.col("o_orderkey").cast("string").alias("unit_id"), F.col("o_orderpriority").alias("name"), F.when(F.col("o_orderpriority").startswith("1"), F.array(F.lit(" "))).otherwise(F.array("o_orderpriority")).alias("experiments_or_tasks"),
        F.array().cast("array<struct<dataset_id:string,name:string,version_or_split:string,description:string>>").alias("datasets"), F.array().cast("array<struct<method_id:string,name:string,protocol_description:string>>").alias("methods"),
        "results", "claims", F.array().cast("array<struct<span_id:string,content:string,provenance:struct<chunk_id:string,page_start:int,page_end:int,text_excerpt:string,paraphrased:boolean>>>").alias("evidence_spans"),
    )
    q = o.groupBy("o_custkey", "o_orderstatus").agg(F.collect_list(unit).alias("study_units"))
    question = F.struct(F.col("o_orderstatus").alias("question_id"), F.col("o_orderstatus").alias("statement"), "study_units")
    p = q.groupBy(F.col("o_custkey").cast("string").alias("paper_id")).agg(F.array_sort(F.collect_list(question), lambda a, b: F.when(a["question_id"] < b["question_id"], -1).otherwise(1)).alias("research_questions"))
    return p.withColumns({"coverage_ledger": F.create_map(F.lit("A"), F.lit("extracted"), F.lit("N"), F.lit("extracted"), F.lit("Z"), F.lit("not_selected")), "limitations_and_boundaries": F.array(F.lit("one"))})


def _component(spark, sf_dir, at):
    d = Q.rule_quality(order_packets(spark, sf_dir)).select("paper_id", F.get("components", F.lit(at)).alias("c"), "score")
    return d.select("paper_id", "c.passed", "c.total", "c.ratio", F.array_join(F.transform("c.warnings", lambda w: F.concat(w["code"], F.lit(":"), F.size(w["entity_ids"]).cast("string"))), ",").alias("codes"))


def rule_quality_score(spark, sf_dir):
    return Q.rule_quality(order_packets(spark, sf_dir)).select("paper_id", "score")


_LINES = r"""
r AS (SELECT CAST(o_custkey AS VARCHAR) AS paper_id, o_orderstatus AS q, o_orderkey AS u, o_orderpriority, l_linenumber AS n, l_returnflag, l_linestatus = 'F' AS claimed, l_discount, l_tax
      FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey),
us AS (SELECT paper_id, q, u, any_value(o_orderpriority) AS pr, list(n) FILTER (n IS NOT NULL) AS ns, count(n) AS results, count(*) FILTER (claimed) AS claims FROM r GROUP BY paper_id, q, u),
c AS (SELECT r.paper_id, r.u, r.n, r.n % 3 = 0 AS bare, coalesce(list_contains(us.ns, r.n + 1), false) AS known FROM r JOIN us USING (paper_id, q, u) WHERE claimed),
pu AS (SELECT paper_id, count(DISTINCT q) AS nq, count(*) AS nu, count(*) FILTER (starts_with(pr, '1')) AS no_task, count(*) FILTER (results = 0) AS no_results, count(*) FILTER (claims = 0) AS no_claims, sum(results) AS nr, sum(claims) AS nc FROM us GROUP BY 1),
pr AS (SELECT paper_id, count(DISTINCT n) FILTER (l_discount = 0) AS d_metric, count(DISTINCT n) FILTER (l_tax = 0) AS d_value, count(*) FILTER (l_discount = 0) AS no_metric, count(*) FILTER (l_tax = 0) AS no_value FROM r WHERE n IS NOT NULL GROUP BY 1),
pc AS (SELECT paper_id, count(*) FILTER (bare) AS bare, count(*) FILTER (NOT bare AND NOT known) AS invalid, count(DISTINCT n) FILTER (bare) AS d_bare, count(DISTINCT n) FILTER (NOT bare AND NOT known) AS d_invalid FROM c GROUP BY 1),
s AS (SELECT pu.paper_id, 1 + nq + 3 * nu + 2 * nr + 2 * nc AS total, no_task, no_results, no_claims, coalesce(d_metric, 0) AS d_metric, coalesce(d_value, 0) AS d_value, coalesce(d_bare, 0) AS d_bare, coalesce(d_invalid, 0) AS d_invalid,
             no_task + no_results + no_claims + coalesce(no_metric, 0) + coalesce(no_value, 0) + 2 * coalesce(bare, 0) + coalesce(invalid, 0) AS lost FROM pu LEFT JOIN pr USING (paper_id) LEFT JOIN pc USING (paper_id)),
structure AS (SELECT paper_id, CAST(total - lost AS INTEGER) AS passed, CAST(total AS INTEGER) AS total, round_even((total - lost) / total, 6) AS ratio,
  concat_ws(',', CASE WHEN no_task > 0 THEN 'structure.units_without_tasks:' || no_task END, CASE WHEN no_results > 0 THEN 'structure.units_without_results:' || no_results END,
    CASE WHEN no_claims > 0 THEN 'structure.units_without_claims:' || no_claims END, CASE WHEN d_metric > 0 THEN 'structure.results_without_metrics:' || d_metric END, CASE WHEN d_value > 0 THEN 'structure.results_without_values:' || d_value END,
    CASE WHEN d_bare > 0 THEN 'structure.claims_without_evidence:' || d_bare END, CASE WHEN d_invalid > 0 THEN 'structure.claims_with_invalid_evidence:' || d_invalid END) AS codes FROM s),
e AS (SELECT paper_id, l_returnflag AS chunk, 'r' || n AS id, 1 AS k FROM r WHERE n IS NOT NULL UNION ALL SELECT paper_id, l_returnflag, 'c' || n, 1 FROM r WHERE claimed),
p AS (SELECT us.paper_id, count(e.chunk) AS n, count(*) FILTER (e.chunk IN ('A', 'N')) AS tracked, count(DISTINCT e.id) FILTER (e.chunk NOT IN ('A', 'N')) AS d_untracked, max(CAST(e.chunk = 'A' AS INTEGER)) AS a, max(CAST(e.chunk = 'N' AS INTEGER)) AS b
      FROM (SELECT DISTINCT paper_id FROM us) us LEFT JOIN e USING (paper_id) GROUP BY 1),
prov AS (SELECT paper_id, CAST(1 + 2 + n + tracked + coalesce(a, 0) + coalesce(b, 0) + CAST(n > 0 AS INTEGER) AS INTEGER) AS passed, CAST(2 + 3 + 2 * n + 2 AS INTEGER) AS total, n, d_untracked, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM p),
provenance AS (SELECT paper_id, passed, total, round_even(passed / total, 6) AS ratio, concat_ws(',', CASE WHEN n = 0 THEN 'provenance.no_evidence_entities:0' END, CASE WHEN d_untracked > 0 THEN 'provenance.untracked_chunks:' || d_untracked END,
   'coverage.not_selected_chunks:1', CASE WHEN a + b < 2 THEN 'coverage.unused_extracted_chunks:' || (2 - a - b) END) AS codes FROM prov)"""


def protected_conditions(spark, sf_dir):
    """Conditions by the prose's own words and by digits with units."""
    words = {"negation": {"no": "no", "la": "of"}, "direction": {"de": "down", "the": "up"}, "modality": {"der": "the"}}
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(conditions(scientific(F.col("text"), False), words)).alias("condition"))
    return d.groupBy("condition").agg(F.count("*").alias("n_documents"))


def _lines(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.posexplode_outer(F.split("text", "\n")).alias("at", "line"))
    d = d.withColumn("key", scientific(F.col("line"), False)).filter("key <> ''")
    return d.withColumn("id", F.concat_ws("-", F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lpad(F.col("at").cast("string"), 6, "0")))


_BY = ["source", "lang", "key"]
_ORDER = lambda: [-F.length("line"), F.col("id")]


def canonical_groups(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy(*_BY).agg(F.count("*").alias("n"), F.min("id").alias("least_id")).filter("n > 1").select("source", "lang", F.sha2("key", 256).alias("digest"), "n", "least_id")


def representatives(spark, sf_dir):
    d = K.representatives(_lines(spark, sf_dir), _BY, _ORDER(), "id").filter("n > 1")
    return d.select("source", "lang", F.sha2("key", 256).alias("digest"), "surviving", "n")


def merge_decisions(spark, sf_dir):
    d = K.merge_decisions(_lines(spark, sf_dir), _BY, _ORDER(), "id")
    return d.select("source", "lang", F.sha2("key", 256).alias("digest"), "surviving", F.array_join("merged", ",").alias("merged"))


_LINES_SQL = r"""
l AS (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
k AS (SELECT source, lang, line, lpad(CAST(doc_id AS VARCHAR), 9, '0') || '-' || lpad(CAST(i AS VARCHAR), 6, '0') AS id,
      trim(regexp_replace(regexp_replace(translate(replace(lower(line), 'ß', 'ss'), '‐‑‒–—−μ', '------u'), '[^\p{L}\p{N}_.%<>=!+\-/]+', ' ', 'g'), '\s+', ' ', 'g')) AS key FROM l),
f AS (SELECT *, first_value(id) OVER w AS surviving, count(*) OVER (PARTITION BY source, lang, key) AS n FROM k WHERE key <> '' WINDOW w AS (PARTITION BY source, lang, key ORDER BY length(line) DESC, id))"""


def complete_link(spark, sf_dir):
    """Clusters of the vectors of a label whose cosines all reach 0.2."""
    v = table(spark, sf_dir, "embeddings")
    items = v.select("label", F.col("vec_id").cast("string").alias("key"))
    return L.complete_link(items, L.cosine_pairs(v, "label", "vec_id", "embedding", 200_000), 200_000, "label")


def similarity_ratio(spark, sf_dir):
    """How well a passage from anywhere in each document, one character left out, stands in its whole text."""
    at = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - 60)).cast("int") + 1
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.substring("text", at, F.lit(30)), F.substring("text", at + 31, F.lit(30))).alias("e"), "text")
    return d.select("doc_id", F.round(ratio_udf("e", "text"), 6).alias("ratio"))


def broken_basis_refs(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return V.broken_references(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), done, ["l_orderkey"])


def coverage_gaps(spark, sf_dir):
    """Chunks whose ordinal isn't among the paper's selected ones, both ways."""
    planned = P.plan(papers(spark, sf_dir), PROSE)
    return V.set_differences(chunk_rows(planned).select("paper_id", "ordinal"), P.selected_rows(planned).select("paper_id", "ordinal"), ["paper_id", "ordinal"])


def duplicate_ids(spark, sf_dir):
    return V.repeated(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey"])


def atomic_items(spark, sf_dir):
    from evidentia.operators.packets import atomic_items as items

    return items(order_packets(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("n"))


def _order_lines(spark, sf_dir):
    """(l_orderkey, lines): an order's lines in order, with no more than its packet says of them: this is what is shuffled by customer."""
    li = table(spark, sf_dir, "lineitem")
    true = lambda c: F.coalesce(c, F.lit(False))
    raw = {"many": true(F.col("l_quantity") > 25), "upper": true(F.dayofmonth("l_shipdate") % 2 == 0), "pieces": true(F.col("l_discount") > 0.05)}
    by, told = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax"], ["l_returnflag", "l_linestatus", *raw]
    li = li.select("l_orderkey", *by, *told[:2], *(c.alias(n) for n, c in raw.items())).repartition("l_orderkey")  # rows, as few orders have several in a task
    lines = F.sort_array(F.collect_list(F.struct(*by, *told)))
    return li.groupBy("l_orderkey").agg(F.transform(lines, lambda x: F.struct(x["l_suppkey"].alias("l_suppkey"), (x["l_tax"] > 0.04).alias("retold"), *(x[c].alias(c) for c in told))).alias("lines"))


def restated_packets(spark, sf_dir):
    """Customers as papers, orders as units named by their priority, lines as results and claims that differ in spelling and provenance alone.

    Packets are built from a customer's orders and lines within its row.
    """
    none = F.array().cast(f"array<{PROVENANCE}>")
    empty = lambda t: F.array().cast(f"array<{t}>")
    number = lambda k: F.lpad((k + 1).cast("string"), 3, "0")
    prov = lambda x: F.struct(F.concat(F.lit("c"), x["l_suppkey"].cast("string")).alias("chunk_id"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end"), F.lit("x").alias("text_excerpt"), x["retold"].alias("paraphrased"))

    def result(x, k):
        raw = F.concat(x["l_linestatus"], F.when(x["many"], " many").otherwise(" few"))
        return F.struct(
            number(k).alias("result_id"), x["l_returnflag"].alias("metric_name"), F.when(x["upper"], F.upper(raw)).otherwise(F.lower(raw)).alias("value_raw_text"), F.lit(None).cast("double").alias("quantitative_value"),
            F.when(x["pieces"], "pieces").alias("unit"), F.lit(None).cast("double").alias("p_value"), F.lit(None).cast("int").alias("n_sample_size"), prov(x).alias("provenance"), none.alias("additional_provenance"),
        )

    def claim(x, k):
        polarity = F.when(x["l_returnflag"] == "R", "negative").otherwise("positive")
        return F.struct(F.concat(F.lit("c"), number(k)).alias("claim_id"), F.lit("Shipped.").alias("statement"), polarity.alias("polarity"), F.array(number(k)).alias("inference_basis_ids"), prov(x).alias("provenance"), none.alias("additional_provenance"))

    def unit(o):
        results = F.coalesce(F.transform(o["lines"], result), empty(RESULT))
        claims = F.coalesce(F.filter(F.transform(o["lines"], lambda x, k: F.when(x["l_linestatus"] == "F", claim(x, k))), lambda c: c.isNotNull()), empty(CLAIM))
        return F.struct(
            o["o_orderkey"].cast("string").alias("unit_id"), o["o_orderpriority"].alias("name"), F.array(o["o_orderpriority"]).alias("experiments_or_tasks"), empty(DATASET).alias("datasets"), empty(METHOD).alias("methods"),
            results.alias("results"), claims.alias("claims"), empty(SPAN).alias("evidence_spans"),
        )

    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").join(_order_lines(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    q = o.groupBy(F.col("o_custkey").cast("string").alias("paper_id")).agg(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "lines")).alias("os"))
    question = F.struct(F.lit("q").alias("question_id"), F.lit("What?").alias("statement"), F.transform("os", unit).alias("study_units"))
    return q.select("paper_id", F.array(question).alias("research_questions"), empty(MERGE).alias("merge_decisions"))


def canonical_packets(spark, sf_dir):
    """Results, claims and merges of restated packets after canonicalisation: who stands for a group, and all it rests on."""
    d = canonicalize(restated_packets(spark, sf_dir))
    d = d.select("paper_id", F.flatten(F.transform("research_questions", lambda q: q["study_units"])).alias("us"), F.transform("merge_decisions", lambda m: F.substring_index(m["surviving_id"], "_", 1)).alias("ms"))
    told = lambda e: F.array_join(F.transform(F.concat(F.array(e["provenance"]), e["additional_provenance"]), lambda p: F.concat(p["chunk_id"], F.when(p["paraphrased"], "~").otherwise(""))), ",")
    row = lambda kind, unit_name, a, b, c: F.struct(F.lit(kind).alias("kind"), unit_name.alias("unit_name"), a.alias("a"), b.alias("b"), c.alias("c"))
    of_unit = lambda kind, a, b: F.flatten(F.transform("us", lambda u: F.transform(u[f"{kind}s"], lambda e: row(kind, u["name"], e[a], e[b], told(e)))))
    merges = F.transform(F.array_distinct("ms"), lambda a: row("merge", F.lit(""), a, F.size(F.filter("ms", lambda m: m == a)).cast("string"), F.lit("")))
    rows = F.concat(of_unit("result", "metric_name", "value_raw_text"), of_unit("claim", "polarity", "statement"), merges)
    return d.select("paper_id", F.explode_outer(rows).alias("r")).select("paper_id", "r.*").filter("kind IS NOT NULL")


QUERIES = {
    "canonical_packets": canonical_packets, "provenance_containment": provenance_containment, "provenance_overlap": provenance_overlap, "excerpt_verified": excerpt_verified, "semantic_prf": semantic_prf, "evidence_strength": evidence_strength,
    "rule_quality_boundaries": rule_quality_boundaries, "rule_quality_structure": lambda s, d: _component(s, d, 0), "rule_quality_provenance": lambda s, d: _component(s, d, 1), "rule_quality_score": rule_quality_score,
    "protected_conditions": protected_conditions, "canonical_groups": canonical_groups, "representatives": representatives, "merge_decisions": merge_decisions, "complete_link": complete_link, "similarity_ratio": similarity_ratio,
    "broken_basis_refs": broken_basis_refs, "coverage_gaps": coverage_gaps, "duplicate_ids": duplicate_ids, "atomic_items": atomic_items,
}

_MADE = f"""{PAGES_SQL}, made AS (SELECT paper_id, chunk_id, page, page - CASE WHEN (paper_id + ordinal) % 3 = 2 THEN 1 ELSE 0 END AS page_start, page + CASE WHEN (paper_id + ordinal) % 3 = 1 THEN 1 ELSE 0 END AS page_end FROM chunks),
met AS (SELECT *, CASE WHEN page_start >= page AND page_end <= page THEN 'ok' ELSE 'outside_chunk' END AS problem, page <= page_end AND page >= page_start AS meets FROM made)"""
_COLLAPSED = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
_UNIT = r"regexp_extract(m, '^\d+(?:\.\d+)?\s*(.*)$', 1)"
_NUMBER = r"regexp_replace(regexp_extract(m, '^\d+(?:\.\d+)?'), '^0+(\d)', '\1')"
_QUANTITY = rf"CASE WHEN contains({_NUMBER}, '.') THEN regexp_replace({_NUMBER}, '\.?0+$', '') ELSE {_NUMBER} END || ' ' || CASE {_UNIT} {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in UNITS.items())} ELSE {_UNIT} END"
_COND = "scientific AS (SELECT doc_id, ' ' || trim(regexp_replace(regexp_replace(replace(lower(text), 'ß', 'ss'), '[^\\p{L}\\p{N}_.%<>=!+\\-/]+', ' ', 'g'), '\\s+', ' ', 'g')) || ' ' AS t FROM documents)"

ORACLE_SQL = {
    "canonical_packets": """
WITH l AS (SELECT o_custkey AS paper, o_orderkey AS u, o_orderpriority AS pr, CASE WHEN l_orderkey IS NOT NULL THEN row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax) END AS n, l_returnflag AS metric, l_linestatus AS st, l_discount > 0.05 AS pieces, l_tax > 0.04 AS retold, 'c' || l_suppkey AS chunk,
    l_linestatus || CASE WHEN l_quantity > 25 THEN ' many' ELSE ' few' END AS raw, dayofmonth(l_shipdate) % 2 = 0 AS up, CASE WHEN l_returnflag = 'R' THEN 'negative' ELSE 'positive' END AS pol FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey),
units AS (SELECT paper, u, any_value(pr) AS pr, coalesce(string_agg(DISTINCT metric, ',' ORDER BY metric), '') AS ms FROM l GROUP BY 1, 2),
r AS (SELECT l.*, ms, lower(raw) AS norm, CASE WHEN up THEN upper(raw) ELSE lower(raw) END AS shown FROM l JOIN units USING (paper, u) WHERE n IS NOT NULL),
prov AS (SELECT paper, pr, ms, metric, norm, pieces, string_agg(chunk || CASE WHEN retold THEN '~' ELSE '' END, ',' ORDER BY retold, chunk) AS c FROM (SELECT DISTINCT paper, pr, ms, metric, norm, pieces, chunk, retold FROM r) GROUP BY ALL),
results AS (SELECT paper, pr, ms, metric, norm, pieces, first(shown ORDER BY retold, shown, n) AS b, count(*) AS size FROM r GROUP BY ALL),
cprov AS (SELECT paper, pr, ms, metric, norm, pieces, pol, string_agg(chunk || CASE WHEN retold THEN '~' ELSE '' END, ',' ORDER BY retold, chunk) AS c FROM (SELECT DISTINCT paper, pr, ms, metric, norm, pieces, pol, chunk, retold FROM r WHERE st = 'F') GROUP BY ALL),
claims AS (SELECT paper, pr, ms, metric, norm, pieces, pol, count(*) AS size FROM r WHERE st = 'F' GROUP BY ALL),
merges AS (SELECT paper, 'su' AS a FROM units GROUP BY paper, pr, ms HAVING count(*) > 1 UNION ALL SELECT paper, 'res' FROM results WHERE size > 1 UNION ALL SELECT paper, 'clm' FROM claims WHERE size > 1)
SELECT CAST(paper AS VARCHAR) AS paper_id, 'result' AS kind, pr AS unit_name, metric AS a, b, c FROM results JOIN prov USING (paper, pr, ms, metric, norm, pieces)
UNION ALL SELECT CAST(paper AS VARCHAR), 'claim', pr, pol, 'Shipped.', c FROM claims JOIN cprov USING (paper, pr, ms, metric, norm, pieces, pol)
UNION ALL SELECT CAST(paper AS VARCHAR), 'merge', '', a, CAST(count(*) AS VARCHAR), '' FROM merges GROUP BY paper, a""",
    "provenance_containment": f"WITH {_MADE} SELECT problem, count(*) AS n, count(*) FILTER (meets) AS n_overlapping FROM met GROUP BY 1",
    "provenance_overlap": f"WITH {_MADE} SELECT paper_id, chunk_id, CAST(page_start AS INTEGER) AS page_start, CAST(page_end AS INTEGER) AS page_end FROM met WHERE meets AND problem <> 'ok'",
    "excerpt_verified": f"SELECT b.item_id, count(d.doc_id) AS n_documents FROM benchmark b LEFT JOIN documents d ON contains({_COLLAPSED.format('d.text')}, {_COLLAPSED.format('b.text')}) GROUP BY 1",
    "semantic_prf": """
WITH g AS (SELECT source, lang, count(quality) AS extracted, count(*) FILTER (quality = 0) AS incorrect, count(*) FILTER (quality IS NULL) AS missed FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2),
s AS (SELECT *, extracted - incorrect AS c, CASE WHEN extracted = 0 THEN 1.0 ELSE CAST(extracted - incorrect AS DOUBLE) / extracted END AS p, CASE WHEN extracted - incorrect + missed = 0 THEN 1.0 ELSE CAST(extracted - incorrect AS DOUBLE) / (extracted - incorrect + missed) END AS r FROM g)
SELECT source, lang, extracted, incorrect, missed, c AS correct_item_count, round_even(p, 4) AS precision, round_even(r, 4) AS recall, round_even(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 4) AS f1 FROM s""",
    "evidence_strength": """
WITH e AS (SELECT user_id, CASE WHEN event_type = 'purchase' THEN value / 200 END AS p, CAST(json_extract(props, '$.k') AS INTEGER) AS n FROM events)
SELECT user_id, round_even(CAST(count(p) AS DOUBLE) / count(*), 4) AS statistical_support_coverage, round_even(CAST(count(n) AS DOUBLE) / count(*), 4) AS sample_size_coverage,
       round_even(avg(least(1.0, ln(1 + n) / ln(1001))), 4) AS sample_size_log_score FROM e GROUP BY 1""",
    "rule_quality_boundaries": r"""
WITH b AS (SELECT doc_id, string_split(text, chr(10)) AS bs FROM documents),
n AS (SELECT doc_id, bs, list_transform(list_filter(bs, lambda x: trim(x) <> ''), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))) AS k FROM b),
m AS (SELECT doc_id, len(k) AS n, len(list_distinct(list_transform(k, lambda x: replace(lower(x), 'ß', 'ss')))) AS u, len(list_filter(k, lambda x: length(x) < 40)) AS short, len(bs) - len(k) AS blank FROM n),
p AS (SELECT *, CAST(n > 0 AS INTEGER) + CAST(u >= 3 AS INTEGER) + CAST(n > 0 AND u = n AS INTEGER) + CAST(n > 0 AND short = 0 AS INTEGER) + CAST(blank = 0 AS INTEGER) AS passed FROM m)
SELECT doc_id, passed, round_even(passed / 5, 6) AS ratio, concat_ws(',', CASE WHEN n = 0 THEN 'boundaries.none' END, CASE WHEN n > 0 AND u < 3 THEN 'boundaries.too_few' END, CASE WHEN n > 0 AND u <> n THEN 'boundaries.duplicates' END,
  CASE WHEN short > 0 THEN 'boundaries.shallow' END, CASE WHEN blank > 0 THEN 'boundaries.blank' END) AS codes FROM p""",
    "rule_quality_structure": f"WITH {_LINES} SELECT paper_id, passed, total, ratio, codes FROM structure",
    "rule_quality_provenance": f"WITH {_LINES} SELECT paper_id, passed, total, ratio, codes FROM provenance",
    "rule_quality_score": f"WITH {_LINES} SELECT paper_id, round_even(round_even(s.ratio * 0.5, 6) + round_even(p.ratio * 0.35, 6) + round_even(0.6 * 0.15, 6), 4) AS score FROM structure s JOIN provenance p USING (paper_id)",
    "protected_conditions": f"""WITH {_COND}
SELECT c AS condition, count(*) AS n_documents FROM (SELECT doc_id, unnest(list_distinct(list_concat(
  list_filter([CASE WHEN contains(t, ' no ') THEN 'negation:no' END, CASE WHEN contains(t, ' la ') THEN 'negation:of' END, CASE WHEN contains(t, ' de ') THEN 'direction:down' END, CASE WHEN contains(t, ' the ') THEN 'direction:up' END, CASE WHEN contains(t, ' der ') THEN 'modality:the' END], lambda x: x IS NOT NULL),
  list_transform(regexp_extract_all(t, '{STAGE}'), lambda m: 'development_stage:' || m), list_transform(regexp_extract_all(t, '{TIME}'), lambda m: 'time:' || {_QUANTITY}),
  list_transform(regexp_extract_all(t, '{DOSE}'), lambda m: 'dose:' || {_QUANTITY}), list_transform(regexp_extract_all(t, '{GENOTYPE}'), lambda m: 'perturbation:' || m)))) AS c FROM scientific) GROUP BY 1""",
    "canonical_groups": f"WITH {_LINES_SQL} SELECT source, lang, sha256(key) AS digest, count(*) AS n, min(id) AS least_id FROM f GROUP BY source, lang, key HAVING count(*) > 1",
    "representatives": f"WITH {_LINES_SQL} SELECT source, lang, sha256(key) AS digest, any_value(surviving) AS surviving, count(*) AS n FROM f WHERE n > 1 GROUP BY source, lang, key",
    "merge_decisions": f"WITH {_LINES_SQL} SELECT source, lang, sha256(key) AS digest, surviving, string_agg(DISTINCT id, ',' ORDER BY id) AS merged FROM f WHERE n > 1 AND id <> surviving GROUP BY source, lang, key, surviving",
    "broken_basis_refs": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')",
    "coverage_gaps": f"WITH {plan_sql(PROSE)} SELECT c.paper_id, c.ordinal, 'missing' AS side FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM selected s WHERE s.paper_id = c.paper_id AND s.ordinal = c.ordinal)",
    "duplicate_ids": "SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "atomic_items": f"WITH {_LINES} SELECT kind, CAST(n AS BIGINT) AS n FROM (SELECT 'research_question' AS kind, sum(nq) AS n FROM pu UNION ALL SELECT 'experiment_or_task', sum(nu) FROM pu UNION ALL SELECT 'result', count(DISTINCT (paper_id, u, n)) FROM r WHERE n IS NOT NULL UNION ALL SELECT 'claim', count(DISTINCT (paper_id, u, n)) FROM c UNION ALL SELECT 'limitation_or_boundary', count(*) FROM pu)",
}
