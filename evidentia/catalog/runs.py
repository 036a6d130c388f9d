"""Queries of run reports, recovery, the ledger and bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.catalog.planning import PAGES_SQL, papers, table
from evidentia.functions.text import namespaced, natural_key
from evidentia.operators import ledger as L
from evidentia.operators import recovery as R
from evidentia.operators import reporting as B
from evidentia.operators.chunks import chunk_rows

#: Prices whose costs are whole halves of a millionth: exact in both engines.
_PRICES = (0.5, 1.0)


def _micro(d):
    return d.withColumn("cost_micro_usd", F.round(F.col("estimated_cost_usd") * 1e6, 1)).drop("estimated_cost_usd")



def _calls(spark, sf_dir):
    """Views as extraction calls and clicks as judge calls; a paper for each user and day."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    paper = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "dd"))
    stage = F.when(F.col("event_type") == "view", "extraction").when(F.col("event_type") == "click", "judge")
    return e.select(
        paper.alias("paper_id"), stage.alias("stage"), "ts", F.coalesce(k, F.lit(0)).alias("prompt_tokens"), (F.coalesce(k, F.lit(0)) % 7).alias("completion_tokens"), (F.coalesce(k, F.lit(0)) % 97 != 0).alias("usage_complete"),
        F.round("value", 3).alias("latency_seconds"), (F.col("event_type") == "signup").alias("unpriced"), (F.col("event_type") == "error").alias("broken"),
    )


def stage_metrics(spark, sf_dir):
    d = B.stage_metrics(_calls(spark, sf_dir).filter("stage is not null"), ["paper_id", "stage"], *_PRICES)
    return _micro(d.withColumn("latency_seconds", F.round("latency_seconds", 3)))


def _records(spark, sf_dir):
    calls = _calls(spark, sf_dir)
    stages = B.stage_metrics(calls.filter("stage is not null"), ["paper_id", "stage"], *_PRICES)
    marks = calls.groupBy("paper_id").agg(F.bool_or("unpriced").alias("unpriced"), F.bool_or("broken").alias("broken"), F.round(F.avg("latency_seconds") / 200, 3).alias("score"))
    stages = stages.join(marks.select("paper_id", "unpriced"), "paper_id").withColumn("estimated_cost_usd", F.when(~F.col("unpriced"), F.col("estimated_cost_usd"))).drop("unpriced")
    p = marks.select("paper_id", F.when(F.col("broken"), "failed").otherwise("succeeded").alias("status"), F.when(~F.col("broken"), F.col("score")).alias("quality_score"))
    return B.records(stages, p)


def record_rollup(spark, sf_dir):
    return _micro(_records(spark, sf_dir).withColumn("total_latency_seconds", F.round("total_latency_seconds", 3)).drop("quality_score"))


def run_summary(spark, sf_dir):
    d = B.run_summary(_records(spark, sf_dir))
    return _micro(d.withColumns({"total_latency_seconds": F.round("total_latency_seconds", 2), "mean_quality_score": F.round("mean_quality_score", 3)}))


def retry_ordinals(spark, sf_dir):
    d = B.attempts(table(spark, sf_dir, "conversations").select("conv_id", "role", "turn"), ["conv_id", "role"], "turn")
    return d.select("conv_id", "role", "turn", "attempt", "is_last")


def failed_selection(spark, sf_dir):
    d = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("paper_id"), F.when(F.col("quality") == 0, "failed").otherwise("succeeded").alias("status"))
    return R.failed(d).select("paper_id")


def recovery_split(spark, sf_dir):
    """Documents of low quality failed; their texts are delivered where a good document has the same one, and changed where they are long."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), F.sha2("text", 256).alias("sha"), "n_chars")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("paper_id"), "quality")
    d = docs.join(labels, "paper_id")
    bad = d.filter("quality = 0").select("paper_id", F.col("sha").alias("source_sha256"))
    good = d.filter("quality = 1").select("sha").distinct()
    delivered = bad.join(good, bad["source_sha256"] == good["sha"], "left_semi").select("paper_id")
    now = docs.filter("n_chars % 10 <> 0").select("paper_id", F.when(F.col("n_chars") > 5000, "other").otherwise(F.col("sha")).alias("source_sha256"))
    return R.split(bad, now, delivered).select("paper_id", "action")


def ledger_sequence_check(spark, sf_dir):
    """Events as ledgers of users: a revision a day, a purchase as its commit."""
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "purchase", "batch_committed").otherwise("evidence_added")
    d = e.select(F.col("user_id").alias("ledger_id"), F.col("event_id").alias("sequence"), F.dayofmonth("ts").alias("revision"), kind.alias("kind"))
    return L.sequence_violations(d).groupBy("ledger_id", "rule").agg(F.count("*").alias("n"))


def evidence_cardinality(spark, sf_dir):
    """Orders as assertions with their lines as evidence; lines after the first are added by events, but for returned ones."""
    li = table(spark, sf_dir, "lineitem")
    a = li.groupBy(F.col("l_orderkey").alias("assertion_id")).agg(F.count("*").alias("evidence_count"))
    first = a.select("assertion_id", F.lit("assertion_added").alias("kind"))
    more = li.filter("l_linenumber > 1 and l_returnflag <> 'R'").select(F.col("l_orderkey").alias("assertion_id"), F.lit("evidence_added").alias("kind"))
    return L.cardinality_violations(a, first.unionByName(more)).select("assertion_id", "evidence_count", "more")


def bundle_manifest(spark, sf_dir):
    """Per horizon and group: papers, chunks, least id, and the ids in natural order."""
    horizon = F.when(F.col("n_chars") >= 2000, "long").otherwise("short")
    d = table(spark, sf_dir, "documents").select("doc_id", "source", horizon.alias("horizon"))
    d = d.withColumn("paper_id", namespaced(F.concat(F.lit("p"), F.col("doc_id").cast("string")), F.col("horizon")))
    n = chunk_rows(papers(spark, sf_dir)).groupBy("paper_id").agg(F.count("*").alias("chunks")).withColumnRenamed("paper_id", "doc_id")
    d = d.join(n, "doc_id", "left").fillna(0, ["chunks"])
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(natural_key(F.col("paper_id")).alias("k"), F.col("paper_id").alias("id")))), lambda x: x["id"]), ",")
    return d.groupBy("horizon", "source").agg(F.count("*").alias("n_papers"), F.sum("chunks").alias("n_chunks"), F.min("doc_id").alias("least_id"), F.sha2(listed, 256).alias("ids_sha256"))


def usage_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.create_map(F.col("event_type"), F.get_json_object("props", "$.k").cast("long")).alias("usage"))
    return B.merged_usage(e, ["user_id"]).select("user_id", F.explode("usage").alias("event_type", "tokens"))


QUERIES = {
    "stage_metrics": stage_metrics, "record_rollup": record_rollup, "run_summary": run_summary, "retry_ordinals": retry_ordinals, "failed_selection": failed_selection, "recovery_split": recovery_split,
    "ledger_sequence_check": ledger_sequence_check, "evidence_cardinality": evidence_cardinality, "bundle_manifest": bundle_manifest, "usage_merge": usage_merge,
}

_CALLS = """
calls AS (SELECT user_id || '-' || strftime(ts, '%d') AS paper_id, CASE event_type WHEN 'view' THEN 'extraction' WHEN 'click' THEN 'judge' END AS stage, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS p,
  coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) % 7 AS c, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) % 97 <> 0 AS u, round(value, 3) AS s, event_type = 'signup' AS unpriced, event_type = 'error' AS broken FROM events),
stages AS (SELECT paper_id, stage, count(*) AS attempts, CAST(sum(p) AS BIGINT) AS prompt_tokens, CAST(sum(c) AS BIGINT) AS completion_tokens, bool_and(u) AS usage_complete, round(sum(s), 6) AS latency_seconds,
  CAST(sum(p) + sum(c) AS BIGINT) AS total_tokens, round(sum(p) * 0.5 + sum(c), 1) AS cost FROM calls WHERE stage IS NOT NULL GROUP BY 1, 2),
marks AS (SELECT paper_id, bool_or(unpriced) AS unpriced, bool_or(broken) AS broken, round(avg(s) / 200, 3) AS score FROM calls GROUP BY 1),
records AS (SELECT m.paper_id, CASE WHEN broken THEN 'failed' ELSE 'succeeded' END AS status, CASE WHEN NOT broken THEN any_value(score) END AS quality_score, CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS total_prompt_tokens,
  CAST(coalesce(sum(completion_tokens), 0) AS BIGINT) AS total_completion_tokens, CAST(coalesce(sum(total_tokens), 0) AS BIGINT) AS total_tokens, coalesce(bool_and(usage_complete), true) AS usage_complete,
  coalesce(round(sum(latency_seconds), 6), 0) AS total_latency_seconds, CASE WHEN count(stage) > 0 AND NOT any_value(unpriced) THEN round(sum(cost), 1) END AS cost_micro_usd
  FROM marks m LEFT JOIN stages s USING (paper_id) GROUP BY m.paper_id, broken)"""

ORACLE_SQL = {
    "stage_metrics": f"WITH {_CALLS} SELECT paper_id, stage, attempts, prompt_tokens, completion_tokens, usage_complete, round(latency_seconds, 3) AS latency_seconds, total_tokens, cost AS cost_micro_usd FROM stages",
    "record_rollup": f"WITH {_CALLS} SELECT * EXCLUDE (quality_score) REPLACE (round(total_latency_seconds, 3) AS total_latency_seconds) FROM records",
    "run_summary": f"""WITH {_CALLS} SELECT count(*) AS input_count, count(*) FILTER (status = 'succeeded') AS succeeded, count(*) FILTER (status = 'failed') AS failed, CAST(sum(total_prompt_tokens) AS BIGINT) AS total_prompt_tokens,
  CAST(sum(total_completion_tokens) AS BIGINT) AS total_completion_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens, bool_and(usage_complete) AS usage_complete, NOT bool_and(usage_complete) AS estimated_cost_is_lower_bound,
  round(sum(total_latency_seconds), 2) AS total_latency_seconds, CASE WHEN count(cost_micro_usd) = count(*) THEN round(sum(cost_micro_usd), 1) END AS cost_micro_usd, round(avg(quality_score), 3) AS mean_quality_score,
  min(quality_score) AS minimum_quality_score, max(quality_score) AS maximum_quality_score FROM records""",
    "retry_ordinals": "SELECT conv_id, role, turn, CAST(row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS INTEGER) AS attempt, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = count(*) OVER (PARTITION BY conv_id, role) AS is_last FROM conversations",
    "failed_selection": "SELECT doc_id AS paper_id FROM labels WHERE quality = 0",
    "recovery_split": """
WITH d AS (SELECT doc_id, sha256(text) AS sha, n_chars, quality FROM documents JOIN labels USING (doc_id))
SELECT doc_id AS paper_id, CASE WHEN sha IN (SELECT sha FROM d WHERE quality = 1) THEN 'present' WHEN n_chars % 10 = 0 THEN 'missing' WHEN n_chars > 5000 THEN 'changed' ELSE 'retry' END AS action FROM d WHERE quality = 0""",
    "ledger_sequence_check": """
WITH e AS (SELECT user_id AS ledger_id, event_id AS s, dayofmonth(ts) AS r, event_type = 'purchase' AS commits FROM events),
w AS (SELECT *, row_number() OVER x AS place, lag(r) OVER x AS b, lead(r) OVER x AS nx FROM e WINDOW x AS (PARTITION BY ledger_id ORDER BY s)),
v AS (SELECT ledger_id, unnest(list_filter([CASE WHEN s <> place THEN 'gap' END, CASE WHEN r < b THEN 'revision_falls' END, CASE WHEN r > coalesce(b, 0) + 1 THEN 'revision_skips' END,
  CASE WHEN commits <> (nx IS NULL OR nx <> r) THEN 'commit_not_last' END], lambda x: x IS NOT NULL)) AS rule FROM w)
SELECT ledger_id, rule, count(*) AS n FROM v GROUP BY 1, 2""",
    "evidence_cardinality": """
WITH a AS (SELECT l_orderkey AS assertion_id, count(*) AS evidence_count, count(*) FILTER (l_linenumber > 1 AND l_returnflag <> 'R') AS more FROM lineitem GROUP BY 1)
SELECT assertion_id, evidence_count, more FROM a WHERE evidence_count <> 1 + more""",
    "bundle_manifest": f"""WITH {PAGES_SQL}, n AS (SELECT paper_id AS doc_id, count(*) AS c FROM chunks GROUP BY 1),
d AS (SELECT doc_id, source, CASE WHEN n_chars >= 2000 THEN 'long' ELSE 'short' END AS horizon, coalesce(c, 0) AS c FROM documents LEFT JOIN n USING (doc_id))
SELECT horizon, source, count(*) AS n_papers, CAST(sum(c) AS BIGINT) AS n_chunks, min(doc_id) AS least_id, sha256(string_agg('p' || doc_id || '_' || horizon, ',' ORDER BY doc_id)) AS ids_sha256 FROM d GROUP BY 1, 2""",
    "usage_merge": "SELECT user_id, event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens FROM events GROUP BY 1, 2",
}
