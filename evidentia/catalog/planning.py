"""Queries of chunking, classification and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions.profiles import SCIENCE, Profiles
from evidentia.functions.text import SECTIONS, namespaced, natural_key
from evidentia.operators import chunks as C
from evidentia.operators import planning as P

#: A profile of words that the tables' prose has, so that every rule is met.
PROSE = Profiles(
    domains={"clinical_trial": ("der", "die und"), "computational_biology": ("que", "de la", "los"), "wet_lab_molecular": ("les", "une", "du"), "general_method": ("the", "and", "of the", "that")},
    modes={"causal_validation": ("er", "heit"), "contrastive": ("ción", "mente"), "methodological": ("tion", "ing"), "phenomenological": ("eau", "oui")},
    general="general_method",
    fallback_mode="methodological",
    contrast=("contrastive", ("mente",)),
    intervention=("causal_validation", ("heit",)),
    generic=("in", "on"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as papers of 8-line pages."""
    return C.papers(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", C.line_pages(F.coalesce("text", F.lit(""))))


PAGES_SQL = r"""
lines AS (SELECT doc_id, sha256(coalesce(text, '')) AS source_sha256, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM documents),
raw_pages AS (SELECT doc_id, source_sha256, i // 8 + 1 AS page, trim(string_agg(line, chr(10) ORDER BY i), E' \n\t\r\f\v') AS text FROM lines GROUP BY ALL),
chunks AS (SELECT doc_id AS paper_id, source_sha256, page, text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page) AS INTEGER) AS ordinal,
                  substr(sha256(source_sha256 || ':' || page || ':' || sha256(text)), 1, 20) AS chunk_id FROM raw_pages WHERE text <> '')"""

_NORMAL = r"trim(regexp_replace(translate(replace(lower({0}), 'ß', 'ss'), '_-/;,|:()[]{{}}', '             '), '\s+', ' ', 'g'))"


def _has(text: str, signals: tuple[str, ...]) -> str:
    return " + ".join(f"CAST(contains({text}, '{P._signal(s)}') AS INTEGER)" for s in signals)


def _any(text: str, signals: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{P._signal(s)}')" for s in signals) + ")"


def _capped(text: str, signals: tuple[str, ...]) -> str:
    return " + ".join(f"least((length({text}) - length(replace({text}, '{P._signal(s)}', ''))) // {len(P._signal(s))}, 3)" for s in signals)


def plan_sql(p: Profiles, k: int = 4) -> str:
    """CTEs whole, found, classified, scored, selected for a profile."""
    special = [d for d in p.domains if d != p.general]
    best = f"greatest({', '.join(f'd_{d}' for d in special)})"
    top = f"greatest({', '.join(f'm_{m}' for m in p.modes)})"
    fallback = f"m_{p.fallback_mode}"
    first = lambda names, kind, of: "CASE " + " ".join(f"WHEN {kind}_{n} = {of} THEN '{n}'" for n in names) + " END"
    per = lambda among, key: "CASE " + " ".join(f"WHEN {key} = '{n}' THEN {_capped('t', s)}" for n, s in among.items()) + " END"
    return f"""{PAGES_SQL},
whole AS (SELECT paper_id, {_NORMAL.format("string_agg(text, chr(10) ORDER BY ordinal)")} AS t FROM chunks GROUP BY paper_id
          UNION ALL SELECT doc_id, '' FROM documents WHERE doc_id NOT IN (SELECT paper_id FROM chunks)),
found AS (SELECT paper_id, {', '.join(f'{_has("t", s)} AS d_{d}' for d, s in p.domains.items())}, {', '.join(f'{_has("t", s)} AS m_{m}' for m, s in p.modes.items())},
                 {_any("t", p.contrast[1])} AS contrasts, {_any("t", p.intervention[1])} AS intervenes FROM whole),
domains AS (SELECT *, CASE WHEN {best} = 0 OR d_{p.general} > 2 * {best} THEN '{p.general}' ELSE {first(special, 'd', best)} END AS domain FROM found),
classified AS (SELECT *, CASE WHEN contrasts THEN '{p.contrast[0]}' WHEN intervenes THEN '{p.intervention[0]}'
                              WHEN domain = '{p.general}' AND {fallback} >= {top} THEN '{p.fallback_mode}' WHEN {top} = 0 THEN '{p.fallback_mode}' ELSE {first(p.modes, 'm', top)} END AS mode FROM domains),
normal AS (SELECT paper_id, chunk_id, ordinal, domain, mode, {_NORMAL.format("text")} AS t FROM chunks JOIN classified USING (paper_id)),
scored AS (SELECT paper_id, chunk_id, ordinal, CAST(CASE WHEN starts_with(t, 'references ') THEN -1000 ELSE 2 * ({per(p.domains, 'domain')}) + 4 * ({per(p.modes, 'mode')}) + {_capped('t', p.generic)} END AS INTEGER) AS score FROM normal),
selected AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY ordinal = 1 DESC, score DESC, ordinal) <= {k})"""


def chunk_ids(spark, sf_dir):
    return C.chunk_rows(papers(spark, sf_dir)).select("paper_id", "chunk_id", "ordinal", "page_start", "char_count", "token_estimate", "content_sha256")


def section_hints(spark, sf_dir):
    return C.chunk_rows(papers(spark, sf_dir)).groupBy("section_hint").agg(F.count("*").alias("n_chunks"), F.sum("char_count").alias("n_chars"))


def duplicate_inputs(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    return d.groupBy("sha").agg(F.count("*").alias("n"), F.min("doc_id").alias("least_id")).filter("n > 1")


def safe_paper_ids(spark, sf_dir):
    d = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[?#].*$", "").alias("path"))
    return C.paper_ids(d).select("page_id", "paper_id")


def signal_scores(spark, sf_dir):
    d = P.classify(papers(spark, sf_dir), PROSE)
    scores = F.map_concat("classification.domain_scores", "classification.mode_scores")
    return d.select("paper_id", F.explode_outer(scores).alias("profile", "score"))


def _classified(spark, sf_dir, p):
    return P.classify(papers(spark, sf_dir), p).select("paper_id", "classification.domain", "classification.mode")


def _selected(spark, sf_dir, p):
    return P.selected_rows(P.plan(papers(spark, sf_dir), p)).select("paper_id", "chunk_id", "ordinal", "score")


def chunk_scores(spark, sf_dir):
    d = P.scored(P.classify(papers(spark, sf_dir), PROSE), PROSE)
    return C.unnest(d, F.transform("scores", lambda s, i: F.struct((i + 1).alias("ordinal"), s.alias("score"))), "ordinal")


def coverage_ledger(spark, sf_dir):
    return P.coverage(P.plan(papers(spark, sf_dir), PROSE))


def coverage_counts(spark, sf_dir):
    d = P.coverage(P.plan(papers(spark, sf_dir), PROSE))
    return d.groupBy("paper_id").agg(F.count_if(F.col("status") == "extracted").alias("extracted"), F.count_if(F.col("status") == "not_selected").alias("not_selected"))


def namespace_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", namespaced(F.concat(F.lit("p"), F.col("doc_id").cast("string")), F.when(F.col("n_chars") >= 2000, "long").otherwise("short")).alias("paper_id"))


def natural_order(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n_papers"))
    return d.select("source", "n_papers", natural_key(F.col("source"), 3).alias("key")).withColumn("key", F.regexp_replace("key", "[\u0001￿]", ""))


_HINTS = "CASE " + " ".join(f"WHEN contains(head, '{s}') THEN '{s}'" for s in SECTIONS) + " ELSE 'page' END"
_SCORES = ", ".join(f"('{n}', {k}_{n})" for k, among in (("d", PROSE.domains), ("m", PROSE.modes)) for n in among)

QUERIES = {
    "selected_chunks": lambda s, d: _selected(s, d, PROSE),
    "selected_chunks_science": lambda s, d: _selected(s, d, SCIENCE),
    "chunk_ids": chunk_ids,
    "section_hint": section_hints,
    "duplicate_inputs": duplicate_inputs,
    "safe_paper_ids": safe_paper_ids,
    "signal_scores": signal_scores,
    "classify": lambda s, d: _classified(s, d, PROSE),
    "classify_science": lambda s, d: _classified(s, d, SCIENCE),
    "chunk_scores": chunk_scores,
    "coverage_ledger": coverage_ledger,
    "coverage_counts": coverage_counts,
    "namespace_ids": namespace_ids,
    "natural_order": natural_order,
}

ORACLE_SQL = {
    "selected_chunks": f"WITH {plan_sql(PROSE)} SELECT paper_id, chunk_id, ordinal, score FROM selected",
    "selected_chunks_science": f"WITH {plan_sql(SCIENCE)} SELECT paper_id, chunk_id, ordinal, score FROM selected",
    "chunk_ids": f"WITH {PAGES_SQL} SELECT paper_id, chunk_id, ordinal, CAST(page AS INTEGER) AS page_start, CAST(length(text) AS INTEGER) AS char_count, CAST(greatest(1, (length(text) + 3) // 4) AS INTEGER) AS token_estimate, sha256(text) AS content_sha256 FROM chunks",
    "section_hint": f"WITH {PAGES_SQL}, heads AS (SELECT text, replace(lower(substr(text, 1, 500)), 'ß', 'ss') AS head FROM chunks) SELECT {_HINTS} AS section_hint, count(*) AS n_chunks, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM heads GROUP BY 1",
    "duplicate_inputs": "SELECT sha256(coalesce(text, '')) AS sha, count(*) AS n, min(doc_id) AS least_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "safe_paper_ids": r"""
WITH p AS (SELECT page_id, regexp_replace(coalesce(url, ''), '[?#].*$', '') AS path FROM pages),
s AS (SELECT page_id, path, regexp_replace(string_split(path, '/')[-1], '^(.+)\.[^.]*$', '\1') AS stem FROM p),
b AS (SELECT page_id, path, coalesce(nullif(regexp_replace(regexp_replace(stem, '[^A-Za-z0-9._-]+', '-', 'g'), '^[-._]+|[-._]+$', '', 'g'), ''), 'paper') AS base FROM s)
SELECT page_id, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN base || '-' || substr(sha256(path), 1, 8) ELSE base END AS paper_id FROM b""",
    "signal_scores": f"WITH {plan_sql(PROSE)} SELECT paper_id, x.profile, CAST(x.score AS INTEGER) AS score FROM (SELECT paper_id, unnest([{', '.join('{' + f'profile: {a}, score: {b}' + '}' for a, b in (s.strip('()').split(', ') for s in _SCORES.split('), (')))}]) AS x FROM found)",
    "classify": f"WITH {plan_sql(PROSE)} SELECT paper_id, domain, mode FROM classified",
    "classify_science": f"WITH {plan_sql(SCIENCE)} SELECT paper_id, domain, mode FROM classified",
    "chunk_scores": f"WITH {plan_sql(PROSE)} SELECT paper_id, ordinal, score FROM scored",
    "coverage_ledger": f"WITH {plan_sql(PROSE)} SELECT c.paper_id, c.chunk_id, CASE WHEN s.ordinal IS NULL THEN 'not_selected' ELSE 'extracted' END AS status FROM chunks c LEFT JOIN selected s ON c.paper_id = s.paper_id AND c.ordinal = s.ordinal",
    "coverage_counts": f"WITH {plan_sql(PROSE)} SELECT c.paper_id, count(s.ordinal) AS extracted, count(*) - count(s.ordinal) AS not_selected FROM chunks c LEFT JOIN selected s ON c.paper_id = s.paper_id AND c.ordinal = s.ordinal GROUP BY 1",
    "namespace_ids": "SELECT doc_id, 'p' || doc_id || CASE WHEN n_chars >= 2000 THEN '_long' ELSE '_short' END AS paper_id FROM documents",
    "natural_order": r"SELECT source, count(*) AS n_papers, regexp_extract(source, '^\D*') || lpad(regexp_extract(source, '\d+'), 3, '0') AS key FROM documents GROUP BY source",
}
