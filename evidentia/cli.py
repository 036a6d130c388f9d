"""Commands: extract packets from a folder of PDFs, export evidence bundles, recover a failed run."""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _number(kind: type, low: float | None = None, high: float | None = None) -> Callable[[str], float]:
    def parse(text: str) -> float:
        x = kind(text)
        if low is not None and x < low or high is not None and x > high:
            raise argparse.ArgumentTypeError(f"{text} is out of range")
        return x

    return parse


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="evidentia", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    x = commands.add_parser("extract-paper-study")
    x.add_argument("--paper-folder", required=True)
    x.add_argument("--index")
    x.add_argument("--output-folder")
    x.add_argument("--report-folder")
    x.add_argument("--provider", required=True, help="module:callable that makes a provider on an executor")
    x.add_argument("--max-chunks", type=_number(int, 1), default=4)
    x.add_argument("--max-tokens", type=_number(int, 1), default=16_000)
    x.add_argument("--validation-retries", type=_number(int, 0), default=1)
    x.add_argument("--minimum-quality-score", type=_number(float, 0, 1), default=0.6)
    x.add_argument("--input-usd-per-million-tokens", type=_number(float, 0))
    x.add_argument("--output-usd-per-million-tokens", type=_number(float, 0))
    x.add_argument("--pricing-as-of")
    e = commands.add_parser("export-ablation-evidence")
    for name in ("--corpus-root", "--packets-root", "--output-folder"):
        e.add_argument(name, required=True)
    e.add_argument("--horizon", choices=("long", "short"))
    e.add_argument("--group")
    e.add_argument("--paper-id")
    r = commands.add_parser("recover-failed")
    for name in ("--source-report", "--paper-folder", "--delivery-folder", "--audit-folder", "--provider"):
        r.add_argument(name, required=True)
    r.add_argument("--paper-id", action="append")
    r.add_argument("--allow-source-change", action="store_true")
    r.add_argument("--validation-retries", type=_number(int, 0), default=3)
    return p


def _provider(name: str) -> Callable:
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def extract(spark: SparkSession, a: argparse.Namespace) -> int:
    from evidentia.operators import chunks, planning, reporting
    from evidentia.operators.validation import repeated, require_empty
    from evidentia.plans import extraction, ingestion
    from evidentia.sources import inputs, shared, sinks

    began = datetime.now(UTC)
    prices = reporting.pricing(a.input_usd_per_million_tokens, a.output_usd_per_million_tokens, a.pricing_as_of)
    out = a.output_folder or f"{a.paper_folder.rstrip('/')}/{inputs.STATE_FOLDER}/paper-study-2.2"
    report = a.report_folder or f"{out.rstrip('/')}-report"
    sinks.require_apart(out, report)
    for folder in (out, report):
        sinks.require_empty(spark, folder)
    if a.index:
        entries = inputs.discover(spark, a.paper_folder, a.index)
        papers = inputs.artifact_papers(inputs.artifacts(spark, [r[0] for r in entries.select("source_path").collect()]))
    else:
        papers = inputs.artifact_papers(ingestion.ingest(spark, a.paper_folder))
    make = _provider(a.provider)
    o = extraction.Options(a.validation_retries, a.max_tokens, a.minimum_quality_score)
    require_empty(repeated(papers, ["paper_id"]), "paper ids repeat")
    require_empty(chunks.violations(papers).select("rule", "paper_id"), "chunks break rules")
    planned = planning.plan(papers, max_chunks=a.max_chunks)
    try:
        records = extraction.run(planned, make, o=o)
        about = planned.select(
            F.col("paper_id").cast("string").alias("paper_id"), "source_sha256", F.array_max(F.transform("chunks", lambda c: c["page_end"])).alias("pages"), F.size("chunks").alias("source_chunks"),
            F.size("selected").alias("selected_chunks"),
        )
        r = reporting.totals(records, *prices).join(about, "paper_id", "left")
        r = r.withColumn("output_file", F.when(F.col("status") == "succeeded", F.concat(F.lit(f"{out.rstrip('/')}/paper_id="), "paper_id")))
        sinks.publish(spark, out, lambda folder: sinks.write_packets(sinks.packets(records.filter("status = 'succeeded'")), folder))
        summary = reporting.run_summary(r).withColumns({
            "started_at": F.lit(began.isoformat()), "completed_at": F.lit(datetime.now(UTC).isoformat()), "input_folder": F.lit(a.paper_folder), "output_folder": F.lit(out), "report_folder": F.lit(report),
        })
        sinks.write_report(r, summary, report, planned)
        return int(r.filter(F.col("status") == "failed").limit(1).count() > 0)
    finally:
        shared.clear(spark)


def export(spark: SparkSession, a: argparse.Namespace) -> int:
    from evidentia.plans import export as plan

    if a.group and not a.horizon or a.paper_id and not a.group:
        raise ValueError("--group needs --horizon, and --paper-id needs --group")
    plan.export(spark, a.corpus_root, a.packets_root, a.output_folder, a.horizon, a.group, a.paper_id)
    return 0


def recover(spark: SparkSession, a: argparse.Namespace) -> int:
    from evidentia.plans import extraction, recovery
    from evidentia.sources import inputs

    papers = inputs.pdf_papers(spark, a.paper_folder)
    out = recovery.recover(spark, a.source_report, papers, a.delivery_folder, a.audit_folder, _provider(a.provider), a.paper_id, a.allow_source_change, extraction.Options(a.validation_retries))
    print(out)
    return int(out["status"] == "partial")


def main(argv: list[str] | None = None) -> int:
    """0: done; 1: some papers failed; 2: wrong use or input."""
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("evidentia").getOrCreate()
    try:
        return {"extract-paper-study": extract, "export-ablation-evidence": export, "recover-failed": recover}[a.command](spark, a)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
