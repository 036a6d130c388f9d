"""A failed run tried again: only its failed papers, only where sources are what they were, nothing overwritten."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators import planning, recovery
from evidentia.plans import extraction
from evidentia.sources import sinks
from evidentia.sources.shared import stored

#: A second run reads more and tries longer (fixed values).
MAX_CHUNKS, RETRIES = 8, 3


def packets_in(spark: SparkSession, folder: str) -> DataFrame:
    """(value, paper_id) of delivered packets; ids of digits stay texts."""
    return spark.read.schema("value string, paper_id string").option("basePath", folder).text(folder)


def require_same(got: DataFrame, asked: DataFrame) -> None:
    """Raises ValueError unless both have the same paper ids."""
    odd = [r[0] for r in got.exceptAll(asked).unionByName(asked.exceptAll(got)).limit(10).collect()]
    if odd:
        raise ValueError(f"papers tried again differ from those asked for: {sorted(odd)}")


def recover(
    spark: SparkSession, report: str, papers: DataFrame, delivery: str, audit: str, make_provider: Callable[[], extraction.Provider], requested: list[str] | None = None, allow_change: bool = False,
    options: extraction.Options = extraction.Options(retries=RETRIES),
) -> dict:
    """Failed papers of ``report`` (JSON lines with paper_id, status, source_sha256) extracted again from ``papers``.

    Packets that pass are added to ``delivery``; papers that are there already are left
    alone.  A source that changed or is missing is a ValueError unless allowed (a missing
    one always).  ``audit`` gets one JSON row a paper.  The result counts papers by outcome
    and says ``no-op``, ``completed`` or ``partial``.
    """
    sinks.require_apart(delivery, audit)
    sinks.require_empty(spark, audit)
    records = spark.read.schema("paper_id string, status string, source_sha256 string").json(report)
    fs, path = sinks._fs(spark, delivery)
    there = packets_in(spark, delivery).select("paper_id").distinct() if fs.exists(path) and len(fs.listStatus(path)) else spark.createDataFrame([], "paper_id string")
    now = papers.select(F.col("paper_id").cast("string").alias("paper_id"), "source_sha256")
    todo = recovery.split(recovery.failed(records, requested), now, there, allow_change).cache()
    bad = todo.filter(F.col("action").isin("changed", "missing")).select("paper_id", "action").limit(10).collect()
    if bad:
        raise ValueError(f"sources differ from the report's: {[(r.paper_id, r.action) for r in bad]}")
    again = papers.withColumn("paper_id", F.col("paper_id").cast("string")).join(todo.filter("action = 'retry'").select("paper_id"), "paper_id", "left_semi")
    done = extraction.run(planning.plan(again, max_chunks=MAX_CHUNKS), make_provider, o=options)
    good = sinks.delivered(sinks.packets(done.filter("status = 'succeeded'")))
    good = stored(good.select("paper_id", F.to_json(F.struct(*good.columns)).alias("value")), "recovered")
    require_same(done.select("paper_id"), todo.filter("action = 'retry'").select("paper_id"))
    outcome = todo.filter("action = 'present'").select("paper_id", F.lit("present").alias("outcome"), F.lit(None).cast("string").alias("error_message"))
    outcome = outcome.unionByName(done.select("paper_id", F.when(F.col("status") == "succeeded", "recovered").otherwise("failed").alias("outcome"), "error_message"))

    def write(folder: str) -> None:
        # the audit comes first: adding to the delivery makes Spark forget what it kept of it
        outcome.write.json(f"{folder}/papers")
        if good.limit(1).count():
            good.write.mode("append").partitionBy("paper_id").text(delivery)
            there_now = packets_in(spark, delivery).join(good.select("paper_id"), "paper_id", "left_semi")
            bad = there_now.withColumn("p", F.from_json("value", "paper_id string, schema_version string")).filter("p.paper_id is null or p.paper_id <> paper_id or p.schema_version is null")
            if bad.limit(1).count() or there_now.count() != good.count():
                raise ValueError("the delivery doesn't hold what was recovered")

    sinks.publish(spark, audit, write)
    told = spark.read.schema("paper_id string, outcome string, error_message string").json(f"{audit}/papers")
    n = {r["outcome"]: r["count"] for r in told.groupBy("outcome").count().collect()}
    status = "partial" if n.get("failed") else "completed" if n.get("recovered") else "no-op"
    return {"status": status, **n}
