"""Failed papers of a run: which to try again, which are delivered, which sources changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def failed(records: DataFrame, requested: list[str] | None = None) -> DataFrame:
    """Failed records; ``requested`` ids must all be among them."""
    d = records.filter(F.col("status") == "failed")
    if requested is not None:
        wanted = records.sparkSession.createDataFrame([(x,) for x in requested], "paper_id string")
        unknown = [r[0] for r in wanted.join(d, "paper_id", "left_anti").limit(10).collect()]
        if unknown:
            raise ValueError(f"not failed in the report: {sorted(unknown)}")
        d = d.join(wanted.distinct(), "paper_id", "left_semi")
    return d


def split(failed_: DataFrame, inputs: DataFrame, delivered: DataFrame, allow_change: bool = False) -> DataFrame:
    """``failed_`` (paper_id, source_sha256) with action: retry, present, missing or changed.

    ``inputs`` (paper_id, source_sha256) are the sources now; ``delivered`` (paper_id) what
    has a packet already.  A changed source is an error to the caller unless allowed.
    """
    now = inputs.select("paper_id", F.col("source_sha256").alias("sha_now"))
    d = failed_.join(now, "paper_id", "left").join(delivered.select("paper_id").distinct().withColumn("there", F.lit(True)), "paper_id", "left")
    drift = F.lit(False) if allow_change else F.col("source_sha256") != F.col("sha_now")
    action = F.when(F.col("there"), "present").when(F.col("sha_now").isNull(), "missing").when(drift, "changed").otherwise("retry")
    return d.withColumn("action", action).drop("there")


def append_new(new: DataFrame, delivered: DataFrame) -> DataFrame:
    """What may be added: rows of ``new`` that ``delivered`` doesn't have, so nothing is overwritten."""
    return new.join(delivered.select("paper_id", "source_sha256"), ["paper_id", "source_sha256"], "left_anti")
