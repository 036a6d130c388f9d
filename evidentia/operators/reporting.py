"""Telemetry of model calls rolled up to stages, papers and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pricing(input_usd: float | None = None, output_usd: float | None = None, as_of: str | None = None) -> tuple[float | None, float | None]:
    """Prices for a million tokens: both or none, and a date with them."""
    if (input_usd is None) != (output_usd is None):
        raise ValueError("give both prices or none")
    if (input_usd is None) != (as_of is None):
        raise ValueError("prices need their date, and a date needs prices")
    return input_usd, output_usd


def usage_value(usage: Column, name: str, other: str) -> Column:
    """A count from a usage map, under either of its names; 0 if neither is there."""
    return F.coalesce(F.try_element_at(usage, F.lit(name)), F.try_element_at(usage, F.lit(other)), F.lit(0)).cast("long")


def merged_usage(calls: DataFrame, by: list[str], usage: str = "usage") -> DataFrame:
    """Usage maps summed by key."""
    each = calls.select(*by, F.explode(usage).alias("k", "v")).groupBy(*by, "k").agg(F.sum("v").alias("v"))
    return each.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(usage))


def estimated_cost(prompt: Column, completion: Column, input_usd: float | None, output_usd: float | None) -> Column:
    if input_usd is None:
        return F.lit(None).cast("double")
    return F.round(prompt * input_usd / 1_000_000 + completion * output_usd / 1_000_000, 8)


def stage_metrics(calls: DataFrame, by: list[str], input_usd: float | None = None, output_usd: float | None = None) -> DataFrame:
    """Calls (by, prompt_tokens, completion_tokens, latency_seconds, usage_complete) summed to stages.  The total is prompt plus completion."""
    d = calls.groupBy(*by).agg(
        F.count("*").alias("attempts"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"),
        F.bool_and("usage_complete").alias("usage_complete"), F.round(F.sum("latency_seconds"), 6).alias("latency_seconds"),
    )
    total = F.col("prompt_tokens") + F.col("completion_tokens")
    return d.withColumns({"total_tokens": total, "estimated_cost_usd": estimated_cost(F.col("prompt_tokens"), F.col("completion_tokens"), input_usd, output_usd)})


def strict_sum(c: str, places: int = 8) -> Column:
    """A sum that is null if any value is, or if there is none."""
    return F.when((F.count(c) == F.count("*")) & (F.count("*") > 0), F.round(F.sum(c), places))


_SUMS = ("prompt_tokens", "completion_tokens", "total_tokens")


def records(stages: DataFrame, papers: DataFrame) -> DataFrame:
    """Stages (paper_id, ...) summed to ``papers`` (paper_id, ...): a paper without stages has zeros, complete usage, and no cost."""
    d = stages.groupBy("paper_id").agg(
        *(F.sum(c).alias(f"total_{c}" if c != "total_tokens" else c) for c in _SUMS), F.bool_and("usage_complete").alias("usage_complete"),
        F.round(F.sum("latency_seconds"), 6).alias("total_latency_seconds"), strict_sum("estimated_cost_usd").alias("estimated_cost_usd"),
    )
    return papers.join(d, "paper_id", "left").fillna(0, ["total_prompt_tokens", "total_completion_tokens", "total_tokens"]).fillna(0.0, ["total_latency_seconds"]).fillna(True, ["usage_complete"])


def totals(records_: DataFrame, input_usd: float | None = None, output_usd: float | None = None) -> DataFrame:
    """Records of extraction and judging, without packets, with the columns of a report: both stages' usage, latency and cost added up."""
    both = lambda c: F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"judge_{c}"), F.lit(0))
    cost = lambda stage: estimated_cost(F.col(f"{stage}prompt_tokens"), F.col(f"{stage}completion_tokens"), input_usd, output_usd)
    return records_.drop("packet").withColumns({
        "quality_score": F.col("f1"), "total_prompt_tokens": both("prompt_tokens"), "total_completion_tokens": both("completion_tokens"), "total_tokens": both("prompt_tokens") + both("completion_tokens"),
        "estimated_cost_usd": F.round(cost("") + cost("judge_"), 8), "usage_complete": F.coalesce("usage_complete", F.lit(True)) & F.coalesce("judge_usage_complete", F.lit(True)),
        "total_latency_seconds": F.round(both("latency_seconds"), 6),
    })


def run_summary(records_: DataFrame) -> DataFrame:
    """One row over all records (status, quality_score, totals)."""
    score = F.col("quality_score")
    return records_.agg(
        F.count("*").alias("input_count"), F.count_if(F.col("status") == "succeeded").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_prompt_tokens", "total_completion_tokens", "total_tokens")),
        F.coalesce(F.bool_and("usage_complete"), F.lit(True)).alias("usage_complete"), (~F.coalesce(F.bool_and("usage_complete"), F.lit(True))).alias("estimated_cost_is_lower_bound"),
        F.round(F.coalesce(F.sum("total_latency_seconds"), F.lit(0.0)), 6).alias("total_latency_seconds"), strict_sum("estimated_cost_usd").alias("estimated_cost_usd"),
        F.bround(F.avg(score), 4).alias("mean_quality_score"), F.min(score).alias("minimum_quality_score"), F.max(score).alias("maximum_quality_score"),
    )


def attempts(calls: DataFrame, by: list[str], order: str) -> DataFrame:
    """``calls`` with attempt (from 1) and is_last within each stage."""
    w = Window.partitionBy(*by)
    return calls.withColumn("attempt", F.row_number().over(w.orderBy(order))).withColumn("is_last", F.col("attempt") == F.count("*").over(w))


#: Columns of the papers table of a report, in order (fixed values).
REPORT_COLUMNS = (
    "paper_id", "status", "quality_score", "precision", "recall", "deterministic_rule_score", "incorrect_item_count", "missed_core_item_count", "total_prompt_tokens", "total_completion_tokens", "total_tokens",
    "estimated_cost_usd", "usage_complete", "total_latency_seconds", "output_file", "error_type", "error_message",
)
