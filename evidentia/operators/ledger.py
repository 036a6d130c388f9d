"""An append-only event ledger with revisions, checked as tables of violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sequence_violations(events: DataFrame, by: str = "ledger_id") -> DataFrame:
    """(rule, by, sequence) of ``events`` (by, sequence, revision, kind): gaps, falling or skipped revisions, commits that don't end a revision."""
    w = Window.partitionBy(by).orderBy("sequence")
    next_revision = F.lead("revision").over(w)
    d = events.withColumns({
        "__at": F.row_number().over(w), "__before": F.lag("revision").over(w), "__ends": next_revision.isNull() | (next_revision != F.col("revision")),
    })
    rules = {
        "gap": F.col("sequence") != F.col("__at"),
        "revision_falls": F.col("revision") < F.col("__before"),
        "revision_skips": F.col("revision") > F.coalesce("__before", F.lit(0)) + 1,
        "commit_not_last": (F.col("kind") == "batch_committed") != F.col("__ends"),
    }
    broken = F.filter(F.array(*(F.when(t, F.lit(n)) for n, t in rules.items())), lambda x: x.isNotNull())
    return d.select(by, "sequence", F.explode_outer(broken).alias("rule")).filter("rule is not null")


def cardinality_violations(assertions: DataFrame, events: DataFrame) -> DataFrame:
    """Assertions (assertion_id, evidence_count) that haven't one add-event, and one evidence-event for each piece of evidence but the first."""
    counts = events.groupBy("assertion_id").agg(F.count_if(F.col("kind") == "assertion_added").alias("added"), F.count_if(F.col("kind") == "evidence_added").alias("more"))
    d = assertions.join(counts, "assertion_id", "left").fillna(0, ["added", "more"])
    return d.filter((F.col("added") != 1) | (F.col("evidence_count") != 1 + F.col("more"))).select("assertion_id", "evidence_count", "added", "more")


def lost_rows(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """Rows of an older snapshot that a newer one lacks: an append-only table has none."""
    return before.join(after.select(*by), by, "left_anti")


def chain_violations(snapshots: DataFrame) -> DataFrame:
    """Snapshots (ledger_id, revision, digest, parent_digest) whose parent isn't the revision before; the first has none."""
    w = Window.partitionBy("ledger_id").orderBy("revision")
    d = snapshots.withColumns({"__digest": F.lag("digest").over(w), "__revision": F.lag("revision").over(w)})
    first = F.col("__revision").isNull()
    bad = F.when(first & ((F.col("revision") != 0) | F.col("parent_digest").isNotNull()), "genesis").when(~first & (F.col("revision") != F.col("__revision") + 1), "revision").when(
        ~first & ~F.col("parent_digest").eqNullSafe(F.col("__digest")), "parent"
    )
    return d.withColumn("rule", bad).filter("rule is not null").select("rule", "ledger_id", "revision")


def weight_violations(evidence: DataFrame) -> DataFrame:
    """Evidence (assertion_id, status, weight_ppm): accepted weighs 1,000,000 ppm, provisional 1 to 500,000."""
    good = F.when(F.col("status") == "accepted", F.col("weight_ppm") == 1_000_000).otherwise(F.col("weight_ppm").between(1, 500_000))
    return evidence.filter(~F.coalesce(good, F.lit(False)))


def endpoint_violations(relations: DataFrame, assertions: DataFrame) -> DataFrame:
    """Relations (src, dst, ...) whose ends aren't two different assertions."""
    known = assertions.select(F.col("assertion_id").alias("id"))
    lost = relations.join(known, relations["src"] == known["id"], "left_anti").unionByName(relations.join(known, relations["dst"] == known["id"], "left_anti"))
    return lost.unionByName(relations.filter("src = dst")).distinct()
