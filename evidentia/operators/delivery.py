"""Deliveries and ledger transitions as tables of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.operators.ledger import lost_rows
from evidentia.operators.validation import repeated


def _say(d: DataFrame, rule: str, *key: str | Column) -> DataFrame:
    return d.select(F.lit(rule).alias("rule"), F.concat_ws("/", *key).alias("subject"))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def receipt_violations(receipts: DataFrame) -> DataFrame:
    """Generation receipts (paper_id, ledger_revision, through_batch, included_assertion_ids)."""
    ids = F.col("included_assertion_ids")
    return _all([
        _say(receipts.filter(F.col("ledger_revision") != F.col("through_batch")), "revision_is_not_batch", "paper_id"),
        _say(receipts.filter(~ids.eqNullSafe(F.array_sort(F.array_distinct(ids)))), "assertions_not_sorted", "paper_id"),
    ])


def alignment_violations(deliveries: DataFrame, claims: DataFrame, alignments: DataFrame) -> DataFrame:
    """(rule, subject) of ``alignments`` (paper_id, alignment_id, source_type, source_id, source_digest, output_ledger_digest, alignment_policy_version).

    ``deliveries`` has (paper_id, packet_digest), ``claims`` the packets' (paper_id, claim_id).
    Each claim has one alignment, alignments start from claims of their packet, and a
    delivery has one output ledger and one policy.
    """
    own = alignments.join(deliveries, "paper_id", "left")
    source = F.col("source_id") == F.col("claim_id")
    claimed = claims.withColumnRenamed("paper_id", "of")
    known = alignments.join(claimed, (F.col("paper_id") == F.col("of")) & source, "left_anti")
    per_claim = claimed.join(alignments.filter("source_type = 'claim'"), (F.col("paper_id") == F.col("of")) & source, "left").groupBy("of", "claim_id").agg(F.count("alignment_id").alias("n"))
    whole = alignments.groupBy("paper_id").agg(F.count_distinct("output_ledger_digest").alias("ledgers"), F.count_distinct("alignment_policy_version").alias("policies"))
    return _all([
        _say(repeated(alignments, ["paper_id", "alignment_id"]), "alignment_repeats", "paper_id", "alignment_id"),
        _say(own.filter(~F.col("source_digest").eqNullSafe(F.col("packet_digest"))), "packet_digest", "paper_id", "alignment_id"),
        _say(alignments.filter("source_type <> 'claim'"), "source_is_no_claim", "paper_id", "alignment_id"),
        _say(known, "source_unknown", "paper_id", "alignment_id"),
        _say(per_claim.filter("n <> 1"), "claim_without_its_alignment", "of", "claim_id"),
        _say(whole.filter("ledgers > 1"), "several_ledgers", "paper_id"),
        _say(whole.filter("policies > 1"), "several_policies", "paper_id"),
    ])


def successor_violations(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """(rule, subject) of what a newer snapshot changed that it mustn't.

    Snapshots have ``events`` (sequence, kind, subject_id, digest), ``assertions``
    (assertion_id, identity, content), ``evidence`` (assertion_id, evidence_key) and
    ``relations`` (relation_id, digest); identity is what an assertion says, content how.
    Events keep their beginning; identities, evidence and relations stay; new evidence
    and new content each need an event among the new ones.
    """
    new = after["events"].join(before["events"].select("sequence"), "sequence", "left_anti")
    old = before["assertions"].select("assertion_id", F.col("identity").alias("was"), F.col("content").alias("had"))
    both = after["assertions"].join(old, "assertion_id")
    revised = new.filter("kind = 'assertion_revised'").select(F.col("subject_id").alias("assertion_id"))
    added = after["evidence"].join(before["evidence"], ["assertion_id", "evidence_key"], "left_anti").join(old.select("assertion_id"), "assertion_id", "left_semi").groupBy("assertion_id").agg(F.count("*").alias("added"))
    told = new.filter("kind = 'assertion_evidence_added'").groupBy(F.col("subject_id").alias("assertion_id")).agg(F.count("*").alias("told")).join(old.select("assertion_id"), "assertion_id", "left_semi")
    uneven = added.join(told, "assertion_id", "full_outer").fillna(0, ["added", "told"]).filter("added <> told")
    return _all([
        _say(lost_rows(before["events"], after["events"], ["sequence", "digest"]), "event_lost", F.col("sequence").cast("string")),
        _say(lost_rows(before["assertions"], after["assertions"], ["assertion_id"]), "assertion_lost", "assertion_id"),
        _say(both.filter(F.col("identity") != F.col("was")), "identity_changed", "assertion_id"),
        _say(both.filter(F.col("content") != F.col("had")).join(revised, "assertion_id", "left_anti"), "revision_without_event", "assertion_id"),
        _say(lost_rows(before["evidence"], after["evidence"], ["assertion_id", "evidence_key"]), "evidence_lost", "assertion_id", "evidence_key"),
        _say(uneven, "evidence_without_event", "assertion_id"),
        _say(lost_rows(before["relations"], after["relations"], ["relation_id", "digest"]), "relation_changed", "relation_id"),
    ])
