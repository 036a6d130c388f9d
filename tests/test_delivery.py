from evidentia.operators import delivery as D

ALIGN = "paper_id string, alignment_id string, source_type string, source_id string, source_digest string, output_ledger_digest string, alignment_policy_version string"


def rules(d):
    return {(r.rule, r.subject) for r in d.collect()}


def test_receipts(spark):
    d = spark.createDataFrame([("a", 1, 1, ["x", "y"]), ("b", 1, 2, ["x"]), ("c", 0, 0, ["y", "x"]), ("d", 0, 0, [])], "paper_id string, ledger_revision int, through_batch int, included_assertion_ids array<string>")
    assert rules(D.receipt_violations(d)) == {("revision_is_not_batch", "b"), ("assertions_not_sorted", "c")}


def test_alignments(spark):
    packets = spark.createDataFrame([("p", "d1"), ("q", "d2")], "paper_id string, packet_digest string")
    claims = spark.createDataFrame([("p", "c1"), ("p", "c2"), ("q", "c1")], "paper_id string, claim_id string")
    good = [("p", "a1", "claim", "c1", "d1", "L", "1"), ("p", "a2", "claim", "c2", "d1", "L", "1"), ("q", "a1", "claim", "c1", "d2", "M", "1")]
    assert rules(D.alignment_violations(packets, claims, spark.createDataFrame(good, ALIGN))) == set()
    bad = [("p", "a1", "claim", "c1", "d1", "L", "1"), ("p", "a1", "claim", "c1", "d9", "M", "2"), ("q", "a5", "result", "r1", "d2", "M", "1")]
    assert rules(D.alignment_violations(packets, claims, spark.createDataFrame(bad, ALIGN))) == {
        ("alignment_repeats", "p/a1"), ("packet_digest", "p/a1"), ("source_is_no_claim", "q/a5"), ("source_unknown", "q/a5"), ("claim_without_its_alignment", "p/c1"), ("claim_without_its_alignment", "p/c2"),
        ("claim_without_its_alignment", "q/c1"), ("several_ledgers", "p"), ("several_policies", "p"),
    }


def snapshot(spark, events, assertions, evidence, relations):
    return {
        "events": spark.createDataFrame(events, "sequence int, kind string, subject_id string, digest string"), "assertions": spark.createDataFrame(assertions, "assertion_id string, identity string, content string"),
        "evidence": spark.createDataFrame(evidence, "assertion_id string, evidence_key string"), "relations": spark.createDataFrame(relations, "relation_id string, digest string"),
    }


def test_successors(spark):
    one = snapshot(spark, [(1, "assertion_added", "a", "e1"), (2, "assertion_added", "b", "e2")], [("a", "i", "s"), ("b", "j", "s")], [("a", "k1"), ("b", "k1")], [("r", "x")])
    events = [(1, "assertion_added", "a", "e1"), (2, "assertion_added", "b", "e2"), (3, "assertion_evidence_added", "a", "e3"), (4, "assertion_revised", "b", "e4")]
    two = snapshot(spark, events, [("a", "i", "s"), ("b", "j", "t"), ("c", "k", "s")], [("a", "k1"), ("a", "k2"), ("b", "k1"), ("c", "k1")], [("r", "x"), ("r2", "y")])
    assert rules(D.successor_violations(one, two)) == set()
    bad = snapshot(spark, [(1, "assertion_added", "a", "other")], [("a", "changed", "t")], [("a", "k2")], [("r", "z")])
    assert rules(D.successor_violations(one, bad)) == {
        ("event_lost", "1"), ("event_lost", "2"), ("assertion_lost", "b"), ("identity_changed", "a"), ("revision_without_event", "a"), ("evidence_lost", "a/k1"), ("evidence_lost", "b/k1"), ("evidence_without_event", "a"),
        ("relation_changed", "r"),
    }
