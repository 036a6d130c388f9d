import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from evidentia import cli
from evidentia.operators import chunks, planning
from evidentia.plans import export, recovery
from evidentia.plans import extraction as X
from evidentia.sources import inputs, sinks
from evidentia.streaming import ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests

TEXT = "Results. The treatment raised the reading from 1 to 2 in all samples."


def prov(chunk, **changes):
    return {"chunk_id": chunk, "page_start": 1, "page_end": 1, "text_excerpt": "raised the reading from 1 to 2", "paraphrased": False} | changes


def answer(chunk, **changes):
    unit = {
        "unit_id": "U1", "name": changes.pop("name", "trial"), "experiments_or_tasks": ["t"], "datasets": [], "methods": changes.pop("methods", []),
        "results": [{"result_id": i, "metric_name": "m", "value_raw_text": "2", "provenance": prov(chunk, **changes)} for i in changes.pop("results", ["R1"])],
        "claims": [{"claim_id": "C1", "statement": "s", "polarity": "positive", "inference_basis_ids": ["R1"], "provenance": prov(chunk)}], "evidence_spans": [],
    }
    return {"research_questions": [{"question_id": "Q1", "statement": "q", "study_units": [unit]}], "limitations_and_boundaries": ["b"]}


class Fake:
    name, model = "fake", "fake-1"

    def __init__(self, *steps, verdicts=({"incorrect_items": [], "missed_core_items": []},)):
        self.steps, self.verdicts, self.asked = list(steps), list(verdicts), []

    def complete_json(self, system, user, max_tokens):
        self.asked.append(user)
        step = (self.verdicts if system == X.JUDGE_SYSTEM else self.steps).pop(0)
        if isinstance(step, Exception):
            raise step
        return X.Completion(step, {"prompt_tokens": 10, "completion_tokens": 5})


CHUNKS = [{"chunk_id": "c1", "ordinal": 1, "page_start": 1, "page_end": 1, "text": TEXT}]


def go(provider, retries=1):
    return X.one_paper(provider, "p", CHUNKS, [1], "focus", ("a",), X.Options(retries))


def test_accepted():
    r = go(Fake(answer("c1")))
    assert (r["status"], r["f1"], r["attempts"], r["prompt_tokens"]) == ("succeeded", 1.0, 1, 10)
    assert json.loads(r["packet"])["status"] == "accepted"


def test_repair_makes_it_provisional():
    p = json.loads(go(Fake(answer("c1", text_excerpt="quite unlike it", methods=[{"method_id": "M"}, {"method_id": "M"}])))["packet"])
    assert p["status"] == "provisional" and {w["code"].rpartition(".")[2] for w in p["validation_warnings"]} == {"duplicate_method_id_renamed", "provenance_paraphrase_corrected"}


def test_wrong_answer_gets_a_repair_prompt():
    f = Fake(answer("c9"), answer("c1"))
    assert go(f)["status"] == "succeeded" and "unknown chunk" in f.asked[1]


def test_provider_trouble_repeats_the_prompt():
    f = Fake(X.ProviderError("empty", {"prompt_tokens": 1}), answer("c1"))
    r = go(f)
    assert r["status"] == "succeeded" and f.asked[0] == f.asked[1] and r["prompt_tokens"] == 11
    assert go(Fake(X.ProviderError("a"), X.ProviderError("b")))["error_type"] == "provider"
    assert go(Fake(X.ProviderError("no", retryable=False)))["error_type"] == "ProviderError"


def test_clashing_ids_fall_back_to_a_flat_packet():
    twice = answer("c1", results=["R1", "R1"])
    r = go(Fake(twice, twice, answer("c1", name=X.FLAT_UNIT)))
    assert r["attempts"] == 3 and "flat_fallback" in r["packet"]
    assert go(Fake(twice, answer("c9")))["error_type"] == "validation"


def test_judge():
    bad = {"incorrect_items": [{"item_id": "nope"}], "missed_core_items": []}
    good = {"incorrect_items": [{"item_id": "claim:U1:C1"}], "missed_core_items": [{"item_id": None, "reason": "r", "source_chunk_id": "c1", "source_excerpt": "not there"}]}
    s = X.judge(Fake(verdicts=[bad, good]), answer("c1"), CHUNKS, X.Options())
    assert (s["extracted"], s["incorrect"], s["missed"], s["precision"], s["recall"], s["f1"]) == (5, 1, 1, 0.8, 0.8, 0.8) and s["missed_core_items"][0]["source_excerpt_verified"] is False
    assert go(Fake(answer("c1"), verdicts=[bad, bad]))["error_type"] == "judge"
    low = {"incorrect_items": [{"item_id": i} for i in X.items(answer("c1"))], "missed_core_items": []}
    assert go(Fake(answer("c1"), verdicts=[low]))["error_type"] == "quality"


class ByChunk:
    """Answers for whatever chunk it is shown; fails on one text."""

    name, model = "fake", "fake-1"

    def complete_json(self, system, user, max_tokens):
        if system == X.JUDGE_SYSTEM:
            return X.Completion({"incorrect_items": [], "missed_core_items": []}, {"prompt_tokens": 1})
        c = json.loads(user)["chunks"][0]
        if "poison" in c["text"]:
            raise RuntimeError("broken")
        return X.Completion(answer(c["chunk_id"]), {"prompt_tokens": 10})


def test_judge_usage_counts_whatever_comes_of_it():
    bad = {"incorrect_items": [{"item_id": "nope"}], "missed_core_items": []}
    r = go(Fake(answer("c1"), verdicts=[X.ProviderError("busy", {"prompt_tokens": 3}), bad]))
    assert (r["status"], r["error_type"], r["judge_attempts"], r["judge_prompt_tokens"], r["judge_completion_tokens"], r["attempts"]) == ("failed", "judge", 2, 13, 5, 1)
    assert go(Fake(answer("c1"), verdicts=[X.ProviderError("busy"), {}]))["judge_usage_complete"] is False


class Twice:
    """States one result and claim twice, under other ids; the judge must be shown canonical ids, each once."""

    name, model = "fake", "fake-1"

    def complete_json(self, system, user, max_tokens):
        if system == X.JUDGE_SYSTEM:
            kinds = sorted(i.partition(":")[0] + ":" + i.rpartition(":")[2].partition("_")[0] for i in json.loads(user)["items"])
            assert kinds == ["boundary:1", "claim:clm", "question:Q1", "result:res", "task:1"] or kinds[0] == "boundary:1" and "boundary:2" in kinds, kinds
            return X.Completion({"incorrect_items": [], "missed_core_items": []}, {"prompt_tokens": 7, "completion_tokens": 2})
        chunk = json.loads(user)["chunks"][0]["chunk_id"]
        a = answer(chunk, results=["R1", "R2"])
        claims = a["research_questions"][0]["study_units"][0]["claims"]
        claims.append(claims[0] | {"claim_id": "C2", "inference_basis_ids": ["R2"]})
        return X.Completion(a, {"prompt_tokens": 10, "completion_tokens": 5})


def test_the_judged_packet_is_canonical_and_scored(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "007.pdf").write_bytes(pdf(TEXT))
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    a = cli.parser().parse_args(["extract-paper-study", "--paper-folder", str(tmp_path / "in"), "--output-folder", out, "--report-folder", report, "--provider", f"{__name__}:Twice"])
    assert cli.extract(spark, a) == 0
    r = spark.read.json(f"{report}/papers_jsonl").first()
    assert (r.paper_id, r.attempts, r.judge_attempts, r.total_prompt_tokens, r.total_completion_tokens, r.total_tokens, r.usage_complete) == ("007", 1, 1, 17, 7, 24, True)
    assert 0 < r.deterministic_rule_score <= 1 and (r.incorrect_item_count, r.missed_core_item_count, r.source_chunks, r.selected_chunks) == (0, 0, 1, 1) and r.output_file == f"{out}/paper_id=007"
    s = spark.read.json(f"{report}/summary").first()
    assert s.started_at < s.completed_at and s.total_tokens == 24
    assert spark.read.json(f"{report}/plans").first().selected_ordinals == [1]
    packet = json.loads(recovery.packets_in(spark, out).first().value)
    unit = packet["research_questions"][0]["study_units"][0]
    assert not {"status", "requires_reconciliation", "merge_decisions"} & set(packet) and packet["quality_assessment"]["deterministic_rule_score"] == r.deterministic_rule_score
    assert unit["unit_id"].startswith("su_") and [x["result_id"][:4] for x in unit["results"]] == ["res_"] and [x["claim_id"][:4] for x in unit["claims"]] == ["clm_"]
    assert unit["claims"][0]["inference_basis_ids"] == [unit["results"][0]["result_id"]]


def test_a_causal_paper_without_rescue_is_noted(spark):
    from evidentia.operators import merging

    d = spark.createDataFrame([("a", TEXT)], "id string, text string")
    planned = planning.plan(chunks.papers(d, "id", "text", chunks.line_pages(F.col("text"))))
    causal = planned.withColumn("classification", F.col("classification").withField("mode", F.lit("causal_validation")))
    notes = [json.loads(X.run(p, ByChunk).first().packet)["limitations_and_boundaries"] for p in (causal, planned)]
    assert notes == [["b", merging.NO_RESCUE], ["b"]]


def test_papers_fail_alone(spark):
    d = spark.createDataFrame([("a", TEXT), ("b", "poison")], "id string, text string")
    planned = planning.plan(chunks.papers(d, "id", "text", chunks.line_pages(F.col("text"))))
    r = {x.paper_id: x for x in X.run(planned, ByChunk).collect()}
    assert (r["a"].status, r["b"].status, r["b"].error_type) == ("succeeded", "failed", "RuntimeError")


def test_index_entries():
    got = inputs.index_entries({"papers": [{"id": "b", "path": "x/b.json", "metadata": {"year": 2020, "n": None}}, "x/A.json"]})
    assert [(e["paper_id"], e["metadata"]) for e in got] == [("A", {}), ("b", {"year": "2020"})]
    for bad in ({}, {"papers": [], "items": []}, [], [{}], [1], [{"path": "a", "metadata": 1}], ["a.json", "b/a.json"], 3):
        with pytest.raises(ValueError):
            inputs.index_entries(bad)


def pdf(*pages):
    out = b"%PDF-1.4\n"
    for i, text in enumerate(pages):
        body = b"BT /F1 12 Tf (" + text.encode() + b") Tj ET" if text else b"BT ET"
        out += b"%d 0 obj << /Length %d >>\nstream\n" % (i + 4, len(body)) + body + b"\nendstream endobj\n"
    return out + b"%%EOF"


def test_pdf_folder(spark, tmp_path):
    (tmp_path / "sub" / ".evidentia").mkdir(parents=True)
    (tmp_path / "Paper One.pdf").write_bytes(pdf("Abstract of it", "", "second (page)".replace("(", r"\(").replace(")", r"\)")))
    (tmp_path / "sub" / ".evidentia" / "x.pdf").write_bytes(pdf("hidden"))
    rows = chunks.chunk_rows(inputs.pdf_papers(spark, str(tmp_path))).orderBy("ordinal").collect()
    assert [(r.paper_id, r.page_start, r.text, r.section_hint) for r in rows] == [("Paper-One", 1, "Abstract of it", "abstract"), ("Paper-One", 3, "second (page)", "page")]


def test_discover(spark, tmp_path):
    with pytest.raises(ValueError):
        inputs.discover(spark, str(tmp_path))
    (tmp_path / "evidentia_index.json").write_text(json.dumps([{"id": "z", "path": "a.json"}]))
    r = inputs.discover(spark, str(tmp_path)).first()
    assert r.paper_id == "z" and r.source_path == f"{tmp_path}/a.json"


def test_publish_is_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "out")

    def broken(folder):
        spark.range(1).write.json(f"{folder}/x")
        raise RuntimeError

    with pytest.raises(RuntimeError):
        sinks.publish(spark, target, broken)
    assert list(tmp_path.iterdir()) == []
    sinks.publish(spark, target, lambda folder: spark.range(1).write.json(f"{folder}/x"))
    with pytest.raises(ValueError):
        sinks.publish(spark, target, broken)
    with pytest.raises(ValueError):
        sinks.require_apart("/a/b", "/a")


def test_commands(spark, tmp_path):
    folder = tmp_path / "long" / "g1"
    folder.mkdir(parents=True)
    (folder / "a.pdf").write_bytes(pdf(TEXT))
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    a = cli.parser().parse_args(["extract-paper-study", "--paper-folder", str(tmp_path), "--output-folder", out, "--report-folder", report, "--provider", f"{__name__}:ByChunk"])
    assert cli.extract(spark, a) == 0
    s = spark.read.json(f"{report}/summary").first()
    assert (s.succeeded, s.failed) == (1, 0)
    packets = tmp_path / "packets" / "long" / "g1"
    packets.mkdir(parents=True)
    (packets / "a.json").write_text(spark.read.text(out).first()[0])
    export.export(spark, str(tmp_path), str(tmp_path / "packets"), str(tmp_path / "bundle"))
    m = spark.read.json(str(tmp_path / "bundle" / "manifest")).first()
    assert (m.horizon, m.group, m.paper_count, m.minimum_similarity) == ("long", "g1", 1, 1.0) and m.papers[0].paper_id == "a_long"
    assert "status" not in spark.read.json(str(tmp_path / "bundle" / "packets")).columns
    (packets / "b.json").write_text(spark.read.text(out).first()[0])
    with pytest.raises(ValueError):
        export.export(spark, str(tmp_path), str(tmp_path / "packets"), str(tmp_path / "bundle2"))
    for wrong in ("--max-chunks=0", "--minimum-quality-score=2"):
        with pytest.raises(SystemExit):
            cli.parser().parse_args(["extract-paper-study", "--paper-folder", "x", "--provider", "a:b", wrong])


def test_stream_adds_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a\nb"), (2, "c")], "doc_id long, text string").write.parquet(source)
    schema = "doc_id long, text string"
    ingest.append_chunks(ingest.read_stream(spark, schema, source), target, str(tmp_path / "c1")).awaitTermination()
    spark.createDataFrame([(2, "c"), (3, "d")], schema).write.mode("append").parquet(source)
    ingest.append_chunks(ingest.read_stream(spark, schema, source), target, str(tmp_path / "c2")).awaitTermination()
    assert sorted(r.paper_id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_windows_equal_batch(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    q = ingest.windowed(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))).writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, ingest.windowed(events).collect()))
    assert ingest.sessions(events).agg(F.sum("n")).first()[0] == events.count()


def test_recovery_adds_without_overwriting(spark, tmp_path):
    d = spark.createDataFrame([("a", TEXT), ("b", "poison"), ("c", TEXT + " more"), ("d", TEXT)], "id string, text string")
    papers = chunks.papers(d, "id", "text", chunks.line_pages(F.col("text")))
    sha = {r.paper_id: r.source_sha256 for r in papers.collect()}
    report = tmp_path / "papers.jsonl"
    report.write_text("\n".join(json.dumps({"paper_id": k, "status": "succeeded" if k == "d" else "failed", "source_sha256": v}) for k, v in sha.items()))
    delivery = str(tmp_path / "delivery")
    spark.createDataFrame([("c", "old")], "paper_id string, value string").write.partitionBy("paper_id").text(delivery)
    out = recovery.recover(spark, str(report), papers, delivery, str(tmp_path / "audit"), ByChunk)
    assert out == {"status": "partial", "recovered": 1, "failed": 1, "present": 1}
    assert {r.paper_id: r.value[:3] for r in spark.read.text(delivery).collect()}["c"] == "old" and spark.read.json(str(tmp_path / "audit" / "papers")).count() == 3
    assert recovery.recover(spark, str(report), papers, delivery, str(tmp_path / "audit2"), ByChunk, ["a", "c"])["status"] == "no-op"
    drifted = papers.withColumn("source_sha256", F.lit("x"))
    with pytest.raises(ValueError):
        recovery.recover(spark, str(report), drifted, str(tmp_path / "d2"), str(tmp_path / "audit3"), ByChunk)
    with pytest.raises(ValueError):
        recovery.recover(spark, str(report), papers, delivery, str(tmp_path / "audit4"), ByChunk, ["d"])


def test_ingestion_reuses_what_has_not_changed(spark, tmp_path):
    from evidentia.plans import ingestion

    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    for name, text in (("a.pdf", "one"), ("b.pdf", "two"), ("sub/a.pdf", "three")):
        (folder / name).write_bytes(pdf(text))
    seen = str(tmp_path / "seen")

    def parse(content):
        with open(seen, "a") as f:
            f.write("x")
        return inputs.pdf_text(content)

    first = {r.paper_id: r for r in ingestion.ingest(spark, str(folder), parse).collect()}
    assert len(open(seen).read()) == 3 and {r.source_file for r in first.values()} == {"a.pdf", "b.pdf", "sub/a.pdf"} and "b" in first
    (folder / "b.pdf").write_bytes(pdf("four"))
    again = {r.paper_id: r for r in ingestion.ingest(spark, str(folder), parse).collect()}
    assert len(open(seen).read()) == 4 and again.keys() == first.keys() and again["b"].chunks[0].text == "four"
    assert all(again[k] == first[k] for k in first if k != "b")
    moved = tmp_path / "moved"
    folder.rename(moved)
    assert {r.paper_id for r in ingestion.ingest(spark, str(moved), parse).collect()} == set(first) and len(open(seen).read()) == 4
    texts = {json.loads(r.value)["paper_id"]: r.value for r in spark.read.text(str(moved / ".evidentia" / "texts")).collect()}
    import hashlib

    assert hashlib.sha256(texts["b"].encode()).hexdigest() == again["b"].text_artifact_sha256
    (moved / "empty.pdf").write_bytes(pdf(""))
    with pytest.raises(ValueError):
        ingestion.ingest(spark, str(moved), parse)


def test_a_file_that_changes_while_it_is_read(spark, tmp_path):
    from evidentia.plans import ingestion

    (tmp_path / "a.pdf").write_bytes(pdf("one"))
    files = inputs.pdf_files

    def then_changed(*args):
        d = spark.createDataFrame(files(*args).collect())
        (tmp_path / "a.pdf").write_bytes(pdf("two"))
        return d

    inputs.pdf_files = then_changed
    try:
        with pytest.raises(ValueError, match="changed while"):
            ingestion.ingest(spark, str(tmp_path))
    finally:
        inputs.pdf_files = files
    assert not (tmp_path / ".evidentia").exists()


def test_export_guards(spark, tmp_path):
    import hashlib

    body = pdf(TEXT)
    for h in ("long", "short"):
        (tmp_path / h / "g").mkdir(parents=True)
        (tmp_path / h / "g" / "a.pdf").write_bytes(body)
    sha = hashlib.sha256(body).hexdigest()
    chunk = hashlib.sha256(f"{sha}:1:{hashlib.sha256(TEXT.encode()).hexdigest()}".encode()).hexdigest()[:20]

    def packet(**changes):
        return answer(chunk) | {"schema_version": "2.2", "paper_id": "a", "coverage_ledger": {chunk: "extracted"}, "metadata": {"source_file": "a.pdf", "source_sha256": sha}, "status": "accepted"} | changes

    def out(name, p, horizon="long", stem="a"):
        folder = tmp_path / name / horizon / "g"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{stem}.json").write_text(json.dumps(p))
        return str(tmp_path / name)

    root = out("good", packet())
    out("good", packet(), "short")
    target = tmp_path / "bundle"
    export.export(spark, str(tmp_path), root, str(target))
    rows = sorted(spark.read.json(str(target / "papers")).collect(), key=lambda r: r.paper_id)
    assert [(r.paper_id, r.horizon, r.group, r.chunk_count, r.reference_count, r.minimum_similarity, r.source_pdf_path) for r in rows] == [(f"a_{h}", h, "g", 1, 2, 1.0, f"{h}/g/a.pdf") for h in ("long", "short")]
    for r in rows:
        for kind in ("packet", "chunk", "crosswalk"):
            (file,) = (target / r[f"{kind}_path"]).glob("part-*")
            assert hashlib.sha256(file.read_bytes().rstrip(b"\n")).hexdigest() == r[f"{kind}_sha256"]
        assert r.source_packet_sha256 == hashlib.sha256(json.dumps(packet()).encode()).hexdigest()
    kept = json.loads(next((target / rows[0].packet_path).glob("part-*")).read_text())
    assert kept["metadata"]["ablation_original_paper_id"] == "a" and "status" not in kept
    for i, (p, stem, rule) in enumerate((
        (packet(metadata={"source_file": "a.pdf", "source_sha256": "0"}), "a", "source_differs"), (packet(metadata={"source_file": "a.pdf"}), "a", "source_differs"), (packet(metadata={"source_file": "../g/a.pdf", "source_sha256": sha}), "a", "source_escapes_group"),
        (packet(metadata={"source_file": "b.pdf", "source_sha256": sha}), "a", "source_missing"), (packet(), "c", "name_differs"),
    )):
        with pytest.raises(ValueError, match=rule):
            export.export(spark, str(tmp_path), out(f"bad{i}", p, stem=stem), str(tmp_path / f"no{i}"))
        assert not (tmp_path / f"no{i}").exists()
    with pytest.raises(ValueError, match="no packets"):
        export.export(spark, str(tmp_path), str(tmp_path / "nothing"), str(tmp_path / "no"))


def test_pdf_with_page_tree_fonts_and_object_streams():
    import zlib

    cmap = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <03BC> <0002> <00660069> endbfchar 1 beginbfrange <0010> <0012> <0041> endbfrange"
    body = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [5 0 R 3 0 R] /Count 2 /Resources << /Font << /F1 7 0 R /F2 8 0 R >> >> >>",
        3: b"<< /Type /Page /Parent 2 0 R /Contents [4 0 R] >>", 7: b"<< /Type /Font /Subtype /Type1 /Encoding << /Differences [65 /beta /uni00E9] >> >>", 8: b"<< /Type /Font /Subtype /Type0 /ToUnicode 9 0 R >>",
    }
    streams = {
        4: b"BT /F1 12 Tf 1 0 0 1 10 700 Tm (last \\(page\\) A) Tj 1 0 0 1 10 680 Tm [(sp) -300 (aced) -20 (out)] TJ ET",
        6: b"BT /F2 9 Tf <00010010> Tj 0 -12 Td <00020012> Tj ET", 9: cmap,
    }
    inner = b"<< /Type /Page /Parent 2 0 R /Contents 6 0 R >>"
    out = b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % x for x in body.items())
    packed = b"5 0 " + inner
    streams_ = {n: (b"<< /Length %d /Filter /FlateDecode >>", zlib.compress(s)) for n, s in streams.items()} | {10: (b"<< /Type /ObjStm /N 1 /First 4 /Length %d /Filter [/FlateDecode] >>", zlib.compress(packed))}
    for n, (head, data) in streams_.items():
        out += b"%d 0 obj\n" % n + head % len(data) + b"\nstream\n" + data + b"\nendstream\nendobj\n"
    out += b"trailer << /Root 1 0 R >>\n%%EOF"
    assert inputs.pdf_text(out) == ["μA\nfiC", "last (page) β\nsp acedout"]
    assert inputs.pdf_text(out.replace(b"/Root 1 0 R", b"/Root 1 0 R /Encrypt 9 0 R")) == []
