"""Operators over the whole corpus, and the pipeline: against brute force, and on odd tables."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evidentia.llm import common, components, near_dedup, quality_classifier, suffix_dedup

SF = "/root/testdata/sf0.001"


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# --- components


def test_components(spark):
    import random

    random.seed(3)
    for n, m in ((30, 20), (60, 80), (1, 0)):
        edges = [(random.randrange(n), random.randrange(n)) for _ in range(m)] + [(100 + i, 101 + i) for i in range(20 if m == 20 else 0)]
        root = {x: x for e in edges for x in e}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: find(x) for x in root if find(x) != x}


# --- near-dedup


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, n, percent=80):
    sets = {k: shingle_set(t, n) for k, t in rows}
    of = {}
    for k, s in sets.items():
        for x in s:
            of.setdefault(x, []).append(k)
    both = Counter(p for ks in of.values() for p in itertools.combinations(sorted(ks), 2))
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in both.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k), find(k) == k) for k in sets}


def found(d):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in d.collect()}


def test_near_copies_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert found(near_dedup.op7_near_dedup(spark, SF)) == brute(rows, 4)


@pytest.mark.parametrize("unit", [400, 8])
def test_groups_of_edited_copies(spark, monkeypatch, unit):
    import random

    monkeypatch.setattr(near_dedup, "UNIT", unit)
    random.seed(7)
    word = lambda: f"w{random.randint(0, 400)}"
    texts = []
    for length in (3, 5, 9, 40, 150):
        body = [word() for _ in range(length)]
        for _ in range(30):
            copy = body[:]
            for _ in range(random.choice((0, 0, 1, 2, 4))):
                copy[random.randrange(length)] = word()
            texts.append(" ".join(copy))
    passage = " ".join(word() for _ in range(60))
    texts += [f"{passage} {' '.join(word() for _ in range(80))}" for _ in range(20)] + [None, "", "  ", "A b", "a B"]
    assert found(near_dedup.link(table(spark, texts), 5)) == brute(list(enumerate(texts)), 5)


def test_copies_among_texts_on_one_boilerplate(spark, monkeypatch):
    """All texts are candidates of each other just under the threshold (J 0.78); only the planted pairs (J 0.84) link."""
    monkeypatch.setattr(near_dedup, "UNIT", 20)
    page, texts = [f"page{i}" for i in range(100)], []
    for i in range(300):
        own = [f"own{i}x{k}" for k in range(14)]
        texts.append(" ".join(page + own))
        if i % 3 == 0:
            texts.append(" ".join(page + own[:4] + [f"edit{i}x{k}" for k in range(10)]))
    want = brute(list(enumerate(texts)), 1)
    assert sum(not kept for _, _, kept in want.values()) == 100
    assert found(near_dedup.link(table(spark, texts), 1)) == want


@pytest.mark.parametrize("pairs", [350, 800, 2500])
def test_copies_in_components_of_any_size(spark, pairs):
    """Texts of 1,139 words: pairs at J 0.8046, all others at 0.786; linked at default settings."""
    page, texts = [f"p{i}" for i in range(1003)], []
    for i in range(pairs):
        own = [f"o{i}x{k}" for k in range(136)]
        texts.append(" ".join(page + own))
        texts.append(" ".join(page + own[:13] + [f"e{i}x{k}" for k in range(123)]))
    sets = [shingle_set(t, 4) for t in (texts[0], texts[1], texts[2])]
    index = lambda a, b: len(a & b) / len(a | b)
    assert index(sets[0], sets[1]) > 0.8 > index(sets[0], sets[2]) > 0.78
    got = found(near_dedup.link(table(spark, texts).repartition(4), 4))
    assert [i for i in range(pairs) if got[2 * i][1:] != (2 * i, True) or got[2 * i + 1][1:] != (2 * i, False)] == []


def test_rows_that_share_an_id_link(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    d = spark.createDataFrame([(1, a), (1, b), (2, a), (3, a + " x"), (4, b), (None, a)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.link(d, 4).collect()))
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False)]


def test_overlaps_are_exact():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 4000)).astype(np.uint64)) for _ in range(30)]
    got = near_dedup.overlaps(sets)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)


def test_copies_of_very_short_texts(spark):
    """Texts of 7 words and the same with one more: 4 of 5 shingles are shared."""
    texts = [t for i in range(2000) for t in (" ".join(f"w{i}x{k}" for k in range(7)), " ".join(f"w{i}x{k}" for k in range(8)))]
    got = found(near_dedup.link(table(spark, texts), 4))
    assert [i for i in range(2000) if got[2 * i + 1][1:] != (2 * i, False)] == []


def test_pairs_of_a_band_whose_hubs_are_far(spark, monkeypatch):
    """Texts of 60 slots with one of two fillings each: bands hold many texts that aren't near, so that two near ones are often both spokes of far hubs."""
    monkeypatch.setattr(near_dedup, "BUCKET", 50, raising=False)
    rng = np.random.default_rng(4)
    slots = rng.integers(0, 2, (2000, 60))
    twins = slots.copy()
    for t in twins:
        at = rng.permutation(60)[:6]
        t[at] = 1 - t[at]  # J = 54 / 66
    slots = np.concatenate([slots, twins])
    d = table(spark, [" ".join(f"s{i}v{v}w{w}" for i, v in enumerate(s) for w in range(2)) for s in slots.tolist()])
    reps = common.stored(near_dedup.features(d, 1).drop("set_id"), "reps")
    roots = {r.node: r.root for r in components.components(near_dedup.candidate_edges(reps, 0.8 - near_dedup.SLACK)).collect()}
    assert [i for i in range(2000) if roots.get(i, i) != roots.get(2000 + i, 2000 + i)] == []


def test_near_dedup_of_odd_tables(spark, odd, none):
    d = near_dedup.link(odd, 4)
    assert d.count() == odd.count() and near_dedup.link(none, 4).count() == 0
    got = {r.doc_id: r for r in d.collect()}
    assert got[2].component_id == 1 and got[4].n_shingles == 0 and got[4].kept and got[None].component_id is None and got[None].kept
    assert got[3].component_id == 1 and not got[3].kept and got[8].n_shingles == 1


def test_estimates_follow_the_index():
    rng = np.random.default_rng(1)
    for n in (20, 100, 1000):
        for j in (0.5, 0.8, 0.95):
            far = []
            for _ in range(60):
                shared = round(2 * n * j / (1 + j))
                s = rng.integers(0, 2**63, 2 * n - shared, dtype=np.uint64)
                a, b = np.sort(s[:n]), np.sort(np.concatenate([s[n - shared : n], s[n:]]))
                far.append(float(near_dedup.estimate(near_dedup.registers(a), near_dedup.registers(b))) - shared / (2 * n - shared))
            assert abs(np.mean(far)) < 0.06


def test_registers_keep_zeros_and_mantissa():
    s = np.arange(1, 5000, dtype=np.uint64)
    v = near_dedup._mixed(near_dedup._mixed(s * near_dedup._M1) + near_dedup._M2)
    bucket = near_dedup._mixed(s * near_dedup._M1) % near_dedup.REGISTERS
    got = near_dedup.registers(s)
    for i in range(near_dedup.REGISTERS):
        bits = f"{int(v[bucket == i].min()):064b}"
        zeros = bits.index("1")
        assert got[i] == zeros << 10 | int(bits[zeros + 1 : zeros + 11].ljust(10, "0"), 2)


# --- suffix-array dedup


def removed(rows, length):
    starts = Counter(b[i : i + length] for _, b in rows for i in range(len(b) - length + 1))
    for k, b in rows:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if starts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)  # noqa: B905
        yield k, len(b), int(gone.sum()), int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum()), hashlib.sha256(kept).hexdigest()


def test_repeats_of_documents(spark):
    rows = [(r.doc_id, r.text.encode()) for r in documents(spark).collect()]
    assert sorted(map(tuple, suffix_dedup.op10_suffix_dedup(spark, SF).collect())) == sorted(removed(rows, 200))


@pytest.mark.parametrize("split, shard", [(1500, 1_500_000), (2, 500)])
def test_repeats_of_edited_texts(spark, monkeypatch, split, shard):
    import random

    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    random.seed(9)
    body = "".join(random.choice("abcdeé \n") for _ in range(900))
    texts = [None, "", "short", "ab" * 400, "x" * 199, "x" * 201, body, body]
    for _ in range(40):
        a, z = sorted(random.sample(range(len(body)), 2))
        copy = list(body[a:z] + "".join(random.choice("fgh") for _ in range(random.randint(0, 90))) + body[: random.randint(0, 400)])
        for _ in range(random.randint(0, 3)):
            copy[random.randrange(len(copy))] = "!"
        texts.append("".join(copy))
    want = sorted(removed([(i, (t or "").encode()) for i, t in enumerate(texts)], 200))
    assert sorted(map(tuple, suffix_dedup.removed_bytes(table(spark, texts)).collect())) == want


def test_repeats_of_a_passage_in_thousands_of_contents(spark):
    """One passage, edited at random places in each of 2,400 texts: more contents of a label than ``SPLIT``."""
    import random

    random.seed(4)
    body = "".join(random.choice("abcdefgh ") for _ in range(420))
    texts = []
    for i in range(2400):
        copy = list(body)
        for _ in range(random.choice((1, 2, 3))):
            copy[random.randrange(len(copy))] = random.choice("XYZ0123456789")
        texts.append(f"{''.join(copy)}{i:09d}")
    want = sorted(removed([(i, t.encode()) for i, t in enumerate(texts)], 200))
    assert sorted(map(tuple, suffix_dedup.removed_bytes(table(spark, texts)).collect())) == want


def test_suffix_arrays_and_prefixes():
    import random

    random.seed(3)
    for _ in range(150):
        parts = [bytes(random.choice(b"ab\0") for _ in range(random.randint(1, 40))) for _ in range(random.randint(1, 6))]
        start = np.cumsum([0] + [len(p) for p in parts[:-1]])
        data = np.frombuffer(b"".join(parts), np.uint8)
        sa, rank = suffix_dedup.suffix_array(data, start)
        want = sorted((p[i:], k, int(s) + i) for k, (p, s) in enumerate(zip(parts, start, strict=True)) for i in range(len(p)))
        assert [x[2] for x in want] == sa.tolist() and (rank[sa] == np.arange(len(data))).all()
        lcp = suffix_dedup.common_prefixes(data, start, sa, rank)
        for (a, _, _), (b, _, j) in itertools.pairwise(want):
            assert lcp[j] == next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_suffix_dedup_of_odd_tables(spark, odd, none):
    rows = suffix_dedup.removed_bytes(odd).collect()
    assert len(rows) == odd.count() and suffix_dedup.removed_bytes(none).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[1].n_removed == by[1].n_bytes and by[4].n_bytes == 0 and by[11].n_removed == by[11].n_bytes and by[8].n_removed == by[8].n_bytes
    out = suffix_dedup.without_repeats(odd)
    assert out.schema == odd.schema and out.count() == odd.count() and {r.text for r in out.filter("doc_id in (1, 4, 8)").collect()} == {""}


# --- quality classifier


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    test = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    d = quality_classifier.resample(documents(spark, sf), labels.filter(~test)).join(labels.filter(test), "doc_id").toPandas()
    good = (d.quality == 1) & (d.toxic == 0)
    assert d[good].kept.mean() > 0.97 and d[d.quality == 0].kept.mean() < 0.1 and d[(d.quality == 1) & (d.toxic == 1)].kept.mean() < 0.5


def test_words_are_hashed_by_their_bytes():
    """Equal words, beginnings and shapes have equal hashes, and others have others."""
    import re

    texts = [r.text for r in documents_of(SF)] + [None, "", " \n", "...", "A b. !c! ..x.. é日本 AAaa11--11", "x" * 300_000]
    hashes, of_word, of_shape, at = quality_classifier.Hashes(), {}, {}, 0
    for g in quality_classifier.grams(texts, hashes):
        words = [w for t in texts[at : at + len(g.size)] for w in (t or "").encode().split()]
        assert g.size.tolist() == [len((t or "").encode().split()) for t in texts[at : at + len(g.size)]]
        for w, lower, shape, *heads in zip(words, g.lower.tolist(), g.shape.tolist(), *g.heads.tolist(), strict=True):
            plain = w.strip(b".,;:!?").lower()
            kinds = re.sub(rb"([Xx0])\1+", rb"\1", bytes(quality_classifier._KINDS[list(w)]))[:12]
            for table_, key, h in ((of_word, plain, lower), (of_shape, kinds, shape), *((of_word, plain[:n], h) for n, h in zip(quality_classifier.HEADS, heads, strict=True))):
                assert table_.setdefault(key, h) == h
        at += len(g.size)
    assert all(len(set(t.values())) == len(t) for t in (of_word, of_shape))


def documents_of(sf):
    import pyarrow.parquet as pq

    return [type("Row", (), r) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]


def test_weights_against_plain_python(spark):
    """Models, weights and the sample of sf0.01, recomputed document by document."""
    import math

    sf = "/root/testdata/sf0.01"
    q = quality_classifier
    docs = documents_of(sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = {}
    for r in labels.collect():
        good[r.doc_id] = good.get(r.doc_id, True) and r.quality == 1 and r.toxic == 0
    cut = {d.doc_id: q._cut([(d.text or "").encode()], q.Hashes()) for d in docs}
    good = {k: v for k, v in good.items() if k in cut}
    group = {k: int(cut[k].groups()[0]) for k in good}
    share = Counter((group[k], good[k]) for k in good)
    vote = {k: 1 / share[group[k], good[k]] for k in good}

    def model(buckets, surprise, support, most):
        raw, target, tv, av = (Counter() for _ in range(4))
        for k, found_ in buckets.items():
            for b in set(found_):
                raw[b] += 1
                if k in good:
                    av[b] += vote[k]
                    target[b] += good[k]
                    tv[b] += vote[k] * good[k]
        votes, ok = sum(vote.values()), sum(v for k, v in vote.items() if good[k])
        p, per = ok / votes, sum(good.values()) / len(docs)
        out = {}
        for b, n in av.items():
            part = lambda x, e: x * math.log(x / e) if x > 0 else 0.0
            gain = part(tv[b], p * n) + part(n - tv[b], (1 - p) * n)
            if gain > surprise and n >= max(6, support * votes) and math.log((tv[b] + 0.5) / (p * n + 0.5)) < most:
                out[b] = min(0.0, math.log((target[b] + 0.5) / (raw[b] * per + 0.5)))
        return out

    shapes = model({k: g.shapes().ravel().tolist() for k, g in cut.items()}, 10, 0.001, -0.7)
    first = {k: sum(shapes.get(b, 0.0) for b in g.shapes().ravel().tolist()) for k, g in cut.items()}
    words = model({k: g.words().ravel().tolist() for k, g in cut.items() if first[k] > -2}, 12, 0.004, -2.0)
    want = {k: first[k] + sum(min(words.get(b, 0.0) for b in column) for column in g.words().T.tolist()) for k, g in cut.items()}
    rows = q.resample(spark.read.parquet(f"{sf}/documents.parquet"), labels).collect()
    assert shapes and all(r.weight == pytest.approx(want[r.doc_id], abs=1e-6) for r in rows)
    k = sum(w > -5 for w in want.values())
    last = sorted((r.key for r in rows), reverse=True)[k - 1]
    assert 0 < k < len(rows) and all(r.kept == (r.key >= last) for r in rows)


def test_kth_largest(spark):
    rng = np.random.default_rng(2)
    for values in (rng.normal(size=5000), rng.integers(0, 3, 400).astype(float), np.array([1.0])):
        d = spark.createDataFrame([(float(v),) for v in values], "key double")
        for k in {1, len(values) // 2 or 1, len(values) - 1 or 1}:
            t = quality_classifier.kth_largest(d, k, bins=8)
            assert (values >= t).sum() >= k and (values > t).sum() < k or k >= len(values)
    assert quality_classifier.kth_largest(d, 5) == float("-inf")


def test_gumbel_top_k_samples_by_weight(spark):
    d = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 2.0).otherwise(0.0).alias("w"))
    keys = d.withColumn("key", quality_classifier.gumbel_key(F.col("w"), F.col("doc_id"), 1.0, 1))
    t = quality_classifier.kth_largest(keys.select("key"), 100)
    n = keys.filter(F.col("key") >= t).agg(F.count("*"), F.count_if(F.col("w") == 2.0)).first()
    assert n[0] == 100 and 75 <= n[1] <= 97  # e^2 : 1 is 88 of 100


def test_classifier_of_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 1, 0), (None, 1, 0), (99, None, 1)], "doc_id long, quality int, toxic int")
    d = quality_classifier.resample(odd, labels)
    assert d.count() == odd.count() and d.filter("kept is null").count() == 0 and quality_classifier.resample(none, labels).count() == 0
    assert quality_classifier.resample(odd, labels.filter("false")).filter("not kept").count() == 0
    assert quality_classifier.kept_rows(odd, labels).columns == odd.columns
    small = quality_classifier.fit(odd, labels, labelled=1)
    assert small.shapes is not None


# --- the pipeline


def test_pipeline(spark):
    sf = SF
    docs = documents(spark, sf)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "MinHash near-dedup", "suffix-array dedup", "mixing sources to target weights", "packing"]
    a, b, c, d, e = (f for _, f in corpus_pipeline.STAGES)
    one = common.stored(a(spark, docs, sf), "t")
    assert one.columns == docs.columns
    kept = {r.doc_id for r in quality_classifier.resample(docs, spark.read.parquet(f"{sf}/labels.parquet")).filter("kept").collect()}
    assert {r.doc_id for r in one.collect()} == kept
    two = common.stored(b(spark, one, sf), "t")
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == {k for k, v in brute(rows, 5).items() if v[2]}
    three = common.stored(c(spark, two, sf), "t")
    want = {k: sha for k, _, _, _, sha in removed([(r.doc_id, r.text.encode()) for r in two.collect()], 200)}
    ascii_only = [r for r in three.collect() if r.text.isascii() and next(x for x in two.filter(F.col("doc_id") == r.doc_id).collect()).text.isascii()][:40]
    assert three.columns == docs.columns and three.count() == two.count() and ascii_only
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id] for r in ascii_only) and three.filter("n_chars <> length(text)").count() == 0
    four = common.stored(d(spark, three, sf), "t")
    times = Counter(r.doc_id for r in four.collect())
    assert four.columns == docs.columns and set(times) == {r.doc_id for r in three.collect()} and max(times.values()) <= 3
    five = e(spark, four, sf)
    assert five.count() == four.count() and five.filter("n_tokens > padded_length").count() == 0


def test_pipeline_of_odd_tables(spark, odd, none, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table_ in (odd, none):
        d = table_
        for _, stage in corpus_pipeline.STAGES:
            d = common.stored(stage(spark, d, str(tmp_path)), "t")
        assert (d.count() > 0) == (table_ is odd)


def test_the_shared_folder_is_the_sessions(spark):
    assert common.shared_folder(spark) == (spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir"))
