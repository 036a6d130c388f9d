import unicodedata
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.functions.conditions import conditions
from evidentia.functions.profiles import SCIENCE, check, mandatory
from evidentia.functions.similarity import best_ratio


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize("raw, want", [("A_b-c/d;e", "a b c d e"), ("  Straße (x)\n", "strasse x"), ("", ""), (None, None), ("a.b", "a.b")])
def test_normalize(spark, raw, want):
    assert one(spark, raw, T.normalize) == want


@pytest.mark.parametrize("raw, want", [("Paper One", "Paper-One"), ("--x..", "x"), ("???", "paper"), ("", "paper"), ("a.b_c-d", "a.b_c-d")])
def test_safe_id(spark, raw, want):
    assert one(spark, raw, T.safe_id) == want


def test_is_safe_id(spark):
    assert [one(spark, x, T.is_safe_id) for x in ("a1", "../a", "", None, "a\n")] == [True, False, False, False, False]


def test_sections_and_tokens(spark):
    assert one(spark, "The Results and METHODS", T.section_hint) == "methods"
    assert one(spark, "x" * 500 + " abstract", T.section_hint) == "page"
    assert [one(spark, x, T.token_estimate) for x in ("", "abcd", "abcde")] == [1, 1, 2]


def test_occurrences_do_not_overlap(spark):
    assert one(spark, "aaaa", lambda c: T.occurrences(c, F.lit("aa"))) == 2


def test_namespaced(spark):
    f = lambda c: T.namespaced(c, F.lit("long"))
    assert [one(spark, x, f) for x in ("p", "p_long", "p_short")] == ["p_long", "p_long", "p_short_long"]


def test_natural_key_sorts_numbers(spark):
    names = ["5_10", "5_9", "5_1", "a2", "A10"]
    d = spark.createDataFrame([(n,) for n in names], "x string").orderBy(T.natural_key(F.col("x")))
    assert [r[0] for r in d.collect()] == ["a2", "A10", "5_1", "5_9", "5_10"]


def test_ratio4_is_half_to_even(spark):
    assert spark.range(1).select(T.ratio4(F.lit(1), F.lit(32)), T.ratio4(F.lit(0), F.lit(0))).first()[:] == (0.0312, 1.0)


@pytest.mark.parametrize("raw", ["ﬁne – 5μM", "E14.5, +3 h", "a|b (c)", "x≥1"])
def test_scientific(spark, raw):
    import re

    want = unicodedata.normalize("NFKC", raw).casefold().translate(str.maketrans("‐‑‒–—−μ", "------u"))
    want = re.sub(r"\s+", " ", re.sub(r"[^\w.%<>=!+\-/]+", " ", want)).strip()
    assert one(spark, raw, T.scientific) == want


def test_conditions(spark):
    got = one(spark, "E14.5 cultures were not treated for 3 hours; rescue was sufficient at 10.0 ug", lambda c: conditions(T.scientific(c)))
    assert {"development_stage:e14.5", "time:3 h", "negation:not", "modality:sufficient", "causal_rung:rescue", "dose:10 ug"} <= set(got)


def test_decimal_text():
    assert [T.decimal_text(x) for x in (1.50, 0.0, "1e3", 1e-7)] == ["1.5", "0", "1000", "0.0000001"]


def test_profiles_hold():
    check(SCIENCE)
    assert mandatory("general_method", "methodological")[:2] == ("proposed_method", "baselines")
    assert len(mandatory("general_method", "methodological")) == 6


SENTENCE = "The treatment lowered the reading in every sample run."


def test_ratio_goldens():
    assert best_ratio(SENTENCE[:-1] + ",", SENTENCE) == pytest.approx(0.981481, abs=1e-6)
    assert best_ratio("", "x") == 0 and best_ratio("x", "") == 0 and best_ratio("a  b", "z a b z") == 1


@settings(max_examples=60, deadline=None)
@given(st.text("ab c", max_size=12), st.text("ab c", max_size=30))
def test_ratio_is_the_best_window(excerpt, source):
    e, s = " ".join(excerpt.split()), " ".join(source.split())
    got = best_ratio(excerpt, source)
    if not e or not s:
        assert got == 0
    elif e in s:
        assert got == 1
    elif len(e) > len(s):
        assert got == SequenceMatcher(None, e, s, autojunk=False).ratio()
    else:
        assert got == max(SequenceMatcher(None, e, s[i : i + len(e)], autojunk=False).ratio() for i in range(len(s) - len(e) + 1))


@pytest.mark.parametrize("text, want", [("abc-kox", []), ("p53 knockouts", ["development_stage:p53"]), ("p53 knockout", ["development_stage:p53", "perturbation:knockout", "perturbation:p53 knockout"]), ("abc-ko mice", ["perturbation:abc-ko"]), ("5 µg daily", ["dose:5 ug"]), ("５ μｇ daily", ["dose:5 ug"])])
def test_genotypes_and_micro_signs(spark, text, want):
    assert one(spark, text, lambda c: conditions(T.scientific(c))) == want
