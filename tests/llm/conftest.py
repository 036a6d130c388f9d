import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, and columns whose names clash."""
    random.seed(5)
    words = ["alpha", "Beta", "gamma", "délta", "ε", "zeta,", "eta.", "3"]
    prose = lambda n: " ".join(random.choice(words) + str(random.randint(0, 60)) for _ in range(n))
    base = prose(120)
    twice = base[:300] + prose(60)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.replace("alpha", "omega", 1), "en", "b"), (4, None, None, None), (5, "", "en", "b"), (6, " \t\n", "en", None), (7, "one", "fr", "c"),
        (8, "word " * 9000, "en", "a"), (9, "x" * 30_000, "en", "a"), (10, prose(80), "en", "b"), (10, prose(80), "en", "b"), (11, twice, "de", "c"), (11, twice, "de", "c"),
        (12, "日本語の文章です。" * 60, "ja", "c"), (13, "naïve ﬁancé\r\n\u2028 x\0y 🎉" * 30, "en", "c"), (None, prose(20), "en", "a"),
    ]
    d = [r + (len(r[1] or ""), 1, "k", 2, 3) for r in rows]
    return spark.createDataFrame(d, "doc_id long, text string, lang string, source string, n_chars long, key long, shard string, taken long, words long")


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
