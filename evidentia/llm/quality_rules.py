"""Quality rules: base counts, and divergence of a text's histograms from its language's.

A document has two histograms: character classes (letters by case, digits, marks ...) and
common words (function words of four languages, all others in one cell).  The reference of
a language is the sum of the histograms of all its documents that pass the base rules and,
after the first round, passed the verdict by the reference of the round before.  A document
fails if the Jensen-Shannon distance (base 2, 0 to 1) of either histogram from the reference
is over limit + noise / sqrt(length): the distance of a sample from its own source falls
with the root of its length.  A histogram counts only from a least length on; a text below
both lengths, or of a language without reference, is judged by the base rules alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import read, small, stored

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")

#: Function words of English, German, French and Spanish (fixed values).
COMMON = """
the of and to in is that for it with as was on be by this are or an at from
der die das und ist nicht mit den von zu ein eine für auf dem des sich auch als
le la les et est des une un du dans que qui pour par sur avec pas au ce
el los las y es en una por con para del se lo su no al como más
""".split()
_CELL = {w: i + 1 for i, w in enumerate(dict.fromkeys(COMMON))}
_CLASSES = 8  # lower, upper, digit, comma or full stop, other ASCII mark, white space, other letter without case, rest
_WORDS = len(_CELL) + 1

#: Languages up to this many are broadcast with their references.
BROADCAST_LANGUAGES = 10_000

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, hist array<int>"


def repeated_words(words: list[str], n: int = 5) -> int:
    """Words covered by ``n``-word windows that are found twice or more."""
    if len(words) <= n:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key = ids[: len(ids) - n + 1].copy()
    top = len(number)
    for i in range(1, n):
        if top * len(number) >= 2**62:  # keep keys exact
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            top = int(key.max()) + 1
        key = key * len(number) + ids[i : len(ids) - n + 1 + i]
        top *= len(number)
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    start = np.flatnonzero(counts[inverse] > 1)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + n, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


_ASCII = np.full(128, 4, np.int64)
for _i in range(128):
    _c = chr(_i)
    _ASCII[_i] = 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c in ".," else 5 if _c in " \t\n\v\f\r" else 7 if _i < 32 or _i == 127 else 4


def _classes(text: str) -> list[int]:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    counts = np.bincount(_ASCII[codes[codes < 128]], minlength=_CLASSES)
    for c, n in zip(*np.unique(codes[codes >= 128], return_counts=True), strict=True):
        c = chr(c)
        counts[0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 6 if c.isalpha() else 7] += n
    return counts.tolist()


def features(text: str) -> tuple:
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    cells = [0] * _WORDS
    for w, n in Counter(words).items():
        cells[_CELL.get(w.strip(".,;:!?").lower(), 0)] += n
    return len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)), repeated_words(words), _classes(text) + cells


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of the rows of two matrices of counts."""
    p, q = (x / np.maximum(x.sum(1, keepdims=True), 1) for x in (p.astype(float), q.astype(float)))
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = [np.where(x > 0, x * np.log2(x / m), 0).sum(1) for x in (p, q)]
    return np.sqrt(np.clip((kl[0] + kl[1]) / 2, 0, 1))


def _compare(known: np.ndarray, hist: np.ndarray, ref: np.ndarray, limits: tuple, least: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances by class and by word (NaN where they don't count), and whether both are within limits."""
    out, good = [], np.ones(len(hist), bool)
    for cells, (limit, noise), n in zip((slice(0, _CLASSES), slice(_CLASSES, None)), limits, least, strict=True):
        size = hist[:, cells].sum(1)
        far = np.where(known & (size >= n), _divergence(hist[:, cells], ref[:, cells]), np.nan)
        good &= ~(np.nan_to_num(far) > limit + noise / np.sqrt(np.maximum(size, 1)))
        out.append(far)
    return out[0], out[1], good


def judge(docs: DataFrame, class_limit: tuple[float, float] = (0.05, 4.5), word_limit: tuple[float, float] = (0.05, 3.3), least_chars: int = 200, least_words: int = 50, min_words: int = 10, max_repeat: int = 20, rounds: int = 3) -> DataFrame:
    """``docs`` (doc_id, text, lang) judged: counts, base_failed, the two distances, kept.

    A limit is (limit, noise).  Null and empty texts have no words, so they fail the base
    rules.  A null language is a language of its own.  Distances are null where a histogram
    is too short to count or the language has no reference.  Repeated rows each count.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FEATURES.split(", ")]
        for b in batches:
            out = pd.DataFrame([features(t) for t in b["text"]], columns=names)
            out.insert(0, "lang", b["lang"].to_numpy())
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    d = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    d = d.mapInPandas(count, f"doc_id {id_type}, lang string, {FEATURES}")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    d = stored(d.withColumn("base_failed", failed), "features")
    width = _CLASSES + _WORDS

    def reference(of: DataFrame) -> DataFrame:
        sums = of.groupBy("lang").agg(*(F.sum(F.element_at("hist", i + 1).cast("long")).alias(f"h{i}") for i in range(width)))
        return stored(sums.select(F.col("lang").alias("ref_lang"), F.array(*(f"h{i}" for i in range(width))).alias("ref")), "reference", compact=True)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zero = np.zeros(width)
        for b in batches:
            if len(b):
                known = b["ref"].notna().to_numpy()
                hist, ref = (np.stack([zero if x is None else np.asarray(x, float) for x in b[c]]) for c in ("hist", "ref"))
                by_class, by_word, good = _compare(known, hist, ref, (class_limit, word_limit), (least_chars, least_words))
                b["class_distance"], b["word_distance"] = (pd.Series(x, b.index).astype("Float64").mask(np.isnan(x)) for x in (by_class, by_word))
                b["kept"] = ~b["base_failed"] & good
                yield b.drop(columns=["ref", "ref_lang"])

    def judged(ref: DataFrame) -> DataFrame:
        both = d.join(small(ref, BROADCAST_LANGUAGES), F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
        return both.mapInPandas(compare, f"doc_id {id_type}, lang string, {FEATURES}, base_failed boolean, class_distance double, word_distance double, kept boolean")

    ref = reference(d.filter("not base_failed"))
    for _ in range(rounds - 1):
        ref = reference(judged(ref).filter("kept"))
    return judged(ref).drop("lang", "hist")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document's base counts and verdict."""
    d = judge(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
