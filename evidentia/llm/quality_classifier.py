"""Quality classifier by importance resampling.

The weight of a document is the log ratio of two hashed n-gram models, one of target text
(documents labelled good and not toxic) and one of raw text (all documents), summed over
those n-grams that tell target from other labelled text beyond chance and are rarer in
target text.  Documents are then sampled without replacement by Gumbel top-k: weight /
``temperature`` plus Gumbel noise, the k largest kept.

There are two rounds.  Round 1 has n-grams of word shapes (case, digits and marks; pairs
with whether the word repeats) and finds text of the wrong form.  Round 2 has words and
their beginnings, its models made of documents that round 1 leaves, and finds wrong content in good form.
Models count documents, not occurrences.  Labelled copies of one text share one vote:
their group is the least hash of their 3-word windows.

The labelled sample is bounded (``labelled`` documents, those with the least hashed ids),
so it may be broadcast; raw counts, weights and k cover all documents.  A model has
``BUCKETS`` cells.  The k-th key is found by counting keys in ever finer bins, each pass
an aggregation; only counts of bins reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import distinct_sorted, give_back, read, stored

#: Cells of a model.  With a quarter of them, frequent words that share a cell with toxic ones hid 4 % of toxic documents.
BUCKETS = 1 << 19
LABELLED = 200_000
#: Lengths in bytes of the beginnings of words that count beside whole words: they catch inflected forms.
HEADS = (4, 5)
#: Bytes of a word's shape that count, runs of a kind being one.
SHAPE = 12
#: Bytes of texts that are cut into words together.
_BYTES = 200_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_INVERSE = np.uint64(pow(0xBF58476D1CE4E5B9, -1, 2**64))
_SPACE, _MARKS = (np.isin(np.arange(256), list(b)) for b in (b"\x20\t\n\v\f\r", b".,;:!?"))
#: Letters and digits by kind; other bytes stay.
_KINDS = np.array([ord("X") if 65 <= c <= 90 else ord("x") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c for c in range(256)], np.uint8)
_RUNS = np.isin(np.arange(256), list(b"Xx0"))


class Model(NamedTuple):
    shapes: np.ndarray | None  # log ratios by bucket, 0 where an n-gram doesn't count
    words: np.ndarray | None


class Hashes:
    """64-bit hashes of pieces of a byte array: polynomials over a random number for each byte, from running sums."""

    def __init__(self) -> None:
        n = np.arange(256, dtype=np.uint64)
        n = (n + np.uint64(1)) * _A
        n = (n ^ (n >> np.uint64(29))) * _B
        self.of_byte = (n ^ (n >> np.uint64(32))) * _A
        self.power, self.inverse = (np.ones(1, np.uint64) for _ in range(2))

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.power) < len(data) + 1:
            for name, base in (("power", _B), ("inverse", _INVERSE)):
                each = np.full(len(data) + 1, base, np.uint64)
                each[0] = 1
                setattr(self, name, np.cumprod(each, dtype=np.uint64))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.power[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def of(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (sums[end] - sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * _A
        return h ^ (h >> np.uint64(29))


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _B
    return ((h ^ (h >> np.uint64(29))) & np.uint64(BUCKETS - 1)).astype(np.int64)


class Grams(NamedTuple):
    size: np.ndarray  # words of each document
    of: np.ndarray  # document of each word
    lower: np.ndarray  # hash of each word
    shape: np.ndarray
    heads: np.ndarray  # hashes of its beginnings, a row each

    def words(self) -> np.ndarray:
        """Buckets of words and of their beginnings, a row each."""
        return _bucket(np.vstack([self.lower[None], self.heads]) * _A)

    def shapes(self) -> np.ndarray:
        """Buckets of shapes and of pairs, two rows."""
        before, again = self.shape.copy(), np.zeros(len(self.of), bool)
        inner = np.flatnonzero(self.of[1:] == self.of[:-1]) + 1
        before[inner] = self.shape[inner - 1]
        again[inner] = self.lower[inner] == self.lower[inner - 1]
        pair = self.shape * np.uint64(3) + before * np.uint64(5) + again.astype(np.uint64)
        return np.stack([_bucket((self.shape + np.uint64(7)) * _A), _bucket(pair * _A)])

    def groups(self) -> np.ndarray:
        """The least hash of each document's 3-word windows."""
        h = self.lower
        w = _bucket(h * _A).astype(np.uint64)
        third = np.concatenate([h[2:], np.zeros(2, np.uint64)]) if len(h) > 1 else np.zeros(len(h), np.uint64)
        second = np.concatenate([h[1:], np.zeros(1, np.uint64)])[: len(h)]
        end = np.cumsum(self.size)[self.of]
        place = np.arange(len(h))
        z = (h * _A + np.where(place + 1 < end, second, 0).astype(np.uint64)) * _B
        z = (z + np.where(place + 2 < end, third, 0).astype(np.uint64)) * _A + w
        z[(place + 2 >= end) & (self.size[self.of] > 2)] = np.uint64(2**64 - 1)
        out = np.full(len(self.size), 2**64 - 1, np.uint64)
        np.minimum.at(out, self.of, z ^ (z >> np.uint64(31)))
        return out.view(np.int64)

    def scores(self, m: Model) -> np.ndarray:
        """Sum of the models' log ratios for each document."""
        each = np.zeros(len(self.of))
        if m.shapes is not None:
            each += m.shapes[self.shapes()].sum(0)
        if m.words is not None:
            each += m.words[self.words()].min(0)  # a word and its beginnings count once
        return np.bincount(self.of, each, len(self.size))


def grams(texts: list[str | None], hashes: Hashes) -> Iterator[Grams]:
    """Words of consecutive documents, some at a time."""
    parts, held = [], 0
    for i, t in enumerate(texts):
        parts.append((t or "").encode("utf-8", "surrogatepass"))
        held += len(parts[-1])
        if held > _BYTES or i + 1 == len(texts):
            yield _cut(parts, hashes)
            parts, held = [], 0


def _cut(parts: list[bytes], hashes: Hashes) -> Grams:
    """Words of some documents, found in all their bytes at once."""
    joined = b" ".join([b"", *parts, b""])  # a space before and after each document
    data = np.frombuffer(joined, np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[data].view(np.int8)))
    begin, end = edge[::2] + 1, edge[1::2] + 1
    last = np.cumsum([len(p) + 1 for p in parts])
    of = np.searchsorted(last, begin - 1, side="right")
    # without marks at the ends
    a, z = begin.copy(), end.copy()
    for x, step, at in ((a, 1, 0), (z, -1, -1)):
        go = np.flatnonzero(_MARKS[data[x + at]] & (a < z))
        while len(go):
            x[go] += step
            go = go[a[go] < z[go]]
            go = go[_MARKS[data[x[go] + at]]]
    plain = hashes.sums(np.frombuffer(joined.lower(), np.uint8))
    heads = np.stack([hashes.of(plain, a, np.minimum(z, a + n)) for n in HEADS])
    kinds = _KINDS[data]
    new = np.ones(len(data), bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | ~_RUNS[kinds[1:]]
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(new, out=place[1:])
    first = place[begin]
    shape = hashes.of(hashes.sums(kinds[new]), first, np.minimum(place[end], first + SHAPE))
    return Grams(np.bincount(of, minlength=len(parts)), of, hashes.of(plain, a, z), shape, heads)


def _counts(docs: DataFrame, votes: DataFrame, first: np.ndarray | None, limit: float) -> DataFrame:
    """bucket, raw, target, target_votes, all_votes; of shapes, or with ``first`` of words in documents that it leaves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, total = Hashes(), np.zeros((4, BUCKETS))
        for b in batches:
            good, vote = b["good"].to_numpy(bool), b["vote"].to_numpy(float)
            at = 0
            for g in grams(b["text"].tolist(), hashes):
                here = slice(at, at + len(g.size))
                at += len(g.size)
                found = g.shapes() if first is None else g.words()
                of = np.broadcast_to(g.of, found.shape)
                if first is not None:
                    left = g.scores(Model(first, None)) > limit
                    found, of = found[:, left[g.of]], of[:, left[g.of]]
                pair = distinct_sorted((of * BUCKETS + found).ravel())
                of, bucket = pair // BUCKETS, pair % BUCKETS
                v, t = vote[here][of], good[here][of]
                for i, w in enumerate((1, t, v * t, v)):
                    np.add.at(total[i], bucket, w)
        some = np.flatnonzero(total[0])
        yield pd.DataFrame({"bucket": some, **{c: total[i, some] for i, c in enumerate(("raw", "target", "target_votes", "all_votes"))}})
        del total, some
        give_back()

    d = docs.join(votes, docs["doc_id"] == votes["labelled_id"], "left").select("text", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("vote", F.lit(0.0)).alias("vote"))
    parts = d.mapInPandas(run, "bucket long, raw double, target double, target_votes double, all_votes double")
    return parts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("raw", "target", "target_votes", "all_votes")))


def _ratios(counts: DataFrame, docs: tuple[float, float, float], surprise: float, support: float, most: float) -> np.ndarray:
    """Log ratios of target to raw text by bucket where the labelled sample tells them apart, else 0.

    ``docs``: target votes, all votes, target documents a raw one.
    """
    out = np.zeros(BUCKETS)
    if not docs[1] or docs[0] in (0, docs[1]):
        return out
    least, share = max(6.0, support * docs[1]), docs[0] / docs[1]
    rows = counts.filter(F.col("all_votes") >= least).toPandas()  # BUCKETS rows at most
    if not len(rows):
        return out
    t, n = rows["target_votes"].to_numpy(), rows["all_votes"].to_numpy()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.nan_to_num(t * np.log(t / (share * n))) + np.nan_to_num((n - t) * np.log((n - t) / ((1 - share) * n)))
    ratio = np.log((rows["target"] + 0.5) / (rows["raw"] * docs[2] + 0.5)).to_numpy()
    tells = (gain > surprise) & (np.log((t + 0.5) / (share * n + 0.5)) < most)
    out[rows["bucket"].to_numpy()] = np.where(tells, np.minimum(ratio, 0), 0)
    return out


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, limit: float = -2.0) -> Model:
    """Models from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality, toxic).

    A document with several labels is good only if all say so.  Labels without a document
    and null labels don't count.  Without labels of both kinds all weights are 0.
    """
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    known = labels.filter("doc_id is not null and quality is not null and toxic is not null").groupBy(F.col("doc_id").alias("labelled_id")).agg(F.min(good).alias("good"))
    known = stored(known, "labels", compact=True)
    n = known.count()
    if n > labelled:  # a threshold on hashed ids leaves the bound, less a margin for chance
        share = max(0.0, labelled - 6 * labelled**0.5) / n
        known = known.filter(F.xxhash64("labelled_id") < F.lit(int(-(2**63) + share * 2**64)))

    def group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for b in batches:
            keys = [g.groups() for g in grams(b["text"].tolist(), hashes)]
            yield pd.DataFrame({"labelled_id": b["labelled_id"], "good": b["good"], "group": np.concatenate(keys) if keys else []})

    small = F.broadcast(known)
    texts = docs.select("doc_id", "text")
    groups = texts.join(small, texts["doc_id"] == small["labelled_id"]).select("labelled_id", "good", "text")
    kind = labels.schema["doc_id"].dataType.simpleString()
    groups = stored(groups.mapInPandas(group, f"labelled_id {kind}, good boolean, group long").dropDuplicates(["labelled_id"]), "groups", compact=True)
    sizes = groups.groupBy("group", "good").agg(F.count("*").alias("n"))
    votes = stored(groups.join(sizes, ["group", "good"]).select("labelled_id", "good", (1 / F.col("n")).alias("vote")), "votes", compact=True)
    votes = F.broadcast(votes)  # LABELLED rows at most

    total = votes.agg(F.sum(F.when(F.col("good"), F.col("vote"))), F.sum("vote"), F.count_if("good")).first()
    raw = max(1, texts.count())
    docs_ = (total[0] or 0.0, total[1] or 0.0, (total[2] or 0) / raw)
    shapes = _ratios(_counts(texts, votes, None, limit), docs_, surprise=10, support=0.001, most=-0.7)
    words = _ratios(_counts(texts, votes, shapes, limit), docs_, surprise=12, support=0.004, most=-2.0)
    return Model(shapes, words)


def weight(text: Column, model: Model) -> Column:
    """Log importance of a text; 0 for null and empty ones."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = Hashes()
        for b in batches:
            parts = [g.scores(model) for g in grams(b.tolist(), hashes)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))
        give_back()

    return run(text)


def gumbel_key(w: Column, doc_id: Column, temperature: float, seed: int) -> Column:
    """weight / temperature plus Gumbel noise that hangs on id and seed alone."""
    u = (F.xxhash64(F.lit(seed), doc_id).bitwiseAND(F.lit(2**53 - 1)) + F.lit(0.5)) / float(2**53)
    return w / temperature - F.log(-F.log(u))


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The ``k``-th largest value of ``keys`` (key), by counting in bins that narrow around it."""
    lo, hi, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k >= n:
        return float("-inf")
    above = 0
    while True:
        width = (hi - lo) / bins
        if width <= max(abs(lo), abs(hi), 1e-300) * 1e-14:
            return lo
        inside = keys.filter((F.col("key") >= lo) & (F.col("key") <= hi))
        cell = F.least(F.lit(bins - 1), F.floor((F.col("key") - lo) / width))
        counted = inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy(F.desc("cell")).collect()
        for row in counted:
            if above + row["n"] >= k:
                break
            above += row["n"]
        if row["lo"] == row["hi"] or above + row["n"] == k:
            return row["lo"]
        lo, hi = row["lo"], row["hi"]


def _threshold(scored: DataFrame, limit: float) -> float:
    """Of ``scored`` (w, key), the key that the last of k has; k: documents with a weight over ``limit``."""
    k = scored.filter(F.col("w") > limit).count()
    return kth_largest(scored.select("key"), k) if k else float("inf")


def resample(docs: DataFrame, labels: DataFrame, limit: float = -5.0, temperature: float = 0.25, seed: int = 1) -> DataFrame:
    """doc_id, weight, key, kept of ``docs`` (doc_id, text).

    k is the number of documents with a weight over ``limit``, so with little noise the
    sample is them.  Null and empty texts have weight 0 and so are kept.  Rows with equal
    ids and texts have equal keys and share their lot; where they tie for the last place
    all stay.  Rows without id share one draw of noise.  Texts of any length are read whole,
    an empty table gives an empty one, and other columns of ``docs`` are ignored, whatever
    their names.  Reruns agree.
    """
    model = fit(docs, labels)
    d = docs.select("doc_id", weight(F.col("text"), model).alias("w"))
    d = stored(d.withColumn("key", gumbel_key(F.col("w"), F.col("doc_id"), temperature, seed)), "weights")
    last = _threshold(d, limit)
    return d.select("doc_id", F.col("w").alias("weight"), "key", (F.col("key") >= F.lit(last)).alias("kept"))


def kept_rows(docs: DataFrame, labels: DataFrame, limit: float = -5.0, temperature: float = 0.25, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` that ``resample`` keeps, with all their columns.

    Rows are stored with their weights, so each text is weighed once and none is shuffled.
    ``docs`` must not have columns named __w or __key.
    """
    model = fit(docs, labels)
    d = stored(docs.withColumn("__w", weight(F.col("text"), model)), "weights")
    d = d.withColumn("__key", gumbel_key(F.col("__w"), F.col("doc_id"), temperature, seed))
    last = _threshold(d.select(F.col("__w").alias("w"), F.col("__key").alias("key")), limit)
    return d.filter(F.col("__key") >= F.lit(last)).select(*docs.columns)


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """All documents weighed and sampled."""
    return resample(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
