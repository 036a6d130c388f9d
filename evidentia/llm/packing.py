"""Packing by optimal length buckets.

The lengths of all documents go into one global histogram; dynamic programming over it
chooses the bucket boundaries that minimise padding.  Inside a bucket, documents in a
hashed order form batches of as many rows as the token budget allows at the bucket's
padded length.

Lengths are exact up to ``EXACT``; longer ones share a cell with others of the same 1/64 of
their power of two, and a cell stands at its greatest length.  So the histogram has at most
``EXACT`` + 64 cells a power of two and is safe on the driver, whatever the corpus; up to
``EXACT`` the boundaries are the best there are, and no bucket is longer than a document.
The program takes time and memory in proportion to the cells.  Positions in a bucket come from prefix sums in two levels, so no task holds a bucket.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import read, stored, word_count

EXACT = 1 << 16
_STEPS = 64
_ROWS_A_SHARD = 500


class Packed(NamedTuple):
    rows: DataFrame
    buckets: list[int]  # padded lengths, ascending


def cell(n: Column) -> Column:
    """The length that a length is rounded up to in the histogram."""
    power = F.floor(F.log2(n.cast("double") - 0.5)).cast("int")  # 2^power < n <= 2^(power + 1)
    step = F.pow(F.lit(2.0), power).cast("long") / _STEPS
    return F.when(n <= EXACT, n).otherwise((F.ceil(n / step) * step).cast("long"))


def _hull_minima(lines: list[tuple[int, int]], at: list[int]) -> list[int]:
    """Which of the lines (height, fall: y = height - fall * x; falls ascending) is least at each x (ascending), line i being there from x i on."""
    hull: list[int] = []
    out, first = [], 0

    def useless(a: int, b: int, c: int) -> bool:  # b is nowhere below both a and c
        (ha, fa), (hb, fb), (hc, fc) = lines[a], lines[b], lines[c]
        return (hc - ha) * (fb - fa) <= (hb - ha) * (fc - fa)

    y = lambda j, x: lines[j][0] - lines[j][1] * x
    for i, x in enumerate(at):
        while len(hull) - first >= 2 and useless(hull[-2], hull[-1], i):
            hull.pop()
        hull.append(i)
        while first + 1 < len(hull) and y(hull[first + 1], x) <= y(hull[first], x):
            first += 1
        out.append(hull[first])
    return out


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Padded lengths of at most ``buckets`` buckets over a histogram (ascending lengths) with the least padding.

    A last bucket of cells j..i adds lengths[i] * (many[i + 1] - many[j]) to the best of the
    cells before j: for given i the least of lines in lengths[i], found on their lower hull.
    """
    size = [int(x) for x in lengths]
    many = [0]
    for c in counts:
        many.append(many[-1] + int(c))
    n = len(size)
    if n == 0:
        return []
    best = [size[i] * many[i + 1] for i in range(n)]  # all up to cell i in one bucket: slots, padded
    cuts = []
    for _ in range(min(buckets, n) - 1):
        cut = _hull_minima(list(zip([0, *best[:-1]], many[:-1], strict=True)), size)
        before = [0, *best]
        best = [before[j] + size[i] * (many[i + 1] - many[j]) for i, j in enumerate(cut)]
        cuts.append(cut)
    out, i = [], n - 1
    for cut in reversed(cuts):
        out.append(size[i])
        i = cut[i] - 1
        if i < 0:
            return out[::-1]
    return [*out, size[i]][::-1]


def pack(docs: DataFrame, buckets: int = 16, budget: int = 65_536, size: Column | None = None, seed: int = 1) -> Packed:
    """``docs`` (doc_id, text, ...) as doc_id, n_tokens, bucket, padded_length, batch_id, place.

    ``size`` gives the tokens of a row, words of the text by default.  A batch has
    floor(``budget`` / padded length) rows, 1 at least: a document over the budget is a
    batch by itself.  Only the last batch of a bucket has fewer rows.  Null and empty
    texts have 0 tokens and no batch (bucket and later columns null).  Repeated rows each
    take a place; a shared id is no matter, and ties of the hashed order are broken by id.  An
    empty table gives an empty one.  Of other columns only those named in ``size`` are read.
    """
    d = docs.select("doc_id", (word_count(F.col("text")) if size is None else F.coalesce(size.cast("long"), F.lit(0))).alias("n_tokens"))
    d = stored(d.withColumn("cell", F.when(F.col("n_tokens") > 0, cell(F.col("n_tokens")))), "lengths")
    histogram = d.filter("cell is not null").groupBy("cell").agg(F.max("n_tokens").alias("top"), F.count("*").alias("n")).select("top", "n").orderBy("top").collect()
    tops = boundaries(np.array([r[0] for r in histogram], np.int64), np.array([r[1] for r in histogram], np.int64), buckets)
    if not tops:
        empty = {"bucket": "int", "padded_length": "long", "batch_id": "string", "place": "int"}
        return Packed(d.drop("cell").withColumns({c: F.lit(None).cast(t) for c, t in empty.items()}), [])
    top = F.lit(np.array(tops, np.int64))
    bucket = F.aggregate(top, F.lit(0), lambda a, x: a + F.when(x < F.col("n_tokens"), 1).otherwise(0))
    counts = [0] * len(tops)
    for length, n in histogram:
        counts[int(np.searchsorted(tops, length))] += n
    shards = F.element_at(F.lit(np.array([-(-c // _ROWS_A_SHARD) for c in counts], np.int64)), F.col("bucket") + 1)
    key = F.xxhash64(F.lit(seed), "doc_id", "n_tokens").bitwiseAND(F.lit(2**63 - 1))
    p = d.filter("cell is not null").withColumn("bucket", bucket).withColumn("padded_length", F.element_at(top, F.col("bucket") + 1))
    p = p.withColumn("key", key).withColumn("shard", F.floor(F.col("key") / float(2**63) * shards))
    sums = p.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    first = F.sum("n").over(Window.partitionBy("bucket").orderBy("shard")) - F.col("n")
    sums = sums.select("bucket", "shard", first.alias("first"))
    here = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("key", "doc_id"))
    p = p.withColumn("here", here).join(sums, ["bucket", "shard"]).withColumn("at", F.col("first") + F.col("here") - 1)
    rows = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("padded_length")))
    batch = F.concat_ws("-", F.col("bucket"), F.floor(F.col("at") / rows))
    p = p.select("doc_id", "n_tokens", "bucket", "padded_length", batch.alias("batch_id"), (F.col("at") % rows).cast("int").alias("place"))
    none = d.filter("cell is null").select("doc_id", "n_tokens")
    return Packed(p.unionByName(none, allowMissingColumns=True), tops)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into 16 buckets, batches of 65,536 words."""
    return pack(read(spark, sf_dir, "documents").select("doc_id", "text")).rows
