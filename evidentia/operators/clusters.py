"""Complete-link clustering of blocks by pair scores."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_complete(keys: list[str], score: np.ndarray, threshold: int) -> list[list[str]]:
    """Clusters of ``keys``: the two whose worst cross score is highest merge, while it reaches ``threshold``; of equals the first by sorted members."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    members = [[keys[i]] for i in order]
    s = np.asarray(score)[np.ix_(order, order)]
    np.fill_diagonal(s, -1)
    # a cluster stays at the place of its least key; each place knows the first of its best partners after it, as scores only fall
    best, partner = np.full(len(keys), -1, s.dtype), np.full(len(keys), -1)

    def look(i: int) -> None:
        later = s[i, i + 1 :]
        at = int(later.argmax()) if len(later) else -1
        best[i], partner[i] = (later[at], i + 1 + at) if at >= 0 else (-1, -1)

    for i in range(len(keys)):
        look(i)
    while len(keys):
        i = int(best.argmax())
        if best[i] < threshold:
            break
        j = int(partner[i])
        members[i] += members[j]
        members[j] = []
        s[i] = s[:, i] = np.minimum(s[i], s[j])
        s[i, i] = s[j] = s[:, j] = best[j] = -1
        for r in np.flatnonzero(((partner == i) | (partner == j)) & (best >= threshold)):
            look(r)
        look(i)
    return [sorted(m) for m in members if m]


def _connected(keys: set[str], links: list) -> Iterator[tuple[list[str], list]]:
    """Parts of ``keys`` that ``links`` (a, b, score_ppm) connect, with their links."""
    near: dict[str, list] = {k: [] for k in keys}
    for r in links:
        near[r.a].append(r)
        near[r.b].append(r)
    left = set(keys)
    for k in sorted(keys):
        if k not in left:
            continue
        left.discard(k)
        part, mine, ahead = [k], [], [k]
        while ahead:
            x = ahead.pop()
            for r in near[x]:
                mine += [r] if r.a == x else []
                y = r.b if r.a == x else r.a
                if y in left:
                    left.discard(y)
                    part.append(y)
                    ahead.append(y)
        yield sorted(part), mine


def _matrix(keys: list[str], links: list) -> np.ndarray:
    at = {k: i for i, k in enumerate(keys)}
    small = max((r.score_ppm for r in links), default=0) < 2**31
    score = np.zeros((len(keys), len(keys)), np.int32 if small else np.int64)
    for r in links:
        score[at[r.a], at[r.b]] = score[at[r.b], at[r.a]] = r.score_ppm
    return score


def complete_link(items: DataFrame, pairs: DataFrame, threshold_ppm: int, block: str = "block") -> DataFrame:
    """(block, key, cluster) of ``items`` (block, key string) by ``pairs`` (block, a, b, score_ppm).

    A missing pair scores 0; the cluster is named by its least key.  Pairs under the threshold
    can't be in a cluster, so they aren't shuffled, and what the others don't connect is
    clustered apart: work and memory are quadratic in a connected part of a block, not in
    the block.  A block's keys and connecting pairs meet in one task.
    """
    if threshold_ppm < 1:
        raise ValueError("threshold_ppm must be at least 1")
    scored = pairs.select(block, F.col("a"), F.col("b"), F.col("score_ppm").cast("long").alias("score_ppm")).filter(F.col("score_ppm") >= threshold_ppm)
    rows = items.select(block, F.col("key").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(0).cast("long").alias("score_ppm")).distinct().unionByName(scored)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = (r for b in batches for r in b.itertuples(index=False))
        for name, group in itertools.groupby(each, key=lambda r: r[0]):
            group = list(group)
            keys = {r.a for r in group if r.b is None}
            links = [r for r in group if r.b is not None and r.a in keys and r.b in keys and r.a != r.b]
            found = [c for part, mine in _connected(keys, links) for c in merge_complete(part, _matrix(part, mine), threshold_ppm)]
            yield pd.DataFrame([(name, k, c[0]) for c in found for k in c], columns=[block, "key", "cluster"])

    kind = items.schema[block].dataType.simpleString()
    return rows.repartition(block).sortWithinPartitions(block).mapInPandas(run, f"{block} {kind}, key string, cluster string")


#: Vectors of a block are dealt to chunks of about so many; each pair of chunks is one product of matrices.
CHUNK = 1000


def _cosines(x: list, y: list) -> np.ndarray:
    """Cosines in millionths, rounded; 0 for negative ones and where vectors are null, differ in length or have no direction."""
    wide = max((len(v) for v in [*x, *y] if v is not None), default=0)

    def laid(vs: list) -> tuple[np.ndarray, np.ndarray]:
        m = np.zeros((len(vs), wide))
        for r, v in enumerate(vs):
            if v is not None:
                m[r, : len(v)] = np.asarray(v, float)
        return m, np.array([-1 if v is None else len(v) for v in vs])

    (m, a), (n, b) = laid(x), laid(y)
    with np.errstate(invalid="ignore", divide="ignore"):
        cos = (m @ n.T) / np.sqrt((m * m).sum(1)[:, None] * (n * n).sum(1)[None, :])
    fit = (a[:, None] == b[None, :]) & np.isfinite(cos)
    return np.floor(np.maximum(0, np.where(fit, cos, 0)) * 1_000_000 + 0.5).astype(np.int64)


def cosine_pairs(vectors: DataFrame, block: str, key: str, vector: str, least: int = 0) -> DataFrame:
    """(block, a, b, score_ppm): cosine similarity of all pairs of a block, a before b, in millionths (negative ones 0), of those that reach ``least``."""
    v = vectors.select(block, F.col(key).cast("string").alias("a"), F.col(vector).cast("array<double>").alias("v")).filter(F.col(block).isNotNull() & F.col("a").isNotNull())
    sizes = v.groupBy(block).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    d = v.join(sizes, block).withColumn("chunk", F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int"))
    d = d.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    d = d.select(block, F.least("chunk", "with").alias("i"), F.greatest("chunk", "with").alias("j"), "chunk", "a", "v")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = (r for b in batches for r in b.itertuples(index=False))
        for (name, i, j), group in itertools.groupby(each, key=lambda r: (r[0], r.i, r.j)):
            group = list(group)
            x, y = ([r for r in group if r.chunk == c] for c in (i, j))
            score = _cosines([r.v for r in x], [r.v for r in y])
            p, q = (score >= least).nonzero()
            ka, kb = np.array([r.a for r in x], object)[p], np.array([r.a for r in y], object)[q]
            first = ka < kb
            keep = first if i == j else ka != kb
            out = pd.DataFrame({"a": np.where(first, ka, kb), "b": np.where(first, kb, ka), "score_ppm": score[p, q]})[keep]
            out.insert(0, block, [name] * len(out))
            yield out

    kind = vectors.schema[block].dataType.simpleString()
    return d.repartition(block, "i", "j").sortWithinPartitions(block, "i", "j").mapInPandas(run, f"{block} {kind}, a string, b string, score_ppm long")
