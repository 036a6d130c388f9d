"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that starts twice or more.

1. Candidates.  Every start of a ``LENGTH``-byte string is labelled with the least hash of
   the 32-byte strings inside it.  Equal strings have equal labels, and neighbouring
   starts mostly share one: a run of starts with one label is a segment, about one for
   each 85 bytes.  A start can repeat only if its label occurs in two segments, or twice in
   its own (periodic text).
2. Copies.  Segments with the same label and content are counted; what occurs twice or
   more is repeated as a whole, and only one of each content goes on.
3. Shards.  Labels with several contents, or periodic ones, are dealt to shards of about ``SHARD`` bytes.  In
   a shard, the suffix array of the segments is built by Larsson-Sadakane refinement,
   common prefixes follow by Kasai's rule, and a start whose prefix shared with a
   neighbour has ``LENGTH`` bytes is repeated.
4. Narrowing.  A label with more than ``SPLIT`` contents is cut finer: its segments are labelled
   anew by longer inner strings (the next of ``KMERS``), within the old label.  Equal
   strings stay together, others part, and copies that an edit kept apart meet.  What is
   handed on stays a segment, not a start.
5. Merging.  A label that has more than ``SPLIT`` contents even at the last of ``KMERS`` (strings
   that differ in a few bytes of 200) is split over shards.  Each of these hands on a
   sorted run of its distinct strings' 128-bit hashes, cut by ranges; the runs of a range
   are merged by binary search of each in all.
6. Spans.  Repeated starts meet their texts, which cross the network once.

Aggregations combine on the map side and joins are on unique keys, so a segment that a
third of all documents share is no burden.  Nothing is sampled or capped.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import give_back, read, stored

LENGTH = 200
#: Lengths of the inner strings that labels are made of, by level.
KMERS = (32, 104, 168)
SHARD = 1_500_000
SPLIT = 1500
#: A run of starts is cut after so many.
RUN = 512
#: Bytes of texts that are hashed together.
_CHUNK = 400_000
#: Texts whose segments are cut out together.
_ROWS = 500

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _C
    return h ^ (h >> np.uint64(29))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as little-endian numbers; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data), "<u8", padded.tobytes(), strides=(1,)).copy()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Segments:
    """Segments of texts: their labels, content hashes and first and last starts."""

    def __init__(self, length: int = LENGTH, kmer: int = KMERS[0]) -> None:
        self.length, self.kmer, self.power, self.inverse = length, kmer, _powers(_B, 1), _powers(_INVERSE, 1)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, lo, hi, label, content, whether the label occurs twice within) of all segments."""
        size = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data)
        if n < self.length:
            return tuple(np.empty(0, t) for t in (np.int64, np.int32, np.int32, np.int64, np.int64, np.bool_))
        if len(self.power) < n:
            self.power, self.inverse = _powers(_B, 2 * n), _powers(_INVERSE, 2 * n)
        w = _words(data)
        h, width = _mixed(w * _A), 8
        content = h
        while width < self.kmer:
            step = min(width, self.kmer - width)
            h = _mixed(h[:-step] * _B + h[step:])
            width += step
        kmers, window = h, self.length - self.kmer + 1
        h = _sliding(h, window, np.minimum)
        begin = np.repeat(np.cumsum(size) - size, size)[: len(h)]
        of = np.repeat(np.arange(len(texts)), size)[: len(h)]
        place = np.arange(len(h)) - begin
        inside = place + self.length <= size[of]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        # long runs are cut at equal steps from where they begin
        first = np.flatnonzero(new)
        run = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
        lo = np.flatnonzero((new | (run % RUN == 0)) & inside)
        last = np.ones(len(h), bool)
        last[:-1] = new[1:] | (run[1:] % RUN == 0) | ~inside[1:]
        hi = np.flatnonzero(last & inside)
        # content: a polynomial over mixed 8-byte words that end within the segment
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(content * self.power[:n], dtype=np.uint64, out=total[1:])
        content = _mixed((total[hi + self.length - 7] - total[lo]) * self.inverse[lo] + (hi - lo).astype(np.uint64))
        return of[lo], place[lo].astype(np.int32), place[hi].astype(np.int32), h[lo].view(np.int64), content.view(np.int64), _twice(kmers, h, lo, hi, window)


def _sliding(x: np.ndarray, window: int, best: np.ufunc) -> np.ndarray:
    """``best`` of each ``window`` neighbours."""
    step = 1
    while 2 * step <= window:
        x = best(x[:-step], x[step:])
        step *= 2
    return best(x[: len(x) - (window - step)], x[window - step :]) if window > step else x


def _twice(kmers: np.ndarray, least: np.ndarray, lo: np.ndarray, hi: np.ndarray, window: int) -> np.ndarray:
    """Whether the least hash of the starts lo to hi belongs to several of their inner strings."""
    edge = np.full(window - 1, least.min(initial=np.uint64(0)), np.uint64)
    some = np.flatnonzero(kmers == _sliding(np.concatenate([edge, least, edge]), window, np.maximum))  # the least of a window they are in
    at, end = np.searchsorted(some, lo), np.searchsorted(some, hi + window)
    label, found = least[lo], np.zeros(len(lo), np.int64)
    go = np.arange(len(lo))
    while len(go):
        found[go] += kmers[some[at[go]]] == label[go]
        at[go] += 1
        go = go[(found[go] < 2) & (at[go] < end[go])]
    return found > 1


def suffix_array(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of segments that lie end to end in ``data``, the first bytes at ``start``.

    A suffix ends with its segment; equal ones are ordered by segment.  Larsson-Sadakane:
    groups of suffixes with equal beginnings of h symbols are refined by the ranks h on,
    only as long as they have several members.
    """
    n = len(data)
    size = np.diff(np.append(start, n))
    place = np.arange(n, dtype=np.int32)
    segment = np.repeat(np.arange(len(start), dtype=np.int32), size)
    rest = np.repeat((start + size).astype(np.int32), size) - place
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([data, np.zeros(7, np.uint8)])
    for i in range(7):
        key <<= np.uint64(8)
        key |= np.where(rest > i, padded[i : n + i], np.uint8(0))
    key <<= np.uint64(3)
    key |= np.minimum(rest, 7).astype(np.uint8)
    sa = np.argsort(key).astype(np.int32)
    key = key[sa]
    fresh = np.ones(n, bool)
    fresh[1:] = key[1:] != key[:-1]
    del key
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(fresh, place, 0))
    h = 7
    # places in sa of members of groups of several
    open_ = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
    while len(open_):
        at = sa[open_]
        own = rank[at]
        on = np.where(rest[at] > h, rank[np.minimum(at + h, n - 1)] + len(start), segment[at])
        order = np.argsort(own.astype(np.int64) * (n + len(start)) + on)  # one key for both
        at, own, on = at[order], own[order], on[order]
        sa[open_] = at
        differs = np.ones(len(at), bool)
        differs[1:] = (own[1:] != own[:-1]) | (on[1:] != on[:-1])
        rank[at] = open_[np.maximum.accumulate(np.where(differs, np.arange(len(at)), 0))]
        open_ = open_[~differs | ~np.append(differs[1:], True)]
        h *= 2
    return sa, rank


def common_prefixes(data: np.ndarray, start: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of each suffix and the one before it in order, the common length (0 for the first), by place in ``data``.

    Kasai: from one place to the next the length falls by 1 at most.  All segments go
    through their places at once.
    """
    n = len(data)
    size = np.diff(np.append(start, n))
    end = np.repeat((start + size).astype(np.int32), size)
    w = _words(data)
    out = np.zeros(n, np.int32)
    lanes = np.argsort(-size, kind="stable")
    begin, left = start[lanes], size[lanes]
    h = np.zeros(len(lanes), np.int64)
    for t in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-left, -t, side="left"))  # segments longer than t come first
        i = begin[:live] + t
        hh = np.maximum(h[:live] - 1, 0)
        before = rank[i] - 1
        j = sa[np.maximum(before, 0)]
        most = np.minimum(end[i] - i, end[j] - j)
        most[before < 0] = 0
        hh = np.minimum(hh, most)
        go = np.flatnonzero(hh < most)
        while len(go):
            x = w[i[go] + hh[go]] ^ w[j[go] + hh[go]]
            low = x & (~x + np.uint64(1))
            same = np.where(x == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) // 8)
            hh[go] = np.minimum(hh[go] + same, most[go])
            go = go[(x == 0) & (hh[go] < most[go])]
        h[:live] = hh
        out[i] = hh
    return out


def repeated_starts(parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, start, whether each place starts a string that another place starts too, whether one of ``length`` bytes starts there, sa)."""
    size = np.array([len(p) for p in parts], np.int64)
    start = np.cumsum(size) - size
    data = np.frombuffer(b"".join(parts), np.uint8)
    sa, rank = suffix_array(data, start)
    lcp = common_prefixes(data, start, sa, rank)[sa]
    twice = lcp >= length
    twice[:-1] |= twice[1:]
    out = np.zeros(len(data), bool)
    out[sa] = twice
    full = np.repeat((start + size - length).astype(np.int32), size) >= np.arange(len(data), dtype=np.int32)
    return data, start, out, full, sa


def _string_hashes(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    w = _words(data)
    a, b = np.full(len(at), _A), np.full(len(at), _B)
    steps = [*range(0, length - 7, 8)] + ([length - 8] if length % 8 else [])
    for i in steps:
        x = w[at + i]
        a, b = _mixed((a + x) * _B), _mixed((b ^ x) * _A)
    return a.view(np.int64), b.view(np.int64)


def _intervals(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - 1


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (__key, text, ...) with the first and last starts of runs of repeated strings: arrays __lo, __hi.

    ``__key`` (long) must be unique or repeat only with equal texts.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segments = Segments(length)
        for b in batches:
            keys = b["key"].to_numpy()
            for rows, part in _parts((None if t is None else t.encode("utf-8", "surrogatepass") for t in b["text"]), length):
                of, lo, hi, label, content, own = segments.of(part)
                yield pd.DataFrame({"label": label, "content": content, "key": keys[rows[of]], "lo": lo, "hi": hi, "own": own})
        give_back()

    occurrences = stored(docs.select(F.col("__key").alias("key"), "text").mapInPandas(cut, "label long, content long, key long, lo int, hi int, own boolean"), "occurrences")
    often = occurrences.groupBy("label").agg(F.count("*").alias("times"), F.max("own").alias("own")).filter("times > 1 or own").select("label")
    found = stored(occurrences.join(often, "label"), "segments")

    distinct = found.groupBy("label", "content").agg(F.count("*").alias("n"), F.first("key").alias("key"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.max("own").alias("own"))
    distinct = stored(distinct.withColumn("copied", F.col("n") > 1), "contents")
    spans = _copies(found, distinct)
    several, shards, heavy = _labels(distinct, length)
    asked = distinct.join(several, "label").withColumn("heavy", F.col("contents") > SPLIT).withColumn("shard", _shard(0, shards))
    asked = asked.groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "label", "shard", "copied", "heavy")).alias("w"))
    asked = asked.select(F.col("key").alias("__of"), *(F.col(f"w.{c}").alias(f"__{c}") for c in ("lo", "hi", "label", "shard", "copied", "heavy")))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first in range(0, len(b), _ROWS):
                rows = []
                for key, text, *asked in b[first : first + _ROWS].itertuples(index=False):
                    data = text.encode("utf-8", "surrogatepass")
                    rows += [(key, lo, label, shard, copied, heavy, data[lo : hi + length]) for lo, hi, label, shard, copied, heavy in zip(*asked, strict=True)]
                yield pd.DataFrame(rows, columns=["key", "lo", "label", "shard", "copied", "heavy", "data"])
        give_back()

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for b in batches for r in b.itertuples(index=False))
        for _, group in itertools.groupby(rows, key=lambda r: r.shard):
            yield _search(list(group), length)
            give_back()

    mine = docs.join(asked, F.col("__key") == F.col("__of")).select("__key", "text", "__lo", "__hi", "__label", "__shard", "__copied", "__heavy")
    pieces = mine.mapInPandas(fetch, "key long, lo int, label long, shard long, copied boolean, heavy boolean, data binary")
    settled = []
    for level, kmer in enumerate(k for k in KMERS[1:] if k < length):
        if not heavy:
            break
        pieces = stored(pieces, "pieces")
        settled.append(pieces.filter("not heavy"))
        found = stored(_narrowed(pieces.filter("heavy"), length, kmer), "narrowed")
        distinct = found.groupBy("label", "content").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("key", "lo", "hi", "copied", "data")), F.max("own").alias("own"))
        distinct = stored(distinct.withColumn("copied", F.col("copied") | (F.col("n") > 1)), "contents")
        spans = spans.unionByName(_copies(found, distinct))
        several, shards, heavy = _labels(distinct, length)
        finer = distinct.join(several, "label").withColumn("heavy", F.col("contents") > SPLIT)
        if heavy:  # of the last level: by content
            split = F.xxhash64("label", F.pmod(F.col("content"), F.ceil(F.col("contents") / SPLIT)))
            finer = finer.withColumn("shard", F.when(F.col("heavy"), split).otherwise(_shard(level + 1, shards)))
        else:
            finer = finer.withColumn("shard", _shard(level + 1, shards))
        pieces = finer.select(*pieces.columns)
    for more in settled:
        pieces = pieces.unionByName(more)
    pieces = pieces.repartition("shard").sortWithinPartitions("shard", "label")
    hits = pieces.mapInPandas(search, "key long, lo int, hi int, label long, h1 long, h2 long, single boolean")
    if heavy:
        hits = stored(hits, "hits", compact=True)
        runs = hits.filter("h1 is not null").withColumn("slice", F.shiftright("h1", 52))
        runs = runs.repartition("label", "slice").sortWithinPartitions("label", "slice")
        spans = spans.unionByName(hits.filter("h1 is null").select("key", "lo", "hi")).unionByName(runs.mapInPandas(_merge, "key long, lo int, hi int"))
    else:
        spans = spans.unionByName(hits.select("key", "lo", "hi"))
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("s")).select(F.col("key").alias("__of"), F.col("s.lo").alias("__lo"), F.col("s.hi").alias("__hi"))
    return docs.join(spans, F.col("__key") == F.col("__of"), "left").drop("__of")


def _parts(texts: Iterator[bytes | None], length: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(places, texts) of texts of ``length`` bytes at least, some ``_CHUNK`` bytes at a time."""
    rows, part, size = [], [], 0
    for i, t in enumerate(texts):
        if t is not None and len(t) >= length:
            rows.append(i)
            part.append(t)
            size += len(t)
        if size > _CHUNK:
            yield np.array(rows), part
            rows, part, size = [], [], 0
    if part:
        yield np.array(rows), part


def _copies(found: DataFrame, distinct: DataFrame) -> DataFrame:
    """(key, lo, hi) of the segments ``found`` whose content occurs several times."""
    return found.join(distinct.filter("n > 1").select("label", "content"), ["label", "content"]).select("key", "lo", "hi")


def _labels(distinct: DataFrame, length: int) -> tuple[DataFrame, int, bool]:
    """(label, contents) of labels whose strings may repeat in part; shards for those up to ``SPLIT`` contents; whether others exist."""
    several = distinct.groupBy("label").agg(F.count("*").alias("contents"), F.sum(F.col("hi") - F.col("lo") + length).alias("bytes"), F.max("own").alias("own")).filter("contents > 1 or own").drop("own")
    several = stored(several, "labels", compact=True)
    size, heavy = several.agg(F.sum(F.when(F.col("contents") <= SPLIT, F.col("bytes"))), F.count_if(F.col("contents") > SPLIT)).first()
    return several.drop("bytes"), max(1, (size or 0) // SHARD), heavy > 0


def _shard(level: int, shards: int) -> Column:
    return F.xxhash64(F.lit(level), F.pmod(F.xxhash64("label"), F.lit(shards)))


def _narrowed(pieces: DataFrame, length: int, kmer: int) -> DataFrame:
    """Segments of ``pieces`` by labels of ``kmer`` bytes within theirs; with their bytes, and whether they are copied already."""

    def recut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segments = Segments(length, kmer)
        for b in batches:
            key, lo, label, copied = (b[c].to_numpy() for c in ("key", "lo", "label", "copied"))
            for rows, part in _parts(b["data"], length):
                of, a, z, finer, content, own = segments.of(part)
                row = rows[of]
                finer = _mixed((finer.view(np.uint64) + _A) * _B + label[row].view(np.uint64)).view(np.int64)
                data = [part[i][x : y + length] for i, x, y in zip(of, a, z, strict=True)]
                yield pd.DataFrame({"label": finer, "content": content, "key": key[row], "lo": lo[row] + a, "hi": lo[row] + z, "own": own, "copied": copied[row], "data": data})

    return pieces.mapInPandas(recut, "label long, content long, key long, lo int, hi int, own boolean, copied boolean, data binary")


def _search(rows: list, length: int) -> pd.DataFrame:
    """Repeated starts of a shard's segments that aren't copied as a whole; of split labels also its run of strings."""
    parts, out = [r.data for r in rows], []
    data, start, twice, full, sa = repeated_starts(parts, length)
    for r, a in zip(rows, start, strict=True):
        if not r.copied:
            out += [(r.key, r.lo + lo, r.lo + hi) for lo, hi in zip(*_intervals(twice[a : a + len(r.data)]), strict=True)]
    frame = pd.DataFrame(out, columns=["key", "lo", "hi"]).astype({"key": "int64", "lo": "int32", "hi": "int32"})
    frame = frame.assign(label=None, h1=None, h2=None, single=None).astype(_RUN)
    if any(r.heavy for r in rows):
        order = sa[full[sa]]
        a, b = _string_hashes(data, order, length)
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        order, a, b = order[new], a[new], b[new]
        of = np.searchsorted(start, order, side="right") - 1
        key, lo, label, copied = (np.array([getattr(r, c) for r in rows])[of] for c in ("key", "lo", "label", "copied"))
        lo = (lo + order - start[of]).astype(np.int32)
        run = pd.DataFrame({"key": key, "lo": lo, "hi": lo, "label": label, "h1": a, "h2": b, "single": ~twice[order] & ~copied})
        frame = pd.concat([frame, run.astype(_RUN)])
    return frame


#: Nullable kinds, as floats would round the hashes.
_RUN = {"label": "Int64", "h1": "Int64", "h2": "Int64", "single": "boolean"}


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Strings single in their shard that another shard has too: each run is searched in all of its range."""
    for group in _groups(batches, ["label", "slice"]):
        key = np.empty(len(group), [("a", "<i8"), ("b", "<i8")])
        key["a"], key["b"] = group["h1"], group["h2"]
        code = np.unique(key, return_inverse=True)[1]
        runs = np.sort(code)
        times = np.searchsorted(runs, code, side="right") - np.searchsorted(runs, code, side="left")
        yield group[(times > 1) & group["single"].to_numpy(bool)][["key", "lo", "hi"]]


def _groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of sorted rows, whole across batches."""
    held: list[pd.DataFrame] = []
    for b in batches:
        for _, g in b.groupby(by, sort=False):
            if held and tuple(held[0][by].iloc[0]) != tuple(g[by].iloc[0]):
                yield pd.concat(held)
                held = []
            held.append(g)
    if held:
        yield pd.concat(held)


def _covered(lo, hi, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings of ``length`` starting from each lo to each hi cover, as (begin, end)."""
    if lo is None:
        return []
    out: list[list[int]] = []
    for a, z in sorted(zip(lo, hi, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z + length)
        else:
            out.append([a, z + length])
    return [(a, z) for a, z in out]


def _without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *itertools.chain(*runs), len(data)]
    return b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a long ``__key``: the id where ids are unique integers, else a hash of id and text; null texts made empty."""
    text = F.coalesce("text", F.lit(""))
    kind = docs.schema["doc_id"].dataType.simpleString()
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").limit(1)
    plain = kind in ("tinyint", "smallint", "int", "bigint") and unclear.count() == 0
    return docs.withColumns({"text": text, "__key": F.col("doc_id").cast("long") if plain else F.xxhash64("doc_id", text)})


def removed_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of ``docs`` (doc_id, text).

    Strings are judged on the input; matches never cross documents.  Null and empty texts
    have no bytes, and below ``length`` bytes nothing goes.  Repeated rows each count, and
    so repeat each other's strings.  Ids may be null or shared; rows are then told apart by a
    64-bit hash of id and text.  Texts of any length are read whole, an empty table gives an
    empty one, and other columns are ignored, whatever their names.
    """

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def digest(text: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
        rows = []
        for t, a, z in zip(text, lo, hi, strict=True):
            data, runs = t.encode("utf-8", "surrogatepass"), _covered(a, z, length)
            kept = _without(data, runs)
            rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    d = repeated_spans(_keyed(docs.select("doc_id", "text")), length)
    return d.select("doc_id", digest("text", "__lo", "__hi").alias("d")).select("doc_id", "d.*")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeated bytes cut out of the texts; other columns stay as they are.

    A character that loses some of its bytes goes as a whole.  Null texts become empty.
    Rows whose texts are used up stay, with an empty text.
    """

    @F.pandas_udf("string")
    def cut(text: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
        return pd.Series([_without(t.encode("utf-8", "surrogatepass"), _covered(a, z, length)).decode("utf-8", "ignore") for t, a, z in zip(text, lo, hi, strict=True)])

    d = repeated_spans(_keyed(docs), length)
    return d.withColumn("text", cut("text", "__lo", "__hi")).select(*docs.columns)


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated 200-byte strings."""
    return removed_bytes(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT doc_id, i, sha256(substr(h, 2 * i + 1, 400)) AS s FROM (SELECT doc_id, h, unnest(generate_series(0, n - 200)) AS i FROM d WHERE n >= 200)),
twice AS (SELECT s FROM starts GROUP BY s HAVING count(*) > 1),
repeated AS (SELECT doc_id, i FROM starts SEMI JOIN twice USING (s)),
marks AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER w + 200 OR lag(i) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
grouped AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marks),
spans AS (SELECT doc_id, g, min(i) AS a, max(i) + 200 AS z FROM grouped GROUP BY 1, 2),
gaps AS (SELECT doc_id, g, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM spans
         UNION ALL SELECT doc_id, 1000000000, max(z), NULL FROM spans GROUP BY 1),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * f + 1, 2 * (coalesce(t, n) - f)), '' ORDER BY f) AS k FROM gaps JOIN d USING (doc_id) GROUP BY 1),
sums AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM spans GROUP BY 1)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
