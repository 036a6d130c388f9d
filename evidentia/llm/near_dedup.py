"""MinHash near-dedup with HyperMinHash registers.

Each distinct shingle of a text falls into one of ``REGISTERS`` registers; a register
keeps of its least hash the count of leading zeros (6 bits) and the next 10 bits.  An
empty register borrows the value of another, found by a fixed sequence of probes, so that
short texts fill all.  Two texts agree in a register with a chance near their Jaccard
index J.  The registers form ``BANDS`` bands of ``ROWS``; at J = 0.8 a pair shares no band
once in 1,400 million pairs.

1. Texts with the same shingle set form a class; only its least id goes on.
2. Texts that share a band hang on two hubs of the band, its least and greatest by hash: a
   bucket of n gives 2 n edges, not n^2.  Edges whose collision-corrected estimate is
   under the threshold less ``SLACK`` (over five standard deviations) fall.  Texts of a
   bucket that these edges leave in several components are then compared with each other,
   registers against registers, so that every pair of a bucket is tried or connected.
3. Components of these edges are the units to verify: whole texts go there once.  A
   component over ``UNIT`` texts is split by hub into chunks that all hold the hub; what
   that leaves apart is then compared block by block, every pair of chunks in a task, but
   for pairs inside the component's largest group, which is linked already.
4. In a unit, the full shingle sets of all pairs are compared at once, by products of
   incidence matrices; links that span the components go on.
5. Components of the confirmed links are the result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import distinct_sorted, give_back, read, stored
from evidentia.llm.components import components

BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Chance that two independent registers agree: equal zeros (1/3) and equal mantissas.
COLLISION = 1 / 3 / 2**MANTISSA
SLACK = 0.22
#: Sets with fewer shingles go to verification whatever the estimate.
FEW = 16
UNIT = 400
UNIT_SHINGLES = 1_000_000
#: Registers of so many texts, twice, are compared in a task.
BUCKET = 1000
#: Spokes of a hub are dealt to so many tasks.
SALT = 16
_TABLE = 300_000
#: Shingles whose incidences are laid out as a matrix at a time.
_COLUMNS = 2048

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def _probes() -> np.ndarray:
    n = np.arange(REGISTERS * 64, dtype=np.uint64).reshape(REGISTERS, 64)
    return (_mixed(_mixed((n + np.uint64(1)) * _M1)) % np.uint64(REGISTERS)).astype(np.int64)


_PROBES = _probes()
#: For each register all buckets in an order of its own: where it looks when its probes find nothing.
_ORDERS = np.argsort(_mixed((_mixed(np.arange(REGISTERS**2, dtype=np.uint64) * _M1 + _M2) + np.uint64(3)) * _M1).reshape(REGISTERS, REGISTERS), axis=1)


class Words(dict):
    """64-bit hashes of words; emptied when full, which changes no hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _TABLE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str, n: int, table: Words) -> np.ndarray:
    """Sorted hashes of the distinct ``n``-word shingles; all words as one if there are fewer; none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = _mixed((out + h[i : len(h) - n + 1 + i]) * _M1)
    return distinct_sorted(out)


def registers(s: np.ndarray) -> np.ndarray:
    """The registers of a shingle set that isn't empty."""
    v = _mixed(s * _M1)
    bucket = (v % np.uint64(REGISTERS)).astype(np.int64)
    v = _mixed(v + _M2)
    best = np.full(REGISTERS, 2**64 - 1, np.uint64)
    np.minimum.at(best, bucket, v)
    full = np.zeros(REGISTERS, bool)
    full[bucket] = True
    least = best[full]
    # leading zeros: from the exponent of the top 53 bits, which float64 holds exactly
    high = least >> np.uint64(11)
    zeros = np.where(high > 0, 53 - np.frexp(high.astype(np.float64))[1], 53).astype(np.uint64)
    mantissa = (least << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - MANTISSA)
    out = np.zeros(REGISTERS, np.uint16)
    out[full] = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    if not full.all():
        empty = np.flatnonzero(~full)
        hits = full[_PROBES[empty]]
        at = _PROBES[empty, hits.argmax(1)]
        lost = ~hits.any(1)
        if lost.any():
            orders = _ORDERS[empty[lost]]
            at[lost] = orders[np.arange(len(orders)), full[orders].argmax(1)]
        out[empty] = out[at]
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, corrected for chance agreement."""
    return ((a == b).mean(-1) - COLLISION) / (1 - COLLISION)


def _as_rows(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, REGISTERS)


def features(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, set_id (equal sets have equal ids), registers; the last two null for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Words()
        for b in batches:
            rows = []
            for t in b["text"]:
                s = shingles(t, n, table)
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None, registers(s).tobytes() if len(s) else None))
            out = pd.DataFrame(rows, columns=["n_shingles", "set_id", "registers"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out
        del table
        give_back()

    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return d.mapInPandas(run, "doc_id long, n_shingles long, set_id binary, registers binary")


def candidate_edges(reps: DataFrame, least: float, percent: int = 0) -> DataFrame:
    """(a, b), stored: what connects all pairs of ``reps`` (doc_id, registers, n_shingles) that share a band and may link.

    A pair may link if the smaller set has ``percent`` of the shingles of the larger, and the
    estimate is ``least`` at least or either has few shingles.
    """
    width = 2 * ROWS
    band = lambda i: F.xxhash64(F.lit(i), F.substring("registers", 1 + width * i, width))
    bands = F.explode(F.array(*map(band, range(BANDS)))).alias("key")
    rows = reps.select("doc_id", bands)
    order = F.struct(F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("id"))
    hubs = rows.groupBy("key").agg(F.count("*").alias("n"), F.min(order).alias("lo"), F.max(order).alias("hi")).filter("n > 1")
    hubs = hubs.select("key", F.col("lo.id").alias("lo"), F.col("hi.id").alias("hi"))
    edges = rows.join(hubs, "key").select("doc_id", F.explode(F.array("lo", "hi")).alias("hub")).filter("doc_id <> hub")
    edges = edges.select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()

    @F.pandas_udf("double")
    def likely(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(estimate(_as_rows(a), _as_rows(b)))

    ra, rb = (reps.select(F.col("doc_id").alias(c), F.col("registers").alias(f"r{c}"), F.col("n_shingles").alias(f"n{c}")) for c in "ab")
    edges = edges.join(ra, "a").join(rb, "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    edges = stored(edges.filter((F.least("na", "nb") < FEW) | (likely("ra", "rb") >= least)).select("a", "b"), "candidates", compact=True)

    # buckets of up to three are all hubs and one spoke; equal buckets of several bands count once
    roots = components(edges).withColumnsRenamed({"node": "doc_id"})
    placed = stored(reps.join(roots, "doc_id", "left").withColumn("known", F.coalesce("root", "doc_id")).drop("root"), "placed")
    rows = placed.select("doc_id", "known", bands)
    mixed = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("known").alias("lo"), F.max("known").alias("hi"), F.bit_xor(F.xxhash64("doc_id", F.lit(5))).alias("x"), F.sum("doc_id").alias("y"))
    mixed = mixed.filter("n > 3 and lo < hi").groupBy("n", "lo", "hi", "x", "y").agg(F.min("key").alias("key")).select("key")
    d = rows.join(mixed, "key").select(F.col("key").alias("unit"), "doc_id", F.lit(0).alias("n_shingles"), "known")
    blocks = stored(_met(d, BUCKET), "buckets", compact=True)
    if not blocks.limit(1).count():
        return edges

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for b in batches for r in b.itertuples(index=False))
        for (_, i, j), group in itertools.groupby(rows, key=lambda r: (r.unit, r.i, r.j)):
            group = [*group]
            if len({r.chunk for r in group}) == 1 + (i < j):
                yield pd.DataFrame(_likely_pairs(group, least, percent), columns=["a", "b"])

    full = blocks.join(reps, "doc_id").repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")
    return edges.unionByName(stored(full.mapInPandas(compare, "a long, b long").distinct(), "candidates", compact=True))


def _likely_pairs(rows: list, least: float, percent: int) -> list[tuple[int, int]]:
    """Pairs that may link and connect what isn't of the same ``known``; with several ``chunk``, pairs inside a chunk are left out."""
    at = {}
    known = np.array([at.setdefault(r.known, len(at)) for r in rows])
    ids, chunk, size = (np.array([getattr(r, c) for r in rows]) for c in ("doc_id", "chunk", "n_shingles"))
    registers_ = np.frombuffer(b"".join(r.registers for r in rows), np.uint16).reshape(-1, REGISTERS)
    across = chunk.min() < chunk.max()
    out, group, ahead = [], known.copy(), np.ones(len(rows), bool)
    for i in np.argsort(np.bincount(known)[known], kind="stable"):  # the largest group last, which has then nothing to meet
        ahead[i] = False
        others = np.flatnonzero(ahead & (group != group[i]) & ((chunk != chunk[i]) if across else True))
        others = others[100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i])]
        if not len(others):
            continue
        hits = others[(np.minimum(size[others], size[i]) < FEW) | (estimate(registers_[others], registers_[i]) >= least)]
        for j in hits:
            if group[j] != group[i]:
                out.append((int(ids[j]), int(ids[i])))
                group[group == group[j]] = group[i]
    return out


def _units(edges: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(unit, part, doc_id): where each text is verified; and (node, root, chunks): its component."""
    roots = components(edges)
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    sized = roots.join(sizes.withColumnsRenamed({"doc_id": "node"}), "node")
    chunks = F.greatest(F.ceil(F.col("n") / UNIT), F.ceil(F.col("m") / UNIT_SHINGLES)).cast("int")
    totals = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("m")).withColumn("chunks", chunks)
    placed = stored(sized.join(totals, "root").select("node", "root", "chunks"), "placed", compact=True)
    whole = placed.filter("chunks <= 1").select(F.col("root").alias("unit"), F.lit(0).alias("part"), F.col("node").alias("doc_id"))
    # a large component: by hub, with the hub in every chunk
    hot = placed.filter("chunks > 1").select(F.col("node").alias("a"))
    spokes = edges.join(hot, "a").join(sizes.withColumnsRenamed({"doc_id": "a"}), "a").select("a", "b", "n_shingles")
    hubs = spokes.groupBy("b").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("m")).withColumn("chunks", chunks)
    # hubs are repeated so that the spokes of one are dealt to several tasks
    salt = F.pmod(F.xxhash64("a", F.lit(3)), F.lit(SALT)).cast("int")
    salted = hubs.select("b", "chunks", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    split = spokes.withColumn("salt", salt).join(salted, ["b", "salt"]).select(F.col("b").alias("unit"), (F.pmod(F.xxhash64("a"), F.col("chunks")) + 1).cast("int").alias("part"), F.col("a").alias("doc_id"))
    centres = hubs.select(F.col("b").alias("unit"), F.explode(F.sequence(F.lit(1), F.col("chunks"))).alias("part"), F.col("b").alias("doc_id"))
    return whole.unionByName(split).unionByName(centres), placed


def _blocks(placed: DataFrame, links: DataFrame, sizes: DataFrame) -> DataFrame:
    """(unit, i, j, doc_id, chunk, known): where the texts of large components that ``links`` leave apart meet, each pair of chunks i <= j.

    Texts of the same ``known`` are connected.
    """
    known = F.coalesce("root", "doc_id").alias("known")
    large = placed.filter("chunks > 1").select(F.col("root").alias("unit"), F.col("node").alias("doc_id")).join(sizes, "doc_id")
    d = large.join(components(links).withColumnsRenamed({"node": "doc_id"}), "doc_id", "left").select("unit", "doc_id", "n_shingles", known)
    return _met(d, UNIT)


def _met(d: DataFrame, texts: int) -> DataFrame:
    """(unit, i, j, doc_id, chunk, known): each pair of chunks i <= j, of some ``texts`` each, in which texts of ``d`` (unit, doc_id, n_shingles, known) that aren't of the same ``known`` meet.

    The largest ``known`` of a unit has chunks of its own, which meet only the other texts' chunks.
    """
    groups = d.groupBy("unit", "known").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("m"))
    number = lambda n, m: F.greatest(F.ceil(n / texts), F.ceil(m / UNIT_SHINGLES)).cast("int")
    totals = groups.groupBy("unit").agg(F.max(F.struct("n", "m", "known")).alias("top"), F.sum("n").alias("n"), F.sum("m").alias("m")).filter("n > top.n")
    totals = totals.select("unit", F.col("top.known").alias("top"), number(F.col("n") - F.col("top.n"), F.col("m") - F.col("top.m")).alias("apart"), number(F.col("top.n"), F.col("top.m")).alias("linked"))
    h = F.xxhash64("doc_id", F.lit(7))
    own = F.when(F.col("known") == F.col("top"), F.col("apart") + F.pmod(h, F.col("linked"))).otherwise(F.pmod(h, F.col("apart"))).cast("int")
    last = F.when(F.col("known") == F.col("top"), F.col("apart")).otherwise(F.col("apart") + F.col("linked")) - 1
    d = d.join(totals, "unit").withColumn("chunk", own).withColumn("with", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    return d.select("unit", F.least("chunk", "with").alias("i"), F.greatest("chunk", "with").alias("j"), "doc_id", "chunk", "known")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of shingle sets, as a matrix.

    Only shingles of several sets matter; some ``_COLUMNS`` of these at a time are laid
    out as a 0-1 matrix, whose product with itself counts what is shared.
    """
    n = len(sets)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    every = np.concatenate(sets)
    order = np.argsort(every)
    every, of = every[order], of[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    several = ~new | ~np.append(new[1:], True)
    of, column = of[several], np.cumsum(new[several]) - 1
    both = np.zeros((n, n), np.float32)
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + _COLUMNS, _COLUMNS))
    for k, (lo, hi) in enumerate(itertools.pairwise(edges)):
        m = np.zeros((n, _COLUMNS), np.float32)
        m[of[lo:hi], column[lo:hi] - k * _COLUMNS] = 1
        both += m @ m.T
    return both.astype(np.int64)


def confirmed(ids: list[int], texts: list[str], n: int, percent: int, table: Words, known: list[int] | None = None, chunk: list[int] | None = None) -> list[tuple[int, int]]:
    """Links of a unit that span what is linked: pairs with 100 * intersection >= percent * union.

    Texts of the same ``known`` are connected already.  With texts of several ``chunk``,
    pairs inside a chunk are left out.
    """
    sets = [shingles(t, n, table) for t in texts]
    keep = [i for i, s in enumerate(sets) if len(s)]
    if len(keep) < 2:
        return []
    size = np.array([len(sets[i]) for i in keep])
    both = overlaps([sets[i] for i in keep])
    linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    groups = None
    if known is not None:
        groups, part = np.array([known[i] for i in keep]), np.array([chunk[i] for i in keep])
        linked &= groups[:, None] != groups[None, :]
        if len(set(chunk)) > 1:
            linked &= part[:, None] != part[None, :]
    out, new = [], np.ones(len(keep), bool)
    for first in range(len(keep)):
        if not new[first]:
            continue
        new[first], ahead = False, [first]
        while ahead:
            i = ahead.pop()
            here = np.flatnonzero(linked[i] & new)
            new[here] = False
            out += [(ids[keep[i]], ids[keep[j]]) for j in here]
            ahead += here.tolist()
            if groups is not None:
                mates = np.flatnonzero(new & (groups == groups[i]))
                new[mates] = False
                ahead += mates.tolist()
    return out


def link(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of ``docs`` (doc_id, text, ...; ids are integers).

    Words are lower-cased in A-Z.  Null and empty texts have no shingles and link with
    nothing; so do rows with a null id, which are kept and have no component.  Repeated
    rows each get a row.  Rows that share an id but not their text are linked each by its
    own text; a row is kept if its id is its component's.  Texts of any length are compared
    whole; there are no ties, as links are exact and the least id stands for a
    component.  An empty table gives an empty one; other columns of ``docs`` are ignored,
    whatever their names.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    d = stored(features(docs, n), "features")
    unclear = d.filter("doc_id is not null").groupBy("doc_id").agg(F.count_distinct(F.coalesce("set_id", F.lit(b""))).alias("sets")).filter("sets > 1")
    if not unclear.limit(1).count():
        return _link(docs, d, n, percent)
    # numbers of rows stand in for ids; a component's id is the least of its rows
    rows = stored(docs.filter("doc_id is not null").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")
    by_row = rows.select(F.col("row").alias("doc_id"), "text")
    linked = _link(by_row, stored(features(by_row, n), "features"), n, percent).select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("root"))
    linked = stored(linked.join(rows.select("row", "doc_id"), "row"), "linked")
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = linked.join(least, "root").select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return linked.unionByName(d.filter("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def _link(docs: DataFrame, d: DataFrame, n: int, percent: int) -> DataFrame:
    """``link`` of rows whose ids, where they repeat, have one text; ``d``: their features, stored."""
    reps = d.filter("doc_id is not null and set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles"))
    reps = stored(reps, "classes")
    edges = candidate_edges(reps.select("doc_id", "registers", "n_shingles"), percent / 100 - SLACK, percent)
    sizes = reps.select("doc_id", "n_shingles")
    units, placed = _units(edges, sizes)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Words()
        rows = (r for b in batches for r in b.itertuples(index=False))
        for _, group in itertools.groupby(rows, key=lambda r: (r.unit, r.part)):
            group = {r.doc_id: r.text for r in group}
            yield pd.DataFrame(confirmed([*group], [*group.values()], n, percent, table), columns=["a", "b"])
        del table
        give_back()

    def verify_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Words()
        rows = (r for b in batches for r in b.itertuples(index=False))
        for (_, i, j), group in itertools.groupby(rows, key=lambda r: (r.unit, r.i, r.j)):
            group = {r.doc_id: (r.text, r.known, r.chunk) for r in group}
            if len({c for _, _, c in group.values()}) == 1 + (i < j):
                text, known, chunk = map(list, zip(*group.values(), strict=True))
                yield pd.DataFrame(confirmed([*group], text, n, percent, table, known, chunk), columns=["a", "b"])

    texts = docs.filter("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    full = units.join(texts, "doc_id").repartition("unit", "part").sortWithinPartitions("unit", "part", "doc_id")
    links = stored(full.mapInPandas(verify, "a long, b long"), "links", compact=True)
    if placed.filter("chunks > 1").limit(1).count():
        blocks = stored(_blocks(placed, links, sizes), "blocks", compact=True)
        if blocks.limit(1).count():
            full = blocks.join(texts, "doc_id").repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j", "doc_id")
            links = links.unionByName(stored(full.mapInPandas(verify_apart, "a long, b long"), "links", compact=True))
    roots = components(links)
    found = reps.select("set_id", F.col("doc_id").alias("rep")).join(roots, F.col("rep") == F.col("node"), "left")
    found = found.select("set_id", F.coalesce("root", "rep").alias("root"))
    d = d.drop("registers").join(found, "set_id", "left")
    d = d.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")))
    return d.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents linked on 4-word shingles at 0.8."""
    return link(read(spark, sf_dir, "documents"), n=4)


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs p JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * p.n >= 80 * (a.n + b.n - p.n)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (SELECT x, y FROM edges UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x),
roots AS (SELECT doc_id, min(other) AS root FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.root, d.doc_id)) AS component_id, d.doc_id <= coalesce(r.root, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN roots r USING (doc_id)
"""
