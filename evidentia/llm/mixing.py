"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source's documents, in a hashed order, form one stream of words that is cut
into blocks of equal length.  Golden-ratio points run through the sources' cumulative
shares and give each slot of the schedule a source; the r-th slot of a source takes its
r-th block, and starts the stream over when it ends.  A source stops when its quota is
met, and what the points still owe it follows at the end, so that totals are exact.

Prefix sums are made in two levels (shard, then row), so no window holds a whole source.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import read, small, stored, word_count

#: Sources up to this many are broadcast with their targets; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000
GOLDEN = 0.6180339887498949
_CELLS = 4096
_CHUNK = 16_384


class Mix(NamedTuple):
    documents: DataFrame  # a row for each document: what the mix takes of it
    schedule: DataFrame  # a row for each slot: source, epoch, block, words
    targets: DataFrame  # a row for each source


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, cover: bool = False) -> DataFrame:
    """Targets of the sources of ``sizes`` (source, size), by water filling.

    Weights repeat over the sources in code point order, null last.  Sources share all
    sizes by weight; none gets more than ``cap`` times its own size, and what it can't
    take goes to the others by weight.  With ``cover`` the shared total grows until no
    source gets less than its own size.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod(F.col("src"), len(weights)).cast("int") + 1)
    s = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
        .withColumn("src", (F.row_number().over(by_name) - 1).cast("long"))
        .withColumn("weight", weight)
        .withColumn("most", (cap * F.col("source_size")).cast("double"))
    )
    everything = Window.partitionBy(F.lit(0))
    if cover:
        need = F.max(F.col("source_size") / F.col("weight")).over(everything)
        return s.withColumn("target", F.least("most", need * F.col("weight")))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    sofar = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    total = lambda c: F.sum(c).over(everything)
    s = s.withColumn("level", (total("source_size") - sofar("most")) / (total("weight") - sofar("weight")))
    s = s.withColumn("full", F.col("most") <= F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return s.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(level * F.col("weight"))).drop("level", "full")


def _slots(targets: DataFrame, block: Column) -> DataFrame:
    """The schedule: slot, src, epoch, block, words."""
    spark = targets.sparkSession
    everything = Window.partitionBy(F.lit(0))
    t = targets.filter("source_size > 0 and take > 0").select("src", "source_size", "take", block.alias("b"))
    t = t.withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("b"))).withColumn("rest", F.col("take") % F.col("source_size"))
    t = t.withColumn("quota", F.floor(F.col("take") / F.col("source_size")) * F.col("n_blocks") + F.ceil(F.col("rest") / F.col("b")))
    above = F.sum("quota").over(Window.partitionBy(F.lit(0)).orderBy("src"))
    t = t.withColumn("all", F.sum("quota").over(everything)).withColumn("hi", above / F.col("all")).withColumn("lo", (above - F.col("quota")) / F.col("all"))
    t = stored(t, "quotas", compact=True)
    n = t.agg(F.max("all")).first()[0] or 0

    cells = t.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * _CELLS), F.least(F.floor(F.col("hi") * _CELLS), F.lit(_CELLS - 1)))))
    points = spark.range(n).withColumnRenamed("id", "slot").withColumn("u", F.col("slot") * GOLDEN + GOLDEN).withColumn("u", F.col("u") - F.floor("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * _CELLS)).join(small(cells, BROADCAST_SOURCES + _CELLS), "cell").filter("u >= lo and u < hi")
    points = points.select("slot", F.floor(F.col("slot") / _CHUNK).alias("chunk"), "src")

    counts = points.groupBy("src", "chunk").agg(F.count("*").alias("here"))
    running = Window.partitionBy("src").orderBy("chunk")
    counts = stored(counts.withColumn("first", F.sum("here").over(running) - F.col("here")), "chunks", compact=True)
    rank = F.col("first") + F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    ranked = points.join(counts, ["src", "chunk"]).withColumn("rank", rank).select("slot", "src", "rank")

    owed = t.join(counts.groupBy("src").agg(F.sum("here").alias("got")), "src", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    owed = owed.filter("got < quota").withColumn("rank", F.explode(F.sequence("got", F.col("quota") - 1)))
    owed = owed.select((F.lit(n) + F.col("rank")).alias("slot"), "src", "rank")

    s = ranked.unionByName(owed).join(small(t, BROADCAST_SOURCES), "src").filter("rank < quota")
    s = s.withColumn("epoch", F.floor(F.col("rank") / F.col("n_blocks"))).withColumn("block", F.col("rank") % F.col("n_blocks"))
    begin = F.col("block") * F.col("b")
    s = s.withColumn("words", F.least("b", F.col("source_size") - begin, F.col("take") - F.col("epoch") * F.col("source_size") - begin))
    return s.withColumn("whole", F.col("words") == F.least("b", F.col("source_size") - begin)).select("slot", "src", "epoch", "block", "words", "whole")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, cover: bool = False, seed: int = 1, slots: int = 200_000, least_block: int = 32, rows_a_shard: int = 500) -> Mix:
    """Mixes ``docs`` (doc_id, source, text); other columns are ignored.

    A block has total words / ``slots`` words, ``least_block`` at least.  The order of
    the documents hangs on ``seed`` and their ids alone: reruns agree.  Null and empty
    texts have size 0 and take 0.  A null source is a source of its own, last in order.
    Repeated rows each count.  An empty table gives empty results.
    """
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    targets = source_targets(sizes, weights, cap, cover).withColumn("take", F.floor(F.col("target") + 0.5))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    block = F.greatest(F.lit(least_block).cast("long"), F.ceil(total / slots))
    targets = stored(targets.withColumn("b", block), "targets", compact=True)
    schedule = _slots(targets, F.col("b"))

    key = F.xxhash64(F.lit(seed), "doc_id").bitwiseAND(F.lit(2**63 - 1))
    d = sizes.join(small(targets, BROADCAST_SOURCES), sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    d = d.withColumn("key", key).withColumn("shard", F.floor(F.col("key") / float(2**63) * F.ceil(F.col("n_docs") / rows_a_shard)))
    start = F.sum("sum").over(Window.partitionBy("src").orderBy("shard")) - F.col("sum")
    shards = d.groupBy("src", "shard").agg(F.sum("size").alias("sum")).select("src", "shard", start.alias("start"))
    before = Window.partitionBy("src", "shard").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("a", F.coalesce(F.sum("size").over(before), F.lit(0))).join(shards, ["src", "shard"])
    d = d.withColumn("a", F.col("a") + F.col("start")).withColumn("z", F.col("a") + F.col("size"))

    last = F.greatest(F.floor(F.col("a") / F.col("b")), F.floor((F.col("z") - 1) / F.col("b")))
    pieces = d.withColumn("block", F.explode(F.sequence(F.floor(F.col("a") / F.col("b")), last)))
    begin = F.col("block") * F.col("b")
    pieces = pieces.withColumn("lo", F.greatest("a", begin)).withColumn("hi", F.greatest(F.least("z", begin + F.col("b")), F.greatest("a", begin)))
    takes = schedule.groupBy("src", "block").agg(F.count_if("whole").alias("whole"), F.coalesce(F.max(F.when(~F.col("whole"), F.col("words"))), F.lit(0)).alias("part"))
    cut = F.greatest(F.lit(0), F.least("hi", begin + F.col("part")) - F.col("lo"))
    taken = F.coalesce(F.col("whole") * (F.col("hi") - F.col("lo")) + cut, F.lit(0))
    kept = ["doc_id", "source", "size", "source_size", "target", "src", "a", "key"]
    full = pieces.filter("size > 0").join(takes, ["src", "block"], "left").withColumn("taken", taken).groupBy(*kept).agg(F.sum("taken").alias("taken"))
    empty = d.filter("size = 0").select(*kept, F.lit(0).cast("long").alias("taken"))
    names = targets.select("src", "source")
    return Mix(full.unionByName(empty).drop("src", "a", "key"), schedule.join(small(names, BROADCAST_SOURCES), "src").drop("src", "whole"), targets)


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as the mix has them: each row as often as the mix takes its words, to the nearest whole copy.

    Rows without words stay once.  Needs unique ids; rows that share one get its largest share.
    """
    copies = F.when(F.col("size") == 0, 1).otherwise(F.round(F.col("taken") / F.col("size"))).cast("int")
    share = mix(docs, **how).documents.groupBy("doc_id").agg(F.max(copies).alias("__copies"))
    out = docs.join(share, docs["doc_id"].eqNullSafe(share["doc_id"])).drop(share["doc_id"])
    return out.withColumn("__copies", F.explode(F.array_repeat(F.lit(0), F.col("__copies")))).drop("__copies")


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 5, 2, 1 and at most three passes over a source."""
    d = mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).documents
    return d.select("doc_id", "source", "size", "source_size", "target", "taken")
