"""Document fingerprints from closed syncmers.

A text is a sequence of words; of a run of over ``PIECE`` characters, as in writing without
spaces, every character counts as a word, so nothing hangs on where the run begins.  Of
its ``k``-word windows those are chosen whose least hashed ``s``-word part is the first or
the last of the window.  The choice depends on the window alone, not on its neighbours, so
an unchanged passage keeps its anchors wherever it moves.  The fingerprint is the anchors'
32-bit hashes in order of first place; the likeness of two is the Jaccard index of their
anchors.  A text without a chosen window, as all below ``k`` words are, has one anchor
made of all its words.

All of it is built-in functions.  Hashes are bound to lambda variables (``let``), so that a
text is split once however often its words are named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import let, read, stored

K, S = 10, 2
PIECE = 32
_WORDS = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,%d}(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]" % PIECE
_LOW = 0xFFFFFFFF
_BASE = 2**31


def _int(h: Column) -> Column:
    return (h.bitwiseAND(F.lit(_LOW)) - F.lit(_BASE)).cast("int")


def syncmers(text: Column, k: int = K, s: int = S) -> Column:
    """Anchors of a text in order: array of (at, hash), ``at`` counted in words from 0."""
    w = k - s + 1

    def of(h: Column) -> Column:
        n = F.size(h)
        parts = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, s))))

        def chosen(p: Column) -> Column:
            least = lambda i: F.array_min(F.slice(p, i + 1, w))
            closed = F.filter(F.sequence(F.lit(0), n - k), lambda i: let(least(i), lambda m: (m == F.get(p, i)) | (m == F.get(p, i + w - 1))))
            return F.transform(closed, lambda i: F.struct(i.alias("at"), _int(F.xxhash64(*(F.get(h, i + j) for j in range(k)))).alias("hash")))

        whole = F.array(F.struct(F.lit(0).alias("at"), _int(F.xxhash64(h)).alias("hash")))
        some = F.when(n >= k, let(parts, chosen))
        return F.when(n == 0, F.slice(whole, 1, 0)).otherwise(let(some, lambda c: F.when(F.size(c) > 0, c).otherwise(whole)))

    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORDS), F.lit(0))
    return let(F.transform(words, lambda x: F.xxhash64(x)), of)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Distinct anchor hashes of a text in order of first place: array<int>."""
    return F.array_distinct(F.transform(syncmers(text, k, s), lambda a: a["hash"]))


def as_string(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x.cast("long") + F.lit(_BASE))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of anchors; 1 for two empty ones."""
    return let(F.size(F.array_intersect(a, b)), lambda n: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(n / (F.size(a) + F.size(b) - n)))


def next_ids(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, half: for each distinct id the next one in descending order (after the last, the first).

    Ids are range-partitioned; order within a range is a window over that range alone, and
    ranges are chained through one row each.  ``half`` is floor(n_chars / 2).
    """
    t = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n")).groupBy("doc_id").agg(F.max("n").alias("n"))
    t = stored(t.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    # each range's largest id is where the range above it goes on; the lowest range goes on at the top
    top = t.groupBy("part").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy("part")
    ends = top.select("part", F.coalesce(F.lag("top").over(order), F.last("top").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("onward"))
    down = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"))
    t = t.withColumn("row", F.row_number().over(down)).withColumn("left", F.count("*").over(Window.partitionBy("part")) - F.col("row"))
    t = t.withColumn("below", F.lead("doc_id").over(down)).join(ends, "part")
    return t.select("doc_id", F.when(F.col("left") > 0, F.col("below")).otherwise(F.col("onward")).alias("next_id"), F.floor(F.col("n") / 2).cast("int").alias("half"))


def fingerprint(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), of their edited texts, and likenesses.

    Null texts count as empty, and an empty text has no anchors.  A null id is the lowest.
    Rows that share an id each get a row; their next document is that of the id, and as a
    next document such an id stands for its row with the least text.  Texts of any length
    are read whole.  Ties of hashes in a window choose it.  An empty table gives an empty
    one; other columns are ignored, whatever their names.
    """
    text = F.coalesce("text", F.lit(""))
    a = docs.select("doc_id", text.alias("text"), anchors(text, k, s).alias("fp"))
    ids = stored(next_ids(docs), "next", compact=True)
    following = a
    if ids.count() != docs.count():
        following = a.groupBy("doc_id").agg(F.min_by(F.struct("text", "fp"), "text").alias("b")).select("doc_id", "b.text", "b.fp")
    m = ids.withColumnsRenamed({"doc_id": "for_id"})
    after = following.join(m, following["doc_id"].eqNullSafe(m["next_id"])).select("for_id", "half", F.left("text", F.col("half")).alias("head"), F.col("fp").alias("next_fp"))
    d = a.join(after, a["doc_id"].eqNullSafe(after["for_id"]))
    n = F.length("text")
    edited = F.concat(F.left("text", n - F.floor(n / 2).cast("int")), F.left("head", F.floor(n / 2).cast("int")))
    d = d.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    d = d.withColumn("edited_fp", anchors(F.col("edited"), k, s))
    return d.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_string(F.col("fp")).alias("fingerprint"), as_string(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return fingerprint(read(spark, sf_dir, "documents"))
