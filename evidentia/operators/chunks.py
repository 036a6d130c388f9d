"""Papers cut into page chunks with ids that derive from content.

A paper is one row with its chunks as an array, so classification and selection need no
shuffle; ``chunk_rows`` gives a row for each chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.text import let, safe_id, section_hint, strip, token_estimate


def line_pages(text: Column, lines: int = 8) -> Column:
    """A text as an array of pages of so many lines."""
    pages = lambda x: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(x) - 1) / lines).cast("int")), lambda i: F.array_join(F.slice(x, i * lines + 1, lines), "\n")
    )
    return let(F.split(text, "\n"), pages)


def feed_pages(text: Column) -> Column:
    """A text as an array of pages that form feeds end."""
    return F.split(text, "\f")


def papers(sources: DataFrame, paper_id: str, content: str, pages: Column, keep: tuple[str, ...] = (), sha: Column | None = None) -> DataFrame:
    """(paper_id, source_sha256, chunks, and columns to ``keep``): one row a paper, a chunk for each page with text.

    ``sha`` is the digest of the source's bytes where ``content`` isn't the source itself.

    Ordinals count pages with text without gaps; page numbers count all.  Papers without
    any text have no chunks (``violations`` reports them).  Null content counts as empty.
    """
    found = F.filter(F.transform(pages, lambda p, i: F.struct((i + 1).alias("page"), strip(p).alias("text"))), lambda p: p["text"] != "")
    d = sources.select(F.col(paper_id).alias("paper_id"), (F.sha2(F.coalesce(F.col(content), F.lit("")), 256) if sha is None else sha).alias("source_sha256"), F.coalesce(found, F.array()).alias("pages"), *keep)

    def chunk(p: Column, i: Column) -> Column:
        sha = F.sha2(p["text"], 256)
        key = F.concat_ws(":", F.col("source_sha256"), p["page"].cast("string"), sha)
        return F.struct(
            F.substring(F.sha2(key, 256), 1, 20).alias("chunk_id"), (i + 1).alias("ordinal"), section_hint(p["text"]).alias("section_hint"), p["page"].alias("page_start"), p["page"].alias("page_end"),
            F.length(p["text"]).alias("char_count"), token_estimate(p["text"]).alias("token_estimate"), sha.alias("content_sha256"), p["text"].alias("text"),
        )

    return d.select("paper_id", "source_sha256", F.transform("pages", chunk).alias("chunks"), *keep)


def unnest(papers_: DataFrame, structs: Column, key: str) -> DataFrame:
    """paper_id and the fields of an array of structs, a row for each whose ``key`` isn't null.

    An outer generator: for an inner one the optimizer infers a filter on the array and,
    pushing it down, writes the array's expression out once for every use of its parts.
    """
    return papers_.select("paper_id", F.inline_outer(structs)).filter(F.col(key).isNotNull())


def chunk_rows(papers_: DataFrame) -> DataFrame:
    return unnest(papers_, F.col("chunks"), "chunk_id")


def paper_ids(paths: DataFrame, path: str = "path") -> DataFrame:
    """``paths`` with paper_id: the safe stem, and a hash of the path only where stems meet."""
    stem = F.regexp_replace(F.element_at(F.split(F.col(path), "/"), -1), r"(?<=.)\.[^.]*$", "")
    d = paths.withColumn("base", safe_id(stem))
    shared = F.count("*").over(Window.partitionBy("base")) > 1
    return d.withColumn("paper_id", F.when(shared, F.concat("base", F.lit("-"), F.substring(F.sha2(F.col(path), 256), 1, 8))).otherwise(F.col("base"))).drop("base")


def changed(sources: DataFrame, known: DataFrame) -> DataFrame:
    """``sources`` (paper_id, source_sha256, ...) whose content isn't in ``known`` (paper_id, source_sha256)."""
    return sources.join(known, ["paper_id", "source_sha256"], "left_anti")


def violations(papers_: DataFrame) -> DataFrame:
    """(rule, paper_id, detail) of what a chunked paper must hold; empty if all is well."""
    c = F.col("chunks")
    ids, ordinals = F.transform(c, lambda x: x["chunk_id"]), F.transform(c, lambda x: x["ordinal"])
    rules = {
        "no_text": F.size(c) == 0,
        "chunk_id_repeats": F.size(F.array_distinct(ids)) < F.size(c),
        "ordinal_repeats": F.size(F.array_distinct(ordinals)) < F.size(c),
        "char_count": F.exists(c, lambda x: x["char_count"] != F.length(x["text"])),
        "blank_text": F.exists(c, lambda x: x["text"] == ""),
        "page_range": F.exists(c, lambda x: (x["page_start"] < 1) | (x["page_end"] < x["page_start"])),
    }
    broken = F.filter(F.array(*(F.when(test, F.lit(name)) for name, test in rules.items())), lambda x: x.isNotNull())
    return papers_.select("paper_id", F.size(c).alias("chunk_count"), F.explode_outer(broken).alias("rule")).filter("rule is not null")
