"""Token counts: pieces counted once for each distinct pre-token, summed by frequency, no ids kept.

In the vocabulary used here no piece has a space mark after another character, and none
has a line feed, so merges never cross those places.  A text therefore falls into
pre-tokens (spaces with the word after them, spaces before a line feed, line feeds) whose
piece counts add up to the text's.  ``independent`` checks this of a vocabulary; for one
that fails, whole texts go to the library.

1. Met.  Tasks hand on the distinct pre-tokens that they meet; those that several tasks met
   are shared.
2. Counts.  Each shared pre-token is counted once and for all.  ``SHARED`` of them at most, those
   that most tasks met, make a table whose size is known, and are broadcast.
3. Join.  A task joins its documents' frequencies to that table and sums; a pre-token that
   isn't in it, being met here alone or rare, is counted where it is met.

Documents and their frequencies aren't shuffled: a row for each pre-token of each document
is several times the input, and so is what a shuffled join of shards by number needs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import read, stored

#: Pre-tokens that a task remembers beside the shared ones.
TABLE = 200_000
#: Pre-tokens that are broadcast with their counts.
SHARED = 300_000
#: Longer pre-tokens are counted without entering the table.
LONG = 64

_PRETOKEN = re.compile(r" *[^ \n]+| +|\n")
_MARK = "▁"


def independent(model) -> bool:
    """Whether pre-tokens can be counted apart: checked on all pieces and on the normaliser's work."""
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    apart = not any(_MARK in p.lstrip(_MARK) or "\n" in p for p in pieces)
    probe = "a  b\n c ﬁ\t \n\n  d "
    return apart and model.decode(model.encode(probe)) == probe and len(model.encode("a")) == len(model.encode(" a")) - 1 + (model.encode(" a", out_type=str)[0] != _MARK)


class Counts:
    """Piece counts of texts as ``model.encode`` gives them."""

    def __init__(self, model, shared: dict[str, int] | None = None) -> None:
        self.model, self.shared, self.apart = model, shared or {}, independent(model)
        self.table = dict(self.shared)
        self.line = len(model.encode("\n"))  # pieces of a mark and a line feed

    def _new(self, tokens: list[str]) -> list[int]:
        # the library puts a mark before what it encodes: it stands for the space that is
        # left out here, and after a line feed it and the line feed's piece are taken off
        spaced = [t[1:] if t[0] == " " else f"\n{t}" for t in tokens]
        less = [0 if t[0] == " " else self.line for t in tokens]
        return [len(ids) - n if s else 1 for ids, n, s in zip(self.model.encode(spaced, num_threads=1), less, spaced, strict=True)]

    def each(self, tokens: list[str]) -> list[int]:
        """Pieces of distinct pre-tokens."""
        return self._new(tokens) if tokens else []

    def of(self, texts: list[str]) -> list[int]:
        """Pieces of texts one after the other, by a table of this object."""
        if not self.apart:
            return [len(x) for x in self.model.encode(texts, num_threads=1)] if texts else []
        for f in map(pretokens, texts):
            new = [t for t in f if t not in self.table]
            if new and len(self.table) + len(new) > len(self.shared) + TABLE:
                self.table = dict(self.shared)
                new = [t for t in f if t not in self.table]
            if new:
                self.table.update(zip(new, self._new(new), strict=True))
            yield sum(map(lambda t, n: self.table[t] * n, f.keys(), f.values()))
            for t in new:
                if len(t) > LONG:
                    del self.table[t]


def pretokens(text: str) -> Counter:
    """Frequencies of a text's pre-tokens."""
    return Counter(_split(text))


def _split(text: str) -> list[str]:
    return _PRETOKEN.findall(f" {text.replace(_MARK, ' ')}") if text else []


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of ``docs`` (doc_id, text, ...).

    ``n_tokens`` is what the library's ``encode`` gives without begin and end tokens.
    Null and empty texts have 0 bytes and 0 tokens.  Rows are independent: repeated
    rows each count, ids may be null or shared, an empty table gives an empty one; texts of
    any length are read whole, and other columns are ignored, whatever their names.
    ``model_file`` must be at the same place on all executors.
    """

    def load():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=model_file)

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: set[str] = set()
        for b in batches:
            for text in b["text"]:
                found.update(t for t in set(_split(text)) if len(t) <= LONG)
                if len(found) > TABLE:
                    yield pd.DataFrame({"token": list(found)})
                    found.clear()
        yield pd.DataFrame({"token": list(found)}, dtype=object)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counts(load())
        for b in batches:
            yield b.assign(pieces=counts.each(b["token"].tolist()))

    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    # ids go through Python as text, so that nulls among them make no floats
    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = None
    if independent(load()):
        shared = d.select("text").mapInPandas(met, "token string").groupBy("token").agg(F.count("*").alias("tasks")).filter("tasks > 1")
        shared = stored(shared, "shared")
        least, left = 2, SHARED
        for tasks, n in shared.groupBy("tasks").count().orderBy(F.desc("tasks")).collect():  # a row for each number of tasks
            if n > left:
                least = tasks + 1
                break
            left -= n
        found = shared.filter(F.col("tasks") >= least).select("token").mapInPandas(pieces, "token string, pieces int").toArrow()
        table = spark.sparkContext.broadcast(("".join(t := found["token"].to_pylist()), np.array([len(x) for x in t], np.uint8), np.array(found["pieces"].to_pylist(), np.uint16)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counts(load(), _table(*table.value) if table is not None else None)
        for b in batches:
            texts = b["text"].tolist()
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": [len(t.encode()) for t in texts], "n_tokens": list(counts.of(texts))})

    counted = d.mapInPandas(count, "doc_id string, n_bytes long, n_tokens long")
    return counted.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _table(text: str, sizes: np.ndarray, pieces: np.ndarray) -> dict[str, int]:
    """The broadcast table: tokens lie end to end in one text."""
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return {text[a:z]: n for a, z, n in zip([0, *ends], ends, pieces.tolist(), strict=False)}


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document by the public 32k piece vocabulary."""
    import public_tokenizers

    return count_tokens(read(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))
