"""Where papers come from: folders of PDF files, chunk artifacts, indexes."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators.chunks import paper_ids, papers
from evidentia.schemas import ARTIFACT
from evidentia.sources.pdf import page_texts

#: Keys of an index entry that may hold its path or id; the first that is there counts (fixed values).
PATH_KEYS = ("source_path", "chunk_path", "chunk_artifact", "artifact_path", "path", "file")
ID_KEYS = ("paper_id", "id")
#: The hidden folder of a run's own files, and the index a folder of papers may hold; both are parameters of the functions below.
STATE_FOLDER = ".evidentia"
INDEX_NAME = "evidentia_index.json"


def _files(spark: SparkSession, path: str) -> list[str]:
    """Files under a path of any file system that Spark reads."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out, walk = [], fs.listFiles(root, True)
    while walk.hasNext():
        out.append(walk.next().getPath().toString())
    return sorted(out)


def _entry(raw: object) -> tuple[dict, str | None]:
    """An index entry as paper_id, source_path, metadata; and what is wrong with it, if anything is."""
    e = {"path": raw} if isinstance(raw, str) else raw if isinstance(raw, dict) else None
    if e is None:
        return {}, "is neither a path nor an object"
    path, name, more = ([e[k] for k in keys if k in e][:1] for keys in (PATH_KEYS, ID_KEYS, ("metadata",)))
    path, name, more = path[0] if path else None, name[0] if name else None, more[0] if more else {}
    if name in (None, ""):
        name = re.sub(r"(?<=.)\.[^.]*$", "", path.rstrip("/").rpartition("/")[2]) if isinstance(path, str) else ""
    problems = {
        "has no path": not isinstance(path, str) or not path.strip(),
        "has metadata that is no object": not isinstance(more, dict),
        "has an empty id": not str(name).strip(),
    }
    wrong = [text for text, found in problems.items() if found]
    return ({}, wrong[0]) if wrong else ({"paper_id": str(name).strip(), "source_path": path, "metadata": {str(k): str(v) for k, v in more.items() if v is not None}}, None)


def index_entries(payload: object) -> list[dict]:
    """Entries (paper_id, source_path, metadata) of an index: a list, or an object with a list named papers or items.  Anything else is a ValueError."""
    named = [payload[k] for k in ("papers", "items") if k in payload] if isinstance(payload, dict) else [payload]
    if len(named) != 1 or not isinstance(named[0], list) or not named[0]:
        raise ValueError("an index is a JSON list with entries, or an object with exactly one: papers or items")
    read = [_entry(raw) for raw in named[0]]
    wrong = [f"entry {n} {problem}" for n, (_, problem) in enumerate(read, 1) if problem]
    counts = Counter(e["paper_id"] for e, problem in read if not problem)
    wrong += [f"id {k} repeats" for k, n in sorted(counts.items()) if n > 1]
    if wrong:
        raise ValueError(f"index: {'; '.join(wrong[:10])}")
    return sorted((e for e, _ in read), key=lambda e: (e["paper_id"].casefold(), e["source_path"]))


def discover(spark: SparkSession, folder: str, index: str | None = None, index_name: str = INDEX_NAME, state: str = STATE_FOLDER) -> DataFrame:
    """(paper_id, source_path, metadata): from the index given, else the folder's own, else its chunk artifacts."""
    files = _files(spark, folder)
    own = f"/{index_name}"
    index = index or next((f for f in files if f.endswith(own) and f[: -len(own)].endswith(folder.rstrip("/").rpartition("/")[2])), None)
    if index:
        entries = index_entries(json.loads("\n".join(r[0] for r in spark.read.text(index, wholetext=True).collect())))
        for e in entries:
            if "://" not in e["source_path"] and not e["source_path"].startswith("/"):
                e["source_path"] = f"{folder.rstrip('/')}/{e['source_path']}"
        return spark.createDataFrame([(e["paper_id"], e["source_path"], e["metadata"]) for e in entries], "paper_id string, source_path string, metadata map<string,string>")
    found = [f for f in files if f.endswith(".json") and f"/{state}/chunks/" in f] or [f for f in files if f.endswith(".json") and "/chunks/" in f]
    if not found:
        raise ValueError(f"no papers in {folder}")
    return artifacts(spark, found).select("paper_id", F.input_file_name().alias("source_path"), F.create_map().cast("map<string,string>").alias("metadata"))


def artifacts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Chunk artifacts by their fixed schema; a file that isn't one fails the read."""
    return spark.read.schema(ARTIFACT).option("multiLine", True).option("mode", "FAILFAST").json(paths)


def artifact_papers(artifacts_: DataFrame) -> DataFrame:
    """Artifacts as papers with chunks."""
    return artifacts_.select("paper_id", "source_file", "source_sha256", F.transform("chunks", lambda c: c.withField("chunk_id", c["id"]).dropFields("id")).alias("chunks"))


def pdf_text(content: bytes) -> list[str]:
    """Text of the pages of a PDF, empty for a page without text (see ``pdf``).

    A file without page tree is read stream by stream: literal strings in file order.  Images of
    text and encrypted files need a parser of their own, given to ``pdf_papers``.
    """
    if (read := page_texts(content)) is not None:
        return read
    pages = []
    for m in re.finditer(rb"stream\r?\n(.*?)\r?\nendstream", content, re.S):
        data = m[1]
        if b"FlateDecode" in content[max(0, m.start() - 300) : m.start()].rpartition(b"obj")[2]:
            try:
                data = zlib.decompress(data)
            except zlib.error:
                continue
        if b"BT" not in data and b"Tf" not in data:
            continue
        shown = re.findall(rb"\(((?:\\.|[^\\()])*)\)\s*(?:Tj|'|\")|(T\*|Td|TD|ET)|\[((?:\\.|[^\]])*)\]\s*TJ", data, re.S)
        parts = []
        for plain, line, several in shown:
            if line:
                parts.append("\n")
            text = plain or b"".join(re.findall(rb"\(((?:\\.|[^\\()])*)\)", several))
            parts.append(re.sub(rb"\\([()\\])", rb"\1", text).decode("latin-1"))
        pages.append(re.sub(r"\n+", "\n", "".join(parts)).strip())
    return pages


def _binary(spark: SparkSession, folder: str, state: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return files.filter(~F.contains("path", F.lit(f"/{state}/")))


def _root(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/") + "/"


def _named(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """paper_id and source_file, the path under ``folder``: ids don't change when the folder moves."""
    root = _root(spark, folder)
    return paper_ids(files.withColumn("source_file", F.when(F.startswith("path", F.lit(root)), F.substring("path", len(root) + 1, 2**30)).otherwise(F.col("path"))), "source_file")


def pdf_files(spark: SparkSession, folder: str, state: str = STATE_FOLDER) -> DataFrame:
    """(paper_id, path, source_file, source_sha256) of the PDF files under a folder, hidden state folders left out."""
    files = _binary(spark, folder, state).select("path", F.sha2("content", 256).alias("source_sha256"))
    return _named(spark, files, folder).select("paper_id", "path", "source_file", "source_sha256")


def parsed(spark: SparkSession, folder: str, parse: Callable[[bytes], list[str]] = pdf_text, state: str = STATE_FOLDER, only: DataFrame | None = None) -> DataFrame:
    """(paper_id, path, source_file, source_sha256, chunks) of PDF files; text and digest come from one read of the bytes.

    Ids come from paths alone, so contents aren't shuffled; ``only`` (path) picks files.
    """
    content = _binary(spark, folder, state).select("path", "content")
    if only is not None:
        content = content.join(only.select("path"), "path", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "sha": [hashlib.sha256(c).hexdigest() for c in b["content"]], "pages": [parse(c) for c in b["content"]]})

    ids = _named(spark, _binary(spark, folder, state).select("path"), folder)
    read = content.mapInPandas(run, "path string, sha string, pages array<string>").join(ids, "path").withColumn("__text", F.lit(""))
    keep = read.select("paper_id", "path", "source_file", F.col("sha").alias("source_sha256"), "pages", "__text")
    d = papers(keep, "paper_id", "__text", F.col("pages"), keep=("path", "source_file"), sha=F.col("source_sha256"))
    return d


def pdf_papers(spark: SparkSession, folder: str, parse: Callable[[bytes], list[str]] = pdf_text, state: str = STATE_FOLDER) -> DataFrame:
    """Papers of the PDF files under a folder, hidden state folders left out."""
    return parsed(spark, folder, parse, state)
