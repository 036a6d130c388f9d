"""PDF folders taken in step by step: what is new or changed is read and cut, the rest is reused from its artifacts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators import chunks as C
from evidentia.operators.validation import require_empty
from evidentia.schemas import ARTIFACT
from evidentia.sources import inputs
from evidentia.sources.shared import stored

CHUNKER, VERSION = "evidentia.pdf-page", "1.0"


def artifact_rows(papers: DataFrame) -> DataFrame:
    """Chunk artifacts and their text artifacts of ``papers`` (paper_id, source_file, source_sha256, chunks)."""
    pages = F.transform("chunks", lambda c: F.struct(c["page_start"].alias("page"), c["text"].alias("text")))
    d = papers.withColumn("text_json", F.to_json(F.struct(F.lit("1.0").alias("schema_version"), "paper_id", "source_file", "source_sha256", pages.alias("pages"))))
    return d.select(
        F.lit("0.1").alias("schema_version"), "paper_id", "source_file", "source_sha256", F.concat(F.lit("texts/of="), "paper_id").alias("text_artifact"), F.sha2("text_json", 256).alias("text_artifact_sha256"),
        F.lit(CHUNKER).alias("chunker"), F.lit(VERSION).alias("chunker_version"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("chunked_at"), F.size("chunks").alias("chunk_count"),
        F.transform("chunks", lambda c: c.withField("id", c["chunk_id"]).dropFields("chunk_id")).alias("chunks"), "text_json",
    )


def ingest(spark: SparkSession, folder: str, parse: Callable[[bytes], list[str]] = inputs.pdf_text, state: str = inputs.STATE_FOLDER) -> DataFrame:
    """Chunk artifacts (columns of ARTIFACT) of all PDF files under ``folder``, those of the hidden state folder left out.

    Only files whose id or bytes no artifact has are parsed; their artifacts replace older ones of the
    same id and no others.  A file that changes between its two reads, one without text, or ids that
    meet end the run with a ValueError before anything is written.
    """
    root = f"{folder.rstrip('/')}/{state}"
    files = stored(inputs.pdf_files(spark, folder, state), "files")
    require_empty(files.groupBy("paper_id").agg(F.count("*").alias("n")).filter("n > 1"), "file names give repeated ids")
    there = existing(spark, root)
    known = there.select("paper_id", "source_sha256").distinct()
    todo = stored(C.changed(files, known), "todo")
    if todo.limit(1).count():
        read = stored(inputs.parsed(spark, folder, parse, state, only=todo), "parsed")
        require_empty(read.join(todo.select("paper_id", F.col("source_sha256").alias("seen")), "paper_id").filter("source_sha256 <> seen").select("paper_id"), "files changed while they were read")
        require_empty(C.violations(read).select("rule", "paper_id"), "files without text or with broken chunks")
        new = artifact_rows(read)
        # the file name's id is a column of its own: a partition's column doesn't stand in its files
        of = F.col("paper_id").alias("of")
        out = lambda d, kind, form: getattr(d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("of"), form)(f"{root}/{kind}")
        out(new.select(of, F.col("text_json").alias("value")), "texts", "text")
        out(new.drop("text_json").select("*", of), "chunks", "json")
    now = existing(spark, root)
    return now.join(files.select("paper_id", "source_sha256"), ["paper_id", "source_sha256"], "left_semi")


def existing(spark: SparkSession, root: str) -> DataFrame:
    """Chunk artifacts of a state folder; none if it isn't there."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/chunks")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], ARTIFACT)
    return spark.read.schema(f"{ARTIFACT}, of string").option("basePath", f"{root}/chunks").option("mode", "FAILFAST").json(f"{root}/chunks").drop("of")
