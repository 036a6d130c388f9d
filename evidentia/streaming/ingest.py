"""Streams: papers taken in as they come, and events counted in windows.

An addition: the batch semantics of the other modules, kept up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from evidentia.operators.chunks import chunk_rows, line_pages, papers


def new_chunks(sources: DataFrame, paper_id: str, text: str) -> DataFrame:
    """Chunks of a stream of texts; each content once within the watermark's memory."""
    p = papers(sources, paper_id, text, line_pages(F.coalesce(F.col(text), F.lit(""))))
    return chunk_rows(p.dropDuplicates(["paper_id", "source_sha256"]))


def append_chunks(sources: DataFrame, target: str, checkpoint: str, paper_id: str = "doc_id", text: str = "text", once: bool = True) -> StreamingQuery:
    """Appends chunks of new or changed papers to ``target``; a batch that comes again adds nothing."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        p = papers(batch, paper_id, text, line_pages(F.coalesce(F.col(text), F.lit("")))).dropDuplicates(["paper_id", "source_sha256"])
        fresh = p.select("paper_id", "source_sha256", F.inline_outer("chunks")).filter("chunk_id is not null")
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            known = spark.read.parquet(target).select("paper_id", "source_sha256").distinct()
            fresh = fresh.join(known, ["paper_id", "source_sha256"], "left_anti")
        fresh.write.mode("append").parquet(target)

    w = sources.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def windowed(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums of events (ts, event_type, value) by tumbling window and type; works on streams and on tables."""
    d = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need an instant
    d = d.withWatermark("ts", late) if events.isStreaming else d
    g = d.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))
    return g.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of users: events with pauses under ``gap``."""
    g = events.groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("session_window.start").alias("session_start"), "n")


def read_stream(spark: SparkSession, schema: str, folder: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)
