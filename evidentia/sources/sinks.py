"""What a run leaves behind: packets, reports, bundles; published whole or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators.reporting import REPORT_COLUMNS
from evidentia.schemas import INTERNAL, PACKET


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def require_empty(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p) and len(fs.listStatus(p)):
        raise ValueError(f"{path} must be empty")


def require_apart(a: str, b: str) -> None:
    """Raises ValueError if one folder is the other or lies in it."""
    x, y = (p.rstrip("/") + "/" for p in (a, b))
    if x.startswith(y) or y.startswith(x):
        raise ValueError(f"{a} and {b} must be apart")


def publish(spark: SparkSession, target: str, write: Callable[[str], None]) -> None:
    """Lets ``write`` fill a folder beside ``target`` and renames it there; on any error nothing stays."""
    require_empty(spark, target)
    staging = f"{target.rstrip('/')}.staging-{uuid.uuid4().hex[:8]}"
    fs, p = _fs(spark, staging)
    try:
        write(staging)
        goal = _fs(spark, target)[1]
        fs.delete(goal, True)
        if not fs.rename(p, goal):
            raise OSError(f"{staging} couldn't be renamed")
    except BaseException:
        fs.delete(p, True)
        raise


def delivered(packets: DataFrame) -> DataFrame:
    """Packets without what stays internal."""
    return packets.drop(*INTERNAL)


def packets(records: DataFrame) -> DataFrame:
    """Packets of records, which hold them as JSON text."""
    return records.select(F.from_json("packet", PACKET).alias("p")).select("p.*")


def write_packets(packets: DataFrame, path: str) -> None:
    """One JSON line a packet, in a folder for each paper."""
    d = delivered(packets)
    d.select("paper_id", F.to_json(F.struct(*d.columns)).alias("value")).write.partitionBy("paper_id").text(path)


def write_report(records: DataFrame, summary: DataFrame, path: str, planned: DataFrame | None = None) -> None:
    """summary (JSON), papers (JSON lines), papers (CSV with fixed columns) and the extraction plans, published together."""
    spark = records.sparkSession

    def write(folder: str) -> None:
        summary.coalesce(1).write.json(f"{folder}/summary")
        records.write.json(f"{folder}/papers_jsonl")
        have = set(records.columns)
        records.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in REPORT_COLUMNS)).write.option("header", True).csv(f"{folder}/papers_csv")
        if planned is not None:
            chosen = F.filter("chunks", lambda c: F.array_contains(F.col("selected"), c["ordinal"]))
            planned.select("paper_id", "source_sha256", "classification", F.transform(chosen, lambda c: c["chunk_id"]).alias("selected_chunk_ids"), F.col("selected").alias("selected_ordinals")).write.json(f"{folder}/plans")

    publish(spark, path, write)


def write_bundle(documents: dict[str, DataFrame], records: DataFrame, manifest: DataFrame, path: str) -> None:
    """Documents by kind (paper_id, value), a folder for each paper; a row a paper with paths and digests, by group and in natural order; the groups' manifest.  Published together."""

    def write(folder: str) -> None:
        for name, d in documents.items():
            d.write.partitionBy("paper_id").text(f"{folder}/{name}")
        records.repartitionByRange("horizon", "group", "order_key").sortWithinPartitions("horizon", "group", "order_key").drop("order_key").write.json(f"{folder}/papers")
        manifest.orderBy("horizon", "group").write.json(f"{folder}/manifest")

    publish(records.sparkSession, path, write)
