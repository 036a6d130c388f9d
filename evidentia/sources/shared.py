"""Tables in the folder that all executors share: written once, read by several, deleted when a command ends."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master may lack it, and then gets a folder of its own."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = os.path.join(tempfile.gettempdir(), "evidentia-shared")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that nothing before it runs again when an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/evidentia-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(f"{path}/{name}")
    return spark.read.schema(df.schema).parquet(f"{path}/{name}")


def clear(spark: SparkSession) -> None:
    """Deletes what ``stored`` wrote in this process; for when results are published."""
    while _written:
        p = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
