"""What the operators of this subpackage share: word pattern, shared storage, checked broadcasts."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, _UPPER, _UPPER.lower())


def word_count(c: Column) -> Column:
    """Words of a text as long; null and empty texts have none."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local master may lack the setting; it gets a folder of its own.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = os.path.join(tempfile.gettempdir(), "evidentia-shared")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    This cuts lineage: a lost executor costs only the tasks that ran on it,
    and several readers don't compute ``df`` again.  ``compact`` is for tables much
    smaller than what they are made of: they go through one more exchange, to two files
    for each core of the cluster, rather than to a file for each partition of theirs.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/evidentia-{uuid.uuid4().hex}"
    _written.append(folder)
    path = f"{folder}/{name}"
    if compact:
        df = df.repartition(2 * spark.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def clear(spark: SparkSession) -> None:
    """Deletes what ``stored`` wrote in this process; for callers, once they have written their results."""
    while _written:
        p = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once a row however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    """Distinct values in order; by sorting, which for integers is many times as fast as ``numpy.unique``'s hash table."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def give_back() -> None:
    """Returns freed memory of this Python worker to the system, where the C library can; workers wait for tasks of other stages with what they hold."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
