"""Helpers that the operators share: the cluster's shared folder, written stages, and joins that hot keys cannot stall."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TABLES: dict = {}


@cache
def _one_machine() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI under spark.checkpoint.dir, which all executors share.

    Where that is unset, a folder of our own if driver and executors are one process (tests); on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(base or _one_machine()).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def worker_table(key: tuple, make: Callable):
    """This Python worker's one large table (a vocabulary, a cache of words): that of the last operator that asked.

    Workers outlive stages, so what an earlier stage left would add to what the next one needs.
    """
    if key not in _TABLES:
        _TABLES.clear()
        give_back()
        _TABLES[key] = make()
    return _TABLES[key]


def give_back() -> None:
    """Returns memory that this worker has freed to the machine: its allocators keep it otherwise, for all later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def drop_tables(kept: bool = False) -> None:
    """Lets go of what ``worker_table`` holds, unless it is ``kept``."""
    if _TABLES and not kept:
        _TABLES.clear()
        give_back()


def tidy(run: Callable[[Iterator], Iterator], table: bool = False) -> Callable[[Iterator], Iterator]:
    """``run``, for mapInArrow, that gives its memory back when a task ends.

    table: ``run`` asks for a ``worker_table``. One that doesn't lets go of what earlier operators left: else a vocabulary
    and its words stay in each worker beside the tables of all later stages.
    """

    def tidied(batches: Iterator) -> Iterator:
        drop_tables(kept=table)
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder as Parquet and read back (its lineage ends there), and where it lies."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    return written_at(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``written_at`` that nothing will read again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, inside a task."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def join_by_count(rows: DataFrame, table: DataFrame, key: str, count: str, total: int, spread: str, most: int = 2000) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has one row per key and in ``count`` how many rows have that key.

    Keys of more than total/most rows, of which there can be only ``most``, are broadcast; the rows that they
    serve go to the shuffled join under null-free keys of their own (from ``spread``), so no task gets a hot key.
    """
    columns = [c for c in table.columns if c != key]
    limit = max(total // most, 50)
    hot = table.filter(F.col(count) > limit).select(F.col(key).alias("_hot_key"), F.struct(*columns).alias("_hot"))
    out = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    # rows of hot keys look for a pair (key, spread) that no cold row has; as one value, so that all of it deals them out
    salt = F.when(F.col("_hot_key").isNotNull(), F.col(spread))
    out = out.withColumn("_probe", F.struct(F.col(key).alias("k"), salt.alias("s")))
    cold = table.filter(F.col(count) <= limit).select(F.struct(F.col(key).alias("k"), F.lit(None).cast(rows.schema[spread].dataType).alias("s")).alias("_cold_probe"), F.struct(*columns).alias("_cold"))
    out = out.join(cold.hint("merge"), F.col("_probe") == F.col("_cold_probe"), "left")
    picked = [F.coalesce(F.col(f"_hot.{c}"), F.col(f"_cold.{c}")).alias(c) for c in columns]
    return out.select(*rows.columns, *picked)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores behind those that ``df`` has already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
