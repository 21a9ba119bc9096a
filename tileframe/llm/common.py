"""What the operators share: scratch tables, skew-proof lookups and components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import operator
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A lookup key with more than 1/HOT_SHARE of the rows is hot, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1000

#: Scratch tables of this process, in the order they were made.
_made: list[str] = []


def _give_back() -> None:
    """Returns what this Python process no longer uses to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """f for mapInArrow, whose process gives its memory back after each task; Spark keeps idle processes beside those of other steps."""

    @functools.wraps(f)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        _give_back()

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from the session's spark.checkpoint.dir.

    Only a session on a local master may lack it; then a temporary folder is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = tempfile.mkdtemp(prefix="tileframe-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{base}")
    return f"file://{base}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark)}/tileframe/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextlib.contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """The session's settings of these names (dots as double underscores) for a while."""
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k.replace("__", "."), str(v))
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends here, and a lost executor loses nothing."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean_disk(spark: SparkSession):
    """While it holds, what a written() table shuffled is deleted as soon as the table is complete, not when the JVM next collects garbage.

    Not for tables that are read with toLocalIterator(), which still needs shuffles when its execution has ended.
    """
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def made() -> int:
    """How many scratch tables there are, for drop_scratch()."""
    return len(_made)


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Deletes this process's scratch tables but the first since and the last keep; results that still read one must have been written before."""
    for path in _made[since : len(_made) - keep]:
        own = spark._jvm.org.apache.hadoop.fs.Path(path)
        own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)
    del _made[since : len(_made) - keep]


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return functools.reduce(operator.and_, (a[k] == b[k] for k in keys))


def skew_lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """rows INNER JOIN table on keys, where table has each key once and weight counts its rows.

    Hot keys, each with over 1/HOT_SHARE of the total rows, number fewer than HOT_SHARE by that count
    and are broadcast; all others go through a shuffle. Both inputs are read twice, so pass written tables.
    """
    hot = F.broadcast(table.filter(F.col(weight) * HOT_SHARE > total))
    cold = table.filter(F.col(weight) * HOT_SHARE <= total)
    rest = rows.join(hot.select(*keys), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(cold, keys))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph given as longs (a, b).

    Alternating large-star and small-star rounds, each written to the shared folder, until the
    edges no longer change. Returns (node, root) for every node that is in an edge, where root is the
    component's smallest node. Work in a round is linear in the edges, rounds grow with the log of the size.
    """
    spark = edges.sparkSession

    def large(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()

    def small(e: DataFrame) -> DataFrame:  # here a > b in every edge
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        linked = e.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return linked.union(least.select("a", F.col("m").alias("b"))).distinct()

    def signature(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(b as decimal(38,0)))")).first())

    e = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, now = None, signature(e)
    while before != now:
        e = written(small(large(e)), "edges")
        before, now = now, signature(e)
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
