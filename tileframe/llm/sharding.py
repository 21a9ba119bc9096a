"""Operator 1: rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents

#: Slots are numbered in this many hash buckets a shard, so that no task sorts a whole shard.
SLOT_BUCKETS = 256


def _score(key: Column, shard: Column, weight: Column) -> Column:
    """-w / ln(u) with u uniform in (0, 1) by key and shard: the highest wins a shard in proportion to w."""
    u = (F.shiftrightunsigned(F.xxhash64(shard, key), 11).cast("double") + 0.5) / F.lit(float(2**53))
    return -weight / F.ln(u)


def _best(key: Column, weights: Sequence[float]) -> Column:
    shards = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights) if w > 0])
    return F.array_max(F.transform(shards, lambda s: F.struct(_score(key, s.i, s.w).alias("score"), (-s.i).alias("back"))))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard (int) of a key. Only key and weights decide; a shard of weight 0 gets nothing.

    One more shard takes keys only into itself; a removed one gives up only its own; a changed weight moves
    only what that shard gains or loses. A null key counts as one more key, and equal keys share a shard.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must be 0 or more, and one of them above 0")
    return (-_best(key, weights)["back"]).cast("int")


def slots(df: DataFrame, shard: str, key: str, order: Sequence[str]) -> DataFrame:
    """Adds slot (long): gapless from 0 in every shard, by hash bucket of key and order, then by these.

    Bucket offsets come from one count of (shard, bucket), at most SLOT_BUCKETS rows a shard. Rows of one key are in one bucket
    only as far as they agree in order, too.
    """
    bucketed = df.withColumn("__bucket", F.pmod(F.xxhash64(F.lit("slot"), F.col(key), *order), F.lit(SLOT_BUCKETS)).cast("int"))
    counts = bucketed.groupBy(shard, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(shard, "__bucket").orderBy(key, *order)
    placed = bucketed.withColumn("__rank", F.row_number().over(within))
    joined = placed.join(F.broadcast(offsets), [shard, "__bucket"])
    return joined.withColumn("slot", F.col("__offset") + F.col("__rank") - 1).drop("__bucket", "__rank", "__offset")


def assign(docs: DataFrame, weights: Sequence[float], extra_weight: float = 1.0) -> DataFrame:
    """Every row of docs (doc_id, text) with its shard, its slot and the shard it has once one more is added.

    Null text counts as empty; repeated rows each get a slot; other columns of docs are not carried.
    """
    best = _best(F.col("doc_id"), weights)
    extra = _score(F.col("doc_id"), F.lit(len(weights)), F.lit(float(extra_weight)))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), weights).alias("shard"),
        F.when(extra > best["score"], F.lit(len(weights))).otherwise((-best["back"]).cast("int")).alias("grown_shard"),
    )
    return slots(rows, "shard", "doc_id", ["text_crc32", "size"])


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir), [1.0] * 40).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
