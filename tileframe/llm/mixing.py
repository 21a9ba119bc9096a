"""Operator 6: mixing sources to target weights by capped water-filling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, skew_lookup, written

#: Documents are sampled in hash buckets of about this many rows, so that a hot source takes many tasks.
BUCKET_ROWS = 4096

#: White space of the words that give a document its size.
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_hash): the words of every text; null or empty: 0."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("text_hash"))


def water_fill(totals: DataFrame, cap: float) -> DataFrame:
    """totals (source, source_size, weight) with target: weight shares of all sizes, at most cap times the source.

    What capped sources leave over is shared again by weight until no target is above its cap. Each round
    is one aggregation to three numbers; at least one more source is capped in each but the last.
    """
    whole = totals.agg(F.sum("source_size"), F.sum("weight")).first()
    level, limit = (whole[0] or 0) / whole[1] if whole[1] else 0.0, F.lit(float(cap)) * F.col("source_size")
    while True:
        over = F.col("weight") * F.lit(float(level)) > limit
        capped, free = totals.agg(F.sum(F.when(over, limit).otherwise(0.0)), F.sum(F.when(~over, F.col("weight")))).first()
        rise = ((whole[0] or 0) - (capped or 0.0)) / free if free else level
        if rise <= level * (1 + 1e-12):
            break
        level = rise
    return totals.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), limit).cast("double"))


def _sample(group: pa.Table) -> pa.Table:
    """Whole repetitions of every document, and one more of some, so that the sum stays next to the target.

    Goes by size octave, largest first, in seeded order; a document is taken once more when what is still
    owed is at least half its size. At the end at most half of a smallest document is owed or over.
    """
    size, factor, mark = (group[c].to_numpy() for c in ("size", "factor", "mark"))
    whole = np.floor(factor + 1e-9)
    owed, extra = 0.0, np.zeros(len(size), "int64")
    for i in np.lexsort((mark, -np.floor(np.log2(np.maximum(size, 1))))):
        owed += (factor[i] - whole[i]) * size[i]
        if factor[i] > whole[i] and size[i] and owed >= size[i] / 2:
            extra[i], owed = 1, owed - size[i]
    copies = pa.array((whole.astype("int64") + extra).astype("int32"))
    return group.select(["doc_id", "source", "size", "text_hash", "source_size", "target"]).append_column("copies", copies)


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 42) -> DataFrame:
    """(doc_id, source, size, text_hash, source_size, target, copies) for every row of docs (doc_id, text, source).

    Sources by code point, null last, take the weights in turn. copies is how often the mix takes the
    document: never above cap, rounded up. A source without words has target 0, and documents
    without words are taken as often as the whole part says. Ties and repeated rows are sampled
    each for itself by a seeded hash; reruns agree for equal inputs.
    """
    keys = {"__name": F.coalesce("source", F.lit("")), "__null": F.col("source").isNull()}
    sized = written(sizes(docs).withColumns(keys), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    targets = water_fill(written(weighted, "weights"), cap)
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    mark = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text_hash"))
    known = written(targets.withColumns(keys).select(*keys, "source_size", "target", factor.alias("factor"), "n"), "targets")
    found = skew_lookup(sized, known, list(keys), "n", sized.count()).drop(*keys)
    bucket = F.pmod(F.shiftright("mark", 3), F.ceil(F.col("n") / BUCKET_ROWS).cast("long"))
    rows = found.withColumn("mark", mark).withColumn("bucket", bucket).drop("n")
    schema = "doc_id long, source string, size long, text_hash long, source_size long, target double, copies int"
    return rows.groupBy("source", "bucket").applyInArrow(_sample, schema)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs as often as mix() takes them, with the columns of docs.

    Rows that agree in doc_id, source and text are taken equally often.
    """
    plan = mix(docs, **how).filter("copies > 0")
    plan = plan.groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_hash").alias("__hash")).agg(F.max("copies").alias("__copies"))
    same = docs["doc_id"].eqNullSafe(plan["__id"]) & docs["source"].eqNullSafe(plan["__source"]) & (F.xxhash64(docs["text"]) == plan["__hash"])
    taken = docs.join(plan, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return taken.select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
