"""Job requests as a stream: {state, district, block} in, one run each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

REQUEST = "state string, district string, block string, requested timestamp"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Requests from JSON files as they arrive, in lower case; those without all three names are marked invalid."""
    fields = {c: F.lower(F.trim(c)) for c in ("state", "district", "block")}
    rows = spark.readStream.schema(REQUEST).json(path).withColumns(fields)
    return rows.withColumn("valid", F.col("state").isNotNull() & F.col("district").isNotNull() & F.col("block").isNotNull())


def fresh(requests: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Valid requests, each region once within the delay."""
    return requests.filter("valid").withWatermark("requested", delay).dropDuplicatesWithinWatermark(["state", "district", "block"])


def start(requests: DataFrame, job: Callable[[SparkSession, str, str, str], None], checkpoint: str) -> StreamingQuery:
    """Runs a job for each request of each micro-batch; a batch holds as many requests as came in one trigger."""

    def run(batch: DataFrame, _: int) -> None:
        for r in batch.select("state", "district", "block").toLocalIterator():
            job(batch.sparkSession, r["state"], r["district"], r["block"])

    return requests.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
