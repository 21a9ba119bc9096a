"""Detection filters and segment classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Least confidence by class, and the entropy above which a pond is dropped.
CONFIDENCE = {"Dry": 0.75, "Wet": 0.60, "Wells": 0.71, "plantations": 0.50}
MOST_ENTROPY = 2.5


def confident(detections: DataFrame, thresholds: dict[str, float] = CONFIDENCE) -> DataFrame:
    """Detections of at least their class's confidence; unknown classes go."""
    table = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
    return detections.filter(F.col("conf") >= F.try_element_at(table, F.col("cls")))


def gated(detections: DataFrame, keep_null_entropy: bool = False) -> DataFrame:
    """Ponds of low entropy. A null entropy, which every dry pond has, is dropped unless kept on request."""
    low = F.col("entropy") <= MOST_ENTROPY
    return detections.filter(low | F.col("entropy").isNull() if keep_null_entropy else low)


def classify(rect: Column, size: Column, ent: Column, lines: Column, redder: Column) -> Column:
    """farm, scrubland or rest. redder: whether redness is above greenness."""
    scrub = (ent > 2.5) & (lines <= 1) & (size > 2000) & (rect < 0.67) & redder
    return F.when((rect >= 0.67) & (size > 500) & (size < 2000) & (ent < 1), "farm").when(scrub | (size > 100_000), "scrubland").otherwise("rest")


def classify_legacy(rect: Column, size: Column, ent: Column, ent_pl: Column, lines: Column) -> Column:
    square = (rect > 0.67) & (size < 20_000)
    return F.when(size > 80_000, 0).when((ent < 1) & (rect > 0.6), 1).when(square & ((ent_pl < 8.5) | (lines == 1)), 2).otherwise(0)


def only_class(label: Column, cls: Column, wanted: str) -> Column:
    return F.when(cls == wanted, label).otherwise(0)


def right_angles(lines: DataFrame, key: str, tolerance: float = 5.0) -> DataFrame:
    """(key, pairs): how many unordered pairs of a segment's lines stand at right angles.

    The angle of two lines is |d|, and 180 - |d| where that is less, so a difference near 270 is not found. Directions are
    counted by value first, and only different directions of one segment are paired.
    """
    angle = F.degrees(F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")))
    dirs = lines.select(key, angle.alias("angle")).groupBy(key, "angle").agg(F.count("*").alias("n"))
    # directions in cells of 5 degrees: a partner stands 85 to 95 degrees on, in one of four cells
    cell = lambda x: F.floor(x / 5.0)
    wide = 90 + tolerance
    a = dirs.select(key, "angle", "n", F.explode(F.sequence(cell(F.col("angle") + 90 - tolerance), cell(F.col("angle") + wide))).alias("cell"))
    b = dirs.select(F.col(key).alias("k2"), F.col("angle").alias("angle2"), F.col("n").alias("n2"), cell(F.col("angle")).alias("cell2"))
    d = F.abs(F.col("angle2") - F.col("angle"))
    pairs = a.join(b, (F.col(key) == F.col("k2")) & (F.col("cell") == F.col("cell2"))).filter(F.abs(F.least(d, 180 - d) - 90) <= tolerance)
    return pairs.groupBy(key).agg(F.sum(F.col("n") * F.col("n2")).alias("pairs"))


def ring_neighbours(values: Column) -> Column:
    """array<struct<before, own, after>> around a ring."""
    n = F.size(values)
    at = lambda i: F.get(values, F.pmod(i, n))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(at(i - 1).alias("before"), at(i).alias("own"), at(i + 1).alias("after")))


def mark_done(status: DataFrame, done: DataFrame, key: str, flag: str) -> DataFrame:
    """Status with the flag set for the keys of done; every other flag stays."""
    ids = done.select(key).distinct().withColumn("__done", F.lit(True))
    return status.join(ids, key, "left").withColumn(flag, F.coalesce("__done", flag)).drop("__done")


def pending(status: DataFrame, flag: str = "overall_status") -> DataFrame:
    return status.filter(~F.coalesce(F.col(flag), F.lit(False)))


def unfinished(tasks: DataFrame, states: DataFrame) -> DataFrame:
    """Tasks that have no terminal state yet."""
    over = states.filter(F.col("state").isin("SUCCEEDED", "COMPLETED", "FAILED", "CANCELLED"))
    return tasks.join(over, "task", "left_anti")


def top_contour(contours: DataFrame, *keys: str) -> DataFrame:
    """The contour of largest area; of equal ones the first."""
    window = Window.partitionBy(*keys).orderBy(F.col("area").desc(), "position")
    return contours.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def sized(regions: DataFrame, least: int = 10, most: int | None = None, area: str = "area") -> DataFrame:
    """Regions of at least and at most so many pixels."""
    return regions.filter((F.col(area) >= least) & (F.col(area) <= most if most is not None else F.lit(True)))


def in_folder_order(blocks: DataFrame, key: str) -> DataFrame:
    """By name, as folders are listed: 10 comes before 2."""
    return blocks.orderBy(F.col(key).cast("string"))


def in_chunk_order(chunks: DataFrame) -> DataFrame:
    """By number: i, then j."""
    return chunks.orderBy("i", "j")


def extent(chunks: DataFrame) -> DataFrame:
    """One row: the largest i, j and label."""
    return chunks.agg(F.max("i").alias("max_i"), F.max("j").alias("max_j"), F.max("label").alias("max_label"))
