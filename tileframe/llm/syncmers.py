"""Operator 4: document fingerprints of closed syncmers. DataFrame functions only.

A text is a sequence of symbols: its words, and the single code points of runs longer than LONG without white space, so that scripts
without spaces have symbols too. Of its k-mers of symbols, those whose smallest inner s-mer, by hash, stands first or last are
anchors. Whether a k-mer is one depends on its own symbols alone, so an edit elsewhere moves no anchor, and any window of
K - S + 1 k-mers has at least one. Anchors of two texts are matched by mark and compared by place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents

K = 5
S = 2
LONG = 24
#: Neighbouring documents are found within buckets of about so many rows, which spill to disk; of STEPS x STEPS buckets at most,
#: whose bounds and first keys (24 bytes each) the driver holds.
BUCKET_ROWS = 2000
STEPS = 256


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<pos int, mark int>> in text order: the closed syncmers' positions in symbols and 32-bit hashes.

    A text of under k symbols is one anchor as a whole; one without any has none.
    """
    words = F.regexp_extract_all(text, F.lit(rf"((?<!\S)\S{{1,{LONG}}}(?!\S)|\S)"), F.lit(1))

    def smers(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - s), lambda i: F.xxhash64(*[w[i + j] for j in range(s)]))

    def marks(w, m):
        at = F.sequence(F.lit(0), F.size(w) - k)
        inner = k - s  # the last of a k-mer's s-mers
        closed = F.filter(at, lambda i: F.least(m[i], m[i + inner]) <= F.least(*[m[i + j] for j in range(1, inner)]))
        return F.transform(closed, lambda i: F.struct(i.alias("pos"), F.hash(*[m[i + j] for j in range(0, inner + 1, s)], m[i + inner]).alias("mark")))

    def of(w):
        whole = F.array(F.struct(F.lit(0).alias("pos"), F.hash(F.array_join(w, " ")).alias("mark")))
        none = F.filter(whole, lambda _: F.lit(False))
        few = F.when(F.size(w) == 0, none).otherwise(whole)
        many = F.flatten(F.transform(F.array(smers(w)), lambda m: marks(w, m)))
        return F.when(F.size(w) < k, few).otherwise(many)

    # a one-element transform binds the words, so that they are computed once
    return F.flatten(F.transform(F.array(words), of))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two arrays of distinct marks: 1 for two empty ones."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(F.try_divide(2.0 * F.size(F.array_intersect(a, b)), total))


def matches(a: Column, b: Column) -> Column:
    """array<struct<a int, b int>> by a: where the marks stand that two anchors() arrays share, the first place of each.

    Both arrays are sorted as one, so that equal marks are neighbours; the work is that of sorting.
    """
    side = lambda x, of, sign: F.transform(x, lambda y: F.struct(y.mark.alias("mark"), F.lit(of).alias("side"), (sign * y.pos).alias("pos")))
    both = F.array(F.sort_array(F.concat(side(a, 0, -1), side(b, 1, 1))))
    near = lambda s: F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), lambda x, y: F.when((x.mark == y.mark) & (x.side < y.side), F.struct((-x.pos).alias("a"), y.pos.alias("b"))))
    return F.sort_array(F.array_compact(F.flatten(F.transform(both, near))))


def steps(pairs: Column) -> Column:
    """array<struct<a int, b int>>: how far each match lies behind the one before, in both texts."""
    return F.zip_with(F.slice(pairs, 2, F.greatest(F.size(pairs) - 1, F.lit(0))), F.slice(pairs, 1, F.greatest(F.size(pairs) - 1, F.lit(0))), lambda y, x: F.struct((y.a - x.a).alias("a"), (y.b - x.b).alias("b")))


def in_step(pairs: Column) -> Column:
    """Share of neighbouring matches that are equally far apart in both texts: 1 where one text is a stretch of the other; null for under two matches."""
    own = steps(pairs)
    return F.try_divide(F.size(F.filter(own, lambda x: x.a == x.b)), F.size(own))


def as_text(marks: Column) -> Column:
    """Marks as one string, 8 hex digits each."""
    return F.array_join(F.transform(marks, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def distinct_marks(found: Column) -> Column:
    """The marks of an anchors() array, each once, in text order."""
    return F.array_distinct(F.transform(found, lambda x: x.mark))


def _bucket(rows: DataFrame, key: str, tie: str) -> Column:
    """A number that does not fall as (key, tie) rises, and so deals rows out in order; nulls are below all keys.

    Keys, which are longs, are cut at STEPS x STEPS quantiles at most, found in two steps, and nulls, as many as they may be, by their ties.
    """
    n, nulls = rows.agg(F.count(key), F.count_if(F.col(key).isNull())).first()
    parts, lots = (max(1, min(STEPS * STEPS, x // BUCKET_ROWS)) for x in (n, nulls))
    cuts = []
    if parts > 1:
        marks = ", ".join(str(i / parts) for i in range(1, parts))
        cuts = sorted(set(rows.select(F.expr(f"percentile_approx({key}, array({marks}), {max(10_000, 4 * parts)})")).first()[0]))
    array = lambda own: F.expr(f"array({', '.join(f'{c}L' for c in own)})")
    below = lambda own: F.size(F.filter(own, lambda c: c <= F.col(key)))
    coarse = cuts[STEPS::STEPS]
    first = below(array(coarse)) if coarse else F.lit(0)
    fine = F.array(*[array(cuts[i : i + STEPS]) for i in range(0, len(cuts), STEPS)])
    of_key = first * STEPS + below(F.get(fine, first)) if cuts else F.lit(0)
    of_null = F.floor((F.col(tie) / F.lit(2.0**64) + 0.5) * lots).cast("int") - lots - 1
    return F.when(F.col(key).isNull(), of_null).otherwise(of_key)


def neighbours(rows: DataFrame, key: str, fields: list[str], tie: str, derive: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """derive(rows) with next: a struct of the fields of the next row by descending key; the first row follows the last.

    Rows are dealt into ranges of key. Each range also gets, as a guest, the first row of the range that follows it, so one
    shuffle brings every row beside its neighbour; derive() works behind it. Ties go by a hash of the column tie; null keys come last.
    """
    ranked = rows.withColumn("__tie", F.xxhash64(tie))
    ranked = ranked.withColumn("__bucket", _bucket(ranked.select(key, "__tie"), key, "__tie"))
    order = F.struct(F.col(key).alias("k"), F.col("__tie").alias("t"))
    firsts = sorted(ranked.groupBy("__bucket").agg(F.max(order).alias("top")).collect(), key=lambda r: r["__bucket"])
    # the first row of a bucket is a guest of the bucket before it, the next higher that has rows
    hosts = [(r["top"]["k"], r["top"]["t"], firsts[(i + 1) % len(firsts)]["__bucket"]) for i, r in enumerate(firsts)]
    tops = rows.sparkSession.createDataFrame(hosts, f"__k {rows.schema[key].dataType.simpleString()}, __t long, __to int")
    met = ranked.join(F.broadcast(tops), ranked[key].eqNullSafe(tops["__k"]) & (ranked["__tie"] == tops["__t"]), "left").drop("__k", "__t")
    places = F.array(F.struct(F.col("__bucket").alias("at"), F.lit(False).alias("guest")), F.when(F.col("__to").isNotNull(), F.struct(F.col("__to").alias("at"), F.lit(True).alias("guest"))))
    dealt = met.withColumn("__p", F.explode(F.array_compact(places))).withColumns({"__at": F.col("__p.at"), "__guest": F.col("__p.guest")}).drop("__p", "__bucket", "__to")
    line = [F.col("__guest"), F.col(key).desc_nulls_last(), F.col("__tie").desc()]
    dealt = derive(dealt.repartition("__at").sortWithinPartitions("__at", *line))
    return dealt.withColumn("next", F.lead(F.struct(*fields)).over(Window.partitionBy("__at").orderBy(*line))).filter("not __guest").drop("__at", "__guest", "__tie")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's anchors, those of its edited text and those of the next document.

    Takes doc_id and text of docs (null: empty); no other column is carried. Repeated rows follow each other, null doc_ids come
    last, a table of one row has itself as the next, and an empty table gives no rows. Long texts are taken whole.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # texts alone are shuffled; anchors are found behind the shuffle
    rows = neighbours(rows, "doc_id", ["text", "found"], "text", lambda x: x.withColumn("found", anchors(F.col("text"))))
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n.cast("int") - half), F.substring(F.col("next.text"), F.lit(1), half))
    rows = rows.select("doc_id", n.alias("n_chars"), "found", F.col("next.found").alias("next_found"), edited.alias("edited"))
    return rows.withColumn("edited_found", anchors(F.col("edited")))


def op4_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints(documents(spark, sf_dir))
    own, edited, after = (distinct_marks(F.col(c)) for c in ("found", "edited_found", "next_found"))
    out = out.withColumn("matched", matches(F.col("found"), F.col("edited_found")))
    out = out.select("doc_id", "n_chars", "edited", "matched", own.alias("marks"), edited.alias("edited_marks"), after.alias("next_marks"))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("marks")).alias("fingerprint"),
        as_text(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
        F.size("matched").alias("matched_edited"),
        in_step(F.col("matched")).alias("in_step_edited"),
    )
