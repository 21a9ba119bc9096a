"""Operator 7: SimHash near-dedup by multi-index hashing, and near-dedup by the Jaccard similarity of shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, documents, lean, skew_lookup, written

SEED = 42
SHINGLE = 3
DISTANCE = 2
#: With two segments and at most two differing bits, one segment differs in at most one bit; with three, too.
SEGMENT_BITS = 32
BLOCK = 1 << 15

#: similar(): words of a shingle, and the Jaccard similarity from which texts are one, as a fraction.
WIDE_SHINGLE, SIMILAR = 5, (4, 5)
#: Bits in which fingerprints of wide shingles may differ for their sets to be compared: as many as two segments with balls of one bit find.
WIDE_DISTANCE = 3
#: Texts of similarity 0.8 agree in no band of so many minima in (1 - 0.8 ** 4) ** 28 = 4e-7 of cases.
BANDS, BAND_ROWS = 28, 4
#: A bucket of more sets is compared in pairs of parts of so many.
PART_SETS = 1024
_DRAWS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS, 1), "u8", endpoint=False) | np.array([1, 0], "u8")[:, None, None]


def _hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles of size words, or of the whole shorter text, block by block."""
    words = text.lower().split()  # of bytes: A-Z, and white space \x20\x09-\x0D
    if not words:
        return
    whole, lens = b" ".join(words), np.fromiter(map(len, words), "i8", len(words))
    ends = np.cumsum(lens + 1) - 1
    starts, k = ends - lens, min(size, len(words)) - 1
    h, n = xxhash.xxh64_intdigest, len(words) - k
    for at in range(0, n, BLOCK):
        pairs = zip(starts[at : min(at + BLOCK, n)].tolist(), ends[at + k : min(at + BLOCK, n) + k].tolist(), strict=True)
        yield np.array([h(whole[a:b], SEED) for a, b in pairs], "u8")


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of a text, signed: a bit is set if over half of the shingles' hashes set it."""
    return _majority(_hashes(text, SHINGLE))


def _majority(blocks: Iterable[np.ndarray]) -> int:
    """The bits set in over half of the hashes, signed."""
    bits, n = np.zeros(64, "i8"), 0
    for hashes in blocks:
        bits += np.unpackbits(hashes.astype(">u8").view("u1").reshape(-1, 8), axis=1).sum(axis=0, dtype="i8")
        n += len(hashes)
    return int(np.packbits(2 * bits > n).view(">i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = [fingerprint(x.as_py() or b"") for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.int64())], ["doc_id", "mark"])


def links(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): the representatives of any two different fingerprints (mark, rep) that differ in at most distance bits, 3 at most.

    Each 32-bit segment is a table of its own. A fingerprint is found under its segments; it looks up, in each
    table, its segment and every value one set bit away, and the whole fingerprints of what it meets are
    compared. Setting bits only is enough, as the other of the two has the bit set.
    """
    low = F.lit((1 << SEGMENT_BITS) - 1)
    segment = lambda s: F.shiftrightunsigned("mark", s * SEGMENT_BITS).bitwiseAND(low)
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)

    def ball(value):
        near = F.transform(F.filter(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1)), lambda i: value.bitwiseAND(bit(i)) == 0), lambda i: value.bitwiseOR(bit(i)))
        return F.concat(F.array(value), near)

    sides = [F.struct(F.lit(s).alias("s"), segment(s).alias("key")) for s in (0, 1)]
    table = marks.select("mark", "rep", F.explode(F.array(*sides)).alias("at")).select("at.s", "at.key", "mark", "rep")
    at = lambda s: lambda key: F.struct(F.lit(s).alias("s"), key.alias("key"))
    looks = [F.transform(ball(segment(s)), at(s)) for s in (0, 1)]
    probes = marks.select("mark", "rep", F.explode(F.concat(*looks)).alias("at")).select("at.s", "at.key", F.col("mark").alias("mark2"), F.col("rep").alias("rep2"))
    near = F.bit_count(F.col("mark").bitwiseXOR(F.col("mark2"))) <= distance
    met = probes.join(table, (probes["s"] == table["s"]) & (probes["key"] == table["key"]) & (F.col("mark") != F.col("mark2")) & near)
    return met.select(F.greatest("rep", "rep2").alias("a"), F.least("rep", "rep2").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, component_id) for every row of docs (doc_id, text) with a doc_id.

    Null or empty text has fingerprint zero, which links like any other. Equal fingerprints always
    link and are taken together first, so copies cost nothing further. Repeated doc_ids are one node
    for each of their fingerprints. Rows with a null doc_id are left out of the links and have a null
    component.
    """
    return _grouped(written(_binary(docs).mapInArrow(lean(_fingerprints), "doc_id long, mark long"), "marks"), links)


def _binary(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def _grouped(own: DataFrame, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(doc_id, mark, component_id) of own (doc_id, mark), a written table; links gives (a, b) of (mark, rep, n)."""
    marks = written(own.filter("doc_id is not null").groupBy("mark").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "distinct")
    shared = own.filter("doc_id is not null").groupBy("doc_id").agg(F.min("mark").alias("x"), F.max("mark").alias("y")).filter("x <> y").select("doc_id")
    extra = own.join(shared, "doc_id").join(marks.select("mark", "rep"), "mark").select(F.col("doc_id").alias("b"), F.col("rep").alias("a"))
    edges = written(links(marks).unionByName(extra), "links")
    roots = components(edges)
    labelled = marks.join(roots, marks["rep"] == roots["node"], "left").select("mark", "n", F.coalesce("root", "rep").alias("component_id"))
    found = skew_lookup(own.filter("doc_id is not null"), written(labelled, "labels"), ["mark"], "n", own.count())
    lost = own.filter("doc_id is null").withColumn("component_id", F.lit(None).cast("long"))
    return found.select("doc_id", "mark", "component_id").unionByName(lost)


def _set(text: bytes) -> tuple[int, np.ndarray]:
    """A text's different wide shingles as sorted hashes, and a signed mark of them, zero if there are none."""
    grams = np.unique(np.concatenate([np.zeros(0, "u8"), *_hashes(text, WIDE_SHINGLE)]))
    mark = xxhash.xxh64_intdigest(grams.tobytes(), SEED) if len(grams) else 0
    return mark - (mark >> 63 << 64), grams


def _wide_fingerprint(grams: np.ndarray) -> int:
    """The SimHash of a set."""
    return _majority(grams[at : at + BLOCK] for at in range(0, len(grams), BLOCK))


def _bands(grams: np.ndarray) -> list[int]:
    """A key for each band of the set's minima under BANDS * BAND_ROWS multiplications; none for no set."""
    if not len(grams):
        return []
    least = np.full(BANDS * BAND_ROWS, np.iinfo("u8").max, "u8")
    for at in range(0, len(grams), 1 << 12):
        least = np.minimum(least, ((grams[at : at + (1 << 12)] ^ _DRAWS[1]) * _DRAWS[0]).min(axis=1))
    rows = least.reshape(BANDS, BAND_ROWS)
    return [h - (h >> 63 << 64) for h in (xxhash.xxh64_intdigest(x.tobytes(), i) for i, x in enumerate(rows))]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [_set(x.as_py() or b"") for x in batch.column("text")]
        bands = pa.array([_bands(grams) for _, grams in sets], pa.list_(pa.int64()))
        prints = pa.array([_wide_fingerprint(grams) for _, grams in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([m for m, _ in sets], pa.int64()), prints, bands], ["doc_id", "mark", "print", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [_set(x.as_py() or b"") for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in sets], pa.int64()), pa.array([g.tobytes() for _, g in sets], pa.binary())], ["mark", "grams"])


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is SIMILAR at least."""
    up, down = SIMILAR
    if min(len(x), len(y)) * down < max(len(x), len(y)) * up:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * down >= (len(x) + len(y) - both) * up


def _verify(group: pa.Table) -> pa.Table:
    """Edges (a, b) that join what is alike in a bucket; those already joined are not compared again."""
    reps, sets = group.column("rep").to_pylist(), [np.frombuffer(x.as_py(), "u8") for x in group.column("grams")]
    clusters, edges = [], []
    for i, own in enumerate(sets):
        joined, apart = [i], []
        for cluster in clusters:
            met = next((j for j in cluster if _alike(sets[j], own)), None)
            if met is None:
                apart.append(cluster)
            else:
                edges.append((reps[met], reps[i]))
                joined = cluster + joined
        clusters = [*apart, joined]
    return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})


def _simhash_keys(prints: DataFrame) -> DataFrame:
    """(mark, key) of sets (mark, print) that share a fingerprint or have one of two that differ in at most WIDE_DISTANCE bits."""
    found = links(prints.select(F.col("print").alias("mark"), F.col("print").alias("rep")).distinct(), WIDE_DISTANCE)
    pairs = found.select(F.xxhash64(F.lit("pair"), "a", "b").alias("key"), F.explode(F.array("a", "b")).alias("print"))
    return prints.select("mark", F.xxhash64(F.lit("print"), "print").alias("key")).unionByName(pairs.join(prints, "print").select("mark", "key"))


def similar(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, component_id) as near_duplicates() has them, where texts link whose sets of 5-word shingles have a Jaccard
    similarity of 0.8 or more.

    Equal sets are taken together first. Of the others, those whose SimHash fingerprints differ in at most WIDE_DISTANCE bits, found by
    links(), are compared in full; so are those further apart that share a band of minima, as sets of similarity 0.8 differ in
    about ten of 64 bits, beyond what segments and balls find.
    """
    rows = _binary(docs)
    sketches = written(rows.mapInArrow(lean(_sketches), "doc_id long, mark long, print long, bands array<long>"), "sketches")

    def near(marks: DataFrame) -> DataFrame:
        own = sketches.filter("doc_id is not null").dropDuplicates(["mark"])
        keys = own.select("mark", F.explode("bands").alias("key")).unionByName(_simhash_keys(written(own.select("mark", "print"), "prints")))
        met = keys.groupBy("key").agg(F.sort_array(F.collect_set("mark")).alias("met")).filter(F.size("met") > 1)
        buckets = written(met.select("met").distinct(), "buckets")
        parts = F.ceil(F.size("met") / PART_SETS).cast("int")
        members = buckets.select(F.xxhash64("met").alias("bucket"), parts.alias("parts"), F.posexplode("met").alias("pos", "mark"))
        part = F.floor(F.col("pos") / PART_SETS).cast("int")
        others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: (o != part) | (F.col("parts") == 1))
        cells = members.withColumn("part", part).withColumn("other", F.explode(others))
        cells = cells.select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "mark").distinct()
        wanted = written(members.select("mark").distinct().join(marks.select("mark", "rep"), "mark"), "wanted")
        texts = rows.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        sets = written(texts.mapInArrow(lean(_sets), "mark long, grams binary").dropDuplicates(["mark"]).join(wanted, "mark"), "sets")
        return cells.join(sets, "mark").select("bucket", "low", "high", "rep", "grams").groupBy("bucket", "low", "high").applyInArrow(_verify, "a long, b long").distinct()

    return _grouped(sketches.select("doc_id", "mark"), near)


def keep_one(docs: DataFrame, groups: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """The document with the smallest doc_id of each group; rows with a null doc_id stay. Of rows that share a doc_id, that of the smallest hash of all columns stays."""
    copies = groups(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    hashed = docs.filter("doc_id is not null").withColumn("__hash", F.xxhash64(*docs.columns))
    least = hashed.groupBy("doc_id").agg(F.min("__hash").alias("__least"))
    first = hashed.join(copies, "doc_id", "left_anti").join(least, "doc_id").filter("__hash = __least").dropDuplicates(["doc_id"])
    return first.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id")
