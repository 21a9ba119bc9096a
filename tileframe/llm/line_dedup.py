"""Operator 2: line dedup over levelled sorted runs of line hashes.

A run is a table (hi, lo, holder) of line keys in buckets by their hash, each one sorted file, where holder is the document that keeps
the line. No key is in two runs. The keys of a new batch of documents are shuffled to the same buckets and merge-anti-joined with
run after run, which are read as they lie, without a shuffle or a sort; what is left is the batch's own run, of level 0. Two
runs of a level are merged, bucket by bucket, into one of the next, so there are at most as many runs as the number of
batches has binary digits. A line stays if its document is the holder in its batch's own run.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, lean, scratch, settings, written

#: Documents of a batch; over one table there are at most MOST_BATCHES, larger ones, as each waits for the one before.
BATCH_ROWS, MOST_BATCHES = 50_000, 12
#: Lines a bucket of all runs together, and buckets at most; larger tables have larger buckets.
BUCKET_LINES, MOST_BUCKETS = 1 << 18, 1 << 16
LEAST_CHARS = 10
SPACE = b" \t\n\x0b\x0c\r"
LAST = 2**63 - 1

LINES = "ord long, text_id long, hi long, lo long, pos array<int>"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's distinct line keys, as 128-bit hashes, with the lines that have them."""
    for batch in batches:
        order, ids, counts, digests, places = batch.column("ord").to_numpy(), batch.column("text_id").to_numpy(), [], [], []
        for text in batch.column("text"):
            own: dict[bytes, list[int]] = {}
            for i, line in enumerate((text.as_py() or b"").split(b"\n")):
                key = line.strip(SPACE).lower()
                if len(key) >= LEAST_CHARS and (len(key) >= 4 * LEAST_CHARS or len(key.decode("utf-8", "replace")) >= LEAST_CHARS):
                    own.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
            counts.append(len(own))
            digests.extend(own)
            places.extend(own.values())
        halves = np.frombuffer(b"".join(digests), ">i8").astype("i8").reshape(-1, 2)
        arrays = [np.repeat(order, counts), np.repeat(ids, counts), halves[:, 0], halves[:, 1]]
        yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), pa.array(places, pa.list_(pa.int32()))], ["ord", "text_id", "hi", "lo", "pos"])


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines at the given positions."""
    for batch in batches:
        kept, total, dropped = [], [], []
        for text, gone in zip(batch.column("text"), batch.column("gone"), strict=True):
            text = text.as_py()
            lines = (text or b"").split(b"\n")
            out = {i for part in gone.as_py() or () for i in part}
            kept.append(b"\n".join([x for i, x in enumerate(lines) if i not in out]) if out else text)
            total.append(len(lines))
            dropped.append(len(out))
        new = [pa.array(kept, pa.binary()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), *new], ["doc", "kept", "n_lines", "n_dropped"])


def _keyed(docs: DataFrame) -> DataFrame:
    """The order that decides who keeps a line, and a hash by which rows of one doc_id are told apart."""
    return docs.withColumn("ord", F.coalesce(F.col("doc_id"), F.lit(LAST))).withColumn("text_id", F.xxhash64("text"))


def line_keys(docs: DataFrame) -> DataFrame:
    rows = _keyed(docs.select("doc_id", "text")).select("ord", "text_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(lean(_keys), LINES)


RUN = "hi long, lo long, holder long"
STATE = "version long, level int, run string, buckets int"


class LineRuns:
    """Levelled sorted runs of line keys below a path, a new one in the shared folder if none is given.

    A path that runs were written to is opened as it was after the last batch, by any session, so that batches can
    be added as a corpus grows; the number of buckets is that of its first time.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 8):
        self.spark, self.path, self.buckets, self.version = spark, path or scratch(spark, "runs"), buckets, 0
        #: Names of runs, by level.
        self.levels: list[list[str]] = [[]]
        self.named: set[str] = set()
        if path and self._exists(f"{path}/state"):
            state = spark.read.schema(STATE).parquet(f"{path}/state")
            for r in state.join(state.agg(F.max("version").alias("version")), "version").orderBy("level", "run").collect():
                self.version, self.buckets = r["version"], r["buckets"]
                self.levels += [[] for _ in range(r["level"] + 1 - len(self.levels))]
                self.levels[r["level"]].append(r["run"])

    def _exists(self, path: str) -> bool:
        own = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return own.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(own)

    def sorted_run(self, run: str) -> DataFrame:
        """A run as a bucketed table of the session's catalog, which is told of it if it is new to the session."""
        self.named.add(run)
        if not self.spark.catalog.tableExists(run):
            columns, where = RUN.replace(" long", " BIGINT"), f"{self.path}/{run}".replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {run} ({columns}) USING parquet CLUSTERED BY (hi, lo) SORTED BY (hi, lo) INTO {self.buckets} BUCKETS LOCATION '{where}'")
        return self.spark.table(run)

    def _write(self, rows: DataFrame) -> str:
        """rows must come in tasks that hold whole buckets, so that each becomes one sorted file."""
        run = f"tileframe_run_{uuid.uuid4().hex}"
        self.named.add(run)
        rows.select("hi", "lo", "holder").write.option("compression", "zstd").option("path", f"{self.path}/{run}").bucketBy(self.buckets, "hi", "lo").sortBy("hi", "lo").saveAsTable(run)
        return run

    def known(self) -> DataFrame:
        """All keys that a batch has brought, with their holders."""
        return functools.reduce(DataFrame.unionByName, [self.sorted_run(x) for level in self.levels for x in level], self.spark.createDataFrame([], RUN))

    def fresh(self, lines: DataFrame) -> DataFrame:
        """(hi, lo, holder) of the keys of line_keys() rows that no run has: the smallest ord holds one."""
        keys = lines.groupBy("hi", "lo").agg(F.min("ord").alias("holder"))
        for run in (x for level in reversed(self.levels) for x in level):
            keys = keys.join(self.sorted_run(run).hint("merge"), ["hi", "lo"], "left_anti")
        return keys

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes a batch of written line_keys() rows; returns its (ord, text_id, pos) that must go.

        A key of an earlier batch is lost to all of this one; a new one stays with the batch's smallest ord.
        """
        with self._layout():
            run = self._write(self.fresh(lines))
            kept = self.spark.read.schema(RUN).parquet(f"{self.path}/{run}").withColumnRenamed("holder", "ord")
            self.levels[0].append(run)
            self._compact()
        self.version += 1
        rows = [(self.version, i, x, self.buckets) for i, level in enumerate(self.levels) for x in level]
        self.spark.createDataFrame(rows, STATE).coalesce(1).write.mode("append").parquet(f"{self.path}/state")
        # a hot key's lines are many, but each document's own; all three columns deal them out evenly
        return lines.join(kept, ["hi", "lo", "ord"], "left_anti").select("ord", "text_id", "pos")

    def _layout(self):
        """Shuffles match the buckets, and the order of the one file that a bucket has is relied on."""
        return settings(self.spark, spark__sql__shuffle__partitions=self.buckets, spark__sql__legacy__bucketedTableScan__outputOrdering="true")

    def merged(self, a: str, b: str) -> DataFrame:
        """Two runs as one; they have no key in common, so a full outer merge join is their union in order."""
        x, y = self.sorted_run(a).hint("merge"), self.sorted_run(b)
        return x.join(y, (x["hi"] == y["hi"]) & (x["lo"] == y["lo"]), "full").select(*[F.coalesce(x[c], y[c]).alias(c) for c in ("hi", "lo", "holder")])

    def _compact(self) -> None:
        for i in range(len(self.levels)):
            if len(self.levels[i]) > 1:
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self._write(self.merged(*self.levels[i])))
                self.levels[i] = []

    def close(self) -> None:
        """Takes the runs out of the session's catalog; their files stay."""
        for run in self.named:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        self.named = set()


def dropped_lines(docs: DataFrame, batches: int | None = None) -> DataFrame:
    """(ord, text_id, gone): the lines that go, for each text that loses any; docs go through the runs in batches by doc_id."""
    spark, rows = docs.sparkSession, docs.count()
    batches = batches or max(1, min(MOST_BATCHES, -(-rows // BATCH_ROWS)))
    cuts = ", ".join(str(i / batches) for i in range(1, batches))
    bounds = (docs.select(F.expr(f"percentile_approx(doc_id, array({cuts}), 1000)")).first()[0] or []) if cuts else []
    batch = sum((F.col("ord") > F.lit(b)).cast("int") for b in sorted(set(bounds))) if bounds else F.lit(0)
    lines = written(line_keys(docs).withColumn("batch", F.lit(0) + batch), "lines", "batch")
    counts, gone = dict(lines.groupBy("batch").count().collect()), []
    runs = LineRuns(spark, buckets=max(1, min(MOST_BUCKETS, -(-sum(counts.values()) // BUCKET_LINES))))
    for b in sorted(counts):
        gone.append(runs.add(lines.filter(F.col("batch") == b).drop("batch")))
    runs.close()
    if not gone:
        return lines.select("ord", "text_id", F.array("pos").alias("gone"))
    return functools.reduce(DataFrame.unionByName, gone).groupBy("ord", "text_id").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame, batches: int | None = None) -> DataFrame:
    """(doc, kept, n_lines, n_dropped) for every row of docs, where doc is a struct of all its columns.

    Null text counts as one empty line and stays null. A null doc_id is the largest; rows that share a
    doc_id count as one document, so they all keep the lines of which it is the smallest holder. Texts are taken whole, however long;
    an empty table gives no rows. Columns of any name pass through within doc.
    """
    gone = dropped_lines(docs, batches)
    rows = _keyed(docs.select("doc_id", "text", F.struct(*docs.drop("text").columns).alias("doc")))
    joined = rows.join(gone, ["ord", "text_id"], "left").select("doc", F.col("text").cast("binary").alias("text"), "gone")
    kind = docs.drop("text").schema.simpleString()
    out = joined.mapInArrow(lean(_rebuild), f"doc {kind}, kept binary, n_lines long, n_dropped long")
    return out.withColumn("kept", F.col("kept").cast("string"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    digest = F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256)
    return out.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", digest.alias("kept_sha256"))


OP2_SQL = r"""
with lines as (
  select doc_id, i, line, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as i
        from (select doc_id, string_split(coalesce(text, ''), E'\n') as parts from documents))
), held as (
  select key, min(doc_id) as keeper from lines where length(key) >= 10 group by key having count(distinct doc_id) >= 2
), marked as (
  select l.doc_id, l.i, l.line, h.key is not null and l.doc_id <> h.keeper as gone from lines l left join held h using (key)
)
select doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, E'\n' order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
