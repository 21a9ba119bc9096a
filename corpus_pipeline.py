"""From raw documents to a tokenised training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and
rereads it as the next stage's docs. All but the last return the columns of documents.

In every stage an empty table gives no rows, texts of any length are taken whole, and a null text counts as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tileframe.llm import bpe, line_dedup, mixing, quality, simhash
from tileframe.llm.common import documents, drop_scratch, made, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the model of trusted text rejects go. Rows are told apart by doc_id, text and lang; those of a language
    without trusted text stay, and so do empty texts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines that an earlier document holds go, and n_chars follows. A null doc_id is the largest, null text stays null, and
    repeated rows of a doc_id count as one document."""
    out = line_dedup.dedup_lines(docs)
    fields = {c: F.col(f"doc.{c}").alias(c) for c in docs.columns if c != "text"}
    fields["text"] = F.col("kept").alias("text")
    fields["n_chars"] = F.char_length("kept").cast("long").alias("n_chars")
    return out.select(*[fields[c] for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7 on 5-word shingles: one document of each group stays, that of the smallest doc_id. Texts whose SimHash fingerprints are near each other,
    found by multi-index hashing, link if their Jaccard similarity is 0.8 or more, and so do texts of that similarity whose fingerprints are not.
    Rows with a null doc_id stay; of rows that share a doc_id one stays, chosen by a hash; texts without words are one group."""
    return simhash.keep_one(docs, simhash.similar)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents stand as often as the mix takes them. A null source is one more source; repeated rows are taken equally often."""
    return mixing.mixed(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: every row's token ids and the digests of them and of what they decode to, repeated rows and null doc_ids included."""
    encoded = bpe.encode(docs.select("doc_id", "source", "lang", "text"), bpe.word_bpe())
    return encoded.select("doc.doc_id", "doc.source", "doc.lang", "ids", *bpe.digests(encoded))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", source_mixing),
    ("BPE encoding and decoding", bpe_encoding),
]

#: Hash-seeded sampling and the model cannot be written in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table; all other tables that the stages wrote are removed once the next one is complete."""
    docs, before = documents(spark, sf_dir), made()
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i}")
        drop_scratch(spark, since=before, keep=1)
    return docs
