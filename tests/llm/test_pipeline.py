"""The corpus pipeline against brute-force versions of its stages, each on what its predecessor kept."""

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_operators import KIND, brute_groups, brute_lines, brute_simhash, docs, rows, texts  # noqa: F401

from tileframe.llm import bpe, mixing, quality


@pytest.fixture(scope="module")
def sf_dir(spark, docs, texts, tmp_path_factory):  # noqa: F811
    path = tmp_path_factory.mktemp("tables")
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(d, 1, 0) for d in texts if d % 3], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_and_run(spark, sf_dir, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, after = now.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, sf_dir).write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
        after.append(now)
    assert all(x.columns == columns for x in after[:-1])
    got = [{r["doc_id"]: r["text"] for r in x.collect()} for x in after[:-1]]

    judged = quality.classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert set(got[0]) == {r["doc_id"] for r in judged.filter("keep").collect()}
    lines = brute_lines(got[0])
    assert {d: t or "" for d, t in got[1].items()} == {d: x[2] for d, x in lines.items()}
    assert after[1].filter(F.col("text").isNotNull() & (F.col("n_chars") != F.char_length("text"))).count() == 0
    marks = {d: brute_simhash(t) for d, t in got[1].items()}
    assert set(got[2]) == set(brute_groups(marks).values()) and all(got[1][d] == t for d, t in got[2].items())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(after[2]).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in after[3].select("doc_id").collect()) == Counter(copies)

    library = tokenizers.Tokenizer.from_file(bpe.word_bpe())
    last = after[4].collect()
    assert Counter(r["doc_id"] for r in last) == Counter(copies)
    for r in last:
        ids = library.encode(got[3][r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, last), key=str)


def test_empty_documents(spark, sf_dir, tmp_path):
    spark.createDataFrame([], KIND).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
