"""Top-k search: that it prunes, that it is exact whatever the tree's shape, and that the query returns it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tileframe.llm import topk


def frame(spark, vectors, first=0):
    rows = [(first + i, [float(x) / 64 for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def brute(table, k=20):
    """{query_id: [(vec_id, score)]} over rows (vec_id, integer vector)."""
    out = {}
    for i, v in table:
        if i % 20 == 0:
            scores = [(-int(np.dot(v, w)), j) for j, w in table if j != i and len(w) == len(v)]
            out.setdefault(i, []).extend(scores)
    return {i: [(j, -s) for s, j in sorted(x)[:k]] for i, x in out.items() if x}


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def clustered(n, clusters=40, dim=32):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 40, (clusters, dim))
    return np.rint(centres[rng.integers(0, clusters, n)] + rng.normal(0, 1.5, (n, dim))).astype("i8")


@pytest.mark.parametrize("block", [64, 400, 4096])
def test_prunes_clusters_and_stays_exact(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "LEAF_ROWS", 16)
    x = clustered(2000)
    found = topk.search(topk.quantised(frame(spark, x))).cache()
    met, of = found.agg(F.sum("met"), F.sum("of")).first()

    assert met < of / 2 or block < 4096  # smaller blocks are pruned as pairs, before their leaves count
    assert got(topk._ranked(found, 20)) == brute(list(enumerate(x)))


def test_equal_vectors_and_hot_ids(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    monkeypatch.setattr(topk, "SAMPLE", 16)
    rng = np.random.default_rng(2)
    same = [(1000 + i, np.array([3, 1, -2])) for i in range(150)]  # no net parts them
    other = [(i, rng.integers(-50, 50, 3)) for i in range(120)]
    hot = [(40, rng.integers(-50, 50, 3)) for _ in range(5)] + [(2000, np.zeros(0, "i8")) for _ in range(90)] + [(2020 + i, np.zeros(0, "i8")) for i in range(80)]
    table = same + other + hot
    distinct = list({(i, tuple(v.tolist())): (i, v) for i, v in table}.values())
    rows = [(i, v.tolist(), len(v), "x") for i, v in table]
    out = topk.top_k(spark.createDataFrame(rows, "vec_id long, v array<long>, dim int, score string"))
    assert got(out) == brute(distinct)


def test_query(spark, tmp_path):
    x = clustered(300, 5, 8)
    odd = spark.createDataFrame([(400, None), (420, [float("nan")] * 8), (None, [1.0] * 8), (440, [0.5] * 8)], "vec_id long, embedding array<double>")
    frame(spark, x).union(odd).withColumn("label", F.lit(1)).withColumn("rank", F.lit("x")).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = topk.op10_topk(spark, str(tmp_path))
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert got(out) == brute([*enumerate(x), (440, np.full(8, 32))])


def test_block_tree_covers():
    x = clustered(900, 9, 6)
    order, nodes, radii = topk.planted(x)
    v = x[order].astype("f8")
    assert sorted(order.tolist()) == list(range(900))
    for (a, b, first, last), r in zip(nodes.tolist(), radii, strict=True):
        assert (np.sqrt(((v[a:b] - v[a:b].mean(axis=0)) ** 2).sum(axis=1)) <= r + 1e-9).all()
        kids = nodes[first:last]
        assert first == last and b - a <= topk.LEAF_ROWS or (kids[0][0], kids[-1][1]) == (a, b) and (kids[1:, 0] == kids[:-1, 1]).all()
