"""The registered queries as they are called, against brute force: columns, digests, nulls, repeated rows and clashing columns."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F
from test_operators import KIND, brute_groups, brute_simhash, docs, rows, texts  # noqa: F401

from tileframe.llm import common, licenses, mixing, queries, quality, sharding, simhash


@pytest.fixture(scope="module")
def sf_dir(docs, tmp_path_factory):  # noqa: F811
    path = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{path}/documents.parquet")
    return str(path)


def spark_hash(*longs):
    """Spark's xxhash64 of an int and a long, unsigned."""
    first, second = longs
    h = xxhash.xxh64_intdigest(first.to_bytes(4, "little"), 42)
    return h if second is None else xxhash.xxh64_intdigest(second.to_bytes(8, "little", signed=True), h)


def brute_shard(key, shards):
    score = lambda i: -1.0 / math.log(((spark_hash(i, key) >> 11) + 0.5) / 2**53)
    return max(range(shards), key=lambda i: (score(i), -i))


def test_sharding_is_rendezvous_hashing(spark, sf_dir, texts):  # noqa: F811
    out = sharding.op1_sharding(spark, sf_dir).collect()
    assert out[0].__fields__ == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for r in out:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 16, zlib.crc32(data), "key")
        assert (r["shard"], r["grown_shard"]) == (brute_shard(r["doc_id"], 40), brute_shard(r["doc_id"], 41))


def test_slots_of_hot_keys_and_nulls(spark):
    table = spark.createDataFrame([(None, f"t{i}") for i in range(700)] + [(5, f"u{i}") for i in range(300)], "doc_id long, text string")
    slots = defaultdict(list)
    for r in sharding.assign(table, [1.0] * 3).collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and sum(map(len, slots.values())) == 1000


def test_mixing_query(spark, sf_dir, rows):  # noqa: F811
    out = mixing.op6_mixing(spark, sf_dir).collect()
    assert out[0].__fields__ == ["doc_id", "size", "source_size", "target", "taken"]
    source = {r[0]: r[3] for r in rows}
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    order = [*sorted({s for s in source.values() if s is not None}), None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total = {s: sum(size[d] for d in source if source[d] == s) for s in order}
    capped, target = set(), {}
    while True:  # by the words of the contract: what stands above its cap is set to it, the rest is shared again
        free = [s for s in order if s not in capped]
        left = sum(total.values()) - sum(3 * total[s] for s in capped)
        target = {s: 3 * total[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > 3 * total[s]}
        if not over:
            break
        capped |= over
    taken = Counter()
    for r in out:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= max(size[d] for d in source if source[d] == s) for s in order)
    again = mixing.op6_mixing(spark, sf_dir).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_mixed_rows_alike_but_for_their_text(spark):
    table = spark.createDataFrame([(1, f"some {w} words", "a") for w in "abcdefgh"] + [(2, "x " * 50, "b"), (None, "y z", None)], "doc_id long, text string, source string")
    plan = mixing.mix(table)
    wanted = Counter()
    for r in plan.collect():
        wanted[r["doc_id"], r["text_hash"]] += r["copies"]
    got = Counter((r["doc_id"], r["h"]) for r in mixing.mixed(table).select("doc_id", F.xxhash64("text").alias("h")).collect())
    assert got == +wanted


def test_simhash_query(spark, sf_dir, texts):  # noqa: F811
    marks = {d: brute_simhash(t) for d, t in texts.items()}
    out = simhash.op7_simhash(spark, sf_dir).collect()
    groups = brute_groups(marks)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out} == {d: (f"{m:016x}", groups[d]) for d, m in marks.items()}


def test_keep_one_chooses_the_same_row_again(spark):
    same = [(1, f"different words in every row {i}", "en") for i in range(20)] + [(1, "different words in every row 3", "en"), (None, "x", "en"), (None, "x", "en")]
    table = spark.createDataFrame(same, "doc_id long, text string, __x string")
    first = sorted(map(tuple, simhash.keep_one(table.repartition(7)).collect()), key=str)
    assert first == sorted(map(tuple, simhash.keep_one(table.repartition(3).orderBy(F.rand(1))).collect()), key=str)
    assert sum(r[0] == 1 for r in first) == 1 and sum(r[0] is None for r in first) == 2


def test_lookup_of_hot_and_cold_keys(spark):
    rng = random.Random(1)
    left = [(rng.randrange(3000) if i % 3 else 7, i) for i in range(6000)]
    counts = Counter(k for k, _ in left)
    table = common.written(spark.createDataFrame([(k, n, k * 10) for k, n in counts.items() if k % 2], "k long, n long, v long"), "t")
    own = common.written(spark.createDataFrame(left, "k long, i long"), "t")
    assert max(counts.values()) * common.HOT_SHARE > 6000 > min(counts.values()) * common.HOT_SHARE
    out = common.skew_lookup(own, table, ["k"], "n", 6000).select("k", "i", "v").collect()
    assert sorted(map(tuple, out)) == sorted((k, i, k * 10) for k, i in left if k % 2)


def test_license_query_agrees_with_its_sql(spark, tmp_path):
    rng = random.Random(2)
    bodies = [t for _, t in licenses.TEMPLATES]
    filler = "the of and software provided license copyright notice without any this".split()
    table = [(i, " ".join([*rng.choices(filler, k=rng.randint(0, 300)), rng.choice(bodies), *rng.choices(filler, k=40)]), "x") for i in range(60)]
    table += [(100, None, "x"), (101, "", "x"), (102, "CC BY NC cc-by-nc, under the MIT license", "x"), (102, "CC BY NC cc-by-nc, under the MIT license", "x"), (None, bodies[0], "x")]
    spark.createDataFrame(table, "doc_id long, text string, labels string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    out = licenses.op8_licenses(spark, str(tmp_path))
    expected = con.sql(f"select {', '.join(out.columns)} from ({licenses.OP8_SQL})").fetchall()
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)


def test_scratch_tables_go(spark):
    before = common.made()
    first, last = (common.written(spark.range(5), x) for x in ("a", "b"))
    common.drop_scratch(spark, since=before, keep=1)
    assert last.count() == 5 and common.made() == before + 1
    with pytest.raises(Exception, match="(?i)not.*exist|FileNotFound"):
        first.count()


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 11))
    assert quality.MOST_LANGUAGES > 7000 and KIND
