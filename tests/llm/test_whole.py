"""Cases in which an operator once did less than the whole job."""

import json
import math
import random
import time
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from test_operators import brute_model, lower

from tileframe.llm import bpe, common, quality, simhash, topk


def shingle_set(text):
    words = lower(text).split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_similar(texts):
    sets, root = {d: shingle_set(t) for d, t in texts.items()}, {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            union = len(sets[a] | sets[b])
            if a < b and (not union or 5 * len(sets[a] & sets[b]) >= 4 * union):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in sets}


def near_copies():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts = {0: None, 1: " ", 2: "only three words", 3: "only  THREE words", 4: "only three others"}
    for base in range(100, 1300, 100):
        text = rng.choices(words, k=rng.choice([60, 120, 300]))
        texts[base] = " ".join(text)
        for i in range(1, 8):  # some from the first, some from the one before, so that chains arise
            text = text if i % 2 else texts[base].split()
            text = list(text)
            for _ in range(rng.randint(1, 1 + len(text) // 60)):
                text[rng.randrange(len(text))] = rng.choice(words)
            texts[base + i] = " ".join(text)
    return texts


def test_pipeline_dedups_at_jaccard_08(spark, monkeypatch):
    texts = near_copies()
    docs = spark.createDataFrame([(d, t, "en", "a", len(t or "")) for d, t in texts.items()] + [(None, "only three words", "en", "a", 16)], "doc_id long, text string, lang string, source string, n_chars long")
    groups = brute_similar(texts)
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == set(groups.values()) | {None}
    monkeypatch.setattr(simhash, "PART_SETS", 2)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(docs).collect()}
    assert got.pop(None) is None and got == groups


def test_topk_of_a_large_length_beside_many(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "FAN", 4)
    base = np.random.default_rng(6).normal(0, 1, (300, 6)).round(2)
    table = [(i, [float(x) for x in v]) for i, v in enumerate(base)] + [(1001 + i, [1.0] * (7 + i)) for i in range(6)]
    got = defaultdict(list)
    for r in topk.top_k(topk.quantised(spark.createDataFrame(table, "vec_id long, embedding array<double>"))).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    q = np.floor(64 * base).astype("i8")
    for i in range(0, 300, 20):
        scores = sorted((-int(q[i] @ q[j]), j) for j in range(300) if j != i)[:20]
        assert got.pop(i) == [(j, -s) for s, j in scores]
    assert not got


@pytest.mark.parametrize("bound", [{"MOST_LANGUAGES": 2}, {"VOCABULARY_DOCS": 20}, {}])
def test_quality_judges_every_trusted_language(spark, monkeypatch, bound):
    for k, v in bound.items():
        monkeypatch.setattr(quality, k, v)
    rng, rows, labels = random.Random(8), [], []
    for lang, n in (("en", 300), ("fr", 100), ("de", 60), ("nl", 40), ("rare", 1)):
        words = [f"{lang}{chr(97 + i)}" for i in range(20)]
        for i in range(n + 1):
            text = rng.choices(words, k=80) if i < n else [f"{rng.random()}@#{j}" for j in range(80)]
            rows.append((len(rows), " ".join(text), lang))
            labels.append((len(labels), int(i < n), 0))
    rows.append((len(rows), "a text of a language without trusted text", "none"))
    out = {r["doc_id"]: r for r in quality.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(out[d]["perplexity"] is not None and out[d]["threshold"] is not None for d, _, _ in labels)
    assert not any(out[d]["keep"] for d, good, _ in labels if not good)
    assert out[len(labels)]["keep"] and out[len(labels)]["threshold"] is None


def test_forty_languages_lose_their_junk_and_keep_the_rest(spark, tmp_path):
    rng, rows, labels = random.Random(9), [], []
    for lang in range(40):
        words = [f"l{lang}{chr(97 + i)}" for i in range(20)]
        for i in range(31):
            text = rng.choices(words, k=rng.randint(40, 90)) if i < 30 else [f"{rng.random()}@#{j}" for j in range(80)]
            rows.append((len(rows), " ".join(text), f"lang{lang}", "x", 1.0))
            labels.append((len(labels), int(i < 30), 0))
    rows += [rows[0], (None, rows[30][1], "lang0", "x", 1.0), (None, rows[1][1], "lang0", "x", 1.0), (2000, None, "lang1", "x", 1.0), (2001, "", None, "x", 1.0), (rows[30][0], rows[2][1], "lang0", "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, keep string, perplexity double")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = quality.op3_quality(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) and {r["lang"] for r in out} == {f"lang{i}" for i in range(40)} | {None}
    goes = {(d, t) for d, t, *_ in rows if t and "@#" in t}
    kept = quality.keep_good(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert kept.columns == docs.columns
    left = [tuple(r) for r in kept.collect()]
    # a junk text goes and the good text that shares its doc_id stays
    assert not {r[:2] for r in left} & goes and (rows[30][0], rows[2][1]) in {r[:2] for r in left}
    assert len(left) >= len(rows) - len(goes) - 3 and left.count(rows[0]) == 2
    assert all((r["perplexity"] <= r["threshold"]) == r["keep"] for r in out if r["threshold"] is not None)


def test_models_pool_what_cannot_stand_alone(monkeypatch):
    monkeypatch.setattr(quality, "MOST_LANGUAGES", 3)
    assert quality._models([("a", 9, 1), ("b", 8, 1), ("c", 7, 1)]) == (["a", "b", "c"], {"a": 0, "b": 1, "c": 2})
    assert quality._models([("a", 9, 1), ("b", 8, 1), ("c", 7, 1), ("d", 2, 1)]) == (["a", "b", None], {"a": 0, "b": 1, "c": 2, "d": 2})
    assert quality._models([("a", 9, 1), ("b", 8, 1), ("x", 1, 0)]) == (["a", None], {"a": 0, "b": 1, "x": 1})
    assert quality._models([("x", 1, 0)]) == ([None], {"x": 0}) and quality._models([]) == ([], {})


@pytest.mark.parametrize("number, split", [(1, False), (7, False), (5, True)])
def test_quality_model_keeps_every_rare_word(spark, number, split):
    rng = random.Random(2)
    codes = [*range(500, 506), *(quality.rare(f"rare{i}") for i in range(30))]
    assert min(codes[6:]) >= quality.RARE and len(set(codes)) == 36
    ids = [rng.choices(codes, [2 ** (i / 4) for i in range(36)], k=60) for _ in range(20)]
    counts = {lang: Counter() for lang in (0, 1)}
    grams = lambda x: zip([0, 0, *x], [0, *x], x, strict=False)
    for i, x in enumerate(ids):
        counts[i % 2].update(grams(x))
    spell = lambda x: bytearray(b"".join(map(quality.spelled, x)))
    rows = lambda own: common.written(spark.createDataFrame(own, quality.TOKENS).repartition(3), "t")
    train = rows([(i, i, i % 2, spell(x)) for i, x in enumerate(ids)])
    asked = [*ids[:3], [500, 999, quality.rare("new"), quality.rare("new"), codes[7], codes[30], 503], [], [codes[9]] * 90, rng.choices(codes, k=120)]
    shards = quality.Shards(number, {lang << quality.BITS | v: 0.4 for lang in (0, 1) for v in (0, *codes[:6])} if split else {})
    out = {r["doc_id"]: r for r in quality.score(rows([(i, -i, i % 2, spell(x)) for i, x in enumerate(asked)]), train, shards, 2, 1000).collect()}
    for i, x in enumerate(asked):
        p = brute_model(counts[i % 2], 1000)
        assert out[i]["n"] == len(x) and math.isclose(out[i]["loss"], -sum(math.log(p(g)) for g in grams(x)), rel_tol=1e-4, abs_tol=1e-9)


def test_quality_tells_words_beyond_the_frequent_apart(spark, monkeypatch):
    """2,000 words of one shape, each as frequent as the others: a text of them is likelier than one of as many words that no trusted text has."""
    rng, words = random.Random(3), [f"{a}{b}{c}xy" for a in "abcdefghijklm" for b in "abcdefghijklm" for c in "abcdefghijkl"]
    new = [w[:3] + "zw" for w in words]
    rows = [(i, " ".join(rng.choices(words, k=100)), "en") for i in range(400)] + [(400 + i, " ".join(rng.choices(new, k=100)), "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert not any(out[400 + i]["keep"] for i in range(20)) and sum(out[i]["keep"] for i in range(400)) >= 398
    monkeypatch.setattr(quality, "MOST_WORDS", 10)
    monkeypatch.setattr(quality, "LEAST_WORDS", 10)
    again = {r["doc_id"]: r["perplexity"] for r in quality.classify(docs, labels).collect()}
    assert all(math.isclose(out[d]["perplexity"], x, rel_tol=1e-5) for d, x in again.items())


def test_quality_scores_in_rounds_and_keeps_no_shuffle(spark, monkeypatch):
    rng, words = random.Random(5), [f"word{i}" for i in range(300)]
    rows = [(i if i % 50 else None, " ".join(rng.choices(words, k=i % 90)), "en" if i % 3 else None) for i in range(400)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    folders = [Path(str(x)) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    left = lambda: {p for x in folders for p in x.rglob("shuffle_*.data")}
    steps, written = [], quality.written

    def watched(df, name, *more):
        before, out = left(), written(df, name, *more)
        for _ in range(50):  # files are removed by messages
            if not left() - before:
                break
            time.sleep(0.1)
        steps.append((name, len(left() - before)))
        return out

    def judged(rounds):
        steps.clear()
        monkeypatch.setattr(quality, "MOST_ROUNDS", rounds)
        out = sorted((tuple(r) for r in quality._judged(docs, labels).select("mark", "doc_id", "n_words", "keep", "perplexity").collect()), key=str)
        return out, [x for x in steps if x[0] in ("model", "lots", "shared", "scores")]

    monkeypatch.setattr(quality, "written", watched)
    monkeypatch.setattr(quality, "ROUND_BYTES", 1)
    (one, _), (many, made) = judged(1), judged(4)
    assert len(one) == 800 and [x[:4] for x in one] == [x[:4] for x in many]
    assert all(math.isclose(a[4], b[4], rel_tol=1e-5) for a, b in zip(one, many, strict=True))
    assert made == [(x, 0) for x in ("model", "lots", "shared", *["scores"] * 4)]


def test_quality_trigrams_of_long_texts_come_in_pieces(monkeypatch):
    rng, langs = random.Random(4), np.array([0, 1, 1])
    codes = [5, 6, 7, quality.rare("a"), quality.rare("b")]
    texts = [rng.choices(codes, k=n) for n in (100, 0, 31)]
    flat, lens = quality._words(langs, [b"".join(map(quality.spelled, x)) for x in texts])
    assert lens.tolist() == [100, 0, 31]
    want = [(int(n), *(langs[n] << quality.BITS | c for c in g)) for n, x in enumerate(texts) for g in zip([0, *x], [0, 0, *x], x, strict=False)]
    for words in (1 << 19, 37, 2):
        monkeypatch.setattr(quality, "BLOCK_WORDS", words)
        got = []
        for keys, grams, row in quality._trigrams(flat, lens):
            part = quality._grams_expanded(quality._part(keys, np.sort(grams)))
            assert sorted(zip(*(part[0][x].tolist() for x in part[1:]), strict=True)) == sorted(zip(*(keys[grams >> quality.LOCAL * i & quality.LOCAL_MASK].tolist() for i in (2, 1, 0)), strict=True))
            got += zip(row.tolist(), *(keys[grams >> quality.LOCAL * i & quality.LOCAL_MASK].tolist() for i in (2, 1, 0)), strict=True)
        assert got == want


def test_pipeline_near_dedup_links_by_simhash(spark):
    """The SimHash fingerprints alone bring together what is near; only what is similar links."""
    words = [f"word{i}" for i in range(5000)]
    texts = {1: words, 2: [*words[:-1], "last"], 3: ["first", *words[1:]], 4: words[::-1], 5: ["one", "two", "three"], 6: ["one", "two", "other"]}
    docs = spark.createDataFrame([(d, " ".join(t), "en", "a", 1) for d, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    prints = {d: simhash._wide_fingerprint(simhash._set(" ".join(t).encode())[1]) for d, t in texts.items()}
    near = [(a, b) for a in texts for b in texts if a < b and ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= simhash.WIDE_DISTANCE]
    assert near == [(1, 2), (1, 3), (2, 3)] and len({prints[d] for d in texts}) > 4
    marks = [(d, simhash._set(" ".join(t).encode())[0], prints[d]) for d, t in texts.items()]
    keys = simhash._simhash_keys(common.written(spark.createDataFrame([x[1:] for x in marks], "mark long, print long"), "p")).collect()
    met = defaultdict(set)
    for r in keys:
        met[r["key"]].add(next(d for d, m, _ in marks if m == r["mark"]))
    assert {(a, b) for x in met.values() for a in x for b in x if a < b} == set(near)
    kept = {r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()}
    assert kept == {1, 4, 5, 6}


def test_bpe_looks_up_only_pairs_that_a_merge_changed(monkeypatch):
    with open(bpe.word_bpe()) as f:
        own = bpe.Bpe(json.load(f))
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 30))).encode() for _ in range(300)] + [b"aaaaaaa", b"abababab", b"a"]
    asked, rank = [], own._rank
    monkeypatch.setattr(own, "_rank", lambda left, right: asked.append(len(left)) or rank(left, right))
    ids, ends = own.merge(words)
    pairs, merges = sum(len(w) - 1 for w in words), sum(map(len, words)) - len(ids)
    assert merges > 100 and sum(asked) <= pairs + 2 * merges and ends[-1] == len(ids)
    assert [own.merge([w])[0].tolist() for w in words] == [x.tolist() for x in np.split(ids, ends[:-1])]
