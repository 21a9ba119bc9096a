"""Each operator against a brute-force version on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tileframe.llm import bpe, common, language, licenses, line_dedup, mixing, quality, sharding, simhash, syncmers, topk

KIND = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, fingerprint string, slot long, mark long, n long"
WORDS = "the of and edonre ontiatth license under mit apache version 2 cc by nc Shared LINE ünder naïve".split()


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    shared = ["a line that many documents share", "Another   shared LINE of text", "short"]
    out = [(0, None), (1, ""), (2, " \n\t"), (3, "x"), (4, "under the MIT License, under the mit license"), (5, "word " * 9000), (6, "\n".join(shared)), (7, "cc-by-nc cc by nc\r\n\x0b")]
    for i in range(8, 120):
        lines = [" ".join(rng.choices(WORDS, k=rng.randint(1, 25))) for _ in range(rng.randint(1, 4))] + rng.sample(shared, rng.randint(0, 2))
        out.append((i, "\n".join(lines)))
    out += [(200 + i, out[20][1]) for i in range(30)]  # copies
    out += [(300 + i, out[21][1] + f" tail{i}") for i in range(10)]  # near copies
    return [(d, t, ["en", "fr", None][d % 3], [None, "a", "b", "c"][d % 4], len(t or ""), -1, -1, "f", -1, -1, -1) for d, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(5)


@pytest.fixture(scope="module")
def texts(rows):
    return {r[0]: r[1] for r in rows}


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def odd(spark):
    """A null key, and rows that repeat."""
    row = ("some words that stand in a line of text", "en", "a", 1, 1, 1, "f", 1, 1, 1)
    return spark.createDataFrame([(None, *row), (1, *row), (1, *row), (2, None, None, None, *row[3:])], KIND)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_sharding(docs, texts, none, odd):
    out = by_id(sharding.assign(docs, [1.0] * 40))
    assert set(out) == set(texts)
    for d, r in out.items():
        data = (texts[d] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        assert r["grown_shard"] in (r["shard"], 40)
    slots = defaultdict(list)
    for r in out.values():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.assign(none, [1.0]).count() == 0
    assert sharding.assign(odd, [1.0, 2.0]).count() == 4
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("doc_id"), [0.0])


def test_sharding_moves_few_and_follows_weights(spark):
    keys = spark.range(20_000)
    count = lambda w: dict(keys.groupBy(sharding.shard_of(F.col("id"), w).alias("s")).count().collect())
    share = count([1.0, 2.0, 0.0, 5.0])
    assert 2 not in share and all(abs(share[s] / 20_000 - w / 8) < 0.02 for s, w in ((0, 1), (1, 2), (3, 5)))
    moved = keys.select(sharding.shard_of(F.col("id"), [1.0] * 9).alias("a"), sharding.shard_of(F.col("id"), [1.0] * 10).alias("b")).filter("a <> b")
    assert moved.filter("b <> 9").count() == 0 and abs(moved.count() / 20_000 - 0.1) < 0.02


def brute_lines(texts):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for d, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held[key(line)].add(d)
    out = {}
    for d, t in texts.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 2 or min(held[key(x)]) == d]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_line_dedup(docs, texts, batches):
    out = {r["doc"]["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"] or "") for r in line_dedup.dedup_lines(docs, batches).collect()}
    assert out == brute_lines(texts)


def test_line_dedup_odd(none, odd):
    assert line_dedup.dedup_lines(none).count() == 0
    out = [(r["doc"]["doc_id"], r["n_dropped"], r["kept"]) for r in line_dedup.dedup_lines(odd).collect()]
    text = "some words that stand in a line of text"
    assert sorted(out, key=str) == sorted([(1, 0, text), (1, 0, text), (2, 0, None), (None, 1, "")], key=str)


def test_line_runs_compact_and_reopen(spark, docs, tmp_path):
    lines = common.written(line_dedup.line_keys(docs), "t")
    path = f"file://{tmp_path}/runs"
    for i in range(5):  # every batch by a store opened anew, as a later session would
        runs = line_dedup.LineRuns(spark, path, buckets=3)
        gone = runs.add(lines.filter(F.col("ord") % 5 == i))
        seen = lines.filter(F.col("ord") % 5 <= i).select("hi", "lo").distinct().count()
        assert runs.known().count() == runs.known().select("hi", "lo").distinct().count() == seen
        assert gone.count() == lines.filter(F.col("ord") % 5 == i).count() - (seen - (before if i else 0))
        before = seen
        runs.close()
    runs = line_dedup.LineRuns(spark, path)
    assert [len(x) for x in runs.levels] == [1, 0, 1] and runs.version == 5 and runs.buckets == 3
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tileframe_run_")]


def test_runs_are_read_without_shuffle_or_sort(spark, docs):
    lines = common.written(line_dedup.line_keys(docs), "t")
    runs = line_dedup.LineRuns(spark, buckets=3)
    for i in range(3):
        runs.add(lines.filter(F.col("ord") % 4 == i))
    assert [len(x) for x in runs.levels] == [1, 1]
    with runs._layout():
        for df, sorts in ((runs.fresh(lines.filter(F.col("ord") % 4 == 3)), 1), (runs.merged(runs.levels[0][0], runs.levels[1][0]), 0)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == len(runs.levels) - (not sorts)
            # the batch's own keys are shuffled and sorted, no run is
            assert (plan.count("Exchange"), len(re.findall(r"\bSort \[", plan))) == (sorts, sorts), plan
    runs.close()


def brute_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(marks):
    root = {d: d for d in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in marks:
        for b in marks:
            if a < b and (marks[a] ^ marks[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in marks}


def test_simhash(docs, texts, none, odd):
    marks = {d: brute_simhash(t) for d, t in texts.items()}
    out = by_id(simhash.near_duplicates(docs))
    assert {d: r["mark"] % 2**64 for d, r in out.items()} == marks
    assert {d: r["component_id"] for d, r in out.items()} == brute_groups(marks)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(brute_groups(marks).values())
    assert simhash.near_duplicates(none).count() == 0
    assert Counter(r["component_id"] for r in simhash.near_duplicates(odd).collect()) == Counter([None, 1, 1, 2])


def test_links_find_all_near_pairs(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(20)]
    marks = set(base)
    for m in base:
        for _ in range(8):
            marks.add(m ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ rng.choice([0, 1 << rng.randrange(64)]))
    marks = sorted(marks)
    signed = [(m - 2**64 if m >= 2**63 else m, i) for i, m in enumerate(marks)]
    got = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame(signed, "mark long, rep long")).collect()}
    assert got == {(j, i) for i in range(len(marks)) for j in range(i + 1, len(marks)) if (marks[i] ^ marks[j]).bit_count() <= 2}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 100] + [(500, 400), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in common.components(edges).collect()}
    assert all(roots[i] == (i - 1) // 100 * 100 + 1 for i in range(1, 300)) and roots[500] == roots[400] == 400 and len(roots) == 302


def test_quality(spark, docs, texts, none):
    labels = spark.createDataFrame([(d, 1, 0, "x") for d in texts if d % 2] + [(2, 0, 1, "x"), (None, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    out = by_id(quality.classify(docs, labels))
    assert set(out) == set(texts) and all(r["keep"] or r["perplexity"] > r["threshold"] for r in out.values())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d, r in out.items() if r["keep"]}
    assert quality.classify(none, labels).count() == 0
    assert all(r["keep"] and r["perplexity"] is None for r in quality.classify(docs, labels.limit(0)).collect())


def brute_model(counts, vocabulary):
    """Interpolated modified Kneser-Ney over one language's trigrams, by its textbook sums."""
    levels = [counts]
    for _ in range(2):
        below = Counter(g[1:] for g in levels[0])
        levels.insert(0, below)

    def discounts(level):
        n = [sum(c == k for c in level.values()) for k in range(5)]
        n[0] = 0
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.1), k * 0.95) if n[k] else k * 0.5 for k in (1, 2, 3)]

    ds = [discounts(x) for x in levels]

    def p(gram):
        if not gram:
            return 1 / vocabulary
        level, d = levels[len(gram) - 1], ds[len(gram) - 1]
        own = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        total = sum(own.values())
        cut = lambda c: d[min(c, 3) - 1]
        c = own.get(gram, 0)
        return ((c - cut(c)) / total if c else 0) + sum(cut(x) for x in own.values()) / total * p(gram[1:])

    return p


@pytest.mark.parametrize("number, split", [(1, False), (7, False), (5, True)])
def test_quality_model_is_kneser_ney(spark, number, split):
    rng = random.Random(1)
    ids = [np.array(rng.choices(range(500, 512), [2 ** (i / 2) for i in range(12)], k=40), "u2") for _ in range(20)]
    counts = {lang: Counter() for lang in (0, 1)}
    grams = lambda x: zip([0, 0, *map(int, x)], [0, *map(int, x)], map(int, x), strict=False)
    for i, x in enumerate(ids):
        counts[i % 2].update(grams(x))
    rows = lambda own: common.written(spark.createDataFrame(own, quality.TOKENS).repartition(3), "t")
    train = rows([(i, i, i % 2, bytearray(x.tobytes())) for i, x in enumerate(ids)])
    asked = [*ids[:3], np.array([500, 999, 500, 511, 3], "u2"), np.zeros(0, "u2"), np.array([511] * 50, "u2")]
    tokens = rows([(i, -i, i % 2, bytearray(x.tobytes())) for i, x in enumerate(asked)] + [(None, 7, -1, bytearray())])
    # every middle word split over several shards, or none
    shards = quality.Shards(number, {lang << quality.BITS | v: 0.4 for lang in (0, 1) for v in (0, *range(500, 512))} if split else {})
    assert (shards.parts_of(np.array([500, 1 << quality.BITS | 511])) > 1).all() == split
    out = {r["doc_id"]: r for r in quality.score(tokens, train, shards, 2, 1000).collect()}
    assert len(out) == len(asked) + 1 and out[None]["lang"] == -1 and out[None]["n"] == 0 and out[None]["mark"] == 7
    for i, x in enumerate(asked):
        p = brute_model(counts[i % 2], 1000)
        assert out[i]["n"] == len(x) and out[i]["mark"] == -i
        assert math.isclose(out[i]["loss"], -sum(math.log(p(g)) for g in grams(x)), rel_tol=1e-4, abs_tol=1e-9)


def test_syncmers(docs, texts, none, odd):
    out = by_id(syncmers.fingerprints(docs))
    order = sorted(texts, reverse=True)
    for d, after in zip(order, order[1:] + order[:1], strict=True):
        text, nxt = texts[d] or "", texts[after] or ""
        half = len(text) // 2
        assert out[d]["edited"] == text[: len(text) - half] + nxt[:half] and out[d]["n_chars"] == len(text)
        assert out[d]["next_found"] == out[after]["found"]
    assert out[200]["found"] == out[201]["found"] == out[20]["found"]
    assert syncmers.fingerprints(none).collect() == []
    line, half = "some words that stand in a line of text", 19
    edited = [(1, line[:20] + line[:half]), (1, line[:20] + line[:half]), (2, ""), (None, line[:20])]
    assert sorted(((r["doc_id"], r["edited"]) for r in syncmers.fingerprints(odd).collect()), key=str) == sorted(edited, key=str)


def test_neighbours_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", 7)
    rows = spark.createDataFrame([(i * i, f"t{i}") for i in range(100)], "k long, t string").repartition(3)
    for steps in (256, 4):
        monkeypatch.setattr(syncmers, "STEPS", steps)
        got = {r["k"]: r["next"]["t"] for r in syncmers.neighbours(rows, "k", ["t"], "t").collect()}
        assert got == {i * i: f"t{(i - 1) % 100}" for i in range(100)}
    nulls = rows.union(spark.createDataFrame([(None, f"n{i}") for i in range(60)], "k long, t string")).withColumn("h", F.xxhash64("t"))
    got = {r["t"]: r["next"]["t"] for r in syncmers.neighbours(nulls, "k", ["t"], "t").collect()}
    order = [f"t{i}" for i in reversed(range(100))] + [r["t"] for r in nulls.filter("k is null").orderBy(F.desc("h")).collect()]
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_syncmers_are_closed_and_context_free(spark):
    words = [f"w{random.Random(i).randrange(50)}" for i in range(200)]
    row = spark.createDataFrame([(" ".join(words), "new start " + " ".join(words[:100]) + " end")], "a string, b string")
    m = F.transform(F.sequence(F.lit(0), F.lit(len(words) - 2)), lambda i: F.xxhash64(F.split("a", " ")[i], F.split("a", " ")[i + 1]))
    r = row.select(syncmers.anchors(F.col("a")).alias("own"), m.alias("m"), syncmers.matches(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))).alias("both")).first()
    closed = [i for i in range(len(words) - 4) if min(r["m"][i], r["m"][i + 3]) <= min(r["m"][i + 1 : i + 3])]
    assert [x["pos"] for x in r["own"]] == closed
    shared = [x["pos"] for x in r["own"] if x["pos"] + 5 <= 100]
    place = lambda found, m: next(x["pos"] for x in found if x["mark"] == m)
    other = row.select(syncmers.anchors(F.col("b")).alias("x")).first()["x"]
    both = {x["mark"] for x in r["own"]} & {x["mark"] for x in other}
    assert [(x["a"], x["b"]) for x in r["both"]] == sorted((place(r["own"], m), place(other, m)) for m in both)
    assert len(shared) > 20 and {x["mark"] for x in r["own"] if x["pos"] in shared} <= both
    got = row.select(syncmers.in_step(syncmers.matches(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b")))).alias("x")).first()["x"]
    assert got > 0.9


def test_syncmers_of_text_without_spaces(spark):
    rng = random.Random(9)
    run = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(6000))
    cases = [run, "中" + run, run[:3000] + "文" + run[3000:], " ".join(["word"] * 30) + " " + run]
    out = spark.createDataFrame([(run, x) for x in cases], "a string, b string").select(syncmers.likeness(*(syncmers.distinct_marks(syncmers.anchors(F.col(c))) for c in "ab")).alias("x"))
    assert all(r["x"] > 0.95 for r in out.collect())


def test_syncmer_query_is_what_the_marks_say(spark, docs, texts, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = by_id(syncmers.op4_syncmers(spark, str(tmp_path)))
    own = {r["doc_id"]: [x["mark"] for x in r["x"]] for r in docs.select("doc_id", syncmers.anchors(F.coalesce("text", F.lit(""))).alias("x")).collect()}
    dice = lambda a, b: 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b))) if a or b else 1.0
    text = lambda marks: "".join(f"{m & 0xFFFFFFFF:08x}" for m in dict.fromkeys(marks))
    order = sorted(texts, reverse=True)
    for d, after in zip(order, order[1:] + order[:1], strict=True):
        r, t, nxt = out[d], texts[d] or "", texts[after] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(t)
        assert r["fingerprint"] == text(own[d]) and r["near_next"] == pytest.approx(dice(own[d], own[after]))
        marks = [int(r["edited_fingerprint"][i : i + 8], 16) for i in range(0, len(r["edited_fingerprint"]), 8)]
        assert r["near_edited"] == pytest.approx(dice([m & 0xFFFFFFFF for m in own[d]], marks))


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.word_bpe())


def test_bpe(docs, texts, none, odd, library):
    out = bpe.encode(docs, bpe.word_bpe())
    for r in out.collect():
        ids = library.encode(texts[r["doc"]["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(none, bpe.word_bpe()).count() == 0 and bpe.encode(odd, bpe.word_bpe()).count() == 4


def test_bpe_on_odd_text(library):
    import json

    with open(bpe.word_bpe()) as f:
        own = bpe.Bpe(json.load(f))
    rng = random.Random(5)
    alpha = "abcABC'’ éÉßΣσ12٣ \n\t\x0b\x1c​!?<|>-_#日本́̈İıſK\x85　"
    pool = ["<|endoftext|>x<|startoftext|>", "'s<|EndOfText|>'LL", "aaaaaaa lalala", *("".join(rng.choices(alpha, k=rng.randint(1, 50))) for _ in range(1500))]
    for text, (ids, decoded) in zip(pool, own.encode(pool), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<i4").tolist() == expected
        assert decoded == own.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_mixing(docs, texts, none, odd):
    out = mixing.mix(docs)
    got = by_id(out)
    sources = defaultdict(int)
    for d, r in got.items():
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[d] or "")) and 0 <= r["copies"] <= 3
        sources[r["source"]] += r["size"]
    assert sum({r["source"]: r["target"] for r in got.values()}.values()) == pytest.approx(sum(sources.values()))
    for source, size in sources.items():
        own = [r for r in got.values() if r["source"] == source]
        assert own[0]["source_size"] == size and own[0]["target"] <= 3 * size + 1e-6
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    assert by_id(mixing.mix(docs.repartition(3))) == got
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got.values())
    assert mixing.mix(none).count() == 0 and mixing.mix(odd).count() == 4


def test_water_fill(spark):
    rows = [("a", 10, 1.0), ("b", 100, 2.0), ("c", 5, 3.0), ("d", 1000, 1.0), ("e", 0, 2.0)]
    out = {r["source"]: r["target"] for r in mixing.water_fill(spark.createDataFrame(rows, "source string, source_size long, weight double"), 3.0).collect()}
    assert out["e"] == 0 and out["c"] == 15 and out["a"] == 30 and out["b"] == 300 and out["d"] == pytest.approx(1115 - 345)


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_templates(words, templates):
    """Labels of the templates of which a block has 0.8, every block looked at."""
    labels = set()
    for label, template in templates:
        whole = license_words(template)
        own, step = set(whole), 16
        while step < len(whole):
            step *= 2
        if any(len(own & set(words[i : i + 2 * step])) >= 0.8 * len(own) - 1e-9 for i in range(0, len(words), step)):
            labels.add(label)
    return labels


def test_licenses(docs, texts, none, odd):
    out = by_id(licenses.scan(docs))
    for d, t in texts.items():
        words = license_words(t)
        at, base = [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            at, base = at + hits, base | ({label} if hits else set())
        labels = set(base)
        labels |= brute_templates(words, licenses.TEMPLATES)
        r = out[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(at), min(at, default=None), max(at, default=None))
        assert (r["base_labels"], r["labels"]) == (",".join(sorted(base)), ",".join(sorted(labels)))
    assert licenses.scan(none).collect() == []
    assert sorted((str(r["doc_id"]), r["n_words"], r["labels"]) for r in licenses.scan(odd).collect()) == [("1", 9, ""), ("1", 9, ""), ("2", 0, ""), ("None", 9, "")]


def test_license_templates_are_found(spark):
    rng = random.Random(4)
    filler = [f"filler{i}" for i in range(500)]
    mixed = ("long", " ".join(f"w{i}x" for i in range(200)))
    templates = (*licenses.TEMPLATES, mixed)
    texts = []
    for _, t in templates:
        for at in (0, 3, 17, 100, 333):
            own = license_words(t)
            for i in rng.sample(range(len(own)), len(own) // 20):
                own[i] = rng.choice(filler)
            texts.append((len(texts), " ".join([*rng.choices(filler, k=at), *own, *rng.choices(filler, k=50)])))
            texts.append((len(texts), " ".join([*own[: len(own) // 2], *rng.choices(filler, k=at)])))
    out = by_id(licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), templates=templates))
    for d, t in texts:
        base = {x for x in out[d]["base_labels"].split(",") if x}
        assert set(out[d]["labels"].split(",")) - {""} == base | brute_templates(license_words(t), templates)
    assert all(label in out[10 * i + 2 * j]["labels"].split(",") for i, (label, _) in enumerate(templates) for j in range(5))


def test_language(spark, none):
    rng = random.Random(2)
    kinds = {"xx": "ka ko ku ki".split(), "yy": "sta stre sti sto".split(), "zz": "éa èo çi ñu".split()}
    make = lambda lang: " ".join("".join(rng.choices(kinds[lang], k=3)) for _ in range(30))
    train = [(i, make(lang), lang, i) for i, lang in enumerate(list(kinds) * 40)]
    models = language.fit(spark.createDataFrame(train, "doc_id long, text string, lang string, mark long"))
    ask = [(i, make(lang), lang) for i, lang in enumerate(list(kinds) * 10)]
    out = by_id(language.identify(spark.createDataFrame(ask, "doc_id long, text string, lang string"), models))
    assert all(out[i]["lang_pred"] == lang and out[i]["score"] > 0.9 for i, _, lang in ask)
    odd = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (3, "12 !?", "q"), (None, "kakoku", "q")], "doc_id long, text string, score string")
    got = by_id(language.identify(odd, models))
    assert [got[i]["lang_pred"] for i in (1, 2, 3, None)] == ["und", "und", "und", "xx"]
    assert language.identify(none, models).count() == 0
    assert language.fit(none).names == []


@pytest.mark.parametrize("small", [False, True])
def test_topk(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
        monkeypatch.setattr(topk, "LEAF_ROWS", 4)
        monkeypatch.setattr(topk, "CHUNK", 2)
    rng = np.random.default_rng(4)
    base = rng.normal(0, 1, (300, 6)).round(2)
    base[100:200] = base[0]  # a common vector
    table = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    odd = [(1000, None), (1020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1040, [float("nan")] * 6), (1060, [float("inf")] * 6), (None, [1.0] * 6), (1080, [0.5, 0.5]), (1100, []), (5, table[5][1])]
    frame = spark.createDataFrame([*table, *odd], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.top_k(topk.quantised(frame)).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    q = np.floor(64 * base).astype("i8")
    for i in range(0, 300, 20):
        scores = sorted((-int(q[i] @ q[j]), j) for j in range(300) if j != i)[:20]
        assert got.pop(i) == [(j, -s) for s, j in scores]
    assert not got
    assert topk.top_k(topk.quantised(frame.limit(0))).count() == 0


def test_digests(docs, texts, library):
    encoded = bpe.encode(docs.select("doc_id", "text"), bpe.word_bpe())
    for r in encoded.select("doc.doc_id", *bpe.digests(encoded)).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
