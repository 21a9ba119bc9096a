"""Language models against a brute-force Kneser-Ney, rejection of unseen text, and the registered query."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tileframe.llm import language

ORDER = language.ORDER


def brute_losses(counts, alphabet):
    """-ln of a word's probability by a model of one language's word counts, by the sums of the textbook."""
    levels = [None] * (ORDER + 1)
    for n in range(ORDER, 0, -1):
        own = Counter()
        if n == ORDER:
            for w, c in counts.items():
                t = f" {w} "
                for end in range(n, len(t) + 1):
                    own[t[end - n : end]] += c
        else:
            for gram in levels[n + 1]:  # how many letters precede it
                own[gram[1:]] += 1
            for w, c in counts.items():  # nothing precedes what starts a word
                if n > 1 and len(w) + 2 >= n:
                    own[f" {w} "[:n]] += c
        levels[n] = own

    def discount(own):
        once, twice = (sum(c == k for c in own.values()) for k in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.5

    discounts = [None] + [discount(x) for x in levels[1:]]

    def p(gram):
        if not gram:
            return 1 / (alphabet + 2)
        own = {g: c for g, c in levels[len(gram)].items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        d, total = discounts[len(gram)], sum(own.values())
        share = {g: (c - min(d, c)) / total for g, c in own.items()}
        return share.get(gram, 0.0) + (1 - sum(share.values())) * p(gram[1:])

    def loss(w):
        t = f" {w} "
        return -sum(math.log(max(p(t[max(0, end - ORDER) : end]), 1e-12)) for end in range(2, len(t) + 1))

    return loss


def test_models_are_kneser_ney():
    rng = random.Random(3)
    make = lambda alpha: Counter("".join(rng.choices(alpha, k=rng.randint(1, 7))) for _ in range(60))
    counts = {"xx": make("abcde"), "yy": make("cdefgh"), "zz": Counter({"a": 3}), "none": Counter()}
    models = language.Models(counts)
    assert models.names == ["xx", "yy", "zz"]
    alphabet = len({c for own in counts.values() for w in own for c in w})
    asked = ["a", "abc", "hgf", "abcdefgh", "q", "aaaaaaaaaa", "éa", *list(counts["xx"])[:5]]
    got = models.word_losses(asked)
    for i, name in enumerate(models.names):
        loss = brute_losses(counts[name], alphabet)
        assert got[:, i] == pytest.approx([loss(w) for w in asked], rel=1e-4)
    assert got[:, -1].tolist() == [len(w) + 1 for w in asked]


def test_words_are_scored_in_blocks(monkeypatch):
    models = language.Models({"xx": Counter(["abba", "bab"]), "yy": Counter(["cc"])})
    asked = [f"a{c}b" for c in "abcdefgh"] * 3
    whole = models.word_losses(asked)
    monkeypatch.setattr(language, "CELLS", 12)
    assert (models.word_losses(asked) == whole).all()


KINDS = {"xx": "ka ko ku ki ta".split(), "yy": "sta stre sti sto nu".split(), "zz": "éa èo çi ñu ka".split()}


def make(rng, lang, low=1, high=60):
    return " ".join("".join(rng.choices(KINDS[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(low, high)))


def test_rejects_few_known_and_most_foreign_texts(spark):
    rng = random.Random(5)
    train = [(i, make(rng, lang), lang, rng.getrandbits(62)) for i, lang in enumerate(list(KINDS) * 500)]
    models = language.fit(spark.createDataFrame(train, "doc_id long, text string, lang string, mark long"))
    fresh = [make(rng, lang) for lang in list(KINDS) * 1000]
    names, _, _, rejected = models.predict(fresh)
    assert rejected.mean() < 0.004
    wrong = [x for x, lang, n in zip(fresh, list(KINDS) * 1000, names, strict=True) if n != lang and len(x) > 20]
    assert not wrong
    foreign = ["".join(rng.choices("bdfghjlmpqvwxz", k=6)) + " " + "".join(rng.choices("bdfghjlmpqvwxz", k=7)) for _ in range(200)]
    assert models.predict(foreign)[3].mean() > 0.99


def test_learns_every_language_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(language, "LEAST_BYTES", 4000)
    monkeypatch.setattr(language, "FIT_ALL", 4000)
    rng = random.Random(6)
    letters = [chr(0x4E00 + 8 * i + j) for i in range(60) for j in range(8)]
    text = lambda i, n: " ".join("".join(rng.choices(letters[8 * i : 8 * i + 8], k=3)) for _ in range(n))
    rows = [(text(i, 40_000 if i == 7 else 30), f"l{i:02d}", rng.getrandbits(62)) for i in range(60) for _ in range(1 if i == 7 else 3)]
    models = language.fit(spark.createDataFrame(rows, "text string, lang string, mark long"))
    assert len(models.names) == 60
    assert models.predict([text(i, 10) for i in range(60)])[0] == [f"l{i:02d}" for i in range(60)]


def test_query(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, make(rng, lang, 5, 40), lang, "source", 1, "x") for i, lang in enumerate(list(KINDS) * 100)]
    rows += [(1000, None, "xx", None, None, None), (1001, " 12 !?", "xx", None, None, None), (None, make(rng, "xx", 9, 10), None, None, None, None), (0, *rows[0][1:])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string").write.parquet(f"{tmp_path}/documents.parquet")
    out = language.op9_language(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) and out[0].__fields__[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in by if i is not None)
    assert (by[1000]["lang_pred"], by[1001]["lang_pred"], by[None]["lang_pred"]) == ("und", "und", "xx") and by[1000]["score"] == by[1001]["score"] == 0
    assert np.mean([by[i]["lang_pred"] == rows[i][2] for i in range(300)]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in out) and len({(r["lang_pred"], r["score"]) for r in out if r["doc_id"] == 0}) == 1
