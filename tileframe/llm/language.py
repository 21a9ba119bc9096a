"""Operator 9: language identification by interpolated Kneser-Ney character models.

Each language has a character model of order ORDER, within words that a space encloses. n-grams are 64-bit
hashes in sorted arrays that all languages share; behind each stand the languages that have it. A text has the language of the
lowest cross-entropy per character. It is marked as rejected if that is higher than texts of its length and language
show under a model that has not seen them.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, written

ORDER = 5
#: The fit takes about so many documents of each language, by hash, and of these about so many bytes of words: FIT_BYTES, or a like
#: share of FIT_ALL if languages are many, but LEAST_BYTES at least. Languages are as many as there are.
FIT_DOCS, FIT_BYTES, FIT_ALL, LEAST_BYTES = 4000, 1 << 20, 1 << 26, 1 << 16
#: The share of texts in a language it knows that identify() does not reject.
REJECT = 0.999
#: Positions times languages that are looked up at once.
CELLS = 1 << 22
TEXT_CHARS = 1 << 20
CACHE = 300_000
UNDECIDED = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(chunk: str) -> list[str]:
    """Runs of letters, in lower case."""
    low = chunk.lower()
    return [low] if low.isalpha() else "".join(c if c.isalpha() else " " for c in low).split()


def _positions(distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixed code points of words within spaces, place in word, and word number, all words in one flat array."""
    flat = np.frombuffer("".join(f" {w} " for w in distinct).encode("utf-32-le", "surrogatepass"), "u4").astype("u8")
    lens = np.fromiter((len(w) + 2 for w in distinct), "i8", len(distinct))
    owner = np.repeat(np.arange(len(distinct)), lens)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    x = (flat + np.uint64(1)) * _STEP
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9), place, owner


def _grams(x: np.ndarray) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each position, for n from 0 to ORDER."""
    out = [np.zeros_like(x)]
    for _ in range(ORDER):
        before = np.concatenate([np.zeros(1, "u8"), out[-1][:-1]])
        out.append(before * np.uint64(0xD6E8FEB86659FD93) + x)
    return out


def _count(keys: np.ndarray, context: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return distinct, context[first], np.bincount(inverse, weight, len(distinct)), first


def fit_one(counts: Counter) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 1: n-gram hashes with their discounted shares, context hashes with their back-off weights."""
    distinct = sorted(counts)
    x, place, owner = _positions(distinct)
    weight = np.array([counts[w] for w in distinct], "f8")[owner]
    grams = _grams(x)
    orders, longer = [], None
    for n in range(ORDER, 0, -1):
        if longer is None:
            at = np.flatnonzero(place >= n - 1)
            at = at[place[at] >= 1]
            w = weight[at]
        else:  # how many letters precede it; raw counts where a word starts, as nothing can
            start = np.flatnonzero((place == n - 1) & (place >= 1))
            at, w = np.concatenate([longer, start]), np.concatenate([np.ones(len(longer)), weight[start]])
        context = np.concatenate([np.zeros(1, "u8"), grams[n - 1][:-1]])[at]
        keys, contexts, c, first = _count(grams[n][at], context, w)
        longer = at[first]  # one place of each distinct n-gram: what its last n - 1 are preceded by
        once, twice = (c == 1).sum(), (c == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        held, inverse = np.unique(contexts, return_inverse=True)
        total = np.bincount(inverse, c, len(held))
        share = (c - np.minimum(discount, c)) / total[inverse]
        orders.append((keys, share, held, 1 - np.bincount(inverse, share, len(held))))
    return orders[::-1]


class Models:
    """All languages' models over shared sorted hash arrays, from their words' counts."""

    def __init__(self, counts: dict[str, Counter]):
        self.names = sorted(name for name, own in counts.items() if own)
        fits = [fit_one(counts[name]) for name in self.names]
        self.floor = 1.0 / (len({c for name in self.names for w in counts[name] for c in w}) + 2)
        #: For each order, of n-grams and then of contexts: hashes, where each one's languages begin, languages, values.
        self.tables = []
        for n in range(ORDER):
            table = []
            for part in (0, 2):
                keys = np.concatenate([f[n][part] for f in fits]) if fits else np.zeros(0, "u8")
                langs = np.repeat(np.arange(len(fits), dtype="i4"), [len(f[n][part]) for f in fits])
                values = np.concatenate([f[n][part + 1] for f in fits]).astype("f4") if fits else np.zeros(0, "f4")
                order = np.argsort(keys, kind="stable")
                distinct, first = np.unique(keys[order], return_index=True)
                table.append((distinct, np.append(first, len(keys)), langs[order], values[order]))
            self.tables.append(table)
        self.rows: dict[int, np.ndarray] = {}
        self.cache: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.names) + 1))
        #: Each language's mean cross-entropy, what it varies by (that of long texts, and more in short ones), and how many times that passes.
        self.means, self.spread, self.most = np.zeros(len(self.names)), (0.0, 0.0), np.inf

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rows": {}, "cache": {}, "scores": self.scores[:0]}

    def word_losses(self, distinct: list[str]) -> np.ndarray:
        """-ln of each word's probability in each language, and its characters with the space that ends it."""
        out, at = np.zeros((len(distinct), len(self.names) + 1)), 0
        ends = np.cumsum([len(w) + 2 for w in distinct])
        while at < len(distinct):
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + CELLS // max(1, len(self.names)), "right")))
            out[at:end] = self._word_losses(distinct[at:end])
            at = end
        return out

    def _word_losses(self, distinct: list[str]) -> np.ndarray:
        x, place, owner = _positions(distinct)
        grams = _grams(x)
        p = np.full((len(x), len(self.names)), self.floor)
        for n, (shares, back) in enumerate(self.tables, 1):
            at = np.flatnonzero(place >= max(n - 1, 1))
            context = np.concatenate([np.zeros(1, "u8"), grams[n - 1][:-1]])[at]
            p[at] = self._find(shares, grams[n][at], 0.0) + self._find(back, context, 1.0) * p[at]
        loss = np.where(place[:, None] > 0, -np.log(np.maximum(p, 1e-12)), 0.0)
        out = np.zeros((len(distinct), len(self.names) + 1))
        for i in range(len(self.names)):
            out[:, i] = np.bincount(owner, loss[:, i], len(distinct))
        out[:, -1] = np.bincount(owner, place > 0, len(distinct))
        return out

    def _find(self, table: tuple, asked: np.ndarray, lacking: float) -> np.ndarray:
        keys, first, langs, values = table
        out = np.full((len(asked), len(self.names)), lacking)
        if not len(keys):
            return out
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        if len(keys) * len(self.names) <= CELLS:  # few enough for a row of each n-gram
            if id(table) not in self.rows:
                self.rows[id(table)] = rows = np.full((len(keys), len(self.names)), lacking, "f4")
                rows[np.repeat(np.arange(len(keys)), np.diff(first)), langs] = values
            return np.where((keys[at] == asked)[:, None], self.rows[id(table)][at], lacking)
        rows = np.flatnonzero(keys[at] == asked)
        at = at[rows]
        n = first[at + 1] - first[at]
        place = np.arange(int(n.sum())) + np.repeat(first[at] - np.cumsum(n) + n, n)
        out[np.repeat(rows, n), langs[place]] = values[place]
        return out

    def losses(self, texts: list[str]) -> np.ndarray:
        """Each text's summed word_losses(); the last column is 0 without letters."""
        parts = [x.split() for x in texts]
        new = {c for own in parts for c in own if c not in self.cache}
        if len(self.cache) + len(new) > CACHE:
            self.cache, self.scores, new = {}, self.scores[:0], {c for own in parts for c in own}
        if new:
            chunks = list(new)
            own = [words(c) for c in chunks]
            distinct = list({w for ws in own for w in ws})
            number = {w: i for i, w in enumerate(distinct)}
            loss = self.word_losses(distinct) if distinct else np.zeros((0, len(self.names) + 1))
            lens = [len(ws) for ws in own]
            rows = np.zeros((len(chunks), len(self.names) + 1))
            np.add.at(rows, np.repeat(np.arange(len(chunks)), lens), loss[np.array([number[w] for ws in own for w in ws], "i8")])
            self.cache.update(zip(chunks, range(len(self.scores), len(self.scores) + len(chunks)), strict=True))
            self.scores = np.concatenate([self.scores, rows])
        lens = np.fromiter(map(len, parts), "i8", len(parts))
        flat = np.fromiter((self.cache[c] for own in parts for c in own), "i8", int(lens.sum()))
        sums = np.concatenate([np.zeros((1, self.scores.shape[1])), np.cumsum(self.scores[flat], axis=0)])
        ends = np.cumsum(lens)
        return sums[ends] - sums[ends - lens]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, cross-entropy per character, rejected) of each text."""
        if not self.names:
            n = len(texts)
            return [UNDECIDED] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
        loss = self.losses(texts)
        chars = np.round(loss[:, -1])
        known, own = chars > 0, loss[:, :-1]
        best = own.argmin(axis=1)
        least = own.min(axis=1)
        score = 1 / np.exp(np.maximum(least[:, None] - own, -700)).sum(axis=1)
        entropy = np.where(known, least / np.maximum(chars, 1), np.nan)
        names = [self.names[b] if k else UNDECIDED for b, k in zip(best, known, strict=True)]
        scale = np.sqrt(self.spread[0] + self.spread[1] / np.maximum(chars, 1))
        far = entropy - self.means[best] > self.most * scale if np.isfinite(self.most) else np.zeros(len(known), bool)
        return names, np.where(known, np.clip(score, 0, 1), 0.0), entropy, ~known | far


def _text_blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts with TEXT_CHARS characters in all, or of one that has more."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (chars == 0 or chars + len(texts[end]) <= TEXT_CHARS):
            chars += len(texts[end]) or 1
            end += 1
        yield at, end
        at = end


def _own_words(text: str) -> list[str]:
    return [w for chunk in text.split() for w in words(chunk)]


def _word_counts(below: dict[str, int]):
    """(lang, half, word, n) of texts (lang, text, mark); of a language's words those whose hash is below its bound, in 2^32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, int], Counter] = {}
            for lang, text, mark in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "mark")), strict=True):
                own = _own_words(text)
                if below[lang] < 1 << 32:
                    place = (np.arange(len(own), dtype="u8") + np.uint64(mark & (1 << 63) - 1)) * _STEP
                    place ^= place >> np.uint64(29)
                    kept = (place * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32) < below[lang]
                    own = [w for w, k in zip(own, kept.tolist(), strict=True) if k]
                counts.setdefault((lang, mark >> 7 & 1), Counter()).update(own)
            rows = [(lang, half, w, n) for (lang, half), c in counts.items() for w, n in c.items()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int32(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "half", "word", "n"])

    return run


def _unseen(held):
    """(lang, entropy, chars) of texts (lang, text, mark) in their own language, by the model of the half that lacks them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves = pickle.loads(held.value)
        for batch in batches:
            langs, entropy, chars = [], [], []
            names, texts, marks = (batch.column(c).to_pylist() for c in ("lang", "text", "mark"))
            for half, model in enumerate(halves):
                place = {name: i for i, name in enumerate(model.names)}
                own = [i for i, mark in enumerate(marks) if mark >> 7 & 1 != half and names[i] in place]
                for a, b in _text_blocks([texts[i] for i in own]):
                    for i, loss in zip(own[a:b], model.losses([texts[i] for i in own[a:b]]), strict=True):
                        if loss[-1] > 0:
                            langs.append(names[i])
                            entropy.append(loss[place[names[i]]] / loss[-1])
                            chars.append(loss[-1])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(entropy, pa.float64()), pa.array(chars, pa.float64())], ["lang", "entropy", "chars"])

    return run


def fit(docs: DataFrame) -> Models:
    """Models of every non-null lang of docs (text, lang, mark), where mark is a hash that picks the bounded sample.

    The sample's halves, by mark, are fitted alone first: each half's texts are judged by the other's model, which tells how the
    cross-entropy of unseen text varies with language and length. The models returned are of both halves.
    """
    spark = docs.sparkSession
    some = docs.filter("lang is not null and text is not null").select("lang", "text", F.coalesce("mark", F.lit(0)).cast("long").alias("mark"))
    counts = some.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    each = max(LEAST_BYTES, min(FIT_BYTES, FIT_ALL // max(1, len(counts))))
    share = {r["lang"]: min(1.0, FIT_DOCS / r["n"]) for r in counts}
    below = {r["lang"]: int(min(1.0, each / max(1.0, share[r["lang"]] * r["bytes"])) * (1 << 32)) for r in counts}
    chances = spark.createDataFrame([(k, int(v * (1 << 30))) for k, v in share.items()], "lang string, docs long")
    picked = F.pmod(F.xxhash64(F.lit("fit"), "mark"), F.lit(1 << 30)) < F.col("docs")
    texts = written(some.join(F.broadcast(chances), "lang").filter(picked).select("lang", "text", "mark"), "sample")
    found = texts.mapInArrow(_word_counts(below), "lang string, half int, word string, n long").groupBy("lang", "half", "word").agg(F.sum("n").alias("n"))
    halves: list[dict[str, Counter]] = [{}, {}]
    for lang, half, word, n in found.toLocalIterator():
        halves[half].setdefault(lang, Counter())[word] = n
    models = Models({lang: halves[0].get(lang, Counter()) + halves[1].get(lang, Counter()) for lang in share})
    held = spark.sparkContext.broadcast(pickle.dumps([Models(own) for own in halves]))
    unseen = written(texts.mapInArrow(_unseen(held), "lang string, entropy double, chars double"), "unseen")
    means = {r["lang"]: (r["mean"], r["n"]) for r in unseen.groupBy("lang").agg(F.avg("entropy").alias("mean"), F.count("*").alias("n")).collect()}
    whole = unseen.agg(F.avg("entropy")).first()[0]
    if whole is None:
        return models
    models.means = np.array([means[x][0] if x in means else whole for x in models.names])
    table = spark.createDataFrame([(k, v[0], v[1]) for k, v in means.items()], "lang string, mean double, n long")
    off = unseen.join(F.broadcast(table), "lang").withColumn("d", (F.col("entropy") - F.col("mean")) * F.sqrt(F.col("n") / F.greatest(F.col("n") - 1, F.lit(1))))
    long, short = off.agg(F.regr_intercept(F.col("d") ** 2, 1 / F.col("chars")), F.regr_slope(F.col("d") ** 2, 1 / F.col("chars"))).first()
    every = off.agg(F.avg(F.col("d") ** 2)).first()[0]
    models.spread = (long, short) if long and short and long > 0 and short > 0 else (max(every, 1e-6), 0.0)
    scale = F.sqrt(F.lit(models.spread[0]) + F.lit(models.spread[1]) / F.col("chars"))
    models.most = off.agg(F.percentile_approx(F.col("d") / scale, REJECT, F.lit(10_000))).first()[0]
    return models


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected) for every row of docs (doc_id, text).

    Text that is null or has no letter is `und` with score 0, no entropy, and rejected. Ties go to the first language by name.
    Repeated rows have the same result each, other columns are ignored, an empty table gives no rows, and texts are read whole
    in blocks of about TEXT_CHARS, or of one text if it is longer.
    """
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(held.value)
        for batch in batches:
            texts = ["" if x is None else x for x in batch.column("text").to_pylist()]
            for at, end in _text_blocks(texts):
                names, score, entropy, rejected = own.predict(texts[at:end])
                found = [pa.array(names, pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(rejected)]
                arrays = [batch.column("doc_id").slice(at, end - at), *found]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "entropy", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, entropy double, rejected boolean")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3))
    models = fit(docs.filter(fold != 1).select("text", "lang", F.xxhash64("doc_id", "text").alias("mark")))
    return identify(docs, models).select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score", "entropy", "rejected")
