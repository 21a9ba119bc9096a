"""Operator 3: a quality classifier by an interpolated modified Kneser-Ney word model of trusted text.

Every word stands for itself: a language's frequent ones have short codes, any other its 48-bit hash. Trigrams are counted over all trusted
text and all are kept. They lie in shards by their middle word, which tell bigrams and contexts; a frequent middle word has several
shards, by last words. Documents' trigrams are dealt to the same shards, joined there and return as sums. How many words precede a word is
summed over all shards and goes back to those that have the word; documents ask for their rare words in the shard of the word, as a
rare word's own share is a factor of its probability where the bigram is unknown. Only frequent words, frequent middle words as contexts and discounts are
broadcast. A document is rejected above a perplexity quantile of its own language, taken over trusted documents that were not counted.
"""

from __future__ import annotations

import functools
import pickle
import struct
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, lean, lean_disk, written

#: Trusted documents that tell a language's frequent words, and how many words have short codes, by language and of all together (but LEAST_DOCS
#: and LEAST_WORDS of each). Results do not depend on these.
VOCABULARY_DOCS, ALL_DOCS, LEAST_DOCS = 5_000, 1 << 20, 50
MOST_WORDS, ALL_WORDS, LEAST_WORDS = (1 << 16) - 2, 1 << 17, 256
#: As many languages have models of their own as keys have room for; the last may be a pool of the others.
MOST_LANGUAGES = (1 << 15) - 1
#: One trusted document in HELD_OUT is not counted and sets the threshold; languages of under FEW are parted by rank, not by hash.
HELD_OUT, FEW = 8, 400
QUANTILE = 0.998
#: A language with fewer documents that were not counted takes the quantile of all languages' deviations from their means.
OWN_QUANTILE = 500
#: The cross-entropy of a document is drawn to its language's mean as if so many more words had it, as short texts vary.
PRIOR_WORDS = 12
CACHE = 25_000
#: Words whose n-grams a task holds at once.
BLOCK_WORDS = 1 << 19
#: A shard has about so many of the documents' words or fewer; a sample of so many documents tells which words are frequent.
SHARD_WORDS, BALANCE_DOCS = 1 << 26, 5_000
#: Documents are scored in rounds, by a hash, of about so many bytes of text and at most so many rounds, so that not all of their trigrams lie on disk at once.
ROUND_BYTES, MOST_ROUNDS = 1 << 24, 4
#: Trusted ids are broadcast up to so many (8 bytes each), and joined by a shuffle beyond.
BROADCAST_IDS = 1 << 18
#: A word's key is its language and, in BITS, its code: START, a frequent word's rank, or, from RARE on, a hash.
BITS, RARE = 48, 1 << 16
MASK = (1 << BITS) - 1
START = 0
#: Among two-byte codes, what says that a hash follows, in HASH_PARTS parts of PART_BITS, none of which looks like it.
ESCAPE, HASH_PARTS, PART_BITS = 0xFFFF, 4, 12
#: The code of all words that no trusted text has, where documents are dealt.
NEW = 0xFFFF
#: A sieve that tells these takes so many bits a rare word, and at most as many as SIEVE; what it lets through costs room but changes nothing.
SIEVE_BITS, SIEVE = 10, 1 << 29
#: Bits of a word's number among those of a block.
LOCAL = 20
LOCAL_MASK = (1 << LOCAL) - 1


def rare(word: str) -> int:
    """The code of a word without a short one."""
    return max(RARE, xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) & MASK)


_frequent_code, _rare_code = struct.Struct("<H").pack, struct.Struct("<5H").pack


def spelled(code: int) -> bytes:
    """A code as it stands in TOKENS."""
    if code < ESCAPE:
        return _frequent_code(code)
    return _rare_code(ESCAPE, code & 0xFFF, code >> 12 & 0xFFF, code >> 24 & 0xFFF, code >> 36)


class _Ids(dict):
    """A language's words as they stand in TOKENS: frequent ones, and others as they come, of which at most CACHE are kept."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__((w, spelled(i)) for w, i in vocabulary.items())
        self.others: list[str] = []

    def __missing__(self, word: str) -> bytes:
        if len(self.others) >= CACHE:
            for other in self.others:
                del self[other]
            self.others.clear()
        self.others.append(word)
        self[word] = i = spelled(rare(word))
        return i


#: ids are codes of two bytes each, and hashes behind ESCAPE.
TOKENS = "doc_id long, mark long, lang int, ids binary"
Reader = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _tokens(held):
    """Documents (doc_id, mark, lang, text) as TOKENS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, vocabularies = pickle.loads(held.value)
        ids = []
        while vocabularies:
            ids.append(_Ids(vocabularies.pop(0)))
        for batch in batches:
            langs = [number.get(x, -1) for x in batch.column("lang").to_pylist()]
            out = []
            for text, lang in zip(batch.column("text"), langs, strict=True):
                parts = (text.as_py() or "").split() if lang >= 0 else ()
                out.append(b"".join(map(ids[lang].__getitem__, parts)) if lang >= 0 else b"")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(langs, pa.int32()), pa.array(out, pa.binary())], ["doc_id", "mark", "lang", "ids"])

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(model, word, c) of texts (model, text)."""
    for batch in batches:
        counts = Counter((model, w) for model, text in zip(batch.column("model").to_pylist(), batch.column("text").to_pylist(), strict=True) for w in (text or "").split())
        columns = [[k[0] for k in counts], [k[1] for k in counts], list(counts.values())]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.int32(), pa.string(), pa.int64()), strict=True)], ["model", "word", "c"])


def _words(langs: np.ndarray, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all words of documents, one after another, and each document's number of words."""
    units = np.fromiter((len(x) // 2 for x in ids), "i8", len(ids))
    flat = np.frombuffer(b"".join(ids), "<u2")
    hashed = np.flatnonzero(flat == ESCAPE)
    own = np.ones(len(flat), bool)
    code = flat.astype("i8")
    code[hashed] = 0
    for i in range(HASH_PARTS):
        own[hashed + 1 + i] = False
        code[hashed] |= code[hashed + 1 + i] << PART_BITS * i
    lens = np.diff(np.concatenate([[0], np.cumsum(own)])[np.concatenate([[0], np.cumsum(units)])])
    return np.repeat(langs.astype("i8"), lens) << BITS | code[own], lens


def _trigrams(flat: np.ndarray, lens: np.ndarray, sieve: "Sieve | None" = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of what _words() says, piece by piece of at most BLOCK_WORDS words: sorted word keys, packed (v, u, w) of every word w and the two
    before it as numbers of these keys, and the place of its document. Words that a sieve lacks are NEW."""
    row = np.repeat(np.arange(len(lens), dtype="u4"), lens)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    for at in range(0, len(flat), BLOCK_WORDS):
        end, before = min(at + BLOCK_WORDS, len(flat)), min(at, 2)
        starts = np.unique(flat[at:end] >> BITS) << BITS | START
        keys, number = np.unique(np.concatenate([starts, flat[at - before : end]]), return_inverse=True)
        if sieve is not None:
            keys, again = np.unique(np.where((keys & MASK < RARE) | sieve.has(keys), keys, keys >> BITS << BITS | NEW), return_inverse=True)
            number = again[number]
        start = np.searchsorted(keys, flat[at:end] >> BITS << BITS | START)
        number = np.concatenate([np.zeros(2 - before, "i8"), number[len(starts) :]])
        v = np.where(place[at:end] >= 1, number[1:-1], start)
        u = np.where(place[at:end] >= 2, number[:-2], start)
        yield keys, (v << LOCAL | u) << LOCAL | number[2:], row[at:end]


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about BLOCK_WORDS codes."""
    words = np.cumsum(pc.binary_length(batch.column("ids")).to_numpy(zero_copy_only=False) // 2)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(words, (words[at - 1] if at else 0) + BLOCK_WORDS, "right")))
        yield batch.slice(at, end - at)
        at = end


def _squeeze(*columns: np.ndarray) -> bytes:
    """Arrays of one length, byte plane by byte plane, compressed."""
    planes = b"".join(x.view("u1").reshape(len(x), x.itemsize).T.tobytes() for x in columns)
    return len(columns[0]).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _expand(packed: bytes, *kinds: str) -> list[np.ndarray]:
    n, widths = int.from_bytes(packed[:8], "little"), [np.dtype(k).itemsize for k in kinds]
    if not n:
        return [np.zeros(0, k) for k in kinds]
    planes = np.frombuffer(pa.Codec("zstd").decompress(packed[8:], n * sum(widths), asbytes=True), "u1")
    parts = np.split(planes, np.cumsum(widths)[:-1] * n)
    return [np.ascontiguousarray(x.reshape(w, n).T).view(k).reshape(n) for x, w, k in zip(parts, widths, kinds, strict=True)]




def _discounts(counts: np.ndarray) -> np.ndarray:
    """The modified Kneser-Ney discounts of counts 1, 2 and more, from rows of how many n-grams have counts 1 to 4."""
    n = counts.astype("f8")
    y = np.where((n[:, 0] > 0) & (n[:, 1] > 0), n[:, 0] / np.maximum(n[:, 0] + 2 * n[:, 1], 1), 0.5)
    out = [np.where(n[:, k - 1] > 0, np.clip(k - (k + 1) * y * n[:, k] / np.maximum(n[:, k - 1], 1), 0.1, k * 0.95), k * 0.5) for k in (1, 2, 3)]
    return np.stack(out, axis=1)


def _find(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, lacking: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(asked), lacking)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], lacking)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)


def _contexts(keys: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """(context, sum, n-grams of count 1, of 2, of more) of n-grams' contexts."""
    return _summed(keys, c, *((x).astype("i8") for x in (c == 1, c == 2, c > 2)))


class Shards:
    """Where a trigram lies: by language and middle word, and of frequent middle words by the last word, too."""

    def __init__(self, number: int, frequent: dict[int, float]):
        """frequent: shares of all words that (language, word) keys have."""
        self.number = number
        parts = {k: min(number, int(2 * share * number) + 1) for k, share in frequent.items() if 2 * share * number >= 1}
        self.hot = np.array(sorted(parts), "i8")
        self.parts = np.array([parts[k] for k in self.hot.tolist()], "i8")

    @staticmethod
    def _mixed(x: np.ndarray) -> np.ndarray:
        x = (x.astype("u8") + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype("i8")

    def parts_of(self, middle: np.ndarray) -> np.ndarray:
        """How many shards (language, word) keys have as middle words."""
        return _find(self.hot, self.parts, middle, 1).astype("i8")

    def first(self, middle: np.ndarray) -> np.ndarray:
        return self._mixed(middle) % self.number

    def cut(self, keys: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """(order, (shard, start, end) of every shard met): trigrams of numbered keys sorted by shard, then value."""
        order = np.argsort(grams, kind="stable")
        v, w = grams[order] >> 2 * LOCAL, grams[order] & LOCAL_MASK
        shard, parts = self.first(keys)[v], self.parts_of(keys)[v]
        split = np.flatnonzero(parts > 1)
        shard[split] = (shard[split] + self._mixed(keys[w[split]]) % parts[split]) % self.number
        # behind a new word only the last word counts, so any shard will do
        new = np.flatnonzero((keys & MASK == NEW)[v])
        shard[new] = np.arange(len(new)) * self.number // max(1, len(new))
        again, cuts = _cut(shard, self.number)
        return order[again], cuts


class Sieve:
    """Tells for sure of some rare words that no trusted text has them: bits by the word's lot."""

    def __init__(self, shards: Shards, lots: dict[int, bytes]):
        self.shards, parts = shards, [lots.get(i, b"\0") for i in range(shards.number)]
        self.sizes = np.array([8 * len(x) for x in parts])
        self.first, self.bits = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(parts), "u1")

    @staticmethod
    def places(words: np.ndarray, sizes: np.ndarray | int) -> list[np.ndarray]:
        return [Shards._mixed(words ^ salt) % sizes for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]

    @classmethod
    def lot(cls, words: np.ndarray, most: int) -> bytes:
        bits = np.zeros(max(1, min(len(words) * SIEVE_BITS, most) // 8) * 8, bool)
        for at in cls.places(words, len(bits)):
            bits[at] = True
        return np.packbits(bits).tobytes()

    def has(self, words: np.ndarray) -> np.ndarray:
        lot = self.shards.first(words)
        at = [self.first[lot] + x for x in self.places(words, self.sizes[lot])]
        return np.logical_and.reduce([(self.bits[x >> 3] >> (7 - (x & 7))) & 1 == 1 for x in at])


def _cut(shard: np.ndarray, number: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order, (shard, start, end) of every shard met)."""
    order = np.argsort(shard.astype("u2" if number <= 1 << 16 else "i8"), kind="stable")
    shard = shard[order]
    first = np.flatnonzero(np.diff(shard, prepend=-1))
    return order, list(zip(shard[first].tolist(), first.tolist(), np.append(first, len(shard))[1:].tolist(), strict=True))


def _grams_packed(keys: np.ndarray, v: np.ndarray, u: np.ndarray, w: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted word keys, trigrams of their numbers, sorted by v, then u, and what belongs to each."""
    head, step = _squeeze(np.diff(keys, prepend=0)), np.diff(v, prepend=-1)
    u = np.where(step == 0, np.diff(u, prepend=0), u)
    return len(head).to_bytes(8, "little") + head + _squeeze(step.astype("u4"), u.astype("u4"), w.astype("u4"), *more)


def _grams_expanded(packed: bytes, *kinds: str) -> list[np.ndarray]:
    """Keys, v, u, w and what belongs to each."""
    n = int.from_bytes(packed[:8], "little")
    v, u, w, *more = _expand(packed[8 + n :], "u4", "u4", "u4", *kinds)
    sums = u.cumsum(dtype="i8")
    start = np.maximum.accumulate(np.where(v > 0, np.arange(len(v)), 0))
    return [_expand(packed[8 : 8 + n], "i8")[0].cumsum(), v.cumsum(dtype="i8") - 1, sums - (sums - u)[start], w.astype("i8"), *more]


def _part(keys: np.ndarray, grams: np.ndarray, *more: np.ndarray) -> bytes:
    """Some of a block's trigrams, in order, with the keys they need."""
    v, u, w = grams >> 2 * LOCAL, grams >> LOCAL & LOCAL_MASK, grams & LOCAL_MASK
    met = np.zeros(len(keys), bool)
    met[v] = met[u] = met[w] = True
    number = np.cumsum(met) - 1
    return _grams_packed(keys[met], number[v], number[u], number[w], *more)


# --- counting -----------------------------------------------------------------------------------------

#: Parts of the model, packed. By shard: TRIGRAMS with their counts. By shard and key: what a shard has of the contexts SHARED by the shards of a
#: frequent word (the key), of such words as CONTEXT_WORDS, of how many words precede WORDS (the key is the shard of the word), and of
#: how many TALLIES n-grams of a language have counts 1 to 4. Sums over shards: CONTEXTS of frequent words and TOTALS of WORDS for the shards that
#: have them, UNIGRAMS for the shard of the word, FREQUENT words, and the SIEVED bits of rare ones. Of documents: DOCUMENTS' trigrams, and ASKED, their rare words.
TRIGRAMS, CONTEXTS, TOTALS, UNIGRAMS, DOCUMENTS, ASKED, SHARED, CONTEXT_WORDS, WORDS, TALLIES, FREQUENT, SIEVED = range(12)
MODEL = "shard int, kind int, part binary, key long"
LOW = (1 << 32) - 1


def _model_rows(shard: int, kind: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    """rows are (key, packed)."""
    columns = [pa.array([shard] * len(rows), pa.int32()), pa.array([kind] * len(rows), pa.int32()), pa.array([x for _, x in rows], pa.binary()), pa.array([k for k, _ in rows], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "kind", "part", "key"])


def _packed(keys: np.ndarray, *values: np.ndarray) -> bytes:
    """Sorted keys with their values."""
    return _squeeze(np.diff(keys, prepend=0), *(np.ascontiguousarray(x, "i8") for x in values))


def _unpacked(parts: list[bytes], columns: int) -> list[np.ndarray]:
    """The columns of several _packed() parts, behind each other."""
    found = [_expand(x, *["i8"] * columns) for x in parts]
    return [np.concatenate(x) for x in zip([np.zeros(0, "i8")] * columns, *([f[0].cumsum(), *f[1:]] for f in found), strict=True)]


def _by_key(of: np.ndarray, keys: np.ndarray, *values: np.ndarray) -> list[tuple[int, bytes]]:
    """(key, packed) of each key in of, which says where the sorted keys go."""
    order = np.argsort(of, kind="stable")
    first = np.flatnonzero(np.diff(of[order], prepend=-1)).tolist()
    return [(int(of[order[a]]), _packed(*(x[order[a:b]] for x in (keys, *values)))) for a, b in zip(first, [*first[1:], len(of)][: len(first)], strict=True)]


#: Columns of what is kept by key.
COLUMNS = {SHARED: 5, CONTEXT_WORDS: 5, TALLIES: 5}


def _counted(shards: Shards):
    """Trigram counts of token blocks, packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _blocks(whole)):
            for keys, found, _ in _trigrams(*_words(batch.column("lang").to_numpy(), batch.column("ids").to_pylist())):
                grams, c = np.unique(found, return_counts=True)
                order, cuts = shards.cut(keys, grams)
                grams, c = grams[order], c[order].astype("i8")
                columns = [pa.array([i for i, _, _ in cuts], pa.int32()), pa.array([_part(keys, grams[a:b], c[a:b]) for _, a, b in cuts], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "part"])

    return run


def _merged(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Keys, v, u, w and counts of several such."""
    keys = np.unique(np.concatenate([x[0] for x in held]))
    at = [np.searchsorted(keys, x[0]) for x in held]
    vu = np.concatenate([n[v] << 32 | n[u] for n, (_, v, u, _, _) in zip(at, held, strict=True)])
    w, c = np.concatenate([n[x[3]] for n, x in zip(at, held, strict=True)]), np.concatenate([x[4] for x in held])
    order = np.lexsort((w, vu))
    vu, w = vu[order], w[order]
    first = np.flatnonzero((np.diff(vu, prepend=-1) != 0) | (np.diff(w, prepend=-1) != 0))
    return [keys, vu[first] >> 32, vu[first] & LOW, w[first], np.add.reduceat(c[order], first)]


def _tallied(n: int, lang: np.ndarray, counts: np.ndarray) -> bytes:
    return _packed(*_summed(lang * 4 + n, *((counts == k).astype("i8") for k in (1, 2, 3, 4))))


def _built(shards: Shards):
    """The model's parts, shard by shard, from the counts dealt to it."""

    def done(shard: int, held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, v, u, w, c = _merged(held)
        yield _model_rows(shard, TRIGRAMS, [(0, _grams_packed(keys, v, u, w, c))])
        yield _model_rows(shard, TALLIES, [(0, _tallied(3, keys[v] >> BITS, c))])
        split = shards.parts_of(keys) > 1
        vu, *contexts = _contexts((v << 32 | u)[split[v]], c[split[v]])
        yield _model_rows(shard, SHARED, _by_key(keys[vu >> 32], keys[vu & LOW], *contexts))
        two, preceding = np.unique(v << 32 | w, return_counts=True)
        yield _model_rows(shard, TALLIES, [(0, _tallied(2, keys[two >> 32] >> BITS, preceding))])
        own = split[two >> 32]
        middle, *contexts = _contexts(two[own] >> 32, preceding[own].astype("i8"))
        yield _model_rows(shard, CONTEXT_WORDS, [(0, _packed(keys[middle], *contexts))])
        words, before = np.unique(two & LOW, return_counts=True)
        yield _model_rows(shard, WORDS, _by_key(shards.first(keys[words]), keys[words], before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n = -1, [], 0
        for batch in batches:
            for shard, part in zip(batch.column("shard").to_pylist(), batch.column("part"), strict=True):
                if shard != now:
                    if held:
                        yield from done(now, held)
                    now, held, n = shard, [], 0
                held.append(_grams_expanded(part.as_py(), "i8"))
                n += len(held[-1][4])
                if n > 4 * BLOCK_WORDS and len(held) > 1 and n > 2 * len(held[0][4]):
                    held = [_merged(held)]
                    n = len(held[0][4])
        if held:
            yield from done(now, held)

    return run


def _lots(shards: Shards):
    """MODEL rows of a lot of words, from what every shard says of how many words precede them."""

    def run(group: pa.Table) -> pa.Table:
        rows = [(i, *_unpacked([x], 2)) for i, x in zip(group.column("shard").to_pylist(), group.column("part").to_pylist(), strict=True)]
        words, totals = _summed(*(np.concatenate(x) for x in list(zip(*rows, strict=True))[1:]))
        lot, rare_ones, lang, none = group.column("key")[0].as_py(), (words & MASK) >= RARE, words >> BITS, np.zeros(len(words), "i8")
        out = [(i, TOTALS, _packed(own, totals[np.searchsorted(words, own)])) for i, own, _ in rows]
        out += [(lot, UNIGRAMS, _packed(words[rare_ones], totals[rare_ones])), (lot, SIEVED, Sieve.lot(words[rare_ones], SIEVE // shards.number))]
        out += [(-1, FREQUENT, _packed(words[~rare_ones], totals[~rare_ones])), (-1, TALLIES, _tallied(1, lang, totals))]
        out.append((-1, TALLIES, _packed(*_summed(lang * 4, none + 1, totals, none, none))))
        columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary()))]
        return pa.table([*columns, pa.array([0] * len(out), pa.int64())], ["shard", "kind", "part", "key"])

    return run


class Lower:
    """What is broadcast: shares of frequent words, frequent middle words as contexts, and all discounts."""

    def __init__(self, table: pa.Table, languages: int, size: int | None):
        """table: (kind, part) sums of CONTEXT_WORDS, FREQUENT and TALLIES; size is how many words there may be, None being one more than there are."""
        kind, parts = table.column("kind").to_pylist(), table.column("part").to_pylist()

        def of(k: int, columns: int) -> list[np.ndarray]:
            out = _unpacked([x for x, own in zip(parts, kind, strict=True) if own == k], columns)
            return [x[np.argsort(out[0], kind="stable")] for x in out]

        tallies, key = np.zeros((4, languages, 4), "i8"), of(TALLIES, 5)
        np.add.at(tallies, (key[0] % 4, key[0] // 4), np.stack(key[1:], axis=1))
        self.discounts = [None, *(_discounts(tallies[n]) for n in (1, 2, 3))]
        words, self.all = tallies[0, :, 0], np.maximum(tallies[0, :, 1], 1)
        of_counts = np.stack([tallies[1, :, 0], tallies[1, :, 1], words - tallies[1, :, 0] - tallies[1, :, 1]], axis=1)
        left = np.where(words > 0, (self.discounts[1] * of_counts).sum(axis=1) / self.all, 1.0)
        #: the probability of a word that was not met
        self.new = left / (words + 1 if size is None else size)
        self.words, counts = of(FREQUENT, 2)
        self.share = self.words_shares(self.words, counts)
        self.context, self.total, *counts = of(CONTEXT_WORDS, 5)
        self.back = self.backs(2, self.context >> BITS, self.total, *counts)

    def backs(self, n: int, lang: np.ndarray, total: np.ndarray, *counts: np.ndarray) -> np.ndarray:
        """What contexts of order n leave to the order below, from what _contexts() says of them."""
        return ((self.discounts[n][lang] * np.stack(counts, axis=1)).sum(axis=1) / np.maximum(total, 1)).astype("f4")

    def shares(self, n: int, lang: np.ndarray, c: np.ndarray, total: np.ndarray) -> np.ndarray:
        return ((c - self.discounts[n][lang, np.minimum(c, 3) - 1]) / np.maximum(total, 1)).astype("f4")

    def words_shares(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.shares(1, words >> BITS, counts, self.all[words >> BITS])

    def chances(self, words: np.ndarray, known: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """Probabilities of words alone, of which known have shares."""
        return _find(known, shares, words, 0.0) + self.new[words >> BITS]


class Upper:
    """A shard's trigrams and bigrams, and shares of rare words that are its own."""

    def __init__(self, lower: Lower, shards: Shards, parts: dict[int, list[tuple[int, bytes]]]):
        """parts are (at, packed) by kind; at is the word of CONTEXTS."""
        self.lower = lower
        grams = [_grams_expanded(x, "i8") for _, x in parts.get(TRIGRAMS, [])] or [[np.zeros(0, "i8")] * 5]
        shared = [(word, *_unpacked([x], 5)) for word, x in parts.get(CONTEXTS, [])]
        own, v, u, w, c = grams[0] if len(grams) == 1 else _merged(grams)
        self.keys = keys = np.unique(np.concatenate([own, [word for word, *_ in shared], *(x[1] for x in shared)]).astype("i8"))
        number = np.searchsorted(keys, own)
        v, u, w = number[v], number[u], number[w]
        split, lang, vu = shards.parts_of(keys) > 1, keys >> BITS, v << 32 | u
        contexts = list(_contexts(vu[~split[v]], c[~split[v]]))
        for word, others, *counts in shared:
            contexts = [np.concatenate(x) for x in zip(contexts, [np.searchsorted(keys, word) << 32 | np.searchsorted(keys, others), *counts], strict=True)]
        order = np.argsort(contexts[0], kind="stable")
        self.contexts, total, *counts = (x[order] for x in contexts)
        self.back = lower.backs(3, lang[self.contexts >> 32], total, *counts)
        at = np.searchsorted(self.contexts, vu)
        self.three, self.share = at << 32 | w, lower.shares(3, lang[v], c, total[at])
        self.two, preceding = np.unique(v << 32 | w, return_counts=True)
        middle, total, *counts = _contexts(self.two >> 32, preceding.astype("i8"))
        # of split words lower has the sums, of others all that there is is here
        whole = np.where(split[middle], _find(lower.context, lower.total, keys[middle], 1), total)
        self.share_two = lower.shares(2, lang[self.two >> 32], preceding, np.repeat(whole, np.diff(np.flatnonzero(np.diff(self.two >> 32, prepend=-1)), append=len(self.two))))
        self.back_two = _find(lower.context, lower.back, keys, 1.0)
        self.back_two[middle[~split[middle]]] = lower.backs(2, lang[middle], total, *counts)[~split[middle]]
        totals, rare_ones = (_summed(*_unpacked([x for _, x in parts.get(k, [])], 2)) for k in (TOTALS, UNIGRAMS))
        self.chance = lower.chances(keys, totals[0], lower.words_shares(*totals))
        self.rare, self.rare_share = rare_ones[0], lower.words_shares(*rare_ones)

    def losses(self, keys: np.ndarray, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """-ln of the probabilities of trigrams of numbered keys; of rare words, without what rare_losses() says of them."""
        lower, at = self.lower, np.full(len(keys), -1)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            at = np.where(self.keys[at] == keys, at, -1)
        v, u, own = at[v], at[u], at[w]
        absent = (v < 0) | (own < 0)
        two = _find(self.two, self.share_two, np.where(absent, -1, v << 32 | own), 0.0)
        if len(self.contexts):
            vu = np.where((v < 0) | (u < 0), -1, v << 32 | u)
            context = np.minimum(np.searchsorted(self.contexts, vu), len(self.contexts) - 1)
            met = self.contexts[context] == vu
            back, three = np.where(met, self.back[context], 1.0), _find(self.three, self.share, np.where(met & ~absent, context << 32 | own, -1), 0.0)
        else:
            back, three = 1.0, 0.0
        frequent = ((keys & MASK) < RARE)[w]
        alone = lower.chances(keys, lower.words, lower.share)[w]
        if len(self.keys):
            alone = np.where(frequent, alone, np.where(two > 0, self.chance[own], 1.0))
            low = np.where(v >= 0, self.back_two[v], 1.0)
        else:
            alone, low = np.where(frequent, alone, 1.0), 1.0
        return np.log(np.where(frequent, 1.0, alone)) - np.log(three + back * (two + low * alone))

    def rare_losses(self, words: np.ndarray) -> np.ndarray:
        return -np.log(self.lower.chances(words, self.rare, self.rare_share))


# --- scoring ------------------------------------------------------------------------------------------

#: Parts of the model by kind, then blocks (at) of documents: what of its trigrams is the shard's, and, in one of its rows, its documents.
DEALT = "shard int, kind int, at long, part binary, docs array<long>, marks array<long>, langs array<int>, lens array<long>"
SUMS = "shard int, at long, part binary, docs array<long>, marks array<long>, langs array<int>, lens array<long>"
ABOUT = ("docs", "marks", "langs", "lens")


def _dealt(kind: int, at: int, rows: list[tuple[int, bytes | None]], head: int = -1, of: tuple[list, ...] = ([], [], [], [])) -> pa.RecordBatch:
    """Rows of DEALT; that of shard head has the documents."""
    n, kinds = len(rows), (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))
    columns = [pa.array([i for i, _ in rows], pa.int32()), pa.array([kind] * n, pa.int32()), pa.array([at] * n, pa.int64()), pa.array([x for _, x in rows], pa.binary())]
    columns += [pa.array([values if i == head else None for i, _ in rows], k) for values, k in zip(of, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["shard", "kind", "at", "part", *ABOUT])


def _added(group: pa.Table) -> pa.Table:
    """(kind, key, part): the sums of what all shards have of a key."""
    kind = group.column("kind")[0].as_py()
    out = _summed(*_unpacked(group.column("part").to_pylist(), COLUMNS[kind]))
    return pa.table({"kind": pa.array([kind], pa.int32()), "key": group.column("key").slice(0, 1), "part": pa.array([_packed(*out)], pa.binary())})


def _deal_shared(shards: Shards):
    """The contexts of frequent words (key, part) to all shards of these; at is the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, part in zip(batch.column("key").to_pylist(), batch.column("part").to_pylist(), strict=True):
                word = np.array([key])
                own = (shards.first(word) + np.arange(shards.parts_of(word)[0])) % shards.number
                yield _dealt(CONTEXTS, key, [(int(i), part) for i in own])

    return run


def _deal(shards: Shards, sieve):
    """Blocks of documents dealt to shards: which trigrams stand in which of the block's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, known = TaskContext.get().partitionId(), 0, pickle.loads(sieve.value)
        for batch in (part for whole in batches for part in _blocks(whole)):
            flat, lens = _words(batch.column("lang").to_numpy(), batch.column("ids").to_pylist())
            at, head = task << 32 | number, None
            about = (*(batch.column(x).to_pylist() for x in ("doc_id", "mark", "lang")), lens.tolist())
            for keys, grams, row in _trigrams(flat, lens, known):
                order, cuts = shards.cut(keys, grams)
                asked = np.flatnonzero((keys & MASK >= RARE)[grams & LOCAL_MASK])
                words, own = keys[grams[asked] & LOCAL_MASK], row[asked]
                if head is None:
                    head = cuts[(task + number) % len(cuts)][0]
                    yield _dealt(DOCUMENTS, at, [(head, None)], head, about)
                grams, row = grams[order], row[order]
                yield _dealt(DOCUMENTS, at, [(i, _part(keys, grams[a:b], row[a:b])) for i, a, b in cuts])
                order = np.argsort(words, kind="stable")
                words, own = words[order], own[order]
                order, cuts = _cut(shards.first(words), shards.number)
                words, own = words[order], own[order]
                yield _dealt(ASKED, at, [(i, _squeeze(np.diff(words[a:b], prepend=0), own[a:b])) for i, a, b in cuts])
            if head is None:
                head = (task + number) % shards.number
                yield _dealt(DOCUMENTS, at, [(head, None)], head, about)
            number += 1

    return run


def _join(held, shards: Shards):
    """Shard by shard the model's parts, then every block's: each document's summed -ln of probabilities."""

    def part(kind: int, packed: bytes | None, upper: Upper) -> bytes | None:
        if packed is None:
            return None
        if kind == ASKED:
            steps, row = _expand(packed, "i8", "u4")
            new = steps != 0
            new[0] = True
            loss = upper.rare_losses(steps.cumsum()[new])
        else:
            keys, v, u, w, row = _grams_expanded(packed, "u4")
            new = (np.diff(v, prepend=-1) != 0) | (np.diff(u, prepend=-1) != 0) | (np.diff(w, prepend=-1) != 0)
            loss = upper.losses(keys, v[new], u[new], w[new])
        sums = np.bincount(row, loss[np.cumsum(new) - 1])
        rows = np.flatnonzero(np.bincount(row))
        return _squeeze(np.diff(rows, prepend=0).astype("u4"), sums[rows].astype("f4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = pickle.loads(held.value)
        now, parts, upper = -1, {}, None
        for batch in batches:
            shard, kind = (batch.column(x).to_numpy() for x in ("shard", "kind"))
            first = np.flatnonzero(np.diff(shard.astype("i8") * 16 + kind, prepend=-1)).tolist()
            for a, b in zip(first, [*first[1:], len(shard)], strict=True):
                if shard[a] != now:
                    now, parts, upper = shard[a], {}, None
                rows = batch.slice(a, b - a)
                if kind[a] not in (DOCUMENTS, ASKED):
                    parts.setdefault(int(kind[a]), []).extend(zip(rows.column("at").to_pylist(), rows.column("part").to_pylist(), strict=True))
                    continue
                if upper is None:
                    upper, parts = Upper(lower, shards, parts), {}
                sums = pa.array([part(int(kind[a]), x.as_py(), upper) for x in rows.column("part")], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("shard"), rows.column("at"), sums, *(rows.column(x) for x in ABOUT)], ["shard", "at", "part", *ABOUT])

    return run


def _sum(group: pa.Table) -> pa.Table:
    """A block's documents with the sums of all shards."""
    docs, marks, langs, lens = (group.column(x).combine_chunks().drop_null().flatten() for x in ABOUT)
    loss = np.zeros(len(docs))
    for _, packed in sorted(x for x in zip(group.column("shard").to_pylist(), group.column("part").to_pylist(), strict=True) if x[1] is not None):
        rows, sums = _expand(packed, "u4", "f4")
        loss[np.cumsum(rows)] += sums
    return pa.table({"doc_id": docs, "mark": marks, "lang": langs, "n": lens, "loss": pa.array(loss)})


def _then(reader: Reader | None, f: Reader) -> Reader:
    """f behind a reader, in one Python process."""
    return lean(f if reader is None else lambda batches: f(reader(batches)))


def score(
    tokens: DataFrame, train: DataFrame, shards: Shards, languages: int, size: int | None = None, readers: tuple[Reader | None, Reader | None] = (None, None), rounds: int = 1
) -> DataFrame:
    """(doc_id, mark, lang, n, loss) for every row of tokens: -ln of its words' probabilities, summed, by a model of train.

    Both are TOKENS, or what their readers make TOKENS of; size is how many different words there may be, None being one more than a language has. Blocks of documents are named by task and place, so tokens
    must come the same when a task is run again, as rows of stored tables do. All of train makes the model, and each of rounds parts of tokens is joined with all of it;
    a round's shuffle is deleted before the next one's.
    """
    spark = tokens.sparkSession
    counted = train.mapInArrow(_then(readers[1], _counted(shards)), "shard int, part binary").repartition(shards.number, "shard").sortWithinPartitions("shard")
    with lean_disk(spark):
        model = written(counted.mapInArrow(lean(_built(shards)), MODEL), "model")
        added = lambda *kinds: model.filter(F.col("kind").isin(*kinds)).groupBy("kind", "key").applyInArrow(_added, "kind int, key long, part binary")
        lots = written(model.filter(F.col("kind") == WORDS).groupBy("key").applyInArrow(_lots(shards), MODEL), "lots")
        shared = written(added(SHARED), "shared")
    sums = added(CONTEXT_WORDS, TALLIES).select("kind", "part").unionByName(lots.filter(F.col("kind").isin(FREQUENT, TALLIES)).select("kind", "part"))
    held = spark.sparkContext.broadcast(pickle.dumps(Lower(sums.toArrow(), languages, size)))
    sieve = {r["shard"]: bytes(r["part"]) for r in lots.filter(F.col("kind") == SIEVED).select("shard", "part").toLocalIterator()}
    sieve = spark.sparkContext.broadcast(pickle.dumps(Sieve(shards, sieve)))
    none = [F.lit(None).cast("array<int>" if x == "langs" else "array<long>").alias(x) for x in ABOUT]
    own = model.unionByName(lots).filter(F.col("kind").isin(TRIGRAMS, TOTALS, UNIGRAMS)).select("shard", "kind", F.lit(0).cast("long").alias("at"), "part", *none)
    own = own.unionByName(shared.mapInArrow(lean(_deal_shared(shards)), DEALT))
    scores = []
    for i in range(rounds):
        some = tokens.filter(F.pmod(F.xxhash64(F.lit("round"), "doc_id", "mark"), F.lit(rounds)) == i)
        met = own.unionByName(some.mapInArrow(_then(readers[0], _deal(shards, sieve)), DEALT)).repartition(shards.number, "shard").sortWithinPartitions("shard", "kind", "at")
        scored = met.mapInArrow(lean(_join(held, shards)), SUMS).groupBy("at").applyInArrow(_sum, "doc_id long, mark long, lang int, n long, loss double")
        with lean_disk(spark):
            scores.append(written(scored, "scores"))
    return functools.reduce(DataFrame.unionByName, scores)


def _models(counts: list[tuple[str, int, int]]) -> tuple[list[str | None], dict[str, int]]:
    """The models' languages, None being the pool, and each language's model.

    counts are (language, counted documents, held-out documents). A language has a model of its own if it has both and is
    among the largest MOST_LANGUAGES, or one less if there is a pool. All others are pooled; to a pool that lacks either, the
    smallest language with its own model is added until it has both.
    """
    ranked = sorted(counts, key=lambda x: (not (x[1] and x[2]), -x[1] - x[2], x[0]))
    own = [x for x in ranked if x[1] and x[2]][:MOST_LANGUAGES]
    if len(own) < len(ranked):
        own = own[: MOST_LANGUAGES - 1]
        while own and not all(sum(x[i] for x in ranked[len(own) :]) for i in (1, 2)):
            own.pop()
    names = [x[0] for x in own] + [None] * (len(own) < len(ranked))
    return names, {x[0]: min(i, len(own)) for i, x in enumerate(ranked)}


def _judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What classify() says, with mark, a hash of text and language by which rows of one doc_id are told apart."""
    spark = docs.sparkSession
    lang = F.coalesce("lang", F.lit(""))
    rows = docs.select("doc_id", lang.alias("lang"), "text").withColumn("mark", F.xxhash64("text", "lang"))
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    spoken = written(rows.filter(F.col("text").rlike(r"\S")).select("doc_id", "lang").join(trusted, "doc_id", "left_semi").distinct(), "spoken")
    # one in HELD_OUT of each language: by hash, or by rank where that could leave none
    sizes = spoken.groupBy("lang").agg(F.count("*").alias("size"))
    few = spoken.join(sizes.filter(F.col("size") < FEW), "lang").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")))
    many = spoken.join(sizes.filter(F.col("size") >= FEW), "lang").withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), F.col("doc_id")), F.lit(HELD_OUT)))
    by_rank = F.when((F.col("rank") - 1) % HELD_OUT == 1, 0).otherwise(1).cast("long")
    spoken = written(few.select("doc_id", "lang", by_rank.alias("fold")).unionByName(many.select("doc_id", "lang", "fold")), "folds")
    counts = spoken.groupBy("lang").agg(F.count_if(F.col("fold") > 0).alias("counted"), F.count_if(F.col("fold") == 0).alias("held")).collect()
    names, number = _models([tuple(r) for r in counts])
    size = [0] * len(names)
    for r in counts:
        size[number[r["lang"]]] += r["counted"] + r["held"]

    docs_each = max(LEAST_DOCS, ALL_DOCS // max(1, len(names))) if len(names) * VOCABULARY_DOCS > ALL_DOCS else VOCABULARY_DOCS
    share = [(x, i, int(min(1.0, docs_each / size[i]) * (1 << 30))) for x, i in number.items()]
    models = F.broadcast(spark.createDataFrame(share, "lang string, model int, below long"))
    chance = F.pmod(F.xxhash64(F.lit("fit"), F.col("doc_id")), F.lit(1 << 30))
    sample = spoken.join(models, "lang").filter(chance < F.col("below")).select("doc_id", "lang").distinct()
    texts = rows.join(F.broadcast(sample), ["doc_id", "lang"], "left_semi").join(models, "lang").select("model", "text")
    words = texts.mapInArrow(lean(_word_counts), "model int, word string, c long").groupBy("model", "word").agg(F.sum("c").alias("c"))
    most = max(LEAST_WORDS, min(MOST_WORDS, ALL_WORDS // max(1, len(names))))
    ranked = words.withColumn("rank", F.row_number().over(Window.partitionBy("model").orderBy(F.desc("c"), "word"))).filter(F.col("rank") <= most)
    vocabularies: list[dict[str, int]] = [{} for _ in names]
    for r in ranked.toLocalIterator():
        vocabularies[r["model"]][r["word"]] = START + r["rank"]
    held = spark.sparkContext.broadcast(pickle.dumps((number, vocabularies)))

    reader = _tokens(held)
    tokens = lambda some: some.select("doc_id", "mark", "lang", "text").mapInArrow(reader, TOKENS)
    n, length = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    chance = F.pmod(F.xxhash64(F.lit("balance"), F.col("mark"), F.col("doc_id")), F.lit(1 << 30))
    some = tokens(rows.filter(chance < int(min(1.0, BALANCE_DOCS / max(1, n)) * (1 << 30))))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (length or 0) // 4 // SHARD_WORDS + 1)
    shards = Shards(shards, _frequent(some, shards))
    ids = spoken.filter("fold > 0").select("doc_id", "lang")
    if ids.count() <= BROADCAST_IDS:
        train, read = rows.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi"), reader
    else:
        read = None
        train = tokens(rows).join(ids.join(models, "lang").select("doc_id", F.col("model").alias("lang")), ["doc_id", "lang"], "left_semi").select("doc_id", "mark", "lang", "ids")
    rounds = max(1, min(MOST_ROUNDS, (length or 0) // ROUND_BYTES))
    scored = score(rows, train, shards, len(names), readers=(reader, read), rounds=rounds)

    check = scored.filter("lang >= 0").join(spoken.filter("fold = 0").select("doc_id").distinct(), "doc_id", "left_semi")
    means = check.groupBy("lang").agg((F.sum("loss") / F.greatest(F.sum("n"), F.lit(1))).alias("mean"), F.count("*").alias("held"))
    means = F.broadcast(spark.createDataFrame(means.collect(), "lang int, mean double, held long"))
    entropy = (F.col("loss") + PRIOR_WORDS * F.col("mean")) / (F.col("n") + PRIOR_WORDS)
    off = check.join(means, "lang").withColumn("off", entropy - F.col("mean"))
    pooled = off.agg(F.percentile_approx("off", QUANTILE, F.lit(10_000))).first()[0]
    own = off.groupBy("lang", "mean", "held").agg(F.percentile_approx("off", QUANTILE, F.lit(10_000)).alias("own"))
    limit = F.col("mean") + F.when(F.col("held") >= OWN_QUANTILE, F.col("own")).otherwise(F.greatest("own", F.lit(pooled).cast("double")))
    limits = own.select("lang", "mean", F.exp(limit).alias("threshold")).collect()
    # one row a model, of which keys allow MOST_LANGUAGES
    limits = F.broadcast(spark.createDataFrame([(*r, names[r["lang"]]) for r in limits], "model int, mean double, threshold double, name string"))
    out = scored.join(limits, scored["lang"] == limits["model"], "left").withColumn("perplexity", F.exp(entropy))
    return out.select("doc_id", "mark", F.col("name").alias("lang"), F.col("n").alias("n_words"), "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("keep"))


def _frequent(tokens: DataFrame, shards: int) -> dict[int, float]:
    """Keys of frequent words with over a share of 1 / (2 shards) of the words of a sample; START counts for every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, grams, _ in _trigrams(*_words(batch.column("lang").to_numpy(), batch.column("ids").to_pylist())):
                found, c = np.unique(grams >> 2 * LOCAL, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words[found]), pa.array(c.astype("i8"))], ["key", "c"])

    counted = written(tokens.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")), "frequent")
    total = counted.agg(F.sum("c")).first()[0] or 1
    return {r["key"]: r["c"] / total for r in counted.filter(F.col("c") * (2 * shards) >= total).collect() if r["key"] & MASK < RARE}


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, n_words, perplexity, threshold, keep) for every row of docs (doc_id, text, lang).

    Trusted are documents that labels (doc_id, quality, toxic) call of quality 1 and not toxic. A language, null being one
    too, that has no trusted text has no model: its documents have no perplexity and stay. Every other has a model of its own, if it
    has two trusted documents, one to be counted and one to judge by; those that have one, and languages beyond MOST_LANGUAGES, share a
    pooled model and threshold, and lang is null. If all trusted text together lacks either, nothing has a threshold. A text without
    words has the mean of its language. Repeated rows have the same result each, and count as often. A null doc_id is judged like
    any other; other columns are ignored; an empty table gives no rows; texts are read whole.
    """
    return _judged(docs, labels).drop("mark")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the documents that classify() rejects, told apart by doc_id, text and language."""
    bad = _judged(docs, labels).filter("not keep").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct()
    own = F.xxhash64(docs["text"], F.coalesce(docs["lang"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id"]) & (own == bad["__mark"]), "left_anti").select(*docs.columns)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
