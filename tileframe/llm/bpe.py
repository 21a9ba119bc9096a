"""Operator 5: BPE encoding and decoding in batched numpy merge rounds.

Works on tokenizer files of the kind of word_bpe_49k.json: NFC, white space and lower case as normalizers, a split
into word pieces, bytes as letters, and an end-of-word suffix. As no piece crosses white space, texts are
parted at white space first; the distinct chunks of a batch are encoded together and kept in a cache of bounded size.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Texts of about this many code points are encoded together; each cache generation holds so many chunks.
TEXT_CHARS = 1 << 20
CACHE = 80_000
NEVER = np.int64(2**62)

# Unicode white space, and the file format's word pieces.
WHITE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
SPLIT = regex.compile(rf"[^{WHITE}]+")
#: What str.split() takes for white space though Unicode doesn't.
ODD = regex.compile("[\\x1c-\\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 ones for themselves, the others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in own)
    moved = {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [moved.get(b) or chr(b) for b in range(256)]


class _Cache:
    """Entries of two generations: when the young one is full, it becomes the old one, and the old one goes."""

    def __init__(self):
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def known(self, keys: Iterable[str]) -> tuple[dict[str, tuple[bytes, str]], list[str]]:
        """What is held of keys, and those that are not."""
        found, missing = {}, []
        young, old = self.young.get, self.old.get
        for key in keys:
            entry = young(key) or old(key)
            if entry is None:
                missing.append(key)
            else:
                found[key] = entry
        return found, missing

    def hold(self, entries: dict[str, tuple[bytes, str]]) -> None:
        if len(self.young) + len(entries) > CACHE:
            self.old, self.young = self.young, {}
        if len(entries) <= CACHE:
            self.young.update(entries)


class Bpe:
    """A tokenizer from its file's vocabulary, merges and special tokens."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = np.empty(max([*vocab.values(), *self.special.values()]) + 1, object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], "i8")
        self.final = np.array([vocab[x + suffix] for x in letters], "i8")
        self.base = len(self.tokens)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], "i8")
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], "i8")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known_chunks, self.known_pieces = _Cache(), _Cache()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, each not empty, one after another, and where each word ends. Every round merges, in each word, its pair of lowest rank wherever it stands."""
        lens = np.fromiter(map(len, words), "i8", len(words))
        flat = np.frombuffer(b"".join(words), "u1")
        symbol = self.inner[flat]
        ends = np.cumsum(lens)
        symbol[ends - 1] = self.final[flat[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lens)
        done_symbols, done_owners = [], []
        rank = np.full(len(symbol), NEVER)  # of each symbol and the next one of its word
        changed = np.flatnonzero(owner[:-1] == owner[1:])
        while len(symbol):
            rank[changed] = self._rank(symbol[changed], symbol[changed + 1])
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            best = np.repeat(best, np.diff(starts, append=len(symbol)))
            open_ = best < NEVER
            done_symbols.append(symbol[~open_])
            done_owners.append(owner[~open_])
            symbol, owner, rank, best = symbol[open_], owner[open_], rank[open_], best[open_]
            hit = np.flatnonzero(rank == best)
            if not len(hit):
                break
            # of neighbouring hits, which overlap, every other one from the left
            runs = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            hit = hit[(np.arange(len(hit)) - np.repeat(runs, np.diff(runs, append=len(hit)))) % 2 == 0]
            symbol[hit] = self.merged[rank[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            rank[hit] = NEVER
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            # only pairs with a merged symbol have other ranks now
            hit -= np.arange(len(hit))
            changed = np.concatenate([hit[hit > 0] - 1, hit[hit < len(symbol) - 1]])
            changed = changed[owner[changed] == owner[changed + 1]]
        symbols, owners = np.concatenate(done_symbols), np.concatenate(done_owners)
        order = np.argsort(owners, kind="stable")
        return symbols[order], np.cumsum(np.bincount(owners, minlength=len(words)))

    def _pieces(self, chunk: str) -> list[str]:
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower()]
        if chunk.isascii() and chunk[:-1].isalpha() and not chunk[-1].isalnum():
            return [chunk[:-1].lower(), chunk[-1]]
        out = []
        for part in self.marks.split(chunk) if self.marks and "<" in chunk else (chunk,):
            if part in self.special:
                out.append(part)
            elif part:
                out += PIECES.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out

    def pieces(self, distinct: Iterable[str]) -> dict[str, tuple[bytes, str]]:
        """For each piece, which may be a special token: its ids as int32 bytes, and its tokens joined by spaces."""
        found, missing = self.known_pieces.known(distinct)
        special = [p for p in missing if p in self.special]
        plain = [p for p in missing if p not in self.special]
        new = {p: (np.array([self.special[p]], "<i4").tobytes(), p) for p in special}
        if plain:
            flat, ends = self.merge([p.encode("utf-8", "replace") for p in plain])
            ids, tokens, ends = flat.astype("<i4").tobytes(), self.tokens[flat].tolist(), ends.tolist()
            new |= {p: (ids[4 * a : 4 * b], " ".join(tokens[a:b])) for p, a, b in zip(plain, [0, *ends], ends, strict=False)}
        found |= new
        self.known_pieces.hold(found)
        return found

    def chunks(self, distinct: Iterable[str]) -> dict[str, tuple[bytes, str]]:
        """The same for each chunk without white space, which consists of pieces."""
        found, missing = self.known_chunks.known(distinct)
        parts = list(map(self._pieces, missing))
        table = self.pieces({p for own in parts for p in own})
        for chunk, own in zip(missing, parts, strict=True):
            if len(own) == 1:
                found[chunk] = table[own[0]]
            else:
                entries = [table[p] for p in own]
                found[chunk] = b"".join([x[0] for x in entries]), " ".join([x[1] for x in entries])
        self.known_chunks.hold(found)
        return found

    def split(self, text: str) -> list[str]:
        return SPLIT.findall(text) if ODD.search(text) else text.split()

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """The ids, as int32 bytes, and decoded text of each text."""
        parts = [self.split(x) for x in texts]
        table = self.chunks({w for own in parts for w in own})
        id_of, text_of = {k: v[0] for k, v in table.items()}, {k: v[1] for k, v in table.items()}
        for own in parts:
            yield b"".join(map(id_of.__getitem__, own)), " ".join(filter(None, map(text_of.__getitem__, own)))

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(self.tokens[np.asarray(list(ids), "i8")])


#: A worker's tokenizer and its cache, by the hash of the file.
_loaded: dict[str, Bpe] = {}


def _run(spec, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded.get(name)
        if bpe is None:
            _loaded.clear()
            bpe = _loaded[name] = Bpe(json.loads(spec.value))
        for batch in batches:
            at, texts = 0, ["" if x is None else x for x in batch.column("text").to_pylist()]
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (chars == 0 or chars + len(texts[end]) <= TEXT_CHARS):
                    chars += len(texts[end]) or 1
                    end += 1
                out = list(bpe.encode(texts[at:end]))
                sizes = np.fromiter((len(x[0]) // 4 for x in out), "i4", len(out))
                flat = pa.array(np.frombuffer(b"".join(x[0] for x in out), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(1, "i4"), np.cumsum(sizes, dtype="i4")])), flat)
                arrays = [batch.column("doc").slice(at, end - at), ids, pa.array([x[1] for x in out], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "ids", "decoded"])
                at = end

    return run


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc, ids array<int>, decoded string) for every row of docs, where doc is a struct of all columns but text.

    tokenizer is the path of the file, read once on the driver and broadcast; its size is that of a vocabulary. Null text
    counts as empty and has no ids. Rows that repeat are encoded each.
    """
    with open(tokenizer, "rb") as f:
        file = f.read()
    spec, name = docs.sparkSession.sparkContext.broadcast(file), hashlib.sha256(file).hexdigest()
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*rest).alias("doc"), "text")
    return rows.mapInArrow(_run(spec, name), f"doc {docs.select(*rest).schema.simpleString()}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> list:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    ]


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(documents(spark, sf_dir).select("doc_id", "text"), word_bpe())
    return encoded.select(F.col("doc.doc_id").alias("doc_id"), *digests(encoded))
