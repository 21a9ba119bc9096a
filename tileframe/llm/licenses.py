"""Operator 8: license scans by an exact set-similarity join. DataFrame functions only.

Base labels come from phrases whose words stand consecutively. The method adds labels of templates: a text is cut
into overlapping blocks of words, and a block gets a template's label if it holds at least THRESHOLD of
the template's distinct words. Templates of up to 16, 32, 64 ... words have blocks of twice as many, which start every 16, 32,
64 ... words, so that any passage as long as the template is whole in one. The join orders words by how many documents have them,
rarest first:

* prefix filter: a block that holds enough of a template has one of its len - need + 1 rarest words;
* length filter: it has at least need words of the templates at all;
* positional filter: from the first shared word on, enough words must remain on both sides.

Pairs that pass are compared in full, so the result is that of comparing every block with every template.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, written
from .license_texts import TEMPLATES

#: The smallest step of blocks; other steps are it doubled.
LEAST_STEP = 16
THRESHOLD = 0.8
MOST_TEMPLATE_WORDS = 10_000

# The phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: All ASCII but letters and digits parts words.
SEPARATORS = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
_FROM = string.ascii_uppercase + SEPARATORS
_TO = string.ascii_lowercase + " " * len(SEPARATORS)


def normal(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, each with one space before and the last with one after."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _FROM, _TO)
    return F.concat(F.lit(" "), F.regexp_replace(F.trim(spaced), " +", " "), F.lit(" "))


def n_words(norm: Column) -> Column:
    """Words of a normal() text: its spaces less one."""
    return F.when(norm == "  ", 0).otherwise(F.octet_length(norm) - F.octet_length(F.replace(norm, F.lit(" "), F.lit(""))) - 1)


def places(norm: Column, phrase: str) -> Column:
    """array<long>: the word positions at which the phrase starts, overlapping ones too.

    Text is parted at the spaces that the phrase follows; how many words stand before each is where it starts.
    """
    words = lambda x: F.size(F.filter(F.split(x, " "), lambda w: w != ""))
    parts = F.split(norm, f" (?={phrase} )", -1)
    grown = F.aggregate(
        F.slice(parts, 1, F.size(parts) - 1),
        F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<long>").alias("at")),
        lambda acc, x: F.struct((acc.n + words(x)).alias("n"), F.array_append(acc.at, acc.n + words(x)).alias("at")),
    )
    return F.when(F.contains(norm, F.lit(f" {phrase} ")), grown.at).otherwise(F.array().cast("array<long>"))


def template_table(templates) -> list[dict]:
    """Templates as id, label, step of their blocks, distinct words, and how many of these a block needs."""
    table = []
    for i, (label, text) in enumerate(templates):
        own = text.translate(str.maketrans(_FROM, _TO)).split()
        words, step = sorted(set(own)), LEAST_STEP
        while step < len(own):
            step *= 2
        table.append({"id": i, "label": label, "step": step, "words": words, "need": math.ceil(THRESHOLD * len(words) - 1e-9)})
    if not all(t["words"] for t in table) or sum(len(t["words"]) for t in table) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates need words, and may have {MOST_TEMPLATE_WORDS} in all")
    return table


def _words(own: list[str]) -> Column:
    return F.array(*map(F.lit, own))


def _held(rows: DataFrame, table: list[dict]) -> DataFrame:
    """rows (norm) with held, the templates' words that a text has, and near, the templates of which it has enough as a whole."""
    vocabulary = sorted({w for t in table for w in t["words"]})
    rows = rows.withColumn("held", F.array_intersect(F.split(F.trim("norm"), " "), _words(vocabulary)))
    enough = [F.when(F.size(F.array_intersect(_words(t["words"]), "held")) >= t["need"], F.lit(t["id"])) for t in table]
    return rows.withColumn("near", F.when(F.size("held") >= min(t["need"] for t in table), F.array_compact(F.array(*enough))).otherwise(F.array().cast("array<int>")))


def _hits(texts: DataFrame, key: str, table: list[dict]) -> DataFrame:
    """(key, label, score) of each key and template label whose block meets THRESHOLD; score is its best containment.

    texts are (key, norm, held, near) of all documents, norm being null where near is empty.
    """
    vocabulary = sorted({w for t in table for w in t["words"]})
    # in how many of all documents each word stands, at most MOST_TEMPLATE_WORDS rows
    count = dict(texts.select(F.explode("held").alias("word")).groupBy("word").count().collect())
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefixes = []
    for t in table:
        words = sorted(t["words"], key=rank.get)
        prefixes += [(t["step"], w, t["id"], t["label"], t["need"], i, words) for i, w in enumerate(words[: len(words) - t["need"] + 1])]
    prefix = texts.sparkSession.createDataFrame(prefixes, "step int, word string, template int, label string, need int, i int, words array<string>")
    rare = sorted({p[1] for p in prefixes}, key=rank.get)

    steps = sorted({t["step"] for t in table})
    of = {n: [t for t in table if t["step"] == n] for n in steps}
    wanted = F.array_compact(F.array(*[F.when(F.arrays_overlap("near", F.array(*[F.lit(t["id"]) for t in of[n]])), F.lit(n)) for n in steps]))
    least = F.create_map(*[F.lit(x) for n in steps for x in (n, min(t["need"] for t in of[n]))])
    words = F.split(F.trim("norm"), " ")
    some = texts.filter(F.size("near") > 0).select(key, words.alias("words"), F.explode(wanted).alias("step"))
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.col("step"))
    cut = some.select(key, "step", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, 2 * F.col("step")))).alias("part"))
    # the block's template words, rarest first
    blocks = cut.select(key, "step", F.array_intersect(_words(order), "part").alias("own")).filter(F.size("own") >= least[F.col("step")])
    tokens = blocks.select(key, "step", "own", F.size("own").alias("len"), F.posexplode("own").alias("j", "word")).filter(F.col("word").isin(rare))
    met = tokens.join(F.broadcast(prefix), ["step", "word"])
    remain = F.least(F.size("words") - F.col("i"), F.col("len") - F.col("j"))
    before = F.array_intersect(F.slice("words", 1, F.col("i")), "own")
    met = met.filter((F.col("len") >= F.col("need")) & (F.size(before) == 0) & (remain >= F.col("need")))
    shared = F.size(F.array_intersect("words", "own"))
    return met.filter(shared >= F.col("need")).groupBy(key, "label").agg(F.max(shared / F.size("words")).alias("score"))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of docs (doc_id, text).

    Null text counts as empty. Rows that repeat have the same result each, other columns are ignored, an empty table gives no rows.
    A text of any length is scanned whole. score is 1 with a base label, else the best containment of a template that met the
    threshold, else 0. Texts are normalised once; what is written holds words only of texts that have enough of some template's.
    """
    table = template_table(templates)
    norms = _held(docs.select("doc_id", normal(F.col("text")).alias("norm")), table)
    found = [places(F.col("norm"), phrase) for phrase, _ in phrases]
    rows = norms.select("*", F.xxhash64("norm").alias("hash"), n_words(F.col("norm")).cast("long").alias("n_words"), *[at.alias(f"at{i}") for i, at in enumerate(found)])
    named = [F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]
    rows = rows.withColumns({"at": F.concat(*[f"at{i}" for i in range(len(phrases))]), "base": F.array_compact(F.array_distinct(F.array(*named)))})
    rows = written(rows.select("doc_id", "hash", "n_words", "at", "base", "held", "near", F.when(F.size("near") > 0, F.col("norm")).alias("norm")), "words")
    hits = _hits(rows.select(F.struct("doc_id", "hash").alias("key"), "norm", "held", "near"), "key", table)
    hits = hits.groupBy("key").agg(F.sort_array(F.collect_set("label")).alias("more"), F.max("score").alias("best"))
    hits = hits.select(F.col("key.doc_id").alias("d"), F.col("key.hash").alias("h"), "more", "best")
    joined = rows.join(hits, rows["doc_id"].eqNullSafe(hits["d"]) & (rows["hash"] == hits["h"]), "left")
    base = F.size("base") > 0
    return joined.select(
        "doc_id",
        "n_words",
        F.size("at").cast("long").alias("n_base"),
        F.array_min("at").alias("first_word"),
        F.array_max("at").alias("last_word"),
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(base, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql(templates=TEMPLATES, phrases=PHRASES) -> str:
    """The scan in SQL: every block is held against every template."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    low = f"translate({{0}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quoted(label)}, {quoted(text)})" for i, (label, text) in enumerate(templates))
    steps = " ".join(f"when len(words) <= {LEAST_STEP << k} then {LEAST_STEP << k}" for k in range(14))
    found = [f"list_filter(range(0, len(words) - {len(p.split()) - 1}), lambda i: words[i + 1:i + {len(p.split())}] = {p.split()!r})" for p, _ in phrases]
    base = ", ".join(f"case when len(at{i}) > 0 then {quoted(label)} end" for i, (_, label) in enumerate(phrases))
    at = " || ".join(f"at{i}" for i in range(len(phrases)))
    return f"""
with docs as (select doc_id, row_number() over () as rid, regexp_extract_all({low.format("coalesce(text, '')")}, {word}) as words from documents),
  cut as (select id, label, regexp_extract_all({low.format('text')}, {word}) as words from (values {rows}) t(id, label, text)),
  templates as (select id, label, case {steps} end as step, list_distinct(words) as own, ceil({THRESHOLD} * len(list_distinct(words)) - 1e-9) as need from cut),
  steps as (select distinct step from templates),
  blocks as (select rid, step, list_distinct(words[i + 1:i + 2 * step]) as part from docs, steps, lateral (select unnest(range(0, len(words), step)) as i) b),
  hits as (select rid, label, len(list_intersect(own, part)) / len(own) as score from blocks join templates using (step) where len(part) >= need and len(list_intersect(own, part)) >= need),
  best as (select rid, list(distinct label) as more, max(score) as best from hits group by rid),
  placed as (select *, {", ".join(f"{x} as at{i}" for i, x in enumerate(found))} from docs),
  based as (select *, {at} as places, list_filter([{base}], lambda x: x is not null) as base from placed)
select doc_id, len(words) as n_words, len(places) as n_base, list_min(places) as first_word, list_max(places) as last_word,
  array_to_string(list_sort(list_distinct(base)), ',') as base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') as labels,
  case when len(base) > 0 then 1.0 else coalesce(best, 0.0) end :: double as score
from based left join best using (rid)
"""


OP8_SQL = _sql()
