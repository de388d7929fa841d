"""License scans, in DataFrame expressions only.

Base: places where the words of a phrase stand in a row. On top, an exact set-similarity join finds every text block that contains at
least `threshold` of the distinct words of a license template. A block is a line or, for notices that are hard-wrapped, a run of as many
words as the template has, over any number of line ends; lines without words do not part it. Template words are ordered by how many
blocks of all documents hold them, rarest first; a block can reach the threshold only if it holds one of a template's first
t - ceil(threshold t) + 1 words (prefix), has enough template words at all (length), and has enough of them left behind the
matching place in both orders (position). What passes is counted in full.

The templates are a parameter; their words are the only thing that is broadcast or brought to the driver.

Null text: empty text, no words, no labels, score 0. Repeated rows: each is returned. Empty table: no rows. Other columns are
ignored. Score: 1 where a base phrase stands, else the largest containment that reached the threshold, else 0.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.llm.tables import only, query, table

#: fixed values: what parts words, and the phrases with their labels
PARTS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # A-Z are word characters, as they are lower-cased first
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: label and wording of short notices
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under creative commons attribution share alike 4 0"),
    ("all-rights-reserved", "all rights reserved"),
]


def phrase_pattern(phrases) -> str:
    """Whole words of a phrase in a row, whatever stands between them; A-Z equal a-z."""
    either = "|".join(f"[{PARTS}]+".join(p.split()) for p in phrases)
    return rf"(?i)(?<![^{PARTS}])(?:{either})(?![^{PARTS}])"


def word_set(words: list[str]):
    return F.array(*[F.lit(w) for w in words])


def around_line_ends(every, reach: int):
    """Of each line: its first `reach` words, behind the `reach` words that stand before the line."""
    last = lambda x: F.slice(x, F.greatest(F.lit(1), F.size(x) - reach + 1), F.lit(reach))
    # every line holds a word, so no more than `reach` lines are needed
    before = lambda i: F.flatten(F.transform(F.slice(every, F.greatest(F.lit(1), i - reach + 1), F.least(i, F.lit(reach))), last))
    joined = lambda x, i: F.transform(F.array(before(i)), lambda b: F.concat(last(b), F.slice(x, 1, reach)))[0]
    return F.filter(F.transform(every, lambda x, i: F.when(i > 0, joined(x, i))), F.isnotnull)


def least_words(text: str, threshold: float) -> int:
    return math.ceil(threshold * len(set(text.split())) - 1e-9)


def base(docs: DataFrame, phrases: dict[str, str], templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """Per document: counts and places of the phrases, and the blocks: the distinct template words of each line (`near` is null), and of
    the words around each line end, `near`, if they can hold a template."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    reach = max(len(t.split()) for _, t in templates)
    text, any_phrase = F.col("text"), phrase_pattern(phrases)
    words = F.lit(f"[^{PARTS}]+")
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("n_base", F.regexp_count(text, F.lit(any_phrase)).cast("long"))
    found = F.col("n_base") > 0
    before_first = F.expr("substring(text, 1, place - 1)")
    before_last = F.regexp_extract(text, f"(?s)^(.*){any_phrase}", 1)
    by_label: dict[str, list[str]] = {}
    for p, label in phrases.items():
        by_label.setdefault(label, []).append(p)
    labels = F.array(*[F.when(text.rlike(phrase_pattern(ps)), label) for label, ps in by_label.items()])
    lines = F.transform(F.split(text, "\n"), lambda x: F.filter(F.split(F.lower(x), f"[{PARTS}]+"), lambda w: w != ""))
    lines = F.filter(lines, lambda x: F.size(x) > 0)
    held = lambda x: F.array_intersect(x, word_set(vocabulary))
    can_hold = lambda w: functools.reduce(operator.or_, [F.size(F.array_intersect(w, word_set(sorted(set(t.split()))))) >= least_words(t, threshold) for _, t in templates])
    # transform over one value: what a lambda refers to is computed once, not for each line
    whole = lambda every: F.transform(every, lambda x: F.struct(held(x).alias("words"), F.lit(None).cast("array<string>").alias("near")))
    joined = lambda every: F.transform(around_line_ends(every, reach), lambda x: F.struct(held(x).alias("words"), x.alias("near")))
    joined_that_can = lambda every: F.filter(joined(every), lambda x: can_hold(x["words"]))
    blocks = F.transform(F.array(lines), lambda every: F.concat(whole(every), joined_that_can(every)))[0]
    return docs.withColumn("place", F.when(found, F.regexp_instr(text, F.lit(any_phrase)))).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("uid"), F.regexp_count(text, words).cast("long").alias("n_words"), "n_base",
        F.when(found, F.regexp_count(before_first, words)).cast("long").alias("first_word"),
        F.when(found, F.regexp_count(before_last, words)).cast("long").alias("last_word"),
        F.when(found, F.array_sort(F.array_compact(labels))).otherwise(F.array().cast("array<string>")).alias("found"),
        F.filter(blocks, lambda x: F.size(x["words"]) > 0).alias("blocks"),
    )


def template_hits(rows: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """uid, label, containment of every template in every block that reaches the threshold."""
    spark = rows.sparkSession
    blocks = rows.select("uid", F.inline("blocks"))
    # blocks that hold a word, over all documents; one row per template word
    lines = dict(blocks.select(F.explode("words").alias("w")).groupBy("w").count().collect())
    order = {w: i for i, w in enumerate(sorted({w for _, t in templates for w in t.split()}, key=lambda w: (lines.get(w, 0), w)))}
    prefix = []
    for k, (label, text) in enumerate(templates):
        own = sorted(set(text.split()), key=order.get)
        need, width = least_words(text, threshold), len(text.split())
        prefix += [(w, k, label, own, need, width, i) for i, w in enumerate(own[: len(own) - need + 1])]
    prefix = spark.createDataFrame(prefix, "w string, template int, label string, own array<string>, need int, width int, at int")
    ranks = F.create_map(*[x for w, i in order.items() for x in (F.lit(w), F.lit(i))])
    rank_of = lambda w: F.element_at(ranks, w)
    least = min(least_words(t, threshold) for _, t in templates)
    short = blocks.where(F.size("words") >= least).distinct()  # equal blocks of a document once
    short = short.withColumn("id", F.xxhash64("uid", "words"))
    pairs = short.withColumn("w", F.explode("words")).join(F.broadcast(prefix), "w")
    behind = F.size(F.filter("words", lambda x: rank_of(x) > rank_of(F.col("w"))))
    pairs = pairs.where((F.size("words") >= F.col("need")) & (1 + F.least(behind, F.size("own") - F.col("at") - 1) >= F.col("need")))
    # the first shared prefix word carries the pair; its later ones would only repeat it
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("near") - F.col("width") + 1))
    of_run = F.array_max(F.transform(starts, lambda s: F.size(F.array_intersect(F.slice("near", s, F.col("width")), F.col("own")))))
    overlap = F.when(F.col("near").isNull(), F.size(F.array_intersect("words", "own"))).otherwise(of_run)
    hits = pairs.where(overlap >= F.col("need")).select("uid", "label", (overlap / F.size("own")).alias("containment"))
    return hits.groupBy("uid", "label").agg(F.max("containment").alias("containment"))


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every document."""
    rows = stage(base(only(docs, "doc_id", "text"), phrases, templates, threshold))
    hits = template_hits(rows.select("uid", "blocks"), templates, threshold)
    hits = hits.groupBy("uid").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))  # one label each at most
    both = rows.drop("blocks").join(hits, "uid", "left")
    labels = F.array_sort(F.array_union("found", F.coalesce("more", F.array().cast("array<string>"))))
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("found", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrases = ", ".join(f"('{p}', '{label}', [{', '.join(repr(w) for w in p.split())}])" for p, label in PHRASES.items())
    templates = ", ".join(f"('{label}', [{', '.join(repr(w) for w in sorted(set(t.split())))}])" for label, t in TEMPLATES)
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{word}') AS words FROM d),
p(phrase, label, parts) AS (VALUES {phrases}),
i AS (SELECT doc_id, unnest(range(0, len(words))) AS i, words FROM w WHERE regexp_matches(text, 'gnu|apache|cc|mit')),
m AS (SELECT doc_id, i, label FROM i JOIN p ON words[i + 1] = parts[1] AND words[i + 1 : i + len(parts)] = parts),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS found FROM m GROUP BY doc_id),
t(label, own) AS (VALUES {templates}),
l AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '{word}')) AS own FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
c AS (SELECT doc_id, label, len(list_intersect(l.own, t.own)) / len(t.own) AS containment, len(list_intersect(l.own, t.own)) >= ceil(0.8 * len(t.own) - 1e-9) AS hit FROM l, t),
h AS (SELECT doc_id, list(DISTINCT label) AS more, max(containment) AS best FROM c WHERE hit GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(found, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(found, []), coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN h USING (doc_id)
"""


@query("op8_licenses", _sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
