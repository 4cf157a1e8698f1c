"""Licence scan through a positional index of rare licence words.

A template is one or two mandatory key phrases at fixed offsets.  Document
frequencies over all texts decide each phrase's rarest word (highest IDF); the
index posts the phrase's template, number and offset under that word.  A file's
indexed words give postings, a posting and the word's position give the place
where the phrase must start, and there the whole phrase is verified.  Two phrases
of a template belong together if their positions relative to the template agree.

DataFrame functions only: the index is a literal map, and everything about a file
is computed in its own row, so nothing is shuffled but the word frequencies.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: the base phrases and their labels
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

#: fixed values: further templates, as text with the key phrases in brackets (offsets follow from the text)
TEMPLATES = {
    "agpl": "[affero general public license]",
    "apache": "[apache license]",
    "bsd": "[redistribution and use in source and binary forms] with or without modification [are permitted provided that]",
    "cc-by-nc": "[cc by nc]",
    "cc-by-nd": "[cc by nd]",
    "cc-by-sa": "[cc by sa]",
    "lgpl": "[lesser general public license]",
    "mit": "[mit license]",
    "mit-text": "[permission is hereby granted free of charge] to any person [obtaining a copy of this software]",
    "mpl": "[mozilla public license]",
    "no-warranty": "the software is [provided as is] [without warranty of any kind]",
    "public-domain": "[dedicated to the public domain]",
}
#: words by which the relative positions of two key phrases may differ
SLACK = 8

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def phrases(templates: dict[str, str] | None = None) -> list[tuple[str, int, int, list[str]]]:
    """(label, number of the phrase, offset in the template, words) of every key phrase."""
    out = [(label, 0, 0, text.split()) for label, text in BASE.items()]
    for label, text in (TEMPLATES if templates is None else templates).items():
        offset = number = 0
        for part in re.findall(r"\[[^\]]*\]|[^\[\]]+", text):
            words = part.strip("[]").split()
            if part.startswith("["):
                out.append((label, number, offset, words))
                number += 1
            offset += len(words)
        if number > 2:
            raise ValueError(f"{label}: one or two key phrases")
    return out


def _words(text: Column) -> tuple[Column, Column]:
    """The split text and the number of empty strings before its first word."""
    parts = F.split(F.coalesce(text, F.lit("")), SEPARATORS)
    return parts, (F.element_at(parts, 1) == "").cast("int")


def rarest_words(docs: DataFrame, keys: list[tuple[str, int, int, list[str]]]) -> list[int]:
    """For each phrase the place of the word that the fewest texts contain (ties: the longer, then the first)."""
    vocabulary = sorted({w for *_, words in keys for w in words})
    own = F.array_intersect(F.split(F.lower("text"), SEPARATORS), F.array(*map(F.lit, vocabulary)))
    found = docs.select(F.explode(own).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in found.collect()}  # a row for each word of the templates
    return [min(range(len(words)), key=lambda i: (counts.get(words[i], 0), -len(words[i]), i)) for *_, words in keys]


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: the share of its key phrases that the best template has (1 with any
    label).  Defined cases: a null text is an empty one, with no words, places
    or labels (empty strings); every place of a phrase counts, overlapping ones
    too; repeated rows give repeated results; an empty table gives none; other
    columns are not read.
    """
    keys = phrases(templates)
    anchors = rarest_words(docs, keys)
    sizes = {label: sum(k[0] == label for k in keys) for label, *_ in keys}
    posted: dict[str, list[Column]] = {}
    for n, ((label, number, offset, words), at) in enumerate(zip(keys, anchors)):
        posted.setdefault(words[at], []).append(F.struct(
            F.lit(n).alias("phrase"), F.lit(label).alias("label"), F.lit(number).alias("number"), F.lit(offset).alias("offset"),
            F.lit(at).alias("at"), F.lit(len(words)).alias("n"), F.lit(label in BASE).alias("base"),
            F.lit(sizes[label]).alias("of"), F.lit(" ".join(words)).alias("text")))
    postings = F.create_map(*[x for w, p in posted.items() for x in (F.lit(w), F.array(*p))])
    # texts without any indexed word (in whatever case) have no postings
    any_word = "(?i)" + "|".join(sorted(map(re.escape, posted)))

    raw, _ = _words(F.col("text"))
    empty = (F.element_at(raw, 1) == "").cast("int") + ((F.size(raw) > 1) & (F.element_at(raw, -1) == "")).cast("int")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split, skipped = _words(lower)
    words = F.slice(split, skipped + 1, F.size(split))
    out = docs.select(F.col("doc_id"), (F.size(raw) - empty).cast("long").alias("n_words"),
                      F.when(F.col("text").rlike(any_word), words).otherwise(F.array().cast("array<string>")).alias("words"))
    places = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                      lambda x: x["w"].isin(list(posted)))
    out = out.withColumn("places", places)
    starts = F.flatten(F.transform("places", lambda x: F.transform(
        F.element_at(postings, x["w"]), lambda p: F.struct(p.alias("p"), (x["i"] - p["at"]).alias("start")))))
    hits = F.filter(starts, lambda s: (s["start"] >= 0) & F.when(
        s["start"] >= 0, F.array_join(F.slice("words", s["start"] + 1, s["p"]["n"]), " ") == s["p"]["text"]).otherwise(False))
    out = out.withColumn("hits", hits).drop("words", "places")
    base = F.filter("hits", lambda h: h["p"]["base"])
    # hits of two-phrase templates by relative position: agreeing ones of different numbers become neighbours
    pairs = F.array_sort(F.transform(F.filter("hits", lambda h: h["p"]["of"] == 2), lambda h: F.struct(
        h["p"]["label"].alias("label"), (h["start"] - h["p"]["offset"]).alias("rel"), h["p"]["number"].alias("number"))))
    out = out.withColumn("base", base).withColumn("pairs", pairs)
    nearby = F.filter(F.transform("pairs", lambda a, i: F.struct(
        a["label"].alias("label"), a["rel"].alias("rel"), a["number"].alias("number"),
        F.get("pairs", i + 1).alias("next"))), lambda x: (x["next"]["label"] == x["label"]) & (
            x["next"]["number"] != x["number"]) & (x["next"]["rel"] - x["rel"] <= SLACK))
    whole = F.filter("hits", lambda h: h["p"]["of"] == 1)
    labels = F.array_sort(F.array_distinct(F.concat(F.transform(whole, lambda h: h["p"]["label"]),
                                                    F.transform(nearby, lambda x: x["label"]))))
    out = out.withColumn("labels", labels)
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda h: h["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda h: h["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda h: h["p"]["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.when(F.size("labels") > 0, 1.0).when(F.size("hits") > 0, 0.5).otherwise(0.0).alias("score"))


def oracle(words_sql: str) -> str:
    """The same result in DuckDB SQL; ``words_sql`` gives the words of ``text``."""
    keys = phrases()
    lists = ", ".join(f"('{label}', {number}, {offset}, {sum(k[0] == label for k in keys)}, {str(words)})"
                      for label, number, offset, words in keys)
    base = ", ".join(f"'{b}'" for b in BASE)
    return f"""
WITH keys(label, number, off, of, phrase) AS (VALUES {lists}),
d AS (SELECT row_number() OVER () AS r, doc_id, {words_sql.format("coalesce(text, '')")} AS w FROM documents),
spots AS (SELECT r, w, unnest(range(0, len(w))) AS i FROM d),
hits AS (SELECT r, label, number, off, of, i FROM spots JOIN keys ON w[i + 1] = phrase[1] AND w[i + 1 : i + len(phrase)] = phrase),
base AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hits WHERE label IN ({base}) GROUP BY r),
whole AS (SELECT r, label FROM hits WHERE of = 1
          UNION SELECT a.r, a.label FROM hits a JOIN hits b ON a.r = b.r AND a.label = b.label AND a.number < b.number
                AND abs((a.i - a.off) - (b.i - b.off)) <= {SLACK}),
named AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM whole GROUP BY r)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN labels IS NOT NULL THEN 1.0 WHEN r IN (SELECT r FROM hits) THEN 0.5 ELSE 0.0 END::double AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN named USING (r)"""
