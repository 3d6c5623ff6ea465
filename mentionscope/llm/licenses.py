"""Licence scan by a positional rare-token index (DataFrame only).

Document frequencies of the licence words over the whole corpus give each
template its rarest word. A file is looked up by these words; a hit at word
position p of a word with offset o in a template proposes the start p - o, the
template's other postings are intersected at the same relative positions, and
the mandatory key phrase must stand there word for word.

Edge cases: null or empty text has no words and no label; repeated rows are
scanned alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# Letters and digits of ASCII and everything beyond ASCII are word characters.
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``key`` is the mandatory phrase, ``after`` the words that usually follow it."""
    label: str
    key: str
    after: str = ""
    base: bool = False

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def words(self) -> list[str]:
        return (self.key + " " + self.after).split()


# Phrases of public licences.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license", "version 2 0"),
    Template("epl", "eclipse public license"),
    Template("bsd", "redistribution and use in source and binary forms", "with or without modification are permitted"),
    Template("isc", "permission to use copy modify and or distribute this software", "for any purpose"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc0", "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPLIT), "")


def rarity(docs: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of each licence word over all documents. The
    result has one row per licence word, however many documents there are."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary)))
    both = docs.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("w")).groupBy("w").count()
    df = {r["w"]: r["count"] for r in both.collect()}
    n = df.get("", 0)
    return {w: math.log((n + 1.0) / (df.get(w, 0) + 0.5)) for w in vocabulary}


def scan(docs: DataFrame, idf: dict[str, float], templates=TEMPLATES) -> DataFrame:
    """Per document: ``n_words``, ``places`` (template number, start), sorted, and
    ``score``, the weight of template words found at their places, best place first."""
    anchors = [max(range(len(t.key_words)), key=lambda i, t=t: (idf[t.key_words[i]], -i)) for t in templates]
    rare = sorted({t.key_words[a] for t, a in zip(templates, anchors)})
    listed = F.array(*map(F.lit, rare))
    words = F.col("__words")
    none = F.expr("array()").cast("array<struct<w:string,i:int>>")
    hits = F.when(F.arrays_overlap(words, listed),
                  F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                           lambda s: s["w"].isin(rare))).otherwise(none)
    d = docs.withColumn("__words", words_of(F.col("text"))).withColumn("__hits", hits)

    def at(start: Column, j: int) -> Column:
        return F.get(words, start + j)

    def places(number: int) -> Column:
        t, a = templates[number], anchors[number]
        weight = [idf[w] for w in t.words]
        total = sum(weight) or 1.0

        def stands(h):
            start = h["i"] - a
            whole = start >= 0
            for j, w in enumerate(t.key_words):
                whole = whole & F.coalesce(at(start, j) == w, F.lit(False))
            return (h["w"] == t.key_words[a]) & whole

        def place(h):
            start = h["i"] - a
            sure = sum(weight[: len(t.key_words)])
            score = F.lit(float(sure))
            for j in range(len(t.key_words), len(t.words)):
                score = score + F.when(at(start, j) == t.words[j], F.lit(weight[j])).otherwise(0.0)
            score = F.least(score / F.lit(total), F.lit(1.0)) if len(t.words) > len(t.key_words) else F.lit(1.0)
            return F.struct(F.lit(number).alias("t"), start.alias("start"), score.cast("double").alias("score"))

        return F.transform(F.filter(F.col("__hits"), stands), place)

    found = F.when(F.size("__hits") > 0, F.concat(*[places(k) for k in range(len(templates))])).otherwise(
        F.expr("array()").cast("array<struct<t:int,start:int,score:double>>"))
    return (d.withColumn("n_words", F.size(words).cast("long")).withColumn("places", found)
             .withColumn("score", F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)))
             .drop("__words", "__hits"))


def labels_of(found: Column, templates=TEMPLATES) -> Column:
    """Distinct labels of places, sorted, joined by commas."""
    names = F.array(*[F.lit(t.label) for t in templates])
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda p: F.get(names, p["t"])))), ",")


def license_scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places."""
    base = [k for k, t in enumerate(templates) if t.base]
    d = scan(docs.select("doc_id", "text"), rarity(docs, templates), templates)
    d = d.withColumn("__base", F.filter("places", lambda p: p["t"].isin(base)))
    start = F.transform("__base", lambda p: p["start"])
    return d.select("doc_id", "n_words", F.size("__base").cast("long").alias("n_base"),
                    F.array_min(start).cast("long").alias("first_word"), F.array_max(start).cast("long").alias("last_word"),
                    labels_of(F.col("__base"), templates).alias("base_labels"), labels_of(F.col("places"), templates).alias("labels"),
                    "score", "places")
