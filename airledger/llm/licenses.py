"""License scans by a positional index of rare licence words; built-in functions only.

Words are runs of letters and digits, lower-cased in A-Z (characters outside ASCII count as
letters). Three phrases are found outright, wherever their words stand consecutively (the base).

Index. TEMPLATES are licence notices of some words each. Their words but for COMMON and single
characters are the licence words; a posting says at which place of which template one stands. One
pass over the texts keeps of each document the places of its licence words and the key phrases it
has. How many documents have a licence word gives its weight, 1000 times the logarithm of the
inverse share, in whole numbers so that sums are exact.

Look-up. Of each document the LOOKED licence words that fewest documents have are looked up in the
postings. Place in the document minus place in the template is where the template would begin; places of one template that agree on
it are added up. A template is a candidate if at least AGREEING places agree that hold SHARE of the template's
weight, and it is found if the document has all of its key phrases as well. The score is the share of the
best template found; 1 if there is a base phrase; else 0.

At scale. Texts are read once and do not travel; what is stored are licence words and their places,
and what is shuffled are (document, template, beginning) counts, so a document of any length and a licence of
any frequency spread over tasks. The word counts that the driver gets, and the postings that are broadcast, are bounded by the
fixed templates.

Defined cases: a null or empty text has no words, no labels and score 0; documents are told apart
as rows, so repeated rows and null keys each get a result; of words with equal counts the first in
order is looked up first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airledger.llm.common import stored
from airledger.operators.tables import fixed_table

#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices of well-known licences as words, each with its label and the key phrases it must have.
TEMPLATES = [
    ("released under the mit license", "mit", ["mit license"]),
    ("licensed under the mit license", "mit", ["mit license"]),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit",
     ["hereby granted free of charge", "this software and associated documentation files"]),
    ("licensed under the apache license version 2 0", "apache-2.0", ["apache license", "version 2 0"]),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0",
     ["apache license", "in compliance with the license"]),
    ("this work is licensed under the gnu general public license", "gpl", ["gnu general public license"]),
    ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl",
     ["gnu general public license"]),
    ("licensed under the gnu general public license version 3", "gpl-3.0", ["gnu general public license", "version 3"]),
    ("under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl", ["gnu lesser general public license"]),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd",
     ["source and binary forms", "following conditions are met"]),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc", ["with or without fee"]),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", ["mozilla public license"]),
    ("licensed under cc by nc 4 0", "cc-by-nc", ["cc by nc"]),
    ("licensed under cc by sa 4 0", "cc-by-sa", ["cc by sa"]),
    ("licensed under cc by nd 4 0", "cc-by-nd", ["cc by nd"]),
    ("this work is licensed under a creative commons attribution noncommercial international license", "cc-by-nc", ["attribution noncommercial"]),
    ("this work is licensed under a creative commons attribution sharealike international license", "cc-by-sa", ["attribution sharealike"]),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by", ["creative commons attribution 4 0"]),
    ("this is free and unencumbered software released into the public domain", "unlicense", ["unencumbered software", "public domain"]),
    ("copyright holders all rights reserved", "reserved", ["all rights reserved"]),
]
#: Words too common to be looked up.
COMMON = ("the of to and or in is are this that it as by an you may not any with for be on at can into").split()
LOOKED, AGREEING, SHARE = 64, 2, 0.6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def postings(templates: list = TEMPLATES) -> list[tuple[str, int, int]]:
    """(licence word, template, place)."""
    return [(w, t, at) for t, (words, _, _) in enumerate(templates) for at, w in enumerate(words.split()) if w not in COMMON and len(w) > 1]


def padded(text: Column) -> Column:
    """The words, each between two single spaces."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _has(text: Column, phrase: str) -> Column:
    return F.contains(text, F.lit(f" {phrase} "))


def scan(docs: DataFrame, key: str, text: str, base: dict[str, str] = BASE, templates: list = TEMPLATES) -> DataFrame:
    """Per document row, stored: uid, key, n_words, n_base, first_word, last_word, base_labels,
    marks (places of licence words) and keyed (its key phrases)."""
    words = sorted({w for w, _, _ in postings(templates)})
    rows = docs.select(docs[key].alias("__key"), padded(docs[text]).alias("padded"))
    any_of = f" (?:{'|'.join(base)}) "
    # a piece for each place where a phrase begins, and one for what stands before the first
    pieces = F.when(F.col("padded") != "  ", F.split("padded", f"(?={any_of})"))
    rows = rows.select("*", pieces.alias("pieces"), F.rlike("padded", F.lit(f"^{any_of}")).alias("at_once"),
                       F.when(F.col("padded") != "  ", F.split(F.trim("padded"), " ")).alias("words"))
    n_base = F.coalesce(F.size("pieces") - 1 + F.col("at_once").cast("int"), F.lit(0)).cast("long")
    here = F.transform("words", lambda w, i: F.when(w.isin(words), F.struct(i.alias("at"), w.alias("word"))))
    phrases = sorted({p for _, _, must in templates for p in must})
    rows = rows.select("__key", "padded", F.coalesce(F.size("words"), F.lit(0)).cast("long").alias("n_words"), n_base.alias("n_base"), "at_once", "pieces",
                       F.filter(F.coalesce(here, F.array()), lambda m: m.isNotNull()).alias("marks"))
    first = F.when(F.col("at_once"), F.lit(0).cast("long")).otherwise(_spaces(F.element_at("pieces", 1)))
    last = F.col("n_words") + 1 - _spaces(F.element_at("pieces", -1))
    found = F.filter(F.array(*[F.when(_has(F.col("padded"), p), F.lit(label)) for p, label in base.items()]), lambda x: x.isNotNull())
    keyed = F.filter(F.array(*[F.when(_has(F.col("padded"), p), F.lit(p)) for p in phrases]), lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    return stored(rows.select(
        F.monotonically_increasing_id().alias("uid"), "__key", "n_words", "n_base",
        F.when(F.col("n_base") > 0, first).alias("first_word"), F.when(F.col("n_base") > 0, last).alias("last_word"),
        F.when(F.col("n_base") > 0, found).otherwise(none).alias("base_labels"), "marks",
        F.when(F.size("marks") >= AGREEING, keyed).otherwise(none).alias("keyed")), "scanned")


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text", base: dict[str, str] = BASE, templates: list = TEMPLATES) -> DataFrame:
    """Per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    scanned = scan(docs, key, text, base, templates)
    total = scanned.count()
    marked = scanned.where(F.size("marks") >= AGREEING)
    each = scanned.select(F.explode(F.array_distinct(F.transform("marks", lambda m: m["word"]))).alias("word"))
    have = {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}  # licence words only
    index = postings(templates)
    weight = {w: max(1, round(1000 * math.log((total + 1) / (have.get(w, 0) + 1)))) for w, _, _ in index}
    whole = {t: sum(weight[w] for w, u, _ in index if u == t) for t in range(len(templates))}
    rarest = F.array(*[F.lit(w) for w in sorted(weight, key=lambda w: (have.get(w, 0), w))])

    looked = F.slice(F.array_intersect(rarest, F.transform("marks", lambda m: m["word"])), 1, LOOKED)
    places = (marked.select("uid", "marks", looked.alias("looked"))
              .select("uid", F.explode(F.filter("marks", lambda m: F.array_contains("looked", m["word"]))).alias("mark")))
    listed = fixed_table(spark, [(w, t, at, weight[w]) for w, t, at in index], "word string, template int, place int, weight long")
    agreed = (places.select("uid", F.col("mark.at").alias("at"), F.col("mark.word").alias("word")).join(F.broadcast(listed), "word")
              .groupBy("uid", "template", (F.col("at") - F.col("place")).alias("beginning"))
              .agg(F.count(F.lit(1)).alias("places"), F.sum("weight").alias("weight")).where(F.col("places") >= AGREEING))
    about = fixed_table(spark, [(t, label, must, whole[t]) for t, (_, label, must) in enumerate(templates)],
                                  "template int, label string, must array<string>, whole long")
    share = F.round(F.col("weight") / F.col("whole"), 6)
    likely = (agreed.join(F.broadcast(about), "template").where(share >= SHARE).groupBy("uid")
              .agg(F.collect_set(F.struct(share.alias("share"), "label", "must")).alias("likely")))
    sure = F.filter("likely", lambda t: F.forall(t["must"], lambda p: F.array_contains("keyed", p)))
    rows = (scanned.drop("marks").join(likely, "uid", "left")
            .withColumn("sure", F.coalesce(sure, F.array())))
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("sure", lambda t: t["label"]))))
    best = F.coalesce(F.array_max(F.transform("sure", lambda t: t["share"])), F.lit(0.0))
    return rows.select(F.col("__key").alias(key), "n_words", "n_base", "first_word", "last_word",
                       F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                       F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"))
