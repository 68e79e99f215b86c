from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from airledger.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def stands(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]


def brute(docs):
    texts = [(k, WORD.findall((t or "").translate(LOWER))) for k, t in docs]
    index = L.postings()
    known = {w for w, _, _ in index}
    have = Counter(w for _, ws in texts for w in set(ws) & known)
    weight = {w: max(1, round(1000 * math.log((len(texts) + 1) / (have[w] + 1)))) for w in known}
    out = []
    for key, words in texts:
        places = [(i, label) for phrase, label in L.BASE.items() for i in stands(words, phrase)]
        base = {label for _, label in places}
        looked = set(sorted(set(words) & known, key=lambda w: (have[w], w))[:L.LOOKED])
        votes = defaultdict(list)
        for i, w in enumerate(words):
            for v, t, at in index if w in looked else ():
                if v == w:
                    votes[t, i - at].append(weight[w])
        found, best = set(base), 0.0
        for (t, _), got in votes.items():
            share = round(sum(got) / sum(weight[w] for w, u, _ in index if u == t), 6)
            _, label, must = L.TEMPLATES[t]
            if len(got) >= L.AGREEING and share >= L.SHARE and all(stands(words, p) for p in must):
                found.add(label)
                best = max(best, share)
        starts = [i for i, _ in places]
        out.append((key, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(found)),
                    1.0 if places else best))
    return sorted(out, key=str)


def report(docs):
    return sorted((tuple(r[c] for c in COLUMNS) for r in L.license_report(docs).collect()), key=str)


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute(pairs(docs))
    assert {"mit", "apache-2.0"} <= {r[6] for r in want}
    assert report(docs) == want


def test_phrases_in_all_places(spark):
    texts = ["cc by cc by CC-BY", "All rights reserved", "x all rights reserved general public license cc by y", "rights reserved all rights", "cc bye", "acc by", "all rights\nreserved. all\trights reserved",
             "cc", "général public license", "cc by " * 3000, " cc by", "Kc by"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = report(docs)
    assert got == brute(pairs(docs))
    assert got[0][2:5] == (3, 0, 4)


def test_notices_need_place_and_key_phrase(spark):
    grant = L.TEMPLATES[2][0]
    words = grant.split()
    texts = [f"before {grant} after", " ".join(reversed(words)), grant.replace("hereby granted free of charge", "hereby granted free of all charge"),
             "the license of mit was released under the sun", "Released under the MIT License.", "released under the license mit",
             "Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 3.0", f"Licensed under CC BY-NC 4.0 {grant}"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(100 + i, "some other words that have nothing to do with it") for i in range(50)], "doc_id long, text string")
    got = report(docs)
    assert got == brute(pairs(docs))
    labels = {r[0]: r[6] for r in got}
    assert [labels[i] for i in range(9)] == ["mit", "", "", "", "mit", "", "apache-2.0", "", "cc-by,cc-by-nc,mit"]


def test_rows_are_told_apart(spark, edge_docs, no_docs):
    assert report(edge_docs) == brute(pairs(edge_docs))
    assert report(no_docs) == []
    clash = spark.createDataFrame([(1, "all rights reserved", "x", 1), (1, "all rights reserved", "x", 1), (None, "mit license released", None, 2)],
                                  "doc_id long, text string, marks string, uid long")
    assert report(clash) == brute(pairs(clash))


def test_no_python_on_the_way(spark, monkeypatch):
    monkeypatch.setattr(L, "stored", lambda df, what: df)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = L.license_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
