from __future__ import annotations

import math
import random
import zlib

import numpy as np

from airledger.llm import toxicity as X


def plain_segments(scores):
    """Ruzzo and Tompa's definition by recursion: the best segment (first, shortest), then those
    to its left and right."""
    def inside(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                    best = (i, j + 1, total)
        return [] if best is None else [*inside(a, best[0]), best, *inside(best[1], b)]
    return inside(0, len(scores))


def test_segments_against_definition():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(0, 25)
        marked = [(i, rng.uniform(-2, 3)) for i in range(n) if rng.random() < 0.5]
        whole = [-0.3] * n
        for i, s in marked:
            whole[i] = s
        got = X.segments(marked, 0.3)
        want = plain_segments(whole)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_scan_is_linear():
    """Candidates that pile up: falling totals, alternating signs, and one late segment that joins all."""
    import time
    n = 200_000
    shapes = [[(3 * i, 1.0) for i in range(n)], [(2 * i, 1.0 if i % 2 else -0.5) for i in range(n)], [(2 * i, 0.1) for i in range(n)] + [(2 * n, 1e9)],
              [(i, 1.0 / (i + 1) if i % 2 else -1.0 / (i + 1)) for i in range(n)]]
    for marked in shapes:
        began = time.process_time()
        X.segments(marked, 0.9)
        assert time.process_time() - began < 2
    random.seed(4)
    marked = [(i, random.choice([1.0, -1.0, 2.0, -2.0])) for i in range(120)]
    whole = [s for _, s in marked]
    assert [(a, b) for a, b, _ in X.segments(marked, 0.0)] == [(a, b) for a, b, _ in plain_segments(whole)]


def test_score_by_hand(monkeypatch):
    """The score of a text from its words, segments and evidence by their definitions."""
    entries = {b"vile ": 3.0, b"vil": 1.5, b"fool": 2.0, b"kind ": -2.0}
    model = X.Lexicon(entries, 1.0, rate=0.7, log_k=-1.0, logistic=(-3.0, 1.2))

    def plain(word):
        keys = [word + b" "] + [word[:n] for n in range(9, 2, -1) if len(word) >= n]
        return next((entries[k] for k in keys if k in entries), -1.0)

    rng = random.Random(6)
    monkeypatch.setattr(X, "KNOWN_WORDS", 3)
    for _ in range(60):
        text = " ".join(rng.choice(["vile", "vilest", "Foolish", "foo", "kind", "kindly", "a", "b"]) for _ in range(rng.randint(1, 14)))
        words = text.lower().encode().split()
        n, found = model.found(text.encode())
        segments = plain_segments([plain(w) for w in words])
        rated = [0.7 * s + 1.0 - math.log(len(words)) for *_, s in segments]
        evidence = sum(e for e in rated if e > -math.log(0.05))
        want = 1 / (1 + math.exp(3.0 - 1.2 * math.log1p(evidence)))
        assert n == len(words) and abs(model.score(model.significant(n, found)) - want) < 1e-9


def test_extreme_rate_solves_its_equation():
    scores, shares = np.array([-0.1, 2.0, 5.0]), np.array([0.97, 0.02, 0.01])
    scores[0] = -0.2
    rate = X.extreme_rate(scores, shares)
    assert abs((shares * np.exp(rate * scores)).sum() - 1) < 1e-9


def test_logistic_fit_where_values_nearly_part_the_labels():
    """Full Newton steps run away here, to an intercept under which all texts score the same."""
    x, y, times = np.array([0.0, 3.0, 3.0, 3.5]), np.array([0.0, 0.0, 1.0, 1.0]), np.array([12000.0, 5.0, 20.0, 1260.0])
    a, b = X.fit_logistic(x, y, times)
    loss = lambda a, b: (times * (np.logaddexp(0, a + b * x) - y * (a + b * x))).sum() + 0.05 * b * b
    assert b > 1 and abs(a) < 100
    assert all(loss(a, b) <= loss(a + d, b + e) + 1e-6 for d in (-0.1, 0, 0.1) for e in (-0.1, 0, 0.1))
    a, b = X.fit_logistic(np.array([1.0, 2.0]), np.array([1.0, 0.0]), np.array([10.0, 30.0]))  # the other way round
    shares = 1 / (1 + np.exp(-(a + b * np.array([1.0, 2.0]))))
    assert b == X.LEAST_SLOPE and abs((shares * [10, 30]).sum() - 10) < 1e-6


def test_texts_without_significant_segments_are_ranked():
    model = X.Lexicon({b"vile ": 2.0, b"mean ": 1.0}, 1.0, rate=0.7, log_k=0.0, logistic=(-3.0, 1.2))

    def score(text):
        n, found = model.found(text)
        passages = model.significant(n, found)
        return model.score(passages, model.weak(n, found)), len(passages)

    rest = b" a" * 200
    got = [score(b + rest) for b in (b"", b"mean", b"vile", b"vile vile vile", b"vile " * 9, b"vile " * 30)]
    assert [n for _, n in got] == [0, 0, 0, 0, 1, 1]
    assert all(a < b for (a, _), (b, _) in zip(got, got[1:], strict=False))


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = X.toxicity_report(docs, labels).collect()
    assert len(rows) == docs.count()
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["score"], toxic[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    yes, no = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    above = sum((a > b) + 0.5 * (a == b) for a in yes for b in no) / (len(yes) * len(no))
    assert above > 0.85
    caught = [y for _, y, p in held if p]
    assert sum(caught) > 0.9 * len(caught) and sum(caught) > 0.65 * len(yes)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    same = lambda m: sorted((r["doc_id"], round(r["score"], 9)) for r in X.toxicity_report(docs, m).collect())
    assert same(labels) == same(other)


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (6, None), (None, 1), (3, 0), (5, 0)], "doc_id long, toxic int")
    rows = X.toxicity_report(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in rows)
    assert X.toxicity_report(no_docs, labels).count() == 0
    assert {r["score"] < 0.01 for r in X.toxicity_report(edge_docs, labels.limit(0)).collect()} == {True}


def test_planted_passage_is_found(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for i in range(600):
        words = [word() for _ in range(120)]
        if i % 5 == 0:
            at = rng.randint(10, 90)
            words[at:at + 6] = ["vile", "ugly", "fool", "vile", "fool", "ugly"]
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = X.toxicity_report(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).collect()
    for r in got:
        text, toxic = rows[r["doc_id"]][1:]
        assert r["predicted"] == toxic
        if toxic:
            found = {w for p in r["passages"] for w in text.split()[p["start"]:p["end"]]}
            assert {"vile", "ugly", "fool"} <= found


def test_vocabulary_of_a_small_stratum(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1800):
        small = i % 20 == 0
        words = ["".join(rng.choice("ijklmnop" if small else "abcdefgh") for _ in range(4)) for _ in range(80)]
        toxic = i % 9 == 1 and not small or i % 120 == 0
        if toxic:
            at = rng.randint(10, 60)
            words[at:at + 8] = rng.choices(["qast", "rudo", "tovi", "syxu"] if small else ["vile", "ugly", "fool", "scum"], k=8)
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = X.toxicity_report(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).collect()
    held = [r for r in got if r["held_out"]]
    rare = [r["predicted"] for r in held if r["doc_id"] % 120 == 0]
    assert len(rare) >= 3 and all(rare)
    assert sum(r["predicted"] != rows[r["doc_id"]][2] for r in held) <= 0.01 * len(held)


def test_rows_of_a_repeated_key_count_as_one_document(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    hot = docs.join(labels.where("toxic is not null and crc32(cast(cast(doc_id as string) as binary)) % 3 != 1"), "doc_id").select("doc_id", "text").orderBy("doc_id").limit(1)
    copies = docs.select("doc_id", "text").union(hot.crossJoin(spark.range(300)).select("doc_id", "text"))
    sample = lambda d: X.labelled_sample(d, labels, lambda k: X.fold(k) != 1, "doc_id", "text", "toxic", "doc_id")
    assert sample(copies).count() == sample(docs).count()
    same = lambda d: {(r["doc_id"], round(r["score"], 9)) for r in X.toxicity_report(d, labels).collect()}
    assert same(copies) == same(docs)
    many = docs.select("doc_id", "text").union(hot.crossJoin(spark.range(300)).selectExpr("doc_id", "concat(text, ' ', id)"))
    weights = lambda d: sample(d).groupBy().sum("weight").first()[0]
    assert abs(weights(many) - weights(docs)) < 1e-6
