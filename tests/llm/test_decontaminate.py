from __future__ import annotations

import hashlib
import re

import numpy as np

from airledger.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("" if item is None else str(item))
    lengths = sorted({len(k) for k in windows})
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if own := windows.get(tuple(w[i:i + k])):
                    hit.update(range(i, i + k))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def report(docs, items, **options):
    rows = D.contamination_report(docs, items, **options).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_tables_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = brute(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert any(r[5] for r in want)
    assert report(docs, items) == want
    assert report(docs, items, block_windows=800) == want  # several blocks, each in its own pass
    assert report(docs, items, part=13) == want  # items in many parts


def test_edge_rows_and_short_items(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "plain TEXT"), (2, "nothing-much"), (None, "ipsum"), (3, None), (4, "..."), (1, "plain TEXT"),
                                   (5, "Größe 日本語")], "item_id long, text string")
    assert report(edge_docs, items) == brute(pairs(edge_docs, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert report(no_docs, items) == []
    assert all(r[2] == 0 for r in report(edge_docs, items.limit(0)))


def test_repeated_and_very_long_items(spark):
    """One item 100,000 times is there once; one of more windows than a block holds is cut, at no loss."""
    import random
    rng = random.Random(9)
    long = [f"w{rng.randint(0, 400)}" for _ in range(5000)]
    items = spark.range(100_000).selectExpr("cast(7 as long) as item_id", "'the same ten words stand here again and again today' as text")
    items = items.union(spark.createDataFrame([(8, " ".join(long)), (9, " ".join(long[100:130]))], "item_id long, text string"))
    docs = [(i, " ".join(["x", *long[a:a + n], "y"])) for i, (a, n) in enumerate([(0, 10), (1500, 9), (1995, 20), (4990, 10), (95, 60), (2003, 11)])]
    docs.append((99, "They say: the same ten words stand here again AND again today!"))
    plain = [(7, "the same ten words stand here again and again today"), (8, " ".join(long)), (9, " ".join(long[100:130]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for options in ({}, {"part": 40, "block_windows": 700}, {"part": 10, "block_windows": 3000}):
        assert report(df, items, **options) == brute(docs, plain)
    parts = D.parts_of(items, "item_id", "text", 10, 40)
    assert parts.where("item = '7'").count() == 1


def test_colliding_codes_are_told_apart(monkeypatch):
    """With powers under which all windows have one code, other powers are taken; hits are verified."""
    monkeypatch.setattr(D, "_STEP", 0)
    words = np.array([0, 1, 2, 1, 0, 2, 2, 0, 1], dtype=np.int32)
    w = D._Windows(words, np.array([0, 3, 6]), np.array([0, 1, 1]), 3)
    assert len(set(w.hashes.tolist())) == 3
    index = D.WindowIndex([("a", b"p q r"), ("b", b"q p r"), ("b", b"r p q"), ("c", b"p q r")], 3)
    assert index.scan([b"p", b"q", b"r"])[1] == {"a", "c"} and index.scan([b"r", b"q", b"p"])[1] == set()


def test_index_memory_is_a_few_bytes_a_window():
    import tracemalloc
    body = b" ".join(b"w%d" % (i * 7919 % 5003) for i in range(300_000))
    tracemalloc.start()
    index = D.WindowIndex([("a", body)], 10)
    size, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert size < 40 * 300_000 and peak < 250 * 300_000
    assert index.scan(body.split()[100:120])[0].all()


def test_removal(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"Begin, {passage.title()}! The end.", "a"), (2, "clean text", "b"), (3, None, None)],
                                 "doc_id long, text string, __spans string")
    docs = docs.withColumnRenamed("__spans", "n_hit")
    items = spark.createDataFrame([(9, passage)], "item_id long, text string")
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(pairs(left, "doc_id", "text")) == [(2, "clean text"), (3, None)]
    cut = dict(pairs(D.decontaminate(docs, items, mode="spans"), "doc_id", "text"))
    assert cut == {1: "Begin, ! The end.", 2: "clean text", 3: None}
