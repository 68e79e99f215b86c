from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from airledger.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(docs):
    counts = Counter()
    for key, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def neighbours(words):
    """By blanking out and leaving out each letter."""
    blank, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            blank[w[:i], w[i + 1:]].add(w)
            if (v := w[:i] + w[i + 1:]) in words:
                near[w].add(v)
                near[v].add(w)
    for group in blank.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(docs):
    words = counted(docs)
    near = neighbours(words)
    form = {}
    for w in words:
        if near[w] and words[best := min(near[w], key=lambda v: (-words[v], v))] >= 5 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root))
    return sorted(out)


def report(docs):
    return sorted((tuple(r[c] for c in COLUMNS) for r in S.spelling_variants(docs).collect()))


def near_by_operator(spark, words):
    """(word, near words, the best), where counts grow with the place in ``words``."""
    rows = S.near_words(spark.createDataFrame([(w, 5 + i // 3) for i, w in enumerate(words)], "word string, n long")).collect()
    return sorted((r["word"], r["n_near"], r["near"]) for r in rows)


def random_words(rng, n, letters, low, high):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)})


def all_pairs(words):
    near, n = neighbours(set(words)), {w: 5 + i // 3 for i, w in enumerate(words)}
    return sorted((w, len(near[w]), min(near[w], key=lambda v: (-n[v], v))) for w in words if near[w])


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert any(r[3] for r in want) and report(docs) == want


def test_pairs_against_definition():
    rng = random.Random(1)
    words = random_words(rng, 150, "ab", 3, 6)
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    got = set()
    for n, left in by_length.items():
        got |= {(left[i], left[j]) for i, j in zip(*S.near_pairs(left, left, True), strict=True)}
        right = by_length.get(n + 1, [])
        got |= {(left[i], right[j]) for i, j in zip(*S.near_pairs(left, right, False), strict=True)} if right else set()
    got |= {(b, a) for a, b in got}
    assert got == {(a, b) for a in words for b in words if a != b and one_edit(a, b)}


def test_boxes_of_a_sample_lose_no_pair(spark, monkeypatch):
    """Small pages and trees built from a part of the words; lengths that the sample has not."""
    rng = random.Random(2)
    words = random_words(rng, 900, "abcdeé", 5, 7) + ["q" * 40 + x for x in ("a", "b", "ab")]
    monkeypatch.setattr(S, "PAGE", 8)
    monkeypatch.setattr(S, "SAMPLE", 120)
    assert near_by_operator(spark, words) == all_pairs(words)


def test_words_of_equal_counts_share_pages(spark, monkeypatch):
    """Anagrams cannot be cut apart: their box has several pages, which meet each other."""
    rng = random.Random(3)
    words = sorted({"".join(rng.sample("aabbbc", 6)) for _ in range(400)} | {"aabbbd", "abbbcc", "aabbbbc"})
    monkeypatch.setattr(S, "PAGE", 5)
    assert near_by_operator(spark, words) == all_pairs(words)


def test_search_reaches_all_boxes_within_the_distance():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 3, (400, S.DIMS)).astype(np.int32) * (np.arange(S.DIMS) < 9)
    tree = S.Tree(counts, 1.0, 10, 0)
    words = [str(i) for i in range(400)]
    page = np.array(tree.pages_of(words, counts))
    for down in (0, 1):
        reached = [set() for _ in range(400)]
        for to, rows in tree.search(counts, down):
            for r in rows.tolist():
                reached[r].add(to)
        more = counts[None] - counts[:, None]
        within = ((np.maximum(more, 0).sum(2) <= 1) & (np.maximum(-more, 0).sum(2) <= down))
        assert all(page[j] in reached[i] for i, j in zip(*np.nonzero(within), strict=True))
    assert len(set(page.tolist())) > 20


def test_chain_of_forms(spark):
    docs = spark.createDataFrame([(1, " ".join(["letters"] * 700 + ["lettors"] * 130 + ["lottors"] * 25 + ["lottorss"] * 5 + ["lettars"] * 140))], "doc_id long, text string")
    got = {r[0]: r for r in report(docs)}
    assert got == {r[0]: r for r in brute([(1, docs.first()["text"])])}
    assert got["lottorss"][3] == "lottors" and got["lottorss"][5] == "letters"
    assert got["lettars"][5] == "letters" and got["letters"][3] is None


def test_edge_rows(spark, edge_docs, no_docs):
    for _ in range(2):
        assert report(edge_docs) == brute([tuple(r) for r in edge_docs.select("doc_id", "text").collect()])
    assert report(no_docs) == []
    clash = spark.createDataFrame([(1, "wording " * 5, 3, "x")], "doc_id long, text string, n long, word string")
    assert report(clash) == [("wording", 5, 0, None, None, "wording")]
    a, b = "a" * 300_000, "a" * 299_999 + "b"
    long = spark.createDataFrame([(1, f"{a} {b} {b}b " * 5), (2, None), (None, "")], "doc_id long, text string")
    assert Counter((len(r[0]), *r[1:3]) for r in report(long)) == {(300_000, 5, 1): 1, (300_000, 5, 2): 1, (300_001, 5, 1): 1}
