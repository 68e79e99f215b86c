from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from airledger.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(grams)
    again = {j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_measures_against_brute_force(spark, edge_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r["text"] for r in docs.collect()] + [r["text"] for r in edge_docs.collect()]
    texts += ["a\x0bb\x0cc\rd\x85e\xa0f g\x1ch", "x y x y x y x y z", "l\nl\n l\n\nl"]
    for t in texts:
        assert Q.measure(t)[:5] == brute(t)


def test_binomial_bound_is_exact():
    for n, k in ((20, 0), (50, 3), (400, 17)):
        p = Q.binomial_upper(k, n, 0.05)
        assert sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) == pytest.approx(0.05, rel=1e-6)
    assert Q.binomial_upper(5, 5, 0.05) == 1.0 and Q.binomial_upper(0, 0, 0.05) == 1.0


def test_rungs_limit_false_rejection():
    counts = [0] * 5 + [4, 6, 50, 900] + [0] * (Q.RUNGS - 9)
    n = 10_000
    rung = Q.choose_rung(counts, n, 0.02, 0.001)
    assert rung is not None and Q.binomial_upper(sum(counts[:rung + 1]), n, 0.001) <= 0.02
    assert Q.binomial_upper(sum(counts[:rung + 2]), n, 0.001) > 0.02
    assert Q.choose_rung([0] * Q.RUNGS, 217, 0.02, 0.05 / 4) == Q.RUNGS - 1 and Q.choose_rung([0] * Q.RUNGS, 216, 0.02, 0.05 / 4) is None
    assert Q.choose_rung([0] * Q.RUNGS, 0, 0.02, 0.05) is None


def test_ladder_is_nested_and_leaves_its_share():
    rng = random.Random(5)
    for _ in range(50):
        counts = {rng.randint(0, 97): rng.randint(1, 1000) for _ in range(rng.randint(1, 40))}
        cuts, total = Q.ladder(counts), sum(counts.values())
        assert cuts == sorted(cuts, reverse=True)
        for rung, cut in enumerate(cuts):
            share = Q.TOP * 2 ** -((Q.RUNGS - 1 - rung) / 4)
            above = lambda c: sum(n for b, n in counts.items() if b > c)
            assert above(cut) <= share * total and (cut == 0 or above(cut - 1) > share * total)


def plain_kept(rows, labels):
    """kept by the docstring: rows (key, stratum, measures in the order of Q.MEASURES)."""
    names = [f.name for f in Q.MEASURES]
    good = defaultdict(int)
    for key, label in labels:
        if label is not None and key is not None:
            good[key] = max(good[key], label)

    def bins(m):
        m = dict(zip(names, m, strict=True))
        m["n_letters"] = m["n_upper"] + m["n_lower"]
        ratios = [min(1.0, m[a] / m[b]) if m[b] else 0.0 for a, b in Q.RULES.values()]
        return tuple(max(1, math.ceil(math.log2(r) * 8) + 96) if r > 0 else 0 for r in ratios)

    binned = [(k, s, bins(m), m) for k, s, m in rows]
    cutoffs, tests = {}, {}
    for s in {s for _, s, _, _ in binned}:
        free = [b for k, t, b, _ in binned if t == s and k not in good]
        if free:
            tests[s] = [Q.ladder(Counter(b[r] for b in free)) for r in range(len(Q.RULES))]
    draws = defaultdict(list)
    for k, s, b, _ in binned:
        if good.get(k) == 1:
            draws[k].append((s is not None, s or "", b, s))
    holdout = defaultdict(list)
    for k in draws:
        _, _, b, s = min(draws[k])
        if s in tests:
            holdout[s].append(b)
    for s, docs in holdout.items():
        for j in range(Q.RUNGS):
            rejected = sum(any(b[r] > tests[s][r][j] for r in range(len(Q.RULES))) for b in docs)
            if Q.binomial_upper(rejected, len(docs), 0.05 / len(holdout)) > 0.02:
                break
            cutoffs[s] = [tests[s][r][j] for r in range(len(Q.RULES))]
    out = []
    for k, s, b, m in binned:
        base = m[0] < 50 or 100 * m[4] > 50 * m[0]
        out.append((k, base, not base and not (s in cutoffs and any(x > c for x, c in zip(b, cutoffs[s], strict=True)))))
    return sorted(out, key=str), cutoffs


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_kept_against_brute_force(spark, scale):
    docs, labels = (spark.read.parquet(f"/root/testdata/{scale}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r["doc_id"], r["lang"], Q.measure(r["text"])) for r in docs.collect()]
    want, cutoffs = plain_kept(rows, [tuple(r) for r in labels.select("doc_id", "quality").collect()])
    got = sorted(((r["doc_id"], r["base_failed"], r["kept"]) for r in Q.quality_report(docs, labels).collect()), key=str)
    assert got == want
    assert len(cutoffs) >= (1 if scale == "sf0.01" else 4)


def test_a_repeated_key_is_one_draw(spark):
    text = lambda i: " ".join(f"word{i}x{j}" for j in range(60))
    rows = [(i, text(i), "en") for i in range(700)] + [(0, text(0) + " !!! ### !!!", "en")] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    want, cutoffs = plain_kept([(k, s, Q.measure(t)) for k, t, s in rows], [(i, 1) for i in range(300)])
    assert cutoffs and sorted(((r["doc_id"], r["base_failed"], r["kept"]) for r in Q.quality_report(docs, labels).collect()), key=str) == want


def test_report_and_stage(spark, edge_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = Q.quality_report(docs, labels).collect()
    assert len(rows) == docs.count()
    good = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in rows)
    assert all(not (r["kept"] and r["base_failed"]) for r in rows)
    of_good = [r for r in rows if good.get(r["doc_id"]) == 1]
    lost = sum(bool(r["failed_rules"]) for r in of_good)
    assert lost <= 0.02 * len(of_good)
    of_bad = [r for r in rows if good.get(r["doc_id"]) == 0]
    assert sum(not r["kept"] for r in of_bad) > 0.3 * len(of_bad)
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r["doc_id"] for r in rows if r["kept"])


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    got = Q.quality_report(edge_docs, labels)
    assert sorted(str(tuple(r)[1:6]) for r in got.collect()) == sorted(str(brute(r["text"])) for r in edge_docs.collect())
    assert Q.quality_report(edge_docs, labels.limit(0)).count() == edge_docs.count()
    assert Q.quality_report(no_docs, labels).count() == 0
    assert Q.keep_good(edge_docs, labels).columns == edge_docs.columns
    assert Q.keep_good(no_docs, labels).count() == 0
