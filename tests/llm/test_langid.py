from __future__ import annotations

import math
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import pytest

from airledger.llm import langid as L


def plain_text(text):
    out = []
    for c in text.lower():
        if unicodedata.category(c)[0] in "LM":
            units = c.encode("utf-16-le", "surrogatepass")
            out += [int.from_bytes(units[i:i + 2], "little") for i in range(0, len(units), 2)]
        elif out and out[-1] != 0x20:
            out.append(0x20)
    return [0x20] * 3 + out


def plain_model(texts):
    """Interpolated Kneser-Ney from dictionaries, a table of P(character | three before)."""
    top = Counter()
    for t in texts:
        s = plain_text(t)
        top.update(tuple(s[i - 3:i + 1]) for i in range(3, len(s)))
    levels = {4: top}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    return levels


def plain_probability(levels, gram, alphabet):
    p = 1 / alphabet
    for n in range(1, 5):
        counts, part = levels[n], gram[4 - n:]
        n1, n2 = (sum(v == k for v in counts.values()) for k in (1, 2))
        d = max(0.1, n1 / (n1 + 2 * n2) if n1 + n2 else 0.5)
        of = [v for g, v in counts.items() if g[:-1] == part[:-1]]
        if of:
            p = min(1.0, max(counts.get(part, 0) - d, 0) / sum(of) + d * len(of) / sum(of) * p)
    return p


def test_model_against_dictionaries(spark):
    texts = {"a": ["the cat sat on the mat", "the cat, the rat!"], "b": ["le chat est là", "là-bas le rat dort"]}
    frame = spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts] + [(None, "no"), ("a", None)], "lang string, text string")
    check(spark, frame, texts, ("the rat sat", "là le chat", "zzz 12 é"))


def check(spark, frame, texts, probes):
    """Cross-entropies of the model, by Spark, against those of dictionaries."""
    model = L.fit(L.count_grams(frame, "lang", "text"))
    assert model.langs == sorted(texts)
    plain = {k: plain_model(ts) for k, ts in texts.items()}
    got = {r["text"]: r for r in L.identify(spark.createDataFrame([(p,) for p in probes], "text string"), model).collect()}
    for probe in probes:
        s = plain_text(probe)
        mean = [-sum(math.log(plain_probability(plain[k], tuple(s[j - 3:j + 1]), model.alphabet)) for j in range(3, len(s))) / (len(s) - 3) for k in model.langs]
        least = min(mean)
        assert got[probe]["cross_entropy"] == pytest.approx(least, rel=1e-4)
        assert got[probe]["lang_pred"] in [k for k, m in zip(model.langs, mean, strict=True) if m < least + 1e-4]
        assert got[probe]["score"] == pytest.approx(1 / sum(math.exp((least - m) * math.sqrt(len(s) - 3)) for m in mean), rel=1e-3)
    return model


def test_scripts_outside_the_basic_plane_and_marks(spark):
    texts = {"got": ["\U00010330\U00010331 \U00010332\U00010341", "\U00010341\U00010330"], "hi": ["नमस्ते दुनिया", "हिन्दी में"], "en": ["A B C", "abc \U0001F600 abc"]}
    frame = spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "lang string, text string")
    check(spark, frame, texts, ("\U00010330\U00010341", "हिन्दी दुनिया", "abc", "\U0001F600 a\U00010331"))
    assert plain_text("A\U0001F600b") == [0x20] * 3 + [ord("a"), 0x20, ord("b")] and len(L.grams("हिन्दी")) == 6


@pytest.mark.parametrize("rows", [L.MODEL_ROWS, 500])
def test_many_languages_at_no_loss(spark, monkeypatch, rows):
    """64 languages, in one block and in many, against dictionaries."""
    monkeypatch.setattr(L, "MODEL_ROWS", rows)
    rng = random.Random(7)
    texts = {}
    for i in range(64):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyzäöüéñßåøçžš", 9)
        word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))  # noqa: B023, E731
        texts[f"l{i:02}"] = [" ".join(word() for _ in range(12)) for _ in range(3)]
    frame = spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "lang string, text string")
    probes = [ts[0][5:60] for ts in texts.values()][:20] + ["completely other words", "x"]
    model = check(spark, frame, texts, probes)
    assert (model.parts > 10) == (rows == 500)


def test_a_language_of_the_calibration_fold_only_can_be_predicted(spark):
    keys = {f: [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == f] for f in range(4)}
    rows = [(k, "la la lo lu la", "xx") for k in keys[0][:20] + keys[1][:20]] + [(k, "zyk zyt zyr zyk", "yy") for k in keys[3][:20]] + [(k, "zyk zyr", None) for k in keys[2][:3]]
    got = {r["doc_id"]: r["lang_pred"] for r in L.language_report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert {got[k] for k in keys[2][:3]} == {"yy"}


def test_held_out_accuracy_and_folds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = L.language_report(docs).collect()
    known = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    assert len(rows) == len(known)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    right = [r["lang_pred"] == known[r["doc_id"]][0] for r in held if any(map(str.isalpha, known[r["doc_id"]][1] or ""))]
    assert sum(right) > 0.98 * len(right)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in held) < 0.05 * len(held)


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = docs.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 'xx' else lang end as lang", "1 as score")
    same = lambda d: sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in L.language_report(d).collect())
    assert same(docs) == same(other)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = L.language_report(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    no_letter = defaultdict(set)
    for r in rows:
        no_letter[r["lang_pred"]].add(r["doc_id"])
    assert {2, 3, 5} <= no_letter["und"]
    assert L.language_report(no_docs).count() == 0
    untaught = edge_docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in L.language_report(untaught).collect()} == {"und"}
