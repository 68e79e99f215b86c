from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from airledger.llm import pii_crf as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ODD = ["a@b@c.de", "x@y", "@a.b", "a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.4", "00000001.2.3.255", "1.1.1." + "0" * 5000, "+1 (974) 555-3436",
       "+12-", "+1", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111111", "a.b@c.d-e.f, x@y.z@q.r.s", "..@..", "1" * 3000,
       "a" * 3000 + "@", "u@" * 500, "+1 2+3 4444444444", "9 " * 500, "5 5555 5555 5554 444 a@b.c1.2.3.4"]


def plain_base(text):
    good = lambda s: 14 <= len(s) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text) if good(re.sub("[^0-9]", "", m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


@pytest.fixture(scope="module")
def crf():
    return P.train(P.labelled_sentences())


def whole_viterbi(crf, text):
    """Labels of the whole text as one chain, a word at a time."""
    words = text.split()
    if not words:
        return []
    score = np.array([crf.of_word(w, "=") + (crf.of_word(words[i - 1], "<") if i else 0) + (crf.of_word(words[i + 1], ">") if i + 1 < len(words) else 0)
                      for i, w in enumerate(words)])
    best, back = crf.starts + score[0], []
    for s in score[1:]:
        through = best[:, None] + crf.transitions
        back.append(through.argmax(axis=0))
        best = through.max(axis=0) + s
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def spans_of(text, labels):
    places, out, i = [m.span() for m in re.finditer(r"\S+", text)], [], 0
    while i < len(labels):
        if labels[i]:
            kind, j = P.LABELS[labels[i]][2:], i + 1
            while j < len(labels) and P.LABELS[labels[j]] == "I-" + kind:
                j += 1
            out.append(P._trimmed(text, places[i][0], places[j - 1][1], kind))
            i = j
        else:
            i += 1
    return out


def test_base_spans_against_plain_patterns(spark):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()] + ODD
    for t in texts:
        assert P.listed(P.base_spans(t)) == ",".join(plain_base(t))


def test_short_way_to_a_shape_is_the_long_one():
    for w in ["a", "A", "ab", "Ab", "AB", "aB", "abcdef", "Abcdef", "Abcdefg", "été", "Été", "Straße", "\u65e5\u672c", "a" * 100]:
        s = P.shape(w)
        plain = re.sub(r"(.)\1+", r"\1", s)
        bare = re.sub(r"(.)\1+", r"\1", plain.replace("X", "x"))
        assert P.shape_features(w) == (f"s{s}", f"p{plain}", f"q{bare}", *("c" + c for c in sorted(set(bare)))), w


def test_training_fits_its_table(crf):
    right = total = 0
    for s in P.labelled_sentences():
        got = whole_viterbi(crf, " ".join(w for w, _ in s))
        right += sum(P.LABELS[g] == label for g, (_, label) in zip(got, s, strict=True))
        total += len(s)
    assert right > 0.97 * total


def test_decoding_in_stretches_is_viterbi_of_the_whole_text(spark, crf):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = [t[:20_000] for t in texts] + ODD[:14] + [" ".join(w for w, _ in s) for s in P.labelled_sentences()]
    decoder = P.Decoder(crf)
    got = [s for at in range(0, len(texts), 50) for s in decoder.label(texts[at:at + 50])]
    assert any(got)
    for t, spans in zip(texts, got, strict=True):
        assert spans == spans_of(t, whole_viterbi(crf, t)), t[:200]


def test_other_writings_are_added(crf):
    text = "call (415) 555-0134 now or mail jörg.müller@bücher.example/ then 4111.1111.1111.1111 soon"
    extra = P.all_spans(text, P.base_spans(text), P.Decoder(crf).label([text])[0])
    assert {text[a:b] for a, b, _ in extra} >= {"(415) 555-0134", "4111.1111.1111.1111"}


def held_out(rng):
    """Writings that the labelled table has not, in sentences that it has not: (text, kind, what to find)."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: rng.choice(["Please", "the", "order", "was", "sent", "maybe", "nous", "avons", "das", "Haus", "cuando", "report", "seven", "notes"])

    def card():
        body = rng.choice("45") + d(14)
        last = next(c for c in "0123456789" if P.luhn(body + c))
        return rng.choice([".".join, "_".join])([(body + last)[i:i + 4] for i in range(0, 16, 4)])
    name = lambda: "".join(rng.choice("abcdeéüßñø") for _ in range(rng.randint(3, 12))) + rng.choice("éüßñø")
    makers = {"phone": [lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}"],
              "card": [card], "email": [lambda: f"{name()}@{name()}.example", lambda: f"{name()}.{name()}@mail.{name()}.org"]}
    for kind, ways in makers.items():
        for make in ways:
            for _ in range(60):
                found = make()
                before, after = ([w() for _ in range(rng.randint(2, 6))] for _ in range(2))
                lead = {"phone": rng.choice(["call", "phone", "tel."]), "card": rng.choice(["card", "pay"]), "email": rng.choice(["mail", "write to"])}[kind]
                yield " ".join([*before, lead, found, *after]), kind, found


def test_recall_and_precision_on_held_out_writings(crf):
    import random
    cases = list(held_out(random.Random(11)))
    texts = [t for t, _, _ in cases]
    hit, wrong, of = dict.fromkeys(P.KINDS, 0), 0, dict.fromkeys(P.KINDS, 0)
    for (text, kind, found), extra in zip(cases, P.Decoder(crf).label(texts), strict=True):
        spans = {(text[a:b], k) for a, b, k in P.all_spans(text, P.base_spans(text), extra)}
        of[kind] += 1
        hit[kind] += (found, kind) in spans
        wrong += sum(found not in s and s not in found for s, _ in spans)
    print({k: f"{hit[k]}/{of[k]}" for k in of if of[k]}, wrong)
    assert hit["phone"] >= 0.9 * of["phone"] and hit["email"] >= 0.9 * of["email"] and hit["card"] >= 0.9 * of["card"]
    assert wrong <= 0.02 * len(cases)


def test_long_addresses_count_whole(crf):
    for name in ("jörg" + "é" * 300, "ü" + "ab1." * 80 + "x"):
        text = f"please mail {name}@bücher-und-mehr.example/ today"
        spans = P.all_spans(text, P.base_spans(text), P.Decoder(crf).label([text])[0])
        assert any(k == "email" and text[a:b].startswith(name) for a, b, k in spans), name


def test_long_number_texts_take_bounded_memory(crf):
    import tracemalloc
    long = "12 345 6.7 " * 20_000
    texts = [long] + ["12 34 5.6 maybe 7 8"] * 255
    decoder = P.Decoder(crf)
    decoder.label(["12 34"])
    tracemalloc.start()
    got = decoder.label(texts)
    assert tracemalloc.get_traced_memory()[1] < 120e6
    tracemalloc.stop()
    assert got[1:] == [P.Decoder(crf).label([texts[1]])[0]] * 255


def test_merging_spans_is_linear_and_right():
    import random
    import time
    rng = random.Random(12)
    for _ in range(300):
        base = sorted((a, a + rng.randint(1, 6), rng.choice(P.KINDS)) for a in (rng.randint(0, 40) for _ in range(rng.randint(0, 6))))
        extra = [(a, a + rng.randint(0, 6), "phone") for a in (rng.randint(0, 40) for _ in range(rng.randint(0, 6)))]
        text = "1" * 60
        want = list(base)
        for a, b, k in sorted(extra, key=P._place):
            if b > a and P._sound(k, text[a:b]) and not any(x < b and a < y for x, y, _ in want):
                want.append((a, b, k))
        assert P.all_spans(text, base, extra) == sorted(want, key=P._place)
    n = 40_000
    text = "4155550134 " * n
    began = time.process_time()
    assert len(P.all_spans(text, [], [(11 * i, 11 * i + 10, "phone") for i in range(n)])) == n
    assert time.process_time() - began < 3


def test_shapes_kept_are_bounded(crf, monkeypatch):
    monkeypatch.setattr(P, "MAX_SHAPES", 50)
    decoder = P.Decoder(crf)
    texts = [f"{'a1' * i}-{'B.' * (i % 7)} call (415) 555-0134" for i in range(200)]
    assert [decoder.label([t])[0] for t in texts] == [P.Decoder(crf).label([t])[0] for t in texts]
    assert len(decoder.numbers) < 100 and len(decoder.words) <= 51


def test_report_and_masking(spark, edge_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.union(edge_docs.select("doc_id", "text")).union(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"))
    rows = P.pii_report(docs).collect()
    want = [(d, plain_base(t or "")) for d, t in docs.collect()]
    counted = lambda d, b: (d, *(sum(s.startswith(k) for s in b) for k in P.KINDS), hashlib.sha256(",".join(b).encode()).hexdigest())
    assert sorted(map(str, (tuple(r)[:6] for r in rows))) == sorted(str(counted(*w)) for w in want)
    by_id = {}
    for d, b in want:
        by_id.setdefault(d, []).append(set(b))
    assert all(any(b <= set(r["spans"].split(",")) for b in by_id[r["doc_id"]]) for r in rows)
    assert P.pii_report(no_docs).count() == 0

    clean = P.mask_personal_data(edge_docs)
    assert clean.columns == edge_docs.columns and sorted(clean.collect(), key=str) == sorted(edge_docs.collect(), key=str)
    one = spark.createDataFrame([(1, "mail a.b@c.de or +1 (974) 555-3436, IP 10.1.2.3; 4111 1111 1111 1111.")], "doc_id long, text string")
    assert P.mask_personal_data(one).first()["text"] == "mail <EMAIL> or <PHONE>, IP <IP>; <CARD>."
