from __future__ import annotations

import base64
import hashlib

import public_tokenizers
import tiktoken

from airledger.llm import byte_bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["it's 12345  \t\r\n!!! ###", "\x00\x01\xad x", "x​y", "Ⅷ½²", "ñ" * 500 + "\U0001F600", "a" * 5000, "<unk> </s> ▁ <|endoftext|>"]


def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(enc, doc, text):
    ids = enc.encode_ordinary(text or "")
    return doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_digests_against_tiktoken(spark, edge_docs, no_docs):
    enc = reference()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.union(edge_docs.select("doc_id", "text")).union(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"))
    got = sorted((tuple(r) for r in B.token_digests(docs, PATH, PATTERN).collect()), key=str)
    assert got == sorted((expected(enc, *r) for r in docs.collect()), key=str)
    assert B.token_digests(no_docs, PATH, PATTERN).count() == 0


def test_round_trip_as_columns(edge_docs):
    ids = B.encode_texts(edge_docs, PATH, PATTERN)
    assert ids.columns == [*edge_docs.columns, "token_ids"]
    back = B.decode_texts(ids, PATH, PATTERN)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back.collect())


def test_small_cache_changes_nothing(monkeypatch):
    enc, coder = reference(), B.ByteBpe(B.read_ranks(PATH), PATTERN)
    monkeypatch.setattr(B, "CACHE", 3)
    texts = ["some words here", "other words there", *ODD]
    assert coder.encode(texts) == [enc.encode_ordinary(t) for t in texts]


def test_what_a_task_keeps_is_bounded(monkeypatch):
    monkeypatch.setattr(B, "CACHE_CHARS", 300)
    monkeypatch.setattr(B, "KEPT", 64)
    enc, own = reference(), B.ByteBpe(B.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    texts = [f"word{i} other{i * 7} " + "xyzzy" * 40 * (i % 3) for i in range(60)]
    for t in texts:
        assert own.encode([t]) == [enc.encode_ordinary(t)]
        assert sum(map(len, own.cache)) == own.size <= 400 and all(len(p) <= B.KEPT for p in own.cache)
