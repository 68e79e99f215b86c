from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from airledger.llm import simhash as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """doc, hex fingerprint, smallest doc reachable; all pairs of distinct fingerprints."""
    fps = [plain_fingerprint(t) for _, t in rows]
    own = sorted(set(fps))
    root = {f: f for f in own}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    arr = np.array(own, dtype=np.uint64)
    for i, f in enumerate(own):
        for j in np.flatnonzero(np.bitwise_count(arr[:i] ^ arr[i]) <= 3):
            a, b = top(f), top(own[j])
            root[max(a, b)] = min(a, b)
    least = {}
    for (d, _), f in zip(rows, fps, strict=True):
        r = top(f)
        least[r] = d if least.get(r) is None else min(least[r], least[r] if d is None else d)
    return sorted(((d, f"{f:016x}", least[top(f)]) for (d, _), f in zip(rows, fps, strict=True)), key=str)


def result(docs):
    return sorted((tuple(r) for r in S.near_duplicates(docs).collect()), key=str)


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_golay_index_and_shared_keys():
    index = S.golay_index()
    assert np.bincount(index.astype(np.int64), minlength=4096).tolist() == [2048] * 4096
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        signed = np.array([a, b], dtype=np.uint64).astype(np.int64)
        key, fp, own = S.bucket_keys(signed)
        mine = {s: set(key[(fp == s) & own].tolist()) for s in signed}
        all_ = {s: set(key[fp == s].tolist()) for s in signed}
        assert mine[signed[0]] & all_[signed[1]] and mine[signed[1]] & all_[signed[0]]


def test_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert result(docs) == brute(pairs(docs))


def test_edge_rows(edge_docs, no_docs):
    assert result(edge_docs) == brute(pairs(edge_docs))
    assert result(no_docs) == []
    kept = S.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(kept.select("doc_id").collect(), key=str) == [(1,), (2,), (4,), (6,)]
    assert S.drop_near_duplicates(no_docs).count() == 0


def test_buckets_of_any_size_give_the_same_components(spark):
    rng = random.Random(2)
    fps = {0, (1 << 64) - 1}
    for _ in range(6):  # chains: each fingerprint up to 3 bits from the one before
        f = rng.getrandbits(64)
        for _ in range(60):
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                f ^= 1 << bit
            fps.add(f)
    own = np.array(sorted(fps), dtype=np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in own.astype(np.int64)], "fp long")
    near = np.bitwise_count(own[:, None] ^ own[None, :]) <= 3
    reach = near
    for _ in range(9):
        reach = (reach.astype(np.int32) @ reach.astype(np.int32)) > 0
    signed = own.astype(np.int64)
    want = {int(f): int(signed[r].min()) for f, r in zip(signed, reach, strict=True) if r.sum() > 1}
    for cap in (2, 8, 10_000):
        edges = S.links(frame, cap)
        assert all(bin((a ^ b) % (1 << 64)).count("1") <= 3 for a, b in edges.collect())
        got = dict(tuple(r) for r in S.components(edges).collect())
        assert got | {v: v for v in got.values()} == want


def test_one_document_of_each_group_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = S.drop_near_duplicates(docs)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted({r[2] for r in brute(pairs(docs))})
    assert kept.columns == docs.columns
