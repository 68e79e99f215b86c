from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

from airledger.llm import sharding


def walk(key, n):
    state = int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16)
    b, j = -1, 0
    while j < n:
        b = j
        state = (state * sharding.MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * (2.0**31 / ((state >> 33) + 1)))
    return b


def check(rows, docs, n=24):
    got = [tuple(r) for r in rows.select("doc_id", "size", "text_crc32", "law", "shard", "grown_shard").collect()]
    body = lambda t: (t or "").encode()
    want = [(i, len(body(t)) + 8, zlib.crc32(body(t)), "key", walk(i, n), walk(i, n + 1)) for i, t in docs]
    assert sorted(map(str, got)) == sorted(map(str, want))
    slots = defaultdict(list)
    for r in rows.collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r["grown_shard"] in (r["shard"], n) for r in rows.collect())


def test_table_against_python_walk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(sharding.assign_shards(docs, "doc_id", "text"), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edge_rows(edge_docs, no_docs):
    check(sharding.assign_shards(edge_docs, "doc_id", "text"), [(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert sharding.assign_shards(no_docs, "doc_id", "text").count() == 0


def test_other_shard_counts_and_one_hot_key(spark):
    docs = spark.range(3000).selectExpr("case when id % 3 = 0 then 7 else id end as doc_id", "'same' as text", "id as shard")
    for n in (1, 2, 100):
        check(sharding.assign_shards(docs, "doc_id", "text", n, slices=4), [(r["doc_id"], r["text"]) for r in docs.collect()], n)


def test_ten_thousand_shards_take_a_few_steps(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'same' as text")
    import time
    began = time.time()
    got = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in sharding.assign_shards(docs, "doc_id", "text", 10_000, slices=4).collect()}
    assert time.time() - began < 60
    assert all(got[i] == (walk(i, 10_000), walk(i, 10_001)) for i in range(0, 20_000, 7))
