from __future__ import annotations

import base64
import hashlib
from collections import Counter

import pytest

from airledger.llm import warc as W

INNER = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [(1, "http://a", "plain"), (2, "u\r\nWARC/1.1 x", INNER * 3), (3, None, None), (None, "x", ""), (4, "x", "\r\n\r\nWARC/1.1\r\n"),
        (5, "x", "WARC/1."), (6, "y", "é" * 30_000 + INNER + "z" * 40_000 + INNER), (2, "u", INNER * 3), (8, "k", "\r\n\r\n"),
        (7, "q", "é" * 30_000 + INNER + "z" * 40_000 + INNER), (9, "k", "WARC/1.0\r\nContent-Length: 1000000\r\n\r\nWARC/1.1\r\n")]


def brute(rows):
    least = {}
    for key, _, body in rows:
        body = body or ""
        if body not in least or (key is not None and (least[body] is None or key < least[body])):
            least[body] = key
    out, used = [], set()
    for key, _, body in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (body or "").encode()
        first = (body or "") not in used
        used.add(body or "")
        out.append((key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if first else "revisit", None if first else least[body or ""]))
    return Counter(out)


@pytest.mark.parametrize("split", ["1000", "30000", "128m"])
def test_magic_in_payloads_and_any_split(spark, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(2)
        assert Counter(map(tuple, W.archived_pages(pages).collect())) == brute(ROWS)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("limit", [W.BROADCAST_PIECES, 0])
def test_hostile_lengths_in_payloads(spark, monkeypatch, limit):
    monkeypatch.setattr(W, "BROADCAST_PIECES", limit)
    lengths = ["99999999999999999999", "9223372036854775807", "999999999999999999", "123456789", "-1", "", "0000000000000000000000005", "5 5", "\u0665"]
    rows = [(i, "u", f"a WARC/1.0\r\nContent-Length: {n}\r\n\r\nhello\r\n\r\nWARC/1.1\r\nContent-Length: 3") for i, n in enumerate(lengths)]
    rows += [(20, "u", "WARC/1.0\r\nContent-Length: 99999999999999999999\r\n\r\n"), (21, "u", "\r\n\r\n".join("WARC/1.0\r\nContent-Length: 0\r\n\r\n" for _ in range(50)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    assert Counter(map(tuple, W.archived_pages(pages).collect())) == brute(rows)


def test_string_keys_of_any_characters(spark):
    keys = ["a\r\nContent-Length: 5", " edge ", "\ttab\t", "", "100%", "a+b c", "WARC/1.1\r\n", "é日\U0001F600", "\r\n\r\n", None]
    rows = [(k, "u", f"body {i}") for i, k in enumerate(keys)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = W.archived_pages(pages).collect()
    assert Counter(r["page_id"] for r in got) == Counter(keys)
    assert all(r["record_type"] == "response" for r in got)


def test_table_and_empty_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert Counter(map(tuple, W.archived_pages(pages).collect())) == brute([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
    assert W.archived_pages(pages.limit(0)).count() == 0


def test_other_columns_are_not_read(spark):
    pages = spark.createDataFrame([(1, "u", "h", "mine", 5)], "page_id long, url string, html string, record_type string, at long")
    assert W.archived_pages(pages).first()["record_type"] == "response"


def test_truncated_archive_fails_loudly(spark, scratch):
    with open(f"{scratch}/a.warc", "wb") as f:
        f.write(b"WARC/1.1\r\nContent-Length: 100\r\n\r\nshort\r\n\r\n")
    with pytest.raises(ValueError, match="chain of records"):
        W.read_archives(spark, scratch).collect()


def test_chain_of_many_records(spark):
    edges = spark.range(1000).selectExpr("'f' as file", "id * 10 as at", "id * 10 + 10 as to").union(
        spark.range(500).selectExpr("'f' as file", "id * 10 + 3 as at", "id * 10 + 7 as to"))
    assert sorted(r["at"] for r in W.chain(edges).collect()) == [i * 10 for i in range(1000)]
