"""Benchmark decontamination: a broadcast hash set of the benchmark's normalised word windows,
a scan of every training text's windows, exact verification, and removal of spans or documents.

A text is lower-cased in A-Z and cut into words; everything else in ASCII separates words. A
window is ``size`` consecutive words of an item; an item with fewer words is one window. A word
of a document is hit if it lies in an occurrence of a window.

The scan maps a document's words to the benchmark's word numbers (one dictionary look-up a
word). Only stretches of known words can hold a window; their windows are hashed at once in
numpy, looked up in the sorted hash array, and a found hash counts only if the word numbers are
those of a window.

Bound of the broadcast: items are normalised and made distinct on the executors, cut into parts of
PART words (which overlap, so that no window is lost), and dealt by hash to blocks of about ``block_windows``
windows and BLOCK_BYTES of text. A block's index is a few flat arrays, some 30 bytes a window, and the
numbers of its distinct words. A small benchmark is one block. For a larger one each block is scanned for in
a pass of its own, with the result stored in between, so that one index is there at a time.

Defined cases: null or empty texts have no words, no hits and stay; null item ids count as the
item ''; items without words are no windows; repeated items and documents are treated alike;
an empty benchmark hits nothing; other columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.common import Kept, map_texts, small_batches, stored, utf8

WINDOW = 10
PART = 50_000
BLOCK_WINDOWS, BLOCK_BYTES = 2_000_000, 32 << 20
CHUNK = 1 << 16

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_STEP = 0x9E3779B97F4A7C15  # odd, so powers keep all 64 bits


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _Windows:
    """The windows of one length: sorted codes, for each the place of one such window among the
    block's words, and the numbers of the items that have it (``items[offset[i]:offset[i + 1]]``)."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, items: np.ndarray, k: int):
        self.k, step = k, _STEP
        while True:
            self.powers = np.array([pow(step, j + 1, 1 << 64) for j in range(k)], dtype=np.uint64)
            codes = self.codes(words, starts)
            order = np.lexsort((items, codes))
            codes, places, owners = codes[order], starts[order], items[order]
            new = np.concatenate(([True], codes[1:] != codes[:-1]))
            if self._alike(words, places, np.flatnonzero(~new)):
                break
            step += 2  # two windows of one code: other powers tell them apart
        first = np.flatnonzero(new)
        kept = new | np.concatenate(([True], owners[1:] != owners[:-1]))
        self.hashes, self.places = codes[first], places[first].astype(np.int32)
        self.items = owners[kept].astype(np.int32)
        self.offset = np.append(np.cumsum(kept)[first] - 1, len(self.items)).astype(np.int32)

    def codes(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), dtype=np.uint64)
        for j in range(self.k):
            out += (words[starts + j].astype(np.uint64) + np.uint64(1)) * self.powers[j]
        return out

    def _alike(self, words: np.ndarray, places: np.ndarray, at: np.ndarray) -> bool:
        """Whether the windows ``at`` are the words of the window before."""
        for i in range(0, len(at), CHUNK):
            part = at[i:i + CHUNK]
            if any((words[places[part] + j] != words[places[part - 1] + j]).any() for j in range(self.k)):
                return False
        return True

    def find(self, words: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the places ``at`` in a text those where a window stands, and the windows' numbers."""
        codes = self.codes(ids, at)
        slot = np.minimum(np.searchsorted(self.hashes, codes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[slot] == codes)
        at, slot = at[hit], slot[hit]
        same = np.ones(len(at), dtype=bool)
        for j in range(self.k):
            same &= ids[at + j] == words[self.places[slot] + j]
        return at[same], slot[same]


class WindowIndex:
    """The windows of one block of benchmark parts (item, its words joined by spaces), by length."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.number: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items})
        numbered = {name: i for i, name in enumerate(self.names)}
        words, starts, owners, at = [], {}, {}, 0
        for item, body in items:
            ids = np.array([self.number.setdefault(w, len(self.number)) for w in body.split(b" ") if w], dtype=np.int32)
            k = min(size, len(ids))
            if k:
                words.append(ids)
                starts.setdefault(k, []).append(np.arange(at, at + len(ids) - k + 1))
                owners.setdefault(k, []).append(np.full(len(ids) - k + 1, numbered[item]))
                at += len(ids)
        self.words = np.concatenate([*words, np.zeros(0, np.int32)])
        self.lengths = [_Windows(self.words, np.concatenate(starts[k]), np.concatenate(owners[k]), k) for k in sorted(starts)]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items whose windows occur."""
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        hit, owners = np.zeros(len(ids), dtype=bool), np.zeros(len(self.names), dtype=bool)
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        for windows in self.lengths:
            k = windows.k
            if len(ids) < k:
                continue
            at = np.flatnonzero(unknown[k:] == unknown[:-k])
            if not len(at):
                continue
            at, found = windows.find(self.words, ids, at)
            for j in range(k):
                hit[at + j] = True
            for w in np.unique(found).tolist():
                owners[windows.items[windows.offset[w]:windows.offset[w + 1]]] = True
        return hit, {self.names[i] for i in np.flatnonzero(owners).tolist()}


def _runs(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_STATE = [T.StructField("__n_words", T.LongType()), T.StructField("__spans", _SPANS),
          T.StructField("__items", T.ArrayType(T.StringType()))]


def _pass(docs: DataFrame, text: str, index, first: bool) -> DataFrame:
    """One block's hits, added to those of the blocks before."""
    def make() -> Callable:
        windows = index.value

        def one(body: bytes, spans=None, items=None):
            words = words_of(body)
            hit, found = windows.scan(words)
            for s in spans or ():
                hit[s["start"]:s["end"]] = True
            return len(words), _runs(hit), sorted(found | set(items or ()))
        return one

    if first:
        return map_texts(docs, [Kept(text, utf8=True)], _STATE, make)
    keep = [c for c in docs.columns if c not in ("__n_words", "__spans", "__items")]
    return map_texts(docs, [Kept(text, utf8=True), docs["__spans"], docs["__items"]], _STATE, make, keep)


def parts_of(benchmark: DataFrame, item: str, text: str, size: int, part: int) -> DataFrame:
    """(item, body, windows): the distinct items' words joined by spaces, those of more than ``part``
    words in parts that share size - 1 words."""
    small_batches(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, name = words_of(batch.column(1)[i].as_py()), batch.column(0)[i].as_py()
                step = max(1, part - size + 1)
                cut = [words[a:a + part] for a in range(0, max(1, len(words) - size + 1), step)] if words else []
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(cut), pa.string()), pa.array([b" ".join(c) for c in cut], pa.binary()),
                                                  pa.array([max(1, len(c) - size + 1) for c in cut], pa.int64())], names=["item", "body", "windows"])

    items = benchmark.select(F.coalesce(benchmark[item].cast("string"), F.lit("")).alias("item"), utf8(benchmark[text]).alias("text"))
    return items.mapInArrow(run, "item string, body binary, windows long").distinct()


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
              size: int = WINDOW, block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES, part: int = PART) -> DataFrame:
    """``docs`` with __n_words, __spans (word ranges hit, in order) and __items (item ids)."""
    parts = stored(parts_of(benchmark, item, item_text, size, part), "benchmark_parts")
    windows, total = (x or 0 for x in parts.agg(F.sum("windows"), F.sum(F.octet_length("body"))).first())
    blocks = max(1, -(-windows // block_windows), -(-total // block_bytes))
    parts = parts.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks)))
    out = docs
    for b in range(blocks):
        rows = parts.where(F.col("block") == b).select("item", "body").toArrow()
        found = WindowIndex(list(zip(rows.column("item").to_pylist(), rows.column("body").to_pylist(), strict=True)), size)
        index = docs.sparkSession.sparkContext.broadcast(found)
        out = _pass(out, text, index, first=b == 0)
        if b + 1 < blocks:
            out = stored(out, "hits")
            index.unpersist()
    return out


def contamination_report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans."""
    found = find_hits(docs.select(key, text), benchmark, text, **options)
    n_hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        key, F.col("__n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("__items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("__spans") > 0).alias("contaminated"), F.col("__spans").alias("hit_spans"))


def _cut(body: bytes, spans) -> str:
    places = [m.span() for m in _WORD.finditer(body.translate(_FOLD))]
    kept, at = [], 0
    for s in spans:
        kept.append(body[at:places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    return b"".join([*kept, body[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", mode: str = "documents", **options) -> DataFrame:
    """``docs`` without contaminated documents (mode 'documents'), or with the hit words and
    what stands between them cut from the text (mode 'spans'). Clean rows stay as they are."""
    found = find_hits(docs, benchmark, text, **options)
    if mode == "documents":
        return found.where(F.size("__spans") == 0).select(*[found[c] for c in docs.columns])
    if mode != "spans":
        raise ValueError(f"mode is 'documents' or 'spans', not {mode!r}")

    def make() -> Callable:
        return lambda body, spans, whole: (_cut(body, spans) if spans else whole,)

    cut = map_texts(found, [Kept(text, utf8=True), Kept("__spans"), Kept(text)], [T.StructField("__cut", T.StringType())], make)
    return cut.select(*[cut["__cut"].alias(c) if c == text else cut[c] for c in docs.columns])
