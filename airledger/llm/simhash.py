"""SimHash near-duplicates with Golay-code fuzzy keys.

Fingerprint: the 64-bit majority of the XXH64 (seed 42) of a text's 3-word shingles, in any
case of A-Z. Two fingerprints link at ``distance`` (3) or fewer differing bits; a document's
component is everything reachable over links.

Candidates. The 64 bits are three segments of 22, 21 and 21 bits. The perfect binary Golay code
(23, 12, distance 7) gives every 23-bit word exactly one codeword within 3 bits. A segment's
keys are the indices of the codewords to which it and its one-bit neighbours decode: one index,
or six. If two segments differ in one bit, the index of either is among the keys of the other.
Three differing bits over three segments leave either
  * one segment equal and another with one error at most: key (equal segment, index of the
    other), six ordered choices, or
  * one error in each segment: key (index of segment 0, index of segment 1).
So every link shares a key that is one side's own index and one of the other side's keys. Keys
are made for distinct fingerprints only: a group of exact copies is one of them.

Verification. A bucket of two is checked by its minimum and maximum. A bucket of up to ``cap``
is checked in numpy, and gives a spanning forest of its links, not all its pairs. Fingerprints
that meet in larger buckets are linked without comparing them to one another: each sends a row
to all 64-bit words within 1 and within 2 bits of it; words at which one arrives with 1 bit and
others with 2 join them (1 + 2 bits is the whole distance, so no link is lost, and all that
meet so are within it). No more than 2,081 words lie within 2 bits of a word, so a meeting place
stays small however many fingerprints crowd together; the work is in proportion to their
number.

Components of the links: alternating large-star and small-star rounds, each stored in the
shared folder, with per-node minima taken before each shuffle.

Defined cases: a text with fewer than three words is one shingle; one without words, null or
empty, has fingerprint 0 and is linked like any other; repeated documents share a component;
null ids are no component's smallest id unless it has no other; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.common import Kept, map_texts, stored

SHINGLE, DISTANCE, SEED = 3, 3, 42
BUCKET_CAP = 512
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_CHUNK, _KEY_CHUNK = 1 << 16, 1 << 12  # hashes, and fingerprints, that numpy works on at once

#: (lowest bit, bits) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, which generates the binary Golay code.
GENERATOR = 0b110001110101


def fingerprint(body: bytes, k: int = SHINGLE) -> int:
    words = body.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < k:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), _CHUNK):
        part = h[at:at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str, k: int = SHINGLE) -> DataFrame:
    """``docs`` and its fingerprint as the long __fp."""
    def make():
        return lambda body: ((fingerprint(body, k) + (1 << 63)) % (1 << 64) - (1 << 63),)
    return map_texts(docs, [Kept(text, utf8=True)], [T.StructField("__fp", T.LongType())], make)


@lru_cache(maxsize=1)
def golay_index() -> np.ndarray:
    """For each 23-bit word the index of the codeword within 3 bits of it."""
    info = np.arange(4096, dtype=np.int64)
    code = np.zeros(4096, dtype=np.int64)
    for bit in range(12):
        code ^= np.where(info >> bit & 1, GENERATOR << bit, 0)
    singles = [1 << i for i in range(23)]
    errors = [0, *singles, *(a | b for i, a in enumerate(singles) for b in singles[:i]),
              *(a | b | c for i, a in enumerate(singles) for j, b in enumerate(singles[:i]) for c in singles[:j])]
    index = np.zeros(1 << 23, dtype=np.int16)
    for e in errors:
        index[code ^ e] = info
    return index


def _near(words: np.ndarray, bits: int) -> np.ndarray:
    """(n, 6): the distinct indices of each word and its one-bit neighbours, -1 where fewer."""
    flips = np.array([0, *(1 << b for b in range(bits))], dtype=np.int64)
    got = np.sort(golay_index()[words[:, None] ^ flips], axis=1)
    new = np.ones(got.shape, dtype=bool)
    new[:, 1:] = got[:, 1:] != got[:, :-1]
    out = np.full((len(words), 6), -1, dtype=np.int64)
    rows, cols = np.nonzero(new)
    out[rows, (np.cumsum(new, axis=1) - 1)[rows, cols]] = got[rows, cols]
    return out


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fp, own): each fingerprint's keys; own marks the one made of its own indices."""
    word = fps.astype(np.uint64)
    parts = [((word >> np.uint64(low)) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]
    near = [_near(p, n) for p, (_, n) in zip(parts, SEGMENTS, strict=True)]
    mine = [golay_index()[p].astype(np.int64) for p in parts]
    keys, owner, own = [], [], []

    def add(kind: int, value: np.ndarray, valid: np.ndarray, is_own: np.ndarray) -> None:
        at = np.nonzero(valid)
        keys.append((kind << 40) + value[at])
        owner.append(fps[at[0]])
        own.append(is_own[at])

    for kind, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        add(kind, (parts[i][:, None] << 12) + near[j], near[j] >= 0, near[j] == mine[j][:, None])
    a, b = np.repeat(near[0], 6, axis=1), np.tile(near[1], 6)
    add(6, (a << 12) + b, (a >= 0) & (b >= 0), (a == mine[0][:, None]) & (b == mine[1][:, None]))
    return np.concatenate(keys), np.concatenate(owner), np.concatenate(own)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), _KEY_CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in bucket_keys(fps[at:at + _KEY_CHUNK])], names=["key", "fp", "own"])


def spanning_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``fps``, each row compared with all others at once."""
    word = np.sort(fps).astype(np.uint64)
    todo = np.ones(len(word), dtype=bool)
    links = []
    for root in range(len(word)):
        if not todo[root]:
            continue
        todo[root] = False
        front = [root]
        while front:
            at = front.pop()
            rest = np.flatnonzero(todo)
            if not len(rest):
                return links
            got = rest[np.bitwise_count(word[rest] ^ word[at]) <= distance]
            todo[got] = False
            front.extend(got.tolist())
            links += [(int(word[at].astype(np.int64)), int(w)) for w in word[got].astype(np.int64)]
    return links


def _bucket_links(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {e for fps in batch.column(0) for e in spanning_links(fps.values.to_numpy(), distance)}
            yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    single = [1 << i for i in range(64)]
    flips = np.array([0, *single, *(a | b for i, a in enumerate(single) for b in single[:i])], dtype=np.uint64)
    near = np.arange(len(flips)) <= 64
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 256):
            part = fps[at:at + 256]
            places = (part.astype(np.uint64)[:, None] ^ flips).astype(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(places), pa.array(np.repeat(part, len(flips))), pa.array(np.tile(near, len(part)))], names=["place", "fp", "near"])


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, cap: int = BUCKET_CAP) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the distance; one column fp."""
    rows = distinct.mapInArrow(_key_rows, "key long, fp long, own boolean")
    buckets = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("own"),
                                             F.min("fp").alias("a"), F.max("fp").alias("b"))
                     .where((F.col("n") > 1) & F.col("own")), "buckets")
    found = buckets.where((F.col("n") == 2) & (differing_bits(F.col("a"), F.col("b")) <= DISTANCE)).select("a", "b")
    sizes = buckets.agg(F.max("n")).first()[0] or 0
    if sizes > 2:
        middle = buckets.where(F.col("n").between(3, cap)).select("key")
        lists = rows.join(middle, "key", "left_semi").groupBy("key").agg(F.collect_list("fp").alias("fps"))
        found = found.union(lists.select("fps").mapInArrow(_bucket_links(DISTANCE), "a long, b long"))
    if sizes > cap:
        crowded = rows.join(buckets.where(F.col("n") > cap).select("key"), "key", "left_semi").select("fp").distinct()
        meet = crowded.mapInArrow(_meetings, "place long, fp long, near boolean")
        hubs = (meet.groupBy("place").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("a"), F.collect_list("fp").alias("bs"))
                .where(F.col("a").isNotNull() & (F.size("bs") > 1)))
        found = found.union(hubs.select("a", F.explode("bs").alias("b")).where("a <> b"))
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of the links (a, b), root being its component's smallest node."""
    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))

    def ordered(e: DataFrame) -> DataFrame:
        return (e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    edges = stored(ordered(edges), "links")
    while True:
        # large star: the larger neighbours of u go to the smallest of u and its neighbours
        around = both(edges)
        low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = stored(ordered(around.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))), "large")
        # small star: u and its smaller neighbours go to the smallest of them
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        edges = stored(ordered(edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                               .union(low.select("a", "m"))), "small")
        # done when each node has one link and no link leads to a node that has one itself
        rows, nodes = edges.agg(F.count(F.lit(1)), F.count_distinct("a")).first()
        if rows == nodes and edges.select("b").join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _grouped(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """Per document __key, __fp, __root (smallest fingerprint reachable), component_id."""
    marked = stored(fingerprints(docs.select(key, text), text, k).select(F.col(key).alias("__key"), "__fp"), "fingerprints")
    texts = stored(marked.groupBy("__fp").agg(F.min("__key").alias("__first")), "texts")
    roots = components(links(texts.select(F.col("__fp").alias("fp"))))
    rooted = (texts.join(roots, texts["__fp"] == roots["node"], "left")
              .select("__fp", "__first", F.coalesce("root", "__fp").alias("__root")))
    smallest = rooted.groupBy("__root").agg(F.min("__first").alias("component_id"))
    return marked.join(rooted.join(smallest, "__root").select("__fp", "__root", "component_id"), "__fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """Per document: key, fingerprint (16 hex digits), component_id (smallest key reachable)."""
    return _grouped(docs, key, text, k).select(
        F.col("__key").alias(key), F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """One document of each component, the one with its smallest key (of several with that key,
    the one with the smallest fingerprint; of repeated rows, any one). Columns as in ``docs``."""
    found = _grouped(docs, key, text, k)
    stays = stored(found.where(F.col("__key").eqNullSafe(F.col("component_id")))
                   .groupBy("__root", "__key", "__fp").agg(F.count(F.lit(1)).alias("n"))
                   .groupBy("__root").agg(F.min(F.struct("__fp", "__key", "n")).alias("s"))
                   .select(F.col("s.__fp").alias("__stay"), F.col("s.__key").alias("__key"), F.col("s.n").alias("__n")), "stays")
    marked = fingerprints(docs, text, k)
    kept = marked.join(stays, marked["__fp"].eqNullSafe(stays["__stay"]) & marked[key].eqNullSafe(stays["__key"]))
    out = kept.where("__n = 1")
    if not stays.where("__n > 1").isEmpty():
        out = out.union(kept.where("__n > 1").dropDuplicates(["__stay", "__key"]))
    return out.select(*[out[c] for c in docs.columns])
