"""Hard negatives by segment summaries.

Every row is a vector of whole numbers with a label; a row's score is its inner product with an
anchor. An anchor's positives are its best rows of the same label; for each positive the hard
negatives are the best rows of other labels whose score lies in a window below the positive's
(LEAST to MOST hundredths of it), so that rows nearly as good, which may be positives that nobody
has labelled, are left out.

Summaries. A vector is cut into 1, 2, 4, ... segments. Of each the mean m and the deviation d (the
root of the squared differences' sum) are stored. With l components in a segment, its part of an
inner product is l * m * m' plus at most d * d' either way (Cauchy and Schwarz), so each level gives
lower and upper bounds of a score, and finer segments closer ones. Rows whose upper bound is below what is
already found, or whose bounds miss all windows, are dropped level by level; exact scores are taken
of those left only, in 64-bit integers. Deviations are widened by SLACK of the segment's norm, far more than
rounding takes, so no row is lost.

At scale. The rows lie in blocks, one row of the stored table each, of a bounded number of cells:
labels are dealt to BUCKETS by hash, and a bucket's rows by hash to as many blocks as its count
asks for, so one label with a third of all rows is many blocks. Anchors lie in groups of GROUP. A
block and a group meet in an equi-join on the block's slice (and, for positives, the bucket): each block
is there once, each group once a slice, and what a task keeps is one block, one group and the best
rows so far of at most HELD anchors, which spare later blocks the work. The best rows of a
task are joined by a window over the few rows of each anchor. That every anchor meets all rows, in
blocks, is the operation's own query set.

Defined cases: rows with a null label, a null vector, or a component that is null, not finite or of
LARGE or more in size (whose scores could leave 64 bits) take no part; vectors of unequal lengths are filled with zeros; a
null id cannot be an anchor's, and sorts after all others; repeated rows are rows of their own,
except that an anchor's id is never among its own results and an anchor that is there several
times counts once (the smallest label and vector); ties go to the smaller id; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airledger.llm.common import small_batches, stored

POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95
LEVELS = (1, 2, 4, 8, 16)
LARGE = 1 << 22
SLACK = 1e-6
BUCKETS = 64
#: Cells (rows times components) of a block, anchors of a group, blocks of a slice.
CELLS, GROUP, SLICE = 1 << 16, 256, 4
#: Blocks and groups that a task keeps as arrays.
CACHED = 32
HELD = 100_000
_LAST = np.iinfo(np.int64).max


def whole_rows(rows: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(id, label, vector) of the rows that take part; components are floor(scale * component)."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double") * scale) >= LARGE))
    kept = rows.where(label.isNotNull() & rows[vector].isNotNull() & ~F.coalesce(odd, F.lit(False))).select(
        rows[key].cast("long").alias("id"), label.cast("string").alias("label"),
        F.transform(rows[vector], lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("vector"))
    return kept.withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)))


def pack(rows: pa.StructArray, dims: int) -> tuple[list, list, bytes, bytes, list]:
    """Rows ordered by label as they are stored: ids, labels, components, summaries, windows. A
    level's summary has the segments' means times the root of their lengths, then their deviations."""
    labels = rows.field("label").to_pylist()
    order = sorted(range(len(labels)), key=labels.__getitem__)
    vectors = rows.field("vector")
    cells = np.zeros((len(order), dims), dtype=np.int32)
    cells[np.arange(dims) < vectors.value_lengths().to_numpy(zero_copy_only=False)[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    cells = cells[order]
    ids = rows.field("id").to_pylist()
    asked = rows.field("windows").to_pylist() if "windows" in [f.name for f in rows.type] else []
    summaries = [part for n in levels_of(dims) for part in summary(cells, n)]
    return ([_LAST if ids[i] is None else ids[i] for i in order], [labels[i] for i in order], cells.tobytes(),
            np.concatenate(summaries, axis=1).tobytes(), [asked[i] for i in order if asked])


def levels_of(dims: int) -> list[int]:
    return [n for n in LEVELS if n <= dims]


class Block:
    """Stored rows as arrays: per level the segments' means and deviations, and where each
    label's rows are."""

    def __init__(self, ids: list[int], labels: list[str], cells: bytes, summaries: bytes, windows: list, dims: int):
        n = len(ids)
        self.ids, self.labels = np.array(ids, dtype=np.int64), labels
        self.rows = np.frombuffer(cells, dtype=np.int32).reshape(n, dims).astype(np.int64)
        sides, at, self.levels = np.frombuffer(summaries).reshape(n, -1), 0, []
        for k in levels_of(dims):
            self.levels.append((sides[:, at:at + k], sides[:, at + k:at + 2 * k]))
            at += 2 * k
        self.windows = [[(w["low"], w["high"]) for w in asked] for asked in windows]
        starts = [i for i in range(n) if not i or labels[i] != labels[i - 1]]
        self.span = {labels[a]: (a, b) for a, b in zip(starts, [*starts[1:], n], strict=True)}


def summary(rows: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    edges = np.linspace(0, rows.shape[1], segments + 1).astype(int)
    means, deviations = np.empty((len(rows), segments)), np.empty((len(rows), segments))
    for s, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        part = rows[:, a:b].astype(np.float64)
        length = max(1, b - a)
        mean = part.sum(axis=1) / length
        means[:, s] = mean * np.sqrt(length)
        deviations[:, s] = np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)) + SLACK * np.sqrt((part ** 2).sum(axis=1))
    return means, deviations


def survivors(block: Block, rows: np.ndarray, anchors: Block, a: int, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Those of ``rows`` that ``wanted`` (of lower and upper bounds) keeps at every level."""
    for (means, deviations), (m, d) in zip(block.levels, anchors.levels, strict=True):
        if not len(rows):
            break
        middle, spread = means[rows] @ m[a], deviations[rows] @ d[a]
        rows = rows[wanted(middle - spread, middle + spread)]
    return rows


def best_of(scores: np.ndarray, ids: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The n first (score, id): higher scores, then smaller ids."""
    order = np.lexsort((ids, -scores))[:n]
    return list(zip(scores[order].tolist(), ids[order].tolist(), strict=True))


def _merged(old: list[tuple[int, int]], new: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    return sorted([*old, *new], key=lambda x: (-x[0], x[1]))[:n]


def find_positives(block: Block, anchors: Block, found: dict, n: int) -> None:
    """Adds to ``found`` (by anchor id) the best rows of the anchor's label."""
    for a, (own, label) in enumerate(zip(anchors.ids.tolist(), anchors.labels, strict=True)):
        if label not in block.span:
            continue
        rows = np.arange(*block.span[label])
        rows = rows[block.ids[rows] != own]
        have = found.get((own,), [])
        least = have[-1][0] if len(have) == n else -np.inf

        def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            sure = np.partition(low, len(low) - n)[len(low) - n] if len(low) > n else -np.inf  # noqa: B023
            return high >= max(sure, least)  # noqa: B023
        rows = survivors(block, rows, anchors, a, wanted)
        if len(rows):
            found[own,] = _merged(have, best_of(block.rows[rows] @ anchors.rows[a], block.ids[rows], n), n)


def find_negatives(block: Block, anchors: Block, found: dict, n: int) -> None:
    """Adds to ``found`` (by anchor id and window) the best rows of other labels within the
    window (lowest, highest score)."""
    for a, (own, label) in enumerate(zip(anchors.ids.tolist(), anchors.labels, strict=True)):
        first, last = block.span.get(label, (0, 0))
        rows = np.concatenate((np.arange(first), np.arange(last, len(block.ids))))
        rows = rows[block.ids[rows] != own]
        live = []
        for window in anchors.windows[a]:
            have = found.get((own, *window), [])
            live.append((max(window[0], have[-1][0]) if len(have) == n else window[0], window[1]))

        def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(low), dtype=bool)
            for least, most in live:  # noqa: B023
                keep |= (high >= least) & (low <= most)
            return keep
        rows = survivors(block, rows, anchors, a, wanted)
        if not len(rows):
            continue
        scores, ids = block.rows[rows] @ anchors.rows[a], block.ids[rows]
        for window in anchors.windows[a]:
            inside = (scores >= window[0]) & (scores <= window[1])
            if inside.any():
                found[own, *window] = _merged(found.get((own, *window), []), best_of(scores[inside], ids[inside], n), n)


_STORED = ("bucket long, page long, ids array<long>, labels array<string>, cells binary, summaries binary, "
           "windows array<array<struct<low: long, high: long>>>")


def packed(rows: DataFrame, page: Column, dims: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """The rows of each bucket and page as one row, with their summaries."""
    whole = F.collect_list(F.struct("id", "label", "vector", *extra)).alias("all")
    groups = rows.withColumn("page", page).groupBy(F.col("bucket").cast("long").alias("bucket"), "page").agg(whole)
    window = pa.struct([("low", pa.int64()), ("high", pa.int64())])
    types = [pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.list_(pa.list_(window))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = pack(batch.column(2)[i].values, dims)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:i + 1], batch.column(1)[i:i + 1], *(pa.array([x], t) for x, t in zip(made, types, strict=True))],
                                                 names=["bucket", "page", "ids", "labels", "cells", "summaries", "windows"])
    return groups.mapInArrow(run, _STORED)


def page_of(key: list[str], sizes: dict[int, int], per_page: int) -> Column:
    """A row's page among as many as its bucket's size asks for."""
    pages = F.array(*[F.lit(-(-sizes.get(b, 1) // per_page)) for b in range(BUCKETS)])
    return F.pmod(F.xxhash64(*key), F.element_at(pages, (F.col("bucket") + 1).cast("int")).cast("long"))


def meet(blocks: DataFrame, groups: DataFrame, slices: int, on: list[str], kernel: Callable[[], tuple[Callable, Callable]], schema: str) -> DataFrame:
    """Every block with every group that ``on`` allows, a slice's blocks in one place. ``kernel``
    makes a task's functions: of a block and a group, and that which gives what has been found and
    forgets it."""
    parts = ["ids", "labels", "cells", "summaries", "windows"]
    sliced = blocks.select(*on, F.pmod(F.xxhash64("bucket", "page"), F.lit(slices)).alias("slice"), F.struct("bucket", "page").alias("block"),
                           *[F.col(c).alias(f"block_{c}") for c in parts])
    spread = groups.select(*on, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"),
                           F.struct("bucket", "page").alias("group"), *[F.col(c).alias(f"group_{c}") for c in parts])
    # the groups are there once a slice, which the optimizer's sizes do not know
    met = sliced.join(spread.hint("merge"), [*on, "slice"]).select("block", *[f"block_{c}" for c in parts], "group", *[f"group_{c}" for c in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take, give = kernel()
        for batch in batches:
            for i in range(batch.num_rows):
                cells = [c[i] for c in batch.columns]
                yield from take(cells[:len(parts) + 1], cells[len(parts) + 1:])
        yield from give()
    return met.mapInArrow(run, schema)


class _Made(dict):
    """The last CACHED blocks or groups as arrays, by their key."""

    def __init__(self, dims: int):
        super().__init__()
        self.dims = dims

    def of(self, cells: list[pa.Scalar]) -> Block:
        key = tuple(cells[0].as_py().values())
        if key not in self:
            while len(self) >= CACHED:
                del self[next(iter(self))]
            self[key] = Block(*(c.as_py() for c in cells[1:]), self.dims)
        return self[key]


def _kernel(dims: int, find: Callable, n: int, columns: list[str]) -> Callable[[], tuple[Callable, Callable]]:
    def make() -> tuple[Callable, Callable]:
        blocks, groups, found = _Made(dims), _Made(dims), {}

        def give() -> Iterator[pa.RecordBatch]:
            rows = [(*key, score, i) for key, best in found.items() for score, i in best]
            found.clear()
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(len(columns))], names=columns)

        def take(block: list[pa.Scalar], group: list[pa.Scalar]) -> Iterator[pa.RecordBatch]:
            find(blocks.of(block), groups.of(group), found, n)
            if len(found) > HELD:
                yield from give()
        return take, give
    return make


def _first(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(rows: DataFrame, key: str, vector: str, label: Column, is_anchor: Callable[[Column], Column], scale: int = 256,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor
    and each of its ``positives`` best rows of its label, the ``negatives`` best rows of other labels with
    least * positive_score <= 100 * negative_score <= most * positive_score."""
    spark = rows.sparkSession
    small_batches(spark)
    whole = stored(whole_rows(rows, key, vector, label, scale), "vectors")
    sizes = whole.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims")).collect()  # BUCKETS rows
    dims = max([1, *(r["dims"] for r in sizes)])
    per_block = max(1, CELLS // dims)
    total = sum(r["n"] for r in sizes)
    slices = max(1, -(-total // (per_block * SLICE)))
    blocks = stored(packed(whole, page_of(["id", "vector"], {r["bucket"]: r["n"] for r in sizes}, per_block), dims), "blocks")
    per_group = max(1, min(GROUP, CELLS // dims))
    chosen = whole.where(is_anchor(F.col("id")) & F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct("label", "vector", "bucket")).alias("x"))
    anchors = stored(chosen.select("id", "x.*"), "anchors")
    page = page_of(["id"], {r["bucket"]: r["n"] for r in anchors.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}, per_group)

    kernel = _kernel(dims, find_positives, positives, ["anchor", "score", "id"])
    best = meet(blocks, packed(anchors, page, dims), slices, ["bucket"], kernel, "anchor long, score long, id long")
    best = stored(_first(best, ["anchor"], positives), "positives")

    # a window's ends are whole numbers, so positives of one score share it
    low = F.when(F.col("score") >= 0, F.expr(f"(score * {least}L + 99L) div 100L")).otherwise(F.expr(f"(score * {least}L) div 100L"))
    high = F.when(F.col("score") >= 0, F.expr(f"(score * {most}L) div 100L")).otherwise(F.expr(f"(score * {most}L - 99L) div 100L"))
    windows = best.select("anchor", F.col("id").alias("positive"), "score", low.alias("low"), high.alias("high"))
    asked = (windows.where("low <= high").groupBy(F.col("anchor").alias("id")).agg(F.collect_set(F.struct("low", "high")).alias("windows")))
    groups = packed(anchors.join(asked, "id"), page, dims, ("windows",))

    kernel = _kernel(dims, find_negatives, negatives, ["anchor", "low", "high", "score", "id"])
    hard = meet(blocks, groups, slices, [], kernel, "anchor long, low long, high long, score long, id long")
    hard = _first(hard, ["anchor", "low", "high"], negatives)
    unkeyed = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return windows.join(hard.withColumnRenamed("score", "negative_score"), ["anchor", "low", "high"]).select(
        F.col("anchor").alias("anchor_id"), unkeyed("positive").alias("positive_id"), "rank", unkeyed("id").alias("negative_id"),
        F.col("score").alias("positive_score"), "negative_score")
