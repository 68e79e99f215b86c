"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

Words. A text's maximal runs of letters, lower-cased in A-Z, are counted over all documents. So
that rare slips are there to be grouped, one code point of a run is deleted where the hash of
document and run says so (``EVERY``). Words are the results of at least MIN_LENGTH code points
and MIN_COUNT occurrences.

Near words. Two words one inserted, deleted or replaced code point apart have letter counts at an
L1 distance of two at most: a replaced code point takes one count down and one up, an inserted
one takes one count up. So the words of each length are cut into boxes by a k-d tree over their
counts, and for each pair of lengths (the same, or one more) a range search visits the boxes that
lie within that distance. Words of two boxes that meet are compared by their counts in one
product, and what is left letter by letter, which decides.

At scale. The trees are built on the driver from the letter counts of SAMPLE words at most (by
hash) and broadcast, about 2 * SAMPLE / LEAST nodes at most; every word is then put into its box
by a task, and the search is exact whatever the sample. A box of more words than fit PAGE (words
of equal counts cannot be cut apart) has several pages, by hash. Pages are rows; a page and the
words that reach it meet in an equi-join on the page's number, so that no task holds a box, and
two pages meet once.

Variants. A word's form is its near word of most occurrences (ties: the smallest), if it has at
least RATIO times the word's own; the root is where the forms end, found by pointer jumping. Each
step multiplies the count by RATIO, so chains are short and have no cycles.

Defined cases: a null text has no runs; a null key hashes as the empty text; repeated rows count
as often as they are there; words of any length and alphabet take part (letters share counts by
code point modulo DIMS, which can only add boxes to a search); an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger.llm.common import small_batches, stored

EVERY, MIN_LENGTH, MIN_COUNT, RATIO = 199, 6, 5, 5
SAMPLE, LEAST = 400_000, 8
#: A page's words and code points at most (as the sample tells).
PAGE, PAGE_CHARS = 256, 1 << 16
#: a-z and U+00C0 to U+00FF have counts of their own
DIMS = 160
#: Counts up to so many are compared at once; LETTERS: cells of two words' letters compared at once.
LEVELS, LETTERS = 4, 1 << 21
FLUSH = 200_000
LONG_TEXT = 1 << 22

_RUN = re.compile("[a-zÀ-ÿ]+")
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def slipped(run: str, start: int) -> str:
    """The run, without one code point if EVERY divides its hash, which goes on from ``start``."""
    h = zlib.crc32(run.encode(), start)
    return run if h % EVERY else run[:(at := h % len(run))] + run[at + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for i in range(batch.num_rows):
            key, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().translate(_FOLD).decode("utf-8", "replace")
            runs = Counter(_RUN.findall(text) if len(text) < LONG_TEXT else (m[0] for m in _RUN.finditer(text)))
            start = zlib.crc32(key.encode() + b":")
            for run, n in runs.items():
                if len(run) >= MIN_LENGTH and len(word := slipped(run, start)) >= MIN_LENGTH:
                    held[word] += n
            if len(held) > FLUSH:
                yield out()
                held.clear()
    yield out()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of at least MIN_LENGTH code points and MIN_COUNT occurrences."""
    small_batches(docs.sparkSession)
    rows = docs.where(docs[text].isNotNull()).select(F.coalesce(docs[key].cast("string"), F.lit("")), docs[text].cast("binary"))
    return rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def codes(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), -1)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    n, length = letters.shape
    at = (letters % DIMS).astype(np.int64) + np.arange(n)[:, None] * DIMS
    return np.bincount(at.ravel(), minlength=n * DIMS).reshape(n, DIMS).astype(np.int32)


class Tree:
    """The k-d tree of the words of one length: node i sends counts of ``dim[i]`` up to ``cut[i]``
    to ``low[i]``, others to ``high[i]``; a negative child is the box -1 - child. Box b has the
    pages first[b] to first[b] + pages[b] - 1."""

    def __init__(self, counts: np.ndarray, times: float, page: int, first: int):
        self.dim, self.cut, self.low, self.high = [], [], [], []
        self.first, self.pages, self.next = [], [], first
        self.root = 0
        todo = [(np.arange(len(counts)), None, 0)]
        while todo:
            rows, parent, side = todo.pop()
            split = self._split(counts[rows]) if len(rows) * times > page and len(rows) >= 2 * LEAST else None
            if split is None:
                made = -1 - len(self.first)
                self.first.append(self.next)
                self.pages.append(max(1, math.ceil(len(rows) * times / page)))
                self.next += self.pages[-1]
            else:
                made, (d, cut) = len(self.dim), split
                for part, x in ((self.dim, d), (self.cut, cut), (self.low, 0), (self.high, 0)):
                    part.append(x)
                below = counts[rows, d] <= cut
                todo += [(rows[~below], made, 1), (rows[below], made, 0)]
            if parent is None:
                self.root = made
            else:
                (self.high if side else self.low)[parent] = made

    @staticmethod
    def _split(counts: np.ndarray) -> tuple[int, int] | None:
        """The letter and count that cut the words most evenly; None if all are equal."""
        best = (0, None)
        for cut in range(min(LEVELS, int(counts.max(initial=0)))):
            below = (counts <= cut).sum(axis=0)
            smaller = np.minimum(below, len(counts) - below)
            d = int(smaller.argmax())
            if smaller[d] > best[0]:
                best = (int(smaller[d]), (d, cut))
        return best[1]

    def pages_of(self, words: list[str], counts: np.ndarray) -> list[int]:
        """Each word's page."""
        out = [0] * len(words)
        todo = [(self.root, np.arange(len(words)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                first, pages = self.first[-1 - node], self.pages[-1 - node]
                for i in rows.tolist():
                    out[i] = first + (zlib.crc32(words[i].encode()) % pages if pages > 1 else 0)
                continue
            below = counts[rows, self.dim[node]] <= self.cut[node]
            todo += [(self.low[node], rows[below]), (self.high[node], rows[~below])]
        return out

    def search(self, counts: np.ndarray, most_down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(page, rows of ``counts``) for the boxes that a row reaches with one count up by one and
        ``most_down`` counts down by one, at most."""
        n = len(counts)
        todo = [(self.root, np.arange(n), np.zeros(n, np.int32), np.zeros(n, np.int32), {})]
        while todo:
            node, rows, up, down, box = todo.pop()
            if node < 0:
                box_no = -1 - node
                for page in range(self.first[box_no], self.first[box_no] + self.pages[box_no]):
                    yield page, rows
                continue
            d, cut = self.dim[node], self.cut[node]
            low, high = box.get(d, (0, None))
            have = counts[rows, d]
            was_up, was_down = np.maximum(low - have, 0), (np.maximum(have - high, 0) if high is not None else 0)
            for child, side in ((self.low[node], (low, cut)), (self.high[node], (cut + 1, high))):
                more_up = up - was_up + np.maximum(side[0] - have, 0)
                more_down = down - was_down + (np.maximum(have - side[1], 0) if side[1] is not None else 0)
                fits = (more_up <= 1) & (more_down <= most_down)
                if fits.any():
                    todo.append((child, rows[fits], more_up[fits], more_down[fits], box | {d: side}))


class Forest:
    """A tree for each length that the sample has; words of another length share the page -length."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, total: int):
        self.whole, self.trees, first = total <= len(lengths), {}, 0
        for length in np.unique(lengths).tolist():
            page = max(1, min(PAGE, PAGE_CHARS // length))
            self.trees[length] = tree = Tree(counts[lengths == length], max(1.0, total / len(lengths)), page, first)
            first = tree.next

    def pages_of(self, words: list[str]) -> list[int]:
        tree = self.trees.get(len(words[0]))
        return tree.pages_of(words, letter_counts(codes(words))) if tree else [-len(words[0])] * len(words)

    def search(self, page: int, words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(page, places of the words that reach it), over the words' own length (from their own
        page on, so that two pages meet once) and the next."""
        counts, length = letter_counts(codes(words)), len(words[0])
        for other, down in ((length, 1), (length + 1, 0)):
            tree = self.trees.get(other)
            found = tree.search(counts, down) if tree else () if self.whole else [(-other, np.arange(len(words)))]
            yield from (x for x in found if other != length or x[0] >= page)


def near_pairs(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in left and in right of words one edit apart. All of ``left`` have one length,
    all of ``right`` that or one more; ``same``: both are the same page, so each pair counts once."""
    a, b = codes(left), codes(right)
    length, longer = a.shape[1], b.shape[1] - a.shape[1]
    ca, cb = np.minimum(letter_counts(a), LEVELS), np.minimum(letter_counts(b), LEVELS)
    use = np.flatnonzero(ca.any(axis=0) & cb.any(axis=0))
    steps = np.arange(LEVELS)
    level = lambda c: (c[:, use, None] > steps).reshape(len(c), -1).astype(np.float32)
    shared = level(ca) @ level(cb).T  # the letters that two words share
    fits = (ca.sum(axis=1)[:, None] - shared <= 1 - longer) & (cb.sum(axis=1)[None, :] - shared <= 1)
    i, j = np.nonzero(np.triu(fits, 1) if same else fits)
    step, ok = max(1, LETTERS // length), [np.zeros(0, dtype=bool)]
    for at in range(0, len(i), step):
        p, q = i[at:at + step], j[at:at + step]
        x, y = a[p], b[q]
        if longer:
            begin = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
            end = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            ok.append(begin + end >= length)
        else:
            ok.append((x != y).sum(axis=1) == 1)
    near = np.concatenate(ok)
    return i[near], j[near]


def best_near(words: list[str], counts: list[int], at: np.ndarray, others: list[str], other_counts: list[int], to: np.ndarray) -> Iterator[tuple]:
    """(word, n, near words, n of the best of them, the best) of each word of the pairs ``at`` -> ``to``."""
    best: dict[int, list] = {}
    for i, j in zip(at.tolist(), to.tolist(), strict=True):
        rank = (-other_counts[j], others[j])
        if i not in best:
            best[i] = [0, rank]
        best[i][0] += 1
        best[i][1] = min(best[i][1], rank)
    return ((words[i], counts[i], k, -less, near) for i, (k, (less, near)) in best.items())


def plant(words: DataFrame) -> Forest:
    """The trees of (word, n), from SAMPLE words at most."""
    total = words.count()
    share = max(1, -(-total // SAMPLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w.as_py() for w in batch.column(0)]
            made = [np.minimum(letter_counts(codes([w])), 255).astype(np.uint8).tobytes() for w in found]
            yield pa.RecordBatch.from_arrays([pa.array([len(w) for w in found], pa.int64()), pa.array(made, pa.binary())], names=["length", "counts"])

    rows = words.where(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select("word").mapInArrow(run, "length long, counts binary").toArrow()
    lengths = rows.column("length").to_numpy()
    counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), dtype=np.uint8).reshape(-1, DIMS)
    return Forest(lengths, counts, total if share > 1 else len(lengths))


_PAGES = "page long, words array<string>, counts array<long>"


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, near, near_n) of the words of (word, n) that have near words: how many, and
    the best (most occurrences, then the smallest). A task sums up the pairs of two pages."""
    spark = words.sparkSession
    small_batches(spark)
    forest = spark.sparkContext.broadcast(plant(words))
    names, lists = ["page", "words", "counts"], [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            pages, by_length = [0] * len(found), {}
            for i, w in enumerate(found):
                by_length.setdefault(len(w), []).append(i)
            for rows in by_length.values():
                for i, page in zip(rows, forest.value.pages_of([found[i] for i in rows]), strict=True):
                    pages[i] = page
            yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), *batch.columns], names=["page", "word", "n"])

    placed = words.select("word", "n").mapInArrow(place, "page long, word string, n long")
    pages = stored(placed.groupBy("page").agg(F.collect_list(F.struct("word", "n")).alias("all"))
                   .select("page", F.col("all.word").alias("words"), F.col("all.n").alias("counts")), "pages")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                page, found, n = (c[i].as_py() for c in batch.columns)
                out = [(to, page, [found[r] for r in rows], [n[r] for r in rows]) for to, rows in forest.value.search(page, found)]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate([pa.int64(), *lists])],
                                                 names=["page", "own", "left", "left_counts"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for r in range(batch.num_rows):
                page, own, left, ln, right, rn = (c[r].as_py() for c in batch.columns)
                i, j = near_pairs(left, right, page == own)
                out = [*best_near(left, ln, i, right, rn, j), *best_near(right, rn, j, left, ln, i)]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(types)], names=["word", "n", "n_near", "near_n", "near"])

    reach = pages.mapInArrow(search, "page long, own long, left array<string>, left_counts array<long>")
    parts = (reach.join(pages.hint("merge"), "page").select("page", "own", "left", "left_counts", "words", "counts")
             .mapInArrow(verify, "word string, n long, n_near long, near_n long, near string"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    return parts.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where the forms end, by pointer jumping."""
    jump = stored(links.select("word", F.col("form").alias("root")), "links")
    while True:
        on = jump.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jump = stored(jump.select("word", "root").join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if jump.where("moved").isEmpty():
            return jump.select("word", "root")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    words = stored(word_counts(docs, key, text), "words")
    is_form = F.col("near_n") >= RATIO * F.col("n")
    near = stored(near_words(words).select("word", "n_near", F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), "near")
    ends = roots(near.where("form is not null"))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
