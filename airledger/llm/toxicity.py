"""Toxic passages by maximum-scoring segments.

Model. Words and their beginnings (PREFIXES bytes) are counted by labelled documents. Each has
the log-odds between toxic and other documents, shrunken by a prior of some documents of the common
share whatever its own count, and a z-score with variance 1 / (count + SMOOTH). Those beyond a limit make
the lexicon, all of them. A word scores as itself if it is in
the lexicon, else as its longest beginning there; all other words score -drift, and the drift is taken
from the rest too (more, if need be), so that the expected score of a clean word is negative.
The prior, the limit and the drift are chosen among SETTINGS (and, for few texts, SMALL_SETTINGS) by the
logarithmic loss over labelled documents (CHOOSING of them, by hash), each scored by what the others teach.

Scan. All maximal scoring segments of a text are found in one linear pass (Ruzzo and Tompa): a
stack of candidates, each popped at most once and each linked to the last one below it with a
smaller total before it, so that those between are never looked at again.

Calibration. By extreme-value theory the best segment of n clean words has P(score >= s) about
1 - exp(-K n exp(-lambda s)). lambda solves E[exp(lambda * score)] = 1 over the words of the clean
labelled documents; K is fitted to their best segments. In all of the calibration a document is
scored by what the others teach: its own part is taken out of the counts. A segment is significant if its expected
number K n exp(-lambda s) is under SIGNIFICANT. A text's evidence is the sum of
lambda s - log(K n) over its significant segments; without one, that of its best segment is
log(1 + exp(lambda s) / (K n)), at most what a segment needs to be significant, so that texts without significant
segments are ranked too. Its score is a logistic function of the logarithm of one plus the evidence, fitted
to the labelled documents by Newton steps that are halved until they better the fit, with a slope of
LEAST_SLOPE at least.

Bounds. The classifier is fitted on the documents of at most MAX_LABELLED labelled ids (by hash
order of the id), each distinct text of an id once and with an equal share of its weight of 1;
counts, K and the values of the logistic fit are aggregates. The lexicon, some 100 bytes an entry, holds what that
sample's vocabulary gives, however long; it is what is broadcast to score all texts.

Defined cases: a null or empty text has no segments and the score of no evidence; a key with
several labels is toxic if one of them is; null labels and null keys teach nothing; without labels
of both kinds no word scores and all texts get the share of toxic labels (0 if none); repeated
documents, ties and other columns make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.common import map_texts, stored, utf8

MAX_LABELLED = 20_000
SMOOTH = 0.5
#: (PRIOR, Z, DRIFT) to choose from, on CHOOSING labelled documents at most.
SETTINGS = ((2.0, 1.5, 2.0), (2.0, 2.5, 2.0), (2.0, 1.5, 1.0), (5.0, 2.0, 1.0))
CHOOSING = 5_000
#: To choose from too for at most SMALL texts, where no word is in enough toxic ones for the others' limits.
SMALL_SETTINGS = ((1.0, 1.0, 2.0),)
SMALL = 1_000
PREFIXES = range(3, 10)
KNOWN_WORDS = 200_000
SIGNIFICANT = 0.05
#: More evidence always gives a higher score, if only by a little.
LEAST_SLOPE = 0.05
THRESHOLD = 0.7

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(body: bytes) -> list[bytes]:
    """Runs of ASCII letters, lower-cased, and of characters outside ASCII."""
    return body.translate(_FOLD).split()


def features_of(words: set[bytes]) -> set[bytes]:
    """The words, marked by a space at their end, and their beginnings."""
    out = {w + b" " for w in words}
    for n in PREFIXES:
        out.update(w[:n] for w in words if len(w) >= n)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, weight of toxic documents, of others) of a task; passed on whenever many are held."""
    held: tuple[Counter, Counter] = Counter(), Counter()

    def out() -> Iterator[pa.RecordBatch]:
        for kind, counts in enumerate(held):
            n, none = pa.array(counts.values(), pa.float64()), pa.array([0.0] * len(counts), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), *((n, none) if kind else (none, n))], names=["feature", "toxic", "other"])
            counts.clear()
    for batch in batches:
        for i in range(batch.num_rows):
            found, weight = features_of(set(words_of(batch.column(0)[i].as_py()))), batch.column(2)[i].as_py()
            held[bool(batch.column(1)[i].as_py())].update(found if weight == 1 else dict.fromkeys(found, weight))
            if len(held[0]) + len(held[1]) > 1_000_000:
                yield from out()
    yield from out()


def segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a text, where the words in ``scores``
    (position, score; in order) score so and all others -drift."""
    #: start, end, total before it, total at its end, the last one below it with a smaller total before it
    stack: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for place, score in scores:
        total -= drift * (place - at)
        at = place + 1
        if score <= 0:
            total += score
            continue
        start, left, right = place, total, total + score
        total = right
        j = len(stack) - 1
        while j >= 0 and stack[j][2] >= left:
            j = stack[j][4]  # those between have totals no smaller
        while j >= 0 and stack[j][3] < right:
            start, _, left, _, below = stack[j]
            del stack[j:]
            j = below
        stack.append((start, place + 1, left, right, j))
    return [(s, e, r - l) for s, e, l, r, _ in stack]  # noqa: E741


class _Scores(dict):
    """Word -> its score; filled as words are met, and afresh beyond KNOWN_WORDS."""

    def __init__(self, entries: dict[bytes, float], other: float):
        super().__init__()
        self.entries, self.other = entries, other

    def __missing__(self, word: bytes) -> float:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        keys = [word + b" ", *(word[:n] for n in reversed(PREFIXES) if len(word) >= n)]
        self[word] = score = next((self.entries[k] for k in keys if k in self.entries), self.other)
        return score


class Lexicon:
    def __init__(self, entries: dict[bytes, float], drift: float, rate: float = 1.0, log_k: float = 0.0, logistic: tuple[float, float] = (0.0, 0.0)):
        self.entries, self.drift, self.rate, self.log_k, self.logistic = entries, drift, rate, log_k, logistic

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "known"}

    def scores(self, words: list[bytes]) -> np.ndarray:
        if "known" not in vars(self):
            self.known = _Scores(self.entries, -self.drift)
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.float64, count=len(words))

    def found(self, body: bytes) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of words, and the maximal segments."""
        words = words_of(body)
        scores = self.scores(words)
        at = np.flatnonzero(scores != -self.drift)
        return len(words), segments(list(zip(at.tolist(), scores[at].tolist(), strict=True)), self.drift) if len(at) else []

    def significant(self, n: int, found: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
        """(start, end, evidence) of the significant segments."""
        least = -math.log(SIGNIFICANT)
        rated = ((a, b, self.rate * s - self.log_k - math.log(n)) for a, b, s in found)
        return [r for r in rated if r[2] > least]

    def weak(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """The evidence of the best segment, where none is significant."""
        if not found:
            return 0.0
        most = -math.log(SIGNIFICANT)
        rated = max(-500.0, min(most, self.rate * max(s for *_, s in found) - self.log_k - math.log(n)))
        return min(most, math.log1p(math.exp(rated)))

    def score(self, passages: list[tuple[int, int, float]], weak: float = 0.0) -> float:
        a, b = self.logistic
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * math.log1p(sum(p[2] for p in passages) if passages else weak)))))


def extreme_rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of E[exp(x * score)] = 1; 1 if the scores have none."""
    if not (scores > 0).any() or (scores * shares).sum() >= 0:
        return 1.0
    value = lambda x: float((shares * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    low, high = 0.0, 1e-3
    while value(high) < 0 and high < 1e3:
        low, high = high, high * 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def fit_logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, where each value counts so many ``times``, by Newton steps with a small ridge on the slope. A step
    that doesn't lessen the loss is halved: a full one may run away where x nearly parts the labels. The slope
    is LEAST_SLOPE at least: more evidence never makes a text less toxic."""
    odds = math.log(((times * y).sum() + 0.5) / ((times * (1 - y)).sum() + 0.5))
    share = lambda a, b: 1 / (1 + np.exp(-np.clip(a + b * x, -500, 500)))
    loss = lambda a, b: float((times * (np.logaddexp(0, a + b * x) - y * (a + b * x))).sum()) + 0.05 * b * b
    a, b = odds, 0.0
    least = loss(a, b)
    for _ in range(200):
        p = share(a, b)
        w = times * (p * (1 - p) + 1e-9)
        ga, gb = (times * (y - p)).sum(), (times * (y - p) * x).sum() - 0.1 * b
        haa, hab, hbb = w.sum(), (w * x).sum(), (w * x * x).sum() + 0.1
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = next((k for k in (0.5 ** i for i in range(60)) if loss(a + k * da, b + k * db) < least), 0.0)
        if not step:
            break
        a, b = a + step * da, b + step * db
        least = loss(a, b)
    if b < LEAST_SLOPE:
        b = LEAST_SLOPE
        low, high = odds - b * x.max() - 1, odds - b * x.min() + 1
        for _ in range(80):
            a = (low + high) / 2
            low, high = (a, high) if (times * (y - share(a, b))).sum() > 0 else (low, a)
    return float(a), float(b)


def labelled_sample(docs: DataFrame, labels: DataFrame, allowed: Callable[[Column], Column], key: str, text: str,
                    label: str, label_key: str) -> DataFrame:
    """(body, toxic, weight) of the distinct texts of at most MAX_LABELLED labelled keys, stored. The
    texts of a key share its weight of 1, so that no key decides the model."""
    marks = (labels.where(F.col(label).isNotNull() & F.col(label_key).isNotNull() & allowed(F.col(label_key)))
             .groupBy(F.col(label_key).alias("__key")).agg((F.max(label) > 0).alias("toxic"))
             .orderBy(F.xxhash64("__key"), "__key").limit(MAX_LABELLED))
    rows = docs.select(F.col(key).alias("__doc"), F.col(text).alias("__text"))
    texts = stored(rows.join(F.broadcast(marks), F.col("__doc") == F.col("__key")).select("__key", utf8(F.col("__text")).alias("body"), "toxic").distinct(), "labelled")
    shares = stored(texts.groupBy("__key").agg((1 / F.count(F.lit(1))).alias("weight")), "shares")  # MAX_LABELLED rows
    return texts.join(F.broadcast(shares), "__key").select("body", "toxic", "weight")


def _rate(t, o, toxic: float, other: float, prior: float, m) -> tuple:  # noqa: ANN001
    """Shrunken log-odds of a feature in t toxic and o other documents, and its z-score: ``prior``
    documents of the common share are added, whatever the feature's own count. ``m``: numpy or Spark's functions."""
    share = toxic / (toxic + other)
    score = m.log((t + prior * share) / (o + prior * (1 - share))) - math.log(share / (1 - share))
    return score, score / m.sqrt(1 / (t + SMOOTH) + 1 / (o + SMOOTH))


def _views(t, o, greatest: Callable) -> list[tuple]:  # noqa: ANN001
    """The counts, those without a toxic document that has the feature, those without another one."""
    zero = F.lit(0.0) if isinstance(t, Column) else 0.0
    return [(t, o), (greatest(t - 1, zero), o), (t, greatest(o - 1, zero))]


def fit(sample: DataFrame, settings: tuple = SETTINGS) -> Lexicon:
    """The model of that setting whose scores of documents by what the others teach have the
    least logarithmic loss."""
    of = lambda kind: F.round(F.coalesce(F.sum(F.when(kind, F.col("weight"))), F.lit(0.0)), 6)
    toxic, other, n = sample.agg(of(F.col("toxic")), of(~F.col("toxic")), F.count(F.lit(1))).first()
    if not toxic or not other:
        return Lexicon({}, settings[0][2], logistic=(-500.0 if not toxic else 500.0, 0.0))
    counts = stored(sample.mapInArrow(_count, "feature binary, toxic double, other double").groupBy("feature")
                    .agg(F.round(F.sum("toxic"), 6).alias("toxic"), F.round(F.sum("other"), 6).alias("other")), "counts")
    if len(settings) > 1:
        settings = (*settings, *(SMALL_SETTINGS if n <= SMALL else ()))
        few = sample.where(F.pmod(F.xxhash64("body"), F.lit(-(-n // CHOOSING))) == 0)
        settings = (min(settings, key=lambda s: _fitted(counts, few, toxic, other, s)[1]),)
    return _fitted(counts, sample, toxic, other, settings[0])[0]


def _fitted(counts: DataFrame, sample: DataFrame, toxic: float, other: float, setting: tuple[float, float, float]) -> tuple[Lexicon, float]:
    """The lexicon of ``counts``, calibrated on ``sample``, and the loss there."""
    prior, least_z, drift = setting
    # those that pass as counted, or without one of the documents they are in
    passes = [F.abs(_rate(t, o, toxic, other, prior, F)[1]) > least_z for t, o in _views(F.col("toxic"), F.col("other"), F.greatest)]
    picked = counts.where(passes[0] | passes[1] | passes[2]).toArrow()
    names, seen = [bytes(x) for x in picked.column("feature").to_pylist()], [picked.column(n).to_numpy() for n in ("toxic", "other")]
    models = []
    for t, o in _views(*seen, np.maximum):
        score, z = _rate(t, o, toxic, other, prior, np)
        models.append(Lexicon({names[i]: float(score[i]) - drift for i in np.flatnonzero(np.abs(z) > least_z)}, drift))
    model, without = models[0], (models[2], models[1])  # by label: what the other documents teach
    values, times = _clean_scores(sample, without[0])
    if (mean := float((values * times).sum() / times.sum())) > -drift / 2:  # keep a clean word's mean score negative
        more = mean + drift / 2
        for m in models:
            m.entries, m.drift = {w: v - more for w, v in m.entries.items()}, drift + more
        values = values - more
    rate = extreme_rate(values, times / times.sum())
    for m in models:
        m.rate = rate

    best = stored(map_texts(sample, [sample["body"], sample["toxic"]], [T.StructField("n", T.LongType()), T.StructField("best", T.DoubleType()), T.StructField("scores", T.ArrayType(T.DoubleType()))],
                            _best(sample, without), ["toxic", "weight"]), "best")
    k = best.where("not toxic and n > 0").agg(F.sum(F.col("weight") * F.col("n") * F.exp(-rate * F.col("best"))) / F.sum("weight")).first()[0]
    model.log_k = -math.log(max(1e-9, 1.0 if k is None else k))
    rated = F.transform("scores", lambda s: rate * s - model.log_k - F.log("n"))
    passages = F.filter(rated, lambda e: e > -math.log(SIGNIFICANT))
    weak = F.least(F.lit(-math.log(SIGNIFICANT)), F.log1p(F.exp(F.array_max(rated))))
    evidence = F.when(F.size(passages) > 0, F.aggregate(passages, F.lit(0.0), lambda a, e: a + e)).otherwise(F.coalesce(weak, F.lit(0.0)))
    # one row per thousandth of the logarithm, some ten thousand at most
    rows = (best.select("toxic", "weight", F.round(F.when(F.col("n") > 0, F.log1p(evidence)).otherwise(0.0), 3).alias("x"))
            .groupBy("x", "toxic").agg(F.round(F.sum("weight"), 6).alias("times")).orderBy("x", "toxic").collect())
    x, y, times = (np.array([float(r[c]) for r in rows]) for c in ("x", "toxic", "times"))
    model.logistic = a, b = fit_logistic(x, y, times)
    p = np.clip(1 / (1 + np.exp(-np.clip(a + b * x, -30, 30))), 1e-6, 1 - 1e-6)
    return model, round(float(-(times * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / max(1e-9, times.sum())), 6)


def _clean_scores(sample: DataFrame, model: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """The scores that words of clean documents have (one per entry at most), and how often; each
    entry counts half a time more, so that one unseen there has a share."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, total = shared.value, Counter()
        for batch in batches:
            for body, weight in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                values, n = np.unique(lexicon.scores(words_of(body.as_py())), return_counts=True)
                total.update(dict(zip(values.tolist(), (n * weight).tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.float64()), pa.array(total.values(), pa.float64())], names=["score", "n"])

    rows = (sample.where("not toxic").select("body", "weight").mapInArrow(run, "score double, n double")
            .groupBy("score").agg(F.round(F.sum("n"), 6).alias("n")).orderBy("score").collect())
    times = {r["score"]: float(r["n"]) for r in rows}
    for score in (-model.drift, *model.entries.values()):
        times[score] = times.get(score, 0.0) + 0.5
    scores = sorted(times)
    return np.array(scores), np.array([times[s] for s in scores])


def _best(sample: DataFrame, without: tuple[Lexicon, Lexicon]) -> Callable:
    shared = sample.sparkSession.sparkContext.broadcast(without)

    def make() -> Callable:
        lexicons = shared.value

        def one(body: bytes, toxic: bool) -> tuple:
            n, found = lexicons[bool(toxic)].found(body)
            scores = [s for _, _, s in found]
            return n, max(scores, default=0.0), scores
        return one
    return make


_PASSAGES = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("evidence", T.DoubleType())]))


def score_texts(docs: DataFrame, model: Lexicon, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``), score, and passages (word ranges and evidence)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        lexicon = shared.value

        def one(body: bytes) -> tuple:
            n, found = lexicon.found(body)
            passages = lexicon.significant(n, found) if n else []
            return lexicon.score(passages, lexicon.weak(n, found) if n else 0.0), [{"start": a, "end": b, "evidence": e} for a, b, e in passages]
        return one

    return map_texts(docs, [utf8(docs[text])], [T.StructField("score", T.DoubleType()), T.StructField("passages", _PASSAGES)], make, keep)


def fold(key: Column, folds: int = 3) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def toxicity_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                    label_key: str = "doc_id") -> DataFrame:
    """Per document: key, held_out, score, predicted, passages. Fold 1 of 3 is held out."""
    model = fit(labelled_sample(docs, labels, lambda k: fold(k) != 1, key, text, label, label_key))
    rows = docs.select(F.col(key).alias("__key"), (fold(F.col(key)) == 1).alias("held_out"), F.col(text).alias("__text"))
    scored = score_texts(rows, model, "__text", ["__key", "held_out"])
    return scored.select(F.col("__key").alias(key), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")
