"""Quality rules with risk-controlled thresholds.

Each rule rejects a text whose ratio lies above a cutoff. A stratum's cutoffs are one rung of a
ladder: on every rung each rule has a cutoff, and each rung is at least as strict in all rules as
the one before. A rung is tested as a whole: of the labelled good documents (label 1), the holdout, the share
that any rule rejects there has an exact binomial (Clopper-Pearson) upper bound, and a rung may be used
only if that bound is at most ``false_rejection``. So in each stratum the rules together reject at most that
share of good documents, in all strata at once with probability 1 - ``error``.

Multiple testing: the error is split over the strata (Bonferroni), and within a stratum the rungs
are tested in a fixed order from the most lenient to the strictest, stopping at the first that
fails (fixed-sequence testing needs no further correction). At 2 % and 5 % over four strata 217 good
labels are enough for a first rung; a stratum with fewer gets no cutoffs, so there only the base rule rejects.

The ladder comes from the documents without a label, so it does not depend on the holdout: on rung j
each rule's cutoff leaves a share of TOP * 2 ** -((RUNGS - 1 - j) / 4) of them above it. Ratios are
counted in bins, BINS_PER_DOUBLING to a doubling, so small ratios have cutoffs as fine as large ones.

At scale: one pass measures all texts into a narrow table; labelled rows are joined to that, not
to texts; what a stratum's ladder and test see are counts by bin and by rung, pre-aggregated in Spark.

Defined cases: a null or empty text has no words and fails the base rule; a null stratum is a
stratum of its own; a key with several labels counts as good if one of them is, and as one draw,
however many documents have it (the first in order of stratum and bins); null labels are
no labels; without labels, or in a stratum without unlabelled documents, there are no cutoffs; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.common import Kept, map_texts, stored

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
FALSE_REJECTION, ERROR = 0.02, 0.05
RUNGS, TOP = 48, 0.25
#: Ratios from 2 ** -LEAST_POWER on have bins of their own; those below share the first, 0 is bin 0.
BINS_PER_DOUBLING, LEAST_POWER = 8, 12
#: Strata whose cutoffs may be broadcast; above it the join is left to the optimizer.
BROADCAST_STRATA = 10_000

_SPACE = " \t\n\x0b\x0c\r"
#: The symbols that the contract counts.
_SYMBOLS = "#*$%&|<>"
_UPPER, _LOWER = (bytes(range(ord(a), ord(z) + 1)) for a, z in ("AZ", "az"))

MEASURES = [T.StructField(n, T.LongType()) for n in
            ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "n_lines", "n_upper", "n_lower", "n_marks")]
#: Rule -> (numerator, denominator) among the measures; a ratio above 1 counts as 1.
RULES = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
         "repeats": ("n_repeat_words", "n_words"), "capitals": ("n_upper", "n_letters"), "marks": ("n_marks", "n_words")}


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    body = text.encode()
    words = body.split()  # bytes split at space and \t\n\v\f\r, and nowhere else
    chars = len(text) - sum(map(text.count, _SPACE))
    symbols = sum(map(text.count, _SYMBOLS))
    seen, lines, again = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            lines += 1
            again += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, end = Counter(windows), 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    upper = len(body) - len(body.translate(None, _UPPER))
    lower = len(body) - len(body.translate(None, _LOWER))
    return len(words), chars, symbols, again, repeated, lines, upper, lower, text.count("!") + text.count("|")


def _ratios() -> dict[str, Column]:
    value = lambda c: F.col("n_upper") + F.col("n_lower") if c == "n_letters" else F.col(c)
    return {r: F.least(F.lit(1.0), F.coalesce(F.try_divide(value(a), value(b)), F.lit(0.0))) for r, (a, b) in RULES.items()}


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_cdf(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 100_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + term / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1) < 1e-13:
            break
    return front * total


def binomial_upper(k: int, n: int, error: float) -> float:
    """Exact upper bound, at confidence 1 - error, of a share of which k of n were seen."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        # P(X <= k) at share mid is 1 - I_mid(k + 1, n - k)
        low, high = (mid, high) if 1 - beta_cdf(mid, k + 1, n - k) > error else (low, mid)
    return high


def choose_rung(counts: list[int], n: int, limit: float, error: float) -> int | None:
    """counts[j]: good documents that rung j is the first to reject; the last rung of those that
    pass before the first that fails. None if none passes."""
    best, rejected = None, 0
    for rung, more in enumerate(counts):
        rejected += more
        if not n or binomial_upper(rejected, n, error) > limit:
            break
        best = rung
    return best


def ladder(counts: dict[int, int]) -> list[int]:
    """A rule's cutoff on every rung, from the number of documents by bin: the least bin above
    which the rung's share of them lies, at most."""
    total, out = sum(counts.values()), []
    for rung in range(RUNGS):
        most, above, cut = TOP * 2 ** -((RUNGS - 1 - rung) / 4) * total, 0, max(counts, default=0)
        for step in sorted(counts, reverse=True):
            above += counts[step]
            if above > most:
                cut = step
                break
            cut = step - 1
        out.append(max(0, cut))
    return out


def _step(ratio: Column) -> Column:
    """Bin 0 for 0; else bin i > 0 holds (2 ** ((i - 1) / BINS_PER_DOUBLING - LEAST_POWER), 2 ** (i / BINS_PER_DOUBLING - LEAST_POWER)]."""
    top = F.ceil(F.log2(ratio) * BINS_PER_DOUBLING) + BINS_PER_DOUBLING * LEAST_POWER
    return F.when(ratio > 0, F.greatest(F.lit(1), top)).otherwise(0).cast("int")


def _by_bin(rows: DataFrame, sign: int) -> DataFrame:
    each = rows.select("stratum", F.posexplode("bins").alias("rule", "bin"))
    return each.groupBy("stratum", "rule", "bin").agg((F.count(F.lit(1)) * sign).alias("n"))


def fit_cutoffs(measured: DataFrame, labels: DataFrame, key: str, stratum: str, label: str = "quality",
                label_key: str = "doc_id", false_rejection: float = FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """(stratum, cut): a stratum's rules, in the order of RULES, reject bins above those in ``cut``."""
    bins = measured.select(F.col(key).alias("key"), F.col(stratum).alias("stratum"), F.array(*[_step(v) for v in _ratios().values()]).alias("bins"))
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(label_key).alias("__label_key")).agg((F.max(label) == 1).alias("good"))
    labelled = stored(bins.join(marks, F.col("key") == F.col("__label_key")).select("key", "stratum", "bins", "good"), "labelled")
    free = (_by_bin(bins, 1).unionByName(_by_bin(labelled, -1)).groupBy("stratum", "rule", "bin").agg(F.sum("n").alias("n")).where("n > 0"))
    typ = measured.schema[stratum].dataType.simpleString()

    def climb(rows: pd.DataFrame) -> pd.DataFrame:
        of = {r: {} for r in range(len(RULES))}
        for rule, step, n in zip(rows["rule"], rows["bin"], rows["n"], strict=True):
            of[int(rule)][int(step)] = int(n)
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "ladders": [[ladder(of[r]) for r in range(len(RULES))]]})

    ladders = stored(free.groupBy("stratum").applyInPandas(climb, f"stratum {typ}, ladders array<array<int>>"), "ladders")
    good = labelled.where("good").groupBy("key").agg(F.min(F.struct("stratum", "bins")).alias("x")).select("x.stratum", "x.bins")
    first = F.array_min(F.zip_with("ladders", "bins", lambda cuts, step: F.size(F.filter(cuts, lambda c: c >= step))))
    on = lambda left, right: left.join(right.withColumnRenamed("stratum", "__at"), F.col("stratum").eqNullSafe(F.col("__at"))).drop("__at")
    counts = stored(on(good, ladders).groupBy("stratum", first.alias("rung")).agg(F.count(F.lit(1)).alias("n")), "good_counts")
    each = error / max(1, counts.select("stratum").distinct().count())

    def test(rows: pd.DataFrame) -> pd.DataFrame:
        by_rung = [0] * (RUNGS + 1)  # the last: never rejected
        for rung, n in zip(rows["rung"], rows["n"], strict=True):
            by_rung[int(rung)] += int(n)
        rung = choose_rung(by_rung[:RUNGS], sum(by_rung), false_rejection, each)
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "chosen": [rung]}).dropna(subset=["chosen"])

    chosen = counts.groupBy("stratum").applyInPandas(test, f"stratum {typ}, chosen int")
    return on(ladders, chosen).select("stratum", F.transform("ladders", lambda cuts: F.get(cuts, F.col("chosen"))).alias("cut"))


def measured_texts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    source = Kept(text) if keep is None else docs[text]
    return map_texts(docs, [source], MEASURES, lambda: measure, keep)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judged(measured: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``measured`` with base_failed, failed_rules (of the method) and kept."""
    wide = stored(cutoffs.select(F.col("stratum").alias("__stratum"), F.col("cut").alias("__cut")), "cutoffs")
    if wide.count() <= BROADCAST_STRATA:
        wide = F.broadcast(wide)
    joined = measured.join(wide, F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    broken = F.array_compact(F.array(*[F.when(_step(v) > F.get("__cut", F.lit(i)), F.lit(r)) for i, (r, v) in enumerate(_ratios().items())]))
    out = joined.withColumn("failed_rules", broken).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("__stratum", "__cut")


def quality_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Per document: key, the base measures, base_failed, kept, failed_rules."""
    narrow = docs.select(F.col(key).alias("__key"), F.col(stratum).alias("__by"), F.col(text).alias("__text"))
    measured = stored(measured_texts(narrow, "__text", ["__key", "__by"]), "measures")
    out = judged(measured, fit_cutoffs(measured, labels, "__key", "__by"), "__by")
    return out.select(F.col("__key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "failed_rules")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """The documents that the rules keep, columns as in ``docs``. The cutoffs are fitted on all
    rows of ``docs``, whose measures are stored; the texts are measured again on the way out."""
    narrow = docs.select(F.col(key).alias("__key"), F.col(stratum).alias("__by"), F.col(text).alias("__text"))
    cutoffs = fit_cutoffs(stored(measured_texts(narrow, "__text", ["__key", "__by"]), "measures"), labels, "__key", "__by")
    renamed = docs.toDF(*[f"__d{i}" for i in range(len(docs.columns))])
    at = {c: f"__d{i}" for i, c in enumerate(docs.columns)}
    out = judged(measured_texts(renamed, at[text]), cutoffs, at[stratum])
    return out.where("kept").select(*[F.col(f"__d{i}").alias(c) for i, c in enumerate(docs.columns)])
