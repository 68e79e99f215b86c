"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased; a run of characters that are neither letters nor marks on them is one space.
Characters are UTF-16 code units, so a 4-gram is 64 bits whatever the script. Every language has
a model of order ORDER: the probability of a character after the three before it is discounted
and interpolated with that of the shorter context, whose counts are the numbers of distinct
characters seen before it (Kneser-Ney), down to a uniform share. A text goes to the language of
the lowest cross-entropy per character.

Counting covers every training document: tasks count packed 4-grams in numpy, Spark adds the counts
and derives all lower orders, contexts, discounts and weights by grouping. The model keeps every
gram and context, exactly: one sorted array of 64-bit keys, with values, per language and
order (grams: discounted share; contexts: weight of the shorter one).

Bound of the broadcast. What a 4-gram's probability needs of any order shares the character before the
last. So the model is cut into blocks by that character (hashed), about MODEL_ROWS entries each;
only the few entries of single characters are in all blocks. Each block is broadcast for a
pass of its own, which adds the logarithms of the grams it knows to the texts' sums, stored in between, so one block is
there at a time. A small model is one block.

Rejection. A model of folds 0 and 1 scores the documents of fold 3, which gives the distribution of
the cross-entropy of each language's own texts; a text above its language's REJECT quantile is
marked rejected, whatever language came out best. Predictions come from a model of folds 0, 1 and 3. The score is the softmax of the languages'
log-likelihoods, over the root of the number of characters, as neighbouring characters are far from independent.

Defined cases: a text that is null or has no letter is ``und`` with score 0; null languages
teach nothing; null ids hash as the empty text; without training documents every text is
``und``; ties go to the first language in order; repeated rows count as often as they are there.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.common import Kept, map_texts, stored

ORDER = 4
MODEL_ROWS = 1 << 22
REJECT = 0.995
GROUP = 64
FLUSH = 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Letters and the marks that go with them, of all code points."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


def grams(text: str) -> np.ndarray:
    """The packed 4-gram that ends at each UTF-16 code unit of the normalised text."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of others, the first stands for a space
    kept = np.where(letter, code, 0x20)[keep]
    if (kept > 0xFFFF).any():
        kept = np.frombuffer(kept.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-16-le", "surrogatepass"), dtype=np.uint16)
    if not len(kept):
        return np.zeros(0, dtype=np.uint64)
    padded = np.concatenate((np.full(ORDER - 1, 0x20, dtype=np.uint64), kept.astype(np.uint64)))
    out = np.zeros(len(kept), dtype=np.uint64)
    for i in range(ORDER):
        out = out << np.uint64(16) | padded[i:i + len(kept)]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) partial counts; what has been counted is passed on every FLUSH grams."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            values, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(n.astype(np.int64))],
                                             names=["lang", "gram", "n"])
    for batch in batches:
        for i in range(batch.num_rows):
            found = grams(batch.column(1)[i].as_py())
            held.setdefault(batch.column(0)[i].as_py(), []).append(found)
            size += len(found)
            if size >= FLUSH:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def count_grams(texts: DataFrame, lang: str, text: str) -> DataFrame:
    rows = texts.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang), F.col(text))
    return rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _low(gram: Column, chars: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << 16 * chars) - 1))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, grade, item, value): grade n is the discounted share of n-grams, grade 10 + n the
    weight that their contexts give to the order below."""
    tables, level = [], counts
    for order in range(ORDER, 0, -1):
        if order < ORDER:  # the number of distinct characters before
            level = level.groupBy("lang", _low(F.col("gram"), order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        level = stored(level, f"grams{order}")
        d = (level.groupBy("lang").agg(F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("n1"), F.sum(F.when(F.col("n") == 2, 1).otherwise(0)).alias("n2"))
             .select("lang", F.greatest(F.lit(0.1), F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))).alias("d")))
        context = F.shiftrightunsigned("gram", 16)
        of = level.select("*", context.alias("context")).join(F.broadcast(d), "lang")  # a row per language
        sums = of.groupBy("lang", "context", "d").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        shares = of.join(sums.select("lang", "context", "total"), ["lang", "context"]).select(
            "lang", F.lit(order).alias("grade"), F.col("gram").alias("item"), (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("value"))
        weights = sums.select("lang", F.lit(10 + order).alias("grade"), F.col("context").alias("item"), (F.col("d") * F.col("kinds") / F.col("total")).alias("value"))
        tables += [shares, weights]
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.union(t)
    return rows


def _before_last(item: Column, grade: Column) -> Column:
    """The character before the last of the 4-grams that need an entry; null: all need it."""
    char = lambda x: _low(x, 1)
    return F.when(grade.isin(1, 11), None).when(grade < 10, char(F.shiftrightunsigned(item, 16))).otherwise(char(item))


class Model:
    """Languages, the size of the alphabet, and the stored entries (lang, grade, item, value, part) in
    ``parts`` blocks; those without a part belong to all."""

    def __init__(self, langs: list[str], alphabet: int, entries: DataFrame | None, parts: int):
        self.langs, self.alphabet, self.entries, self.parts = langs, alphabet, entries, parts

    def block(self, part: int) -> "Block":
        rows = self.entries.where(F.col("part").isNull() | (F.col("part") == part)).select("lang", "grade", "item", "value").toArrow()
        at = {n: rows.column(n).to_numpy() for n in ("lang", "grade", "item", "value")}
        items = at["item"].view(np.uint64)
        order = np.lexsort((items, at["grade"], at["lang"]))
        place, arrays = at["lang"][order].astype(np.int64) * 100 + at["grade"][order], {}
        for key in np.unique(place).tolist():
            a, b = np.searchsorted(place, [key, key + 1])
            arrays[divmod(key, 100)] = items[order[a:b]], at["value"][order[a:b]]
        return Block(len(self.langs), self.alphabet, arrays, part, self.parts)


def part_of(char: np.ndarray, parts: int) -> np.ndarray:
    return (char.astype(np.int64) * 40_503 >> 4) % parts  # as in fit()


class Block:
    """By language and grade the sorted items and their values."""

    def __init__(self, langs: int, alphabet: int, arrays: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]], part: int, parts: int):
        self.langs, self.alphabet, self.arrays, self.part, self.parts = langs, alphabet, arrays, part, parts

    def _look(self, lang: int, grade: int, items: np.ndarray, missing: float) -> np.ndarray:
        keys, values = self.arrays.get((lang, grade), (np.zeros(0, np.uint64), np.zeros(0, np.float32)))
        if not len(keys):
            return np.full(len(items), missing)
        at = np.minimum(np.searchsorted(keys, items), len(keys) - 1)
        return np.where(keys[at] == items, values[at], missing)

    def log_probabilities(self, items: np.ndarray) -> np.ndarray:
        """(grams, languages): natural logarithm of each 4-gram's last character's probability; 0 for grams of other blocks."""
        mine = np.flatnonzero(part_of(items >> np.uint64(16) & np.uint64(0xFFFF), self.parts) == self.part) if self.parts > 1 else np.arange(len(items))
        out, items = np.zeros((len(items), self.langs)), items[mine]
        lows = {n: items if n == ORDER else items & np.uint64((1 << 16 * n) - 1) for n in range(1, ORDER + 1)}
        for lang in range(self.langs):
            p = np.full(len(items), 1.0 / self.alphabet)
            for n, low in lows.items():
                p = np.minimum(1.0, self._look(lang, n, low, 0.0) + self._look(lang, 10 + n, low >> np.uint64(16), 1.0) * p)
            out[mine, lang] = np.log(p)
        return out

    def sums(self, texts: list[str]) -> list[tuple[np.ndarray, int]]:
        """Per text the languages' sums of logarithms over this block's grams, and the text's characters."""
        parts = [grams(t) for t in texts]
        every, where = np.unique(np.concatenate([*parts, np.zeros(0, np.uint64)]), return_inverse=True)
        logs, out, at = self.log_probabilities(every), [], 0
        for part in parts:
            out.append((logs[where[at:at + len(part)]].sum(axis=0), len(part)))
            at += len(part)
        return out


def fit(counts: DataFrame) -> Model:
    """The model of (lang, gram, n)."""
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not langs:
        return Model([], 2, None, 1)
    alphabet = counts.select(_low(F.col("gram"), 1)).distinct().count() + 1
    number = F.create_map(*[x for i, name in enumerate(langs) for x in (F.lit(name), F.lit(i))])
    rows = stored(kneser_ney(counts).select(number[F.col("lang")].alias("lang"), "grade", "item", F.col("value").cast("float").alias("value"),
                                            _before_last(F.col("item"), F.col("grade")).alias("char")), "model")
    parts = max(1, -(-rows.count() // MODEL_ROWS))
    part = F.shiftright(F.col("char") * 40_503, 4) % parts
    return Model(langs, alphabet, rows.select("lang", "grade", "item", "value", part.cast("int").alias("part")), parts)


_SUMS = [T.StructField("__sums", T.ArrayType(T.DoubleType())), T.StructField("__chars", T.LongType())]


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``), lang_pred, score, cross_entropy (of the best)."""
    langs = model.langs
    names = list(docs.columns if keep is None else keep)
    rows = docs.select(*[docs[c].alias(f"__k{i}") for i, c in enumerate(names)], docs[text].alias("__text"))
    kept = [f"__k{i}" for i in range(len(names))]
    for part in range(model.parts if langs else 0):
        shared = docs.sparkSession.sparkContext.broadcast(model.block(part))
        last = part + 1 == model.parts

        def make(shared=shared) -> Callable:  # noqa: ANN001
            def several(group: list[tuple]) -> list[tuple]:
                out = []
                for (_, before), (more, chars) in zip(group, shared.value.sums([t or "" for t, _ in group]), strict=True):
                    out.append(((more if before is None else more + np.array(before)).tolist(), chars))
                return out
            return several

        before = rows["__sums"] if part else F.lit(None).cast("array<double>")
        rows = map_texts(rows, [Kept("__text"), before], _SUMS, make, [*kept, "__text"], group=GROUP)
        if not last:
            rows = stored(rows, "sums")
            shared.unpersist()

    if not langs:
        rows = rows.select("*", F.lit(None).cast("array<double>").alias("__sums"), F.lit(0).cast("long").alias("__chars"))
    entropy = F.transform("__sums", lambda s: -s / F.col("__chars"))
    known = F.when(F.rlike("__text", F.lit(r"\p{L}")) & (F.col("__chars") > 0), entropy)
    rows = rows.select(*kept, "__chars", known.alias("__entropy"))
    least = F.array_min("__entropy")
    odds = F.aggregate(F.transform("__entropy", lambda e: F.exp((F.col("__least") - e) * F.sqrt("__chars"))), F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumn("__least", least)
    name = F.get(F.array(*map(F.lit, langs)) if langs else F.array().cast("array<string>"), (F.array_position("__entropy", F.col("__least")) - 1).cast("int"))
    return rows.select(*[F.col(k).alias(c) for k, c in zip(kept, names, strict=True)], F.coalesce(name, F.lit(UNKNOWN)).alias("lang_pred"),
                       F.coalesce(1 / odds, F.lit(0.0)).alias("score"), F.col("__least").alias("cross_entropy"))


def fold(key: Column, folds: int = 4) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def language_report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: key, held_out, lang_pred, score, cross_entropy, rejected. Fold 2 of 4 is held
    out; a model of folds 0 and 1 calibrates the rejection on fold 3; one of folds 0, 1 and 3 predicts."""
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.col(lang).alias("__lang"), fold(F.col(key)).alias("__fold"))
    taught, own = (stored(count_grams(rows.where(w), "__lang", "__text"), "counts") for w in ("__fold < 2", "__fold = 3"))
    judged = identify(rows.where("__fold = 3 and __lang is not null"), fit(taught), "__text", ["__lang"])
    limits = stored(judged.where("__lang = lang_pred").groupBy("lang_pred").agg(F.percentile_approx("cross_entropy", REJECT, 10_000).alias("limit")), "limits")
    whole = stored(taught.unionByName(own).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "counts")
    out = identify(rows, fit(whole), "__text", ["__key", "__fold"])
    return out.join(F.broadcast(limits), "lang_pred", "left").select(  # a row per language
        F.col("__key").alias(key), (F.col("__fold") == 2).alias("held_out"), "lang_pred", "score", "cross_entropy",
        F.coalesce(F.col("cross_entropy") > F.col("limit"), F.lit(False)).alias("rejected"))
