"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans of email, ip, card and phone. They are matched so that a long
run of one kind of character costs a linear scan, and give what leftmost non-overlapping
matching gives.

The CRF adds spans in other writings of the same kinds (a phone number without a plus sign, a
card grouped by dots, an address with letters outside ASCII). Its labels are O and B-, I- per
kind; its features are the word shape (letters x, X, digits d, others as they are, runs of the
same kept up to five), a run-free shape and each of its signs, of a word, however long, and of its two neighbours. It is trained
by gradient ascent on the forward-backward log-likelihood of a small labelled table, on the
driver, whose bound is MAX_SENTENCES. A span that it finds counts if it passes its kind's check
(Luhn, parts up to 255, number of digits) and overlaps no base span.

Decoding. Words are looked up by shape. Where even the best other label gains too little over O
to make up for the best transitions, O is certain whatever the neighbours are, so the best path
splits there; only the stretches between certain words, mostly numbers, are decoded, many at a
time, by Viterbi in numpy. This gives the labels of Viterbi over the whole text.

Defined cases: a null or empty text has no spans; repeated rows and other columns make no
difference; an empty table gives an empty result; masking replaces a span by its kind in angle
brackets and leaves texts without spans as they are (null stays null).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from hashlib import sha256
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.common import Kept, map_texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
MAX_SENTENCES = 2000
EPOCHS, RATE, RIDGE = 150, 0.1, 1e-2
GROUP = 256
#: Words, and shapes, whose numbers a task keeps; longer words are looked at each time.
MAX_SHAPES, MAX_KEPT = 200_000, 128
#: Characters of a shape at each end; cells (words times stretches) that are decoded at once.
END = 32
CELLS = 1 << 15

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def valid(kind: str, found: str) -> bool:
    digits = "".join(_DIGITS.findall(found))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    return True


def _emails(text: str) -> list[Span]:
    """At each @: the local part reaches back over its characters, but not into the last match."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            end = m.end()
        else:
            end = max(end, at)  # a later local part cannot hold this @
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    """By start, then kind as in KINDS."""
    out = _emails(text)
    if _DIGITS.search(text):
        out += [(*m.span(), "ip") for m in _IP.finditer(text) if valid("ip", m[0])]
        out += [(*m.span(), "card") for m in _CARD.finditer(text) if valid("card", m[0])]
        if "+" in text:
            out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if valid("phone", m[0])]
    return sorted(out, key=_place)


def _place(span: Span) -> tuple:
    return span[0], KINDS.index(span[2]), span[1]


# ---- word shapes -----------------------------------------------------------------------------

_ASCII = {c: "X" if chr(c).isupper() else "x" if chr(c).isalpha() else "d" if chr(c).isdigit() else chr(c) for c in range(128)}
_RUN = re.compile(r"(.)\1+", re.S)
_LONG_RUN = re.compile(r"(.)\1{4,}", re.S)


def shape(word: str) -> str:
    raw = word.translate(_ASCII) if word.isascii() else "".join(_ASCII.get(ord(c)) or ("X" if c.isupper() else "x") for c in word)
    return _LONG_RUN.sub(r"\1\1\1\1\1", raw)


def _ends(text: str) -> str:
    """A long shape by its two ends, and whether an @ and a dot stand between them."""
    if len(text) <= 2 * END:
        return text
    inside = text[END:-END]
    return f"{text[:END]}~{'@' * ('@' in inside)}{'.' * ('.' in inside)}~{text[-END:]}"


def shape_features(word: str) -> tuple[str, ...]:
    """The word shape; without its runs; without case and closing punctuation too; and each of its
    signs. All of the word counts: shapes that are long even with their runs collapsed stand by their ends."""
    if word.isalpha() and word[1:].islower():  # most words, the short way
        first = "X" if word[0].isupper() else "x"
        tail = "x" * min(len(word) - 1, 5 - (first == "x"))
        return f"s{first}{tail}", "pXx" if first == "X" else "px", "qx", "cx"
    s = shape(word)
    plain = _RUN.sub(r"\1", s)
    bare = _RUN.sub(r"\1", plain.replace("X", "x")).strip(".,;:!?()/<>[]\"'")
    return f"s{_ends(s)}", f"p{_ends(plain)}", f"q{_ends(bare)}", *(f"c{sign}" for sign in sorted(set(bare)))


# ---- training --------------------------------------------------------------------------------

#: The small labelled table: each line's words, marked /email, /ip, /card or /phone where they
#: belong to such a span; a span ends where the mark changes or a word is marked with a capital.
LABELLED = """
write to anna.berg@mail.example.org/email for more
Contact: j_smith99@example.co.uk/email or call (415)/Phone 555-0134/phone today.
jörg.müller@bücher.example/email is the address
für øyvind@søk.example/email und zoë_1@example.net/email gilt das
écrivez à renée@école.example.fr,/email merci
ou andré77.b2@café24.example/email puis rené.1980@hôtel-du-lac.example/email
siehe käthe-groß@mein-bücherladen.example/email unten
mail info@site.example.com,/email please
our server 192.168.10.7/ip answers, 10.0.0.1/ip does not
The host 8.8.4.4/ip was up.
ping 172.16.254.1,/ip then 203.0.113.77./ip
card 4111/Card 1111/card 1111/card 1111/card expires soon
pay with 4111-1111-1111-1111/card now
number 5500000000000004/card was used
Card: 4111.1111.1111.1111/card and 3782-822463-10005/card here
call +1/Phone (974)/phone 555-3436/phone today
phone 415-555-0199/phone or 415.555.0100/phone
then 4111.1111.1111.1111/card soon
paid by 4012_8888_8888_1881/card or 5105.1051.0510.5100,/card thanks
use 5500.0000.0000.0004/Card today
ring +49/Phone 30/phone 901820/phone tomorrow
tel. (030)/Phone 555-2214/phone until noon
Call (212)/Phone 555-0148/phone, or 0044/Phone 20/phone 7946/phone 0958/phone please.
It was the best of times, it was the worst of times.
Version 2.0 of the License applies
Licensed under CC BY-NC 4.0.
the GNU General Public License, version 3.
Licensed under the Apache License, Version 2.0.
In 1999 there were 12,345 people and 67 dogs.
Chapter 12 ends on page 345, line 6.
see section 3.1.4 and table 2.2
token = "bc0d31ba76f17e56642e8751295a3fd50cd8e61f" was there
key: a94a8fe5ccb19ba61c4c0873d391e987982fbbd3 and more
the | table | has | cells | and | bars |
words### with$$$ marks%%% and&&& signs*** here
LOUD!! WORDS!! ARE!! HERE!! AND!! THERE!!
A price of $19.99 or 45% off, at 10:30 on 2021-03-04
Le été est là. Où êtes-vous ? Ça va très bien.
Die Größe der Straße ist 42 Meter, nicht 1000.
El niño comió 3 manzanas y 14 peras en 2020.
order 123456 of 7890123 items, id 98765432
the follower @someone wrote #42 at home
between 10-20 and 100-200 there are 3-4 gaps
+ 1 is not a number, nor is + or - alone
x + y = 10, a - b = 20 (30) and (1) [2]
"""


def labelled_sentences() -> list[list[tuple[str, str]]]:
    """(word, label) pairs of each line of the labelled table."""
    out = []
    for line in LABELLED.strip().splitlines():
        pairs, before = [], None
        for word in line.split():
            text, _, mark = word.rpartition("/")
            if text and mark.lower() in KINDS:
                kind = mark.lower()
                pairs.append((text, f"{'B' if mark != kind or before != kind else 'I'}-{kind}"))
                before = kind
            else:
                pairs.append((word, "O"))
                before = None
        out.append(pairs)
    return out


class Crf:
    """Weights by feature (own, of the word before, of the word after), transitions, starts."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, transitions: np.ndarray, starts: np.ndarray):
        self.names, self.weights, self.transitions, self.starts = names, weights, transitions, starts

    def of_word(self, word: str, where: str) -> np.ndarray:
        rows = [self.names[k] for f in shape_features(word) if (k := where + f) in self.names]
        return self.weights[rows].sum(axis=0) if rows else np.zeros(len(LABELS))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(sentences: Sequence[Sequence[tuple[str, str]]]) -> Crf:
    """Gradient ascent (Adam) on the penalised log-likelihood, all sentences at once."""
    sentences = [s for s in sentences if s][:MAX_SENTENCES]
    n, steps, size = len(sentences), max(map(len, sentences), default=1), len(LABELS)
    names: dict[str, int] = {}
    marks = np.zeros((n, steps, size))
    mask = np.zeros((n, steps), dtype=bool)
    cells, features = [], []
    for i, s in enumerate(sentences):
        for t, (word, label) in enumerate(s):
            mask[i, t], marks[i, t, LABELS.index(label)] = True, 1
            around = [("=", word)] + ([("<", s[t - 1][0])] if t else []) + ([(">", s[t + 1][0])] if t + 1 < len(s) else [])
            for where, w in around:
                for f in shape_features(w):
                    cells.append(i * steps + t)
                    features.append(names.setdefault(where + f, len(names)))
    cells, features = np.array(cells, dtype=np.int64), np.array(features, dtype=np.int64)
    params = [np.zeros((len(names), size)), np.zeros((size, size)), np.zeros(size)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    pairs = marks[:, :-1, :, None] * marks[:, 1:, None, :]
    seen = [None, pairs.sum(axis=(0, 1)), marks[:, 0].sum(axis=0)]
    for epoch in range(1, EPOCHS + 1):
        weights, trans, starts = params
        score = np.zeros((n * steps, size))
        np.add.at(score, cells, weights[features])
        score = score.reshape(n, steps, size)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = starts + score[:, 0]
        for t in range(1, steps):
            new = _log_sum(ahead[:, t - 1, :, None] + trans, 1) + score[:, t]
            ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = _log_sum(trans + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
        total = _log_sum(ahead[:, -1], 1)
        unary = np.exp(ahead + back - total[:, None, None]) * mask[:, :, None]
        joint = np.exp(ahead[:, :-1, :, None] + trans + (score + back)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        step = np.zeros_like(weights)
        np.add.at(step, features, (marks - unary).reshape(-1, size)[cells])
        grads = [step, seen[1] - joint.sum(axis=(0, 1)), seen[2] - unary[:, 0].sum(axis=0)]
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            g = g - RIDGE * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-8)
    return Crf(names, *params)


# ---- decoding --------------------------------------------------------------------------------


def viterbi(scores: np.ndarray, lengths: np.ndarray, crf: Crf, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Best labels of a batch of stretches: scores (n, steps, labels), row i has lengths[i] words.
    first: the stretch opens its text (else an O stands before); last: it ends it (else an O follows)."""
    n, steps, size = scores.shape
    best = scores[:, 0] + np.where(first[:, None], crf.starts, crf.transitions[0])
    back = np.zeros((n, steps, size), dtype=np.int8)
    final = best.copy()
    for t in range(1, steps):
        through = best[:, :, None] + crf.transitions
        back[:, t] = through.argmax(axis=1)
        best = through.max(axis=1) + scores[:, t]
        final = np.where((lengths > t)[:, None], best, final)
    final = final + np.where(last[:, None], 0.0, crf.transitions[:, 0])
    labels = np.zeros((n, steps), dtype=np.int8)
    rows, now = np.arange(n), final.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        inside = lengths > t
        labels[inside, t] = now[inside]
        now = np.where(inside, back[rows, t, now], now)
    return labels


class _Shapes(dict):
    """Word -> number of its features; like shapes share a number."""

    def __init__(self, add: Callable[[str], int]):
        super().__init__()
        self.add = add

    def __missing__(self, word: str) -> int:
        number = self.add(word)
        if len(word) <= MAX_KEPT:
            if len(self) >= MAX_SHAPES:
                self.clear()
            self[word] = number
        return number


class Decoder:
    def __init__(self, crf: Crf):
        self.crf = crf
        trans, starts = crf.transitions, crf.starts
        # the most that any label can gain over O by its transitions, inside or at an end
        before = np.vstack([trans, starts[None]])
        after = np.hstack([trans, np.zeros((len(LABELS), 1))])
        best_in = (before - before[:, :1]).max(axis=0)
        best_out = (after - after[:1]).max(axis=1)
        self.swing = (best_in + best_out)[1:]
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[tuple[str, ...], int] = {}
        self.tables = [np.zeros((0, len(LABELS))) for _ in range(3)]
        self.rows: list[list[np.ndarray]] = [[], [], []]
        self.words = _Shapes(self._number)

    def _number(self, word: str) -> int:
        key = shape_features(word)
        if key not in self.numbers:
            self.numbers[key] = len(self.numbers)
            for rows, where in zip(self.rows, "=<>", strict=True):
                rows.append(self.crf.of_word(word, where))
        return self.numbers[key]

    def _refresh(self) -> None:
        """Tables of the shapes met so far: scores of each label, and the most that any label but
        O gains on O, with the transitions' share on the word's own."""
        if len(self.tables[0]) < len(self.numbers):
            self.tables = [np.array(rows) for rows in self.rows]
            own, before, after = (t[:, 1:] - t[:, :1] for t in self.tables)
            self.tops = [(own + self.swing).max(axis=1), before.max(axis=1), after.max(axis=1)]

    def label(self, texts: Sequence[str]) -> list[list[Span]]:
        """The CRF's spans of each text, unchecked."""
        if len(self.numbers) > MAX_SHAPES:
            self._forget()
        cut, found = [], []
        for text in texts:
            words = text.split()
            cut.append(words)
            found.append(np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words)))
        self._refresh()
        stretches = []  # (text, from, to, scores)
        for i, ids in enumerate(found):
            if not len(ids):
                continue
            open_ = self._uncertain(ids)
            if not open_.any():
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([0], open_.astype(np.int8), [0]))))
            for a, b in zip(edge[::2], edge[1::2], strict=True):
                own = self.tables[0][ids[a:b]].copy()
                left, right = ids[max(a - 1, 0):b - 1], ids[a + 1:b + 1]
                own[len(own) - len(left):] += self.tables[1][left]
                own[:len(right)] += self.tables[2][right]
                stretches.append((i, int(a), int(b), own))
        out: list[list[Span]] = [[] for _ in texts]
        stretches.sort(key=lambda s: s[2] - s[1])
        group = []
        for s in stretches:  # the last of a group is its longest, to which the others are filled up
            if group and (len(group) + 1) * (s[2] - s[1]) > CELLS:
                self._decode(group, texts, cut, out)
                group = []
            group.append(s)
        if group:
            self._decode(group, texts, cut, out)
        return [sorted(spans) for spans in out]

    def _uncertain(self, ids: np.ndarray) -> np.ndarray:
        """Words that some label other than O might get, bounded by three numbers per shape."""
        most = self.tops[0][ids]
        most[1:] += self.tops[1][ids[:-1]]
        most[:-1] += self.tops[2][ids[1:]]
        return most >= 0

    def _decode(self, group: list, texts: Sequence[str], cut: list[list[str]], out: list[list[Span]]) -> None:
        lengths = np.array([b - a for _, a, b, _ in group])
        scores = np.zeros((len(group), lengths.max(), len(LABELS)))
        for row, (_, a, b, own) in zip(scores, group, strict=True):
            row[:b - a] = own
        places_of: dict[int, list[tuple[int, int]]] = {}
        first = np.array([a == 0 for _, a, _, _ in group])
        last = np.array([b == len(cut[i]) for i, _, b, _ in group])
        for (i, a, b, _), labels in zip(group, viterbi(scores, lengths, self.crf, first, last), strict=True):
            if not labels[:b - a].any():
                continue
            if i not in places_of:
                places_of[i] = _word_places(texts[i])
            places = places_of[i]
            at = a
            while at < b:
                if label := int(labels[at - a]):
                    end = at + 1
                    while end < b and LABELS[labels[end - a]] == "I-" + LABELS[label][2:]:
                        end += 1
                    out[i].append(_trimmed(texts[i], places[at][0], places[end - 1][1], LABELS[label][2:]))
                    at = end
                else:
                    at += 1


_WORD = re.compile(r"\S+")  # as split() cuts


def _word_places(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _WORD.finditer(text)]


def _trimmed(text: str, start: int, end: int, kind: str) -> Span:
    """Without the punctuation around it; a bracket that opens a phone number stays."""
    while end > start and text[end - 1] in ".,;:!?\"'])}>|#$%&*":
        end -= 1
    while start < end and text[start] in "\"'[{<|#$%&*" + ("" if kind == "phone" else "("):
        start += 1
    return start, end, kind


def all_spans(text: str, base: list[Span], extra: list[Span]) -> list[Span]:
    """Base spans and those of the CRF's that pass their check and overlap no base span and none of
    the CRF's before them: one walk along both lists."""
    kept, taken, at, end = list(base), sorted((a, b) for a, b, _ in base), 0, 0
    # base spans of unlike kinds may overlap: the furthest end up to each
    furthest = list(accumulate((b for _, b in taken), max))
    for a, b, kind in sorted(extra, key=_place):
        while at < len(taken) and taken[at][0] < b:
            at += 1
        if b > a >= end and (not at or furthest[at - 1] <= a) and _sound(kind, text[a:b]):
            kept.append((a, b, kind))
            end = b
    return sorted(kept, key=_place)


_IP_WHOLE = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")


def _sound(kind: str, found: str) -> bool:
    if kind == "email":
        name, _, host = found.partition("@")
        return bool(name) and "." in host.strip(".") and "@" not in host
    return (kind != "ip" or bool(_IP_WHOLE.fullmatch(found))) and valid(kind, found)


def listed(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: Sequence[Span]) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        if b <= at:
            continue
        out.append(text[at:max(a, at)])
        out.append(f"<{kind.upper()}>" if a >= at else "")
        at = b
    return "".join([*out, text[at:]])


# ---- Spark -----------------------------------------------------------------------------------


def _finder(model) -> Callable[[Sequence[str]], list[tuple[list[Span], list[Span]]]]:
    decoder = Decoder(model.value)

    def find(texts: Sequence[str]) -> list[tuple[list[Span], list[Span]]]:
        base = [base_spans(t) for t in texts]
        return [(b, all_spans(t, b, x) if x else b) for t, b, x in zip(texts, base, decoder.label(texts), strict=True)]
    return find


def trained(docs: DataFrame, sentences: Sequence | None = None):
    return docs.sparkSession.sparkContext.broadcast(train(labelled_sentences() if sentences is None else sentences))


def pii_report(docs: DataFrame, key: str = "doc_id", text: str = "text", sentences: Sequence | None = None) -> DataFrame:
    """Per document: key, base counts, base_sha256, spans (all, as kind:start:end)."""
    model = trained(docs, sentences)

    def make() -> Callable:
        find = _finder(model)

        def several(rows: list[tuple]) -> list[tuple]:
            return [(*(sum(s[2] == k for s in base) for k in KINDS), sha256(listed(base).encode()).hexdigest(), listed(spans))
                    for base, spans in find([t or "" for t, in rows])]
        return several

    out = [*(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return map_texts(docs.select(F.col(key), F.col(text)), [F.col(text)], out, make, [key], group=GROUP)


def mask_personal_data(docs: DataFrame, text: str = "text", sentences: Sequence | None = None) -> DataFrame:
    """``docs`` with each span of its text replaced by its kind; columns as in ``docs``."""
    model = trained(docs, sentences)

    def make() -> Callable:
        find = _finder(model)

        def several(rows: list[tuple]) -> list[tuple]:
            texts = [t or "" for t, in rows]
            return [(masked(t, spans) if spans else was,) for (was,), t, (_, spans) in zip(rows, texts, find(texts), strict=True)]
        return several

    out = map_texts(docs, [Kept(text)], [T.StructField("__masked", T.StringType())], make, group=GROUP)
    return out.select(*[out["__masked"].alias(c) if c == text else out[c] for c in docs.columns])
