"""Text normalisation as Spark column expressions.

Every preset is one chain of built-in functions (``lower``, ``translate``,
``regexp_replace``), so nothing leaves the JVM. Accent removal is Unicode's compatibility
decomposition (NFKD) with combining marks dropped, over all code points. A text takes the first of
these ways that does: one in ASCII has nothing to fold; one that a small ``translate`` of the Latin
letters and the combining marks leaves without anything else to fold is done; in others all characters that fold to one
character or to none are a ``translate``, and those that fold to several (ligatures, fractions,
Hangul syllables) are replaced one by one.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character Python's str.split()/str.strip() treat as whitespace (Java's \s covers
# only the ASCII ones), generated from Unicode's own property rather than listed by hand.
WS_CHARS = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())

# The same set as a regex class: Java's Unicode \s (White_Space) plus the four separators
# U+001C-U+001F that Python also counts (checked equal over every code point). The
# predefined class is one test per character, several times faster than listing the set.
_WS_BODY = r"\s\x{1C}-\x{1F}"


def _escape_class(chars: str) -> str:
    return "".join("\\" + ch if ch in "\\^-[]" else ch for ch in chars)


def ws_class(extra_body: str = "") -> str:
    """One character that is whitespace or matches ``extra_body`` (a character-class body)."""
    return "(?U:[" + _WS_BODY + extra_body + "])"


WS_CLASS = ws_class()

#: The same for a text in ASCII, several times faster again.
_ASCII_WS_BODY = r" \t-\r\x1C-\x1F"


def collapse_runs(c: Column, extra: str = "") -> Column:
    """Each run of whitespace and of the characters of ``extra`` (a character-class body) as one space."""
    return let(c, lambda x: F.when(is_ascii(x), F.regexp_replace(x, f"[{_ASCII_WS_BODY}{extra}]+", " "))
               .otherwise(F.regexp_replace(x, ws_class(extra) + "+", " ")))


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the value of ``c``, which is computed once however often it is used."""
    return F.get(F.transform(F.array(c), use), 0)


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def _fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


# Unicode's arithmetic of Hangul syllables: first, vowel and optional last letter.
_HANGUL, _VOWELS, _LASTS = (0xAC00, 0xD7A3), 21, 28


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to) for ``translate``, of the characters that fold to one character, then of those
    that fold to nothing, which ``translate`` deletes as ``to`` is shorter; and the folds to
    several characters, but for Hangul."""
    single, deleted, several = {}, [], {}
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or _HANGUL[0] <= cp <= _HANGUL[1] or (folded := _fold(ch)) == ch:
            continue
        if len(folded) == 1:
            single[ch] = folded
        elif folded:
            several[ch] = folded
        else:
            deleted.append(ch)
    return "".join(single) + "".join(deleted), "".join(single.values()), several


@lru_cache(maxsize=1)
def _several_class() -> str:
    """A character class of everything that folds to several characters, as ranges."""
    points = sorted(map(ord, fold_tables()[2])) + list(range(_HANGUL[0], _HANGUL[1] + 1))
    ranges: list[list[int]] = []
    for cp in sorted(points):
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    return "[" + "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ranges) + "]"


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace at both ends. ``btrim`` with the
    character set does it without a regular expression (plain ``trim`` only removes spaces)."""
    return F.btrim(c, F.lit(WS_CHARS))


def collapse_ws(c: Column) -> Column:
    """Python ``" ".join(s.split())``: whitespace runs become one space, ends stripped."""
    return strip_ws(collapse_runs(c))


#: The Latin letters with marks, the combining marks and common punctuation: what texts in Latin scripts hold.
_LATIN_BLOCKS = ((0x80, 0x24F), (0x300, 0x36F), (0x1E00, 0x1EFF), (0x2010, 0x2027))


@lru_cache(maxsize=1)
def _beyond_latin() -> str:
    """A character class of what ``latin_table`` leaves to do: all outside its blocks, and what folds
    to several characters inside. Letters that fold to nothing else (as the German sharp s) are done."""
    several = [ch for ch in fold_tables()[2] if any(lo <= ord(ch) <= hi for lo, hi in _LATIN_BLOCKS)]
    blocks = "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ((0, 0x7F), *_LATIN_BLOCKS))
    return f"[[^{blocks}]{''.join(several)}]"


@lru_cache(maxsize=1)
def latin_table() -> tuple[str, str]:
    """(from, to) for ``translate``, of those characters of _LATIN_BLOCKS that fold to one or to none."""
    src, dst, _ = fold_tables()
    of = dict(zip(src, dst))  # those that are deleted stand last and have no partner
    inside = [ch for ch in src if any(lo <= ord(ch) <= hi for lo, hi in _LATIN_BLOCKS)]
    kept = [ch for ch in inside if ch in of]
    return "".join(kept + [ch for ch in inside if ch not in of]), "".join(of[ch] for ch in kept)


def remove_accents(c: Column) -> Column:
    """NFKD without combining marks."""
    return let(c, lambda x: F.when(is_ascii(x), x).otherwise(
        let(F.translate(x, *latin_table()), lambda y: F.when(is_ascii(y) | ~y.rlike(_beyond_latin()), y)
            .otherwise(let(F.translate(y, *fold_tables()[:2]), _fold_several)))))


def _fold_several(once: Column) -> Column:
    rare = ~is_ascii(once) & once.rlike(_several_class())
    letters = F.regexp_extract_all(once, F.lit("(?s)."), F.lit(0))
    return F.when(rare, F.array_join(F.transform(letters, _fold_letter), "")).otherwise(once)


def _fold_letter(ch: Column) -> Column:
    code = F.ascii(ch)
    at = code - _HANGUL[0]

    def jamo(first: int, count: int, index: Column) -> Column:
        return F.get(F.split(F.lit(",".join(chr(first + i) for i in range(count))), ","), index.cast("int"))

    last = at % _LASTS
    syllable = F.concat(jamo(0x1100, 19, F.floor(at / (_VOWELS * _LASTS))), jamo(0x1161, _VOWELS, F.floor(at / _LASTS) % _VOWELS),
                        F.when(last > 0, jamo(0x11A8, _LASTS - 1, last - 1)).otherwise(""))
    # one constant map; the two separators are no characters of its entries
    entries = F.lit("\x01".join(f"{k}\x02{v}" for k, v in fold_tables()[2].items()))
    several = F.try_element_at(F.str_to_map(entries, F.lit("\x01"), F.lit("\x02")), ch)
    return F.when(code < 0x80, ch).when(code.between(*_HANGUL), syllable).otherwise(F.coalesce(several, ch))


def _char_class(chars: str) -> str:
    return "[" + _escape_class(chars) + "]"


def normalize_text(
    c: Column,
    *,
    strip: bool = True,
    lower: bool = True,
    accents: bool = True,
    to_space: str = "",
    drop: str = "",
    letters: tuple[str, str] | None = None,
) -> Column:
    """Generic text key: strip -> lower -> fold accents -> delete ``drop`` -> ``to_space``
    characters become spaces -> collapse whitespace. ``letters`` replaces the accent fold
    with an explicit (from, to) table. NULL stays NULL."""
    out = strip_ws(c) if strip else c
    if lower:
        out = F.lower(out)
    if letters is not None:
        out = F.translate(out, letters[0], letters[1])
    elif accents:
        out = remove_accents(out)
    if drop:
        out = F.regexp_replace(out, _char_class(drop), "")
    if to_space:
        # Separators become spaces and whitespace runs collapse in one pass: a run of
        # separators and whitespace is one space either way.
        return strip_ws(collapse_runs(out, _escape_class(to_space)))
    return collapse_ws(out)


def with_text_keys(df: DataFrame, col: str, outputs: dict[str, str]) -> DataFrame:
    """Several presets of one text column at once. The steps they share -- strip, lower,
    accent fold -- run once into staged columns, so a long text is lower-cased and folded
    once instead of once per key. ``outputs`` maps output column -> preset name
    (``region``, ``pollutant``, ``description``, ``centre``, ``municipality``)."""
    staged = df.withColumn("_tk_low", F.lower(strip_ws(F.col(col))))
    # one space between words: what is left to do for a key is where its own characters stand
    staged = staged.withColumn("_tk_fold", collapse_ws(remove_accents(F.col("_tk_low"))))
    base, low = F.col("_tk_fold"), F.col("_tk_low")

    def spaced(chars: str) -> Column:
        return F.btrim(F.regexp_replace(base, "[ " + _escape_class(chars) + "]+", " "))

    dashes = F.when(F.contains(base, F.lit("-")), spaced("-")).otherwise(base)
    dropped = F.regexp_replace(base, _char_class(",():[]'"), "")
    exprs = {
        "region": lambda: spaced(",.-()"),
        "pollutant": lambda: let(dropped, lambda x: F.btrim(F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " +", " ")).otherwise(x))),
        "description": lambda: spaced(".,"),
        "municipality": lambda: dashes,
        "centre": lambda: F.when(is_ascii(low), dashes).otherwise(normalize_text(low, strip=False, lower=False, letters=CENTRE_LETTERS, to_space="-")),
    }
    out = staged.select("*", *[exprs[p]().alias(name) for name, p in outputs.items()])
    return out.drop("_tk_low", "_tk_fold")


# --- presets ---------------------------------------------------------------------------

def key_region(c: Column) -> Column:
    """Region / generic label key; ``, . - ( )`` become spaces."""
    return normalize_text(c, to_space=",.-()")


def key_pollutant(c: Column) -> Column:
    """Pollutant label key; ``, ( ) : [ ] '`` are deleted, ``.`` and ``-`` kept."""
    return normalize_text(c, drop=",():[]'")


def key_description(c: Column) -> Column:
    """Activity description key; ``.`` and ``,`` become spaces."""
    return normalize_text(c, strip=False, to_space=".,")


# FIXED VALUES: the seven letters the centre-file key replaces, and their plain forms.
CENTRE_LETTERS = ("áéíóúñü", "aeiounu")


def key_centre(c: Column) -> Column:
    """T4: municipality key of the centres file: only seven accented letters are folded."""
    return normalize_text(c, letters=CENTRE_LETTERS, to_space="-")


def key_municipality(c: Column) -> Column:
    """T5: municipality key; ``-`` becomes a space."""
    return normalize_text(c, to_space="-")


def key_region_target(c: Column) -> Column:
    """Region key that deletes the word ``region`` (anywhere, as the source does)."""
    out = remove_accents(F.lower(c))
    out = F.regexp_replace(out, r"[\t\r\n,.;:]", " ")
    out = F.replace(out, F.lit("region"), F.lit(" "))
    return collapse_ws(out)


def blank_if_null(c: Column) -> Column:
    """NULL becomes ``""``, then strip."""
    return strip_ws(F.coalesce(c, F.lit("")))


def safe_file_name(c: Column, fallback: str = "contaminante") -> Column:
    """Runs outside ``[A-Za-z0-9._-]`` become ``_``; leading/trailing ``_`` removed."""
    out = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")
    return F.when(out == "", F.lit(fallback)).otherwise(out)


# --- column names (driver-side, names are metadata) -------------------------------------

# FIXED VALUES: the characters that separate the words of a column name.
_NAME_SEPARATORS = " \t\r\n-/\\.,;:"
# A run of them, and of the underscore they become.
_NAME_GAP = "[_" + _escape_class(_NAME_SEPARATORS) + "]+"


def snake_name_py(name: str | None) -> str:
    """T6 on a Python string: used for column *names*, which live on the driver."""
    words = re.split(_NAME_GAP, _fold(name.strip()).lower()) if name else []
    return "_".join(w for w in words if w)


def snake_name(c: Column) -> Column:
    """T6 as a column expression (header catalogues, label tables): the same words."""
    return F.btrim(F.regexp_replace(F.lower(remove_accents(strip_ws(c))), _NAME_GAP, "_"), F.lit("_"))
