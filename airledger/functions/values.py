"""Missing values and number parsing as Spark column expressions.

All parsing goes through ``try_cast`` behind a pattern test, so ANSI mode never raises
on dirty text and nothing leaves the JVM.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from airledger import fixed_values as fv
from airledger.functions.text import WS_CLASS, strip_ws, ws_class

# A decimal number as pandas.to_numeric / float() read it, minus inf/nan and the
# Java-only suffixes (``1d``, ``1f``) that Spark's cast would accept.
SAFE_NUMBER = rf"^{WS_CLASS}*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?{WS_CLASS}*$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_na_word(c: Column | str, words: list[str] = fv.NA_WORDS) -> Column:
    """True when the stripped, lower-cased text is one of ``words`` (or NULL)."""
    c = col_(c)
    return c.isNull() | F.lower(strip_ws(c)).isin(*words)


def clean_null(c: Column | str, words: list[str] = fv.NA_WORDS) -> Column:
    """Stripped text, or NULL when the cell is empty or a missing-value word."""
    c = col_(c)
    return F.when(~is_na_word(c, words), strip_ws(c))


def clean_pandas_na(c: Column | str) -> Column:
    """NULL for every token pandas reads as missing by default (exact, case-sensitive), like
    a plain ``read_csv`` of an all-string file."""
    c = col_(c)
    return F.when(~c.isin(*fv.PANDAS_NA_TOKENS), c)


def safe_number(c: Column | str) -> Column:
    """double when the whole text is a plain decimal number, else NULL."""
    c = col_(c)
    return F.when(c.rlike(SAFE_NUMBER), strip_ws(c).try_cast("double"))


def _thousands(text: Column) -> Column:
    """When both ``,`` and ``.`` occur, ``.`` is a thousands mark: drop it. Then ``,`` -> ``.``."""
    both = text.contains(",") & text.contains(".")
    dropped = F.when(both, F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    return F.replace(dropped, F.lit(","), F.lit("."))


# Each rule is a list of steps, every step a function of the previous step's column. As a
# column expression the steps are simply chained; ``with_numbers`` writes each step into its
# own column instead, because a step that reads its input several times (the thousands rule
# reads it four times) would otherwise copy the whole expression below it into every place:
# Spark does not share a sub-expression between the branches of a CASE.

def _numeric_like_n1(x: Column) -> Column:
    return F.when(x.rlike(r"^[+-]?[0-9.,]+$"), _thousands(x)).otherwise(x)


def _numeric_like_n2(x: Column) -> Column:
    parsed = strip_ws(_thousands(F.replace(x, F.lit(" "), F.lit(""))))
    return F.when(x.rlike(r"^[+-]?" + ws_class("0-9.,") + "+$"),
                  F.when(~parsed.isin("", "-"), parsed)).otherwise(x)


def _clean(x: Column) -> Column:
    return clean_null(x)


def _clean_analytic(x: Column) -> Column:
    return clean_null(x, fv.NA_WORDS_ANALYTIC)


def _comma_point(x: Column) -> Column:
    return F.replace(x, F.lit(","), F.lit("."))


def _strip_comma_point(x: Column) -> Column:
    return _comma_point(strip_ws(x))


def _no_ws(x: Column) -> Column:
    return F.regexp_replace(x, WS_CLASS + "+", "")


def _no_spaces_n5(x: Column) -> Column:
    return F.regexp_replace(x, r"[ \x{A0}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]", "")


def _finish_n5(x: Column) -> Column:
    return strip_ws(F.replace(x, F.lit("·"), F.lit("")))


def _not_empty(x: Column) -> Column:
    return F.when(x != "", x)


RULE_STEPS = {
    # N1 (raw-file cell rule): NA words -> NULL; if the whole stripped text is
    # ``[+-]?[0-9.,]+`` apply the thousands rule; any other text is returned stripped.
    "n1_text": [_clean, _numeric_like_n1],
    # N2 (spreadsheet cell rule): as N1 but inner spaces are allowed and removed; a result
    # of ``""`` or ``-`` is NULL.
    "n2_text": [_clean, _numeric_like_n2],
    # ``,`` -> ``.``, all whitespace removed, then a number or NULL (no thousands rule,
    # so ``1.234,56`` is NULL).
    "n3": [_strip_comma_point, _no_ws, safe_number],
    # As N3 but inner whitespace is kept (so ``1 234,5`` is NULL).
    "n4": [_strip_comma_point, safe_number],
    # N5 (emission rule), text result: NA words -> NULL; spaces (including no-break and
    # other compatibility spaces) removed; thousands rule; middle dot removed.
    "n5_text": [_clean, _no_spaces_n5, _thousands, _finish_n5, _not_empty],
    "n5": [_clean, _no_spaces_n5, _thousands, _finish_n5, _not_empty, safe_number],
    # N6 (analytic rule): NA words without ``null``; thousands rule; to double or NULL.
    "n6": [_clean_analytic, _thousands, safe_number],
    # ``,`` -> ``.``; to double or NULL.
    "n7": [_clean_analytic, _comma_point, safe_number],
    "f2": [safe_number],
}


def _chain(rule: str, c: Column | str) -> Column:
    out = col_(c)
    for step in RULE_STEPS[rule]:
        out = step(out)
    return out


def number_text_n1(c: Column | str) -> Column:
    return _chain("n1_text", c)


def number_text_n2(c: Column | str) -> Column:
    return _chain("n2_text", c)


def number_n3(c: Column | str) -> Column:
    return _chain("n3", c)


def number_n4(c: Column | str) -> Column:
    return _chain("n4", c)


def number_text_n5(c: Column | str) -> Column:
    return _chain("n5_text", c)


def number_n5(c: Column | str) -> Column:
    return _chain("n5", c)


def number_n6(c: Column | str) -> Column:
    return _chain("n6", c)


def number_n7(c: Column | str) -> Column:
    return _chain("n7", c)


def with_numbers(df: DataFrame, outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """Several parse rules at once, each step in its own column: ``outputs`` maps output
    column -> (source column, rule name of ``RULE_STEPS``). Rules that start with the same
    steps on the same source share those columns (N1, N2 and N5 clean NA words once)."""
    staged: dict[tuple, str] = {}
    cols = list(df.columns)
    final: dict[str, str] = {}
    layers: list[list[Column]] = []
    for out, (src, rule) in outputs.items():
        prev = src
        key: tuple = (src,)
        for depth, step in enumerate(RULE_STEPS[rule]):
            key = key + (step.__name__,)
            if key not in staged:
                name = f"_nb{len(staged)}"
                staged[key] = name
                while len(layers) <= depth:
                    layers.append([])
                layers[depth].append(step(F.col(f"`{prev}`")).alias(name))
            prev = staged[key]
        final[out] = prev
    for layer in layers:
        df = df.select("*", *layer)
    exprs = [F.col(f"`{c}`") for c in cols if c not in final] + [F.col(t).alias(o) for o, t in final.items()]
    return df.select(*exprs)


def usable(c: Column) -> Column:
    """Emission text that may be used: not NULL and not ``-``."""
    return F.when(c != "-", c)


def int_from_text(c: Column | str) -> Column:
    """integer through float, truncating (``"44.0"`` -> 44, ``"44.9"`` -> 44)."""
    return safe_number(c).try_cast("bigint")


def year_first(c: Column | str) -> Column:
    """first run of four digits, as an int."""
    return F.regexp_extract(col_(c).cast("string"), r"([0-9]{4})", 1).try_cast("int")


def year_from_name_last(c: Column | str) -> Column:
    """S9 (``detect_year``): last run of four digits in a file name, as text."""
    return F.try_element_at(F.regexp_extract_all(col_(c), F.lit(r"([0-9]{4})"), 1), F.lit(-1))


def year_from_name_first(c: Column | str) -> Column:
    """S9 (``year_from_path``): first four-digit run in a file name, as text."""
    return F.try_element_at(F.regexp_extract_all(col_(c), F.lit(r"([0-9]{4})"), 1), F.lit(1))


def log_floor(c: Column | str, floor: float = fv.LOG_FLOOR) -> Column:
    """log10 of the value clipped below at ``floor``."""
    c = col_(c)
    return F.when(c.isNotNull(), F.log10(F.greatest(c, F.lit(floor))))


def fixed6(c: Column | str) -> Column:
    """F6 on the JVM: ``%.6f`` text, ``""`` for NULL. Java rounds the shortest decimal form
    of the double half-up, so an exact tie in that form can differ from Python in the last
    digit; report tables use ``fixed6_exact``."""
    c = col_(c)
    return F.when(c.isNotNull(), F.format_string("%.6f", c)).otherwise(F.lit(""))


def fixed6_decimal(c: Column | str) -> Column:
    """F6 of a decimal: its own digits, rounded half-up at the sixth; ``""`` for NULL."""
    return F.coalesce(col_(c).cast("decimal(38,6)").cast("string"), F.lit(""))


@F.pandas_udf(StringType())
def _fixed6_py(s: pd.Series) -> pd.Series:
    return s.map(lambda v: "" if v is None or pd.isna(v) else f"{v:.6f}")


def fixed6_exact(c: Column | str) -> Column:
    """F6 with Python's correctly rounded ``%.6f`` (Arrow-batched pandas UDF). Meant for
    aggregated report tables (one row per group and unit), not for raw facts."""
    return _fixed6_py(col_(c).cast("double"))
