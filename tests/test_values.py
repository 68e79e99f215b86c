"""Number and missing-value rules (N1-N7, F2-F6, T10) on the edge values of FIXTURES.md,
checked against direct Python statements of each rule."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from airledger.functions import values as V
from helpers import one_col

NA = {"", "na", "nan", "none", "null"}
NUMBERS = ["1234.5", "1234,5", "1.234,56", "1,234.56", "1.234", "1,234,567", "1 234,5", "1 234,5",
           "1,5E-03", "-0,2", "+3", "1d", "inf", "·5", "  12  ", "", "  ", "NA", "nan", "None", "null", "N/A",
           "-", None, "abc", "5.", ".5", "1e5", "12·345,6"]


def py_float(s):
    """float() restricted to plain decimals (no inf/nan/Java suffixes), like F2."""
    if s is None:
        return None
    if not re.fullmatch(r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*", s):
        return None
    return float(s)


def thousands(t):
    if "," in t and "." in t:
        t = t.replace(".", "")
    return t.replace(",", ".")


def py_n1(v):
    if v is None:
        return None
    t = v.strip()
    if t.lower() in NA:
        return None
    if re.fullmatch(r"[+-]?[0-9.,]+", t):
        return thousands(t).strip() or None
    return t


def py_n2(v):
    if v is None:
        return None
    t = v.strip()
    if t.lower() in NA:
        return None
    if re.match(r"^[+-]?[\d.,\s]+$", t):
        t = thousands(t.replace(" ", "")).strip()
        return None if t in ("", "-") else t
    return t


def py_n3(v):
    if v is None:
        return None
    s = v.strip()
    if s == "":
        return None
    return py_float(re.sub(r"\s+", "", s.replace(",", ".")))


def py_n5_text(v):
    import unicodedata
    if v is None:
        return None
    t = v.strip()
    if t.lower() in NA or t == "":
        return None
    n = unicodedata.normalize("NFKC", t).replace(" ", "")
    n = thousands(n).replace("·", "").strip()
    return n or None


def py_n6(v):
    if v is None:
        return None
    t = v.strip()
    if t == "" or t.lower() in {"na", "nan", "none"}:
        return None
    return py_float(thousands(t))


def py_n7(v):
    if v is None:
        return None
    t = v.strip()
    if t == "" or t.lower() in {"na", "nan", "none"}:
        return None
    return py_float(t.replace(",", "."))


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float):
        return math.isclose(a, b, rel_tol=0, abs_tol=0) or a == b
    return a == b


@pytest.mark.parametrize("name,spark_fn,py_fn", [
    ("n1", V.number_text_n1, py_n1),
    ("n2", V.number_text_n2, py_n2),
    ("n3", V.number_n3, py_n3),
    ("n5text", V.number_text_n5, py_n5_text),
    ("n6", V.number_n6, py_n6),
    ("n7", V.number_n7, py_n7),
    ("f2", V.safe_number, py_float),
])
def test_number_rules(spark, name, spark_fn, py_fn):
    df = one_col(spark, NUMBERS).select("x", spark_fn(F.col("x")).alias("y"))
    got = {r.x: r.y for r in df.collect()}
    for v in NUMBERS:
        assert same(got[v], py_fn(v)), (name, v, got[v], py_fn(v))


def test_known_values(spark):
    df = one_col(spark, ["1.234,56", "1,234.56", "1.234", "1,234,567", "1,5E-03", "-0,2"])
    got = {r.x: r.y for r in df.select("x", V.number_n5(F.col("x")).alias("y")).collect()}
    assert got["1.234,56"] == 1234.56
    assert got["1,234.56"] == pytest.approx(1.23456)  # thousands rule: parity (decision 17)
    assert got["1.234"] == 1.234
    assert got["1,234,567"] is None  # 1.234.567 does not parse
    assert got["1,5E-03"] == 0.0015
    assert got["-0,2"] == -0.2


def test_int_from_text(spark):
    vals = ["44", "44.0", "44.9", "", "abc", " 7 ", "-3.7", None, "1e2"]
    got = {r.x: r.y for r in one_col(spark, vals).select("x", V.int_from_text(F.col("x")).alias("y")).collect()}
    assert got == {"44": 44, "44.0": 44, "44.9": 44, "": None, "abc": None, " 7 ": 7, "-3.7": -3, None: None, "1e2": 100}


def test_year_rules(spark):
    vals = ["2023", "2023.0", "año 2023", "20052015", "99", None]
    df = one_col(spark, vals).select("x", V.year_first(F.col("x")).alias("y"))
    got = {r.x: r.y for r in df.collect()}
    assert got == {"2023": 2023, "2023.0": 2023, "año 2023": 2023, "20052015": 2005, "99": None, None: None}
    names = one_col(spark, ["ruea-efp-2019-ckan_12345.csv", "retc_2005_2015_RM", "x.csv"])
    got = {r.x: (r.a, r.b) for r in names.select("x", V.year_from_name_first(F.col("x")).alias("a"),
                                                   V.year_from_name_last(F.col("x")).alias("b")).collect()}
    assert got == {"ruea-efp-2019-ckan_12345.csv": ("2019", "1234"), "retc_2005_2015_RM": ("2005", "2015"),
                   "x.csv": (None, None)}


def test_na_words_and_log_and_fixed(spark):
    df = one_col(spark, [None, "", "  ", "NA", "nan", "None", "null", "x", "N/A"])
    got = {r.x: r.na for r in df.select("x", V.is_na_word(F.col("x")).alias("na")).collect()}
    assert got == {None: True, "": True, "  ": True, "NA": True, "nan": True, "None": True, "null": True,
                   "x": False, "N/A": False}
    pandas_na = {r.x: r.y for r in df.select("x", V.clean_pandas_na(F.col("x")).alias("y")).collect()}
    assert pandas_na["N/A"] is None and pandas_na["x"] == "x" and pandas_na["  "] == "  "
    nums = spark.createDataFrame([(0.0,), (1e-30,), (100.0,), (None,)], "v double")
    got = [r.l for r in nums.select(V.log_floor(F.col("v")).alias("l")).collect()]
    assert got[0] == -20.0 and got[1] == -20.0 and got[2] == 2.0 and got[3] is None
    vals = spark.createDataFrame([(1.5,), (None,), (2.0000005,), (1234567.1234565,)], "v double")
    f6 = [r.t for r in vals.select(V.fixed6_exact(F.col("v")).alias("t")).collect()]
    assert f6 == ["1.500000", "", f"{2.0000005:.6f}", f"{1234567.1234565:.6f}"]
    jvm = [r.t for r in vals.select(V.fixed6(F.col("v")).alias("t")).collect()]
    assert jvm[0] == "1.500000" and jvm[1] == ""
