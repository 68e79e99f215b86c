"""Row filters and predicates.

Predicates are plain column expressions, so ``filter`` keeps them inside codegen and
Catalyst pushes the plain comparisons (year, list membership, NOT NULL) down to the
Parquet scan. Text-normalising predicates cannot be pushed into the file reader, so
the pipeline applies them once, at silver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airledger import fixed_values as fv
from airledger.functions import text as T
from airledger.functions.text import snake_name_py


def region_column(columns: list[str]) -> str | None:
    """The region column. An exact ``region`` wins (decision 23); otherwise the first
    column whose T1-normalised name contains ``region``."""
    exact = [c for c in columns if c.strip().lower() == "region"]
    return next(iter(exact + [c for c in columns if "region" in snake_name_py(c)]), None)


def is_metropolitan(c: Column) -> Column:
    """R2: alias set, or both ``metropolitana`` and ``santiago``, or ends with `` rm``."""
    return is_metropolitan_key(T.key_region(c))


def is_metropolitan_key(norm: Column) -> Column:
    """R2 on an already normalised (T1) region key."""
    hit = (norm.isin(*fv.RM_ALIASES)
           | (norm.contains("metropolitana") & norm.contains("santiago"))
           | norm.endswith(" rm"))
    return F.coalesce(hit & (norm != ""), F.lit(False))


def region_matches(c: Column, target: str) -> Column:
    """When the target names the metropolitan region, the alias rule; otherwise strict
    equality after T7 (which deletes the word ``region``)."""
    return region_key_matches(T.key_region_target(c), target)


def region_key_matches(v: Column, target: str) -> Column:
    """R3 on an already normalised (T7) region key."""
    wanted = T.key_region_target(F.lit(target))  # a constant, folded by the optimizer
    named = v.isin(*fv.RM_TARGET_ALIASES) | (v.contains("metropolitana") & v.contains("santiago"))
    return F.coalesce((v == wanted) | (wanted.isin(*fv.RM_TARGETS) & named), F.lit(False))


def region_equals(c: Column, target: str) -> Column:
    """Exact equality after strip + lower (NULL -> ``""``)."""
    return F.lower(T.blank_if_null(c)) == F.lit(target.strip().lower())


def keep_region(df: DataFrame, target: str | None = None, column: str | None = None) -> DataFrame:
    """R1 + R2/R3: keep the rows of one region (default: the metropolitan region)."""
    col = column or region_column(df.columns)
    if col is None:
        raise KeyError(f"no region column among {df.columns}")
    # The key is computed once as a column; the predicate then tests the finished key.
    if target is None:
        keyed = df.withColumn("_rkey", T.key_region(F.col(f"`{col}`")))
        return keyed.where(is_metropolitan_key(F.col("_rkey"))).drop("_rkey")
    keyed = df.withColumn("_rkey", T.key_region_target(F.col(f"`{col}`")))
    return keyed.where(region_key_matches(F.col("_rkey"), target)).drop("_rkey")


def year_equals(df: DataFrame, year: int, col: str = "año") -> DataFrame:
    """R5."""
    return df.where(F.col(col) == F.lit(year))


def in_year(df: DataFrame, ts_col: str, year: int) -> Column:
    """R5 on a date or timestamp column as a half-open range, which the Parquet reader
    can use for row-group skipping (``year(ts) = y`` cannot be pushed down)."""
    dtype = dict(df.dtypes)[ts_col]
    start = F.lit(f"{year}-01-01").cast(dtype)
    end = F.lit(f"{year + 1}-01-01").cast(dtype)
    return (F.col(ts_col) >= start) & (F.col(ts_col) < end)


def year_between(df: DataFrame, start: int | None = None, end: int | None = None, col: str = "año") -> DataFrame:
    """Both bounds optional and inclusive."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end))
    return df


def keep_listed(df: DataFrame, col: str, values: list | None) -> DataFrame:
    """Keep listed values (no list -> all rows)."""
    return df if not values else df.where(F.col(col).isin(*values))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """R8."""
    return df.dropna(subset=cols)


def drop_empty_series(df: DataFrame, key: str, value: str) -> DataFrame:
    """Drop every series (key) that has no non-NULL value at all. The keys with
    values are found by one aggregate and kept with a left-semi join."""
    keys = df.groupBy(key).agg(F.count(value).alias("_n")).where("_n > 0").select(key)
    return df.join(keys, on=key, how="left_semi")


def exclude_default_group(df: DataFrame, col: str = "grupo_canonico", default: str = fv.DEFAULT_GROUP) -> DataFrame:
    """R11."""
    return df.where(F.col(col) != F.lit(default))
