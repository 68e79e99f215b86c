"""Wide/long reshaping (X2-X4) and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airledger import fixed_values as fv
from airledger.operators import shaping as S


# --- reshape ---------------------------------------------------------------------------

#: Columns that a wide table may get from the groups that are found.
MOST_GROUPS = 2000


def found_groups(long: DataFrame, group: str) -> list[str]:
    """The distinct groups in order, by a job of its own; more than MOST_GROUPS are an error."""
    rows = long.where(F.col(group).isNotNull()).select(F.col(group).cast("string").alias("g")).distinct().limit(MOST_GROUPS + 1).collect()
    if len(rows) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups in {group!r}: no wide table")
    return sorted(r["g"] for r in rows)


def pivot_years(long: DataFrame, year: str, group: str, value: str, groups: list[str] | None = None) -> DataFrame:
    """X4 + O2: year x group wide table (one column per group), in year order. Where the groups
    are given, Spark runs no job to discover them; else they are those that ``found_groups`` gives."""
    groups = found_groups(long, group) if groups is None else groups
    return long.groupBy(year).pivot(group, groups).agg(F.sum(value)).orderBy(year)


def unpivot_years(wide: DataFrame, year: str, group_out: str = "grupo", value_out: str = "emision",
                  groups: list[str] | None = None) -> DataFrame:
    """Wide table -> one (year, group, value) row per cell."""
    cols = groups or [c for c in wide.columns if c != year]
    return wide.unpivot([year], cols, group_out, value_out)


# --- unions ----------------------------------------------------------------------------

def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fuse_era(frames_by_year: dict[int, DataFrame], years: list[int], strict: bool = True) -> DataFrame:
    """U1 (strict: every year of the era must be present) / U2 (missing years skipped)."""
    missing = [y for y in years if y not in frames_by_year]
    if strict and missing:
        raise FileNotFoundError(f"missing years {missing}")
    return union_all([frames_by_year[y] for y in years if y in frames_by_year])


def consolidate_efp_era(frames: list[DataFrame], order: list[str]) -> DataFrame:
    """U2 step: spellings renamed when absent (P2), columns completed and ordered."""
    shaped = [S.ensure_columns(S.rename_if_absent(f, fv.EFP_ERA_RENAMES), order) for f in frames]
    return union_all(shaped)


def consolidate_full(efp: DataFrame, r23: DataFrame) -> DataFrame:
    """EFP + 2023 register over the union of their columns, tagged by layout."""
    r23 = S.rename_present(r23, fv.RUEA2023_TO_EFP)
    efp = S.rename_present(efp, fv.EFP_CASE_RENAMES)
    efp = S.tag_layout(S.ensure_columns(efp, fv.CANON_EQUIV), "EFP")
    r23 = S.tag_layout(S.ensure_columns(r23, fv.CANON_EQUIV), "RUEA2023")
    return efp.unionByName(r23, allowMissingColumns=True)


def consolidate_min(efp: DataFrame, r23: DataFrame) -> DataFrame:
    """U4: only the minimum common columns."""
    r23 = S.rename_present(r23, fv.RUEA2023_TO_EFP)
    cols = fv.MIN_COMMON
    return S.ensure_columns(efp, cols, keep_extra=False).unionByName(S.ensure_columns(r23, cols, keep_extra=False))
