"""Aggregates, windows and the documented analyses.

All grouping is ``groupBy().agg()`` (partial aggregation before the shuffle, final after),
so a pollutant or year holding a third of the rows is pre-aggregated on every executor and
only one partial row per task crosses the network. Windows run over those aggregated
tables (one row per group x year, municipality, unit...), never over the raw facts.
The one order statistic, the exact median, is found by counting values per slice of their
order (``ids.with_slice``) rather than by collecting or sorting a group's values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from airledger import fixed_values as fv
from airledger.functions import values as V
from airledger.operators.ids import join_same_keys, with_slice


def annual_totals(df: DataFrame, group: str, year: str, value: str,
                  out: str = "emision") -> DataFrame:
    """A1: total per (group, year); NULL when every value of the cell is NULL (SQL ``sum``
    already behaves like pandas ``min_count=1``); rows without a year are dropped."""
    return (df.where(F.col(year).isNotNull())
            .groupBy(group, year).agg(F.sum(value).alias(out)))


def running_totals(totals: DataFrame, group: str, year: str, value: str,
                   out: str = "emision_acumulada") -> DataFrame:
    """Running total by year within a group. A NULL yearly total stays NULL and the
    running sum continues after it (pandas ``cumsum`` skips NaN)."""
    w = Window.partitionBy(group).orderBy(year).rowsBetween(Window.unboundedPreceding, 0)
    return totals.withColumn(out, F.when(F.col(value).isNotNull(), F.sum(value).over(w)))


def totals_by(df: DataFrame, keys: list[str], value: str, out: str | None = None,
              year: int | None = None, year_col: str = "año") -> DataFrame:
    """A2/A3: one year (optional), rows with all keys and a value, total per key tuple."""
    if year is not None:
        df = df.where(F.col(year_col) == F.lit(year))
    df = df.dropna(subset=[*keys, value])
    return df.groupBy(*keys).agg(F.sum(value).alias(out or value))


def top_n_per_group(df: DataFrame, group: str, value: str, name: str, n: int = fv.TOP_MUNICIPALITIES,
                    rank_col: str = "rank") -> DataFrame:
    """The ``n`` largest per group, ties broken by name (a total order, so the cut is
    deterministic). Catalyst plans a partial ``WindowGroupLimit`` before the shuffle."""
    w = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last(), F.col(name).asc())
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).where(F.col(rank_col) <= n)


def ordered_report(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """W4 + F6: per group, largest total first; value also as ``%.6f`` text. A decimal value
    is formatted from its own digits; a double as Python does (one row per group and unit)."""
    exact = isinstance(df.schema[value].dataType, DecimalType)
    return (df.withColumn("valor_texto", (V.fixed6_decimal if exact else V.fixed6_exact)(F.col(value)))
            .orderBy(F.col(group), F.col(value).desc_nulls_last(), F.col(name)))


def exact_median(df: DataFrame, group: str, value: str, out: str = "mediana") -> DataFrame:
    """Exact median per group (mean of the two middle values for an even count), without
    sorting a group: values are counted by slice of their order, the counts say which one or
    two slices hold the middle, and only those slices' values are counted one by one."""
    vals = df.select(group, value).where(F.col(value).isNotNull())
    placed = with_slice(vals, [group, value])
    per_group = Window.partitionBy(group)
    slices = (placed.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_end", F.sum("_n").over(per_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_all", F.sum("_n").over(per_group))
              .withColumn("_low", F.floor((F.col("_all") + 1) / 2)).withColumn("_high", F.floor((F.col("_all") + 2) / 2)))
    middle = (slices.where((F.col("_end") >= F.col("_low")) & (F.col("_end") - F.col("_n") < F.col("_high")))
              .select(group, "_slice", (F.col("_end") - F.col("_n")).alias("_before"), "_low", "_high"))
    inside = join_same_keys(placed, middle, [group, "_slice"])
    counts = inside.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"), F.min("_before").alias("_before"),
                                              F.min("_low").alias("_low"), F.min("_high").alias("_high"))
    upto = F.min("_before").over(per_group) + F.sum("_n").over(per_group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_n"))

    def at(rank: str) -> Column:
        return F.sum(F.when((F.col("_from") < F.col(rank)) & (F.col(rank) <= F.col("_upto")), F.col(value)))

    return ranked.groupBy(group).agg(((at("_low") + at("_high")).cast("double") / 2).alias(out))


def mean_of(value: str) -> Column:
    """Mean as (sum, cast to double) / count: exact for decimal inputs, so the result does
    not depend on the order partial sums are combined in."""
    return F.sum(value).cast("double") / F.count(value)


def distribution(df: DataFrame, group: str, value: str) -> DataFrame:
    """A4: per group, count of all values, positives, zero-or-negatives; min, max, mean and
    exact median of the positives. Groups without any positive value are absent."""
    base = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    pos = F.when(F.col(value) > 0, F.col(value))
    stats = (base.groupBy(group).agg(
        F.count(F.lit(1)).cast("long").alias("total_registros"),
        F.count_if(F.col(value) > 0).cast("long").alias("registros_positivos"),
        F.count_if(F.col(value) <= 0).cast("long").alias("registros_cero_o_negativos"),
        F.min(pos).alias("emision_min"),
        F.max(pos).alias("emision_max"),
        (F.sum(pos).cast("double") / F.count(pos)).alias("emision_media"),
    ).where(F.col("registros_positivos") > 0))
    med = exact_median(base.where(F.col(value) > 0), group, value, out="emision_mediana")
    return stats.join(med, on=group, how="left")


def log_histogram(df: DataFrame, group: str, value: str, bins: int = fv.HISTOGRAM_BINS) -> DataFrame:
    """A5: ``bins`` equal-width bins of log10(max(v, 1e-20)) between each group's own min and
    max of the positive values; bin of the max is the last one. A group whose values are all
    equal gets the range widened by 0.5 each side, as numpy does. Empty bins are not listed."""
    pos = df.where((F.col(value) > 0) & F.col(group).isNotNull()).select(group, V.log_floor(F.col(value)).alias("_lv"))
    bounds = pos.groupBy(group).agg(F.min("_lv").alias("_lo0"), F.max("_lv").alias("_hi0"))
    bounds = (bounds.withColumn("_lo", F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5).otherwise(F.col("_lo0")))
              .withColumn("_hi", F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5).otherwise(F.col("_hi0"))))
    joined = pos.join(bounds, on=group)  # one row per group; its size tells the optimizer how
    b = F.least(F.floor((F.col("_lv") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))
    return (joined.withColumn("bin", b.cast("int"))
            .groupBy(group, "bin").agg(F.count(F.lit(1)).cast("long").alias("frecuencia"),
                                       F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
            .withColumn("bin_inicio", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins)
            .drop("_lo", "_hi"))


def group_sizes(df: DataFrame, group: str, out: str = "n_filas") -> DataFrame:
    """Rows per group, largest first (rows with NULL ids count too)."""
    return df.groupBy(group).agg(F.count(F.lit(1)).cast("long").alias(out)).orderBy(F.col(out).desc(), F.col(group))


def label_dictionary(df: DataFrame, cols: list[str], group: str, default: str = fv.DEFAULT_GROUP) -> DataFrame:
    """Distinct (id, name, group) rows outside the default group, no NULLs, sorted."""
    return (df.where(F.col(group) != F.lit(default)).select(*cols).dropna().distinct()
            .orderBy(group, *[c for c in cols if c != group]))


# --- documented analyses ----------------------------------------------------------------

def top_units_by_mean(df: DataFrame, unit: str, value: str, n: int = 3) -> DataFrame:
    """The ``n`` units with the highest mean value, ranked."""
    means = df.dropna(subset=[unit, value]).groupBy(unit).agg(mean_of(value).alias("media"))
    return rank_top(means, unit, "media", n)


def rank_top(rows: DataFrame, name: str, value: str, n: int) -> DataFrame:
    """The ``n`` rows of the largest value (ties by name), found by a distributed top-n; the
    rank is counted over those ``n`` rows only."""
    order = [F.col(value).desc(), F.col(name)]
    return rows.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))


def share_within(df: DataFrame, keys: list[str], part: str, value: str) -> DataFrame:
    """Total per (keys, part) and its share of the keys' total."""
    totals = df.dropna(subset=[*keys, part, value]).groupBy(*keys, part).agg(F.sum(value).alias("total"))
    w = Window.partitionBy(*keys)
    share = F.try_divide(F.col("total").cast("double"), F.sum("total").over(w).cast("double"))
    return totals.withColumn("participacion", share)


def extreme_years(totals: DataFrame, group: str, year: str, value: str) -> DataFrame:
    """D3: per group, the years with the largest and smallest total (ties -> earliest year)."""
    t = totals.where(F.col(value).isNotNull())
    hi = F.max(F.struct(F.col(value).alias("v"), (-F.col(year)).alias("y")))
    lo = F.min(F.struct(F.col(value).alias("v"), F.col(year).alias("y")))
    return t.groupBy(group).agg(hi.alias("_hi"), lo.alias("_lo")).select(
        group, (-F.col("_hi.y")).alias("anio_max"), F.col("_hi.v").alias("total_max"),
        F.col("_lo.y").alias("anio_min"), F.col("_lo.v").alias("total_min"))


def yearly_increase(totals: DataFrame, group: str, year: str, value: str, threshold: float = 0.10) -> DataFrame:
    """Year-over-year change against the previous year with data; rows whose relative
    increase exceeds ``threshold``."""
    w = Window.partitionBy(group).orderBy(year)
    t = totals.where(F.col(value).isNotNull())
    prev = F.lag(value).over(w)
    out = (t.withColumn("anterior", prev)
           .withColumn("cambio_relativo", F.try_divide(F.col(value) - F.col("anterior"), F.abs(F.col("anterior")))))
    return out.where(F.col("cambio_relativo") > F.lit(threshold))


def coverage_gaps(facts: DataFrame, key: str, year: str, years: DataFrame | None = None) -> DataFrame:
    """(key, year) pairs without data. One aggregate gives each key its set of years; the
    year axis (distinct years present, or the given one-column table) is a scalar subquery, and
    what a key's set lacks of it is exploded. Both arrays hold distinct years only."""
    present = facts.where(F.col(key).isNotNull() & F.col(year).isNotNull())
    axis_src = years if years is not None else present.select(year)
    name = axis_src.columns[0]
    axis = axis_src.select(name).distinct().select(F.collect_set(name).alias("_years")).scalar()
    have = present.groupBy(key).agg(F.collect_set(year).alias("_have"))
    return have.select(key, F.explode(F.array_except(axis, F.col("_have"))).alias(year))
