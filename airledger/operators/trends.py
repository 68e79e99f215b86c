"""Analyses of yearly series: trend, change points, attribution of changes, correlation with
sectors, and gaps in coverage (D2-D5).

All of them start from yearly totals (one row per series and year, made by partial aggregation),
so what is grouped here is bounded by the number of years, however many facts there are. A
series' years stand in one row as an array where an analysis looks at pairs of years or at all
of them in order; arrays are sorted by year, and arithmetic is done in that order, so a result
does not depend on how rows were dealt out.

Defined cases: rows with a null year or value take no part; a null key is a key like others; a
series of one year has no slope, one segment and no changes; the total of a year is one row, as
``metrics.annual_totals`` makes it; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Two-sided 95 % point of the normal distribution.
Z95 = 1.959963984540054
#: The polynomial approximation 26.2.17 of the normal distribution in Abramowitz and
#: Stegun, good to 7.5e-8.
NORMAL_P = 0.2316419
NORMAL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
NORMAL_C = 0.3989422804014327
PENALTY = 2.0


def series(totals: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """(keys, _x, _y): each series' years and values as two arrays in the order of years."""
    rows = totals.where(F.col(year).isNotNull() & F.col(value).isNotNull())
    points = F.array_sort(F.collect_list(F.struct(F.col(year).cast("int").alias("x"), F.col(value).cast("double").alias("y"))))
    return rows.groupBy(*keys).agg(points.alias("_points")).select(
        *keys, F.transform("_points", lambda p: p["x"]).alias("_x"), F.transform("_points", lambda p: p["y"]).alias("_y"))


def two_sided(z: Column) -> Column:
    """P(|N(0, 1)| >= |z|)."""
    t = 1 / (1 + NORMAL_P * F.abs(z))
    poly = F.lit(0.0)
    for b in reversed(NORMAL_B):
        poly = (poly + F.lit(b)) * t
    return F.least(F.lit(1.0), 2 * (NORMAL_C * F.exp(-z * z / 2) * poly))


def _median(values: Column) -> Column:
    """Of a sorted array column; null if it is empty."""
    n = F.size(values)
    at = lambda i: F.get(values, i.cast("int"))
    return (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2


def theil_sen(totals: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """D3: per series the number of years, the Theil-Sen slope (median of the slopes between all
    pairs of years) with its 95 % interval by Sen's ranks, the intercept (median of value - slope *
    year), the Mann-Kendall statistic with its variance corrected for ties, z with continuity
    correction, the two-sided p (six decimals), Kendall's tau, and the trend: ``sube``, ``baja``, or
    ``sin tendencia`` if p is 0.05 or more."""
    s = series(totals, keys, year, value).withColumn("_n", F.size("_y"))
    pairs = lambda f: F.flatten(F.transform("_x", lambda _, i: F.transform(
        F.slice("_x", i + 2, F.col("_n")), lambda _, j: f(F.get("_x", i), F.get("_y", i), F.get("_x", i + 1 + j), F.get("_y", i + 1 + j)))))
    s = s.select("*", F.array_sort(pairs(lambda x0, y0, x1, y1: (y1 - y0) / (x1 - x0))).alias("_slopes"),
                 F.aggregate(pairs(lambda x0, y0, x1, y1: F.signum(y1 - y0).cast("int")), F.lit(0), lambda a, b: a + b).alias("_s"))
    # a value that is there t times takes t(t-1)(2t+5) from the variance: (t-1)(2t+5) at each of its places
    ties = F.aggregate(F.transform("_y", lambda v: F.size(F.filter("_y", lambda w: w == v))), F.lit(0), lambda a, t: a + (t - 1) * (2 * t + 5))
    n = F.col("_n")
    s = s.select("*", ((n * (n - 1) * (2 * n + 5) - ties) / F.lit(18.0)).alias("_var"), _median(F.col("_slopes")).alias("_slope"), F.size("_slopes").alias("_pairs"))
    z = F.when(F.col("_var") > 0, (F.col("_s") - F.signum("_s")) / F.sqrt("_var")).otherwise(0.0)
    wide = Z95 * F.sqrt("_var")
    low = F.greatest(F.lit(1), F.floor((F.col("_pairs") - wide) / 2).cast("int"))
    high = F.least(F.col("_pairs"), (F.ceil((F.col("_pairs") + wide) / 2) + 1).cast("int"))
    rests = F.array_sort(F.transform("_x", lambda x, i: F.get("_y", i) - F.col("_slope") * x))
    many = F.col("_n") > 1
    out = s.select(
        *keys, F.col("_n").cast("long").alias("n_anios"), F.col("_slope").alias("pendiente"),
        F.get("_slopes", low - 1).alias("pendiente_inf"), F.get("_slopes", high - 1).alias("pendiente_sup"),
        F.when(many, _median(rests)).alias("intercepto"), F.col("_s").cast("long").alias("mk_s"), F.col("_var").alias("mk_var"),
        z.alias("_z"), F.when(many, F.col("_s") / F.col("_pairs")).alias("tau"))
    p = F.round(two_sided(F.col("_z")), 6)
    trend = F.when(p < 0.05, F.when(F.col("mk_s") > 0, "sube").otherwise("baja")).otherwise("sin tendencia")
    return out.select(*keys, "n_anios", "pendiente", "pendiente_inf", "pendiente_sup", "intercepto", "mk_s", "mk_var",
                      F.round("_z", 6).alias("mk_z"), p.alias("p_valor"), F.round("tau", 6).alias("tau"), trend.alias("tendencia"))


def change_points(totals: DataFrame, keys: list[str], year: str, value: str, penalty: float = PENALTY) -> DataFrame:
    """Each series cut into the segments of years with the least sum of squared distances from the
    segments' means plus a penalty a segment: ``penalty`` * v * ln(n), where v is half the mean
    squared step between neighbouring years. Found exactly, by dynamic programming over the years: the best cut of the
    first t years is the best over s of that of the first s plus one segment (ties: the longest last segment).

    One row per segment: its number, first and last year, years, mean, and the change of the mean
    against the segment before (absolute, and relative to it)."""
    s = series(totals, keys, year, value).withColumn("_n", F.size("_y"))
    total = F.aggregate("_y", F.lit(0.0), lambda a, y: a + y)
    s = s.withColumn("_mean", total / F.col("_n"))
    s = s.withColumn("_c", F.transform("_y", lambda y: y - F.col("_mean")))  # centred: sums of squares keep their digits
    steps = F.transform(F.slice("_c", 2, F.col("_n")), lambda y, i: (y - F.get("_c", i)) * (y - F.get("_c", i)))
    noise = F.when(F.col("_n") > 1, F.aggregate(steps, F.lit(0.0), lambda a, d: a + d) / (2 * (F.col("_n") - 1))).otherwise(0.0)
    sums = lambda f: F.aggregate("_c", F.array(F.lit(0.0)), lambda a, y: F.concat(a, F.array(F.element_at(a, -1) + f(y))))
    s = s.select("*", (F.lit(float(penalty)) * noise * F.log(F.col("_n").cast("double"))).alias("_beta"), sums(lambda y: y).alias("_s1"), sums(lambda y: y * y).alias("_s2"))

    def step(state: Column, t: Column) -> Column:
        def best_with(i: Column) -> Column:
            d = F.get("_s1", t) - F.get("_s1", i)
            cost = F.get("_s2", t) - F.get("_s2", i) - d * d / (t - i)
            return F.struct((F.get(state["best"], i) + F.greatest(cost, F.lit(0.0)) + F.col("_beta")).alias("v"), i.alias("i"))
        least = F.array_min(F.transform(F.sequence(F.lit(0), t - 1), best_with))
        return F.struct(F.concat(state["best"], F.array(least["v"])).alias("best"), F.concat(state["last"], F.array(least["i"])).alias("last"))

    start = F.struct(F.array(F.lit(0.0)).alias("best"), F.array(F.lit(0)).alias("last"))
    s = s.withColumn("_last", F.aggregate(F.sequence(F.lit(1), F.col("_n")), start, step)["last"])
    # from the end: where each last segment begins
    back = F.aggregate(F.sequence(F.lit(1), F.col("_n")), F.array(F.col("_n")),
                       lambda cuts, _: F.when(F.element_at(cuts, 1) > 0, F.concat(F.array(F.get("_last", F.element_at(cuts, 1))), cuts)).otherwise(cuts))
    s = s.withColumn("_cuts", back)
    mean = lambda a, b: (F.get("_s1", b) - F.get("_s1", a)) / (b - a) + F.col("_mean")
    parts = F.transform(F.slice("_cuts", 2, F.col("_n")), lambda b, i: F.struct(
        (i + 1).alias("segmento"), F.get("_x", F.get("_cuts", i)).alias("anio_inicio"), F.get("_x", b - 1).alias("anio_fin"),
        (b - F.get("_cuts", i)).alias("anios"), mean(F.get("_cuts", i), b).alias("media"),
        F.when(i > 0, mean(F.get("_cuts", F.greatest(i - 1, F.lit(0))), F.get("_cuts", i))).alias("antes")))
    out = s.select(*keys, F.explode(parts).alias("_part")).select(*keys, "_part.*")
    change = F.col("media") - F.col("antes")
    return out.select(*keys, F.col("segmento").cast("long").alias("segmento"), "anio_inicio", "anio_fin", F.col("anios").cast("long").alias("anios"),
                      F.round("media", 4).alias("media"), F.round(change, 4).alias("cambio"), F.round(F.try_divide(change, F.abs("antes")), 6).alias("cambio_relativo"))


def change_by_part(totals: DataFrame, keys: list[str], part: str, year: str, value: str) -> DataFrame:
    """A series' change from the year before that it has, as a sum over its parts (sectors): each
    part's values in the two years (0 where it has none), what it adds to the change, its share of
    the change, and whether it ``aparece``, ``desaparece`` or ``sigue``. The parts of a year add up to the change exactly
    where ``value`` is a decimal; ``totals`` has a row per key, part and year."""
    rows = totals.where(F.col(year).isNotNull() & F.col(value).isNotNull()).select(*keys, part, F.col(year).alias("_y"), F.col(value).alias("_v"))
    years = rows.select(*keys, "_y").distinct()
    order = Window.partitionBy(*keys).orderBy("_y")
    years = years.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_y").alias("_at"),
                         F.lag("_y").over(order).alias("_before"), F.lead("_y").over(order).alias("_next"))
    same = F.col("_y") == F.col("_at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    # a total counts in its own year, and as what was there before in the next
    none = F.col("_v") - F.col("_v")
    side = lambda y, before, was, now, old: F.struct(y.alias("y"), before.alias("before"), was.alias("was"), now.alias("now"), F.lit(old).alias("old"))
    sides = F.explode(F.array(side(F.col("_at"), F.col("_before"), none, F.col("_v"), False), side(F.col("_next"), F.col("_at"), F.col("_v"), none, True)))
    moved = (rows.join(years, same).select(*keys, part, sides.alias("_side")).where("_side.y is not null and _side.before is not null")
             .groupBy(*keys, F.col("_side.y").alias("_y"), F.col("_side.before").alias("_before"), part)
             .agg(F.sum("_side.was").alias("anterior"), F.sum("_side.now").alias("actual"), F.bool_or("_side.old").alias("_was"), F.bool_or(~F.col("_side.old")).alias("_now")))
    moved = moved.withColumn("aporte", F.col("actual") - F.col("anterior"))
    whole = F.sum("aporte").over(Window.partitionBy(*keys, "_y"))
    state = F.when(~F.col("_was"), "aparece").when(~F.col("_now"), "desaparece").otherwise("sigue")
    return moved.withColumn("cambio", whole).select(
        *keys, F.col("_y").alias(year), F.col("_before").alias("anio_anterior"), part, "anterior", "actual", "aporte", "cambio",
        F.round(F.try_divide(F.col("aporte").cast("double"), F.col("cambio").cast("double")), 6).alias("participacion"), state.alias("estado"))


def correlation_by_sector(facts: DataFrame, group: str, sector: str, year: str, value: str, least: int = 3) -> DataFrame:
    """How the yearly totals of each group (pollutant) go with those of each sector, over the
    years that both have: the number of such years, Pearson's correlation, covariance and the slope
    on the sector, from co-moments that partial aggregates merge. Pairs with fewer than ``least``
    common years are left out."""
    cells = (facts.where(F.col(year).isNotNull() & F.col(value).isNotNull()).groupBy(group, sector, year).agg(F.sum(value).alias("_v")))
    side = lambda key, out: (cells.where(F.col(key).isNotNull()).groupBy(key, year).agg(F.sum("_v").cast("double").alias(out)))
    pairs = side(group, "_a").join(side(sector, "_b"), year)
    return (pairs.groupBy(group, sector).agg(
        F.count(F.lit(1)).alias("n_anios"), F.round(F.corr("_a", "_b"), 6).alias("correlacion"),
        F.covar_samp("_a", "_b").alias("_cov"), F.var_samp("_b").alias("_var")).where(F.col("n_anios") >= least)
        .select(group, sector, "n_anios", "correlacion", F.round(F.try_divide(F.col("_cov"), F.col("_var")), 6).alias("pendiente_sector")))


def coverage_runs(facts: DataFrame, key: str, year: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """The runs of years without data of every key of the dimension, those without any row too:
    first and last year, length, and whether the run is open at the start or end of the years that ``facts`` covers
    (``sin_datos``: the key has no row at all)."""
    present = facts.where(F.col(year).isNotNull()).select(F.col(key).alias("_key"), F.col(year).cast("int").alias("_y"))
    axis = present.agg(F.struct(F.min("_y").alias("lo"), F.max("_y").alias("hi")).alias("axis")).scalar()
    have = present.groupBy("_key").agg(F.collect_set("_y").alias("_have"))
    keys = dimension.where(F.col(dimension_key).isNotNull()).select(F.col(dimension_key).alias("_dim")).distinct()
    rows = keys.join(have, F.col("_dim") == F.col("_key"), "left").select("_dim", "_have", axis.alias("_axis")).where("_axis.lo is not null")
    missing = F.array_sort(F.array_except(F.sequence("_axis.lo", "_axis.hi"), F.coalesce("_have", F.array().cast("array<int>"))))
    spots = rows.select("_dim", F.col("_have").isNull().alias("_none"), "_axis", F.posexplode(missing).alias("_pos", "_y"))
    runs = spots.groupBy("_dim", "_none", "_axis", (F.col("_y") - F.col("_pos")).alias("_island")).agg(
        F.min("_y").alias("desde"), F.max("_y").alias("hasta"), F.count(F.lit(1)).alias("anios"))
    return runs.select(F.col("_dim").alias(dimension_key), "desde", "hasta", "anios", (F.col("desde") == F.col("_axis.lo")).alias("abierto_inicio"),
                       (F.col("hasta") == F.col("_axis.hi")).alias("abierto_fin"), F.col("_none").alias("sin_datos"))
