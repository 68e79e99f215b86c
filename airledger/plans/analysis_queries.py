"""The analyses of yearly series over the shared test tables, each with its DuckDB SQL next to it.

Order totals play emissions: priorities are pollutants, nations landscape units, market segments
and priorities the sectors, and customers the places that may or may not have reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.operators import geo, trends
from airledger.plans.table_queries import dec2, load


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (load(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return (o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
            .select(F.col("o_orderpriority").alias("contaminante"), F.col("n_name").alias("unidad"), F.col("c_mktsegment").alias("sector"),
                    F.year("o_orderdate").alias("anio"), dec2(F.col("o_totalprice")).alias("emision")))


def _unit_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _facts(spark, sf_dir).dropna(subset=["anio", "emision"])
    return facts.groupBy("contaminante", "unidad", "anio").agg(F.sum("emision").alias("emision"))


_FACTS = """SELECT o_orderpriority AS contaminante, n_name AS unidad, c_mktsegment AS sector, CAST(year(o_orderdate) AS INTEGER) AS anio,
  CAST(o_totalprice AS DECIMAL(18,2)) AS emision FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
_UNIT_SERIES = f"""SELECT contaminante, unidad, anio AS x, CAST(sum(emision) AS DOUBLE) AS y FROM ({_FACTS})
  WHERE anio IS NOT NULL AND emision IS NOT NULL GROUP BY ALL"""


def unit_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: Theil-Sen and Mann-Kendall per pollutant and unit."""
    return trends.theil_sen(_unit_series(spark, sf_dir), ["contaminante", "unidad"], "anio", "emision")


_POLY = "0.0"
for _b in reversed(trends.NORMAL_B):
    _POLY = f"(({_POLY} + {_b!r}::DOUBLE) * t)"
UNIT_TREND = f"""
WITH s AS ({_UNIT_SERIES}),
pairs AS (SELECT contaminante, unidad, (b.y - a.y) / (b.x - a.x) AS slope, sign(b.y - a.y) AS way FROM s a JOIN s b USING (contaminante, unidad) WHERE b.x > a.x),
slopes AS (SELECT contaminante, unidad, list_sort(list(slope)) AS q, sum(way)::BIGINT AS mk_s, count(*) AS np FROM pairs GROUP BY ALL),
ties AS (SELECT contaminante, unidad, sum(k * (k - 1) * (2 * k + 5)) AS tied FROM (SELECT contaminante, unidad, y, count(*) AS k FROM s GROUP BY ALL) GROUP BY ALL),
n AS (SELECT contaminante, unidad, count(*) AS n FROM s GROUP BY ALL),
d AS (SELECT *, (n * (n - 1) * (2 * n + 5) - tied)::DOUBLE / 18.0::DOUBLE AS mk_var, (q[((np + 1) // 2)::INT] + q[(np // 2 + 1)::INT]) / 2 AS slope
  FROM n JOIN ties USING (contaminante, unidad) LEFT JOIN slopes USING (contaminante, unidad)),
rest AS (SELECT contaminante, unidad, list_sort(list(y - slope * x)) AS r FROM s JOIN d USING (contaminante, unidad) GROUP BY ALL),
z AS (SELECT *, CASE WHEN mk_var > 0 THEN (mk_s - sign(mk_s)) / sqrt(mk_var) ELSE 0 END AS z, {trends.Z95!r}::DOUBLE * sqrt(mk_var) AS wide FROM d JOIN rest USING (contaminante, unidad)),
t AS (SELECT *, 1 / (1 + {trends.NORMAL_P!r}::DOUBLE * abs(z)) AS t FROM z),
p AS (SELECT *, round(least(1.0, 2 * ({trends.NORMAL_C!r}::DOUBLE * exp(-z * z / 2) * {_POLY})), 6) AS p FROM t)
SELECT contaminante, unidad, n::BIGINT AS n_anios, slope AS pendiente,
  CASE WHEN n > 1 THEN q[greatest(1, floor((np - wide) / 2)::INT)] END AS pendiente_inf, CASE WHEN n > 1 THEN q[least(np, ceil((np + wide) / 2)::INT + 1)::INT] END AS pendiente_sup,
  CASE WHEN n > 1 THEN (r[((n + 1) // 2)::INT] + r[(n // 2 + 1)::INT]) / 2 END AS intercepto, coalesce(mk_s, 0)::BIGINT AS mk_s, mk_var,
  round(z, 6) AS mk_z, p AS p_valor, round(CASE WHEN n > 1 THEN mk_s / np END, 6) AS tau,
  CASE WHEN p < 0.05 THEN CASE WHEN mk_s > 0 THEN 'sube' ELSE 'baja' END ELSE 'sin tendencia' END AS tendencia
FROM p
"""


def unit_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of each pollutant's and unit's annual series."""
    return trends.change_points(_unit_series(spark, sf_dir), ["contaminante", "unidad"], "anio", "emision")


UNIT_CHANGE_POINTS = f"""
WITH RECURSIVE s AS ({_UNIT_SERIES}),
a AS (SELECT contaminante, unidad, list(x ORDER BY x) AS xs, list(y ORDER BY x) AS ys, count(*)::INT AS n FROM s GROUP BY ALL),
m AS (SELECT *, list_reduce(list_prepend(0.0::DOUBLE, ys), lambda p, v: p + v) / n AS mean FROM a),
c AS (SELECT *, list_transform(ys, lambda v: v - mean) AS cs FROM m),
b AS (SELECT contaminante, unidad, xs, n, mean,
  {trends.PENALTY!r}::DOUBLE * CASE WHEN n > 1 THEN list_reduce(list_prepend(0.0::DOUBLE, list_transform(range(1, n), lambda i: (cs[i + 1] - cs[i]) * (cs[i + 1] - cs[i]))), lambda p, v: p + v) / (2 * (n - 1)) ELSE 0.0 END * ln(n::DOUBLE) AS beta,
  list_transform(range(0, n + 1), lambda i: list_reduce(list_prepend(0.0::DOUBLE, cs[1:i]), lambda p, v: p + v)) AS s1,
  list_transform(range(0, n + 1), lambda i: list_reduce(list_prepend(0.0::DOUBLE, list_transform(cs[1:i], lambda v: v * v)), lambda p, v: p + v)) AS s2 FROM c),
dp AS (SELECT contaminante, unidad, 0 AS t, [0.0::DOUBLE] AS best, [0::INT] AS last FROM b
  UNION ALL SELECT contaminante, unidad, t + 1, list_append(best, least.v), list_append(last, least.i::INT)
  FROM (SELECT dp.*, list_sort(list_transform(range(0, t + 1), lambda i: {{'v': best[i + 1] + greatest(s2[t + 2] - s2[i + 1] - (s1[t + 2] - s1[i + 1]) * (s1[t + 2] - s1[i + 1]) / (t + 1 - i), 0.0::DOUBLE) + beta, 'i': i}}))[1] AS least
        FROM dp JOIN b USING (contaminante, unidad) WHERE t < n)),
fin AS (SELECT b.*, last FROM dp JOIN b USING (contaminante, unidad) WHERE t = n),
cut AS (SELECT contaminante, unidad, n AS hi, last[n + 1] AS lo FROM fin
  UNION ALL SELECT cut.contaminante, cut.unidad, cut.lo, fin.last[cut.lo + 1] FROM cut JOIN fin USING (contaminante, unidad) WHERE cut.lo > 0),
seg AS (SELECT contaminante, unidad, lo, hi, row_number() OVER o AS segmento, xs[lo + 1] AS anio_inicio, xs[hi] AS anio_fin, (hi - lo)::BIGINT AS anios,
  (s1[hi + 1] - s1[lo + 1]) / (hi - lo) + mean AS media FROM cut JOIN fin USING (contaminante, unidad) WINDOW o AS (PARTITION BY contaminante, unidad ORDER BY lo)),
prev AS (SELECT *, lag(media) OVER (PARTITION BY contaminante, unidad ORDER BY lo) AS antes FROM seg)
SELECT contaminante, unidad, segmento, anio_inicio, anio_fin, anios, round(media, 4) AS media, round(media - antes, 4) AS cambio,
  round((media - antes) / abs(antes), 6) AS cambio_relativo FROM prev
"""


def change_by_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's change from the year before that it has, as a sum over priorities."""
    o = load(spark, sf_dir, "orders")
    totals = (o.where(F.col("o_orderdate").isNotNull()).groupBy(F.col("o_custkey").alias("lugar"), F.col("o_orderpriority").alias("sector"), F.year("o_orderdate").alias("anio"))
              .agg(F.sum(dec2(F.col("o_totalprice"))).alias("emision")))
    out = trends.change_by_part(totals, ["lugar"], "sector", "anio", "emision")
    return out.select(*[F.col(c).cast("double").alias(c) if c in ("anterior", "actual", "aporte", "cambio") else c for c in out.columns])


CHANGE_BY_SECTOR = """
WITH t AS (SELECT o_custkey AS lugar, o_orderpriority AS sector, CAST(year(o_orderdate) AS INTEGER) AS anio, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL HAVING v IS NOT NULL),
y AS (SELECT lugar, anio, lag(anio) OVER (PARTITION BY lugar ORDER BY anio) AS anio_anterior FROM (SELECT DISTINCT lugar, anio FROM t)),
j AS (SELECT y.lugar, y.anio, y.anio_anterior, t.sector, t.v AS now FROM y JOIN t ON t.lugar IS NOT DISTINCT FROM y.lugar AND t.anio = y.anio WHERE anio_anterior IS NOT NULL),
b AS (SELECT y.lugar, y.anio, y.anio_anterior, t.sector, t.v AS was FROM y JOIN t ON t.lugar IS NOT DISTINCT FROM y.lugar AND t.anio = y.anio_anterior),
f AS (SELECT coalesce(j.lugar, b.lugar) AS lugar, coalesce(j.anio, b.anio) AS anio, coalesce(j.anio_anterior, b.anio_anterior) AS anio_anterior, coalesce(j.sector, b.sector) AS sector,
  coalesce(was, 0) AS anterior, coalesce(now, 0) AS actual, CASE WHEN was IS NULL THEN 'aparece' WHEN now IS NULL THEN 'desaparece' ELSE 'sigue' END AS estado
  FROM j FULL JOIN b ON j.lugar IS NOT DISTINCT FROM b.lugar AND j.anio = b.anio AND j.sector IS NOT DISTINCT FROM b.sector),
w AS (SELECT *, sum(actual - anterior) OVER (PARTITION BY lugar, anio) AS cambio FROM f)
SELECT lugar, anio, anio_anterior, sector, anterior::DOUBLE AS anterior, actual::DOUBLE AS actual, (actual - anterior)::DOUBLE AS aporte, cambio::DOUBLE AS cambio,
  round(CASE WHEN cambio <> 0 THEN (actual - anterior)::DOUBLE / cambio::DOUBLE END, 6) AS participacion, estado FROM w
"""


def sector_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly totals of pollutants against those of sectors."""
    return trends.correlation_by_sector(_facts(spark, sf_dir), "contaminante", "sector", "anio", "emision")


SECTOR_CORRELATION = f"""
WITH f AS (SELECT * FROM ({_FACTS}) WHERE anio IS NOT NULL AND emision IS NOT NULL),
a AS (SELECT contaminante, anio, CAST(sum(emision) AS DOUBLE) AS a FROM f WHERE contaminante IS NOT NULL GROUP BY ALL),
b AS (SELECT sector, anio, CAST(sum(emision) AS DOUBLE) AS b FROM f WHERE sector IS NOT NULL GROUP BY ALL)
SELECT contaminante, sector, count(*) AS n_anios, round(corr(a, b), 6) AS correlacion, round(covar_samp(a, b) / var_samp(b), 6) AS pendiente_sector
FROM a JOIN b USING (anio) GROUP BY contaminante, sector HAVING count(*) >= 3
"""


def coverage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of years without orders, of all customers."""
    o = load(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("anio"))
    return trends.coverage_runs(o, "o_custkey", "anio", load(spark, sf_dir, "customer"), "c_custkey")


COVERAGE_RUNS = """
WITH p AS (SELECT DISTINCT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE o_orderdate IS NOT NULL),
ax AS (SELECT min(y) AS lo, max(y) AS hi FROM p), d AS (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey IS NOT NULL),
g AS (SELECT c_custkey, unnest(range(lo, hi + 1))::INTEGER AS y, lo, hi FROM d, ax),
m AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = g.c_custkey AND p.y = g.y)),
i AS (SELECT *, y - row_number() OVER (PARTITION BY c_custkey ORDER BY y) AS island FROM m)
SELECT c_custkey, min(y) AS desde, max(y) AS hasta, count(*) AS anios, min(y) = any_value(lo) AS abierto_inicio, max(y) = any_value(hi) AS abierto_fin,
  NOT EXISTS (SELECT 1 FROM p WHERE p.k = i.c_custkey) AS sin_datos FROM i GROUP BY c_custkey, island
"""

def reprojected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys and prices as UTM coordinates of zone 19 south, in degrees."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", (300_000 + F.col("o_totalprice").cast("double") / 8).alias("x"), (6_200_000 + F.col("o_orderkey") % 400_000).cast("double").alias("y"))
    lon, lat = geo.utm_to_degrees(F.col("x"), F.col("y"), 19, True)
    return o.select("o_orderkey", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


_XI = "ks - b1 * sin(2 * ks) * cosh(2 * kw) - b2 * sin(4 * ks) * cosh(4 * kw) - b3 * sin(6 * ks) * cosh(6 * kw) - b4 * sin(8 * ks) * cosh(8 * kw)"
_ETA = "kw - b1 * cos(2 * ks) * sinh(2 * kw) - b2 * cos(4 * ks) * sinh(4 * kw) - b3 * cos(6 * ks) * sinh(6 * kw) - b4 * cos(8 * ks) * sinh(8 * kw)"
REPROJECTED_POINTS = f"""
WITH p AS (SELECT o_orderkey, 300000 + o_totalprice::DOUBLE / 8 AS x, 6200000 + (o_orderkey % 400000)::DOUBLE AS y FROM orders),
k AS (SELECT 6378137.0::DOUBLE AS a, (1 / 298.257223563::DOUBLE) / (2 - 1 / 298.257223563::DOUBLE) AS n),
c AS (SELECT a / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) AS r, n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96 - n ** 4 / 360 AS b1, n ** 2 / 48 + n ** 3 / 15 - 437 * n ** 4 / 1440 AS b2,
  17 * n ** 3 / 480 - 37 * n ** 4 / 840 AS b3, 4397 * n ** 4 / 161280 AS b4, 2 * n - 2 * n ** 2 / 3 - 2 * n ** 3 + 116 * n ** 4 / 45 AS d1, 7 * n ** 2 / 3 - 8 * n ** 3 / 5 - 227 * n ** 4 / 45 AS d2,
  56 * n ** 3 / 15 - 136 * n ** 4 / 35 AS d3, 4279 * n ** 4 / 630 AS d4 FROM k),
s AS (SELECT *, (y - 10000000) / (0.9996::DOUBLE * r) AS ks, (x - 500000) / (0.9996::DOUBLE * r) AS kw FROM p, c),
t AS (SELECT *, {_XI} AS xi, {_ETA} AS eta FROM s), u AS (SELECT *, asin(sin(xi) / cosh(eta)) AS chi FROM t)
SELECT o_orderkey, round(-69 + degrees(atan2(sinh(eta), cos(xi))), 7) AS lon,
  round(degrees(chi + d1 * sin(2 * chi) + d2 * sin(4 * chi) + d3 * sin(6 * chi) + d4 * sin(8 * chi)), 7) AS lat FROM u
"""

QUERIES = {"reprojected_points": reprojected_points, "unit_trend": unit_trend, "unit_change_points": unit_change_points, "change_by_sector": change_by_sector,
           "sector_correlation": sector_correlation, "coverage_runs": coverage_runs}
ORACLE = {"reprojected_points": REPROJECTED_POINTS, "unit_trend": UNIT_TREND, "unit_change_points": UNIT_CHANGE_POINTS, "change_by_sector": CHANGE_BY_SECTOR,
          "sector_correlation": SECTOR_CORRELATION, "coverage_runs": COVERAGE_RUNS}
