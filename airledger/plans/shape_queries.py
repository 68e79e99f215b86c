"""Column shaping, unions, header catalogues and region choice over the shared test tables, each
with its DuckDB SQL next to it.

As in ``table_queries`` every query dresses whole tables as the register fields its operator
expects. Operators that decide by column names get tables whose columns are named so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.functions import values as V
from airledger.operators import lookups, metrics, quality, regions, reshape, shaping
from airledger.plans.oracle import q_macro_classify, t6
from airledger.plans.table_queries import dec2, eu_text, load, macro_classify
from airledger.sources import registers

ERA_YEARS = [1995, 1996, 1997, 1998]


def canonical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd spellings of register columns become the canonical ones."""
    s = load(spark, sf_dir, "supplier")
    return shaping.canonical_columns(s.select(F.col("s_suppkey").alias("ID VU"), F.col("s_name").alias(" Razón-Social "),
                                              F.col("s_acctbal").alias("CANTIDAD.TONELADA"), F.col("s_nationkey").alias("extra")))


CANONICAL_COLUMNS = "SELECT s_name AS razon_social, s_suppkey AS id_vu, s_acctbal AS cantidad_toneladas, s_nationkey AS extra FROM supplier"


def rename_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``contaminante`` is renamed, ``rut`` is not, as its new name is there."""
    c = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("contaminante"), F.col("c_name").alias("rut"),
                                               F.col("c_nationkey").alias("rut_razon_social"))
    return shaping.rename_if_absent(c, [("contaminante", "contaminantes"), ("rut", "rut_razon_social")])


RENAME_IF_ABSENT = "SELECT c_custkey, c_mktsegment AS contaminantes, c_name AS rut, c_nationkey AS rut_razon_social FROM customer"


def extract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ano`` stands in for ``año``; the amount's text becomes a number."""
    o = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("ano"), F.col("o_orderkey").cast("string").alias("id_vu"),
                                             eu_text(F.col("o_totalprice")).alias("cantidad_toneladas"), F.col("o_orderstatus").alias("otro"))
    out = shaping.extract_columns(o, ["año", "id_vu", "cantidad_toneladas", "comuna"])
    return out.withColumn("cantidad_toneladas", F.col("cantidad_toneladas").cast("double"))


EXTRACT_COLUMNS = ('SELECT CAST(year(o_orderdate) AS INTEGER) AS "año", CAST(o_orderkey AS VARCHAR) AS id_vu, '
                   "CAST(printf('%.2f', o_totalprice) AS DOUBLE) AS cantidad_toneladas FROM orders")


def ensure_rut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables, with ``rut``, with a candidate for it, and with neither; the choice is
    made for each before they are put together."""
    tables = [load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("rut")),
              load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("rut_razon_social")),
              load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("otro"))]
    return reshape.union_all([shaping.ensure_rut(t).select("id", "rut") for t in tables])


ENSURE_RUT = ("SELECT s_suppkey AS id, s_name AS rut FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer "
              "UNION ALL SELECT CAST(n_nationkey AS BIGINT), NULL FROM nation")


def emission_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 + P8: the emission by its fallbacks, put after ``actividad_macro``."""
    li = load(spark, sf_dir, "lineitem")
    own = F.when(F.col("l_linenumber") > 1, eu_text(F.col("l_extendedprice"))).otherwise(F.lit("-"))
    d = li.select("l_orderkey", "l_linenumber", F.lit("X").alias("actividad_macro"), own.alias("cantidad_toneladas"),
                  eu_text(F.col("l_quantity")).alias("emision_primario"))
    out = shaping.add_emission(d, "cantidad_toneladas")
    assert out.columns.index("emision_total") == out.columns.index("actividad_macro") + 1
    return out.select("l_orderkey", "l_linenumber", "actividad_macro", V.safe_number(F.col("emision_total")).alias("emision_total"))


EMISSION_COLUMN = ("SELECT l_orderkey, l_linenumber, 'X' AS actividad_macro, CAST(printf('%.2f', CASE WHEN l_linenumber > 1 THEN l_extendedprice "
                   "ELSE l_quantity END) AS DOUBLE) AS emision_total FROM lineitem")


def cell_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell rule on every column, the unit forced."""
    li = load(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_linenumber") == 1, F.lit(" NA ")).otherwise(F.concat(F.lit(" "), eu_text(F.col("l_extendedprice"))))
    return shaping.normalize_cells(li.select(F.col("l_orderkey").cast("string").alias("clave"), F.col("l_linenumber").cast("string").alias("linea"),
                                             text.alias("valor"), F.col("l_returnflag").alias("unidad")))


CELL_RULES = ("SELECT CAST(l_orderkey AS VARCHAR) AS clave, CAST(l_linenumber AS VARCHAR) AS linea, CASE WHEN l_linenumber = 1 THEN NULL "
              "ELSE printf('%.2f', l_extendedprice) END AS valor, 't/año' AS unidad FROM lineitem")


def region_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + R2 per table: the region column is called differently in each."""
    k = F.col("n_nationkey")
    label = (F.when(k % 4 == 0, F.lit("Región Metropolitana de Santiago")).when(k % 4 == 1, F.lit(" RM ")).when(k % 4 == 2, F.lit("Valparaíso"))
             .otherwise(F.lit("Santiago, Metropolitana")))
    n = load(spark, sf_dir, "nation")
    tables = [n.where(k % 2 == 0).select("n_nationkey", label.alias("Nombre Región")), n.where(k % 2 == 1).select("n_nationkey", label.alias("region"))]
    return reshape.union_all([regions.keep_region(t).select("n_nationkey") for t in tables])


REGION_ROWS = "SELECT n_nationkey FROM nation WHERE n_nationkey % 4 <> 2"


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a file whose first line is its header, a name a word."""
    line = F.replace(F.element_at(F.split("text", "\n"), 1), F.lit(" "), F.lit("|"))
    docs = load(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    return docs.select(F.col("doc_id").cast("string").alias("archivo"), F.lit(1).alias("num_columnas"), line.alias("columnas_original"))


_NAMES = ("n AS (SELECT archivo, o AS columna_original, {t6} AS columna_normalizada FROM (SELECT CAST(doc_id AS VARCHAR) AS archivo, "
          "unnest(string_split(replace(split_part(text, chr(10), 1), ' ', '|'), '|')) AS o FROM documents WHERE text IS NOT NULL))").format(t6=t6("o"))


def header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 over the documents' first lines."""
    return registers.header_map(_headers(spark, sf_dir))


HEADER_MAP = (f"WITH {_NAMES} SELECT columna_original, columna_normalizada, count(*) AS apariciones, count(DISTINCT archivo) AS archivos_distintos "
              "FROM n GROUP BY 1, 2")


def header_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 over the documents' first lines."""
    return registers.header_vocabulary(_headers(spark, sf_dir))


HEADER_VOCABULARY = (f"WITH {_NAMES}, v AS (SELECT columna_normalizada, columna_original, count(*) AS k FROM n GROUP BY 1, 2), "
                     "r AS (SELECT *, row_number() OVER (PARTITION BY columna_normalizada ORDER BY k DESC, columna_original) AS rk FROM v) "
                     "SELECT columna_normalizada, count(*) AS variantes_detectadas, string_agg(columna_original, ' | ' ORDER BY rk) FILTER (WHERE rk <= 5) "
                     "AS ejemplos_variantes, any_value(f) AS archivos_con_esta_columna FROM r JOIN (SELECT columna_normalizada, count(DISTINCT archivo) AS f "
                     "FROM n GROUP BY 1) USING (columna_normalizada) GROUP BY columna_normalizada")


def macros_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sectors that the classified parts have."""
    return lookups.macros_seen(macro_classify(spark, sf_dir))


def macros_seen_sql() -> str:
    return f"SELECT DISTINCT actividad_macro FROM ({q_macro_classify()})"


def _orders_of(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.where(regions.in_year(o, "o_orderdate", year)).select("o_orderkey", F.lit(year).alias("anio"))


def era_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of an era's years put together; each year's range is pushed to its scan."""
    return reshape.fuse_era({y: _orders_of(spark, sf_dir, y) for y in ERA_YEARS}, ERA_YEARS)


ERA_OF_YEARS = "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1998"


def era_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two eras whose pollutant column is spelt differently; all rows stay."""
    early = load(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id_vu"), F.col("c_mktsegment").alias("contaminante"))
    late = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("id_vu"), F.col("s_name").alias("contaminantes"),
                                                  F.lit("t").alias("tipo_fuente"))
    return reshape.consolidate_efp_era([early, late], ["id_vu", "contaminantes", "sistema"])


ERA_UNION = ("SELECT CAST(c_custkey AS VARCHAR) AS id_vu, c_mktsegment AS contaminantes, CAST(NULL AS VARCHAR) AS sistema, CAST(NULL AS VARCHAR) AS tipo_fuente "
             "FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, 't' FROM supplier")


def wide_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 + X4 on running totals: a year's row has each group's total so far, years in order."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("grupo"), F.year("o_orderdate").alias("anio"), dec2(F.col("o_totalprice")).alias("v"))
    running = metrics.running_totals(metrics.annual_totals(o, "grupo", "anio", "v"), "grupo", "anio", "emision")
    wide = reshape.pivot_years(running, "anio", "grupo", "emision_acumulada", ["F", "O", "P"])
    return wide.select("anio", *[F.col(g).cast("double").alias(g) for g in ("F", "O", "P")])


WIDE_PRODUCT = ("WITH t AS (SELECT o_orderstatus AS g, CAST(year(o_orderdate) AS INTEGER) AS anio, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1, 2), "
                "r AS (SELECT g, anio, sum(v) OVER (PARTITION BY g ORDER BY anio) AS a FROM t) SELECT anio, "
                + ", ".join(f"CAST(max(a) FILTER (WHERE g = '{g}') AS DOUBLE) AS \"{g}\"" for g in "FOP") + " FROM r GROUP BY anio ORDER BY anio")

def ambiguous_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision 17 over prices: with the decimals cut, and with all marks the same."""
    whole = F.format_number(F.col("l_extendedprice") * F.when(F.col("l_linenumber") > 4, 1000).otherwise(1), 0)
    text = F.when(F.col("l_linenumber") == 1, F.lit(" NA ")).when(F.col("l_linenumber") == 2, F.replace(whole, F.lit(","), F.lit("."))).otherwise(whole)
    return quality.ambiguous_numbers(load(spark, sf_dir, "lineitem").select(text.alias("precio"), F.col("l_returnflag").alias("marca")), ["precio", "marca"])


AMBIGUOUS_NUMBERS = (
    "WITH t AS (SELECT l_linenumber AS ln, round_even(l_extendedprice * CASE WHEN l_linenumber > 4 THEN 1000 ELSE 1 END, 0) AS w FROM lineitem) "
    "SELECT 'precio' AS columna, count(*) FILTER (WHERE ln <> 1) AS valores, count(*) FILTER (WHERE ln <> 1 AND w >= 1000 AND w < 1000000) AS una_marca, "
    "count(*) FILTER (WHERE ln <> 1 AND w >= 1000000) AS marca_repetida FROM t "
    "UNION ALL SELECT 'marca', count(l_returnflag), 0, 0 FROM lineitem")

QUERIES = {f.__name__: f for f in (canonical_columns, rename_if_absent, extract_columns, ensure_rut, emission_column, cell_rules, region_rows, header_map,
                                   header_vocabulary, macros_seen, era_of_years, era_union, wide_product, ambiguous_numbers)}
ORACLE = {"canonical_columns": CANONICAL_COLUMNS, "rename_if_absent": RENAME_IF_ABSENT, "extract_columns": EXTRACT_COLUMNS, "ensure_rut": ENSURE_RUT,
          "emission_column": EMISSION_COLUMN, "cell_rules": CELL_RULES, "region_rows": REGION_ROWS, "header_map": HEADER_MAP,
          "header_vocabulary": HEADER_VOCABULARY, "macros_seen": macros_seen_sql(), "era_of_years": ERA_OF_YEARS, "era_union": ERA_UNION,
          "wide_product": WIDE_PRODUCT, "ambiguous_numbers": AMBIGUOUS_NUMBERS}
