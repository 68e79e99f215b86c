"""Writers and readers over the shared test tables, each with its DuckDB SQL next to it: tables are
written as the files that the operator expects, to the shared folder, and read back.

Unlike the other queries these start jobs when they are built, as files have to be there before their
headers can be looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger import fixed_values as fv
from airledger.functions import values as V
from airledger.operators import ids, quality, reshape
from airledger.plans import pipeline
from airledger.plans.table_queries import dec2, load
from airledger.session import shared_dir
from airledger.sources import manifest, sinks
from airledger.sources import registers as R

HEADER_TABLES = ("region", "nation", "supplier", "part", "customer")


def _read_back(spark: SparkSession, folder: str) -> DataFrame:
    """All files under ``folder``, whatever their headers."""
    infos = R.catalogue(spark, R.list_files(spark, folder))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [R.read_signature(spark, g) for g in R.group_by_signature(infos)])


def _files(table: DataFrame, least: int) -> int:
    """As many files as ``table`` is read in splits, whose size Spark bounds, so that a task that
    writes one gets no more of a larger table; ``least`` at least."""
    return max(least, table.rdd.getNumPartitions())


def quoted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, with their line breaks and quotes, as CSV in several files and back."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.col("text") != "", F.col("text")).alias("text"))
    folder = shared_dir(spark)
    sinks.write_export(docs.repartition(_files(docs, 3), "doc_id"), folder)
    return _read_back(spark, folder).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")


QUOTED_FILES = "SELECT doc_id, lang, nullif(text, '') AS text FROM documents"


def file_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of one era's files numbered in the order of files and lines, and their ids."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    folder = shared_dir(spark)
    sinks.write_export(o.repartitionByRange(_files(o, 6), "o_orderkey").sortWithinPartitions("o_orderkey"), folder)
    read = _read_back(spark, folder).withColumn("_era", F.lit("2005"))
    out = ids.sequence_across_files(read, "_era", "_file_name")
    return out.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "seq", ids.format_id(F.col("_era"), F.col("seq")).alias("id_unico"))


FILE_ORDER_IDS = """SELECT o_orderkey, seq, '2005' || lpad(seq::VARCHAR, greatest(9, length(seq::VARCHAR))::INT, '0') AS id_unico
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS seq FROM orders)"""


def file_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in one folder per segment; per folder the rows read, too long and kept."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    folder = shared_dir(spark)
    sinks.write_per_group(c, folder, "c_mktsegment", sep=";")
    infos = R.catalogue(spark, R.list_files(spark, folder))
    frames = [R.read_signature(spark, g, drop_long_rows=False) for g in R.group_by_signature(infos)]
    read = reduce(lambda a, b: a.unionByName(b), frames).withColumn("archivo", F.regexp_extract("_file_path", "grupo_archivo=([^/]*)", 1))
    return quality.file_run_summary(read, F.col("c_nationkey").cast("int") < 10, long_row=R.LONG_ROW)


FILE_RUN_SUMMARY = """SELECT c_mktsegment AS archivo, count(*) AS filas_entrada, 0::BIGINT AS filas_largas, count(*) FILTER (c_nationkey < 10) AS "filas_RM",
  CASE WHEN count(*) FILTER (c_nationkey < 10) > 0 THEN 'ok' ELSE 'sin_registros' END AS estado FROM customer GROUP BY c_mktsegment"""


def file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the catalogue of five tables' files, whose rows are all written."""
    folder = shared_dir(spark)
    for t in HEADER_TABLES:
        sinks.write_export(load(spark, sf_dir, t), f"{folder}/tabla={t}", sep=",")
    infos = R.catalogue(spark, R.list_files(spark, folder))
    for i in infos:
        i.name = i.path.split("tabla=")[1].split("/")[0]
    columns = ["archivo", "tipo", "encoding_detectado", "separador", "num_columnas", "columnas_original", "columnas_normalizadas"]
    return R.catalogue_frame(spark, infos).select(*columns).distinct()


FILE_HEADERS = f"""SELECT table_name AS archivo, 'csv' AS tipo, 'UTF-8' AS encoding_detectado, ',' AS separador, count(*)::INTEGER AS num_columnas,
  string_agg(column_name, '|' ORDER BY ordinal_position) AS columnas_original, string_agg(lower(column_name), '|' ORDER BY ordinal_position) AS columnas_normalizadas
FROM information_schema.columns WHERE table_name IN {HEADER_TABLES} GROUP BY table_name"""


def written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a stage of folders by return flag; the rows that the write counted, and those there per folder."""
    li = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    folder = f"{shared_dir(spark)}/stage"
    written = sinks.write_stage(li, folder, partition_by=["l_returnflag"])
    return (spark.read.parquet(folder).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("filas"))
            .withColumn("filas_escritas", F.lit(written).cast("long")))


WRITTEN_COUNTS = "SELECT l_returnflag, count(*) AS filas, (SELECT count(*) FROM lineitem) AS filas_escritas FROM lineitem GROUP BY l_returnflag"

_TOKENS = [" NA ", "nan", "NULL", "None", "#N/A", "n/a", "", "  ", "null", "-NaN", "sí", "NaN", "0", "na"]


def missing_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing words in a part's cells, as the rules read them and as pandas would."""
    cell = F.get(F.array(*map(F.lit, _TOKENS)), F.col("p_partkey").cast("int") % (len(_TOKENS) + 2))
    part = load(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % (len(_TOKENS) + 2) < len(_TOKENS), cell).otherwise(F.concat(F.lit(" "), "p_type")).alias("celda"))
    return part.select("p_partkey", V.is_na_word(F.col("celda")).alias("falta"), V.clean_null(F.col("celda")).alias("limpia"),
                       V.clean_pandas_na(F.col("celda")).alias("pandas"))


def _quoted(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


MISSING_WORDS = f"""WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % {len(_TOKENS) + 2} < {len(_TOKENS)} THEN list_extract([{_quoted(_TOKENS)[1:-1]}], (p_partkey % {len(_TOKENS) + 2})::INT + 1)
  ELSE ' ' || p_type END AS celda FROM part)
SELECT p_partkey, lower(trim(celda)) IN {_quoted(fv.NA_WORDS)} AS falta, CASE WHEN lower(trim(celda)) NOT IN {_quoted(fv.NA_WORDS)} THEN trim(celda) END AS limpia,
  CASE WHEN celda NOT IN {_quoted(fv.PANDAS_NA_TOKENS)} THEN celda END AS pandas FROM c"""


def gold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products of a gold table written as a stage and read back, in one long table."""
    o, c, n = (load(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    gold = (o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
            .select(F.year("o_orderdate").alias("año"), F.col("c_mktsegment").alias("comuna"), F.col("o_orderpriority").alias("actividad_macro"),
                    F.col("o_orderstatus").alias("contaminante_canon"), F.col("n_name").alias("unidad_paisaje"), dec2(F.col("o_totalprice")).cast("double").alias("emision_total")))
    folder = f"{shared_dir(spark)}/gold"
    sinks.write_stage(gold, folder, partition_by=["año"])
    made = pipeline.products(spark.read.parquet(folder), year=1996)
    long = lambda name, a, b, value: made[name].select(F.lit(name).alias("producto"), F.col(a).cast("string").alias("clave_1"), F.col(b).cast("string").alias("clave_2"), F.col(value).alias("valor"))
    return reduce(DataFrame.unionByName, [long("annual_totals", "contaminante_canon", "año", "emision"), long("running_totals", "contaminante_canon", "año", "emision_acumulada"),
                                          long("municipality_totals", "comuna", "contaminante_canon", "emision_total"), long("macro_share", "contaminante_canon", "actividad_macro", "total"),
                                          long("unit_report", "contaminante_canon", "unidad_paisaje", "emision_total")])


GOLD_PRODUCTS = """
WITH g AS (SELECT year(o_orderdate)::INTEGER AS y, c_mktsegment AS comuna, o_orderpriority AS macro, o_orderstatus AS cont, n_name AS unidad, CAST(o_totalprice AS DECIMAL(18,2)) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
a AS (SELECT cont, y, sum(v) AS t FROM g GROUP BY ALL)
SELECT 'annual_totals' AS producto, cont AS clave_1, y::VARCHAR AS clave_2, t::DOUBLE AS valor FROM a
UNION ALL SELECT 'running_totals', cont, y::VARCHAR, (sum(t) OVER (PARTITION BY cont ORDER BY y))::DOUBLE FROM a
UNION ALL SELECT 'municipality_totals', comuna, cont, sum(v)::DOUBLE FROM g WHERE y = 1996 GROUP BY comuna, cont
UNION ALL SELECT 'macro_share', cont, macro, sum(v)::DOUBLE FROM g GROUP BY cont, macro
UNION ALL SELECT 'unit_report', cont, unidad, sum(v)::DOUBLE FROM g WHERE y = 1996 GROUP BY cont, unidad
"""

def replaced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of orders in a folder of files per year, after the files of 1996 were replaced (by finished
    orders only) and those of 1993 removed: only the replaced ones are read again."""
    o = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("anio"), F.col("o_orderpriority").alias("contaminante"), "o_orderstatus", dec2(F.col("o_totalprice")).alias("emision"))
    base = shared_dir(spark)
    folder, state, keys = f"{base}/registers", f"{base}/state", ["contaminante", "anio"]

    def contribute(paths: list[str]) -> DataFrame:
        frames = [R.read_signature(spark, g) for g in R.group_by_signature(R.catalogue(spark, paths))]
        read = reduce(lambda a, b: a.unionByName(b), frames)
        return read.select(F.col("_file_path").alias("file"), "contaminante", F.col("anio").cast("int").alias("anio"), F.col("emision").cast("decimal(18,2)").alias("emision"))

    for year in range(1992, 1999):
        sinks.write_export(o.where(F.col("anio") == year), f"{folder}/{year}")
    manifest.refresh(spark, folder, state, contribute, keys, "emision")
    sinks.write_export(o.where("anio = 1996 and o_orderstatus = 'F'"), f"{folder}/1996")
    sinks.write_export(o.where("anio = 1993").limit(0), f"{folder}/1993")
    manifest.refresh(spark, folder, state, contribute, keys, "emision")
    return manifest.totals(spark, state, keys).withColumn("emision", F.col("emision").cast("double"))


REPLACED_FILES = """SELECT o_orderpriority AS contaminante, year(o_orderdate)::INTEGER AS anio, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS emision FROM orders
WHERE year(o_orderdate) BETWEEN 1992 AND 1998 AND year(o_orderdate) <> 1993 AND (year(o_orderdate) <> 1996 OR o_orderstatus = 'F') GROUP BY ALL"""

def wide_by_found_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly totals as a wide table, a column for each priority that is found."""
    o = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("anio"), "o_orderpriority", dec2(F.col("o_totalprice")).alias("emision"))
    wide = reshape.pivot_years(o, "anio", "o_orderpriority", "emision")
    return wide.select("anio", *[F.col(f"`{c}`").cast("double").alias(c) for c in wide.columns if c != "anio"])


WIDE_BY_FOUND_GROUPS = """SELECT anio, COLUMNS(* EXCLUDE anio)::DOUBLE FROM (PIVOT (SELECT year(o_orderdate)::INTEGER AS anio, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders)
ON o_orderpriority USING sum(v) GROUP BY anio)"""

QUERIES = {f.__name__: f for f in (wide_by_found_groups, replaced_files, quoted_files, file_order_ids, file_run_summary, file_headers, written_counts, missing_words, gold_products)}
ORACLE = {"wide_by_found_groups": WIDE_BY_FOUND_GROUPS, "replaced_files": REPLACED_FILES, "quoted_files": QUOTED_FILES, "file_order_ids": FILE_ORDER_IDS, "file_run_summary": FILE_RUN_SUMMARY, "file_headers": FILE_HEADERS,
          "written_counts": WRITTEN_COUNTS, "missing_words": MISSING_WORDS, "gold_products": GOLD_PRODUCTS}
