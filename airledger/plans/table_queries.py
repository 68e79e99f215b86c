"""The operators of the library run over the shared test tables.

The test tables are a star schema, not pollutant registers, so each query dresses a table
as the register field the operator expects (a price written the Spanish way, a part type
as a pollutant label, a nation as a landscape unit...) with plain column expressions over
*every* row, then applies the operator. ``oracle.py`` holds the same computations as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger import fixed_values as fv
from airledger.functions import text as T
from airledger.functions import values as V
from airledger.operators import geo, ids, lookups, metrics, quality, regions, reshape, shaping
from airledger.operators.tables import fixed_table
from airledger.sources import links

# Lookup tables used by the queries (small, stated once; the SQL oracle uses the same).
# Part type spellings -> canonical code; PROMO is deliberately absent (unmapped report).
TYPE_LABELS = [("Economy", "ECO"), ("Small", "SML"), ("Médium", "MED"), ("Large", "LRG"), ("Standard", "STD")]
# Market segment key -> canonical spelling; HOUSEHOLD is absent (kept as written).
SEGMENT_SPELLINGS = [("automobile", "Automóvil"), ("building", "Construcción"),
                     ("furniture", "Mueble"), ("machinery", "Maquinaria")]
# Landscape units laid over the (x, y) = (embedding[1], embedding[2]) plane: a square with
# a square hole, a triangle, and two overlapping squares.
POLYGONS = [
    ("Cuenca", [[(-0.2, -0.2), (0.2, -0.2), (0.2, 0.2), (-0.2, 0.2)],
                [(-0.05, -0.05), (0.05, -0.05), (0.05, 0.05), (-0.05, 0.05)]]),
    ("Cordillera", [[(0.2, 0.2), (0.6, 0.2), (0.2, 0.6)]]),
    ("Costa", [[(-0.6, -0.6), (-0.25, -0.6), (-0.25, -0.25), (-0.6, -0.25)]]),
    ("Valle", [[(-0.4, -0.4), (-0.1, -0.4), (-0.1, -0.1), (-0.4, -0.1)]]),
]
UNIT_YEAR = 1998
REGION_TARGET = "Región Middle East"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def eu_text(x: Column) -> Column:
    """``1.234,56``: a price written with Spanish separators."""
    return F.translate(F.format_number(x, 2), ",.", ".,")


def dec2(x: Column) -> Column:
    return x.cast("decimal(18,2)")


def _fixed(spark: SparkSession, rows, schema: str) -> DataFrame:
    return fixed_table(spark, rows, schema)


def type_label_dim(spark: SparkSession) -> DataFrame:
    d = _fixed(spark, TYPE_LABELS, "label string, code string")
    return d.select(T.key_pollutant(F.col("label")).alias("_key"), "code")


def type_label(part: DataFrame) -> Column:
    """Four spellings of the part type, chosen by size."""
    t = F.col("p_type")
    return (F.when(F.col("p_size") % 4 == 0, t)
            .when(F.col("p_size") % 4 == 1, F.concat(F.lit(" "), F.lower(t), F.lit(" ")))
            .when(F.col("p_size") % 4 == 2, F.concat(F.initcap(t), F.lit(":")))
            .otherwise(F.replace(t, F.lit("E"), F.lit("É"))))


# --- scalars ---------------------------------------------------------------------------

def locale_number_parse(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    us = F.format_number(F.col("l_extendedprice"), 2)
    eu = eu_text(F.col("l_extendedprice"))
    raw = (F.when(F.col("l_linenumber") == 1, eu)
           .when(F.col("l_linenumber") == 2, us)
           .when(F.col("l_linenumber") == 3, F.replace(us, F.lit(","), F.lit("")))
           .when(F.col("l_linenumber") == 4, F.translate(F.replace(us, F.lit(","), F.lit("")), ".", ","))
           .when(F.col("l_linenumber") == 5, F.concat(F.lit(" "), F.translate(eu, ".", " "), F.lit(" ")))
           .when(F.col("l_linenumber") == 6, F.lit("NA"))
           .otherwise(F.lit("-")))
    d = li.select("l_orderkey", "l_linenumber", raw.alias("texto"))
    rules = {"n1": "n1_text", "n2": "n2_text", "n3": "n3", "n4": "n4", "n5": "n5", "n6": "n6", "n7": "n7",
             "f2": "f2"}
    return V.with_numbers(d, {out: ("texto", rule) for out, rule in rules.items()})


def int_from_float_text(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    s = F.col("p_size").cast("string")
    raw = (F.when(F.col("p_type") == "ECONOMY", F.concat(s, F.lit(".0")))
           .when(F.col("p_type") == "SMALL", F.concat(s, F.lit(".9")))
           .when(F.col("p_type") == "PROMO", F.concat(F.lit(" "), s, F.lit(" ")))
           .when(F.col("p_type") == "LARGE", F.concat(s, F.lit("e0")))
           .when(F.col("p_type") == "MEDIUM", F.concat(F.lit("n"), s))
           .otherwise(s))
    d = part.select("p_partkey", raw.alias("texto"))
    out = lookups.canon_id_group(d, "texto", out="grupo_canonico", id_out="id_int")
    return out.select("p_partkey", "texto", "id_int", "grupo_canonico")


def year_extract(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    fname = F.concat(F.lit("ruea-efp-"), F.year("o_orderdate").cast("string"), F.lit("-ckan_"),
                     F.col("o_orderkey").cast("string"), F.lit(".csv"))
    d = o.select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("string").alias("fecha"), fname.alias("archivo"))
    return d.select("o_orderkey", "archivo",
                    V.year_first(F.col("fecha")).alias("anio_fecha"),
                    V.year_first(F.col("o_orderpriority")).alias("anio_prioridad"),
                    V.year_from_name_first(F.col("archivo")).alias("anio_primero"),
                    V.year_from_name_last(F.col("archivo")).alias("anio_ultimo"))


def text_key(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    keys = T.with_text_keys(docs, "text", {"k_t1": "region", "k_t2": "pollutant", "k_t3": "description",
                                           "k_t4": "centre", "k_t5": "municipality"})
    return keys.select("doc_id", "k_t1", "k_t2", "k_t3", "k_t4", "k_t5")


def snake_name(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    label = F.concat(F.col("p_brand"), F.lit(" / "), F.col("p_type"))
    return part.select("p_partkey", T.snake_name(F.col("p_name")).alias("nombre_snake"),
                       T.snake_name(label).alias("marca_snake"), T.safe_file_name(label).alias("archivo"))


# --- filters ---------------------------------------------------------------------------

def region_filter(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    d = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        "n_nationkey", "n_name", "r_name", F.concat(F.col("r_name"), F.lit(" (RM)")).alias("etiqueta"))
    return d.select(
        "n_nationkey", "n_name", "r_name",
        regions.is_metropolitan(F.col("r_name")).cast("int").alias("es_rm_nombre"),
        regions.is_metropolitan(F.col("etiqueta")).cast("int").alias("es_rm_etiqueta"),
        regions.region_matches(F.col("r_name"), REGION_TARGET).cast("int").alias("coincide_objetivo"),
        regions.region_equals(F.col("r_name"), "Europe").cast("int").alias("igual_exacto"),
    )


def range_and_list_filter(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumn("anio", F.year("o_orderdate"))
    o = regions.year_between(o, 1995, 1997, col="anio")
    o = regions.keep_listed(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    o = regions.drop_missing(o, ["o_totalprice"])
    return o.select("o_orderkey", "anio", "o_orderpriority")


# --- lookups ---------------------------------------------------------------------------

def canon_label(spark, sf_dir):
    part = load(spark, sf_dir, "part").select("p_partkey", type_label(load(spark, sf_dir, "part")).alias("etiqueta"))
    out = lookups.canon_label(part, "etiqueta", out="codigo", dim=type_label_dim(spark))
    return out.select("p_partkey", "etiqueta", "codigo")


def canon_unmapped(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    labels = part.select(type_label(part).alias("etiqueta"))
    return lookups.unmapped_values(labels, "etiqueta", type_label_dim(spark), T.key_pollutant)


def canon_spelling(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    raw = (F.when(F.col("c_nationkey") % 3 == 0, seg)
           .when(F.col("c_nationkey") % 3 == 1, F.concat(F.initcap(seg), F.lit(" ")))
           .otherwise(F.concat(F.lit("-"), F.lower(seg))))
    d = c.select("c_custkey", raw.alias("comuna"))
    dim = _fixed(spark, SEGMENT_SPELLINGS, "key string, spelling string").select(
        T.key_municipality(F.col("key")).alias("_key"), "spelling")
    out = lookups.canon_spelling(d, "comuna", dim=dim, out="comuna_canon")
    return out.select("c_custkey", "comuna", "comuna_canon")


def canon_id_default(spark, sf_dir):
    n = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_nationkey").cast("string").alias("id_txt"))
    out = lookups.canon_id_group(n, "id_txt", out="grupo_canonico", id_out="id_int")
    return out.select("n_nationkey", "grupo_canonico")


def _activity_facts(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    ciiu6 = (F.when(size % 5 == 0, F.lit(None).cast("string"))
             .when(size % 5 == 1, F.lit(" na "))
             .otherwise(F.col("p_partkey").cast("string")))
    ciiu4 = F.concat(F.substring("p_type", 1, 1), size.cast("string"))
    return part.select("p_partkey", ciiu6.alias("ciiu6_id"), ciiu4.alias("ciiu4_id"),
                       size.cast("string").alias("rubro_id"))


def _activity_codes(spark, sf_dir) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return lookups.activity_code_dim(
        docs.select(F.col("doc_id").cast("string").alias("codigo"), F.col("text").alias("descripcion"), "doc_id"), "doc_id")


def macro_classify(spark, sf_dir):
    facts = _activity_facts(load(spark, sf_dir, "part"))
    out = lookups.add_activity(facts, _activity_codes(spark, sf_dir))
    return out.select("p_partkey", "actividad_canon", "actividad_macro")


# --- shaping ---------------------------------------------------------------------------

def _pair_frame(spark, sf_dir) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("bigint").cast("string")
    ln = F.col("l_linenumber")
    primary = F.when(ln == 1, F.lit(None).cast("string")).otherwise(q)
    secondary = (F.when(ln == 2, F.lit(None).cast("string"))
                 .when(ln == 3, F.concat(q, F.lit(".0")))
                 .when(ln == 4, (F.col("l_quantity").cast("bigint") + 1).cast("string"))
                 .otherwise(q))
    unit = (F.when(F.col("l_returnflag") == "R", F.lit("ton/año"))
            .when(F.col("l_returnflag") == "A", F.lit("Tn/año")).otherwise(F.lit("t/año")))
    return li.select("l_orderkey", "l_linenumber", primary.alias("cantidad_toneladas"),
                     secondary.alias("emision_total"), unit.alias("unidad"))


def merge_pair(spark, sf_dir):
    d = shaping.merge_pair(_pair_frame(spark, sf_dir), "cantidad_toneladas", "emision_total")
    d = shaping.normalize_units(d)
    return d.select("l_orderkey", "l_linenumber", "cantidad_toneladas", "unidad")


def merge_conflicts(spark, sf_dir):
    return shaping.merge_conflicts(_pair_frame(spark, sf_dir), [("cantidad_toneladas", "emision_total")])


def value_fallback(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    eu = eu_text(F.col("l_extendedprice"))
    src = (F.when(ln == 1, F.lit("-")).when(ln == 2, F.lit("NA")).when(ln == 3, F.lit(None).cast("string"))
           .otherwise(eu))
    total = F.when(ln <= 2, F.lit(None).cast("string")).otherwise(F.format_number(F.col("l_extendedprice"), 2))
    primario = F.when(ln == 1, F.lit("-")).otherwise(eu_text(F.col("l_tax") * 1000))
    comb = eu_text(F.col("l_discount") * 1000)
    d = li.select("l_orderkey", "l_linenumber", src.alias("cantidad_toneladas"), total.alias("emision_total"),
                  primario.alias("emision_primario"), comb.alias("emision_combustible_primario"))
    d = shaping.with_emission_text(d, "cantidad_toneladas", "emision_texto")
    return d.select("l_orderkey", "l_linenumber", "emision_texto",
                    V.safe_number(F.col("emision_texto")).alias("emision"))


def _efp_side(spark, sf_dir) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast("string").alias("id_vu"), F.col("s_name").alias("razon_social"),
                    F.col("s_nationkey").cast("string").alias("comuna"),
                    F.lit("EFP-v1").alias("sistema"),
                    F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("CCF8_primario"))


def _r23_side(spark, sf_dir) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("id_vu"), F.col("c_name").alias("razon_social"),
                    F.col("c_nationkey").cast("string").alias("comuna"),
                    F.col("c_mktsegment").alias("contaminante"),
                    F.concat(F.lit("R"), F.col("c_nationkey").cast("string")).alias("ciiu4_id"),
                    F.lit("x").alias("tipo_outlier"))


def outer_union(spark, sf_dir):
    return reshape.consolidate_full(_efp_side(spark, sf_dir), _r23_side(spark, sf_dir))


def min_union(spark, sf_dir):
    return reshape.consolidate_min(_efp_side(spark, sf_dir), _r23_side(spark, sf_dir))


# --- ids, coordinates, geometry ------------------------------------------------------------

def sequential_id(spark, sf_dir):
    """Ids by year, in order of price then key, with payload columns and a group that is NULL."""
    year = F.year("o_orderdate")
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.when(year != 1996, year).alias("anio"), "o_totalprice", "o_orderstatus", "o_orderpriority")
    seq = ids.sequence_in_group(o, ["anio"], ["o_totalprice", "o_orderkey"], out="_seq")
    label = F.coalesce(F.col("anio").cast("string"), F.lit("s/a"))
    return seq.select("o_orderkey", "anio", "o_totalprice", "o_orderstatus", "o_orderpriority", ids.format_id(label, F.col("_seq")).alias("id_unico"))


def fill_from_centre(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    bal = F.col("c_acctbal")
    comuna = F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Nation-"), F.col("c_nationkey").cast("string")))
    lat = (F.when(bal < 0, F.lit(None).cast("string")).when(bal < 100, F.lit(" na "))
           .otherwise(F.col("c_custkey").cast("string")))
    lon = F.when(bal > 9000, F.lit("")).otherwise(F.col("c_nationkey").cast("string"))
    facts = c.select("c_custkey", comuna.alias("comuna"), lat.alias("latitud"), lon.alias("longitud"))
    n = load(spark, sf_dir, "nation")
    centres = n.select(F.replace(F.col("n_name"), F.lit("_"), F.lit(" ")).alias("comuna"),
                       F.col("n_regionkey").cast("string").alias("latitud"),
                       F.col("n_nationkey").cast("string").alias("longitud"))
    out = lookups.fill_from_centre(facts, centres)
    return out.select("c_custkey", "latitud_nueva", "longitud_nueva")


def point_in_polygon(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    pts = e.select("vec_id",
                   F.col("embedding")[1].cast("double").cast("string").alias("longitud"),
                   F.when(F.col("label") == 0, F.lit(None).cast("string"))
                   .otherwise(F.col("embedding")[2].cast("double").cast("string")).alias("latitud_nueva"),
                   F.col("embedding")[2].cast("double").cast("string").alias("latitud"))
    polys = geo.polygons_from_rings(spark, POLYGONS, name="unidad")
    out = geo.assign_landscape_unit(pts, polys, name="unidad", out="unidad_paisaje", cell=0.1)
    return out.select("vec_id", "unidad_paisaje")


# --- aggregates --------------------------------------------------------------------------

def group_sizes(spark, sf_dir):
    part = load(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("id_contaminantes"))
    g = lookups.canon_id_group(part, "id_contaminantes")
    return metrics.group_sizes(g, "grupo_canonico")


def label_dictionary(spark, sf_dir):
    part = load(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("id_contaminantes"),
                                              F.col("p_type").alias("contaminantes"))
    g = lookups.canon_id_group(part, "id_contaminantes")
    return metrics.label_dictionary(g, ["_id_int_", "contaminantes", "grupo_canonico"], "grupo_canonico")


def _events_profile_frame(spark, sf_dir) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.select(
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("value") < 5, F.lit(None)).otherwise(F.col("value")).cast("string").alias("value_n"),
        F.when(F.col("props").endswith("1}"), F.lit("")).otherwise(F.col("props")).alias("props_n"),
        F.lit(None).cast("string").alias("vacia"),
    )


def null_profile(spark, sf_dir):
    return quality.null_profile(_events_profile_frame(spark, sf_dir), "event_type")


def type_profile(spark, sf_dir):
    return quality.type_profile(_events_profile_frame(spark, sf_dir))


def _yearly_facts(spark, sf_dir) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    y = F.year("l_shipdate")
    value = F.when((F.col("l_returnflag") == "A") & (y == 1996), F.lit(None)).otherwise(dec2(F.col("l_extendedprice")))
    return li.select(F.col("l_returnflag").alias("contaminante"), y.alias("year"), value.alias("emision"))


def annual_totals(spark, sf_dir):
    t = metrics.annual_totals(_yearly_facts(spark, sf_dir), "contaminante", "year", "emision")
    return t.select("contaminante", "year", F.col("emision").cast("double").alias("emision")).orderBy("contaminante", "year")


def running_totals(spark, sf_dir):
    t = metrics.annual_totals(_yearly_facts(spark, sf_dir), "contaminante", "year", "emision")
    r = metrics.running_totals(t, "contaminante", "year", "emision")
    return r.select("contaminante", "year", F.col("emision").cast("double").alias("emision"),
                    F.col("emision_acumulada").cast("double").alias("emision_acumulada"))


def _orders_customer(spark, sf_dir) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.year("o_orderdate").alias("año"), F.col("c_name").alias("comuna"),
        F.col("c_mktsegment").alias("actividad_macro"),
        F.col("o_orderpriority").alias("contaminante_canon"), dec2(F.col("o_totalprice")).alias("emision_total"))


def two_key_totals(spark, sf_dir):
    d = _orders_customer(spark, sf_dir).withColumn("comuna", F.col("actividad_macro"))
    t = metrics.totals_by(d, ["comuna", "contaminante_canon"], "emision_total", year=1996)
    return t.select("comuna", "contaminante_canon", F.col("emision_total").cast("double").alias("emision_total"))


def top20_per_group(spark, sf_dir):
    t = metrics.totals_by(_orders_customer(spark, sf_dir), ["comuna", "contaminante_canon"], "emision_total")
    top = metrics.top_n_per_group(t, "contaminante_canon", "emision_total", "comuna", n=20)
    return top.select("contaminante_canon", "comuna", F.col("emision_total").cast("double").alias("emision_total"), "rank")


def _labelled_parts(spark, sf_dir) -> DataFrame:
    part = load(spark, sf_dir, "part")
    return lookups.canon_label(part.select("p_partkey", type_label(part).alias("etiqueta")), "etiqueta",
                               out="contaminante_canon", dim=type_label_dim(spark))


def _line_value() -> Column:
    return dec2(F.col("l_extendedprice")) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


def unit_totals(spark, sf_dir, year: int) -> DataFrame:
    """A3 for one year: line items meet the part labels, are summed by (label, supplier), and
    only those sums meet the suppliers and nations (exact decimals, so the order of summing
    makes no difference)."""
    li = load(spark, sf_dir, "lineitem")
    li = li.where(regions.in_year(li, "l_shipdate", year))
    labelled = _labelled_parts(spark, sf_dir).where(F.col("contaminante_canon").isNotNull())
    sums = (li.join(labelled, li["l_partkey"] == labelled["p_partkey"])
            .groupBy("contaminante_canon", "l_suppkey").agg(F.sum(_line_value()).alias("_t")))
    s = load(spark, sf_dir, "supplier")
    n = load(spark, sf_dir, "nation")
    f = (sums.join(s, sums["l_suppkey"] == s["s_suppkey"]).join(n, s["s_nationkey"] == n["n_nationkey"])
         .select("contaminante_canon", F.col("n_name").alias("unidad_paisaje"), "_t"))
    return metrics.totals_by(f, ["contaminante_canon", "unidad_paisaje"], "_t", out="emision_total")


def unit_report(spark, sf_dir):
    report = metrics.ordered_report(unit_totals(spark, sf_dir, UNIT_YEAR), "contaminante_canon", "emision_total", "unidad_paisaje")
    return report.withColumn("emision_total", F.col("emision_total").cast("double"))


def _balances(spark, sf_dir) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(F.col("c_mktsegment").alias("contaminante_canon"), dec2(F.col("c_acctbal")).alias("emision_total"))


def distribution(spark, sf_dir):
    d = metrics.distribution(_balances(spark, sf_dir), "contaminante_canon", "emision_total")
    return d.select("contaminante_canon", "total_registros", "registros_positivos", "registros_cero_o_negativos",
                    F.col("emision_min").cast("double").alias("emision_min"),
                    F.col("emision_max").cast("double").alias("emision_max"),
                    "emision_media", "emision_mediana")


def log_histogram(spark, sf_dir):
    b = _balances(spark, sf_dir).withColumn("emision_total", F.col("emision_total").cast("double"))
    h = metrics.log_histogram(b, "contaminante_canon", "emision_total")
    return h.select("contaminante_canon", "bin", "frecuencia")


GROUPS = ["A", "N", "R"]


def _series_long(spark, sf_dir) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    value = F.when(F.col("l_returnflag") == "A", F.lit(None)).otherwise(dec2(F.col("l_quantity")))
    return li.select(F.year("l_shipdate").alias("año"), F.col("l_returnflag").alias("grupo"), value.alias("emision"))


def pivot_series(spark, sf_dir):
    wide = reshape.pivot_years(_series_long(spark, sf_dir), "año", "grupo", "emision", GROUPS)
    return wide.select("año", *[F.col(g).cast("double").alias(g) for g in GROUPS])


def unpivot_series(spark, sf_dir):
    wide = pivot_series(spark, sf_dir)
    long = reshape.unpivot_years(wide, "año", "grupo", "emision", GROUPS)
    return regions.drop_empty_series(long, "grupo", "emision")


def link_discovery(spark, sf_dir):
    """Links whose targets begin with a capital are made data files, by their first letter
    quoted differently or not at all, so that the suffix filter and every quoting are met."""
    pages = load(spark, sf_dir, "pages")
    html = F.col("html")
    for letters, target in (("A-H", "href='/$1.csv'"), ("I-P", "HREF = /$1.XLSX"), ("Q-Z", 'class="x" href="/$1.xls"')):
        html = F.regexp_replace(html, f'href="/([{letters}][A-Za-z]*)"', target)
    return links.discover_links(pages.select("page_id", "url", html.alias("html")))


# --- documented analyses --------------------------------------------------------------------

def top3_units(spark, sf_dir):
    """D1 from sums and counts by supplier, so that only those meet the nations."""
    li = load(spark, sf_dir, "lineitem")
    li = li.where(regions.in_year(li, "l_shipdate", UNIT_YEAR))
    s = load(spark, sf_dir, "supplier")
    n = load(spark, sf_dir, "nation")
    sums = li.groupBy("l_suppkey").agg(F.sum(_line_value()).alias("_t"), F.count(_line_value()).alias("_n"))
    means = (sums.join(s, sums["l_suppkey"] == s["s_suppkey"]).join(n, s["s_nationkey"] == n["n_nationkey"])
             .groupBy(F.col("n_name").alias("unidad_paisaje")).agg((F.sum("_t").cast("double") / F.sum("_n")).alias("media")))
    return metrics.rank_top(means, "unidad_paisaje", "media", 3)


def macro_share(spark, sf_dir):
    s = metrics.share_within(_orders_customer(spark, sf_dir), ["contaminante_canon"], "actividad_macro", "emision_total")
    return s.select("contaminante_canon", "actividad_macro", F.col("total").cast("double").alias("total"),
                    F.col("participacion").cast("double").alias("participacion"))


def _yearly_totals_double(spark, sf_dir) -> DataFrame:
    t = metrics.annual_totals(_yearly_facts(spark, sf_dir), "contaminante", "year", "emision")
    return t.withColumn("emision", F.col("emision").cast("double"))


def extreme_years(spark, sf_dir):
    return metrics.extreme_years(_yearly_totals_double(spark, sf_dir), "contaminante", "year", "emision")


def yearly_increase(spark, sf_dir):
    """D4 over per-customer yearly order totals (each customer plays a pollutant series)."""
    o = load(spark, sf_dir, "orders")
    facts = o.select(F.col("o_custkey").alias("contaminante"), F.year("o_orderdate").alias("year"),
                     dec2(F.col("o_totalprice")).alias("emision"))
    totals = metrics.annual_totals(facts, "contaminante", "year", "emision")
    totals = totals.withColumn("emision", F.col("emision").cast("double"))
    inc = metrics.yearly_increase(totals, "contaminante", "year", "emision", 0.10)
    return inc.select("contaminante", "year", "emision", "anterior", "cambio_relativo")


def coverage_gaps(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("anio"))
    return metrics.coverage_gaps(o, "o_custkey", "anio")


QUERIES = {
    "locale_number_parse": locale_number_parse,
    "int_from_float_text": int_from_float_text,
    "year_extract": year_extract,
    "text_key": text_key,
    "snake_name": snake_name,
    "region_filter": region_filter,
    "range_and_list_filter": range_and_list_filter,
    "canon_label": canon_label,
    "canon_unmapped": canon_unmapped,
    "canon_spelling": canon_spelling,
    "canon_id_default": canon_id_default,
    "macro_classify": macro_classify,
    "merge_pair": merge_pair,
    "merge_conflicts": merge_conflicts,
    "value_fallback": value_fallback,
    "outer_union": outer_union,
    "min_union": min_union,
    "sequential_id": sequential_id,
    "fill_from_centre": fill_from_centre,
    "point_in_polygon": point_in_polygon,
    "group_sizes": group_sizes,
    "label_dictionary": label_dictionary,
    "null_profile": null_profile,
    "type_profile": type_profile,
    "annual_totals": annual_totals,
    "running_totals": running_totals,
    "two_key_totals": two_key_totals,
    "top20_per_group": top20_per_group,
    "unit_report": unit_report,
    "distribution": distribution,
    "log_histogram": log_histogram,
    "pivot_series": pivot_series,
    "unpivot_series": unpivot_series,
    "link_discovery": link_discovery,
    "top3_units": top3_units,
    "macro_share": macro_share,
    "extreme_years": extreme_years,
    "yearly_increase": yearly_increase,
    "coverage_gaps": coverage_gaps,
}
