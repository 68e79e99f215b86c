"""Dimension lookups.

Each lookup is a left join against a dimension. Dimensions built from the fixed value lists
have a known, constant size, so they are broadcast outright; those read from data (activity
codes, municipality centres, the caller's own) carry no hint: the optimizer broadcasts them
when their measured size is under its threshold and joins by shuffle otherwise. Building a
lookup starts no Spark job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger import fixed_values as fv
from airledger.functions import text as T
from airledger.functions import values as V
from airledger.operators.tables import fixed_table

def spread_missing(key: Column, df: DataFrame) -> Column:
    """``key``, with each NULL replaced by a text that no dimension key can be, made of a hash of the
    row (maps have none and are left out). A left join then gives such rows no match, as before, and sends
    unlike rows to different tasks when it shuffles; equal rows share one, which AQE's skew split takes apart."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.coalesce(key, F.concat(F.lit("\0"), F.xxhash64(*hashed).cast("string")))


def _beside(df: DataFrame, key: Column, side: DataFrame, side_key: str) -> DataFrame:
    """``df`` left joined to ``side`` on ``key``. The side's other columns come as ``_lookup_<name>``, so that
    none of the caller's is touched; a caller's column of such a name is an error."""
    taken = [c for c in df.columns if c.startswith("_lookup_")]
    if taken:
        raise ValueError(f"column names beginning with _lookup_ are kept for lookups: {taken}")
    renamed = side.withColumnsRenamed({c: f"_lookup_{c}" for c in side.columns})
    keyed = df.withColumn("_lookup_own", key)
    return keyed.join(renamed, F.col("_lookup_own") == F.col(f"_lookup_{side_key}"), "left")


def _without_lookup(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_lookup_")])


def _fixed_dim(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A dimension from a fixed value list; ``pos`` keeps list order."""
    return fixed_table(spark, [(i, *r) for i, r in enumerate(rows)], f"pos int, {schema}")


def _last_per_key(dim: DataFrame, key: str) -> DataFrame:
    """Dictionary semantics: when two entries share a key, the later one (highest ``pos``)
    wins. ``max_by`` is an aggregate, so duplicates are combined on each executor before
    the shuffle: a key repeated in a large share of the rows never lands whole in one task."""
    rest = [c for c in dim.columns if c not in (key, "pos")]
    if not rest:
        return dim.select(key).distinct()
    last = dim.groupBy(key).agg(F.max_by(F.struct(*rest), F.col("pos")).alias("_last"))
    return last.select(key, *[F.col("_last")[c].alias(c) for c in rest])


def _side(dim: DataFrame | None, default_builder, df: DataFrame) -> DataFrame:
    """The library's own dimensions are built from the fixed lists (constant size) and are
    broadcast outright; one passed by the caller is left to the optimizer."""
    return F.broadcast(default_builder(df.sparkSession)) if dim is None else dim


# --- J3 pollutant label -> code ------------------------------------------------------

def pollutant_dim(spark: SparkSession, labels: list[tuple[str, str]] = fv.POLLUTANT_LABELS) -> DataFrame:
    dim = _fixed_dim(spark, labels, "label string, code string")
    dim = dim.withColumn("_key", T.key_pollutant(F.col("label"))).drop("label")
    return _last_per_key(dim, "_key")


def canon_label(df: DataFrame, col: str, out: str = "contaminante_canon", dim: DataFrame | None = None) -> DataFrame:
    """Canonical code of a free-text label through the T2 key; unmatched -> NULL."""
    side = _side(dim, pollutant_dim, df)
    joined = _beside(df, spread_missing(T.key_pollutant(F.col(col)), df), side, "_key")
    return _without_lookup(joined.withColumn(out, F.col("_lookup_code")))


# --- J4 pollutant id -> group ----------------------------------------------------------

def group_dim(spark: SparkSession, rows: list[tuple[int, str]] = fv.POLLUTANT_ID_GROUPS) -> DataFrame:
    """Pollutant id -> group from the fixed list. The key is the raw id, so "a later entry
    wins" is settled on the list itself (a dict keeps the last value of a repeated key)."""
    return fixed_table(spark, list(dict(rows).items()), "_id long, grupo string")


def canon_id_group(df: DataFrame, id_col: str, out: str = "grupo_canonico", id_out: str = "_id_int_",
                   default: str = fv.DEFAULT_GROUP, dim: DataFrame | None = None) -> DataFrame:
    """J4 + F3: integer id from text (``"44.0"`` -> 44), group by id, default group otherwise."""
    side = _side(dim, group_dim, df)
    keyed = df.withColumn(id_out, V.int_from_text(F.col(id_col)))
    joined = _beside(keyed, F.col(id_out), side, "_id")
    return _without_lookup(joined.withColumn(out, F.coalesce(F.col("_lookup_grupo"), F.lit(default))))


# --- J6 municipality spelling ----------------------------------------------------------

def municipality_dim(spark: SparkSession, rows: list[tuple[str, str]] = fv.MUNICIPALITIES) -> DataFrame:
    dim = _fixed_dim(spark, rows, "key string, spelling string")
    dim = dim.withColumn("_key", T.key_municipality(F.col("key"))).drop("key")
    return _last_per_key(dim, "_key")


def canon_spelling(df: DataFrame, col: str, dim: DataFrame | None = None, out: str | None = None,
                   key_fn=T.key_municipality) -> DataFrame:
    """Replace a name by its canonical spelling; unknown or missing names are kept."""
    side = _side(dim, municipality_dim, df)
    out = out or col
    joined = _beside(df, spread_missing(F.when(~V.is_na_word(F.col(col)), key_fn(F.col(col))), df), side, "_key")
    return _without_lookup(joined.withColumn(out, F.coalesce(F.col("_lookup_spelling"), F.col(col))))


# --- J7 unmapped report ----------------------------------------------------------------

def unmapped_values(df: DataFrame, col: str, dim: DataFrame, key_fn, dim_key: str = "_key") -> DataFrame:
    """Distinct non-missing values whose key has no dimension entry, sorted. The
    values are de-duplicated *before* the anti-join, so the join sees one row per label."""
    values = (df.select(F.col(col).alias("valor")).where(~V.is_na_word(F.col("valor"))).distinct()
              .withColumn(dim_key, key_fn(F.col("valor"))))
    return (values.join(dim.select(dim_key), on=dim_key, how="left_anti")
            .select("valor").orderBy("valor"))


def missing_value_count(df: DataFrame, col: str) -> DataFrame:
    """Rows whose label is missing: reported apart from J7 (decision 6)."""
    return df.agg(F.count_if(V.is_na_word(F.col(col))).cast("long").alias("sin_valor"))


# --- P16 / J5 / J8 activity ------------------------------------------------------------

def prefer_code(df: DataFrame, columns: list[str] = fv.ACTIVITY_CODE_COLUMNS) -> Column:
    """First usable (non-missing, stripped) value among the columns that exist."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return F.lit(None).cast("string")
    return F.coalesce(*[V.clean_null(F.col(c)) for c in present])


def keyword_macro(desc_key: Column, rules: list[tuple[str, str]] = fv.KEYWORD_MACRO) -> Column:
    """First rule whose keyword occurs in the normalised description (list order)."""
    expr = None
    for kw, macro in rules:
        expr = (F.when(desc_key.contains(kw), F.lit(macro)) if expr is None
                else expr.when(desc_key.contains(kw), F.lit(macro)))
    return expr


def letter_of(code: Column) -> Column:
    """First alphabetic character of the code (any script), upper-cased; NULL if none."""
    first = F.regexp_extract(code, r"(\p{L})", 1)
    return F.when(first != "", F.upper(first))


def macro_of(code: Column, by_keyword: Column) -> Column:
    """Macro of the code's letter, else of the keyword, else OTHER. A letter with no macro falls
    through to the keyword, as in the source."""
    letter_map = F.create_map(*[x for pair in fv.LETTER_MACRO for x in (F.lit(pair[0]), F.lit(pair[1]))])
    return F.coalesce(F.try_element_at(letter_map, letter_of(code)), by_keyword, F.lit(fv.DEFAULT_MACRO))


def classify_macro(code: Column, desc: Column) -> Column:
    """J8 of a code and its description: the first keyword that the description has counts."""
    return macro_of(code, F.when(desc.isNotNull() & (desc != ""), keyword_macro(T.key_description(desc))))


def activity_code_dim(codes: DataFrame, order_col: str, code_col: str = "codigo", desc_col: str = "descripcion") -> DataFrame:
    """Code -> keyword sector of its description; missing codes dropped, the last entry of
    a duplicated code wins (``order_col`` gives file order). The sector is found per row, before
    the de-duplication, so the descriptions themselves are never shuffled."""
    staged = codes.select(V.clean_null(F.col(code_col)).alias("_code"), F.col(order_col).alias("pos"),
                          T.key_description(F.coalesce(T.strip_ws(F.col(desc_col)), F.lit(""))).alias("_dkey")).where(F.col("_code").isNotNull())
    rows = staged.select("_code", "pos", F.when(F.col("_dkey") != "", keyword_macro(F.col("_dkey"))).alias("_kw"), F.lit(True).alias("_known"))
    return _last_per_key(rows, "_code")


def add_activity(df: DataFrame, code_dim: DataFrame, columns: list[str] = fv.ACTIVITY_CODE_COLUMNS) -> DataFrame:
    """``actividad_canon`` is the preferred code when the dimension knows it;
    ``actividad_macro``: letter of the code, else (known codes only) the description's
    keyword sector, else OTHER."""
    code = prefer_code(df, columns)
    joined = _beside(df, spread_missing(code, df), code_dim, "_code")
    known = F.col("_lookup__known").isNotNull()
    own = F.when(~F.startswith("_lookup_own", F.lit("\0")), F.col("_lookup_own"))
    macro = macro_of(own, F.when(known, F.col("_lookup__kw")))
    return _without_lookup(joined.withColumns({"actividad_canon": F.when(known, F.col("_lookup__code")), "actividad_macro": macro}))


def unmapped_codes(df: DataFrame, code_dim: DataFrame, columns: list[str] = fv.ACTIVITY_CODE_COLUMNS) -> DataFrame:
    """J7 for activity codes: preferred codes missing from the dimension, sorted."""
    codes = df.select(prefer_code(df, columns).alias("_code")).where("_code IS NOT NULL").distinct()
    return (codes.join(code_dim.select("_code"), on="_code", how="left_anti")
            .select(F.col("_code").alias("valor")).orderBy("valor"))


def macros_seen(df: DataFrame, col: str = "actividad_macro") -> DataFrame:
    """Set of macro sectors present, sorted."""
    return df.select(col).distinct().orderBy(col)


# --- J1 centres ------------------------------------------------------------------------

def centre_dim(centres: DataFrame, name_col: str = "comuna", lat_col: str = "latitud",
               lon_col: str = "longitud") -> DataFrame:
    """Centres keyed by the T4 key; one centre per key (decision 12: duplicates would
    multiply rows), chosen deterministically."""
    keyed = centres.select(
        T.key_centre(F.col(name_col)).alias("_ckey"),
        F.col(lat_col).alias("latitud_centro"),
        F.col(lon_col).alias("longitud_centro"),
    ).where(F.col("_ckey").isNotNull())
    # The smallest (latitude, longitude) per key: struct order is field by field, NULL
    # first, as an ascending sort. An aggregate, so repeated keys combine map-side.
    first = keyed.groupBy("_ckey").agg(F.min(F.struct("latitud_centro", "longitud_centro")).alias("_c"))
    return first.select("_ckey", F.col("_c.latitud_centro").alias("latitud_centro"),
                        F.col("_c.longitud_centro").alias("longitud_centro"))


def fill_from_centre(df: DataFrame, centres: DataFrame, name_col: str = "comuna",
                     lat_col: str = "latitud", lon_col: str = "longitud") -> DataFrame:
    """``latitud_nueva``/``longitud_nueva`` = own coordinate when usable, else the
    municipality centre (left join, NULL municipality never matches)."""
    dim = centre_dim(centres)
    joined = _beside(df, spread_missing(T.key_centre(F.col(name_col)), df), dim, "_ckey")

    def choose(orig: str, centre: str) -> Column:
        o = F.col(orig) if orig in df.columns else F.lit(None).cast("string")
        return F.when(V.is_na_word(o), F.col(centre)).otherwise(o)

    return _without_lookup(joined.withColumns({"latitud_nueva": choose(lat_col, "_lookup_latitud_centro"),
                                               "longitud_nueva": choose(lon_col, "_lookup_longitud_centro")}))
