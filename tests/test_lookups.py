"""Dimension lookups (J1, J3-J8, P16, S12) on the FIXTURES.md edge values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from airledger.functions import text as T
from airledger.operators import lookups as L
from helpers import one_col


def test_pollutant_labels(spark):
    labels = ["MP2,5", "PM2.5, primary", "Dióxido de azúfre (SO2)", "NOx", "Ozono", None, "  nitrogen OXIDES (NOx) ",
              "Arsénico", "PCDD-F"]
    out = L.canon_label(one_col(spark, labels, "contaminantes"), "contaminantes")
    got = {r.contaminantes: r.contaminante_canon for r in out.collect()}
    assert got == {"MP2,5": "PM2_5", "PM2.5, primary": "PM2_5", "Dióxido de azúfre (SO2)": "SO2", "NOx": "NOX",
                   "Ozono": None, None: None, "  nitrogen OXIDES (NOx) ": "NOX", "Arsénico": "ARSENIC",
                   "PCDD-F": "PCDD_F"}
    assert out.count() == len(labels)  # a lookup never multiplies rows
    unmapped = L.unmapped_values(one_col(spark, labels, "contaminantes"), "contaminantes",
                                 L.pollutant_dim(spark), T.key_pollutant)
    assert [r.valor for r in unmapped.collect()] == ["Ozono"]  # NULL is not reported (decision 6)
    assert L.missing_value_count(one_col(spark, labels, "c"), "c").first().sin_valor == 1


def test_group_by_id(spark):
    ids = ["44", "44.0", "44.9", "", "abc", "5", None, "998"]
    out = L.canon_id_group(one_col(spark, ids, "id_contaminantes"), "id_contaminantes")
    got = {r.id_contaminantes: (r._id_int_, r.grupo_canonico) for r in out.collect()}
    assert got == {"44": (44, "Sulfur dioxide (SO2)"), "44.0": (44, "Sulfur dioxide (SO2)"),
                   "44.9": (44, "Sulfur dioxide (SO2)"), "": (None, "OTROS"), "abc": (None, "OTROS"),
                   "5": (5, "OTROS"), None: (None, "OTROS"), "998": (998, "Black Carbon")}


def test_municipality_spelling(spark):
    names = ["ÑUÑOA", "Nunoa", "Maipu", "San José de Maipo", " tiltil ", "Til-Til", None, "NA"]
    out = L.canon_spelling(one_col(spark, names, "comuna"), "comuna", out="canon")
    got = {r.comuna: r.canon for r in out.collect()}
    assert got == {"ÑUÑOA": "Ñuñoa", "Nunoa": "Ñuñoa", "Maipu": "Maipú", "San José de Maipo": "San José de Maipo",
                   " tiltil ": "Tiltil", "Til-Til": "Til-Til", None: None, "NA": "NA"}
    unmapped = L.unmapped_values(one_col(spark, names, "comuna"), "comuna", L.municipality_dim(spark),
                                 T.key_municipality)
    assert [r.valor for r in unmapped.collect()] == ["Til-Til"]


def test_macro_rules(spark):
    rows = [("C101", None), ("Z9", "servicios de gastronomia"), ("Z9", None), ("4510", "Comercio de vehículos"),
            ("4511", "administracion publica"), ("4512", ""), (None, None), ("9999", "Generación eléctrica"),
            ("b-12", "x"), ("12ñ", None)]
    df = spark.createDataFrame(rows, "code string, descr string")
    got = [r.m for r in df.select(L.classify_macro(F.col("code"), F.col("descr")).alias("m")).collect()]
    # letter wins; unknown letter Z falls to keywords ("gas" in gastronomia); "min" catches
    # "administracion" before "public" (decision 7); accents folded before matching.
    assert got == ["MANUFACTURING", "ENERGY", "OTHER", "TRADE", "MINING", "OTHER", "OTHER", "ENERGY", "MINING", "OTHER"]


def test_activity_join(spark):
    codes = spark.createDataFrame([("4510", "Comercio"), ("4510", "Obras publicas"), ("  ", "x"), ("7000", None)],
                                  "codigo string, descripcion string").withColumn("pos", F.monotonically_increasing_id())
    dim = L.activity_code_dim(codes, order_col="pos")
    facts = spark.createDataFrame([
        ("na", "4510", None), (None, None, "7000"), ("C1", None, None), ("9999", None, None), (None, None, None)],
        "ciiu6_id string, id_ciiu4 string, rubro_id string")
    out = L.add_activity(facts, dim).collect()
    got = [(r.actividad_canon, r.actividad_macro) for r in out]
    # "4510": last duplicate wins -> "Obras publicas" -> CONSTRUCTION; "7000": known, blank
    # description -> OTHER; "C1" unknown -> letter; "9999" unknown, no letter -> OTHER.
    assert got == [("4510", "CONSTRUCTION"), ("7000", "OTHER"), (None, "MANUFACTURING"), (None, "OTHER"), (None, "OTHER")]
    missing = [r.valor for r in L.unmapped_codes(facts, dim).collect()]
    assert missing == ["9999", "C1"]


def test_fill_from_centre(spark):
    centres = spark.createDataFrame([("Ñuñoa", "-33.45", "-70.6"), ("Maipú", "-33.5", "-70.7"), ("ÑUÑOA", "-1", "-1")],
                                    "comuna string, latitud string, longitud string")
    facts = spark.createDataFrame([("Ñuñoa", None, " "), ("maipu", "-33.1", "NA"), (None, None, None), ("Til-Til", None, None)],
                                  "comuna string, latitud string, longitud string")
    out = L.fill_from_centre(facts, centres).collect()
    got = [(r.comuna, r.latitud_nueva, r.longitud_nueva) for r in out]
    # duplicate centre keys are reduced to one (decision 12): the row count is unchanged
    assert len(got) == 4
    assert got[1] == ("maipu", "-33.1", "-70.7")
    # the two spellings of one key keep the centre that sorts first, deterministically
    assert got[0] == ("Ñuñoa", "-1", "-1")
    assert got[2] == (None, None, None) and got[3] == ("Til-Til", None, None)



def test_last_per_key_with_a_hot_key(spark):
    """Last-wins de-duplication when one key holds most rows, spread over many partitions:
    the aggregate combines the repeats map-side and keeps the highest position."""
    rows = [(i, "hot", f"v{i}") for i in range(3000)] + [(3000 + i, f"k{i}", f"w{i}") for i in range(50)]
    dim = spark.createDataFrame(rows, "pos long, key string, val string").repartition(7)
    got = dict(L._last_per_key(dim, "key").select("key", "val").collect())
    assert got["hot"] == "v2999" and got["k7"] == "w7" and len(got) == 51


def test_centre_dim_picks_smallest_coordinates(spark):
    centres = spark.createDataFrame([("Ñuñoa", "-33.5", "-70.6"), ("nunoa", "-33.4", "-70.5"),
                                     ("nunoa", None, "-70.9"), ("Maipú", "-33.5", None)],
                                    "comuna string, latitud string, longitud string")
    got = {r._ckey: (r.latitud_centro, r.longitud_centro) for r in L.centre_dim(centres).collect()}
    assert got == {"nunoa": (None, "-70.9"), "maipu": ("-33.5", None)}


def test_columns_named_like_helpers_stay(spark):
    """Columns that the dimensions have too keep their values; a map column and repeated null rows do no harm."""
    df = spark.createDataFrame([(1, "NOx", "mine", "k", "s", "g", "l", {"a": 1}), (2, None, "mine", "k", "s", "g", "l", None), (2, None, "mine", "k", "s", "g", "l", None)],
                               "id long, etiqueta string, code string, _key string, spelling string, grupo string, latitud_centro string, m map<string,int>")
    kept = ["id", "code", "_key", "spelling", "grupo", "latitud_centro"]
    want = sorted(map(tuple, df.select(kept).collect()))
    dim = L.pollutant_dim(spark)
    centres = spark.createDataFrame([("NOx", "1", "2")], "comuna string, latitud string, longitud string")
    codes = L.activity_code_dim(spark.createDataFrame([("NOx", "minas", 1)], "codigo string, descripcion string, pos int"), "pos")
    for out in (L.canon_label(df, "etiqueta", dim=dim), L.canon_id_group(df, "etiqueta"), L.canon_spelling(df, "etiqueta", out="x"),
                L.fill_from_centre(df, centres, "etiqueta"), L.add_activity(df, codes, ["etiqueta"])):
        assert not [c for c in out.columns if c.startswith("_lookup_")] and len(set(out.columns)) == len(out.columns)
        assert sorted(map(tuple, out.select(kept).collect())) == want
    with pytest.raises(ValueError, match="_lookup_"):
        L.canon_label(df.withColumn("_lookup_x", F.lit(1)), "etiqueta")
