"""Filters (R1-R11), column shaping (P1-P15), unions (U1-U4) and reshaping."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from airledger import fixed_values as fv
from airledger.operators import regions as RG
from airledger.operators import reshape as RS
from airledger.operators import shaping as S
from helpers import one_col

REGIONS = ["Metropolitana de Santiago", "Región Metropolitana de Santiago (RM)", "RM", "Región Metropolitana",
           "Valparaíso", "Del Maule", None, "Santiago Metropolitana", "region rm", ""]


def test_region_predicates(spark):
    df = one_col(spark, REGIONS, "region")
    got = {r.region: r.m for r in df.select("region", RG.is_metropolitan(F.col("region")).alias("m")).collect()}
    assert got == {"Metropolitana de Santiago": True, "Región Metropolitana de Santiago (RM)": True, "RM": True,
                   "Región Metropolitana": True, "Valparaíso": False, "Del Maule": False, None: False,
                   "Santiago Metropolitana": True, "region rm": True, "": False}
    tgt = {r.region: r.m for r in df.select("region", RG.region_matches(F.col("region"), "Metropolitana de Santiago").alias("m")).collect()}
    assert tgt["Región Metropolitana"] is True and tgt["RM"] is True and tgt["Valparaíso"] is False and tgt[None] is False
    assert tgt["Región Metropolitana de Santiago (RM)"] is True  # contains both words
    other = {r.region: r.m for r in df.select("region", RG.region_matches(F.col("region"), "Región Valparaíso").alias("m")).collect()}
    assert other["Valparaíso"] is True and other["Del Maule"] is False
    # only the word "region" is deleted: "de valparaiso" is not "valparaiso" (strict equality)
    strict = df.select(RG.region_matches(F.col("region"), "Región de Valparaíso").alias("m")).where("m").count()
    assert strict == 0
    eq = {r.region: r.m for r in df.select("region", RG.region_equals(F.col("region"), " rm ").alias("m")).collect()}
    assert eq["RM"] is True and eq["Región Metropolitana"] is False


def test_region_column_detection():
    assert RG.region_column(["año", "id_region", "region"]) == "region"
    assert RG.region_column(["año", "Región del establecimiento"]) == "Región del establecimiento"
    assert RG.region_column(["año", "comuna"]) is None


def test_simple_filters(spark):
    df = spark.createDataFrame([(2005, "a", 1.0), (2010, "b", None), (2023, "c", 0.0), (None, "a", -1.0)],
                               "`año` int, g string, e double")
    assert RG.year_equals(df, 2023).count() == 1
    assert RG.year_between(df, 2006, None).count() == 2
    assert RG.year_between(df, None, None).count() == 4
    assert RG.keep_listed(df, "g", ["a"]).count() == 2 and RG.keep_listed(df, "g", None).count() == 4
    assert RG.drop_missing(df, ["año", "e"]).count() == 2
    series = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("b", None)], "g string, v double")
    assert sorted(set(r.g for r in RG.drop_empty_series(series, "g", "v").collect())) == ["a"]
    grp = spark.createDataFrame([("OTROS",), ("PM10",)], "grupo_canonico string")
    assert [r.grupo_canonico for r in RG.exclude_default_group(grp).collect()] == ["PM10"]


def test_canonical_columns(spark):
    df = spark.createDataFrame([("2019", "x", "13", "Santiago")], "`Año` string, `Razón Social` string, `ciiu4_id` string, `comuna` string")
    out = S.canonical_columns(df, "efp")
    assert out.columns == ["año", "razon_social", "id_ciiu4", "comuna"]
    clash = spark.createDataFrame([("1", "2")], "`ciiu4_id` string, `id_ciiu4` string")
    with pytest.raises(ValueError):
        S.canonical_columns(clash, "efp")


def test_renames_and_ensure(spark):
    df = spark.createDataFrame([("a", "b", "c")], "contaminante string, contaminantes string, rut string")
    out = S.rename_if_absent(df, fv.EFP_ERA_RENAMES)
    assert out.columns == ["contaminante", "contaminantes", "rut_razon_social"]
    filled = S.ensure_columns(out, ["año", "rut_razon_social"])
    assert filled.columns == ["año", "rut_razon_social", "contaminante", "contaminantes"]
    assert filled.first()["año"] is None
    assert S.ensure_rut(spark.createDataFrame([("1",)], "rut_establecimiento string")).first().rut == "1"
    assert S.ensure_rut(spark.createDataFrame([("1",)], "x string")).first().rut is None


def test_merge_pairs_and_conflicts(spark):
    rows = [("1", None), (None, "2"), ("3", "3"), ("4", "5"), ("1", "1.0"), (None, None)]
    df = spark.createDataFrame(rows, "cantidad_toneladas string, emision_total string")
    merged = S.merge_pair(df, "cantidad_toneladas", "emision_total")
    assert merged.columns == ["cantidad_toneladas"]
    assert [r[0] for r in merged.collect()] == ["1", "2", "3", "4", "1", None]
    conf = S.merge_conflicts(df, [("cantidad_toneladas", "emision_total")]).first()
    assert conf.conflictos == 2  # "4" vs "5" and "1" vs "1.0" differ as text
    only_secondary = spark.createDataFrame([("9",)], "emision_total string")
    assert S.merge_pair(only_secondary, "cantidad_toneladas", "emision_total").first().cantidad_toneladas == "9"
    units = spark.createDataFrame([("ton/año",), ("Tn/año",), ("kg",), (None,)], "unidad string")
    assert [r.unidad for r in S.normalize_units(units).collect()] == ["t/año", "t/año", "kg", None]


def test_emission_fallback(spark):
    df = spark.createDataFrame([
        ("1.234,5", "9", "8", "7"), ("-", "9", "8", "7"), ("NA", "-", "8", "7"), (None, None, None, "7,5"),
        (" ", None, None, None)],
        "cantidad_toneladas string, emision_total string, emision_primario string, emision_combustible_primario string")
    out = [r.e for r in S.with_emission_text(df, "cantidad_toneladas", "e").collect()]
    assert out == ["1234.5", "9", "8", "7.5", None]
    without_total = df.drop("emision_total")
    assert S.emission_candidates(without_total, "cantidad_toneladas") == [
        "cantidad_toneladas", "emision_primario", "emision_combustible_primario"]
    placed = S.add_emission(df.withColumn("actividad_macro", F.lit("X")), "cantidad_toneladas")
    assert placed.columns[-1] == "emision_total" and placed.columns.index("emision_total") == placed.columns.index("actividad_macro") + 1


def test_cells_extract_insert(spark):
    df = spark.createDataFrame([(" 1.234,5 ", "kg", "NA")], "a string, unidad string, b string")
    row = S.normalize_cells(df).first()
    assert (row.a, row.unidad, row.b) == ("1234.5", "t/año", None)
    ex = spark.createDataFrame([("2020", "x", "1.234,5", "z")], "ano string, comuna string, cantidad_toneladas string, otra string")
    out = S.extract_columns(ex)
    assert out.columns == ["año", "ano", "comuna", "cantidad_toneladas"]
    assert out.first().cantidad_toneladas == "1234.5"
    with pytest.raises(ValueError):
        S.extract_columns(spark.createDataFrame([("1",)], "x string"))
    ins = S.insert_after(spark.createDataFrame([(1, 2)], "a int, b int"), "c", F.lit(3), "a")
    assert ins.columns == ["a", "c", "b"]


def test_unions(spark):
    efp = spark.createDataFrame([("2005", "A", "1", "Santiago", "x")], "`año` string, razon_social string, id_vu string, comuna string, CCF8_primario string")
    r23 = spark.createDataFrame([("2023", "B", "2", "13", "NOx", "44")],
                                "`año` string, razon_social string, id_vu string, ciiu4_id string, contaminante string, contaminante_id string")
    full = RS.consolidate_full(efp, r23)
    assert full.count() == 2
    rows = {r.fuente_esquema: r for r in full.collect()}
    assert rows["RUEA2023"].id_ciiu4 == "13" and rows["RUEA2023"].contaminantes == "NOx"
    assert rows["EFP"].ccf8_primario == "x" and rows["EFP"].id_ciiu4 is None
    mini = RS.consolidate_min(efp, r23)
    assert mini.columns == fv.MIN_COMMON and mini.count() == 2
    by_year = {2005: efp, 2006: efp}
    with pytest.raises(FileNotFoundError):
        RS.fuse_era(by_year, [2005, 2006, 2007])
    assert RS.fuse_era(by_year, [2005, 2006, 2007], strict=False).count() == 2


def test_pivot_unpivot(spark):
    long = spark.createDataFrame([(2005, "A", 1.0), (2005, "B", 2.0), (2006, "A", 3.0), (2006, "A", None)],
                                 "`año` int, grupo string, v double")
    wide = RS.pivot_years(long, "año", "grupo", "v", ["A", "B", "C"])
    got = {r["año"]: (r.A, r.B, r.C) for r in wide.collect()}
    assert got == {2005: (1.0, 2.0, None), 2006: (3.0, None, None)}
    back = RS.unpivot_years(wide, "año", "grupo", "emision")
    assert back.count() == 6
    kept = RG.drop_empty_series(back, "grupo", "emision")
    assert sorted(set(r.grupo for r in kept.collect())) == ["A", "B"]


def test_wide_table_over_found_groups(spark, monkeypatch):
    from airledger.operators import reshape
    long = spark.createDataFrame([(2001, "b", 1.0), (2000, "a", 2.0), (2001, "a", 4.0), (2001, "b", 3.0), (2002, None, 9.0)], "y int, g string, v double")
    wide = reshape.pivot_years(long, "y", "g", "v")
    assert wide.columns == ["y", "a", "b"]
    assert [tuple(r) for r in wide.collect()] == [(2000, 2.0, None), (2001, 4.0, 4.0), (2002, None, None)]
    monkeypatch.setattr(reshape, "MOST_GROUPS", 1)
    with pytest.raises(ValueError, match="more than 1 groups"):
        reshape.pivot_years(long, "y", "g", "v")
