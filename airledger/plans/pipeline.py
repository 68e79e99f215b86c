"""Bronze -> silver -> gold -> products, as one lazy Spark plan per stage.

Pipeline A (consolidated table):
    register files -> header catalogue -> one parallel read per header signature ->
    cell rule (N1, unit forced) -> region filter (R1/R2) -> file-order row numbers ->
    pollutant code (J3) -> activity (P16/J5/J8) -> emission (P15) -> municipality (J6) ->
    id (W2, era ids labelled with the era's first year) -> target columns (P7/P4/U5)
    = silver; centres (J1) -> landscape unit (P17/J2) = gold; products from gold.
Pipeline B (totals by pollutant group):
    region filter with target (R3) and N3 numbers -> era consolidation (P2/P4/U2) ->
    EFP + 2023 (U3) -> group by pollutant id (F3/J4) -> pair merges (P14/P12) ->
    extracts (P6) -> annual and running totals (A1/W1), null profile (A8).

Between stages the hand-over is Parquet in the shared checkpoint folder (or the path
the caller gives), partitioned by year, so later year filters prune whole directories and
a lost executor never forces the whole chain to be recomputed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger import fixed_values as fv
from airledger.functions import values as V
from airledger.operators import geo, ids, lookups, metrics, quality, regions, reshape, shaping, trends
from airledger.operators.shaping import q
from airledger.operators.tables import fixed_table
from airledger.sources import registers as R


# --- pipeline A -------------------------------------------------------------------------

def era_label(year_col: str = "_year") -> F.Column:
    """Id label of a year: the first year of its era for fused eras (decision 19), else
    the year itself."""
    expr = None
    for _, years in fv.ERAS:
        cond = F.col(year_col).between(min(years), max(years))
        expr = F.when(cond, F.lit(str(min(years)))) if expr is None else expr.when(cond, F.lit(str(min(years))))
    return expr.otherwise(F.col(year_col).cast("string"))


def check_eras(years_present: set[int]) -> None:
    """A fused era needs every one of its years, and the years after the eras must follow
    one another."""
    expected = [(label, years) for label, years in fv.ERAS if any(y in years_present for y in years)]
    later = {y for y in years_present if y > max(y for _, years in fv.ERAS for y in years)}
    if later:
        expected.append(("later", list(range(min(later), max(later) + 1))))
    for label, years in expected:
        missing = [y for y in years if y not in years_present]
        if missing:
            raise FileNotFoundError(f"era {label} is missing years {missing}")


def chosen_files(infos: list[R.FileInfo]) -> tuple[list[R.FileInfo], list[tuple[str, str]]]:
    """The files to read, and (file, reason) of every one that is not: unreadable files, and
    the earlier by name of two files of one layout and year (decision 3)."""
    reasons = [(i.name, i.error) for i in infos if i.error]
    by_year: dict[tuple[str, int], R.FileInfo] = {}
    for i in sorted((i for i in infos if not i.error), key=lambda i: i.name):
        key = (R.layout_of(i.name), _year_of_name(i.name))
        if key in by_year:
            reasons.append((by_year[key].name, f"replaced by {i.name}"))
        by_year[key] = i
    return list(by_year.values()), reasons


def file_report(spark: SparkSession, infos: list[R.FileInfo]) -> DataFrame:
    """(archivo, estado, motivo): every file found, whether it is read, and if not why."""
    chosen, reasons = chosen_files(infos)
    rows = [(i.name, "ok", None) for i in chosen] + [(n, "no_leido", r) for n, r in reasons]
    return fixed_table(spark, sorted(rows, key=lambda r: r[0]), "archivo string, estado string, motivo string")


def bronze(spark: SparkSession, infos: list[R.FileInfo]) -> list[DataFrame]:
    """One frame per header signature: strings, cell rule applied, region rows only, ``rut``,
    file name, year and layout attached. Decisions that depend on a table's columns (P1, R1, P7)
    are taken here, per signature, before the tables are put together."""
    frames = []
    meta = ["_file_name", "_file_path", "_file_block"]
    for group in R.group_by_signature(chosen_files(infos)[0]):
        raw = R.read_signature(spark, group)
        layout = R.layout_of(group[0].name)
        renamed = shaping.canonical_names([c for c in raw.columns if c not in meta], layout)
        if layout == "efp" and fv.EMISSION_SOURCE_DEFAULT not in renamed.values():
            raise KeyError(f"{group[0].name}: no column '{fv.EMISSION_SOURCE_DEFAULT}'")
        cells = [shaping.cell_rule(q(orig), name) for orig, name in renamed.items()]
        kept = shaping.ensure_rut(regions.keep_region(raw.select(*cells, *meta)))
        frames.append(kept.withColumn("_year", R.year_of_file("_file_name")).withColumn("_layout", F.lit(layout)))
    return frames


def _year_of_name(name: str) -> int:
    found = re.findall(r"[0-9]{4}", name.rsplit(".", 1)[0])
    if not found:
        raise ValueError(f"no year in file name {name}")
    return int(found[-1])


def silver_table(df: DataFrame, code_dim: DataFrame) -> DataFrame:
    """Region rows of all register files (``bronze``), shaped to the consolidated columns."""
    # File-order row numbers while rows are still in scan order (the union of the scans is
    # narrow; every join comes after this).
    df = df.withColumn("_era", era_label("_year"))
    df = ids.sequence_across_files(df, "_era", "_year", out="_seq")
    labels = [c for c in ("contaminantes", "contaminante") if c in df.columns]
    if not labels:
        raise KeyError("no pollutant column")
    df = df.withColumn("_label", F.coalesce(*[q(c) for c in labels]))
    df = lookups.canon_label(df, "_label", out="contaminante_canon")
    df = lookups.add_activity(df, code_dim)
    # The 2023 register reports ``emision_total``; the EFP years ``cantidad_toneladas``.
    for c in ("emision_total", fv.EMISSION_SOURCE_DEFAULT):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("_source", F.when(F.col("_layout") == "ruea2023", q(fv.EMISSION_SOURCE_2023))
                       .otherwise(q(fv.EMISSION_SOURCE_DEFAULT)))
    df = shaping.with_emission_text(df, "_source", "_emision")
    if "comuna" in df.columns:
        df = lookups.canon_spelling(df, "comuna")
    df = df.withColumn("id_unico", ids.format_id(F.col("_era"), F.col("_seq")))
    return df.select(
        "id_unico",
        F.col("_year").alias("año"),
        "contaminante_canon",
        "actividad_canon",
        "actividad_macro",
        V.safe_number(F.col("_emision")).alias("emision_total"),
        *[(q(c) if c in df.columns else F.lit(None).cast("string")).alias(c)
          for c in ["rut", "comuna", "latitud", "longitud", "unidad"]],
    )


def silver(spark: SparkSession, register_dir: str, code_dim: DataFrame | None = None,
           glob: str = "*.csv", strict_eras: bool = True, allow_unread: bool = False) -> DataFrame:
    """Pipeline A up to the consolidated table (U5: all signature groups by name). Fails if a
    year is missing (``strict_eras``) or a file is not read (``allow_unread``; the reasons are in
    ``file_report``)."""
    infos = R.catalogue(spark, R.list_files(spark, register_dir, glob))
    _, reasons = chosen_files(infos)
    if reasons and not allow_unread:
        raise ValueError(f"files that are not read: {reasons}")
    if strict_eras:
        check_eras({_year_of_name(i.name) for i in infos if not i.error})
    if code_dim is None:
        code_dim = lookups.activity_code_dim(fixed_table(spark, [], "codigo string, descripcion string, pos int"), "pos")
    return silver_table(reshape.union_all(bronze(spark, infos)), code_dim)


def gold(silver_df: DataFrame, centres: DataFrame | None, polygons: DataFrame | None,
         polygon_name: str = "unidad", cell: float = 0.05) -> DataFrame:
    """Coordinates completed from municipality centres (J1), then the landscape unit."""
    df = silver_df
    if centres is not None:
        df = lookups.fill_from_centre(df.withColumn("latitud", F.col("latitud").cast("string"))
                                      .withColumn("longitud", F.col("longitud").cast("string")), centres)
    if polygons is not None:
        df = geo.assign_landscape_unit(df, polygons, name=polygon_name, out="unidad_paisaje", cell=cell)
    return df


def run_pipeline_a(spark: SparkSession, register_dir: str, out_dir: str, centres: DataFrame | None = None,
                   polygons: DataFrame | None = None, code_dim: DataFrame | None = None,
                   strict_eras: bool = True, allow_unread: bool = False) -> DataFrame:
    """Writes silver and gold Parquet (partitioned by year) and returns the gold table
    read back, so products start from a short lineage."""
    from airledger.sources.sinks import write_stage
    s = silver(spark, register_dir, code_dim, strict_eras=strict_eras, allow_unread=allow_unread)
    write_stage(s, f"{out_dir}/silver", partition_by=["año"])
    s = spark.read.parquet(f"{out_dir}/silver")
    g = gold(s, centres, polygons)
    write_stage(g, f"{out_dir}/gold", partition_by=["año"])
    return spark.read.parquet(f"{out_dir}/gold")


# --- products from the gold table (entry point 3 and D6) --------------------------------

#: Sums are taken over decimals, so that they do not depend on the order of adding: to 10 places.
EXACT = "decimal(32,10)"


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def products(gold_df: DataFrame, year: int = 2023) -> dict[str, DataFrame]:
    g = gold_df.withColumn("emision_total", F.col("emision_total").cast(EXACT))
    annual = metrics.annual_totals(g, "contaminante_canon", "año", "emision_total", out="emision")
    by_comuna = metrics.totals_by(g, ["comuna", "contaminante_canon"], "emision_total", year=year)
    return {
        "annual_totals": _doubles(annual, "emision").orderBy("contaminante_canon", "año"),
        "running_totals": _doubles(metrics.running_totals(annual, "contaminante_canon", "año", "emision"), "emision", "emision_acumulada")
        .orderBy("contaminante_canon", "año"),
        "municipality_totals": _doubles(by_comuna, "emision_total"),
        "top_municipalities": _doubles(metrics.top_n_per_group(by_comuna, "contaminante_canon", "emision_total", "comuna"), "emision_total"),
        "unit_report": metrics.ordered_report(
            _doubles(metrics.totals_by(g, ["contaminante_canon", "unidad_paisaje"], "emision_total", year=year), "emision_total"),
            "contaminante_canon", "emision_total", "unidad_paisaje") if "unidad_paisaje" in g.columns else None,
        "distribution": metrics.distribution(gold_df, "contaminante_canon", "emision_total"),
        "histogram": metrics.log_histogram(gold_df, "contaminante_canon", "emision_total"),
        "macro_share": _doubles(metrics.share_within(g, ["contaminante_canon"], "actividad_macro", "emision_total"), "total"),
        "coverage_gaps": metrics.coverage_gaps(g, "contaminante_canon", "año"),
        **_series_products(g, annual),
    }


def _series_products(g: DataFrame, annual: DataFrame) -> dict[str, DataFrame]:
    """D2-D5 over the annual series: trends, change points, what the sectors add to each change,
    how pollutants go with sectors, and, of units, the trends and the years without data."""
    by_sector = metrics.totals_by(g, ["contaminante_canon", "actividad_macro", "año"], "emision_total")
    out = {
        "trend": trends.theil_sen(annual, ["contaminante_canon"], "año", "emision"),
        "change_points": trends.change_points(annual, ["contaminante_canon"], "año", "emision"),
        "change_by_sector": trends.change_by_part(by_sector, ["contaminante_canon"], "actividad_macro", "año", "emision_total"),
        "sector_correlation": trends.correlation_by_sector(g, "contaminante_canon", "actividad_macro", "año", "emision_total"),
    }
    if "unidad_paisaje" in g.columns:
        by_unit = metrics.totals_by(g, ["contaminante_canon", "unidad_paisaje", "año"], "emision_total")
        out["unit_trend"] = trends.theil_sen(by_unit, ["contaminante_canon", "unidad_paisaje"], "año", "emision_total")
        out["unit_coverage"] = trends.coverage_runs(g.where(F.col("emision_total").isNotNull()), "unidad_paisaje", "año", g.select("unidad_paisaje"), "unidad_paisaje")
    return out


# --- pipeline B -------------------------------------------------------------------------

def filtered_family(spark: SparkSession, infos: list[R.FileInfo], target: str) -> DataFrame:
    """``process_one`` for a family: columns to canonical names (P1), region with target
    (R3), layout numbers parsed with N3, file name kept (A9 uses it)."""
    frames = []
    for group in R.group_by_signature(infos):
        layout = R.layout_of(group[0].name)
        raw = R.read_signature(spark, group)
        canon = shaping.canonical_columns(raw.drop("_file_path", "_file_block"), layout)
        if "region" not in canon.columns:
            raise KeyError(f"{group[0].name}: no 'region' column after normalisation")
        kept = canon.where(regions.region_matches(F.col("region"), target))
        numeric = fv.EFP_NUMERIC if layout == "efp" else fv.RUEA2023_NUMERIC
        kept = kept.select(*[V.number_n3(q(c)).cast("string").alias(c) if c in numeric else q(c) for c in kept.columns])
        frames.append(shaping.rename_if_absent(kept, fv.EFP_ERA_RENAMES) if layout == "efp" else kept)
    return reshape.union_all(frames)


def run_summary(spark: SparkSession, infos: list[R.FileInfo], target: str) -> DataFrame:
    """Per file the rows read, those dropped for having too many fields and those kept, one
    scan per signature group; an unreadable file has its reason as its state."""
    frames = [fixed_table(spark, [(i.name, 0, 0, 0, i.error) for i in infos if i.error],
                          "archivo string, filas_entrada long, filas_largas long, filas_RM long, estado string")]
    for group in R.group_by_signature(infos):
        raw = R.read_signature(spark, group, drop_long_rows=False).drop("_file_path", "_file_block")
        canon = shaping.canonical_columns(raw, R.layout_of(group[0].name)).withColumnRenamed("_file_name", "archivo")
        frames.append(quality.file_run_summary(canon, regions.region_matches(F.col("region"), target), long_row=R.LONG_ROW))
    return reshape.union_all(frames)


def by_variable(efp: DataFrame, r23: DataFrame | None) -> DataFrame:
    """U2 + U3 + F3/J4 + P14/P12: the global table with its pollutant group, duplicate
    columns merged and units normalised. Both eras' files are in ``efp`` (their own renames done
    in ``filtered_family``), so one pass gives every row the columns of both, whatever its year."""
    order = [*fv.ORDER_2005_2018, *(c for c in fv.ORDER_2019_2022 if c not in fv.ORDER_2005_2018)]
    eras = reshape.consolidate_efp_era([efp], order)
    full = reshape.consolidate_full(eras, r23) if r23 is not None else eras
    id_col = "id_contaminantes" if "id_contaminantes" in full.columns else "contaminante_id"
    grouped = lookups.canon_id_group(full, id_col)
    merged = shaping.merge_pairs(shaping.blank_to_null(grouped))
    return shaping.normalize_units(merged)


def extracts(table: DataFrame, group: str = "grupo_canonico") -> DataFrame:
    """P6 per pollutant group: the extract columns (``ano`` standing in for ``año``) with
    the emission text cleaned by the N6 rule; the group stays a column instead of one
    file per group."""
    return shaping.extract_columns(table.select(*[q(c) for c in table.columns]), fv.EXTRACT_COLUMNS + [group])


def variable_totals(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A1 + W1 per pollutant group from the merged table (N6 numbers, F4 years)."""
    facts = table.select(F.col("grupo_canonico").alias("contaminante"),
                         V.year_first(F.col("año")).alias("year"),
                         V.number_n6(F.col("cantidad_toneladas")).cast(EXACT).alias("emision"))
    totals = metrics.annual_totals(facts, "contaminante", "year", "emision")
    running = metrics.running_totals(totals, "contaminante", "year", "emision")
    return (_doubles(totals, "emision").orderBy("contaminante", "year"),
            _doubles(running, "emision", "emision_acumulada").orderBy("contaminante", "year"))
