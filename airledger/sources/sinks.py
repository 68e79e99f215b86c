"""Writers (K1-K4, K6).

Stage hand-overs are Parquet (typed, splittable, no delimiter or quoting hazards);
CSV is only an export. Exports use Spark's default quoting: writing with quoting off
would emit NUL characters and a ``;`` inside a text field would split the row when
read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from airledger.functions import text as T
from airledger.operators.quality import observe_rows


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                files_per_value: int = 8) -> int:
    """Stage output as Parquet (optionally partitioned, e.g. by year so year filters prune
    directories). Rows of a partition value go to ``files_per_value`` tasks, so neither does each
    task write a file for each value nor one task write all of a large value; only the values
    that are written are replaced. Returns the rows written, measured by the write itself (A15)."""
    if partition_by:
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_value))
        df = df.repartition(*partition_by, spread)
    observed, obs = observe_rows(df, "rows_written")
    w = observed.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get.get("filas", 0))


def write_export(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    """K1/K2/K3: header CSV with the given separator, quoted where needed, quotes doubled and blanks
    kept, so that ``registers.read_signature`` gives the same cells back."""
    _csv(df.write.mode(mode), sep).csv(path)


def _csv(writer: DataFrameWriter, sep: str) -> DataFrameWriter:
    return (writer.option("header", True).option("sep", sep).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_per_group(df: DataFrame, path: str, group: str, sep: str = ",", mode: str = "overwrite") -> None:
    """K4: one folder per group value, in a single pass (``partitionBy``) instead of one
    filter-and-write per group. The folder name is the T9-safe form of the value (the
    value column itself is kept untouched)."""
    slug = "grupo_archivo"
    out = df.withColumn(slug, T.safe_file_name(F.regexp_replace(F.col(group), r"[\\/:*?\"<>|]+", "_")))
    _csv(out.write.mode(mode).partitionBy(slug), sep).csv(path)


def report_rows(df: DataFrame, group: str, name: str, value: str) -> DataFrame:
    """K6: rows of the per-unit report: group, unit and the value as ``%.6f`` text (``""``
    for NULL), ordered by group then value descending. Rendering to a text file is left to
    the caller."""
    from airledger.operators.metrics import ordered_report
    return ordered_report(df, group, value, name).select(group, name, "valor_texto")
