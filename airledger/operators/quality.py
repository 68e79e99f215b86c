"""Data-quality tables.

Every profile is one aggregate over the table -- all columns at once -- followed by an
``unpivot`` into long form; there is never one job per column or per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from airledger.functions import values as V
from airledger.operators.shaping import q


def null_profile(df: DataFrame, group: str, columns: list[str] | None = None,
                 blank_is_null: bool = True) -> DataFrame:
    """Per (group, column) the non-NULL, NULL and total counts, long form. ``""`` counts
    as NULL (the source blanks empty strings before counting)."""
    cols = columns or [c for c in df.columns if c != group]

    def present(c: str):
        col = q(c)
        if blank_is_null and dict(df.dtypes)[c] == "string":
            return F.count(F.when(col != "", col))
        return F.count(col)

    wide = df.groupBy(group).agg(
        F.count(F.lit(1)).cast("long").alias("total"),
        *[present(c).cast("long").alias(f"_nn{i}") for i, c in enumerate(cols)],
    )
    long = wide.unpivot([group, "total"], [f"_nn{i}" for i in range(len(cols))], "_slot", "no_nulos")
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(f"_nn{i}"), F.lit(c))])
    return long.select(
        F.col(group),
        F.element_at(names, F.col("_slot")).alias("columna"),
        F.col("no_nulos"),
        (F.col("total") - F.col("no_nulos")).alias("nulos"),
        F.col("total"),
    )


def type_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``numerico`` when every non-NULL value of a column parses as a number (F2), else
    ``texto``; a column without values is ``texto``. Uses all rows (the 10-row sample of
    one variant depends on row order)."""
    cols = columns or df.columns
    aggs = []
    for i, c in enumerate(cols):
        col = q(c).cast("string")
        aggs.append(F.count(col).alias(f"_n{i}"))
        aggs.append(F.count_if(col.isNotNull() & V.safe_number(col).isNull()).alias(f"_bad{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', _n{i}, _bad{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (columna, _n, _bad)")
    return long.select(
        "columna",
        F.when((F.col("_n") > 0) & (F.col("_bad") == 0), F.lit("numerico")).otherwise(F.lit("texto")).alias("tipo"),
    )


def file_run_summary(df: DataFrame, keep, file_col: str = "archivo", long_row: str | None = None) -> DataFrame:
    """Rows read, rows dropped as too long (``long_row`` marks them) and rows kept per source
    file, in one scan (``keep`` is the row filter)."""
    too_long = F.col(long_row) if long_row else F.lit(False)
    return df.groupBy(file_col).agg(
        F.count(F.lit(1)).cast("long").alias("filas_entrada"),
        F.count_if(too_long).cast("long").alias("filas_largas"),
        F.count_if(keep & ~too_long).cast("long").alias("filas_RM"),
    ).withColumn("estado", F.when(F.col("filas_RM") > 0, F.lit("ok")).otherwise(F.lit("sin_registros")))


# Number texts that the thousands rule (N1, N5, N6) reads in one of two possible ways: one mark
# before exactly three digits, which it takes for a decimal mark, and one mark several times
# without the other, which gives no number.
_ONE_MARK = r"^[+-]?[0-9]{1,3}[.,][0-9]{3}$"
_REPEATED_MARK = r"^[+-]?[0-9]{1,3}(?:(?:,[0-9]{3}){2,}|(?:\.[0-9]{3}){2,})$"


def ambiguous_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Decision 17: per column the non-missing values, those with one mark before three digits
    and those with a repeated mark; one aggregate over the table."""
    aggs = []
    for i, c in enumerate(columns):
        text = V.clean_null(q(c))
        aggs += [F.count(text).alias(f"_n{i}"), F.count_if(text.rlike(_ONE_MARK)).alias(f"_one{i}"), F.count_if(text.rlike(_REPEATED_MARK)).alias(f"_many{i}")]
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', _n{i}, _one{i}, _many{i}" for i, c in enumerate(columns))
    return df.agg(*aggs).selectExpr(f"stack({len(columns)}, {stack}) AS (columna, valores, una_marca, marca_repetida)")


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count reported by the write itself (no second pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("filas")), obs
