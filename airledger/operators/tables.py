"""Small fixed tables (lookup lists, polygons) built on the JVM.

A fixed list becomes one ``SELECT CAST(..) FROM VALUES ..`` statement: Spark resolves an
inline table of literals into a local relation in a single call, so the rows never go
through Python workers when scanned, and the driver makes one call instead of one per
literal. Values are written as SQL literals (strings escaped); every column is cast to
its declared type.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegralType,
                               StringType, StructType)


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql(value, dtype: DataType) -> str:
    """``value`` as a SQL expression of type ``dtype``."""
    t = dtype.simpleString()
    if value is None:
        return f"CAST(NULL AS {t})"
    if isinstance(dtype, ArrayType):
        return f"CAST(array({', '.join(_sql(v, dtype.elementType) for v in value)}) AS {t})"
    if isinstance(dtype, StructType):
        fields = ", ".join(f"{_quote(f.name)}, {_sql(v, f.dataType)}" for v, f in zip(value, dtype.fields))
        return f"CAST(named_struct({fields}) AS {t})"
    if isinstance(dtype, StringType):
        return _quote(str(value))
    if isinstance(dtype, BooleanType):
        return "TRUE" if value else "FALSE"
    if isinstance(dtype, (DoubleType, FloatType)):
        v = float(value)
        text = repr(v) if math.isfinite(v) else ("NaN" if math.isnan(v) else ("Infinity" if v > 0 else "-Infinity"))
        return f"CAST({_quote(text)} AS {t})"
    if isinstance(dtype, IntegralType):
        return f"CAST({int(value)} AS {t})"
    return f"CAST({_quote(str(value))} AS {t})"


def fixed_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A DataFrame of the given rows and DDL schema, made of literals."""
    schema = StructType.fromDDL(ddl)
    names = [f"`{f.name.replace('`', '``')}`" for f in schema.fields]
    if not rows:
        cols = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {n}" for f, n in zip(schema.fields, names))
        return spark.sql(f"SELECT {cols} WHERE FALSE")
    values = ", ".join("(" + ", ".join(_sql(v, f.dataType) for v, f in zip(r, schema.fields)) + ")" for r in rows)
    aliases = [f"c{i}" for i in range(len(names))]
    cols = ", ".join(f"CAST({a} AS {f.dataType.simpleString()}) AS {n}"
                     for a, f, n in zip(aliases, schema.fields, names))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({', '.join(aliases)})")
