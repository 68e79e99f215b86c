"""Helpers shared by the tests."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def one_col(spark, values, col="x", typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"{col} {typ}")
