"""SQL-logic check: every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive values), plus the flagship entry."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from airledger.plans import analysis_queries, file_queries, oracle, shape_queries, table_queries
from helpers import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v if isinstance(v, int) or v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([_norm(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(table_queries.QUERIES) == set(oracle.ORACLE)
    for part in E.PARTS:
        assert set(part.QUERIES) == set(part.ORACLE)
    assert set(E.queries()) >= set(E.oracle_sql())


LAZY = table_queries.QUERIES | shape_queries.QUERIES | analysis_queries.QUERIES
OWN = LAZY | file_queries.QUERIES


def test_building_a_query_starts_no_job(spark, monkeypatch):
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in TABLES}  # reads the footers
    for module in (table_queries, shape_queries, analysis_queries):
        monkeypatch.setattr(module, "load", lambda spark, sf_dir, name: tables[name])
    sc = spark.sparkContext
    sc.setJobGroup("building", "no job may run here")
    try:
        for build in LAZY.values():
            build(spark, SF_SMALL)
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(df.columns, srows) == _canon(dcols, drows)


def test_entry(spark):
    out = E.entry(spark)
    assert out.columns == ["contaminante_canon", "unidad_paisaje", "emision_total", "valor_texto"]
    assert out.count() > 0
