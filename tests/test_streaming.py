"""Incremental totals: the stream's snapshot equals the batch operators after each arrival."""

from __future__ import annotations

import os

import pytest

from airledger.operators import metrics
from airledger.streaming.totals import latest_totals, start_totals


def _facts(spark, rows):
    return spark.createDataFrame(rows, "contaminante_canon string, `año` int, emision_total double")


def test_stream_matches_batch(spark, scratch):
    src = os.path.join(scratch, "gold")
    sink = os.path.join(scratch, "totals")
    first = [("CO", 2005, 1.0), ("CO", 2005, 2.0), ("CO", 2006, None), ("NOX", 2005, 4.0)]
    second = [("CO", 2007, 5.0), ("NOX", 2005, 1.5), ("CO", None, 9.0)]
    _facts(spark, first).write.mode("append").parquet(src)
    schema = _facts(spark, first).schema
    ckpt = os.path.join(scratch, "ckpt")

    q = start_totals(spark, src, schema, sink, checkpoint=ckpt)
    q.awaitTermination(120)
    got = {(r.contaminante_canon, r["año"]): (r.emision, r.emision_acumulada) for r in latest_totals(spark, sink).collect()}
    assert got == {("CO", 2005): (3.0, 3.0), ("CO", 2006): (None, None), ("NOX", 2005): (4.0, 4.0)}

    _facts(spark, second).write.mode("append").parquet(src)
    q = start_totals(spark, src, schema, sink, checkpoint=ckpt)
    q.awaitTermination(120)
    got = {(r.contaminante_canon, r["año"]): (r.emision, r.emision_acumulada) for r in latest_totals(spark, sink).collect()}
    batch = metrics.running_totals(metrics.annual_totals(_facts(spark, first + second), "contaminante_canon", "año",
                                                         "emision_total"), "contaminante_canon", "año", "emision")
    want = {(r.contaminante_canon, r["año"]): (r.emision, r.emision_acumulada) for r in batch.collect()}
    assert got == want
    assert got[("CO", 2007)] == (5.0, 8.0) and got[("NOX", 2005)] == (5.5, 5.5)
