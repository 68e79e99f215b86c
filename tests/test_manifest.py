from __future__ import annotations

import os
from decimal import Decimal
from urllib.parse import unquote

from pyspark.sql import functions as F

from airledger.operators import metrics
from airledger.sources import manifest as M
from airledger.sources import registers as R
from airledger.streaming import totals as S

KEYS = ["contaminante_canon", "año"]


def put(root, name, rows):
    with open(os.path.join(root, name), "w", encoding="utf-8") as f:
        f.write("contaminante_canon;año;emision_total\n" + "".join(f"{c};{y};{v}\n" for c, y, v in rows))


def reader(spark, seen):
    def contribute(paths):
        seen.append(sorted(unquote(p).rsplit("/", 1)[-1] for p in paths))
        if not paths:
            return spark.createDataFrame([], "file string, contaminante_canon string, `año` int, emision_total decimal(18,2)")
        infos = R.catalogue(spark, paths)
        read = R.read_signature(spark, infos)
        return read.select(F.col("_file_path").alias("file"), "contaminante_canon", F.col("año").cast("int").alias("año"), F.col("emision_total").cast("decimal(18,2)").alias("emision_total"))
    return contribute


def expected(files):
    out = {}
    for rows in files.values():
        for c, y, v in rows:
            out[c, y] = out.get((c, y), Decimal(0)) + Decimal(v)
    return {k: v for k, v in out.items() if v}


def test_replaced_added_and_vanished_files(spark, scratch):
    root, state = os.path.join(scratch, "in put"), os.path.join(scratch, "state")
    os.makedirs(root)
    files = {"2019.csv": [("CO", 2019, "1.10"), ("NOX", 2019, "2.25")], "2020 ñ+.csv": [("CO", 2020, "3.33")], "2021.csv": [("CO", 2021, "0.07")] * 3}
    for name, rows in files.items():
        put(root, name, rows)
    seen = []

    def check(read, **more):
        got = M.refresh(spark, root, state, reader(spark, seen), KEYS, "emision_total")
        assert sorted(unquote(p).rsplit("/", 1)[-1] for p in got.read) == read and len(got.gone) == more.get("gone", 0)
        now = {tuple(r)[:2]: r["emision"] for r in M.totals(spark, state, KEYS).collect() if r["emision"]}
        assert now == expected(files)
        return got

    check(["2019.csv", "2020 ñ+.csv", "2021.csv"])
    n = len(seen)
    check([])  # nothing changed: nothing is read
    assert len(seen) == n
    files["2019.csv"] = [("CO", 2019, "5.00")]
    put(root, "2019.csv", files["2019.csv"])
    os.utime(os.path.join(root, "2021.csv"), (1, 1))  # touched, but its lines are the same
    check(["2019.csv"])
    assert seen[-1] == ["2019.csv"]
    files["2022.csv"] = [("SO2", 2022, "9.99")]
    put(root, "2022.csv", files["2022.csv"])
    os.remove(os.path.join(root, "2021.csv"))
    del files["2021.csv"]
    check(["2022.csv"], gone=1)
    assert seen[-1] == ["2022.csv"]

    # the stream over the differences has the same totals, with what was replaced taken back
    schema = spark.read.parquet(f"{state}/differences/version=1").schema
    sink = os.path.join(scratch, "sink")
    S.start_totals(spark, f"{state}/differences/*", schema, sink, checkpoint=os.path.join(scratch, "ckpt"), group="contaminante_canon", year="año", value="value").awaitTermination()
    streamed = {tuple(r)[:2]: r["emision"] for r in S.latest_totals(spark, sink).collect() if r["emision"]}
    assert streamed == expected(files)
    files["2020 ñ+.csv"] = []
    put(root, "2020 ñ+.csv", [])
    check(["2020 ñ+.csv"])
    S.start_totals(spark, f"{state}/differences/*", schema, sink, checkpoint=os.path.join(scratch, "ckpt"), group="contaminante_canon", year="año", value="value").awaitTermination()
    assert {tuple(r)[:2]: r["emision"] for r in S.latest_totals(spark, sink).collect() if r["emision"]} == expected(files)


def test_a_failed_attempt_is_written_again(spark, scratch):
    root, state = os.path.join(scratch, "in"), os.path.join(scratch, "state")
    os.makedirs(root)
    put(root, "a.csv", [("CO", 2019, "1.00")])
    ok = reader(spark, [])
    M.refresh(spark, root, state, ok, KEYS, "emision_total")
    put(root, "a.csv", [("CO", 2019, "2.00")])

    def broken(paths):
        raise RuntimeError("lost")
    try:
        M.refresh(spark, root, state, broken, KEYS, "emision_total")
        raise AssertionError
    except RuntimeError:
        pass
    assert M.versions(spark, state) == [1]
    assert M.refresh(spark, root, state, ok, KEYS, "emision_total").version == 2
    assert [tuple(r) for r in M.totals(spark, state, KEYS).collect()] == [("CO", 2019, Decimal(2))]
    assert metrics.annual_totals(M.totals(spark, state, KEYS), "contaminante_canon", "año", "emision").count() == 1
