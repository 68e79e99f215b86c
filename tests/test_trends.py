from __future__ import annotations

import itertools
import math
import random
from collections import defaultdict
from decimal import Decimal
from statistics import NormalDist, median

import pytest

from airledger.operators import trends as T


def series_frame(spark, series):
    """series: name -> {year: value}."""
    rows = [(k, x, None if y is None else float(y)) for k, points in series.items() for x, y in points.items()]
    return spark.createDataFrame(rows, "g string, y int, v double").repartition(3)


def random_series(rng, n, gaps=0.2, values=None):
    return {x: (rng.choice(values) if values else rng.uniform(0, 100)) for x in range(2000, 2000 + n) if rng.random() > gaps}


def test_theil_sen_against_all_pairs(spark):
    rng = random.Random(1)
    series = {f"r{i}": random_series(rng, rng.randint(1, 25)) for i in range(20)} | {f"t{i}": random_series(rng, 15, 0, [1, 2, 2, 3]) for i in range(6)}
    series |= {"up": {x: 2.0 * x + 1 for x in range(2000, 2019)}, "flat": dict.fromkeys(range(2000, 2010), 5.0), "one": {2005: 3.0}, "null": {2005: None, 2006: 1.0, 2007: 4.0}}
    got = {r["g"]: r for r in T.theil_sen(series_frame(spark, series), ["g"], "y", "v").collect()}
    for name, points in series.items():
        p = sorted((x, float(v)) for x, v in points.items() if v is not None)
        if not p:
            assert name not in got
            continue
        r, n = got[name], len(p)
        slopes = sorted((b[1] - a[1]) / (b[0] - a[0]) for a, b in itertools.combinations(p, 2))
        s = sum((b[1] > a[1]) - (b[1] < a[1]) for a, b in itertools.combinations(p, 2))
        counts = [sum(w == v for _, w in p) for v in {v for _, v in p}]
        var = (n * (n - 1) * (2 * n + 5) - sum(t * (t - 1) * (2 * t + 5) for t in counts)) / 18
        z = (s - (s > 0) + (s < 0)) / math.sqrt(var) if var > 0 else 0.0
        assert (r["n_anios"], r["mk_s"]) == (n, s) and r["mk_var"] == pytest.approx(var)
        assert r["p_valor"] == pytest.approx(2 * (1 - NormalDist().cdf(abs(z))), abs=2e-6)
        if n == 1:
            assert r["pendiente"] is None and r["tendencia"] == "sin tendencia"
            continue
        assert r["pendiente"] == pytest.approx(median(slopes)) and r["pendiente_inf"] <= r["pendiente"] <= r["pendiente_sup"]
        assert r["intercepto"] == pytest.approx(median(v - r["pendiente"] * x for x, v in p))
        assert r["tau"] == pytest.approx(s / len(slopes), abs=1e-6)
    assert got["up"]["pendiente"] == 2.0 and got["up"]["tendencia"] == "sube" and got["flat"]["tendencia"] == "sin tendencia"


def cost(ys):
    m = sum(ys) / len(ys)
    return sum((y - m) ** 2 for y in ys)


def best_cut(ys, beta):
    n = len(ys)
    cuts = (c for k in range(n) for c in itertools.combinations(range(1, n), k))
    return min((sum(cost(ys[a:b]) + beta for a, b in itertools.pairwise((0, *c, n))), len(c), c) for c in cuts)


def test_change_points_against_every_cut(spark):
    rng = random.Random(2)
    series = {f"r{i}": random_series(rng, rng.randint(1, 12)) for i in range(15)}
    series |= {f"s{i}": {2000 + x: 10 + rng.uniform(-1, 1) + (30 if x >= 5 + i else 0) for x in range(12)} for i in range(3)}
    series |= {"flat": dict.fromkeys(range(2000, 2010), 5.0), "big": {2000 + x: 1e9 + x % 2 + (50 if x > 6 else 0) for x in range(12)}}
    rows = T.change_points(series_frame(spark, series), ["g"], "y", "v").collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["g"], r["segmento"])):
        got[r["g"]].append(r)
    for name, points in series.items():
        xs = sorted(points)
        if not xs:
            continue
        ys = [points[x] for x in xs]
        n = len(ys)
        noise = sum((b - a) ** 2 for a, b in itertools.pairwise(ys)) / (2 * (n - 1)) if n > 1 else 0.0
        beta = T.PENALTY * noise * math.log(n)
        least, _, _ = best_cut(ys, beta)
        parts = got[name]
        at = [(xs.index(r["anio_inicio"]), xs.index(r["anio_fin"]) + 1) for r in parts]
        assert at[0][0] == 0 and at[-1][1] == n and all(a[1] == b[0] for a, b in itertools.pairwise(at))
        assert sum(cost(ys[a:b]) + beta for a, b in at) == pytest.approx(least, rel=1e-6, abs=1e-6)
        for r, (a, b) in zip(parts, at, strict=True):
            assert r["media"] == pytest.approx(sum(ys[a:b]) / (b - a), abs=1e-3) and r["anios"] == b - a
        assert [r["cambio"] is None for r in parts] == [True] + [False] * (len(parts) - 1)
    assert [r["anio_inicio"] for r in got["s1"]] == [2000, 2006] and len(got["flat"]) == 1


def test_parts_add_up_to_the_change(spark):
    rng = random.Random(3)
    cells = {(k, s, y): Decimal(rng.randint(0, 10_000)) / 100 for k in ("a", "b", None) for s in ("energy", "transport", "waste", None) for y in range(2000, 2008) if rng.random() < 0.5}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()] + [("c", "energy", 2000, None), ("d", "energy", 2001, Decimal(5))], "k string, s string, y int, v decimal(18,2)")
    rows = T.change_by_part(df.repartition(3), ["k"], "s", "y", "v").collect()
    want = {}
    for k in ("a", "b", None):
        years = sorted({y for kk, _, y in cells if kk == k})
        for before, now in itertools.pairwise(years):
            for s in {s for kk, s, y in cells if kk == k and y in (before, now)}:
                old, new = cells.get((k, s, before)), cells.get((k, s, now))
                want[k, now, before, s] = (old or 0, new or 0, "aparece" if old is None else "desaparece" if new is None else "sigue")
    assert {(r["k"], r["y"], r["anio_anterior"], r["s"]): (r["anterior"], r["actual"], r["estado"]) for r in rows} == want
    sums = defaultdict(Decimal)
    for r in rows:
        sums[r["k"], r["y"]] += r["aporte"]
    assert all(r["cambio"] == sums[r["k"], r["y"]] for r in rows)
    assert {r["estado"] for r in rows} == {"aparece", "desaparece", "sigue"}


def test_correlation_over_common_years(spark):
    rng = random.Random(4)
    rows = [(p, s, y, rng.uniform(0, 10)) for y in range(2000, 2012) for p in ("NOx", "SO2", "CO") for s in ("energy", "transport") if not (p == "CO" and y > 2001) and not (s == "energy" and y < 2004)]
    got = {(r["p"], r["s"]): r for r in T.correlation_by_sector(spark.createDataFrame(rows, "p string, s string, y int, v double"), "p", "s", "y", "v").collect()}
    total = lambda i, k: {y: sum(r[3] for r in rows if r[i] == k and r[2] == y) for y in {r[2] for r in rows if r[i] == k}}
    for p in ("NOx", "SO2", "CO"):
        for s in ("energy", "transport"):
            a, b = total(0, p), total(1, s)
            years = sorted(a.keys() & b.keys())
            if len(years) < 3:
                assert (p, s) not in got
                continue
            x, y = [a[t] for t in years], [b[t] for t in years]
            mx, my = sum(x) / len(x), sum(y) / len(y)
            cov, vx, vy = (sum((i - m) * (j - n) for i, j in zip(u, w, strict=True)) for u, w, m, n in ((x, y, mx, my), (x, x, mx, mx), (y, y, my, my)))
            assert got[p, s]["n_anios"] == len(years) and got[p, s]["correlacion"] == pytest.approx(cov / math.sqrt(vx * vy), abs=2e-6)
            assert got[p, s]["pendiente_sector"] == pytest.approx(cov / vy, abs=2e-6)


def test_runs_of_missing_years(spark):
    facts = spark.createDataFrame([("a", y) for y in (2000, 2001, 2004, 2009)] + [("b", y) for y in range(2000, 2011)] + [("c", 2005), ("zz", 2010), ("a", None), (None, 2003)], "k string, y int")
    units = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("none", 1), ("none", 2), (None, 1)], "k string, other int")
    got = sorted(tuple(r) for r in T.coverage_runs(facts, "k", "y", units, "k").collect())
    assert got == [("a", 2002, 2003, 2, False, False, False), ("a", 2005, 2008, 4, False, False, False), ("a", 2010, 2010, 1, False, True, False),
                   ("c", 2000, 2004, 5, True, False, False), ("c", 2006, 2010, 5, False, True, False), ("none", 2000, 2010, 11, True, True, True)]
    assert T.coverage_runs(facts.limit(0), "k", "y", units, "k").count() == 0


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "g string, s string, y int, v double")
    assert T.theil_sen(empty, ["g"], "y", "v").count() == T.change_points(empty, ["g"], "y", "v").count() == 0
    assert T.change_by_part(empty, ["g"], "s", "y", "v").count() == T.correlation_by_sector(empty, "g", "s", "y", "v").count() == 0
