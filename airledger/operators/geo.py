"""Coordinates and the point-in-polygon join.

Spark has no spatial join, so ``within`` is an equi-join on cells of a quadtree plus an exact even-odd
test where it is needed:

* polygons are tables of ring edges ``(x1, y1, x2, y2)``; all rings of all parts sit in
  one array, so holes and multipolygons follow the even-odd rule;
* each polygon is covered by cells of three sizes, each SPLIT times the next, and refined only where its
  outline is: a cell that no edge touches is inside or left out; one with at most LEAF_EDGES edges, or of the
  smallest size, keeps these edges alone and whether its corner is inside;
* a point meets the cells that hold it by their numbers, one join for each size, each a left join to
  a table of one row per cell. In cells that lie inside, no edge is tested. In the others the edges crossed on
  the way from the corner (up the cell's side, then across to the point) tell whether the point is on the
  corner's side, and it may lie on no edge (``within`` excludes the boundary);
* the polygons found stand in one array per point, so points are not shuffled to be put together again.

A left join: points inside no polygon keep one row with a NULL unit; a point inside overlapping
polygons yields one row per polygon, as a spatial left join does. The joins carry no hint: the
optimizer broadcasts a small cell table and shuffles on the cell otherwise (AQE then splits a hot cell).

The grid is set off by OFFSET of a cell, so that its lines run through no round coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.pandas.types import to_arrow_schema

from airledger import fixed_values as fv
from airledger.functions import text as T
from airledger.functions import values as V
from airledger.operators.tables import fixed_table

EDGE_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
#: Cells of one size to a side of the next, and sizes.
SPLIT, SIZES = 16, 3
LEAF_EDGES = 8
OFFSET = 0.3819660112501051


def best_coordinate(df: DataFrame, candidates: list[str]) -> Column:
    """First candidate column (that exists) holding non-blank text, stripped, as a
    number; unparsable text gives no coordinate."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return F.lit(None).cast("double")
    texts = [F.when(T.strip_ws(F.col(c)) != "", T.strip_ws(F.col(c))) for c in present]
    return V.safe_number(F.coalesce(*texts))


def polygons_from_rings(spark: SparkSession, polygons: list[tuple[str, list[list[tuple[float, float]]]]],
                        name: str = "unidad") -> DataFrame:
    """Polygon table from rings given as coordinate lists (closing point optional)."""
    rows = []
    for unit, rings in polygons:
        edges = []
        for ring in rings:
            pts = list(ring)
            if pts[0] != pts[-1]:
                pts.append(pts[0])
            edges += [(float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(pts, pts[1:])]
        rows.append((unit, edges))
    return fixed_table(spark, rows, f"{name} string, edges {EDGE_TYPE}")


def polygons_from_wkt(df: DataFrame, wkt_col: str, name_col: str) -> DataFrame:
    """Polygon table from WKT ``POLYGON``/``MULTIPOLYGON`` text, parsed with Spark string and
    array functions: every ring becomes its list of consecutive-vertex edges. A vertex that is
    no pair of numbers fails the job: a polygon with an edge less would match too little."""
    body = F.regexp_replace(F.upper(F.col(wkt_col)), r"^\s*(MULTI)?POLYGON\s*", "")
    rings = F.regexp_extract_all(body, F.lit(r"\(([^()]+)\)"), 1)
    pts = F.transform(rings, lambda r: F.transform(
        F.split(F.trim(r), r"\s*,\s*"),
        lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("x"),
                           F.split(F.trim(p), r"\s+")[1].cast("double").alias("y"))))
    edges = F.flatten(F.transform(pts, lambda ring: F.transform(
        F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b")),
        lambda e: F.struct(e["a"]["x"].alias("x1"), e["a"]["y"].alias("y1"),
                           e["b"]["x"].alias("x2"), e["b"]["y"].alias("y2")))))
    return df.select(F.col(name_col), edges.alias("edges"))


# FIXED VALUES: the WGS 84 ellipsoid (semi-major axis, flattening) and the constants of UTM.
WGS84 = (6378137.0, 1 / 298.257223563)
UTM_SCALE, UTM_EAST, UTM_SOUTH_NORTH = 0.9996, 500_000.0, 10_000_000.0


def inverse_mercator(x: Column, y: Column, meridian: float, scale: float = UTM_SCALE, false_x: float = UTM_EAST, false_y: float = 0.0,
                     ellipsoid: tuple[float, float] = WGS84) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of transverse Mercator coordinates, by Krueger's series to
    the fourth power of the third flattening: well under 1e-9 degrees within a zone."""
    a, f = ellipsoid
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)
    north, east = (y - false_y) / (scale * radius), (x - false_x) / (scale * radius)
    xi = reduce(lambda v, j: v - beta[j - 1] * F.sin(2 * j * north) * F.cosh(2 * j * east), range(1, 5), north)
    eta = reduce(lambda v, j: v - beta[j - 1] * F.cos(2 * j * north) * F.sinh(2 * j * east), range(1, 5), east)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    latitude = reduce(lambda v, j: v + delta[j - 1] * F.sin(2 * j * chi), range(1, 5), chi)
    return F.lit(float(meridian)) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(latitude)


def utm_to_degrees(x: Column, y: Column, zone: int, south: bool) -> tuple[Column, Column]:
    """(longitude, latitude) of UTM coordinates on WGS 84 (EPSG:326zz north, 327zz south)."""
    return inverse_mercator(x, y, 6.0 * zone - 183, false_y=UTM_SOUTH_NORTH if south else 0.0)


def reproject_polygons(polys: DataFrame, zone: int, south: bool) -> DataFrame:
    """A polygon table whose edges are in UTM as one in degrees (longitude, latitude): each vertex
    is computed by itself, so edges that met still meet."""
    def moved(e: Column) -> Column:
        (x1, y1), (x2, y2) = (utm_to_degrees(e[f"x{i}"], e[f"y{i}"], zone, south) for i in (1, 2))
        return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    return polys.withColumn("edges", F.transform("edges", moved))


def _touching(edges: np.ndarray, x0: np.ndarray, y0: np.ndarray, side: float) -> np.ndarray:
    """(cells, edges): whether an edge and a cell, a hair wider, have a point in common."""
    hair = side * 1e-9
    x1, y1, x2, y2 = edges.T
    left, low = (x0 - hair)[:, None], (y0 - hair)[:, None]
    right, high = left + side + 2 * hair, low + side + 2 * hair
    box = (np.minimum(x1, x2) <= right) & (np.maximum(x1, x2) >= left) & (np.minimum(y1, y2) <= high) & (np.maximum(y1, y2) >= low)
    # which side of the edge's line a corner is on; all four on one side: no common point
    turn = lambda x, y: (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    corners = [turn(x, y) for x in (left, right) for y in (low, high)]
    return box & ~(reduce(np.minimum, corners) > 0) & ~(reduce(np.maximum, corners) < 0)


def _crossings(edges: np.ndarray, x0: float, y0: float, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many edges are crossed on the way from (x0, y0) up to y, then across to x, for each (x, y)."""
    x1, y1, x2, y2 = edges.T
    x, y = x[:, None], y[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        up_at = y1 + (x0 - x1) * (y2 - y1) / (x2 - x1)
        over_at = x1 + (y - y1) * (x2 - x1) / (y2 - y1)
    up = ((x1 > x0) != (x2 > x0)) & (up_at > y0) & (up_at <= y)
    over = ((y1 > y) != (y2 > y)) & (over_at > x0) & (over_at < x)
    return up.sum(axis=1) + over.sum(axis=1)


def _cover(edges: np.ndarray, cell: float) -> Iterator[tuple]:
    """(size, ix, iy, inside, corner inside, x0, y0, edges) of the cells of one polygon."""
    off = OFFSET * cell
    sides = [cell * SPLIT ** (SIZES - 1 - i) for i in range(SIZES)]
    box = [np.floor((v + off) / sides[0]).astype(int) for v in (edges[:, [0, 2]].min(), edges[:, [0, 2]].max(), edges[:, [1, 3]].min(), edges[:, [1, 3]].max())]
    ix, iy = (g.ravel() for g in np.meshgrid(np.arange(box[0], box[1] + 1), np.arange(box[2], box[3] + 1), indexing="ij"))
    # from a point left of and below everything, which is outside
    far_x, far_y = edges[:, [0, 2]].min() - sides[0], edges[:, [1, 3]].min() - sides[0]
    odd = _crossings(edges, far_x, far_y, ix * sides[0] - off, iy * sides[0] - off) % 2 == 1
    todo = [(0, int(a), int(b), bool(o), edges) for a, b, o in zip(ix, iy, odd, strict=True)]
    while todo:
        size, a, b, corner, near = todo.pop()
        side = sides[size]
        x0, y0 = a * side - off, b * side - off
        near = near[_touching(near, np.array([x0]), np.array([y0]), side)[0]]
        if not len(near):
            if corner:
                yield size, a, b, True, True, x0, y0, near
        elif len(near) <= LEAF_EDGES or size == SIZES - 1:
            yield size, a, b, False, corner, x0, y0, near
        else:
            kids = np.arange(SPLIT)
            kx, ky = (g.ravel() for g in np.meshgrid(a * SPLIT + kids, b * SPLIT + kids, indexing="ij"))
            px, py = kx * sides[size + 1] - off, ky * sides[size + 1] - off
            odd = corner ^ (_crossings(near, x0, y0, px, py) % 2 == 1)
            touched = _touching(near, px, py, sides[size + 1])
            for k in np.flatnonzero(touched.any(axis=1) | odd):
                todo.append((size + 1, int(kx[k]), int(ky[k]), bool(odd[k]), near[touched[k]]))


def polygon_cells(polys: DataFrame, cell: float, name: str) -> DataFrame:
    """(size, ix, iy, units): each cell of the polygons' coverings with the polygons that reach into it."""
    edge = ST.DataType.fromDDL(EDGE_TYPE)
    fields = [ST.StructField(n, t) for n, t in (("size", ST.IntegerType()), ("ix", ST.LongType()), ("iy", ST.LongType()), ("inside", ST.BooleanType()),
                                                ("corner", ST.BooleanType()), ("x0", ST.DoubleType()), ("y0", ST.DoubleType()), ("edges", edge))]
    schema = ST.StructType([ST.StructField("name", polys.schema[name].dataType), *fields])
    types = to_arrow_schema(schema).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                points = batch.column(1)[i].as_py() or []
                edges = np.array([[e["x1"], e["y1"], e["x2"], e["y2"]] for e in points], dtype=np.float64).reshape(-1, 4)
                found = list(_cover(edges, cell)) if len(edges) else []
                listed = [[dict(zip(("x1", "y1", "x2", "y2"), e, strict=True)) for e in f[7].tolist()] for f in found]
                names = pa.array([batch.column(0)[i].as_py()] * len(found), types[0])
                yield pa.RecordBatch.from_arrays([names, *(pa.array([f[c] for f in found], types[c + 1]) for c in range(7)), pa.array(listed, types[8])],
                                                 names=schema.names)

    cells = polys.select(F.col(name).alias("name"), "edges").mapInArrow(run, schema)
    return cells.groupBy("size", "ix", "iy").agg(F.collect_list(F.struct("name", "inside", "corner", "x0", "y0", "edges")).alias("units"))


def _within(x: Column, y: Column, unit: Column) -> Column:
    """Whether the point is strictly inside the polygon whose cell this is."""
    def crossed(acc: Column, e: Column) -> Column:
        up_at = e["y1"] + F.try_divide((unit["x0"] - e["x1"]) * (e["y2"] - e["y1"]), e["x2"] - e["x1"])
        over_at = e["x1"] + F.try_divide((y - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
        up = ((e["x1"] > unit["x0"]) != (e["x2"] > unit["x0"])) & (up_at > unit["y0"]) & (up_at <= y)
        over = ((e["y1"] > y) != (e["y2"] > y)) & (over_at > unit["x0"]) & (over_at < x)
        return acc + F.when(up, 1).otherwise(0) + F.when(over, 1).otherwise(0)

    def on_edge(e: Column) -> Column:
        collinear = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
        in_box = (x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                  & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
        return collinear & in_box

    odd = unit["corner"] != (F.aggregate(unit["edges"], F.lit(0), crossed) % 2 == 1)
    return unit["inside"] | (odd & ~F.exists(unit["edges"], on_edge))


def assign_polygon(points: DataFrame, polys: DataFrame, x: str, y: str, name: str = "unidad",
                   out: str = "unidad_paisaje", cell: float = 0.05, keep: str = "all") -> DataFrame:
    """Left spatial join, point ``within`` polygon. ``keep="all"`` returns one row per
    containing polygon (a spatial left join); ``keep="first"`` keeps one row per point, the
    polygon name that sorts first, and adds ``n_poligonos`` (how many contained it). ``cell`` is the side of the
    smallest cells."""
    found = _matches(points, polys, x, y, name, cell)
    kept = [F.col(f"`{c}`") for c in points.columns if c not in (out, "n_poligonos" if keep != "all" else out)]
    if keep == "all":
        return found.select(*kept, F.explode_outer("_units").alias(out))
    return found.select(*kept, F.array_min("_units").alias(out), F.size("_units").alias("n_poligonos"))


def _matches(points: DataFrame, polys: DataFrame, x: str, y: str, name: str, cell: float) -> DataFrame:
    """``points`` plus ``_units``, the names of the polygons that strictly contain the point (none if it has no
    usable coordinate)."""
    def as_double(c: str) -> Column:
        return V.safe_number(F.col(c)) if dict(points.dtypes)[c] == "string" else F.col(c).cast("double")

    cells = polygon_cells(polys, cell, name)
    at = lambda c: F.floor((F.col(c) + F.lit(OFFSET * cell)) / F.lit(cell))
    pts = points.withColumn("_px", as_double(x)).withColumn("_py", as_double(y)).withColumn("_cx", at("_px")).withColumn("_cy", at("_py"))
    # A point without an x or y matches no cell; its other key is spread, so that a shuffled join
    # does not gather all such points in one task.
    hashed = F.xxhash64(*[F.col(f"`{f.name}`") for f in points.schema.fields if "map<" not in f.dataType.simpleString()])
    lost = F.col("_cx").isNull() | F.col("_cy").isNull()
    pts = pts.withColumn("_cy", F.when(lost, hashed).otherwise(F.col("_cy"))).withColumn("_cx", F.when(~lost, F.col("_cx")))
    names = []
    for size in range(SIZES):
        step = float(SPLIT ** (SIZES - 1 - size))
        of_size = cells.where(F.col("size") == size).select(F.col("ix").alias("_ix"), F.col("iy").alias("_iy"), F.col("units").alias(f"_u{size}"))
        in_cell = (F.floor(F.col("_cx") / step) == F.col("_ix")) & (F.floor(F.col("_cy") / step) == F.col("_iy"))
        pts = pts.join(of_size, in_cell, "left").drop("_ix", "_iy")
        hit = F.filter(f"_u{size}", lambda u: _within(F.col("_px"), F.col("_py"), u))
        names.append(F.coalesce(F.transform(hit, lambda u: u["name"]), F.array().cast(ST.ArrayType(polys.schema[name].dataType))))
    return pts.select(*[F.col(f"`{c}`") for c in points.columns], F.concat(*names).alias("_units"))


def assign_landscape_unit(df: DataFrame, polys: DataFrame, name: str = "unidad", out: str = "unidad_paisaje",
                          cell: float = 0.05, keep: str = "all") -> DataFrame:
    """P17 + J2 on the consolidated table: best latitude/longitude, then the unit."""
    staged = (df.withColumn("_lat", best_coordinate(df, fv.LAT_COLUMNS))
              .withColumn("_lon", best_coordinate(df, fv.LON_COLUMNS)))
    return assign_polygon(staged, polys, "_lon", "_lat", name=name, out=out, cell=cell,
                          keep=keep).drop("_lat", "_lon")


def multi_match_count(points: DataFrame, polys: DataFrame, x: str, y: str, name: str = "unidad",
                      cell: float = 0.05) -> DataFrame:
    """Points that fall inside more than one polygon (decision 12 report): one row."""
    found = _matches(points, polys, x, y, name, cell)
    return found.agg(F.count_if(F.size("_units") > 1).cast("long").alias("puntos_multiples"))
