"""Polygon features and a burnt grid made of the part table, shared by the grid queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import made
from shoalgrid.operators.geometry import ring_edges, rings_to_wkb
from shoalgrid.operators.grid import burn_cells, burn_spans, grid_spec

RESOLUTION = 0.5
ATTRIBUTES = ["feature_id", "brand", "kind", "size", "price"]


def _rings():
    def point(i):
        return F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y"))

    return F.array(F.array(*[point(i) for i in (1, 2, 3, 4, 1)]), F.array(*[point(i) for i in (5, 6, 7, 5)]))


def part_rings(spark, sf):
    return made(spark, sf, "corners").select(*ATTRIBUTES, _rings().alias("rings"))


def part_polygons(spark, sf):
    return part_rings(spark, sf).select(*ATTRIBUTES, rings_to_wkb(F.col("rings")).alias("geometry"))


def part_edges(spark, sf):
    return part_rings(spark, sf).select("feature_id", F.explode(ring_edges(F.col("rings"))).alias("e")).select(
        "feature_id", F.lit(0).alias("part"), "e.*"
    )


def part_bounds(spark, sf):
    return made(spark, sf, "corners").select(
        *ATTRIBUTES, F.least("x1", "x4").alias("xmin"), F.col("y1").alias("ymin"), F.col("x2").alias("xmax"), F.col("y3").alias("ymax")
    )


def part_spec(spark, sf):
    from shoalgrid.operators.extents import total_bounds
    return grid_spec(total_bounds(part_bounds(spark, sf)), RESOLUTION)


def part_cells(spark, sf, spec=None):
    return burn_cells(burn_spans(part_edges(spark, sf), spec or part_spec(spark, sf)))


# Ray casting at every cell centre of each polygon's box: no scanline, no spans.
BURN_SQL = """
WITH edges AS (
  SELECT feature_id, unnest([{'ax': x1, 'ay': y1, 'bx': x2, 'by': y2}, {'ax': x2, 'ay': y2, 'bx': x3, 'by': y3},
    {'ax': x3, 'ay': y3, 'bx': x4, 'by': y4}, {'ax': x4, 'ay': y4, 'bx': x1, 'by': y1},
    {'ax': x5, 'ay': y5, 'bx': x6, 'by': y6}, {'ax': x6, 'ay': y6, 'bx': x7, 'by': y7}, {'ax': x7, 'ay': y7, 'bx': x5, 'by': y5}]) AS e FROM corners),
b AS (SELECT min(least(x1, x4)) AS x0, min(y1) AS y0, max(x2) AS x1, max(y3) AS y1 FROM corners),
g AS (SELECT *, ceil((x1 - x0) / 0.5e0)::BIGINT AS width, ceil((y1 - y0) / 0.5e0)::BIGINT AS height FROM b),
s AS (SELECT *, (x1 - x0) / width AS px, (y1 - y0) / height AS py FROM g),
boxes AS (SELECT feature_id, least(corners.x1, corners.x4) AS bx0, corners.x2 AS bx1, corners.y1 AS by0, corners.y3 AS by1 FROM corners),
rows_ AS (SELECT feature_id, bx0, bx1, unnest(range(greatest(floor((by0 - y0) / py)::BIGINT - 1, 0), least(floor((by1 - y0) / py)::BIGINT + 2, height))) AS row FROM boxes, s),
cand AS (SELECT feature_id, row, unnest(range(greatest(floor((bx0 - x0) / px)::BIGINT - 1, 0), least(floor((bx1 - x0) / px)::BIGINT + 2, width))) AS col FROM rows_, s),
pts AS (SELECT feature_id, row, col, x0 + (col + 0.5e0) * px AS xc, y0 + (row + 0.5e0) * py AS yc FROM cand, s),
hits AS (SELECT p.feature_id, row, col FROM pts p JOIN edges d ON p.feature_id = d.feature_id
  WHERE yc >= least(e.ay, e.by) AND yc < greatest(e.ay, e.by) AND e.ax + (yc - e.ay) * (e.bx - e.ax) / (e.by - e.ay) <= xc
  GROUP BY ALL HAVING count(*) % 2 = 1),
cells AS (SELECT row, col, max(feature_id) AS feature_id FROM hits GROUP BY row, col)"""

CLEAN = "CASE WHEN {0} IS NULL OR {0} IN (' ', 'nan', '') THEN 'None' ELSE {0} END"
CATEGORY_SQL = f"""
labels_ AS (SELECT 'brand' AS variable, {CLEAN.format('brand')} AS label, feature_id FROM corners
  UNION ALL SELECT 'kind', {CLEAN.format('kind')}, feature_id FROM corners),
categories AS (SELECT variable, label, row_number() OVER (PARTITION BY variable ORDER BY min(feature_id)) AS code FROM labels_ GROUP BY variable, label)"""
