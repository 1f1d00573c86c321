"""Points in boxes over grids of doubling cells: a box lies in four cells at most of the grid whose cells are as large as the box, and a point
in one cell of each grid, so that they meet by an equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Cells are not smaller than 2**SMALLEST.
SMALLEST = -20


def cell(x: Column, level: Column | int) -> Column:
    return F.floor(x.cast("double") / F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level))


def holding(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """points with the box (id) that holds them: of several the last in order; points outside all boxes are left out.

    points: (drawing, x, y) and others; boxes: (drawing, id, x0, y0, x1, y1, ord), edges included. Boxes at the same place are one, the last."""
    shape = ["drawing", "x0", "y0", "x1", "y1"]
    known = boxes.where("x0 <= x1 AND y0 <= y1").groupBy(*shape).agg(F.max(F.struct("ord", "id")).alias("box"))
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).cast("double")
    level = F.greatest(F.ceil(F.log2(F.greatest(wide, F.lit(2.0**SMALLEST)))), F.lit(SMALLEST)).cast("int")
    cells = known.withColumn("level", level)
    span = lambda a, b: F.sequence(cell(F.col(a), F.col("level")), cell(F.col(b), F.col("level")))
    cells = cells.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1")))
    cells = written(cells, "cells")
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # one for each doubling of size
    tags = F.array(*[F.struct(F.lit(n).alias("level"), cell(F.col("x"), n).alias("cx"), cell(F.col("y"), n).alias("cy")) for n in levels]) if levels else F.array().cast("array<struct<level:int,cx:bigint,cy:bigint>>")
    places = points.select("drawing", "x", "y").distinct()
    flat = places.select("*", F.explode(tags).alias("t")).select("drawing", "x", "y", "t.*")
    met = flat.join(cells, ["drawing", "level", "cx", "cy"]).where(F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")))
    found = met.groupBy("drawing", "x", "y").agg(F.max("box").alias("box")).select("drawing", "x", "y", F.col("box.id").alias("box"))
    return points.join(found, ["drawing", "x", "y"])
