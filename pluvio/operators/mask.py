"""Grid cells inside a polygon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.geo import mercator_x, mercator_y
from pluvio.operators.grid import Grid


def to_mercator(edges: DataFrame) -> DataFrame:
    return edges.withColumns(
        {
            "x1": mercator_x(F.col("x1")), "y1": mercator_y(F.col("y1")),
            "x2": mercator_x(F.col("x2")), "y2": mercator_y(F.col("y2")),
        }
    )


def inside_cells(edges: DataFrame, grid: Grid) -> DataFrame:
    """(row, col) of the cells whose point lies inside the union of the features.

    Each edge crosses a range of grid rows. Along a row the crossings of a feature, sorted, alternate between
    entering and leaving; what lies between two of them is a span of columns. The spans of all features are merged, and their
    cells listed: no cell is tested against an edge, none is listed twice, and rows and columns beyond the bounds never come up.
    """
    if "feature" not in edges.columns:
        edges = edges.withColumn("feature", F.lit(0))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    to_row = lambda y: F.floor((y - grid.y0) / grid.dy - grid.shift)
    rows = edges.where("y1 <> y2").select(
        "feature", "x1", "y1", "x2", "y2",
        F.greatest(to_row(low), F.lit(0)).alias("a"), F.least(to_row(high) + 1, F.lit(grid.ny - 1)).alias("b"),
    ).where("a <= b").select(
        "feature", "x1", "y1", "x2", "y2", F.explode(F.sequence(F.col("a").cast("int"), F.col("b").cast("int"))).alias("row")
    )
    y = grid.y(F.col("row"))
    crossings = rows.withColumn("y", y).where("(y1 <= y) <> (y2 <= y)").select(
        "feature", "row", (F.col("x1") + (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1"))).alias("xc")
    )
    w = Window.partitionBy("feature", "row").orderBy("xc")
    spans = crossings.withColumns({"n": F.row_number().over(w), "x_out": F.lead("xc").over(w)}).where("n % 2 = 1")

    def first_from(x: Column) -> Column:
        """The first column whose point is not left of x."""
        near = F.greatest(F.lit(-1), F.least(F.lit(grid.nx), F.floor((x - grid.x0) / grid.dx - grid.shift)))
        return F.coalesce(*[F.when(grid.x(near + k) >= x, near + k) for k in (-1, 0, 1)], near + 2)

    columns = spans.select(
        "row", F.greatest(first_from(F.col("xc")), F.lit(0)).alias("a"), F.least(first_from(F.col("x_out")) - 1, F.lit(grid.nx - 1)).alias("b")
    ).where("a <= b")
    along = Window.partitionBy("row").orderBy("a", "b")
    reached = F.max("b").over(along.rowsBetween(Window.unboundedPreceding, -1))
    # What begins beyond all before it begins a merged span; what is inside one adds only the columns after its end.
    new = columns.withColumn("a", F.greatest("a", F.coalesce(reached + 1, F.col("a")))).where("a <= b")
    return new.select("row", F.explode(F.sequence(F.col("a").cast("int"), F.col("b").cast("int"))).alias("col"))


def crop(frames: DataFrame, inside: DataFrame) -> DataFrame:
    """Frames on the inside cells only; the cell list is broadcast by Spark if it is small enough."""
    return frames.join(inside, ["row", "col"], "left_semi")
