"""Regular target grids and lookups in them."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.config import Interp, Limits
from pluvio.functions.geo import mercator_point


@dataclass(frozen=True)
class Grid:
    """nx columns and ny rows; the point of a cell is x0 + (col + shift) * dx, likewise in y."""

    nx: int
    ny: int
    x0: float
    y0: float
    dx: float
    dy: float
    shift: float = 0.5

    def x(self, col: Column) -> Column:
        return F.lit(self.x0) + (col + self.shift) * self.dx

    def y(self, row: Column) -> Column:
        return F.lit(self.y0) + (row + self.shift) * self.dy


def make_grid(interp: Interp = Interp(), limits: Limits = Limits()) -> Grid:
    """Mercator cells by number or by step, or points every `res_deg` degrees."""
    if not interp.mercator:
        res = interp.res_deg
        nx = math.ceil((limits.x_max - limits.x_min) / res)
        ny = math.ceil((limits.y_max - limits.y_min) / res)
        return Grid(nx, ny, limits.x_min, limits.y_min, res, res, 0.0)
    (x_a, y_a), (x_b, y_b) = (
        mercator_point(limits.x_min, limits.y_min),
        mercator_point(limits.x_max, limits.y_max),
    )
    x_lo, x_hi, y_lo, y_hi = min(x_a, x_b), max(x_a, x_b), min(y_a, y_b), max(y_a, y_b)
    if interp.nx is not None and interp.ny is not None:
        nx, ny = interp.nx, interp.ny
    else:
        nx, ny = round((x_hi - x_lo) / interp.step_m), round((y_hi - y_lo) / interp.step_m)
    return Grid(nx, ny, x_lo, y_lo, (x_hi - x_lo) / nx, (y_hi - y_lo) / ny)


def cells(spark: SparkSession, grid: Grid) -> DataFrame:
    """(row, col, x, y) of all cells, generated in the tasks."""
    i = F.col("id")
    out = spark.range(grid.nx * grid.ny).select(
        F.floor(i / grid.nx).cast("int").alias("row"), (i % grid.nx).cast("int").alias("col")
    )
    return out.withColumns({"x": grid.x(F.col("col")), "y": grid.y(F.col("row"))})


def display_row(grid: Grid, row: Column) -> Column:
    """Row counted from the top, as images are drawn."""
    return F.lit(grid.ny - 1) - row


def lookup(points: DataFrame, frames: DataFrame, extent: Limits, n_rows: int, n_cols: int, value: str = "r") -> DataFrame:
    """Value of each frame at the cell nearest to each point (point_id, x, y).

    The extent spans the first to the last cell point. Halves round to even, points outside take
    the border cell, cells without a value give NULL. Points are matched to cells by equality.
    """
    x_step = (extent.x_max - extent.x_min) / (n_cols - 1)
    y_step = (extent.y_max - extent.y_min) / (n_rows - 1)

    def index(v: str, low: float, step: float, n: int) -> Column:
        i = F.rint((F.col(v) - low) / step).cast("int")
        return F.least(F.greatest(i, F.lit(0)), F.lit(n - 1))

    placed = points.withColumns(
        {"row": index("y", extent.y_min, y_step, n_rows), "col": index("x", extent.x_min, x_step, n_cols)}
    )
    return placed.join(frames.select("time", "row", "col", value), ["row", "col"], "left").select(
        "point_id", "row", "col", "time", value
    )
