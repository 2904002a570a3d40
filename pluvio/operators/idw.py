"""Inverse distance weighting of link values to grid cells.

Every cell has one list of candidates: the nearest of all links that have a value at any step, in order, somewhat more than it
needs. A step takes from the list the first links that are present then, so links may come and go without another search. Cells whose list
may be too short at some step get a deeper one, until no cell is short; a list that holds all links in reach never is.

The search halves square buckets from the radius down. At each level a cell keeps the buckets that
may still hold one of its nearest links, judged by the bucket's nearest and farthest corner and
the number of links in it. A bucket with very many links is split until it holds few, so no cell is
ever paired with all links of a crowded place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.geo import mercator_x, mercator_y
from pluvio.operators.grid import Grid, cells
from pluvio.operators.presence import Tile
from pluvio.session import ship, stage

FINEST = 16  # halvings of the search radius
LEAF = 48  # links per bucket below which halving stops


def link_centers(links: DataFrame, mercator: bool = True) -> DataFrame:
    lat, lon = (F.col("lat_a") + F.col("lat_b")) / 2, (F.col("lon_a") + F.col("lon_b")) / 2
    if mercator:
        return links.select("cml_id", mercator_x(lon).alias("px"), mercator_y(lat).alias("py"))
    return links.select("cml_id", lon.alias("px"), lat.alias("py"))


def halvings(centers: DataFrame, radius: float) -> int:
    """Levels needed until no bucket holds more than LEAF distinct places; one small row per level is collected."""
    places = centers.select("px", "py").distinct()
    fine = radius / (1 << FINEST)
    counted = (
        places.select(
            F.floor(F.col("px") / fine).alias("bx"), F.floor(F.col("py") / fine).alias("by"),
            F.explode(F.sequence(F.lit(0), F.lit(FINEST))).alias("level"),
        )
        .groupBy(
            "level",
            F.expr(f"shiftright(bx, {FINEST} - level)").alias("bx"),
            F.expr(f"shiftright(by, {FINEST} - level)").alias("by"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("level").agg(F.max("n").alias("n"))
    )
    crowd = {row["level"]: row["n"] for row in counted.collect()}
    return next((lv for lv in range(FINEST + 1) if crowd.get(lv, 0) <= LEAF), FINEST)


def _corner_distances(edge: float) -> tuple[Column, Column]:
    """Nearest and farthest distance from (x, y) to the bucket (bx, by)."""
    def offsets(p: str, b: str) -> tuple[Column, Column]:
        low, high = F.col(b) * edge, (F.col(b) + 1) * edge
        near = F.greatest(low - F.col(p), F.col(p) - high, F.lit(0.0))
        far = F.greatest(F.abs(low - F.col(p)), F.abs(high - F.col(p)))
        return near, far

    (nx, fx), (ny, fy) = offsets("x", "bx"), offsets("y", "by")
    return F.sqrt(nx * nx + ny * ny), F.sqrt(fx * fx + fy * fy)


def nearest_links(present: DataFrame, targets: DataFrame, k: int, radius: float, levels: int) -> DataFrame:
    """The k nearest links of each cell strictly within the radius: (grp, row, col, cml_id, d, rank).

    `present` has (grp, cml_id, px, py), `targets` (row, col, x, y). Distances that agree to 1e-8
    of the radius are ties and go to the smaller id.
    """
    edge = [radius / (1 << lv) for lv in range(levels + 1)]
    # Of links at one place only the k first by id can count.
    place = Window.partitionBy("grp", "px", "py").orderBy("cml_id")
    points = (
        present.withColumn("copy_", F.row_number().over(place)).where(F.col("copy_") <= k).drop("copy_")
        .withColumns({"bx": F.floor(F.col("px") / edge[-1]), "by": F.floor(F.col("py") / edge[-1])})
    )

    def nodes(level: int) -> DataFrame:
        shift = levels - level
        return points.groupBy(
            "grp", F.shiftright("bx", shift).alias("bx"), F.shiftright("by", shift).alias("by")
        ).agg(F.count(F.lit(1)).alias("n"))

    around = F.sequence(F.lit(-1), F.lit(1))
    start = targets.select(
        "row", "col", "x", "y",
        F.floor(F.col("x") / radius).alias("cx"), F.floor(F.col("y") / radius).alias("cy"),
    ).select("*", F.explode(around).alias("ox")).select("*", F.explode(around).alias("oy"))
    pairs = start.select(
        "row", "col", "x", "y", (F.col("cx") + F.col("ox")).alias("bx"), (F.col("cy") + F.col("oy")).alias("by")
    ).join(nodes(0), ["bx", "by"])

    cell = Window.partitionBy("grp", "row", "col")
    for level in range(levels + 1):
        near, far = _corner_distances(edge[level])
        reach = cell.orderBy("far_").rowsBetween(Window.unboundedPreceding, 0)
        pairs = (
            pairs.withColumns({"near_": near, "far_": far})
            .where(F.col("near_") < radius)
            .withColumn("sum_", F.sum("n").over(reach))
            .withColumn("bound_", F.min(F.when(F.col("sum_") >= k, F.col("far_"))).over(cell))
            .where(F.col("bound_").isNull() | (F.col("near_") <= F.col("bound_") * (1 + 1e-7)))
            .select("grp", "row", "col", "x", "y", "bx", "by")
        )
        if level < levels:
            children = nodes(level + 1).withColumns(
                {"px_": F.shiftright("bx", 1), "py_": F.shiftright("by", 1)}
            ).withColumnsRenamed({"bx": "cbx", "by": "cby"})
            pairs = pairs.join(
                children,
                (pairs["grp"] == children["grp"]) & (pairs["bx"] == children["px_"]) & (pairs["by"] == children["py_"]),
            ).select(
                pairs["grp"], "row", "col", "x", "y", F.col("cbx").alias("bx"), F.col("cby").alias("by"), "n"
            )

    dx, dy = F.col("px") - F.col("x"), F.col("py") - F.col("y")
    ranked = cell.orderBy(F.floor(F.col("d") / radius * 1e8), "cml_id")
    return (
        pairs.join(points, ["grp", "bx", "by"])
        .select("grp", "row", "col", "cml_id", F.sqrt(dx * dx + dy * dy).alias("d"))
        .where(F.col("d") < radius)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
    )


def _listed(present: DataFrame, targets: DataFrame, depth: int, radius: float, levels: int, tile: int) -> DataFrame:
    """(trow, tcol, row, col, links): the nearest links of each cell in order, as (cml_id, d); full: there may be more in reach."""
    found = nearest_links(present.withColumn("grp", F.lit(0)), targets, depth, radius, levels)
    packed = found.groupBy("row", "col").agg(F.sort_array(F.collect_list(F.struct("rank", "cml_id", "d"))).alias("links"))
    return packed.select(
        F.floor(F.col("row") / tile).alias("trow"), F.floor(F.col("col") / tile).alias("tcol"), "row", "col",
        F.transform("links", lambda n: F.struct(n["cml_id"].alias("cml_id"), n["d"].alias("d"))).alias("links"),
        (F.size("links") >= depth).alias("full"),
    )


def _by_tile(lists: DataFrame, values: DataFrame, parts: int, part: Column | None, fn: Callable, schema: str) -> DataFrame:
    """Call fn on the cells of a tile and the values of the links in their lists, for a part of the steps."""
    tile = ["trow", "tcol"]
    used = lists.select(F.col("trow").alias("tr"), F.col("tcol").alias("tc"), F.explode("links.cml_id").alias("cml_id")).distinct()
    sent = used.join(values.where("z is not null"), "cml_id").withColumn(
        "pt", F.pmod(F.hash("time"), F.lit(parts)) if part is None else part.cast("int")
    )
    cells_ = lists.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # The work is in the groups, not in the bytes that are shuffled: one task for a few groups.
    spark = lists.sparkSession
    groups = parts * lists.select(*tile).distinct().count()
    tasks = max(1, min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups // 4)))
    ship(spark)
    key = [*tile, "part"]
    left = cells_.repartition(tasks, *key).groupBy(*key)
    own = ["tr", "tc", "pt"]
    right = sent.select(*own, "time", "cml_id", F.col("z").cast("double").alias("z")).repartition(tasks, *own).groupBy(*own)
    return left.cogroup(right).applyInArrow(fn, schema)


def neighbour_lists(
    values: Sequence[DataFrame], centers: DataFrame, targets: DataFrame, *, near: int, radius: float, tile: int = 32, parts: int = 1,
    depth: int | None = None, part: Column | None = None,
) -> DataFrame:
    """Candidate lists of all cells, long enough for every step of all the values (cml_id, time, z). Staged."""
    known = reduce(DataFrame.unionByName, [v.where("z is not null").select("cml_id") for v in values]).distinct()
    present = stage(centers.join(known, "cml_id"), "present")
    levels = halvings(present, radius)
    depth = depth or 2 * near
    lists = open_ = stage(_listed(present, targets, depth, radius, levels, tile), "candidates")

    def short(cells_: pa.Table, sent: pa.Table) -> pa.Table:
        few = Tile(cells_, sent, near).short_cells() if len(cells_) else np.zeros(0, np.int64)
        return cells_.select(["row", "col"]).take(pa.array(few))

    while True:
        unsure = open_.where("full")
        if unsure.isEmpty():
            return lists
        found = reduce(DataFrame.unionByName, [_by_tile(unsure, v, parts, part, short, "row int, col int") for v in values])
        again = stage(found.distinct(), "short")
        if again.isEmpty():
            return lists
        depth *= 4
        open_ = stage(_listed(present, targets.join(again, ["row", "col"]), depth, radius, levels, tile), "candidates")
        lists = stage(lists.join(again, ["row", "col"], "left_anti").select(open_.columns).unionByName(open_), "candidates")


def consume(lists: DataFrame, values: DataFrame, *, near: int, power: float, parts: int = 1, part: Column | None = None) -> DataFrame:
    """Frames (time, row, col, v): each step weighs the first `near` links of a cell's list that are present.

    The steps of a tile are spread over so many `parts`, by a hash or by the number (from 0) that `part` gives to each time.
    """
    def frames(cells_: pa.Table, sent: pa.Table) -> pa.Table:
        return Tile(cells_, sent, near).frames(power)

    return _by_tile(lists, values, parts, part, frames, f"time {dict(values.dtypes)['time']}, row int, col int, v double")


def interpolate(
    values: DataFrame,
    centers: DataFrame,
    targets: DataFrame,
    *,
    near: int = 12,
    radius: float = 20000.0,
    power: float = 2.0,
    tile: int = 32,
    parts: int = 1,
    depth: int | None = None,
) -> DataFrame:
    """Frames (time, row, col, v) of values (cml_id, time, z); cells without a neighbour have no row.

    The values travel to tiles of cells, once per tile that lists their link and not once per cell. With `parts`, the steps of a tile
    are spread over that many tasks and its cells are repeated for each.
    """
    lists = neighbour_lists([values], centers, targets, near=near, radius=radius, tile=tile, parts=parts, depth=depth)
    return consume(lists, values, near=near, power=power, parts=parts)


def clean_frames(frames: DataFrame, least: float) -> DataFrame:
    """Values below the least rain become 0."""
    return frames.withColumn("v", F.when(F.col("v") < least, 0.0).otherwise(F.col("v")))


def rain_frames(
    link_values: DataFrame,
    links: DataFrame,
    grid: Grid,
    *,
    value: str = "r",
    least: float = 0.1,
    near: int = 12,
    radius: float = 20000.0,
    power: float = 2.0,
    mercator: bool = True,
    dry_as_missing: bool = False,
    tile: int = 32,
    parts: int = 1,
    inside: DataFrame | None = None,
) -> DataFrame:
    """Interpolated and cleaned frames (time, row, col, v) of one column of the link series."""
    z = F.nullif(F.col(value), F.lit(0.0)) if dry_as_missing else F.col(value)
    made = frames_by_kind(
        link_values, links, grid, {value: (z, least)}, near=near, radius=radius, power=power, mercator=mercator,
        tile=tile, parts=parts, inside=inside,
    )
    return made[value]


def frames_by_kind(
    link_values: DataFrame,
    links: DataFrame,
    grid: Grid,
    kinds: dict[str, tuple[Column, float]],
    *,
    near: int = 12,
    radius: float = 20000.0,
    power: float = 2.0,
    mercator: bool = True,
    tile: int = 32,
    parts: int = 1,
    inside: DataFrame | None = None,
    part: Column | None = None,
) -> dict[str, DataFrame]:
    """Frames of several columns {kind: (values, least rain)} with one set of candidate lists.

    `inside` (row, col) restricts the cells. Reading one kind works out that kind only.
    """
    values = {kind: link_values.select("cml_id", "time", z.alias("z")) for kind, (z, _least) in kinds.items()}
    targets = cells(links.sparkSession, grid)
    if inside is not None:
        targets = targets.join(inside, ["row", "col"], "left_semi")
    lists = neighbour_lists(list(values.values()), link_centers(links, mercator), targets, near=near, radius=radius, tile=tile, parts=parts, part=part)
    return {
        kind: clean_frames(consume(lists, v, near=near, power=power, parts=parts, part=part), kinds[kind][1]) for kind, v in values.items()
    }
