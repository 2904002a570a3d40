"""GeoJSON polygons as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RINGS = "array<array<array<double>>>"


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Edges (feature, ring, i, x1, y1, x2, y2) of all polygons of a FeatureCollection file.

    `feature` numbers the polygons: a point is inside one if a ray from it crosses an odd number of its edges, those of its holes
    included, and inside the union if it is inside any of them, overlapping or not.
    """
    parts = spark.read.text(path, wholetext=True).select(
        F.explode(
            F.from_json(
                "value",
                "features array<struct<geometry:struct<type:string,coordinates:string>>>",
            )["features"]
        ).alias("f")
    ).select(F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("text"))
    polygons = F.when(F.col("kind") == "Polygon", F.array(F.from_json("text", _RINGS))).otherwise(F.from_json("text", f"array<{_RINGS}>"))
    numbered = parts.select(F.explode(polygons).alias("rings")).withColumn("feature", F.monotonically_increasing_id())
    return edges(numbered.select("feature", F.posexplode("rings").alias("ring", "points")))


def edges(rings: DataFrame) -> DataFrame:
    """Edges of rings given as (ring, points array<array<double>>), with a feature if they have one; open rings are closed."""
    n = F.size("points")
    of = [c for c in ("feature",) if c in rings.columns]
    return rings.select(
        *of, "ring", F.posexplode("points").alias("i", "p"), "points"
    ).select(
        *of, "ring",
        "i",
        F.col("p")[0].alias("x1"),
        F.col("p")[1].alias("y1"),
        F.get(F.col("points"), F.pmod(F.col("i") + 1, n))[0].alias("x2"),
        F.get(F.col("points"), F.pmod(F.col("i") + 1, n))[1].alias("y2"),
    ).where("x1 <> x2 or y1 <> y2")


def literal_rings(spark: SparkSession, rings: list[list[tuple[float, float]]]) -> DataFrame:
    return spark.createDataFrame(
        [(k, [list(map(float, p)) for p in ring]) for k, ring in enumerate(rings)],
        "ring bigint, points array<array<double>>",
    )
