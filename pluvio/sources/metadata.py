"""Link metadata: five tables to one row per link, and the hosts of the links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.geo import haversine_km


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_excluded(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, blank lines skipped."""
    return spark.read.schema("cml_id bigint").csv(path).where(F.col("cml_id").isNotNull())


def load_links(
    links: DataFrame,
    sites: DataFrame,
    technologies: DataFrame,
    mapping: DataFrame,
    *,
    ids: list[int] | None = None,
    min_length: float = 0.01,
    max_length: float = float("inf"),
    excluded: DataFrame | None = None,
) -> DataFrame:
    """Links with both sites, technology and length; cross polarisation counts as vertical.

    The id filter and the exclusion stand before the joins; the length needs both sites.
    """
    if ids:
        links = links.where(F.col("ID").isin(ids))
    if excluded is not None:
        links = links.join(
            excluded.select(F.col("cml_id").alias("ID")).distinct(), "ID", "left_anti"
        )

    def site(end: str) -> DataFrame:
        return sites.select(
            F.col("ID").alias(f"site_{end}"),
            F.col("address").alias(f"name_{end}"),
            F.col("X_coordinate").alias(f"lon_{end}"),
            F.col("Y_coordinate").alias(f"lat_{end}"),
            F.col("X_dummy_coordinate").alias(f"dummy_lon_{end}"),
            F.col("Y_dummy_coordinate").alias(f"dummy_lat_{end}"),
        )

    tech = technologies.select(F.col("ID").alias("technology"), "influx_mapping_ID").join(
        mapping.select(F.col("ID").alias("influx_mapping_ID"), F.col("measurement").alias("tech")),
        "influx_mapping_ID",
    )
    joined = (
        links.withColumnsRenamed({"site_A": "site_a", "site_B": "site_b"})
        .join(site("a"), "site_a")
        .join(site("b"), "site_b")
        .join(tech, "technology")
    )
    return joined.select(
        F.col("ID").cast("bigint").alias("cml_id"),
        F.concat("name_a", F.lit(" <-> "), "name_b").alias("name"),
        "tech", "name_a", "name_b",
        F.col("frequency_A").cast("int").alias("freq_a"),
        F.col("frequency_B").cast("int").alias("freq_b"),
        F.when(F.col("polarization") == "X", "V").otherwise(F.col("polarization")).alias("polarization"),
        F.col("IP_address_A").alias("ip_a"),
        F.col("IP_address_B").alias("ip_b"),
        haversine_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")).alias("length"),
        "lat_a", "lon_a", "lat_b", "lon_b",
        "dummy_lat_a", "dummy_lon_a", "dummy_lat_b", "dummy_lon_b",
    ).where(F.col("length").between(min_length, max_length))


def selected(links: DataFrame, selection: DataFrame) -> DataFrame:
    """Links whose row in the selection (cml_id, enabled) is switched on."""
    return links.join(selection.where("enabled").select("cml_id"), "cml_id", "left_semi")


def hosts_of(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array("ip_a", "ip_b")).alias("agent_host")).distinct()


def missing_hosts(links: DataFrame, wide: DataFrame) -> DataFrame:
    return hosts_of(links).join(wide.select("agent_host").distinct(), "agent_host", "left_anti")


def missing_links(links: DataFrame, wide: DataFrame) -> DataFrame:
    """Every link that lacks one of its hosts, with the hosts it lacks."""
    ends = links.select("cml_id", F.explode(F.array("ip_a", "ip_b")).alias("agent_host"))
    return (
        ends.join(missing_hosts(links, wide), "agent_host")
        .groupBy("cml_id")
        .agg(F.count_distinct("agent_host").alias("n_missing"))
    )
