"""Two directed channels per link from the wide telemetry of its two hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.rainrate import kr_alpha, kr_k
from pluvio.sources.telemetry import few

# Channel names and the technologies that report the received level with its sign turned.
AB, BA = "A(rx)_B(tx)", "B(rx)_A(tx)"
SIGN_TURNED = ("summit", "summit_bt")
CROWD = 1000  # link ends at one host above which the host is split
BROADCAST_ENDS = 100_000  # rows of about 100 bytes


def link_ends(links: DataFrame) -> DataFrame:
    """Two rows per link, one per end: (agent_host, side) with the link's constants.

    Equal frequencies are set 1 MHz apart. A channel carries the frequency of its sending end, and
    the power law is worked out here, per link and not per sample.
    """
    freq_a = F.when(F.col("freq_a") == F.col("freq_b"), F.col("freq_a") + 1).otherwise(F.col("freq_a"))
    dims = links.select(
        "cml_id", "ip_a", "ip_b", "polarization", "length",
        F.col("tech").isin(*SIGN_TURNED).alias("turned"),
        (F.col("freq_b") / 1000.0).alias("f_ab"),
        (freq_a / 1000.0).alias("f_ba"),
    )
    dims = dims.withColumns(
        {
            "k_ab": kr_k("f_ab", "polarization"), "alpha_ab": kr_alpha("f_ab", "polarization"),
            "k_ba": kr_k("f_ba", "polarization"), "alpha_ba": kr_alpha("f_ba", "polarization"),
        }
    )
    constants = ["polarization", "length", "turned", "f_ab", "f_ba", "k_ab", "k_ba", "alpha_ab", "alpha_ba"]
    return dims.select(
        "cml_id",
        F.explode(
            F.array(
                F.struct(F.col("ip_a").alias("host"), F.lit("a").alias("side")),
                F.struct(F.col("ip_b").alias("host"), F.lit("b").alias("side")),
            )
        ).alias("end"),
        *constants,
    ).select("cml_id", F.col("end.host").alias("agent_host"), F.col("end.side").alias("side"), *constants)


def join_ends(wide: DataFrame, ends: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Wide rows joined to the link ends at their host.

    The ends are broadcast if there are few of them. Beyond that the join is a shuffle, and a host
    with more than `crowd` link ends is split: its ends are spread over salts and its rows (one per
    step) are repeated per salt. There are at most 1/crowd as many such hosts as ends, and usually
    none; both counts are taken on the link table.
    """
    if few(ends, BROADCAST_ENDS):
        return wide.join(F.broadcast(ends), "agent_host")
    return join_crowded(wide, ends, crowd)


def join_crowded(wide: DataFrame, ends: DataFrame, crowd: int = CROWD) -> DataFrame:
    crowded = (
        ends.groupBy("agent_host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd)
        .select("agent_host", F.ceil(F.col("n") / crowd).cast("int").alias("salts"))
    )
    if few(crowded, 0):
        return wide.join(ends, "agent_host")
    if few(crowded, BROADCAST_ENDS):
        crowded = F.broadcast(crowded)
    salts = F.coalesce(F.col("salts"), F.lit(1))
    left = wide.join(crowded, "agent_host", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    right = ends.join(crowded, "agent_host", "left").withColumn("salt", F.pmod(F.hash("cml_id"), salts))
    return left.drop("salts").join(right.drop("salts"), ["agent_host", "salt"]).drop("salt")


def build_channels(wide: DataFrame, links: DataFrame, every_link: bool = False) -> DataFrame:
    """Rows (cml_id, channel_id, time, tsl, rsl, temperatures) of the links with both hosts present.

    One shuffle by cml_id brings both ends of a link together. Everything after it that works per
    link or per channel keeps that partitioning. A link has at most one row per step and end.

    A time at which only one end reported is missing in the channel received at the other end; a
    sending end that did not report counts as level 0. With `every_link`, links with one host stay, and has_a and has_b say
    which hosts were seen.
    """
    ends = join_ends(wide, link_ends(links)).repartition("cml_id")
    constants = ["polarization", "length", "turned", "f_ab", "f_ba", "k_ab", "k_ba", "alpha_ab", "alpha_ba"]

    def end(side: str) -> list:
        here = F.col("side") == side
        return [F.max(F.when(here, F.lit(True))).alias(f"{side}_seen")] + [
            F.max(F.when(here, F.col(c))).alias(f"{side}_{c}")
            for c in ("rx_power", "tx_power", "temperature")
        ]

    whole = Window.partitionBy("cml_id")
    paired = (
        ends.groupBy("cml_id", "time", *constants)
        .agg(*end("a"), *end("b"))
        .withColumns({"has_a": F.max("a_seen").over(whole), "has_b": F.max("b_seen").over(whole)})
    )
    flags = ["has_a", "has_b"] if every_link else []
    paired = paired if every_link else paired.where("has_a and has_b")

    def channel(name: str, rx: str, tx: str, way: str):
        seen = F.col(f"{rx}_seen")
        level = F.col(f"{rx}_rx_power")
        return F.struct(
            F.lit(name).alias("channel_id"),
            F.when(seen, F.coalesce(F.col(f"{tx}_tx_power"), F.lit(0.0))).alias("tsl"),
            F.when(F.col("turned"), -level).otherwise(level).alias("rsl"),
            F.when(seen, F.coalesce(F.col(f"{rx}_temperature"), F.lit(0.0))).alias("temperature_rx"),
            F.when(seen, F.coalesce(F.col(f"{tx}_temperature"), F.lit(0.0))).alias("temperature_tx"),
            F.col(f"f_{way}").alias("frequency"),
            F.col(f"k_{way}").alias("k"),
            F.col(f"alpha_{way}").alias("alpha"),
        )

    both = F.array(channel(AB, "a", "b", "ab"), channel(BA, "b", "a", "ba"))
    return paired.select("cml_id", "time", "polarization", "length", *flags, F.explode(both).alias("c")).select(
        "cml_id", "time", "polarization", "length", "c.*", *flags
    )


def paired_channels(channels: DataFrame) -> DataFrame:
    """One row per (cml_id, time) with both channels side by side, links with two channels only."""

    def of(channel: str, column: str):
        return F.max(F.when(F.col("channel_id") == channel, F.col(column)))

    return (
        channels.groupBy("cml_id", "time")
        .agg(
            of(AB, "tsl").alias("tsl_a"), of(BA, "tsl").alias("tsl_b"),
            of(AB, "rsl").alias("rsl_a"), of(BA, "rsl").alias("rsl_b"),
            of(AB, "temperature_rx").alias("temperature_rx"),
            of(BA, "temperature_tx").alias("temperature_tx"),
            F.count(F.lit(1)).alias("n_"),
        )
        .where("n_ = 2")
        .drop("n_")
    )
