"""Time the headline queries on $BENCH_SF_DIR; one JSON line on standard output."""

from __future__ import annotations

import json
import os
import time

import catalogue
from pluvio.config import Interp, Limits
from pluvio.operators import grid as gr
from pluvio.operators import idw
from pluvio.session import local_session, stage

HEADLINE = [
    "telemetry_wide", "link_metadata", "link_channels", "signal_clean_fill", "temp_compensated", "wet_rolling",
    "baseline_constant", "waa_schleiss", "waa_pastorek", "rain_hour_sum", "idw_field", "idw_dry_as_missing",
    "frame_flags", "masked_field", "nearby_wetdry", "step_repair", "rolling_median", "rolling_median_long",
    "segment_arrays", "spectral_wetdry", "color_class",
]


def full_grid(spark, sf_dir):
    """Every step of the link rain on the full 598 x 378 grid."""
    series = stage(catalogue.aligned(spark, sf_dir), "aligned")
    limits = Limits(11.4, 19.2, 47.9, 51.3)
    return idw.rain_frames(series, catalogue.links(spark, sf_dir), gr.make_grid(Interp(), limits))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=max(8, int(cpus) if cpus.isdigit() else 8))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # start-up is not timed
    jobs = {name: catalogue.QUERIES[name] for name in HEADLINE} | {"full_grid": full_grid}
    seconds = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline queries", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
