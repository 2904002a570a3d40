"""Wet flags from trained classifiers, ready for `rain_rates` with method `given`."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.config import CLASSIFIER_WARMUP
from pluvio.operators import preprocess, quality, training, wetdry
from pluvio.operators.channels import AB, BA, paired_channels

Scorer = Callable[[pd.Series], pd.Series]
KEY = ["cml_id"]
BOTH = ["trsl_a", "trsl_b"]


def segment_flags(fine: DataFrame, scorer: Scorer, *, size: int = 60, threshold: float = 0.5, **chain) -> DataFrame:
    """(cml_id, time, wet) per fine row: a segment of `size` rows is wet if it scores at least the threshold.

    Segments with a missing value and the rows after the last full segment have no flag.
    """
    ready = preprocess.preprocess(paired_channels(fine), KEY, keep_rows=True, **chain)
    numbered = ready.select("cml_id", "time", *BOTH)
    arrays = training.segment_arrays(numbered, KEY, size, BOTH)
    whole = F.forall("features", lambda x: x.isNotNull())
    features = arrays.withColumn("features", F.concat(*BOTH)).withColumn("features", F.when(whole, F.col("features")))
    scores = training.score_with(features.select("cml_id", "segment_id", "features"), scorer).drop("features")
    return training.expand_segments(numbered, scores, KEY, size, threshold).select("cml_id", "time", "wet")


def flags_from_fine(
    channels: DataFrame, fine: DataFrame, scorer: Scorer, *, minutes: int = 10, rule: str = "max", **options
) -> DataFrame:
    """Channels with a `wet` column worked out on finer channels (30 s) of the same links."""
    steps = wetdry.flags_to_steps(segment_flags(fine, scorer, **options), minutes, rule)
    return wetdry.attach_flags(channels, steps)


def sliding_flags(
    channels: DataFrame,
    scorer: Callable[[np.ndarray], np.ndarray],
    *,
    threshold: float = 0.82,
    window: int = 180,
    shift: int = 29,
    median_rows: int = 4320,
    median_min: int = 120,
    trim: int = CLASSIFIER_WARMUP,
) -> DataFrame:
    """Channels with a `wet` column from a window sliding over both path losses, without the first rows.

    The scorer gets windows as (windows, path losses, rows) and returns a probability each; see `training.score_blocks`. Rows the
    classifier cannot judge are dry.
    """
    clean = quality.clean(channels, temperature=False)

    def of(channel: str):
        return F.max(F.when(F.col("channel_id") == channel, F.col("trsl")))

    rows = clean.groupBy("cml_id", "time").agg(of(AB).alias("trsl_a"), of(BA).alias("trsl_b"))
    rows = preprocess.shift_ahead(rows, KEY, BOTH, shift)
    rows = preprocess.subtract_median(rows, KEY, BOTH, median_rows, centered=False, min_rows=median_min)
    scored = training.score_blocks(rows, KEY, BOTH, window - 1, 0, scorer)
    placed = training.align_predictions(scored, KEY, "probability", window, shift)
    wet = F.coalesce(training.over(F.col("probability"), threshold), F.lit(False))
    flags = training.trim_leading(placed, KEY, trim).select("cml_id", "time", wet.alias("wet"))
    return channels.join(flags, ["cml_id", "time"])
