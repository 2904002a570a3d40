"""Reference flags, class balance, segments and feature windows for wet/dry classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.grouped import map_groups
from pluvio.operators.series import with_blocks, with_positions
from pluvio.session import ship


def _ordered(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("time")


def repair_single_zeros(df: DataFrame, keys: Sequence[str], rain: str = "rain") -> DataFrame:
    """A dry row with rain within two rows on both sides gets 0.01."""
    order = _ordered(keys)
    wet = F.col(rain) != 0
    after = F.lead(wet, 1, False).over(order) | F.lead(wet, 2, False).over(order)
    before = F.lag(wet, 1, False).over(order) | F.lag(wet, 2, False).over(order)
    return df.withColumn("gap_", after & before & ~wet).withColumn(
        rain, F.when(F.col("gap_"), 0.01).otherwise(F.col(rain))
    ).drop("gap_")


def zero_event_tails(df: DataFrame, keys: Sequence[str], upsampled: int, rain: str = "rain") -> DataFrame:
    """Set the last upsampled-1 rows of each rain event to 0."""
    if upsampled < 2:
        return df
    order = _ordered(keys)
    wet = F.col(rain) != 0
    out = df.withColumn("end_", wet & ~F.lead(wet, 1, False).over(order))
    tail = F.max("end_").over(order.rowsBetween(0, upsampled - 2))
    return out.withColumn("tail_", tail).withColumn(
        rain, F.when(F.col("tail_"), 0.0).otherwise(F.col(rain))
    ).drop("end_", "tail_")


def reference_flags(df: DataFrame, keys: Sequence[str], minutes: float = 30.0, rain: str = "rain") -> DataFrame:
    """Rain summed per interval and divided by 20, on every row of it; ref_wd above 0.15, never on the first row.

    Series are dealt to all partitions, which are not put together by their size: a task sorts its rows several times over.
    """
    df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    seconds = int(minutes * 60)
    bucket = F.floor(F.unix_timestamp("time") / seconds)
    total = F.sum(rain).over(Window.partitionBy(*keys, "bucket_")) / 20.0
    return (
        df.withColumn("bucket_", bucket)
        .withColumn(rain, total)
        .withColumn("ref_wd", (F.col(rain) > 0.15) & (F.row_number().over(_ordered(keys)) > 1))
        .drop("bucket_")
    )


def islands(df: DataFrame, keys: Sequence[str], flag: str = "ref_wd") -> DataFrame:
    """Add `island`, numbering runs of equal flags from 1, and `island_rows`."""
    order = _ordered(keys)
    changed = F.coalesce((F.col(flag) != F.lag(flag).over(order)).cast("int"), F.lit(1))
    out = df.withColumn("changed_", changed).withColumn(
        "island", F.sum("changed_").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("changed_")
    # In the order of time, as `balance` numbers the rows, so that both share one sort.
    whole = Window.partitionBy(*keys, "island").orderBy("time").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return out.withColumn("island_rows", F.count(F.lit(1)).over(whole))


def balance(df: DataFrame, keys: Sequence[str], longest: int = 600, flag: str = "ref_wd") -> DataFrame:
    """Keep the first and last longest/2 rows of dry runs longer than `longest`, and all other rows."""
    half = longest // 2
    inside = Window.partitionBy(*keys, "island").orderBy("time")
    out = islands(df, keys, flag).withColumn("n_", F.row_number().over(inside))
    edge = (F.col("n_") <= half) | (F.col("n_") > F.col("island_rows") - half)
    return out.where(F.col(flag) | (F.col("island_rows") <= longest) | edge).drop("n_")


def segments(df: DataFrame, keys: Sequence[str], size: int, seed: int = 0) -> DataFrame:
    """Add segment_id, the row number divided by the size, and a random segment order per series."""
    out = df.withColumn("row_", F.row_number().over(_ordered(keys)) - 1).withColumn(
        "segment_id", F.floor(F.col("row_") / size)
    )
    order = Window.partitionBy(*keys).orderBy(F.xxhash64("segment_id", F.lit(seed)), "segment_id")
    return out.withColumn("shuffled_id", F.dense_rank().over(order) - 1)


def segment_arrays(df: DataFrame, keys: Sequence[str], size: int, columns: Sequence[str], label: str | None = None) -> DataFrame:
    """One row per full segment: an array of `size` values per column; the label is that of the first row."""
    numbered = segments(df, keys, size)
    names = [*columns, *([label] if label else [])]
    rows = F.array_sort(F.collect_list(F.struct("row_", *names)))
    grouped = numbered.groupBy(*keys, "segment_id").agg(rows.alias("rows")).where(F.size("rows") == size)
    out = [F.col(f"rows.{c}").alias(c) for c in columns]
    if label:
        out.append(F.col("rows")[0][label].alias(label))
    return grouped.select(*keys, "segment_id", *out)


def expand_segments(df: DataFrame, scores: DataFrame, keys: Sequence[str], size: int, threshold: float = 0.5) -> DataFrame:
    """Scores (keys, segment_id, probability) on every row: wet at or above the threshold, tail rows missing."""
    numbered = segments(df, keys, size).drop("shuffled_id", "row_")
    return numbered.join(scores, [*keys, "segment_id"], "left").withColumn(
        "wet", F.col("probability") >= threshold
    )


def feature_windows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], back: int, ahead: int = 0) -> DataFrame:
    """Add `features`: the values of the rows -back..ahead, column after column; NULL if any is missing."""
    w = _ordered(keys).rowsBetween(-back, ahead)
    size = back + ahead + 1
    whole = F.lit(True)
    for c in columns:
        whole = whole & (F.count(c).over(w) == size)
    lists = [F.collect_list(c).over(w) for c in columns]
    return df.withColumn("features", F.when(whole, F.concat(*lists)))


def align_predictions(df: DataFrame, keys: Sequence[str], score: str, window: int = 180, shift: int = 29) -> DataFrame:
    """Move scores from the last row of their window `shift` rows on; the first score fills the rows between."""
    order = _ordered(keys)
    first = F.max(F.when(F.col("n_") == window, F.col(score))).over(Window.partitionBy(*keys))
    out = df.withColumn("n_", F.row_number().over(order)).withColumns(
        {"moved_": F.lag(score, shift).over(order), "first_": first}
    )
    value = F.when(F.col("n_").between(window, window + shift - 1), F.col("first_")).when(
        F.col("n_") >= window + shift, F.col("moved_")
    )
    return out.withColumn(score, value).drop("n_", "moved_", "first_")


def trim_leading(df: DataFrame, keys: Sequence[str], rows: int = 327) -> DataFrame:
    """Series without their first rows, which a sliding classifier cannot score."""
    return df.withColumn("n_", F.row_number().over(_ordered(keys))).where(F.col("n_") > rows).drop("n_")


def split(segment_rows: DataFrame, share: float = 0.8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Training and validation segments by a hash of series and segment."""
    u = F.pmod(F.xxhash64("cml_id", "segment_id", F.lit(seed)), F.lit(10_000)) / 10_000
    return segment_rows.where(u < share), segment_rows.where(u >= share)


def fit_classifier(train: DataFrame, features: str = "features", label: str = "label", hidden: Sequence[int] = (20,), seed: int = 1):
    """A feed-forward net with the given hidden layers, trained by pyspark.ml on the executors."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector

    ready = train.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(
        array_to_vector(features).alias("vector"), F.col(label).cast("double").alias("label")
    )
    size = train.where(F.col(features).isNotNull()).select(F.size(features).alias("n")).first()["n"]
    net = MultilayerPerceptronClassifier(
        layers=[size, *hidden, 2], featuresCol="vector", labelCol="label", seed=seed, maxIter=50
    )
    return net.fit(ready)


def score_with_model(df: DataFrame, model, features: str = "features") -> DataFrame:
    """Add the probability of rain; rows without features have none."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    known = df.where(F.col(features).isNotNull()).withColumn("vector", array_to_vector(features))
    scored = model.transform(known).withColumn("probability", vector_to_array("probability")[1])
    out = scored.drop("vector", "rawPrediction", "prediction")
    missing = df.where(F.col(features).isNull()).withColumn("probability", F.lit(None).cast("double"))
    return out.unionByName(missing)


def score_with(df: DataFrame, scorer: Callable[[pd.Series], pd.Series], features: str = "features") -> DataFrame:
    """Add the probability a given scorer returns for batches of feature vectors."""
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", probability double"

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            known = pdf[features].notna()
            p = pd.Series(float("nan"), index=pdf.index)
            if known.any():
                p[known] = scorer(pdf.loc[known, features]).to_numpy()
            yield pdf.assign(probability=p)

    ship(df.sparkSession)
    out = df.mapInPandas(batches, schema)
    return out.withColumn("probability", F.when(~F.isnan("probability"), F.col("probability")))


def score_blocks(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], back: int, ahead: int, scorer: Callable[[np.ndarray], np.ndarray],
    *, block: int = 4096, part: Column | None = None,
) -> DataFrame:
    """(keys, time, probability) of the rows -back..ahead around every row; missing where a value is missing or beyond the series.

    A series is cut into blocks of rows that overlap by a window. Only the columns themselves travel: the windows are views on a
    block, (windows, columns, rows of a window) for the scorer, and nothing but keys and probability comes back.
    """
    part = F.date_trunc("month", "time") if part is None else part
    slim = df.select(*keys, "time", *[F.col(c).cast("double").alias(c) for c in columns])
    blocks = with_blocks(with_positions(slim, keys, ["time"], part), block, back, ahead)
    names = [*keys, "time", "probability"]
    schema = ", ".join(f"`{c}` {dict(slim.dtypes).get(c, 'double')}" for c in names)
    size = back + ahead + 1

    def score(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        out = np.full(len(pdf), np.nan)
        values = pdf[list(columns)].to_numpy("float64").T
        for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True):
            if b - a < size:
                continue
            views = np.lib.stride_tricks.sliding_window_view(values[:, a:b], size, axis=1).transpose(1, 0, 2)
            whole = np.flatnonzero(np.isfinite(views).all(axis=(1, 2)))
            if len(whole):
                out[a + back + whole] = scorer(views if len(whole) == len(views) else views[whole])
        return pdf.assign(probability=out).loc[pdf["core"].to_numpy(bool), names]

    out = map_groups(blocks, [*keys, "block_id"], ["pos"], score, schema)
    return out.withColumn("probability", F.when(~F.isnan("probability"), F.col("probability")))


def over(probability: Column, threshold: float) -> Column:
    """Wet strictly above the threshold, as sliding classifiers use it; NULL stays NULL."""
    return probability > threshold
