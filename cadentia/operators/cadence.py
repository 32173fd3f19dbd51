"""From per-observation scores to ranked detections."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadentia.functions.text import pattern_string
from cadentia.geometry import Geometry
from cadentia.operators.spectral import overlap_snippets
from cadentia.settings import DetectionRule

RULE = DetectionRule()
REPORT_COLUMNS = (
    "frequency_MHz",
    "confidence",
    "classification",
    "observation_pattern",
    "frequency_index",
)


def is_positive(p: Column, threshold: float) -> Column:
    """Strictly above the threshold; NaN, which Spark sorts above all numbers, is not."""
    return (p > threshold) & ~F.isnan(p)


def threshold_predict(df: DataFrame, threshold: float = RULE.threshold, p: str = "p") -> DataFrame:
    return df.withColumn("prediction", F.when(is_positive(F.col(p), threshold), 1).otherwise(0))


def predict_confidence(df: DataFrame, threshold: float = RULE.threshold, p: str = "p") -> DataFrame:
    """Prediction and the probability of the class it names."""
    p1 = F.col(p)
    return threshold_predict(df, threshold, p).withColumn(
        "confidence", F.when(F.col("prediction") == 1, p1).otherwise(F.lit(1.0) - p1)
    )


def score_join(snippets: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores matched to snippets by key; either side's extra rows drop out."""
    return snippets.join(scores, ["band", "obs", "start_index"])


def cadence_patterns(
    scores: DataFrame, n_obs: int, threshold: float = RULE.threshold
) -> DataFrame:
    """Per ``(band, start_index)``: ON and OFF positives, mean probability, pattern.

    The pattern is kept as one counter per observation and only spelled out at the
    end, so a key's rows are combined before the shuffle and never gathered.
    """
    hits = [F.count_if(F.col("obs") == i).alias(f"_h{i}") for i in range(n_obs)]
    grouped = (
        scores.where(is_positive(F.col("p"), threshold))
        .groupBy("band", "start_index")
        .agg(*hits, F.avg("p").alias("confidence"))
    )
    total = lambda first: reduce(
        lambda a, b: a + b, [F.col(f"_h{i}") for i in range(first, n_obs, 2)]
    )
    spelled = F.flatten(
        F.array(*[F.array_repeat(F.lit(i), F.col(f"_h{i}").cast("int")) for i in range(n_obs)])
    )
    return grouped.select(
        "band",
        "start_index",
        total(0).alias("on_hits"),
        total(1).alias("off_hits"),
        "confidence",
        spelled.alias("pattern"),
    )


def classify(patterns: DataFrame, min_on: int = RULE.min_on) -> DataFrame:
    """ON only, often enough -> candidate; ON and OFF -> interference; the rest is dropped."""
    on, off = F.col("on_hits"), F.col("off_hits")
    kind = F.when((on >= min_on) & (off == 0), "ETI_candidate").when((on > 0) & (off > 0), "RFI_likely")
    return (
        patterns.withColumn("classification", kind)
        .where(F.col("classification").isNotNull())
        .withColumnRenamed("start_index", "frequency_index")
    )


def to_frequency(
    detections: DataFrame, geo: Geometry, rule: DetectionRule = RULE
) -> DataFrame:
    """Frequency of a snippet's first channel; band ``i`` starts at ``first + i * step`` MHz."""
    start_hz = (F.lit(rule.first_band_mhz) + F.col("band") * F.lit(rule.band_step_mhz)) * F.lit(1e6)
    channel_hz = geo.freq_resolution_hz * geo.factor
    return detections.withColumn(
        "frequency_MHz", (start_hz + F.col("frequency_index") * F.lit(channel_hz)) / F.lit(1e6)
    )


def detect(
    scores: DataFrame,
    geo: Geometry,
    rule: DetectionRule = RULE,
) -> DataFrame:
    """Scores -> detections with frequency and pattern text. One shuffle; all bands at once."""
    found = classify(cadence_patterns(scores, geo.n_obs, rule.threshold), rule.min_on)
    return to_frequency(found, geo, rule).select(
        "band",
        *REPORT_COLUMNS[:3],
        pattern_string(F.col("pattern")).alias("observation_pattern"),
        "frequency_index",
    )


def rank_detections(detections: DataFrame) -> DataFrame:
    """Most confident first; ties in band and frequency order, so the order is total."""
    return detections.orderBy(F.desc("confidence"), "band", "frequency_index")


def combine_bands(bands: list[DataFrame]) -> DataFrame:
    """Detections stored per band as one ranked table; empty bands keep the schema."""
    return rank_detections(reduce(DataFrame.unionByName, bands))


def detection_counts(detections: DataFrame) -> DataFrame:
    return detections.groupBy("classification").agg(F.count(F.lit(1)).alias("detections"))


def high_confidence(detections: DataFrame, above: float = RULE.high_confidence) -> DataFrame:
    return detections.where(F.col("confidence") > above)


def band_scan(
    obs: DataFrame,
    geo: Geometry,
    scorer: Callable[[DataFrame], DataFrame],
    *,
    size: int,
    overlap: float = 0.5,
    rule: DetectionRule = RULE,
) -> DataFrame:
    """Snippets of every band -> scores -> detections, as one plan.

    ``scorer`` adds a column ``p`` from ``cells``. The cells are dropped before the
    only shuffle, which moves one small row per positive snippet and map task.
    """
    scores = scorer(overlap_snippets(obs, geo, size, overlap)).select("band", "obs", "start_index", "p")
    return detect(scores, geo, rule)
