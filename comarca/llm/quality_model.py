"""Quality score: ridge regression on random Fourier features of document statistics.

Cosines of random projections of the scaled statistics approximate a Gaussian kernel. Every
partition of the training sample sums its part of the normal equations, and the sums are solved
once. Isotonic regression on other labelled documents turns the ridge values into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import labelled_sample, staged
from comarca.llm.statistics import RATIOS, with_counts, with_ratios

SAMPLE = 60_000
FOURIER = 256
PARTS = 16
RIDGE = 1e-3
BANDWIDTH_ROWS = 500
LARGEST = 4.0
COUNTS = ("n_words", "n_lines", "n_symbols", "n_upper", "n_digits", "n_marks")
FEATURES = (*RATIOS, *[f"log_{name}" for name in COUNTS])


def statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with the statistics that the score rests on."""
    counted = with_ratios(with_counts(docs, text_column, repeats=False))
    return counted.withColumns({f"log_{name}": F.log1p(F.col(name).cast("double")) for name in COUNTS})


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    deviation: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # ridge values at which the isotonic curve has a corner
    heights: np.ndarray

    def features(self, statistics: np.ndarray) -> np.ndarray:
        scaled = np.clip((statistics - self.mean) / self.deviation, -LARGEST, LARGEST)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(scaled), 1))])

    def ridge(self, statistics: np.ndarray) -> np.ndarray:
        return self.features(statistics) @ self.weights

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(statistics), self.steps, self.heights), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step curve nearest to the points, as corners to interpolate between: pools of
    neighbours that would fall are merged. Each pool's height is drawn a little towards the
    mean of all, so that no score is certain, and rises a little within the pool, so that ridge values
    keep their order."""
    if not len(x):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    pools: list[list[float]] = []  # height, weight, first x, last x
    for value, label in zip(x.tolist(), y.tolist(), strict=True):
        pools.append([label, 1.0, value, value])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            height, weight, _, last = pools.pop()
            below = pools[-1]
            below[0] = (below[0] * below[1] + height * weight) / (below[1] + weight)
            below[1] += weight
            below[3] = last
    mean = float(y.mean())
    corners, heights = [], []
    for height, weight, first, last in pools:
        level = (height * weight + mean) / (weight + 1)
        for at in dict.fromkeys((first, last)):
            corners.append(at)
            heights.append(level)
    corners, heights = np.array(corners), np.maximum.accumulate(np.array(heights))
    span = max(corners[-1] - corners[0], 1e-9)
    low, high = corners[0] - span, corners[-1] + span
    corners = np.concatenate([[low], corners, [high]])
    heights = np.concatenate([[heights[0]], heights, [heights[-1]]])
    rise = 1e-3 * (corners - low) / (high - low)
    return corners, heights * (1 - 1e-3) + rise


def _values(row: pd.DataFrame) -> np.ndarray:
    return row[list(FEATURES)].to_numpy(np.float64)


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = SAMPLE,
    seed: int = 0,
) -> QualityModel:
    """Learn from at most ``limit`` labelled documents that are not held out. Runs jobs.

    Three quarters of them fit the ridge, one quarter the isotonic curve. What comes to the
    driver: ``PARTS`` sums of normal equations, ``BANDWIDTH_ROWS`` rows of statistics, and a
    ridge value and label of a quarter of the sample. Without labels all scores are one half.
    """
    sample = labelled_sample(docs, labels, label, limit, id_column, text_column)
    sample = statistics(sample).select("id", F.col("label").cast("double").alias("label"), *FEATURES)
    sample = staged(sample, "quality-sample")
    fits = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(4)) < 3
    columns = [f(name) for name in FEATURES for f in (F.avg, F.stddev_pop)]
    moments = np.array([np.nan if v is None else v for v in sample.where(fits).agg(*columns).first()], float)
    moments = moments.reshape(-1, 2)
    mean, deviation = np.nan_to_num(moments[:, 0]), np.nan_to_num(moments[:, 1])
    deviation = np.where(deviation > 1e-12, deviation, 1.0)

    # The kernel's width: the median distance of some documents.
    some = _values(sample.where(fits).orderBy(F.xxhash64("id", F.lit(17)), "id").limit(BANDWIDTH_ROWS).toPandas())
    some = np.clip((some - mean) / deviation, -LARGEST, LARGEST)
    square = np.maximum(((some[:, None, :] - some[None, :, :]) ** 2).sum(axis=2), 0)
    distances = square[np.triu_indices(len(some), 1)]
    width = float(np.sqrt(np.median(distances))) if len(distances) and np.median(distances) > 0 else 1.0
    random = np.random.default_rng(seed)
    directions = random.normal(size=(len(FEATURES), FOURIER)) / width
    phases = random.uniform(0, 2 * np.pi, FOURIER)
    blank = QualityModel(mean, deviation, directions, phases, np.zeros(FOURIER + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        square, right = np.zeros((FOURIER + 1, FOURIER + 1)), np.zeros(FOURIER + 1)
        for batch in batches:
            waves = blank.features(_values(batch))
            square += waves.T @ waves
            right += waves.T @ batch["label"].to_numpy(np.float64)
        yield pd.DataFrame({"sums": [np.vstack([square, right]).tobytes()]})

    parts = sample.where(fits).repartition(PARTS, "id").mapInPandas(sums, "sums binary").collect()
    total = sum((np.frombuffer(row["sums"]).reshape(FOURIER + 2, FOURIER + 1) for row in parts), np.zeros((FOURIER + 2, FOURIER + 1)))
    count = total[FOURIER, FOURIER]
    if not count:
        return blank
    weights = np.linalg.solve(total[:-1] + RIDGE * count * np.eye(FOURIER + 1) / FOURIER, total[-1])
    fitted = QualityModel(mean, deviation, directions, phases, weights, blank.steps, blank.heights)
    rest = sample.where(~fits).orderBy("id").toPandas()
    return QualityModel(mean, deviation, directions, phases, weights, *isotonic(fitted.ridge(_values(rest)), rest["label"].to_numpy(float)))


def _score(model: QualityModel) -> Column:
    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([c.to_numpy(np.float64) for c in columns], axis=1)))

    return score(*[F.col(name) for name in FEATURES])


def score_quality(
    docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """Score every whole text. One row per row of ``docs``.

    Columns: id, score (0 to 1) and predicted (1 from ``threshold`` on). Null and empty texts
    have statistics of 0, all the same score. Repeated rows are scored each; an empty table gives no rows; a
    text of any length is scored whole; other columns are not looked at. The statistics are built-in expressions; only their few numbers go through Python.
    """
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    scored = statistics(picked).select("id", _score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
