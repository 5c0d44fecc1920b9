"""Toxic passages as maximum-scoring segments of token log-odds.

A token's score is how much likelier it is in toxic documents: a log-odds ratio with a Dirichlet
prior of the pooled frequencies, reduced by its own uncertainty so that rare words count nothing.
A linear scan finds all maximal segments of a document's scores. How surprising a segment is
follows an extreme-value law in its score and the document's length; a document's evidence is the
sum over its significant segments, turned into a probability on labelled documents that did not
give scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import labelled_sample, rows_of, small_batches, staged, staged_small, unmatched, unpacked
from comarca.llm.words import slices, word_codes

SAMPLE = 60_000
PRIOR_TOKENS = 1000.0
LEAST_COUNT = 0.5
DEVIATIONS = 1.7
# What a token without a score takes off a segment.
DRIFT = 0.5
PASSAGES = "array<struct<first:int,last:int,score:double>>"
EDGES = " !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡«»¿–—‘’“”„…"


def tokens_of(words: pa.Array) -> pa.Array:
    """Words in lower case, without marks at their ends."""
    return pc.utf8_trim(pc.utf8_lower(words), characters=EDGES)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as (first, last, score), in order.

    Linear time: sums are cumulative, only positive scores open or join segments, and every
    segment knows the nearest earlier one that starts lower, so that none is passed twice.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    # First, last, sum before, sum after, and the place of the nearest earlier one with a lower sum before, or -1.
    found: list[tuple[int, int, float, float, int]] = []
    for at in np.flatnonzero(scores > 0).tolist():
        first, low, high = at, float(sums[at]), float(sums[at + 1])
        # Join those that end lower than this one ends, from where the sum was lower.
        below = len(found) - 1
        while below >= 0:
            if found[below][2] >= low:
                below = found[below][4]
                continue
            if found[below][3] >= high:
                break
            first, _, low, _, lower = found[below]
            del found[below:]
            below = lower
        found.append((first, at, low, high, below))
    return [(first, last, high - low) for first, last, low, high, _ in found]


@dataclass(frozen=True)
class ToxicityModel:
    words: list[str]
    scores: list[float]
    rate: float  # of the extreme-value law: a segment's chance falls as exp(-rate * score)
    scale: float  # expected segments of score 0 or more for each token of clean text
    bias: float
    slope: float

    def chances(self, length: int, segments: list[tuple[int, int, float]]) -> list[float]:
        """How many segments of such a score a clean text of this length is expected to have, as
        negative logarithms; over 0 is significant."""
        base = math.log(max(self.scale * max(length, 1), 1e-12))
        return [self.rate * score - base for _, _, score in segments]

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.slope * evidence, -500, 500)))


def _scan(texts: pa.Array, words: pa.Array, scores: np.ndarray) -> Iterator[tuple[int, list]]:
    """The number of tokens and the maximal segments of every text."""
    for part in slices(texts):
        codes, starts, distinct = word_codes(part)
        place = pc.fill_null(pc.index_in(tokens_of(distinct), value_set=words), -1).to_numpy(zero_copy_only=False)
        of_word = np.where(place >= 0, scores[place] if len(scores) else 0.0, 0.0) - DRIFT
        of_token = of_word[codes] if len(codes) else np.empty(0)
        hits = np.concatenate([[0], np.cumsum(of_token > 0)])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            yield b - a, maximal_segments(of_token[a:b]) if hits[b] > hits[a] else []


def _summary(model: ToxicityModel):
    """A column function of the text: its evidence, and its significant passages."""
    words = pa.array(model.words, pa.large_string())
    scores = np.array(model.scores, dtype=np.float64)

    @F.arrow_udf(f"struct<evidence:double,passages:{PASSAGES}>")
    def summary(texts: pa.Array) -> pa.Array:
        evidence, firsts, lasts, values, ends = [], [], [], [], [0]
        for length, segments in _scan(texts, words, scores):
            sure = [(s, c) for s, c in zip(segments, model.chances(length, segments), strict=True) if c > 0]
            evidence.append(sum(c for _, c in sure))
            for (first, last, score), _ in sure:
                firsts.append(first)
                lasts.append(last)
                values.append(score)
            ends.append(len(firsts))
        columns = [pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32()), pa.array(values, pa.float64())]
        passage = pa.StructArray.from_arrays(columns, ["first", "last", "score"])
        passages = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), passage)
        return pa.StructArray.from_arrays([pa.array(evidence, pa.float64()), passages], ["evidence", "passages"])

    return summary


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each token comes in the clean and in the toxic texts of a slice."""
    for batch in batches:
        labels = batch.column(1).to_numpy()
        at = 0
        for part in slices(batch.column(0)):
            codes, starts, distinct = word_codes(part)
            toxic = np.repeat(labels[at : at + len(part)] != 0, np.diff(starts))
            at += len(part)
            counts = [np.bincount(codes[own], minlength=len(distinct)) for own in (~toxic, toxic)]
            yield pa.RecordBatch.from_arrays(
                [tokens_of(distinct).cast(pa.string()), *[pa.array(c.astype(np.int64)) for c in counts]],
                ["token", "clean", "toxic"],
            )


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = SAMPLE,
) -> ToxicityModel:
    """Learn from at most ``limit`` labelled documents that are not held out. Runs jobs.

    Three quarters of them give the token scores and the law, the last quarter the
    probabilities. Every word that these documents show to be toxic is in the model, so ``limit`` alone
    bounds its size. Without toxic documents among them all probabilities are small.
    """
    sample = staged(labelled_sample(docs, labels, label, limit, id_column, text_column), "toxic-sample")
    for_scores = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(4)) < 3
    counts = sample.where(for_scores).select("text", "label").mapInArrow(
        _count, "token string, clean long, toxic long"
    )
    counts = counts.groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = staged_small(counts, "tokens")
    clean, toxic = counts.agg(F.coalesce(F.sum("clean"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()

    prior = PRIOR_TOKENS * (F.col("clean") + F.col("toxic")) / max(clean + toxic, 1) + LEAST_COUNT
    in_toxic, in_clean = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(in_toxic / (toxic + PRIOR_TOKENS - in_toxic)) - F.log(in_clean / (clean + PRIOR_TOKENS - in_clean))
    sure = odds - DEVIATIONS * F.sqrt(1 / in_toxic + 1 / in_clean)
    scored = counts.where((F.col("token") != "") & (F.col("toxic") > 0)).select("token", "clean", sure.alias("score"))
    best = scored.where(F.col("score") > DRIFT).orderBy(F.desc("score"), "token").collect()
    rate, scale = _law(
        np.array([row["score"] for row in best]), np.array([row["clean"] for row in best], float), float(max(clean, 1))
    )
    first = ToxicityModel([row["token"] for row in best], [row["score"] for row in best], rate, scale, 0.0, 1.0)
    rest = sample.where(~for_scores).select("label", _summary(first)("text")["evidence"].alias("evidence"))
    with small_batches(docs.sparkSession):
        found = rest.groupBy("evidence", "label").count().toPandas()
    bias, slope = _logistic(found["evidence"].to_numpy(float), found["label"].to_numpy(float), found["count"].to_numpy(float))
    return ToxicityModel(first.words, first.scores, rate, scale, bias, slope)


def _law(scores: np.ndarray, clean: np.ndarray, total: float) -> tuple[float, float]:
    """Rate and scale of the extreme-value law: the rate at which a clean token's mean of
    exp(rate * score) is 1, and the share of clean tokens that can open a segment."""
    share = (clean + LEAST_COUNT) / (total + LEAST_COUNT * len(clean))
    rest, values = max(1 - float(share.sum()), 0.0), scores - DRIFT

    def excess(rate: float) -> float:
        return float((share * np.exp(np.clip(rate * values, None, 600))).sum()) + rest * math.exp(-rate * DRIFT) - 1

    low, high = 1e-6, 50.0
    if not len(scores):
        return 1.0, LEAST_COUNT / total
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if excess(middle) > 0 else (middle, high)
    return low, max(float(share.sum()), LEAST_COUNT / total)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Bias and slope by a few damped Newton steps, with a weak pull of the slope to 0."""
    bias, slope = 0.0, 0.0
    pull = np.diag([1e-6, 1e-3])
    if not len(x):
        return -5.0, 1.0
    z = np.stack([np.ones_like(x), np.minimum(x, 50.0)], axis=1)
    theta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        slope_by = z.T @ (weight * (p - y)) + pull @ theta
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + pull + 1e-9 * np.eye(2)
        step = np.linalg.solve(curve, slope_by)
        theta = theta - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
    bias, slope = (float(v) for v in theta)
    return bias, max(slope, 0.0)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Score every whole text. One row per row of ``docs``.

    Columns: id, score (0 to 1), predicted (1 from 0.5 on) and passages: the significant
    segments as first and last word (from 0) and score. Null and empty texts have no passage
    and get the smallest score. Repeated rows are scored each; an empty table gives no rows; a text of any
    length is scored whole; other columns are not looked at.
    """
    summary = _summary(model)(F.col(text_column)).alias("found")
    found = docs.select(F.col(id_column).alias("id"), summary)
    score = 1 / (1 + F.exp(-(F.lit(model.bias) + F.lit(model.slope) * F.least("found.evidence", F.lit(50.0)))))
    return found.select("id", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "found.passages")


def without_toxic(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents whose score is under 0.5, with all their columns and repeated rows.

    Only texts go through Python, and only digests of the toxic ones come back; rows are then left out by
    the digest of their text, where they lie. Null and empty texts count alike, and stay unless
    the model finds all texts toxic. An empty table gives no rows. A text of any length is scored whole.
    """
    model = learn_toxicity(docs, labels, id_column=id_column, text_column=text_column)
    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    scored = texts.select(digest, F.least(_summary(model)("text")["evidence"], F.lit(50.0)).alias("evidence"))
    score = 1 / (1 + F.exp(-(F.lit(model.bias) + F.lit(model.slope) * F.col("evidence"))))
    toxic = staged_small(scored.where(score >= 0.5).select("digest").distinct(), "toxic")
    text = F.coalesce(F.col("row").getField(text_column), F.lit(""))
    rows = rows_of(docs).select("row", F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    return unpacked(unmatched(rows, toxic, ["digest"]), docs.columns)
