"""Language by the nearest of several centroids per language.

A text is the vector of its hashed character n-grams, weighted by TF-IDF and scaled to length 1. The
training vectors of each language are clustered by cosine into a few centroids. A text gets the
language of the centroid with the largest cosine, and is marked as rejected if that lies below
what nearly all training texts of that centroid reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comarca.llm.common import is_held_out, staged
from comarca.llm.words import slices

PER_LANGUAGE = 1_000
MOST_SAMPLES = 8_000
CENTROIDS = 4
ROUNDS = 10
BITS = 11
REJECT_SHARE = 0.005
UNKNOWN = "und"
SLICE_BYTES = 1 << 20
# Odd multipliers that mix the characters of an n-gram, and one that spreads the sum.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
SPREAD = np.uint32(0x27D4EB2F)


def _grams(codes: np.ndarray, owners: np.ndarray, rows: int, dims: int) -> np.ndarray:
    """Counts of hashed 1-, 2- and 3-grams of characters within each text."""
    counts = np.zeros(rows * dims, dtype=np.float32)
    mixed = codes * MIX[0]
    shift = np.uint32(32 - BITS)
    base = owners.astype(np.int64) * dims
    for size in (1, 2, 3):
        if size > 1:
            if len(codes) < size:
                break
            mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * MIX[size - 1] + codes[size - 1 :]
        hashed = ((mixed * SPREAD) >> shift).astype(np.int64)
        inside = owners[: len(hashed)] == owners[size - 1 :]
        counts += np.bincount((base[: len(hashed)] + hashed)[inside], minlength=rows * dims)
    return counts.reshape(rows, dims)


def count_vectors(texts: pa.Array) -> Iterator[np.ndarray]:
    """For slices of the texts, in order, the n-gram counts of every text, in lower case."""
    dims = 1 << BITS
    for part in slices(texts, SLICE_BYTES):
        lower = pc.replace_substring_regex(pc.utf8_lower(part), r"[^\p{L}]+", " ")
        for at in range(0, len(lower), 256):
            some = lower.slice(at, 256)
            ends = np.cumsum(np.concatenate([[0], pc.utf8_length(some).to_numpy()])).astype(np.int64)
            joined = "".join(some.to_pylist()).encode("utf-32-le")
            codes = np.frombuffer(joined, dtype=np.uint32)
            owners = np.repeat(np.arange(len(some), dtype=np.int32), np.diff(ends))
            yield _grams(codes, owners, len(some), dims)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    least: np.ndarray  # the cosine under which a centroid's text is rejected
    idf: np.ndarray


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [row.astype("<f4").tobytes() for rows in count_vectors(batch.column(2)) for row in rows]
        columns = [batch.column(0), batch.column(1), pa.array(counts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "hash", "counts"])


def cluster(vectors: np.ndarray, count: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from the vectors farthest from each other; centroids and each one's cluster."""
    count = min(count, len(vectors))
    chosen = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < count:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    own = np.zeros(len(vectors), dtype=int)
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[own == k].sum(axis=0) if (own == k).any() else centroids[k] for k in range(count)])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def fair_share(sizes: list[int], most: int, limit: int) -> int:
    """The largest number up to ``most`` that every group, or all of a smaller one, can give if at
    most ``limit`` are taken in all; at least 1."""
    low, high = 1, max(most, 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(min(size, middle) for size in sizes) <= limit else (low, middle - 1)
    return low


def learn_languages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    per_language: int = PER_LANGUAGE,
    limit: int = MOST_SAMPLES,
) -> LanguageModel:
    """Learn from at most ``per_language`` documents per language that are not held out, at most
    ``limit`` in all. Runs jobs.

    They are those with the smallest hash of their id, from documents with a language and a
    letter, whatever the layout. With many languages each gets fewer, so that every one is learned;
    only of more than ``limit`` languages the rarest are not. Their n-gram counts, 8 KB each, come
    to the driver, which clusters them.
    """
    lang, text, ident = F.col(lang_column), F.col(text_column), F.col(id_column)
    usable = docs.where(lang.isNotNull() & F.rlike(text, F.lit(r"\p{L}")) & ~is_held_out(ident))
    hashed = usable.select(
        lang.alias("lang"), F.pmod(F.xxhash64(ident.alias("id"), F.lit(19)), F.lit(1 << 30)).alias("hash"), text.alias("text")
    )
    sizes = hashed.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("count"), F.min("hash").alias("least"))
    sizes = staged(sizes.orderBy(F.desc("count"), "of").limit(limit), "languages")
    own = fair_share([row["count"] for row in sizes.select("count").collect()], per_language, limit)
    # Some more than that are drawn by their hash, and the one with the smallest for certain.
    share = (own + 4 * own**0.5 + 16) / F.col("count")
    drawn = sizes.select("of", F.greatest("least", F.floor(share * (1 << 30))).alias("up_to"))
    likely = hashed.join(F.broadcast(drawn), F.col("lang") == F.col("of")).where(F.col("hash") <= F.col("up_to"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "text"))
    picked = likely.select("lang", "hash", "text", place.alias("place")).where(F.col("place") <= own)
    # The texts are dealt out again, so that no task counts all those of a language.
    dealt = picked.select("lang", "hash", "text").repartition("hash")
    vectors = dealt.mapInArrow(_vectors, "lang string, hash long, counts binary")
    rows = sorted(vectors.collect())
    dims = 1 << BITS
    names = np.array([row["lang"] for row in rows], dtype=object)
    counts = np.array([np.frombuffer(row["counts"], "<f4") for row in rows], dtype=np.float32).reshape(-1, dims)
    idf = (np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    units = unit_vectors(counts, idf)
    languages, centroids, least = [], [np.empty((0, dims), np.float32)], []
    for name in sorted(set(names)):
        own = units[names == name]
        found, of = cluster(own, CENTROIDS)
        cosines = (own @ found.T)[np.arange(len(own)), of]
        for k in range(len(found)):
            languages.append(name)
            least.append(float(np.quantile(cosines[of == k], REJECT_SHARE)) if (of == k).any() else 0.0)
        centroids.append(found)
    return LanguageModel(languages, np.concatenate(centroids), np.array(least), idf)


def identify_languages(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The language of every whole text. One row per row of ``docs``.

    Columns: id, lang_pred (of the nearest centroid; ``und`` for a null text or one without a letter,
    or if nothing was learned), score (its cosine, 0 to 1; 0 for ``und``) and rejected (the
    cosine is smaller than nearly all that this centroid's training texts had; true for ``und``). Repeated rows are
    judged each; of equally near centroids the first by language wins. A text of any length is counted whole.
    An empty table gives no rows. Other columns are not looked at.
    """

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def nearest(texts: pa.Array) -> pa.Array:
        best, scores, rejected = [], [], []
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        at = 0
        for counts in count_vectors(texts):
            known = lettered[at : at + len(counts)] & (len(model.languages) > 0)
            at += len(counts)
            cosines = unit_vectors(counts, model.idf) @ model.centroids.T
            if cosines.shape[1] == 0:
                cosines = np.zeros((len(counts), 1))
            top = np.argmax(cosines, axis=1)
            value = np.clip(cosines[np.arange(len(counts)), top], 0.0, 1.0)
            best.extend(model.languages[k] if ok else UNKNOWN for k, ok in zip(top, known, strict=True))
            scores.append(np.where(known, value, 0.0))
            floor = model.least[top] if len(model.least) else np.ones(len(counts))
            rejected.append(~known | (value < floor))
        empty = [np.empty(0)]
        return pa.StructArray.from_arrays(
            [
                pa.array(best, pa.string()),
                pa.array(np.concatenate(scores or empty).astype(np.float64)),
                pa.array(np.concatenate(rejected or empty).astype(bool)),
            ],
            ["lang", "score", "rejected"],
        )

    found = docs.select(F.col(id_column).alias("id"), nearest(F.col(text_column)).alias("found"))
    return found.select("id", F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")
