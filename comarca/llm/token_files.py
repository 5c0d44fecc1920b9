"""Token ids in ORC files, in ascending order of document ids.

A table is cut into ranges of ids and each range sorted, tokenised and written as one file. ORC
keeps integers as run lengths, deltas and packed bits, with statistics per stripe and per
``INDEX_ROWS`` rows, and Bloom filters on the document ids; so a reader's tasks take stripes
apart from each other, and a search for ids skips files, stripes and row groups. A manifest with one
row per file has what lies before each, and is written last: without it the files are unfinished.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.llm.words import slices, word_codes
from comarca.operators import starts_before

VOCABULARY = "word_bpe_49k.json"
END = 2
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
# Files whose totals are summed in one task.
FILE_BLOCK = 1024
KNOWN_WORDS = 1 << 20
KNOWN_BYTES = 64
TEXT_BYTES = 4 << 20

TOKENS = "doc_id long, part int, offset long, n_tokens long, ids array<int>"
MANIFEST = "part int, rows long, tokens long, first_id long, last_id long, start long"
DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


# How the tokenizer must prepare text for the short way below (fixed values of its file).
PREPARED = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
# Words of these characters are the same in every normal form, and Python lower-cases them alike.
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Tokenizer:
    """A tokenizer file. ``words`` gives the ids of words without white space, one by one.

    If the file prepares text in the known way, simple words go straight to its merges; that
    spares the bookkeeping of places. All other words, and special tokens, go the whole way.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks have the cores
        import public_tokenizers
        import tokenizers

        file = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        self.whole = tokenizers.Tokenizer.from_file(file)
        self.model = self.whole.model
        parts = json.loads(self.whole.to_str())
        first, *rest = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.known_way = (
            [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])] == PREPARED["normalizer"]
            and first.get("pattern", {}).get("Regex") == PREPARED["pattern"]
            and (first.get("behavior"), first.get("invert")) == ("Removed", True)
            and [(r["type"], r["add_prefix_space"], r["use_regex"]) for r in rest] == [("ByteLevel", False, False)]
        )
        level = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in parts["added_tokens"]) or "(?!)")
        self.as_bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}

    def _simple(self, word: str) -> bool:
        return self.known_way and _SIMPLE.fullmatch(word) is not None and not self.special.search(word)

    def words(self, words: list[str]) -> list[list[int]]:
        ids, merge = [], self.model.tokenize
        hard = []
        for word in words:
            if self._simple(word):
                low = word.lower()
                pieces = _PIECE.findall(low)
                if not low.isascii():
                    pieces = [piece.translate(self.as_bytes) for piece in pieces]
                ids.append([t.id for piece in pieces for t in merge(piece)])
            else:
                hard.append(len(ids))
                ids.append([])
        for at in range(0, len(hard), 1024):
            some = hard[at : at + 1024]
            found = self.whole.encode_batch_fast([words[k] for k in some], add_special_tokens=False)
            for k, encoded in zip(some, found, strict=True):
                ids[k] = encoded.ids
        return ids


class WordIds:
    """Ids of words. Those of words up to ``KNOWN_BYTES`` are kept, at most ``KNOWN_WORDS`` of
    them and a text's: when they become too many, the half met latest stays."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer(vocabulary)
        self.words = pa.array([], pa.large_string())
        self.sizes, self.met = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)
        self.turn = 0

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A list of ids, and where in it each of the distinct words' begin and how many there are."""
        self.turn += 1
        self._forget()
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh = self.tokenizer.words(words.take(pa.array(new)).to_pylist())
        self.met[place[place >= 0]] = self.turn
        place[new] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, words.take(pa.array(new))])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, fresh), np.int64, len(fresh))])
        self.met = np.concatenate([self.met, np.full(len(new), self.turn)])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(fresh), np.int32)])
        starts = np.cumsum(self.sizes) - self.sizes
        return self.ids, starts[place], self.sizes[place]

    def _forget(self) -> None:
        short = pc.binary_length(self.words).to_numpy() <= KNOWN_BYTES
        if len(short) > KNOWN_WORDS:
            latest = np.argsort(-self.met, kind="stable")[: KNOWN_WORDS // 2]
            kept = np.zeros(len(short), bool)
            kept[latest] = True
            short &= kept
        if short.all():
            return
        self.ids = self.ids[np.repeat(short, self.sizes)]
        self.words = self.words.filter(pa.array(short))
        self.sizes, self.met = self.sizes[short], self.met[short]


@cache
def word_ids_of(vocabulary: str) -> WordIds:
    """One for all tasks of a worker."""
    return WordIds(vocabulary)


def document_ids(texts: pa.Array, word_ids: WordIds, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some texts, each closed by ``end``, and where each text's begin, with the end.

    The tokenizer drops white space and joins nothing across it, so that a text's ids are its
    words' ids; every distinct word of the texts is encoded once.
    """
    codes, begins, words = word_codes(texts)
    flat, starts, sizes = word_ids(words)
    lengths = sizes[codes]
    places = np.concatenate([[0], np.cumsum(lengths)])
    ids = flat[np.repeat(starts[codes] - places[:-1], lengths) + np.arange(places[-1])]
    ends = places[begins[1:]]
    return np.insert(ids, ends, end), np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])


def _tokenised(vocabulary: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, offset, word_ids = TaskContext.get().partitionId(), 0, word_ids_of(vocabulary)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text"), TEXT_BYTES):
                ids, begins = document_ids(texts, word_ids, end)
                n = len(texts)
                columns = [
                    batch.column("doc_id").slice(at, n),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(offset + begins[:-1]),
                    pa.array(np.diff(begins)),
                    pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids)),
                ]
                at, offset = at + n, offset + int(begins[-1])
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in TOKENS.split(", ")])

    return run


def write_token_files(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
    vocabulary: str = VOCABULARY, end: int = END, stripe_bytes: int = STRIPE_BYTES,
) -> None:
    """Write the ids of all documents below ``path``, ascending by document id over all files.

    A document is its text's ids and ``end``; a null or empty text is ``end`` alone. Null
    document ids come first; rows of one id are ordered by their text's hash and then by their place
    in the table, and may lie in several files, so a frequent id or a null one is no group.
    ``vocabulary`` is a file of ``public_tokenizers`` or an absolute path that all executors
    have, of a tokenizer that drops white space between words. An empty table makes a manifest
    without rows. Texts are shuffled once, by ranges that Spark draws from the keys. A task holds
    about ``TEXT_BYTES`` of text, or one longer text, and a stripe.
    """
    spark = docs.sparkSession
    keys = ["doc_id", "text_hash", "place"]
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
        F.monotonically_increasing_id().alias("place"),
    )
    ranges = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    (
        ranges.mapInArrow(_tokenised(vocabulary, end), TOKENS)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(f"{path}/tokens")
    )
    files = spark.read.schema(TOKENS).orc(f"{path}/tokens").groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("tokens"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
    )
    block = F.floor(F.col("part") / FILE_BLOCK)
    starts_before(files, block, "part", "tokens").write.orc(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, ids: Sequence[int] | None = None) -> DataFrame:
    """Documents from their files, as doc_id, start (ids of all documents before), n_tokens, ids.

    With ``ids`` only those documents: the search is left to the files' statistics and Bloom
    filters. The manifest, of at most as many rows as the write had shuffle partitions, is
    broadcast. Raises if the manifest is missing.
    """
    manifest = spark.read.schema(MANIFEST).orc(f"{path}/manifest")
    tokens = spark.read.schema(TOKENS).orc(f"{path}/tokens")
    if ids is not None:
        tokens = tokens.where(F.col("doc_id").isin(list(ids)))
    starts = F.broadcast(manifest.select("part", "start"))
    return tokens.join(starts, "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids"
    )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        ids = lists.values.to_numpy().astype("<u4")
        ends = lists.offsets.to_numpy()
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        kept = batch.select(["doc_id", "start", "n_tokens"])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sums, pa.int64())], [x.split()[0] for x in DIGESTS.split(", ")])


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit words."""
    return tokens.mapInArrow(_digested, DIGESTS)
