"""Hierarchical packing of tokenised documents into sequences of several context sizes.

Every document is routed: whole windows of the longest context stand alone, the rest goes to the
tier of the smallest context that holds it. Tiers are packed from the longest down; a gap in a
window is filled with pieces of the shorter tiers, the largest that fit, and what then
remains by cutting one. All sequences but the last of a partition are full, and those are cut to
powers of two, so no token is padding. Sequences are dealt to step groups of equal token
counts and nearly equal attention cost.

The work of a partition is independent of all others: nothing is shuffled, and a block of documents
is held at a time.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (1024, 512, 256, 128)
BLOCK_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
# Longer texts are tokenised part by part.
PART_CHARS = 1 << 20
SPECIAL = "<|endoftext|>"

PIECES = (
    "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_group long"
)


@cache
def _encoder(vocabulary: str):
    """From a text to its ids, as the ``tokenizers`` file of that name gives them.

    The same vocabulary as ranks gives the same ids several times faster. Texts that hold the
    special token's string go through the file itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    file = public_tokenizers.path(f"{vocabulary}.json")
    lines = Path(public_tokenizers.path(f"{vocabulary}.tiktoken")).read_bytes().splitlines()
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    slow: list = []

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            if not slow:
                slow.append(Tokenizer.from_file(file))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return encode


def split_text(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Cut a long text before blanks that follow a letter or digit: no token spans such a place.
    A text that holds the special token's string stays whole."""
    at = 0
    whole = len(text) > size and SPECIAL in text
    while not whole and len(text) - at > size:
        cut = at + size
        while (cut := text.find(" ", cut)) >= 0 and not text[cut - 1].isalnum():
            cut += 1
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def encode_document(text: str | None, vocabulary: str, end: int = 0) -> np.ndarray:
    """A document's ids and the end id; null counts as empty."""
    encode = _encoder(vocabulary)
    parts = [encode(part) for part in split_text(text or "")]
    return np.concatenate([*parts, np.array([end], dtype="<u4")])


class Packer:
    """Packs lengths into sequences. A piece is (length, document, start)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = sorted(tiers, reverse=True)
        self.waiting: list[tuple[int, int, int]] = []  # by length

    def add(self, document: int, length: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Route a document: yields its whole windows, keeps the rest waiting."""
        longest, start = self.tiers[0], 0
        for start in range(0, length - longest + 1, longest):
            yield longest, [(longest, document, start)]
        rest = length % longest
        if rest:
            insort(self.waiting, (rest, document, length - rest))

    def _take(self, room: int, below: int) -> tuple[int, int, int] | None:
        """The largest waiting piece of at most ``room`` tokens that is shorter than ``below``."""
        at = bisect_left(self.waiting, (min(room + 1, below), -1, -1))
        return self.waiting.pop(at - 1) if at else None

    def _cut(self, room: int) -> tuple[int, int, int] | None:
        """The first ``room`` tokens of the shortest longer piece; the rest goes on waiting."""
        at = bisect_right(self.waiting, (room, 1 << 62, 0))
        if at == len(self.waiting):
            return None
        length, document, start = self.waiting.pop(at)
        insort(self.waiting, (length - room, document, start + room))
        return room, document, start

    def pack(self, final: bool = False) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Full sequences, as (tier, pieces), while there are enough tokens; all if ``final``."""
        total = sum(length for length, _, _ in self.waiting)
        while self.waiting and (final or total >= 2 * self.tiers[0]):
            length = self.waiting[-1][0]
            size = min(tier for tier in self.tiers if tier >= length)
            if size > total:  # too little is left: the largest power of two that it fills
                size = 1 << (total.bit_length() - 1)
            pieces, room = [], size
            while room:
                piece = self._take(room, size + 1) or self._cut(room)
                pieces.append(piece)
                room -= piece[0]
            total -= size
            yield size, pieces


def balanced(costs: list[int], groups: int) -> list[int]:
    """A group for each sequence: costs in falling order are dealt out to and fro."""
    dealt = [0] * len(costs)
    for place, k in enumerate(sorted(range(len(costs)), key=lambda k: (-costs[k], k))):
        turn, at = divmod(place, groups)
        dealt[k] = groups - 1 - at if turn % 2 else at
    return dealt


def _packed(vocabulary: str, tiers: tuple[int, ...], end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        sequences = groups = 0
        packer, ids, names = Packer(tiers), {}, {}

        def flush(done: list) -> pa.RecordBatch:
            nonlocal sequences, groups
            rows: list[list] = [[] for _ in range(9)]
            tokens: list[np.ndarray] = []
            group_of: dict[int, int] = {}
            for tier in dict.fromkeys(size for size, _ in done):
                own = [k for k, (size, _) in enumerate(done) if size == tier]
                count = -(-len(own) * tier // STEP_TOKENS)
                costs = [sum(length**2 for length, _, _ in done[k][1]) for k in own]
                for k, group in zip(own, balanced(costs, count), strict=True):
                    group_of[k] = first + groups + group
                groups += count
            left: dict[int, int] = {}
            for _, document, _ in packer.waiting:
                left[document] = 1
            for k, (size, pieces) in enumerate(done):
                offset = 0
                for length, document, start in pieces:
                    part = ids[document][start : start + length]
                    values = (
                        names[document], start, length, zlib.crc32(part), len(ids[document]),
                        first + sequences + k, offset, size, group_of[k],
                    )
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
                    if with_ids:
                        tokens.append(part)
                    offset += length
            sequences += len(done)
            for document in [d for d in ids if d not in left]:
                del ids[document], names[document]
            types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(rows, types, strict=True)]
            fields = [x.split()[0] for x in PIECES.split(", ")]
            if with_ids:
                ends = np.cumsum([0, *rows[2]], dtype=np.int32)
                flat = np.concatenate(tokens) if tokens else np.empty(0, "<u4")
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
                fields.append("ids")
            return pa.RecordBatch.from_arrays(arrays, fields)

        done, held, number = [], 0, 0
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                ids[number] = encode_document(text.as_py(), vocabulary, end)
                names[number] = name.as_py()
                done.extend(packer.add(number, len(ids[number])))
                held += len(ids[number])
                number += 1
                if held >= BLOCK_TOKENS:
                    done.extend(packer.pack())
                    yield flush(done)
                    done, held = [], 0
        done.extend(packer.pack(final=True))
        if done:
            yield flush(done)

    return run


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = "byte_bpe_50k",
    tiers: tuple[int, ...] = TIERS,
    end: int = 0,
    with_ids: bool = True,
) -> DataFrame:
    """Pack the whole of all documents; one row per piece.

    Columns: id, start (the document's ids before the piece), length, ids_crc32 (of the piece's
    ids as little-endian 32-bit words), doc_tokens, sequence_id, offset (in the sequence,
    gapless from 0), tier (the sequence's length: a context size, or at a partition's end a
    smaller power of two), step_group, and with ``with_ids`` ids.

    A document is its ids and ``end``; so a null or empty text is one token. Each id lies in
    exactly one piece. ``tiers`` are powers of two. Repeated rows and ids are documents each, and a null id
    stays null. An empty table gives no rows. Other columns are not looked at. A block of
    about a million tokens is held at a time, or one longer document.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return picked.mapInArrow(_packed(vocabulary, tiers, end, with_ids), schema)
