"""Texts as independent compressed frames that can be entered at any unit.

A unit is a run of blanks with the word after it, or the blanks at a text's end; so units start
at a text's first byte and at each blank after a byte that is none. A text is stored as zstandard
frames of at most ``FRAME_BYTES`` bytes, each with the number of units, code points and bytes
before it. To find a unit, one frame is decompressed; to read a stretch, the frames that it
touches are, one at a time. Whole frames may be copied from one text to another as they are.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.llm.words import slices

FRAME_BYTES = 1 << 18
LEVEL = 3

FRAMES = "array<struct<first_unit: bigint, first_char: bigint, first_byte: bigint, after_blank: boolean, data: binary>>"
STORED = f"id long, n_units long, n_chars long, n_bytes long, marked boolean, frames {FRAMES}"

# The blanks 0x20 and 0x09 to 0x0D. No byte of a longer UTF-8 sequence is one of them.
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Frame(NamedTuple):
    first_unit: int
    first_char: int
    first_byte: int
    after_blank: bool
    data: bytes


FRAME = pa.struct(
    [("first_unit", pa.int64()), ("first_char", pa.int64()), ("first_byte", pa.int64()),
     ("after_blank", pa.bool_()), ("data", pa.binary())]
)


def frame_lists(lists: Sequence[Sequence[Frame]]) -> pa.ListArray:
    """Frames of several texts as an Arrow column."""
    flat = [frame for frames in lists for frame in frames]
    columns = zip(*flat, strict=True) if flat else [[]] * len(Frame._fields)
    values = [pa.array(list(c), field.type) for c, field in zip(columns, FRAME, strict=True)]
    ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(values, fields=list(FRAME)))


def frames_of(value: pa.ListScalar) -> list[Frame]:
    """One text's frames from an Arrow column."""
    return [Frame(**frame) for frame in value.as_py()]


@cache
def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL)


@cache
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def compress(data: bytes | memoryview) -> bytes:
    return _packer().compress(data)


def decompress(data: bytes) -> bytes:
    return _unpacker().decompress(data)


def unit_starts(data: np.ndarray, first: bool, after_blank: bool) -> np.ndarray:
    """Where units start in a stretch of bytes; ``first`` if it is the beginning of its text."""
    blank = _BLANK[data]
    start = blank & ~np.concatenate([[after_blank], blank[:-1]])
    if first:
        start[:1] = True
    return np.flatnonzero(start)


def code_points(data: np.ndarray) -> int:
    """Bytes that begin a code point."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def make_frames(text: memoryview, size: int = FRAME_BYTES) -> tuple[list[Frame], int, int]:
    """The frames of a text, and its units and code points. Frames end between code points."""
    data, frames = np.frombuffer(text, np.uint8), []
    at = units = chars = 0
    while at < len(data):
        stop = min(at + size, len(data))
        while stop < len(data) and data[stop] & 0xC0 == 0x80 and stop > at + 1:
            stop -= 1
        part, after_blank = data[at:stop], bool(at and _BLANK[data[at - 1]])
        frames.append(Frame(units, chars, at, after_blank, compress(text[at:stop])))
        units += len(unit_starts(part, at == 0, after_blank))
        chars += code_points(part)
        at = stop
    return frames, units, chars


def unit_place(frames: Sequence[Frame], unit: int, end: tuple[int, int, int]) -> tuple[int, int]:
    """The first byte and code point of a unit; ``end`` has a text's units, code points and bytes.

    Only the frame in which the unit starts is decompressed.
    """
    if unit >= end[0]:
        return end[2], end[1]
    frame = frames[bisect_right(frames, unit, key=lambda f: f.first_unit) - 1]
    data = np.frombuffer(decompress(frame.data), np.uint8)
    at = int(unit_starts(data, frame.first_byte == 0, frame.after_blank)[unit - frame.first_unit])
    return frame.first_byte + at, frame.first_char + code_points(data[:at])


def stretch(frames: Sequence[Frame], low: int, high: int, total: int) -> Iterator[tuple[bytes, bool]]:
    """The bytes from ``low`` to ``high`` of a text of ``total`` bytes, frame by frame.

    A whole frame comes as it is stored, with True; a part of one decompressed, with False.
    """
    k = bisect_right(frames, low, key=lambda f: f.first_byte) - 1
    while low < high:
        stop = frames[k + 1].first_byte if k + 1 < len(frames) else total
        if low == frames[k].first_byte and stop <= high:
            yield frames[k].data, True
        else:
            begin = frames[k].first_byte
            yield decompress(frames[k].data)[low - begin : min(high, stop) - begin], False
        low, k = stop, k + 1


def streamed(frames: Sequence[Frame], low: int, high: int, total: int) -> Iterator[bytes]:
    """The same, all decompressed; one frame is held at a time."""
    for data, stored in stretch(frames, low, high, total):
        yield decompress(data) if stored else data


def joined(pieces: Iterator[tuple[bytes, bool]], size: int = FRAME_BYTES) -> Iterator[tuple[bytes, int]]:
    """Compressed frames, and their bytes, of pieces laid end to end: stored frames as they are,
    loose bytes gathered to frames of at least ``size`` bytes where they adjoin."""
    loose, held = [], 0
    for data, stored in pieces:
        if not stored:
            loose.append(data)
            held += len(data)
        if held and (stored or held >= size):
            yield compress(b"".join(loose)), held
            loose, held = [], 0
        if stored:
            yield data, zstandard.get_frame_parameters(data).content_size
    if held:
        yield compress(b"".join(loose)), held


def sha256(chunks: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for chunk in chunks:
        digest.update(chunk)
    return digest.hexdigest()


def _framed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                rows = [make_frames(memoryview(v.as_buffer()), size) for v in texts.cast(pa.large_binary())]
                own = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": own.column("id"),
                        "n_units": pa.array([units for _, units, _ in rows], pa.int64()),
                        "n_chars": pa.array([chars for _, _, chars in rows], pa.int64()),
                        "n_bytes": own.column("n_bytes"),
                        "marked": own.column("marked"),
                        "frames": frame_lists([frames for frames, _, _ in rows]),
                    }
                )

    return run


def frame_texts(
    docs: DataFrame, marks: Sequence[str] = (), id_column: str = "doc_id", text_column: str = "text",
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Whole texts as frames: id, n_units, n_chars (code points), n_bytes, marked, frames.

    ``marked`` tells whether a text holds one of ``marks``. A null text counts as empty and has
    no frames; ids may be null or repeat, rows stay as they are. An empty table gives no rows. Only
    the two named columns are read. A text is cut in one task, which holds it once, compressed
    frame by frame. Nothing is shuffled.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    marked = F.lit(False)
    for mark in marks:
        marked = marked | text.contains(mark)
    picked = docs.select(
        F.col(id_column).cast("long").alias("id"), text.alias("text"),
        F.octet_length(text).cast("long").alias("n_bytes"), marked.alias("marked"),
    )
    return picked.mapInArrow(_framed(frame_bytes), STORED)


def store_frames(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write ``frame_texts`` below ``path`` and read it back. The frames are compressed already."""
    frame_texts(docs, **options).write.option("compression", "none").parquet(path)
    return read_frames(docs.sparkSession, path)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)
