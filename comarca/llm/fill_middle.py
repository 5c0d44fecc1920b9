"""Fill-in-the-middle rearrangement of texts stored as compressed frames.

Two hashed cuts between units part a text into prefix, middle and suffix, which are put out in
another order behind markers. Only the frames in which a cut lies are decompressed and compressed
anew; all others move as they are. Digests, and the way back, stream the frames in order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.frames import Frame, frames_of, joined, sha256, streamed, stretch, unit_place

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
SEED = 42
FILL_PERCENT = 50
SPM_PERCENT = 80

OUTPUT = "array<struct<first_byte: bigint, data: binary>>"
FILLED = f"id long, n long, form string, prefix_chars long, middle_chars long, out_bytes long, output {OUTPUT}"
DIGESTS = "id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
TEXTS = "id long, form string, output string"

_OUT = pa.struct([("first_byte", pa.int64()), ("data", pa.binary())])


def _draws(seed: int) -> list[Column]:
    """The first four 8-digit groups of the SHA-256 of ``seed:id``; a null id counts as ''."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _form(fill_percent: int, spm_percent: int, marked: Column, empty: Column, draws: Sequence[Column]) -> Column:
    plain = empty | marked | (draws[2] % 100 >= fill_percent)
    return F.when(plain, "plain").when(draws[3] % 100 < spm_percent, "spm").otherwise("psm")


def _rearranged(row: dict, frames: list[Frame]) -> tuple[list[tuple[bytes, int]], int | None, int | None]:
    """The frames put out, with their bytes, and the code points of prefix and middle."""
    total = row["n_bytes"]
    if row["form"] == "plain":
        ends = [frame.first_byte for frame in frames[1:]] + [total]
        return [(f.data, end - f.first_byte) for f, end in zip(frames, ends[: len(frames)], strict=True)], None, None
    end = (row["n"], row["n_chars"], total)
    (low, low_char), (high, high_char) = (unit_place(frames, row[cut], end) for cut in ("low", "high"))

    def pieces() -> Iterator[tuple[bytes, bool]]:
        parts = {PREFIX: (0, low), SUFFIX: (high, total), MIDDLE: (low, high)}
        order = (SUFFIX, PREFIX, MIDDLE) if row["form"] == "spm" else (PREFIX, SUFFIX, MIDDLE)
        for mark in order:
            yield mark.encode(), False
            yield from stretch(frames, *parts[mark], total)

    return list(joined(pieces())), low_char, high_char - low_char


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, outputs = batch.drop_columns(["frames"]).to_pylist(), []
        for row, value in zip(rows, batch.column("frames"), strict=True):
            found, row["prefix_chars"], row["middle_chars"] = _rearranged(row, frames_of(value))
            at, output = 0, []
            for data, size in found:
                output.append({"first_byte": at, "data": data})
                at += size
            row["out_bytes"] = at
            outputs.append(output)
        kinds = {"id": pa.int64(), "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(),
                 "middle_chars": pa.int64(), "out_bytes": pa.int64()}
        columns = {name: pa.array([row[name] for row in rows], kind) for name, kind in kinds.items()}
        yield pa.RecordBatch.from_pydict({**columns, "output": pa.array(outputs, pa.list_(_OUT))})


def fill_in_middle(
    stored: DataFrame, seed: int = SEED, fill_percent: int = FILL_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """Rearrange texts stored by ``frame_texts`` with ``marks=MARKS``; one row per row.

    Columns: id, n (units), form, prefix_chars and middle_chars (code points; null if plain),
    out_bytes, output (zstandard frames with the bytes before each; end to end they are one
    valid stream). Cuts and form come from the SHA-256 of ``seed:id``; so equal ids are cut alike
    and null ids as ''. Form is plain, the text as it is, for empty texts, for texts that hold a
    marker, and for all but ``fill_percent`` of the others; else spm in ``spm_percent`` and psm. A
    text without units is empty, hence plain. An empty table gives no rows. A task holds
    one text's compressed frames and one or two open ones. Nothing is shuffled.
    """
    draws, units = _draws(seed), F.col("n_units") + 1
    cuts = [draws[0] % units, draws[1] % units]
    picked = stored.select(
        "id", F.col("n_units").alias("n"), "n_chars", "n_bytes", F.least(*cuts).alias("low"), F.greatest(*cuts).alias("high"),
        _form(fill_percent, spm_percent, F.col("marked"), F.col("n_bytes") == 0, draws).alias("form"), "frames",
    )
    return picked.mapInArrow(_fill, FILLED)


def mark_places(frames: Sequence[Frame], total: int) -> dict[str, int]:
    """Where each marker begins in a rearranged text, read frame by frame.

    The parts hold no marker and none can arise where they meet one, so the first is the one.
    """
    found: dict[str, int] = {}
    at, before = 0, b""
    for data in streamed(frames, 0, total, total):
        window = before + data
        for mark in MARKS:
            place = window.find(mark.encode())
            if place >= 0 and mark not in found:
                found[mark] = at - len(before) + place
        at += len(data)
        before = window[-2:]
    return found


def restored(frames: Sequence[Frame], form: str, total: int) -> Iterator[bytes]:
    """The text that a rearranged one was made of, from its frames and its form."""
    if form == "plain":
        yield from streamed(frames, 0, total, total)
        return
    places = mark_places(frames, total)
    ends = sorted([*places.values(), total])
    for mark in (PREFIX, MIDDLE, SUFFIX):
        begin = places[mark]
        yield from streamed(frames, begin + len(mark), ends[ends.index(begin) + 1], total)


def _outputs(batch: pa.RecordBatch) -> Iterator[list[Frame]]:
    for value in batch.column("output"):
        yield [Frame(0, 0, frame["first_byte"], False, frame["data"]) for frame in value.as_py()]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        output, back = [], []
        sizes, forms = batch.column("out_bytes").to_pylist(), batch.column("form").to_pylist()
        for frames, total, form in zip(_outputs(batch), sizes, forms, strict=True):
            output.append(sha256(streamed(frames, 0, total, total)))
            back.append(sha256(restored(frames, form, total)))
        kept = batch.select(["id", "n", "form", "prefix_chars", "middle_chars"])
        names = [*kept.schema.names, "output_sha256", "restored_sha256"]
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(output, pa.string()), pa.array(back, pa.string())], names)


def digests(filled: DataFrame) -> DataFrame:
    """SHA-256 of each output and of the text rebuilt from it, both streamed frame by frame."""
    return filled.mapInArrow(_digest, DIGESTS)


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("out_bytes").to_pylist()
        for k, (frames, total) in enumerate(zip(_outputs(batch), sizes, strict=True)):
            text = pa.array([b"".join(streamed(frames, 0, total, total))], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).select(["id", "form"]).columns, text], ["id", "form", "output"])


def filled_texts(filled: DataFrame) -> DataFrame:
    """The rearranged texts themselves: id, form, output."""
    return filled.select("id", "form", "out_bytes", "output").mapInArrow(_text, TEXTS)
