"""Words of Arrow text columns, as codes into the distinct words of a slice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of at most ``size`` bytes, or one longer text, as large strings.

    They cover every row; null is ''. Memory of earlier slices is given back.
    """
    # Cast before slicing: kernels take a slice's offset into account, but not first offsets above 0.
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield texts.slice(at, stop - at)
        pa.default_memory_pool().release_unused()
        at = stop


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between blanks and 0x09 to 0x0D: their codes in order, where each text's begin
    (one more entry than texts), and the distinct words."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    there = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    coded = words.filter(there).dictionary_encode()
    return coded.indices.to_numpy(), before[offsets - offsets[0]], coded.dictionary
