"""Words of whole texts for counting and search, a slice of a batch at a time.

Only A-Z are lower-cased. A word is a longest run of digits, ASCII letters and characters beyond
ASCII, which in UTF-8 is a run of bytes, so it is found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from dossier.llm.common import LOWER

#: Text bytes that are handled at a time. A longer text is a slice of its own.
SLICE_BYTES = 1 << 22
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


class Words(NamedTuple):
    first: int  # place of the slice's first text in the batch
    texts: int
    words: pa.Array  # binary
    text: np.ndarray  # the text (from 0 in the slice) of each word
    data: np.ndarray  # bytes of all words, one after the other
    ends: np.ndarray  # where each word ends in data


def slices(texts: pa.Array | pa.ChunkedArray) -> Iterator[Words]:
    """Words of all texts, null counting as empty, in slices of about ``SLICE_BYTES``."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total, start = np.cumsum(sizes), 0
    while start < len(texts):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + SLICE_BYTES, "right")))
        yield _words(start, texts.slice(start, end - start))
        start = end


def _words(first: int, texts: pa.Array) -> Words:
    raws = [value or b"" for value in texts.cast(pa.large_binary()).to_pylist()]
    raw = LOWER[np.frombuffer(b"\0".join(raws) + b"\0", dtype=np.uint8)]  # a byte that is in no word parts the texts
    inside = _INSIDE[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, stops = edge[::2], edge[1::2]
    data = raw[inside]
    ends = np.cumsum(stops - starts)
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    firsts = np.cumsum([0] + [len(r) + 1 for r in raws])
    return Words(first, len(raws), words, np.searchsorted(firsts, starts, "right") - 1, data, ends)


def places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each word in a list of known words, -1 for others."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)
