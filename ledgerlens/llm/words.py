"""Words of Arrow text columns, found over whole blocks of texts at once (runs inside tasks)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ledgerlens.llm.arrays import text_blocks

# Texts are split in blocks of about this many bytes; a longer text is a block of its own.
SEGMENT_BYTES = 8_000_000


def ascii_lower() -> np.ndarray:
    """For each byte the byte that stands for it once A to Z are lowered."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return lower


def word_bytes() -> np.ndarray:
    """Which bytes belong to words: digits, letters and everything beyond ASCII, whose characters take several bytes each."""
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return inside


@dataclass
class Words:
    """Words of texts ``first`` to ``last``: the distinct ones, the number of each in order, and where each text begins in them."""

    first: int
    last: int
    distinct: pa.Array
    codes: np.ndarray
    at: np.ndarray


def cut_words(raw: np.ndarray, at: np.ndarray, inside: np.ndarray, begins: np.ndarray | None = None, lower: np.ndarray | None = None):
    """(words as a binary array, words before each text): maximal runs of ``inside`` bytes, which end where a text does and also
    before the bytes marked by ``begins``."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(raw)]
    first[edges] = inside[edges]
    if begins is not None:
        first |= begins
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts + 1, out=offsets[1:])
    data = raw[inside]
    data = data if lower is None else lower[data]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.searchsorted(starts, at)


def word_blocks(column: pa.Array, limit: int = SEGMENT_BYTES):
    """Lower-case words (A to Z only) of a text column, block by block. A null text has none."""
    lower, kept = ascii_lower(), word_bytes()
    for first, last, raw, at in text_blocks(column, limit):
        words, begins = cut_words(raw, at, kept[raw], lower=lower)
        coded = words.dictionary_encode()
        yield Words(first, last, coded.dictionary, coded.indices.to_numpy(), begins)
