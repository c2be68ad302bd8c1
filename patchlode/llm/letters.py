"""Texts reduced to lower-case letters and single spaces, as bytes, for models of character runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import U, buffers

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their n + 1 bounds. Each text begins and ends with a space, every run
    of characters that are neither a-z nor beyond ASCII is one space."""
    texts = pc.utf8_lower(texts.fill_null(""))
    blank = pa.scalar(" ", texts.type)
    data, offsets = buffers(pc.binary_join_element_wise(blank, texts, blank, pa.scalar("", texts.type)))
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    mapped = _LETTER[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    space = mapped == 32
    keep = np.ones(len(mapped), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[:-1]] = True
    return mapped[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """The n bytes (up to 8) from each place on as one number, the first byte highest. The last
    n - 1 places, and those near the end of a text, reach beyond it."""
    if len(data) < n:
        return np.zeros(0, U)
    value = np.zeros(len(data) - n + 1, U)
    for j in range(n):
        value = (value << U(8)) | data[j : len(data) - n + 1 + j].astype(U)
    return value
