"""Words of many texts at once, hashed with numpy over Arrow buffers.

A word is a maximal run of characters outside ``\\x20 \\x09-\\x0D``. Texts are handled in pieces that
end between words, so memory follows the piece, not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
U = np.uint64
_BASE = 0x9E3779B97F4A7C55 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = max(n, 2 * PIECE)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U)
    return _powers["up"], _powers["down"]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the n + 1 offsets into them; null counts as empty."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        texts.offset : texts.offset + len(texts) + 1
    ].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(batch: pa.RecordBatch, column: str, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` bytes of text, one row at least."""
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _pieces(data: np.ndarray, first: int, last: int, cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about PIECE bytes that begin and end outside words."""
    at = first
    while at < last:
        end = min(at + PIECE, last)
        while end < last:
            near = cuts[np.searchsorted(cuts, end, "right") - 1]
            if near > at:
                end = int(near)
                break
            gaps = np.flatnonzero(_SPACE[data[end : end + PIECE]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + PIECE, last)
        yield at, end
        at = end


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of all texts in order: 64-bit hash, first byte, byte after the last; and the
    n + 1 bounds of the texts in these arrays. ``lower`` maps A-Z to a-z first."""
    fold = _LOWER if lower else _SAME
    found = []
    for a, b in _pieces(data, int(offsets[0]), int(offsets[-1]), offsets):
        raw = data[a:b]
        inside = ~_SPACE[raw]
        edge = np.zeros(b - a + 1, bool)
        cuts = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b, "right")] - a
        edge[cuts] = True
        edge[0] = edge[-1] = True
        before = np.empty(b - a, bool)
        before[0] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(b - a, bool)
        after[-1] = False
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        up, down = _tables(b - a + 1)
        sums = np.zeros(b - a + 1, U)
        np.cumsum((fold[raw].astype(U) + U(1)) * up[: b - a], out=sums[1:])
        value = (sums[ends] - sums[starts]) * down[starts]
        found.append((mix(value + (ends - starts).astype(U)), starts + a, ends + a))
    if found:
        hashes, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True))
    else:
        hashes, starts, ends = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def rolled(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words, in order, also of runs across texts."""
    if len(hashes) < n:
        return np.zeros(0, U)
    factors = seeds(n, seed) | U(1)
    total = np.zeros(len(hashes) - n + 1, U)
    for j in range(n):
        total += hashes[j : len(hashes) - n + 1 + j] * factors[j]
    return mix(total + U(n))


def runs(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the runs of n words that lie in one text, and the bounds of the texts in them."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    own = np.concatenate([[0], np.cumsum(counts)])
    shift = np.repeat(bounds[:-1] - own[:-1], counts)
    return np.arange(own[-1]) + shift, own


def as_long(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as signed ones with the same bits."""
    return x.view(np.int64)


def joined_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All words, each followed by one space, as bytes; and the place of each word in them."""
    sizes = ends - starts + 1
    places = np.concatenate([[0], np.cumsum(sizes)])
    if not len(starts):
        return np.zeros(0, np.uint8), places
    source = np.arange(places[-1]) - np.repeat(places[:-1] - starts, sizes)
    out = data[np.minimum(source, len(data) - 1)]
    out[places[1:] - 1] = 32
    return out, places


def strings(pieces: list[bytes]) -> pa.Array:
    """UTF-8 byte strings as an Arrow string array."""
    return pa.array(pieces, pa.binary()).cast(pa.string())
