"""Words of a text as 64-bit numbers, computed on whole byte arrays with numpy.

A word is a maximal run of bytes that are not 0x20 or 0x09-0x0D; A-Z count as a-z.
All sums and products are modulo 2**64, so a hash depends on the word alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 18
SEPARATORS = b" \t\n\v\f\r"
NEWLINE = 10

_random = np.random.default_rng(20240607)


def _odd(size: int) -> np.ndarray:
    return _random.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    every = _odd(256)
    values = every.copy()
    values[65:91] = values[97:123]
    values[list(SEPARATORS)] = 0
    return values, every


def _powers(base: int) -> np.ndarray:
    out = np.full(WINDOW, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15
BYTE, PIECE_BYTE = _byte_values()
IS_SEPARATOR = np.isin(np.arange(256), list(SEPARATORS))
POWER = _powers(BASE)
INVERSE = _powers(pow(BASE, -1, 2**64))
SHINGLE = _odd(16)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where the words of ``data`` start and end."""
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = (data == 32) | (data - np.uint8(9) < 5)  # what is below 9 becomes large
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[0::2], edges[1::2]


def _hash_window(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    values = BYTE.take(data)
    values *= POWER[: len(data)]
    upto = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values, out=upto[1:])
    sums = upto[ends] - upto[starts]
    return mix(sums * INVERSE[starts] ^ (ends - starts).astype(np.uint64))


def _hash_long(word: np.ndarray) -> int:
    total, factor, mask = 0, 1, 2**64 - 1
    for at in range(0, len(word), WINDOW):
        part = word[at : at + WINDOW]
        value = int(np.add.reduce(BYTE[part] * POWER[: len(part)], dtype=np.uint64))
        total = (total + value * factor) & mask
        factor = (factor * int(POWER[-1]) * BASE) & mask
    return total


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, a window of the text at a time."""
    starts, ends = word_spans(data)
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        origin = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, origin + WINDOW, "right")))
        if ends[upto - 1] - origin > WINDOW:  # one word longer than a window
            value = np.array([_hash_long(data[origin : ends[at]])], dtype=np.uint64)
            out[at : at + 1] = mix(value ^ np.uint64(ends[at] - origin))
        else:
            part = data[origin : ends[upto - 1]]
            out[at:upto] = _hash_window(part, starts[at:upto] - origin, ends[at:upto] - origin)
        at = upto
    return out, starts, ends


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence, if it has fewer words."""
    if len(words) == 0:
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = words[:n] * SHINGLE[0]
    for i in range(1, width):
        total = total + words[i : i + n] * SHINGLE[i]
    return mix(total + np.uint64(width))


def shingle_set(text: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text."""
    return np.unique(shingles(word_hashes(text)[0], width))


def shingle_sets(texts: list[np.ndarray | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of some texts one after the other, and of each shingle its text's number."""
    space = np.array([SEPARATORS[0]], dtype=np.uint8)
    held = [part for text in texts for part in (text if text is not None else space[:0], space)]
    words, starts, _ = word_hashes(np.concatenate(held))
    upto = np.searchsorted(starts, np.cumsum([len(part) for part in held])[1::2])
    count = np.diff(upto, prepend=0)
    many = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(len(texts)), many)
    before = np.cumsum(many) - many
    at = np.arange(len(owner)) + np.repeat(upto - count - before, many)
    padded = np.append(words, np.zeros(width - 1, dtype=np.uint64))
    found = shingles(padded, width)[at] if len(words) else words
    for i in np.flatnonzero((count > 0) & (count < width)):
        found[before[i]] = shingles(words[upto[i] - count[i] : upto[i]], width)[0]
    order = np.argsort(found)
    order = order[np.argsort(owner[order], kind="stable")]
    found = found[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], owner[new]


def utf8(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The bytes of every text of an Arrow column without copying them; None for null."""
    if len(column) == 0:
        return
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offset_buffer, data_buffer = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offset_buffer, dtype=kind)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer or b"", dtype=np.uint8)
    for i in range(len(column)):
        yield data[offsets[i] : offsets[i + 1]] if valid[i] else None


def same_share(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
