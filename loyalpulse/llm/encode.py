"""Token ids of whole texts with a tokenizer file of the tokenizers library.

Text is cut into pieces where a blank or line end follows another character and where a
full stop or comma follows a letter.  No token of a byte-level vocabulary spans such a
place, so a text's ids are its pieces' ids in a row.  Pieces, mostly a blank and a word,
repeat so often that few need encoding: the ids of those met lately are found by a 64-bit
hash in a table of fixed size.  A text with other white space is one piece.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

from loyalpulse.llm.words import INVERSE, PIECE_BYTE, POWER, WINDOW, mix  # noqa: E402

_OTHER_SPACE = re.compile(r"[^\S \n]")
_BYTES = np.arange(256)
_BLANK = np.isin(_BYTES, [10, 32])
_STOP = np.isin(_BYTES, [44, 46])
_LETTER = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
#: Bytes that another white space character holds (and other characters may).
_MAY_BE_SPACE = np.isin(_BYTES, [9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3])
SLOTS = 1 << 21
#: Ids remembered per worker process; beyond it the table starts anew.
KEPT_IDS = 6_000_000


class Encoder:
    """Token ids of texts given as UTF-8 bytes."""

    def __init__(self, path: str) -> None:
        self._tokenizer = Tokenizer.from_file(path)
        self._ids = np.empty(1 << 16, dtype=np.uint32)
        self._keys = np.zeros(SLOTS, dtype=np.uint64)
        self._start = np.zeros(SLOTS, dtype=np.uint32)
        self._length = np.zeros(SLOTS, dtype=np.uint32)
        self._used = 0

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes pieces and appends their ids; where each starts and how long it is."""
        found = self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        ids = [e.ids for e in found]
        length = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((i for piece in ids for i in piece), np.uint32, int(length.sum()))
        end = self._used + len(flat)
        if end > len(self._ids):
            grown = np.empty(max(end, 2 * len(self._ids)), dtype=np.uint32)
            grown[: self._used] = self._ids[: self._used]
            self._ids = grown
        self._ids[self._used : end] = flat
        start = self._used + np.cumsum(length) - length
        self._used = end
        return start, length

    def _pieces(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and the number of ids of each."""
        ends = np.append(cuts[1:], len(data))
        if len(data) > WINDOW:  # one piece longer than a window
            start, length = self._encode([data.tobytes().decode("utf-8", "replace")])
            return self._ids[start[0] : start[0] + length[0]].copy(), length
        sums = np.add.reduceat(PIECE_BYTE[data] * POWER[: len(data)], cuts)
        keys = mix(sums * INVERSE[cuts] ^ (ends - cuts).astype(np.uint64))
        slots = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        start, length = self._start[slots].astype(np.int64), self._length[slots].astype(np.int64)
        missing = np.flatnonzero(self._keys[slots] != keys)
        if len(missing):
            _, one, which = np.unique(keys[missing], return_index=True, return_inverse=True)
            text = data.tobytes()
            spans = zip(cuts[missing[one]].tolist(), ends[missing[one]].tolist(), strict=True)
            found = self._encode([text[a:b].decode("utf-8", "replace") for a, b in spans])
            start[missing], length[missing] = found[0][which], found[1][which]
            self._keys[slots[missing]] = keys[missing]
            self._start[slots[missing]] = start[missing]
            self._length[slots[missing]] = length[missing]
        before = np.cumsum(length) - length
        places = np.repeat(start - before, length)
        places += np.arange(len(places))
        return self._ids[places], length

    def many(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of the texts that lie in a row in ``data``, one array per text."""
        offsets = offsets - offsets[0]
        cut = np.zeros(len(data) + 1, dtype=bool)
        blank = _BLANK[data]
        cut[1:-1] = blank[1:] & ~blank[:-1]
        cut[1:-1] |= _STOP[data[1:]] & _LETTER[data[:-1]]
        if _MAY_BE_SPACE[data].any():
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                part = data[a:b]
                if _MAY_BE_SPACE[part].any() and _OTHER_SPACE.search(
                    part.tobytes().decode("utf-8", "replace")
                ):
                    cut[a:b] = False
        cut[offsets] = True
        cuts = np.flatnonzero(cut[: len(data)])
        parts, counts, at = [], [np.zeros(1, dtype=np.int64)], 0
        while at < len(cuts):
            if self._used > KEPT_IDS:
                self._keys[:] = 0
                self._used = 0
            upto = max(at + 1, int(np.searchsorted(cuts, cuts[at] + WINDOW, "right")) - 1)
            if upto == len(cuts) - 1 and len(data) - cuts[at] <= WINDOW:
                upto = len(cuts)
            end = cuts[upto] if upto < len(cuts) else len(data)
            ids, length = self._pieces(data[cuts[at] : end], cuts[at:upto] - cuts[at])
            parts.append(ids)
            counts.append(length)
            at = upto
        ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        total = np.cumsum(np.concatenate(counts))
        bounds = total[np.searchsorted(cuts, offsets)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield ids[a:b]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def encoded(column: pa.Array, path: str, run: int = 1 << 22) -> Iterator[np.ndarray]:
    """Token ids of every text of an Arrow column; a null counts as an empty text."""
    if len(column) == 0:
        return
    if column.null_count:
        column = pc.fill_null(column, "")
    encode = encoder(path)
    _, offset_buffer, data_buffer = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offset_buffer, dtype=kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data_buffer or b"", dtype=np.uint8)
    at = 0
    while at < len(column):  # about 4 MB of text at a time
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + run, "right")) - 1)
        yield from encode.many(data[offsets[at] : offsets[upto]], offsets[at : upto + 1])
        at = upto
