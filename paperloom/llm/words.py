"""Words of many texts at once, as codes of their distinct values."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SAME = bytes(range(256))
_UP, _LOW = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
LOWERED = bytes.maketrans(_UP, _LOW)
# A-Z lower-cased; every other ASCII character that is no letter or digit becomes a blank.
ALPHANUMERIC = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in _SAME).translate(LOWERED)


class Words(NamedTuple):
    distinct: pa.Array   # large_string
    codes: np.ndarray    # of every word, in order
    bounds: np.ndarray   # of each text's words in codes; one more than texts

    def text_of(self) -> np.ndarray:
        """The text number of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def buffer_of(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and their bounds. Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if texts.offset:
        texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = data.to_pybytes()[offsets[0]:offsets[-1]] if data is not None else b""
    return data, offsets - offsets[0]


def texts_of(data: bytes, bounds: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data))


def words(texts: pa.Array, table: bytes | None = None) -> Words:
    """Words between ASCII white space, after a byte translation that keeps texts valid."""
    data, bounds = buffer_of(texts)
    if table is not None:
        data = data.translate(table)
    lists = pc.ascii_split_whitespace(texts_of(data, bounds))
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    full = pc.binary_length(flat).to_numpy() > 0
    if not full.all():
        flat = flat.filter(pa.array(full))
        starts = np.concatenate([[0], np.cumsum(full)])[starts]
    coded = flat.dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy().astype(np.int64), starts)


def codes_of(values: np.ndarray) -> np.ndarray:
    """Dense codes of equal values, by hashing."""
    return pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between bounds."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[bounds])
