"""Words of many texts at once, as flat numpy arrays, and helpers the operators share.

A word is ``[^\\x20\\x09-\\x0D]+``: the separators are single bytes in UTF-8, so all work is on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATORS = " \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SEPARATORS.encode())] = True
# Bytes that start a code point (all but UTF-8 continuation bytes).
STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32

# Texts are worked on in slices of about so many bytes, so that temporaries stay small.
SLICE_BYTES = 2 * 1024**2

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2**64, and of its inverse."""
    if len(_POWERS["up"]) < n:
        size = 1 << int(n).bit_length()
        for name, base in (("up", _P), ("down", _PINV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def window_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair of bounds."""
    n = len(values)
    up, down = powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((values + np.uint64(1)) * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of the texts of one slice.

    data    bytes of all texts, one after the other
    offsets where each text begins in data; one more than there are texts
    start, end  bounds of each word in data
    first   index of the first word of each text; one more than there are texts
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = ~IS_SPACE[data]
        n = len(data)
        bounds = np.zeros(n + 1, dtype=bool)
        bounds[offsets] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | bounds[1:n]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | bounds[1:n]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """For each word the index of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes, A-Z lower-cased on demand."""
        out = np.empty(len(self.start), np.uint64)
        step = 1 << 20
        i = 0
        while i < len(out):
            begin = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, begin + step, side="right")))
            part = self.data[begin : self.end[j - 1]]
            part = LOWER_ASCII[part] if lower else part
            out[i:j] = window_hashes(
                part.astype(np.uint64), self.start[i:j] - begin, self.end[i:j] - begin
            )
            i = j
        return out

    def joined(self, keep: np.ndarray) -> list[bytes]:
        """For each text its words where keep is true, joined by one space."""
        raw = self.data.tobytes()
        start, end = self.start[keep].tolist(), self.end[keep].tolist()
        kept_before = np.concatenate([[0], np.cumsum(keep)])[self.first].tolist()
        return [
            b" ".join([raw[s:e] for s, e in zip(start[a:b], end[a:b])])
            for a, b in zip(kept_before, kept_before[1:])
        ]


def bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def word_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Ranges of texts, each with its words."""
    data, offsets = bytes_and_offsets(texts)
    for i, j in spans(offsets, limit):
        yield i, j, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def chars_per_span(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points in each span of bytes."""
    sums = np.concatenate([[0], np.cumsum(STARTS_CHAR[data])])
    return sums[ends] - sums[starts]


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that an operator reads, under fixed names."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
