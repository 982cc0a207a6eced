"""Cost-balanced packing of documents into training sequences.

Tokenise once, cut documents into pieces of at most one sequence, deal the pieces to partitions by a
hash, and pack each partition in groups of bounded size: pieces in descending length go to the
sequence of lowest cost that has room for them. The cost of a sequence is linear in its tokens plus
quadratic in each of its pieces, as attention within documents costs. A piece that fits nowhere
whole is cut to fill the sequence of lowest cost that has any room, so sequences end up full. What
a group has beyond full sequences goes to sequences whose lengths are powers of two, which need no
padding.

Defined results: a null or empty text has the end token alone; rows with a null id are packed like
the others; repeated rows are packed again each; an empty table gives no piece. A group holds about
``group_tokens`` tokens, and a very long document is spread over many groups.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from roadbook.llm.words import ids_and_texts

# What each worker remembers; beyond it, it starts anew.
MOST_PARTS_KEPT, MOST_OFTEN = 900_000, 30_000
TEXTS_AT_ONCE = 512
# Relative cost of a token, and of a pair of tokens within a piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_CUT = "doc_id long, start long, doc_tokens long, ids binary, hash long"

# How byte-level vocabularies write the bytes that are not printable: the n-th one as 256 + n.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(256, 512)))

# The vocabulary's own cut of a text into parts, for lower-case texts of Latin-1 characters. Such
# texts are in normal form, and none of them can be a special token unless it has its brackets.
_LETTERS, _NUMBERS, _SPACES = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_PART = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
)
_NOT_PLAIN = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
_CUT_BY = {
    "type": "Split",
    "pattern": {
        "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    },
    "behavior": "Removed",
    "invert": True,
}


class WordIds:
    """Token ids of texts, packed as little-endian unsigned 32-bit numbers.

    Texts are cut into the parts that the vocabulary's merges stay within, each part is encoded by
    the tokenizer's model once, and its ids are kept. Texts with other than Latin-1 characters, and
    vocabularies that cut in another way, are left to the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        # The first parts to come a second time: few enough to stay near the processor.
        self.often: dict[str, bytes] = {}
        self.seen: set[str] = set()
        steps = json.loads(self.tokenizer.to_str())
        cutting = (steps["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        lower = (steps["normalizer"] or {}).get("normalizers", [{}])[-1].get("type") == "Lowercase"
        self.known_cut = cutting[0] == _CUT_BY and lower

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._plain(t) if self._is_plain(t) else self._whole(t) for t in texts]

    def _is_plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return self.known_cut and not any(x in text for x in _NOT_PLAIN)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain(self, text: str) -> bytes:
        parts = _PART.findall(text.lower())
        codes = list(map(self.often.get, parts))
        known, more = self.parts.get, MOST_OFTEN - len(self.often)
        for i, code in enumerate(codes):
            if code is None:
                part = parts[i]
                code = codes[i] = known(part) or self._learn(part)
                if more > 0:
                    self._again(part, code)
        return b"".join(codes)

    def _again(self, part: str, code: bytes) -> None:
        if part in self.seen:
            self.often[part] = code
        self.seen.add(part)

    def _learn(self, part: str) -> bytes:
        if len(self.parts) > MOST_PARTS_KEPT:
            self.parts.clear()
        written = part
        if not part.isascii() or not part.isprintable():
            written = part.encode().decode("latin-1").translate(_WRITTEN)
        code = array("I", [token.id for token in self.model.tokenize(written)]).tobytes()
        self.parts[part] = code
        return code


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One for each Python worker, which serves many tasks."""
    return WordIds(path)


def pack_group(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset there) for pieces given by their lengths."""
    total = sum(lengths)
    full, rest = divmod(total, size)
    tail = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    room = np.array([size] * full + tail, dtype=np.int64)
    capacity = room.copy()
    cost = np.zeros(len(room))
    out = []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, left = 0, lengths[piece]
        while left:
            fits = np.flatnonzero(room >= left)
            if not len(fits):
                fits = np.flatnonzero(room > 0)
            chosen = int(fits[np.argmin(cost[fits])])
            part = min(left, int(room[chosen]))
            out.append((piece, start, part, chosen, int(capacity[chosen] - room[chosen])))
            room[chosen] -= part
            cost[chosen] += LINEAR * part + QUADRATIC * part * part
            start, left = start + part, left - part
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    size: int = 4096,
    group_tokens: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit numbers.

    A sequence is ``sequence_id``; its pieces lie there from ``offset`` on, gapless from 0.
    """
    if size & (size - 1):
        raise ValueError("the size of a sequence must be a power of two")
    texts = ids_and_texts(docs, id_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(tokenizer_path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                ids = batch.column(0).slice(at, TEXTS_AT_ONCE).to_pylist()
                texts = [t or "" for t in batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()]
                rows = []
                for doc_id, code in zip(ids, encoder.encode(texts)):
                    code += end
                    crc = zlib.crc32(code)
                    tokens = len(code) // 4
                    for start in range(0, tokens, size):
                        key = zlib.crc32(f"{doc_id} {start}".encode(), crc)
                        part = code[4 * start : 4 * (start + size)]
                        rows.append((doc_id, start, tokens, part, key))
                yield _batch(rows, _CUT)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for rows in _groups(batches, group_tokens):
            lengths = [len(r[3]) // 4 for r in rows]
            placed = [
                (
                    rows[piece][0],
                    rows[piece][1] + start,
                    length,
                    rows[piece][2],
                    first + sequence,
                    offset,
                    rows[piece][3][4 * start : 4 * (start + length)],
                )
                for piece, start, length, sequence, offset in pack_group(lengths, size)
            ]
            first += 1 + max(p[4] for p in placed) - first
            for at in range(0, len(placed), 2000):
                yield _batch(placed[at : at + 2000], PIECES)

    return (
        texts.mapInArrow(cut, _CUT)
        .repartition("hash")
        .sortWithinPartitions("hash", "doc_id", "start")
        .select("doc_id", "start", "doc_tokens", "ids")
        .mapInArrow(assign, PIECES)
    )


def _groups(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[list[tuple]]:
    """Rows of about so many tokens together."""
    rows, held = [], 0
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            rows.append(row)
            held += len(row[3]) // 4
            if held >= tokens:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields]
    )
