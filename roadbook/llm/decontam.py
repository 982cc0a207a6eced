"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages: ``BLOCKS`` consecutive blocks of ``STEP`` words, one passage from each
block on. Passages and benchmark items are vectors over hashed words, weighted by their frequency
over all documents: every word has a weight, that of a rare one at most ``RARE`` times (squared) that
of one in all documents. The latent dimensions are those of a block of pieces of items, all of them, and the
strongest of a randomised SVD, computed in parallel over all passages and the items, in the columns
that items have; so no item is lost to truncation. Items are cut into pieces of even lengths,
``PIECE`` words at most: of an item that is covered, some piece is covered as well, and spread by half
its length it lies in one passage. Every passage of every document is compared with every piece: the
cosine of the piece and what the passage has of its words is, for candidates, at least what the least
cover makes if the lightest words of the piece are those that are left. What else is in the passage does not count, nor how many documents have
the item. The piece's rarer words bound that cosine, and most passages are decided by the bound alone.
A candidate is checked on the words themselves: the longest common subsequence of the item and the
words around the passage must cover ``COPIED`` of the item, or ``PARAPHRASED`` of it if the item's
answer (its last sentence, or a given answer) is there in order as well.

The items are a stated query set: they are held by each task in blocks of ``PIECES`` pieces, one pass
over the documents for each block, so that what a task holds is bounded whatever the benchmark's
size. No passage is shuffled. For counting and fitting, texts are split and hashed once, and their words'
columns stored, two bytes for each word.

Bounds: the SVD is fitted on the items and all passages of all documents; everything covers all
documents and whole texts.

Defined results: a null or empty text has no passage and no leak; an item without words finds
nothing; a text shorter than a passage is one passage. Items
shorter than ``FEWEST`` words must be there whole, word by word. A copy with no piece that has its cover
within ``STEP * (BLOCKS - 1) + 1`` words of the text is no candidate. Repeated rows are reported once for
each id and item, with their best cover. Rows with a null id are reported under it. Words are
compared with A-Z lower-cased and without punctuation marks at their ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.shared import stored
from roadbook.llm.words import Words, ids_and_texts, spans, unused_name, word_slices

COLUMNS = 1 << 16
# The square of a word's weight is 1 if all documents have it, RARE if at most this share has it.
COMMON, RARE = 0.01, 2.0
STEP, BLOCKS = 8, 4
PIECES = 1024
# Words of a slice of texts that are read as columns.
SLICE_WORDS = 1 << 18
# Words of a piece of an item: half as many more are still in one passage, wherever it starts.
PIECE = 16
# Dimensions beyond the pieces of a block, and how much more a piece counts than a passage.
SPARE, ITEM_WEIGHT = 16, 30.0
COPIED, PARAPHRASED = 0.8, 0.6
# Of the least share of a piece's weight, how much its commonest words may have and not be looked up.
SKIPPED, ROUNDING = 0.75, 1e-3
FEWEST = 8
# Words that an item may be spread over, relative to its length, on either side of a passage.
SPREAD = 0.5

MARKS = ".,;:!?\"'()[]{}"
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[list(MARKS.encode())] = True


def word_keys(words: Words) -> np.ndarray:
    """Hash of each word, lower-cased, without marks at its ends; a word of marks alone stays."""
    start, end = words.start.copy(), words.end.copy()
    for bound, step, byte in ((end, -1, -1), (start, 1, 0)):
        marked = np.flatnonzero(_IS_MARK[words.data[bound + byte]])
        while len(marked):
            marked = marked[end[marked] - start[marked] > 1]
            bound[marked] += step
            marked = marked[_IS_MARK[words.data[bound[marked] + byte]]]
    bare = Words.__new__(Words)
    bare.data, bare.start, bare.end = words.data, start, end
    return bare.hashes(lower=True)


def columns_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(20)).astype(np.int64) % COLUMNS


class Space(NamedTuple):
    """Latent dimensions: a weight for each column, and weighted axes for the columns of items."""

    weights: np.ndarray
    row_of: np.ndarray  # row in axes, -1 for columns that no item has
    axes: np.ndarray
    squares: np.ndarray  # of the weights of these columns

    def query(self, keys: np.ndarray) -> np.ndarray:
        """The vector whose product with a passage is the share of these words' weight it has."""
        row, times = np.unique(self.row_of[columns_of(keys)], return_counts=True)
        total = float((times * self.squares[row]).sum())
        return (self.axes[row] * times[:, None].astype(np.float32)).sum(axis=0) / total


class Queries(NamedTuple):
    """What passages are compared with, and the words by which they are looked up."""

    owner: np.ndarray  # index of the item
    vectors: np.ndarray
    least: np.ndarray  # share of the weight that a candidate has
    need: np.ndarray  # share that looked-up words have in a candidate
    first: np.ndarray  # for each row of the axes its part of the next two, one more than rows
    asks: np.ndarray
    share: np.ndarray
    table: np.ndarray  # share by row of the axes and query, and a last row of zeros


def least_share(space: Space, keys: np.ndarray, cover: float) -> float:
    """What the lightest words that make up this cover have of the weight of all."""
    squares = np.sort(space.squares[space.row_of[columns_of(keys)]])
    return float(squares[: math.ceil(cover * len(squares) - 1e-9)].sum() / squares.sum())


def queries_of(space: Space, parts: list[tuple[int, np.ndarray]], least: list[float]) -> Queries:
    rows, asks, shares, need = [], [], [], []
    table = np.zeros((len(space.axes) + 1, len(parts)), np.float32)
    for n, (_, keys) in enumerate(parts):
        row, times = np.unique(space.row_of[columns_of(keys)], return_counts=True)
        share = times * space.squares[row]
        share = share / share.sum()
        table[row, n] = share
        rising = np.argsort(space.squares[row], kind="stable")
        skipped = np.cumsum(share[rising]) <= SKIPPED * least[n]
        need.append(least[n] - float(share[rising][skipped].sum()) - ROUNDING)
        looked_up = rising[~skipped]
        rows.append(row[looked_up])
        asks.append(np.full(len(looked_up), n))
        shares.append(share[looked_up])
    rows, asks, shares = np.concatenate(rows), np.concatenate(asks), np.concatenate(shares)
    order = np.argsort(rows, kind="stable")
    return Queries(
        np.array([owner for owner, _ in parts]),
        np.array([space.query(keys) for _, keys in parts], np.float32),
        np.array(least) - ROUNDING,
        np.array(need),
        np.searchsorted(rows[order], np.arange(len(space.axes) + 1)),
        asks[order],
        shares[order],
        table,
    )


def blocks_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each block its text and its first word, and for each text its first block, and one more."""
    blocks = -(-np.diff(first) // STEP)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    text = np.repeat(np.arange(len(blocks)), blocks)
    return text, first[text] + (np.arange(len(text)) - first_block[text]) * STEP, first_block


class Passages:
    """Blocks of words of the texts of a slice, and the passages they make."""

    def __init__(self, words: Words):
        self.words = words
        self.keys = word_keys(words)
        self.block_text, self.block_start, first_block = blocks_of(words.first)
        self.block_number = (self.block_start - words.first[self.block_text]) // STEP
        # The last block of each text, for passages that its end cuts short.
        self.block_last = first_block[1:][self.block_text] - 1

    def likely(self, space: Space, queries: Queries) -> tuple[np.ndarray, ...]:
        """(first block, query, share of the query's weight) of the passages that have enough of it."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        if not len(self.block_start):
            return none
        rows = space.row_of[columns_of(self.keys)]
        ends = np.r_[self.block_start[1:], len(rows)]
        hits = np.flatnonzero(rows >= 0)
        first = queries.first[rows[hits]]
        times = queries.first[rows[hits] + 1] - first
        at = np.repeat(first - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
        block = np.repeat(np.searchsorted(self.block_start, hits, side="right") - 1, times)
        # A word that repeats counts each time, so that these sums bound the share from above.
        n = len(queries.owner)
        pair, of = np.unique(block * n + queries.asks[at], return_inverse=True)
        share = np.bincount(of, queries.share[at], len(pair))
        pairs, shares = [], []
        for k in range(BLOCKS):
            there = self.block_number[pair // n] >= k
            pairs.append(pair[there] - k * n)
            shares.append(share[there])
        pair, of = np.unique(np.concatenate(pairs), return_inverse=True)
        share = np.bincount(of, np.concatenate(shares), len(pair))
        pair = pair[share >= queries.need[pair % n]]
        # From all words, each once.
        kept = [pair[:0]]
        for some in np.array_split(pair, len(pair) // 16384 + 1):
            begin, query = some // n, some % n
            stop = ends[np.minimum(begin + BLOCKS - 1, self.block_last[begin])]
            at = self.block_start[begin][:, None] + np.arange(STEP * BLOCKS)
            row = np.where(at < stop[:, None], rows[np.minimum(at, len(rows) - 1)], -1)
            row = np.sort(row.astype(np.int32), axis=1)
            row[:, 1:][row[:, 1:] == row[:, :-1]] = -1
            share = queries.table[row, query[:, None]].sum(axis=1)
            kept.append(some[share >= queries.least[query]])
        pair = np.concatenate(kept)
        if not len(pair):
            return none
        begin, query = pair // n, pair % n
        chosen, of = np.unique(begin, return_inverse=True)
        likeness = np.empty(len(pair), np.float32)
        last = np.minimum(chosen + BLOCKS - 1, self.block_last[chosen])
        for low in range(0, len(chosen), 4096):
            some = slice(low, low + 4096)
            latent = np.empty((len(chosen[some]), space.axes.shape[1]), np.float32)
            bounds = zip(self.block_start[chosen[some]].tolist(), ends[last[some]].tolist())
            for i, (a, b) in enumerate(bounds):
                row = sorted(set(rows[a:b].tolist()) - {-1})
                latent[i] = space.axes[row].sum(axis=0)
            mine = slice(*np.searchsorted(of, (low, low + len(latent))).tolist())
            likeness[mine] = np.einsum("ij,ij->i", latent[of[mine] - low], queries.vectors[query[mine]])
        enough = likeness >= queries.least[query]
        return begin[enough], query[enough], likeness[enough]


def item_rows(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None):
    answer = F.col(f"`{answer_col}`").cast("string") if answer_col else F.lit(None).cast("string")
    return benchmark.select(
        F.col(f"`{id_col}`").cast("long").alias("item_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        answer.alias("answer"),
    )


def keys_of(text: str | None) -> np.ndarray:
    for _, _, words in word_slices(pa.array([text or ""])):
        return word_keys(words)
    return np.zeros(0, np.uint64)


def answer_of(text: str | None) -> str:
    """The last sentence of a text that has words."""
    parts = [p for p in (text or "").replace("\n", " ").split(". ") if p.strip(MARKS + " ")]
    return parts[-1] if parts else ""


def common_length(masks: dict[int, int], size: int, other: list[int]) -> int:
    """Length of the longest common subsequence, a machine word for many columns at once."""
    full = (1 << size) - 1
    state = full
    for word in other:
        hit = masks.get(word, 0) & state
        if hit:
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


class Item:
    """One benchmark item, ready to be looked for."""

    def __init__(self, item_id, text: str | None, answer: str | None):
        self.item_id = item_id
        self.keys = keys_of(text)
        self.words = self.keys.tolist()
        self.masks = masks_of(self.words)
        answer = keys_of(answer if answer is not None else answer_of(text)).tolist()
        self.answer, self.answer_masks = answer, masks_of(answer)

    def pieces(self) -> list[np.ndarray]:
        return np.array_split(self.keys, -(-len(self.keys) // PIECE))

    def cover(self, around: list[int]) -> float:
        return common_length(self.masks, len(self.words), around) / len(self.words)

    def may_be_in(self, around: np.ndarray) -> bool:
        around = around.tolist()
        return self.present(around) >= PARAPHRASED and self.cover(around) >= PARAPHRASED

    def present(self, around: list[int]) -> float:
        there = set(around)
        return sum(word in there for word in self.words) / len(self.words)

    def is_leak(self, around: list[int], cover: float) -> bool:
        if len(self.words) < FEWEST:
            return cover == 1.0 and _holds(around, self.words)
        if cover >= COPIED:
            return True
        if cover < PARAPHRASED or not self.answer:
            return False
        return common_length(self.answer_masks, len(self.answer), around) == len(self.answer)


def _holds(words: list[int], part: list[int]) -> bool:
    return any(words[i : i + len(part)] == part for i in range(len(words) - len(part) + 1))


class Coded(NamedTuple):
    """Columns of the words of some texts, where each text begins, and one more."""

    columns: np.ndarray
    first: np.ndarray


def coded(docs: DataFrame) -> DataFrame:
    """For each text the columns of its words, two bytes each: what fitting reads, without the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in word_slices(batch.column(1)):
                own = columns_of(word_keys(words)).astype(np.uint16)
                offsets = (2 * words.first).astype(np.int64)
                texts = pa.Array.from_buffers(
                    pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(own)]
                )
                yield pa.RecordBatch.from_arrays([texts.cast(pa.binary())], ["columns"])

    return docs.mapInArrow(run, "columns binary")


def coded_slices(texts: pa.Array) -> Iterator[Coded]:
    """Slices of texts as ``coded`` gives them, of about as many words as slices of text have."""
    _, offsets, data = texts.cast(pa.large_binary()).buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] // 2
    columns = np.zeros(0, np.uint16) if data is None else np.frombuffer(data, np.uint16, offsets[-1])
    for i, j in spans(offsets, SLICE_WORDS):
        own = columns[offsets[i] : offsets[j]].astype(np.int64)
        yield Coded(own, offsets[i : j + 1] - offsets[i])


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each hashed word is, over all of them as ``coded``, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = np.zeros(COLUMNS, np.int64), 0
        for batch in batches:
            for columns, first in coded_slices(batch.column(0)):
                text = np.repeat(np.arange(len(first) - 1), np.diff(first))
                present = np.unique(text * COLUMNS + columns) % COLUMNS
                found += np.bincount(present, minlength=COLUMNS)
                number += len(first) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([found.tobytes()], pa.binary()), pa.array([number], pa.int64())],
            ["found", "texts"],
        )

    total, number = np.zeros(COLUMNS, np.int64), 0
    partial = texts.mapInArrow(run, "found binary, texts long")
    for row in _added(partial, np.int64).collect():  # one row
        total, number = np.frombuffer(row.found, np.int64), row.texts
    return total, number


def _added(partial: DataFrame, kind) -> DataFrame:
    """Sum of the arrays in the first column, and of the second, in rounds of bounded fan-in."""
    name, other = partial.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column(0)[i].as_buffer(), kind)
                total = own.copy() if total is None else total + own
                number += batch.column(1)[i].as_py()
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([total.tobytes()], pa.binary()), pa.array([number], pa.int64())],
                [name, other],
            )

    parts = stored(partial, "partial-sums")
    while parts.count() > 1:
        n = -(-parts.rdd.getNumPartitions() // 32)
        parts = stored(parts.coalesce(n).mapInArrow(run, partial.schema), "partial-sums")
    return parts


def latent_space(docs: DataFrame, parts: list[np.ndarray], weights: np.ndarray) -> Space:
    """``fitted`` on documents as they are."""
    return fitted(stored(coded(docs), "coded-texts"), parts, weights)


def fitted(texts: DataFrame, parts: list[np.ndarray], weights: np.ndarray) -> Space:
    """The pieces' own vectors, then right singular vectors of the matrix of passages and pieces.

    A randomised range finder: the matrix, all passages of all documents by rows over all tasks, is
    applied to a random block and back (A'A times the block), the block is orthonormalised, and this
    is done once more.
    """
    used = np.unique(np.concatenate([columns_of(keys) for keys in parts]))
    row_of = np.full(COLUMNS, -1, np.int64)
    row_of[used] = np.arange(len(used))
    own = np.zeros((len(parts), len(used)), np.float32)
    for i, keys in enumerate(parts):
        np.add.at(own[i], row_of[columns_of(keys)], 1)
    own *= weights[used]
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
    rank = min(SPARE, len(used))
    squares = weights[used].astype(np.float64) ** 2
    block = np.random.default_rng(7).standard_normal((len(used), rank)).astype(np.float32)
    for _ in range(2):
        block, _ = np.linalg.qr(block)
        shared = texts.sparkSession.sparkContext.broadcast(
            Space(weights, row_of, (block * weights[used][:, None]).astype(np.float32), squares)
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            space, total = shared.value, np.zeros((len(used), rank))
            for batch in batches:
                for some in coded_slices(batch.column(0)):
                    total += _back(some, space)
            yield pa.RecordBatch.from_arrays(
                [pa.array([total.tobytes()], pa.binary()), pa.array([1], pa.int64())], ["block", "n"]
            )

        total = ITEM_WEIGHT * (own.T @ (own @ block))
        for row in _added(texts.mapInArrow(run, "block binary, n long"), np.float64).collect():
            total = total + np.frombuffer(row.block).reshape(total.shape)
        block = total.astype(np.float32)
    block, _ = np.linalg.qr(np.c_[own.T, block])
    return Space(weights, row_of, (block * weights[used][:, None]).astype(np.float32), squares)


def _back(texts: Coded, space: Space) -> np.ndarray:
    """A'(A block) for the passages of a slice that do not overlap, each of unit length."""
    out = np.zeros(space.axes.shape, np.float32)
    columns, (_, block_start, _) = texts.columns, blocks_of(texts.first)
    if not len(block_start):
        return out
    length = np.sqrt(np.add.reduceat(space.weights[columns] ** 2, block_start))
    row = space.row_of[columns]
    hits = np.flatnonzero(row >= 0)
    if not len(hits):
        return out
    row = row[hits]
    passage = np.searchsorted(block_start, hits, side="right") - 1
    starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    vectors = np.add.reduceat(space.axes[row], starts, axis=0)
    vectors /= np.maximum(length[passage[starts]], 1e-9)[:, None] ** 2
    # Each column of a passage once, by columns.
    number = np.cumsum(np.r_[False, passage[1:] != passage[:-1]])
    pair = np.unique(row * len(starts) + number)
    column = pair // len(starts)
    first = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
    out[column[first]] = np.add.reduceat(vectors[pair % len(starts)], first, axis=0)
    weights = np.zeros(len(out), np.float32)
    used = space.row_of >= 0
    weights[space.row_of[used]] = space.weights[used]
    return out * weights[:, None]


def leaks_in(words: Words, space: Space, items: list[Item], queries: Queries):
    """(text, item index, first word, words, cosine, cover) of the leaks in a slice."""
    passages = Passages(words)
    found: dict[tuple[int, int], tuple] = {}
    near: dict[tuple[int, int], list[tuple[int, float]]] = {}
    for block, query, share in zip(*(x.tolist() for x in passages.likely(space, queries))):
        near.setdefault((int(passages.block_text[block]), int(queries.owner[query])), []).append(
            (block, math.sqrt(min(share, 1.0)))
        )
    for (text, number), hits in near.items():
        item = items[number]
        low, high = int(words.first[text]), int(words.first[text + 1])
        reach = len(item.words) + int(SPREAD * len(item.words))

        def bounds(block: int) -> tuple[int, int]:
            start = int(passages.block_start[block])
            return max(low, start - reach), min(high, start + STEP * BLOCKS + reach)

        # What all of them together lack, each of them lacks.
        if len(hits) > 1 and not item.may_be_in(
            passages.keys[bounds(min(hits)[0])[0] : bounds(max(hits)[0])[1]]
        ):
            continue
        for block, likeness in sorted(hits, key=lambda hit: (-hit[1], hit[0])):
            begin, end = bounds(block)
            around = passages.keys[begin:end]
            # No cover can exceed the share of the item's words that are there at all.
            around = around.tolist()
            if item.present(around) < PARAPHRASED:
                continue
            cover = item.cover(around)
            if item.is_leak(around, cover):
                found[(text, number)] = (text, number, begin - low, end - begin, likeness, cover)
                break
    return list(found.values())


_LEAKS = "doc_id long, item_id long, first_word long, n_words long, cosine double, cover double"


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    cosine: float | None = None,
) -> DataFrame:
    """One row for each document and item that leaked into it: where, how alike, how covered.

    cosine is the least one of candidates; without it, it follows for each piece from the least cover.
    """
    texts = ids_and_texts(docs, id_col, text_col)
    columns = stored(coded(texts), "coded-texts")
    frequency, total = document_frequencies(columns)
    # No word has weight 0: an item that many documents hold makes its own words frequent.
    rarity = np.log((2 + total) / (1 + frequency)) / math.log(1 / COMMON)
    weights = np.sqrt(1 + (RARE - 1) * np.minimum(rarity, 1)).astype(np.float32)
    rows = item_rows(benchmark, item_col, item_text_col, answer_col)
    rows = rows.orderBy("item_id", "text", "answer").toLocalIterator()
    out, some = None, []
    for row in rows:
        item = Item(row.item_id, row.text, row.answer)
        for keys in item.pieces() if len(item.words) else ():
            some.append((item, keys))
            if len(some) == PIECES:
                out, some = _either(out, _leaks_of(texts, columns, some, weights, cosine)), []
    if some or out is None:
        out = _either(out, _leaks_of(texts, columns, some, weights, cosine))
    best = F.max_by(F.struct("first_word", "n_words", "cosine", "cover"), F.struct("cover", "cosine"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("at")).select("doc_id", "item_id", "at.*")


def _either(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def _leaks_of(
    texts: DataFrame,
    columns: DataFrame,
    pieces: list[tuple[Item, np.ndarray]],
    weights: np.ndarray,
    cosine: float | None,
) -> DataFrame:
    spark = texts.sparkSession
    if not pieces:
        return spark.createDataFrame([], _LEAKS)
    items = list({id(item): item for item, _ in pieces}.values())
    number = {id(item): n for n, item in enumerate(items)}
    parts = [(number[id(item)], keys) for item, keys in pieces]
    space = fitted(columns, [keys for _, keys in parts], weights)
    # What must be there whole is looked for whole.
    covers = [PARAPHRASED if len(item.words) >= FEWEST else 1.0 for item, _ in pieces]
    least = [
        least_share(space, keys, cover) if cosine is None else cosine**2
        for (_, keys), cover in zip(pieces, covers)
    ]
    queries = queries_of(space, parts, least)
    shared = spark.sparkContext.broadcast((space, items, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, items, queries = shared.value
        for batch in batches:
            for i, j, words in word_slices(batch.column(1), 1 << 20):
                ids = batch.column(0).slice(i, j - i).to_pylist()
                rows = [
                    (ids[text], items[n].item_id, begin, length, likeness, cover)
                    for text, n, begin, length, likeness, cover in leaks_in(
                        words, space, items, queries
                    )
                ]
                columns = list(zip(*rows)) or [()] * 6
                kinds = [pa.int64()] * 4 + [pa.float64()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    [c.split()[0] for c in _LEAKS.split(", ")],
                )

    return texts.mapInArrow(run, _LEAKS)


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs in which no item leaked, with all their columns.

    Each row is judged by its own text, whatever other rows of its id hold.
    """
    name, key = unused_name(docs, "leaked_row"), unused_name(docs, "row_key")
    rows = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`"), F.col("text").cast("string")))
    leaked = find_leaks(rows, benchmark, key).select(F.col("doc_id").alias(name)).distinct()
    return rows.join(leaked, F.col(key) == F.col(name), "left_anti").drop(key)
