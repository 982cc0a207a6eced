"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch lie as one ragged numpy array of symbols. In each round every sequence
applies its pair of lowest rank, all sequences at once, until no pair has a rank; the symbols that
are left are the tokens. The vocabulary is read from a sentencepiece file, whose path is a
parameter; sentencepiece itself does not cut the texts.

Defined results: a null or empty text has 0 bytes and 0 tokens; rows with a null id stay, repeated
rows stay repeated; other columns are not read. A text of any length is counted whole: it is cut at
spaces, which no symbol of the vocabulary crosses, and a run without spaces is one sequence.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadbook.llm.words import ids_and_texts

NONE = np.int32(2**31 - 1)
SPACE = "▁"
# Counts of words already seen are kept by each worker up to so many words; then it starts anew.
MOST_WORDS_KEPT = 800_000
TEXTS_AT_ONCE = 512


class Merges:
    """Symbols and ranked pairs of a byte-fallback BPE vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        }
        if any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in scores):
            raise ValueError("a symbol of this vocabulary crosses a space or a line end")
        self.pre_token = _pre_token(scores)
        self.symbols = {piece: i for i, piece in enumerate(scores)}
        for piece in scores:
            for char in piece:
                self.symbols.setdefault(char, len(self.symbols))
        self.in_vocabulary = np.zeros(len(self.symbols) + 1, dtype=bool)
        self.in_vocabulary[: len(scores)] = True
        rank_of = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = []
        for piece, score in scores.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs.append((left, right, rank_of[score], self.symbols[piece]))
        table = np.array(sorted(pairs), dtype=np.int64)
        self.width = np.int64(len(self.symbols) + 1)
        self.keys = table[:, 0] * self.width + table[:, 1]
        self.ranks = table[:, 2].astype(np.int32)
        self.merged = table[:, 3].astype(np.int32)
        # Characters outside the vocabulary stand for themselves and never merge.
        self.other = np.int32(len(self.symbols))

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NONE where the pair has no rank."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], NONE), np.where(known, self.merged[at], self.other)

    def count(self, sequences: list[str]) -> np.ndarray:
        """Tokens of each sequence, which must not be empty."""
        get, other = self.symbols.get, int(self.other)
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        chars = "".join(sequences)
        symbol = np.fromiter((get(c, other) for c in chars), np.int32, len(chars))
        sequence = np.repeat(np.arange(len(sequences)), lengths)
        lost = ~self.in_vocabulary[symbol]
        counts = np.zeros(len(sequences), np.int64)
        if lost.any():  # single characters outside the vocabulary become their bytes
            width = np.array([len(chars[i].encode()) - 1 for i in np.flatnonzero(lost)])
            bytes_more = np.bincount(sequence[lost], weights=width, minlength=len(sequences))
            # A character that takes part in a merge is not cut into bytes.
            mergeable = lost & (symbol != self.other)
            if mergeable.any():
                raise ValueError("a character of a piece is not a piece itself")
            counts += bytes_more.astype(np.int64)
        rank, merged = self._pairs(symbol, sequence)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            length = np.diff(np.r_[starts, len(symbol)])
            done = lowest == NONE
            if done.any():  # what is left of a finished sequence is its tokens
                counts[sequence[starts[done]]] += length[done]
                stays = np.repeat(~done, length)
                symbol, sequence = symbol[stays], sequence[stays]
                rank, merged = rank[stays], merged[stays]
                lowest, length = lowest[~done], length[~done]
                if not len(symbol):
                    break
            row = np.repeat(np.arange(len(length)), length)
            hits = self._hits(symbol, rank, merged, row, lowest)
            symbol[hits] = merged[hits]
            keep = np.ones(len(symbol), dtype=bool)
            keep[hits + 1] = False
            moved = np.cumsum(keep) - 1
            symbol, sequence, rank, merged = (x[keep] for x in (symbol, sequence, rank, merged))
            at = moved[hits]
            touched = np.unique(np.r_[at, at[at > 0] - 1])
            touched = touched[touched < len(symbol) - 1]
            rank[at], merged[at] = NONE, self.other
            new_rank, new_merged = self.find(symbol[touched], symbol[touched + 1])
            apart = sequence[touched] != sequence[touched + 1]
            rank[touched] = np.where(apart, NONE, new_rank)
            merged[touched] = new_merged
        return counts

    def _pairs(self, symbol, sequence):
        rank = np.full(len(symbol), NONE, np.int32)
        merged = np.full(len(symbol), self.other, np.int32)
        rank[:-1], merged[:-1] = self.find(symbol[:-1], symbol[1:])
        rank[:-1][sequence[1:] != sequence[:-1]] = NONE
        return rank, merged

    def _hits(self, symbol, rank, merged, row, lowest):
        """Where the pairs of lowest rank are that can be applied at once, in each sequence.

        From the left, a pair that overlaps the one before it waits. If a merge makes a pair of no
        higher rank than its own, that pair comes before the other hits, so that in such a
        sequence only the leftmost hit counts.
        """
        hits = np.flatnonzero((rank == lowest[row]) & (rank != NONE))
        run_starts = np.r_[True, (np.diff(hits) > 1) | (np.diff(row[hits]) > 0)]
        place = np.arange(len(hits)) - np.flatnonzero(run_starts)[np.cumsum(run_starts) - 1]
        hits = hits[place % 2 == 0]
        own = row[hits]
        leftmost = np.r_[True, own[1:] != own[:-1]]
        if leftmost.all():
            return hits
        made, low = merged[hits], lowest[own]
        after = np.minimum(hits + 2, len(symbol) - 1)
        right = np.where(row[after] == own, self.find(made, symbol[after])[0], NONE)
        right[hits + 2 >= len(symbol)] = NONE
        before = np.maximum(hits - 1, 0)
        previous = symbol[before].copy()
        adjacent = np.r_[False, (hits[1:] - hits[:-1] == 2) & ~leftmost[1:]]
        previous[adjacent] = made[np.flatnonzero(adjacent) - 1]
        left = np.where((row[before] == own) & (hits > 0), self.find(previous, made)[0], NONE)
        early = np.unique(own[(left <= low) | (right <= low)])
        return hits[leftmost | ~np.isin(own, early)]


def _pre_token(pieces: Iterable[str]) -> re.Pattern:
    """What texts are cut by: no piece crosses the end of a match.

    Spaces go with what follows. Letters are cut from other characters if no piece has both.
    """
    letters = {c for piece in pieces for c in piece if c.isalpha()}
    for piece in pieces:
        own = [c in letters for c in piece.lstrip(SPACE)]
        if any(own) and not all(own):
            return re.compile(f"{SPACE}*[^{SPACE}\\n]+|{SPACE}+")
    known = "".join(sorted(letters))
    return re.compile(f"{SPACE}*[{known}]+|{SPACE}*[^{SPACE}\\n{known}]+|{SPACE}+")


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


class Counter:
    """Counts tokens of texts and remembers words that it has seen."""

    def __init__(self, path: str):
        self.merges = merges(path)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        cut, bounds = [], [0]
        for text in texts:
            if text:
                cut += self.merges.pre_token.findall((SPACE + text).replace(" ", SPACE))
            bounds.append(len(cut))
        numbers = list(map(self.known.get, cut))
        new = list({word for word, number in zip(cut, numbers) if number is None})
        if new:
            if len(self.known) > MOST_WORDS_KEPT:
                self.known.clear()
                new = list(set(cut))
            self.known.update(zip(new, self.merges.count(new).tolist()))
            numbers = list(map(self.known.__getitem__, cut))
        return [
            sum(numbers[begin:end]) + text.count("\n")
            for begin, end, text in zip(bounds, bounds[1:], texts)
        ]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One for each Python worker, which serves many tasks."""
    return Counter(path)


def token_counts(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more tokens than ``limit``) for each row of docs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(model_path)
        for batch in batches:
            sizes, numbers = [], []
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                texts = [t or "" for t in batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()]
                sizes += [len(t.encode()) for t in texts]
                numbers += tokens.count(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(numbers, pa.int64()),
                    pa.array([n > limit for n in numbers], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return ids_and_texts(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
