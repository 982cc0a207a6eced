"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Terms of a text are the shapes of its words (runs of lower-case, upper-case, digits; other bytes as
they are), pairs of neighbouring shapes, and whether a word repeats the one before it: hashed to
``TERMS`` columns and weighted by TF-IDF. A truncated singular value decomposition of the labelled
sample gives ``RANK`` latent dimensions. The sample's vectors go to all tasks; each task computes the
cosines of its documents with all of them, in blocks, and the ``VOTES`` nearest vote with their
labels, weighted by a power of the cosine.

Bounds: at most ``SAMPLE`` labelled rows are fitted on and broadcast (0.5 MB), those of smallest hash
of the id. Document frequencies cover all documents.

Defined results: a text without words, or nothing in common with any neighbour, has the mean label
of the sample as its score; without labels every score is 0.5. Equal cosines vote together. Labels
that are null, or of ids that are not in the table, are not used; an id labelled twice counts with
its mean label. Rows with a null id are scored and are not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.shared import stored
from roadbook.llm.words import Words, mix, powers, unused_name, word_slices

TERMS, RANK, SAMPLE = 512, 32, 4000
VOTES, POWER, BLOCK = 15, 8, 256
FOLDS, HELD_OUT = 3, 1

# Classes of bytes: letters below 128 by case, bytes of other letters as lower case, digits.
_CLASS = np.arange(256, dtype=np.uint64) + np.uint64(8)
_CLASS[128:] = _CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3


def term_counts(words: Words) -> np.ndarray:
    """A row of counts for each text."""
    texts = len(words.offsets) - 1
    if not len(words):
        return np.zeros((texts, TERMS), np.float32)
    kind = _CLASS[words.data]
    opens = np.r_[True, kind[1:] != kind[:-1]]
    opens[words.start] = True
    place = np.cumsum(opens)
    up, down = powers(len(place) + 2)
    sums = np.zeros(len(place) + 1, np.uint64)
    np.cumsum(np.where(opens, kind * up[place], np.uint64(0)), out=sums[1:])
    shape = mix((sums[words.end] - sums[words.start]) * down[place[words.start]])
    text, value = words.text_of(), words.hashes()
    beside = text[1:] == text[:-1]
    repeats = np.r_[False, beside & (value[1:] == value[:-1])]
    pairs = mix(shape[1:] * np.uint64(3) + shape[:-1])[beside]
    terms = np.concatenate([shape, pairs, mix(repeats + np.uint64(99))]) % np.uint64(TERMS)
    rows = np.concatenate([text, text[1:][beside], text])
    counts = np.bincount(rows * TERMS + terms.astype(np.int64), minlength=texts * TERMS)
    return counts.reshape(texts, TERMS).astype(np.float32)


class Model(NamedTuple):
    """What a task needs to score texts."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def embed(self, counts: np.ndarray) -> np.ndarray:
        share = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
        return _unit(_unit(np.sqrt(share) * self.idf) @ self.axes)

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.labels.mean() if len(self.labels) else 0.5)
        if not len(self.labels):
            return out
        votes = min(VOTES, len(self.labels))
        for at in range(0, len(counts), BLOCK):
            cosine = self.embed(counts[at : at + BLOCK]) @ self.vectors.T
            nearest = np.partition(cosine, len(self.labels) - votes, axis=1)[:, -votes]
            row, neighbour = np.nonzero(cosine >= nearest[:, None] - 1e-6)
            weight = np.maximum(cosine[row, neighbour], 0).astype(np.float64) ** POWER
            total = np.bincount(row, weights=weight, minlength=len(cosine))
            ones = np.bincount(
                row, weights=weight * self.labels[neighbour], minlength=len(cosine)
            )
            known = total > 1e-12
            out[at : at + BLOCK][known] = ones[known] / total[known]
        return np.clip(out, 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def held_out(doc_id):
    """The fold that labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the labelled rows that are not held out; labels has doc_id and quality."""
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    known = known.where("doc_id is not null and quality is not null")
    known = known.where(~held_out(F.col("doc_id")))
    known = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    sample = (
        known.groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE)
    )
    # At most SAMPLE rows of two numbers.
    marked = texts.join(F.broadcast(sample), "doc_id", "left").select("text", "quality", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, texts = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            rows = []
            for i, j, words in word_slices(batch.column(0)):
                counts = term_counts(words)
                frequency += (counts > 0).sum(axis=0)
                texts += len(counts)
                label = batch.column(1).slice(i, j - i).to_pylist()
                ids = batch.column(2).slice(i, j - i).to_pylist()
                rows += [
                    (q, counts[k].tobytes(), ids[k]) for k, q in enumerate(label) if q is not None
                ]
            yield _batch([(None, None, *row) for row in rows])
        found = [(int(t), int(frequency[t]), None, None, None) for t in np.flatnonzero(frequency)]
        yield _batch([*found, (-1, texts, None, None, None)])

    schema = "term int, n long, quality double, counts binary, doc_id long"
    gathered = stored(marked.mapInArrow(run, schema), "quality-terms")
    sums = dict(gathered.where("term is not null").groupBy("term").agg(F.sum("n")).collect())
    # One row for each id, the one of least counts, so SAMPLE rows at most however often an id stands.
    rows = gathered.where("counts is not null").groupBy("doc_id").agg(
        F.min(F.struct("counts", "quality")).alias("row")
    )
    rows = rows.select("row.*").orderBy("counts", "quality").collect()
    frequency = np.array([sums.get(t, 0) for t in range(TERMS)], np.float64)
    idf = (np.log((1 + sums.get(-1, 0)) / (1 + frequency)) + 0.3).astype(np.float32)
    if not rows:
        return Model(idf, np.zeros((TERMS, RANK), np.float32), np.zeros((0, RANK), np.float32), np.zeros(0))
    counts = np.array([np.frombuffer(r.counts, np.float32) for r in rows])
    share = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    weighted = _unit(np.sqrt(share) * idf).astype(np.float64)
    # Right singular vectors from the small Gram matrix of the terms.
    _, axes = np.linalg.eigh(weighted.T @ weighted)
    model = Model(idf, axes[:, ::-1][:, :RANK].astype(np.float32), None, None)
    return model._replace(
        vectors=model.embed(counts), labels=np.array([r.quality for r in rows], np.float64)
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        ["term", "n", "quality", "counts", "doc_id"],
    )


def with_score(docs: DataFrame, model: Model, name: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of docs and the score (0 to 1), in one pass that moves no row."""
    name = unused_name(docs, name)
    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    at, out = docs.columns.index(text_col), docs.withColumn(name, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(term_counts(words)) for _, _, words in word_slices(batch.column(at))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(run, out.schema)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if the score is at least 0.5) for each row."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
