"""Host-level quality rules.

Each document is measured and judged by rules; rule failures are summed by host; a host's failure
rate is shrunk towards the rate of all hosts with a beta prior whose two parameters come from the
hosts themselves (moments of their rates); and the verdict on the host is joined to its documents.

Defined results: a null text has no words and fails for being short. Documents without a host share
no fate: only their own rules count. Repeated rows are judged and counted each. An empty table
gives no rows, and a corpus of one host, or of hosts of equal rates, gives a prior as strong as the
documents of a mean host.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.shared import stored
from roadbook.llm.words import (
    Words,
    bytes_and_offsets,
    chars_per_span,
    mix,
    spans,
)

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FEWEST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
MOST_SYMBOLS = 50  # per cent of the words
MOST_DUP_LINES = 30  # per cent of the lines with a word
MOST_BROADCAST = 100_000  # hosts
WORST_RATE = 0.5  # a host is rejected if more of its documents than this fail, after shrinking

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
    "n_repeat_words long"
)


def measure(words: Words) -> list[np.ndarray]:
    """The measures of each text, in the order of MEASURES."""
    data, texts = words.data, len(words.offsets) - 1
    text_of = words.text_of()
    chars = chars_per_span(data, words.start, words.end)
    lines, dup_lines = _lines(words)
    return [
        words.counts(),
        np.bincount(text_of, weights=chars, minlength=texts).astype(np.int64),
        _per_text(SYMBOLS[data], words.offsets),
        lines,
        dup_lines,
        _repeat_words(words, text_of, texts),
    ]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(sums[offsets])


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those that equal an earlier line of their text."""
    raw, offsets = words.data.tobytes(), words.offsets.tolist()
    lines, dups = [], []
    for begin, end in zip(offsets, offsets[1:]):
        own = [x for x in raw[begin:end].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        lines.append(len(own))
        dups.append(len(own) - len(set(own)))
    return np.array(lines, np.int64), np.array(dups, np.int64)


def _repeat_words(words: Words, text_of: np.ndarray, texts: int) -> np.ndarray:
    """Words in three-word windows that their text has at least twice."""
    if len(words) < 3:
        return np.zeros(texts, np.int64)
    h = words.hashes()
    window = mix(mix(mix(h[:-2]) + h[1:-1]) + h[2:] + mix(text_of[:-2].astype(np.uint64)))
    whole = np.flatnonzero(text_of[:-2] == text_of[2:])
    window = window[whole]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(ranked), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    at = whole[order[again]]
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[at + k] = True
    return np.bincount(text_of[covered], minlength=texts).astype(np.int64)


def document_measures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """doc_id, host and MEASURES of each row."""
    picked = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{host_col}`").cast("string").alias("host"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    names = [m.split()[0] for m in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_and_offsets(batch.column(2))
            for i, j in spans(offsets):
                words = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                columns = [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)]
                columns += [pa.array(m, pa.int64()) for m in measure(words)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "host", *names])

    return picked.mapInArrow(run, f"doc_id long, host string, {MEASURES}")


def base_failed():
    return (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def any_rule_failed():
    return (
        base_failed()
        | (100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_lines"))
    )


def host_rates(measures: DataFrame) -> DataFrame:
    """host, documents, failures and shrunk_rate of each host, by DataFrame aggregation alone.

    With rates of mean m and variance v between hosts, the prior weighs m (1 - m) / v - 1 documents,
    at least one and at most the documents of a mean host.
    """
    hosts = (
        measures.where("host is not null")
        .groupBy("host")
        .agg(
            F.count("*").alias("documents"),
            F.sum(any_rule_failed().cast("long")).alias("failures"),
        )
    )
    rate = F.col("failures") / F.col("documents")
    prior = hosts.agg(
        F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg("documents").alias("n")
    ).select(
        "m",
        F.greatest(
            F.lit(1.0),
            F.least(
                F.when(F.col("v") > 0, F.col("m") * (1 - F.col("m")) / F.col("v") - 1).otherwise(
                    F.col("n")
                ),
                F.col("n"),
            ),
        ).alias("weight"),
    )
    # The prior is one row: no matter how many hosts there are, this join moves none of them.
    return hosts.join(F.broadcast(prior)).select(
        "host",
        "documents",
        "failures",
        (
            (F.col("failures") + F.col("m") * F.col("weight"))
            / (F.col("documents") + F.col("weight"))
        ).alias("shrunk_rate"),
    )


def judge(
    docs: DataFrame,
    worst_rate: float = WORST_RATE,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Measures of each row, base_failed, host_rejected and kept.

    Only rejected hosts are joined back: to all tasks if they are few, so that no host's documents
    meet in one task, or else by a shuffle in which adaptive execution splits large hosts.
    """
    measures = stored(document_measures(docs, id_col, text_col, host_col), "host-measures")
    rejected = host_rates(measures).where(F.col("shrunk_rate") > worst_rate)
    rejected = stored(rejected.select(F.col("host").alias("rejected_host")), "rejected-hosts")
    if rejected.count() <= MOST_BROADCAST:
        rejected = F.broadcast(rejected)
    return (
        measures.join(rejected, F.col("host") == F.col("rejected_host"), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("host_rejected", F.col("rejected_host").isNotNull())
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .drop("rejected_host")
    )
