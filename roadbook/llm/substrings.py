"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the least hash of the
``gram``-word sequences in it, so that equal windows have equal minimisers. Consecutive windows that
share a minimiser, a super-k-mer, travel as one string to the bucket of the minimiser, where windows
are sorted by hash, compared word by word, and all but the first occurrence are marked. Marks come
back to the documents as word ranges.

A census goes first: the minimisers alone are sorted, and only super-k-mers whose minimiser occurs
again, or that repeat something within themselves, can hold a repeat and travel. The texts are
moved once; the join with the census and the one with the marks share that exchange.

Hot groups. Word sequences that many documents hold rank behind all others as minimisers (they are
found on a sample of about ``SAMPLE`` documents; the choice moves windows between buckets and never
changes a result). Equal strings are folded where they are made: of those in one slice of a task
only the first travels, the others are marked on the spot. So a passage of a third of all documents
is one row for each slice.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has none. A document of
fewer words than a window keeps all. Rows of one id are compared on their own: at the same start
none is earlier, so that repeated rows stay alike; ranges find their row again by the id and the CRC-32
of its text. Each row without an id is a document of its own, after all that have one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.shared import with_row_keys
from roadbook.llm.words import Words, ids_and_texts, mix, word_slices

WINDOW, GRAM = 20, 5
# Documents looked at for hot word sequences, and the share of them that makes a sequence hot.
SAMPLE, HOT_SHARE = 4000, 0.01
# Super-k-mers sorted at a time in a bucket, and windows in one at most.
ROWS_AT_ONCE, LONGEST = 20_000, 256

_SENT = "minimiser long, doc_id long, place long, words binary, begin int, end int"
_CENSUS = ["minimiser", "doc_id", "start", "known"]
_MARK = ["doc_id", "place", "begin", "end"]
_HOT_BIT = np.uint64(1 << 63)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, whatever document they are in."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = mix(out + hashes[k : k + size])
    return out


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[: len(values) - step], values[step:])
        done += step
    return values


def _starts(words: Words, n: int) -> np.ndarray:
    """Words at which n words of one text begin."""
    counts = words.counts()
    last = np.repeat(words.first[1:], counts) - n
    at = np.arange(len(words))
    return at[at <= last]


def super_kmers(
    words: Words, window: int, gram: int, hot: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and minimiser of each run of windows that share it.

    And whether a sequence of ``gram`` words in it comes again within a window: without that, no
    window of the run equals another one.
    """
    starts = _starts(words, window)
    if not len(starts):
        return starts, starts, np.zeros(0, np.int64), np.zeros(0, dtype=bool)
    grams = gram_hashes(words.hashes(), gram) >> np.uint64(1)
    if len(hot):
        grams |= np.where(np.isin(grams, hot), _HOT_BIT, np.uint64(0))
    least = _sliding_min(grams, window - gram + 1)[starts]
    opens = np.r_[True, (np.diff(starts) > 1) | (least[1:] != least[:-1])]
    opens[1:] |= words.text_of()[starts[1:]] != words.text_of()[starts[:-1]]
    run = np.flatnonzero(opens)
    place = np.arange(len(starts)) - run[np.cumsum(opens) - 1]
    first = np.flatnonzero(place % LONGEST == 0)
    last = np.r_[first[1:], len(starts)] - 1
    near = np.zeros(len(grams) + 1, np.int64)
    for distance in range(1, window):
        near[1 : len(grams) + 1 - distance] |= grams[:-distance] == grams[distance:]
    near = np.cumsum(near)
    first, last, least = starts[first], starts[last], least[first].view(np.int64)
    return first, last, least, near[last + window - gram + 1] > near[first]


def hot_grams(docs: DataFrame, gram: int) -> np.ndarray:
    """Hashes of word sequences that a good share of a sample of documents holds."""
    every = max(1, docs.count() // SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(every)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in word_slices(batch.column(1)):
                starts = _starts(words, gram)
                own = (gram_hashes(words.hashes(), gram) >> np.uint64(1))[starts]
                pairs = np.unique(
                    np.rec.fromarrays([words.text_of()[starts], own], names="text,gram")
                )
                yield pa.RecordBatch.from_arrays([pa.array(pairs.gram.view(np.int64))], ["gram"])

    least = max(3, int(HOT_SHARE * SAMPLE))
    # At most the words of the sample divided by the least count: tens of thousands.
    rows = sample.mapInArrow(run, "gram long").groupBy("gram").count().where(F.col("count") >= least)
    return np.sort(np.array([r[0] for r in rows.select("gram").collect()], np.int64).view(np.uint64))


def _census(words, ids, window, gram, hot) -> pa.RecordBatch:
    """Minimisers of a slice, each once; what comes again in the slice is known to do so."""
    first, last, minimiser, known = super_kmers(words, window, gram, hot)
    text = words.text_of()[first]
    _, head, number = np.unique(minimiser, return_index=True, return_inverse=True)
    again = np.bincount(number, minlength=len(head))[number] > 1
    other = np.ones(len(first), dtype=bool)
    other[head] = False
    return pa.RecordBatch.from_arrays(
        [
            pa.array(minimiser, pa.int64(), mask=other & again),
            pa.array(ids[text], pa.int64()),
            pa.array((first - words.first[text]).astype(np.int32)),
            pa.array(known | again),
        ],
        _CENSUS,
    )


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, start) of the census rows that are known to recur or share their minimiser."""
    before: tuple | None = None  # the last row, if it has not been given out
    last_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0)
        given = key.is_null().to_numpy(zero_copy_only=False)
        value = key.fill_null(0).to_numpy()
        doc, start = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        same = (value[1:] == value[:-1]) & ~given[1:] & ~given[:-1]
        out = given | batch.column(3).to_numpy(zero_copy_only=False)
        out[1:] |= same
        out[:-1] |= same
        docs, starts = doc, start
        if last_key is not None and not given[0] and value[0] == last_key:
            out[0] = True
            if before is not None:
                docs, starts = np.r_[doc, before[0]], np.r_[start, before[1]]
                out = np.r_[out, True]
        chosen = np.flatnonzero(out)
        n = len(value)
        last_key = None if given[-1] else value[-1]
        before = None if out[n - 1] else (doc[-1], start[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs[chosen], pa.int64()), pa.array(starts[chosen].astype(np.int32))],
            ["doc_id", "start"],
        )


def _send(words, ids, crcs, chosen, window, gram, hot):
    """Rows to travel, and marks, of one slice of texts; chosen has text << 32 | start."""
    first, last, minimiser, _ = super_kmers(words, window, gram, hot)
    text = words.text_of()[first]
    picked = np.isin(text << 32 | (first - words.first[text]), chosen)
    first, last, minimiser = first[picked], last[picked], minimiser[picked]
    if not len(first):
        return [], []
    text = words.text_of()[first]
    doc, start = ids[text], first - words.first[text]
    place = (start << 32) | crcs[text]
    order = np.lexsort((place, doc))
    raw = words.data.tobytes()
    begins, ends = words.start[first].tolist(), words.end[last + window - 1].tolist()
    doc, place, minimiser, sizes = (x.tolist() for x in (doc, place, minimiser, last - first))
    seen: dict[bytes, int] = {}
    sent, marks = [], []
    for i in order.tolist():
        packed = raw[begins[i] : ends[i]]
        j = seen.setdefault(packed, i)
        if j == i:
            sent.append((minimiser[i], doc[i], place[i], packed))
        elif (doc[j], place[j] >> 32) < (doc[i], place[i] >> 32):
            at = place[i] >> 32
            marks.append((doc[i], place[i], at, at + sizes[i] + window))
        elif place[j] != place[i]:  # the same id and start, another text
            sent.append((minimiser[i], doc[i], place[i], packed))
    return sent, marks


def _mark(rows: list[tuple], window: int) -> tuple[list[tuple], set[int]]:
    """Ranges of words in windows that occur earlier, and the rows that hold a first occurrence.

    Rows are in the order of documents and starts.
    """
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows])])
    words = Words(data, offsets)
    hashes = words.hashes()
    starts = _starts(words, window)
    row = words.text_of()[starts]
    value = gram_hashes(hashes, window)[starts]
    order = np.argsort(value, kind="stable")
    ranked = value[order]
    opens = np.r_[True, ranked[1:] != ranked[:-1]]
    head = order[np.flatnonzero(opens)][np.cumsum(opens) - 1]
    alike = head != order
    for k in range(window):
        alike &= hashes[starts[head] + k] == hashes[starts[order] + k]
    doc = np.array([r[1] for r in rows], np.int64)[row]
    begin = np.array([r[2] >> 32 for r in rows], np.int64)[row] + starts - words.first[row]
    late = alike & ((doc[head] < doc[order]) | ((doc[head] == doc[order]) & (begin[head] < begin[order])))
    gone = np.zeros(len(starts), dtype=bool)
    gone[order[late]] = True
    at = np.flatnonzero(gone)
    marks = []
    if len(at):
        opens = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(row[at]) > 0)])
        closes = np.r_[opens[1:], len(at)] - 1
        for a, b in zip(at[opens].tolist(), at[closes].tolist()):
            own = rows[row[a]]
            marks.append((own[1], own[2], int(begin[a]), int(begin[b]) + window))
    return marks, set(row[~gone].tolist())


def _marks_batch(marks: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*marks)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _MARK)


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, ranges): ranges (crc, begin, end) of words to remove, for docs with doc_id and text.

    doc_id must not be null. crc is that of the text's bytes: it tells rows of one id apart.
    """
    hot = hot_grams(docs, gram)

    def take_census(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, words in word_slices(batch.column(1)):
                yield _census(words, ids[i:j], window, gram, hot)

    # What is known to recur has no need to meet others: it is dealt by its own document.
    dealt = F.coalesce("minimiser", F.xxhash64("doc_id", "start"))
    recurring = (
        docs.mapInArrow(take_census, "minimiser long, doc_id long, start int, known boolean")
        .withColumn("bucket", dealt)
        .repartition("bucket")
        .sortWithinPartitions("minimiser")
        .select(*_CENSUS)
        .mapInArrow(_recurring, "doc_id long, start int")
        .groupBy("doc_id")
        .agg(F.collect_list("start").alias("starts"))  # at most the words of a document
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, words in word_slices(batch.column(1)):
                raw, offsets = words.data.tobytes(), words.offsets.tolist()
                crcs = np.array(
                    [zlib.crc32(raw[a:b]) for a, b in zip(offsets, offsets[1:])], np.int64
                )
                starts = batch.column(2).slice(i, j - i)
                text = np.repeat(np.arange(j - i), starts.value_lengths().to_numpy())
                chosen = text << 32 | starts.flatten().to_numpy()
                sent, marks = _send(words, ids[i:j], crcs, chosen, window, gram, hot)
                rows = [(*r, None, None) for r in sent]
                rows += [(None, m[0], m[1], None, m[2], m[3]) for m in marks]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
                columns = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["minimiser", "doc_id", "place", "words", "begin", "end"],
                )

    def sort_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[tuple] = []
        for rows in _rows(batches):
            marked = [(r[1], r[2], r[4], r[5]) for r in rows if r[3] is None]
            rows = carried + [r for r in rows if r[3] is not None]
            if rows:
                marks, firsts = _mark(rows, window)
                marked += marks
                # The last minimiser may go on: later rows meet the first occurrences again.
                final = rows[-1][0]
                carried = [r for i, r in enumerate(rows) if r[0] == final and i in firsts]
            yield _marks_batch(marked)

    # A mark has no minimiser: dealt by its own document, it passes through.
    key = F.coalesce("minimiser", F.xxhash64("doc_id", "place"))
    marks = (
        docs.join(recurring, "doc_id")
        .select("doc_id", "text", "starts")
        .mapInArrow(send, _SENT)
        .withColumn("bucket", key)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "doc_id", "place")
        .select("bucket", "doc_id", "place", "words", "begin", "end")
        .mapInArrow(sort_windows, "doc_id long, place long, begin int, end int")
    )
    crc = F.col("place").bitwiseAND(F.lit(2**32 - 1)).alias("crc")
    # The ranges of one document, at most its words.
    return marks.groupBy("doc_id").agg(F.collect_list(F.struct(crc, "begin", "end")).alias("ranges"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield list(zip(*(c.to_pylist() for c in part.columns)))


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text (kept words joined by one space), n_words, n_removed for each row of docs."""
    rows, last = with_row_keys(ids_and_texts(docs, id_col, text_col), "doc_id", "row_key")
    # No key is null. Spark is told so, or it would filter one of the two joins with texts, and the
    # texts would be shuffled for each.
    texts = rows.select(F.coalesce("row_key", F.lit(-1)).alias("doc_id"), "text")
    ranges = repeated_ranges(texts, window, gram)
    joined = texts.join(ranges, "doc_id", "left").select("doc_id", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_slices(batch.column(1)):
                depth = np.zeros(len(words) + 1, np.int64)
                raw, offsets = words.data.tobytes(), words.offsets.tolist()
                for text, own in enumerate(batch.column(2).slice(i, j - i).to_pylist()):
                    if own:
                        crc = zlib.crc32(raw[offsets[text] : offsets[text + 1]])
                        base = int(words.first[text])
                        for r in own:
                            if r["crc"] == crc:
                                depth[base + r["begin"]] += 1
                                depth[base + r["end"]] -= 1
                keep = np.cumsum(depth)[:-1] == 0
                kept = np.concatenate([[0], np.cumsum(keep)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array([t.decode() for t in words.joined(keep)], pa.string()),
                        pa.array(words.counts(), pa.int64()),
                        pa.array(words.counts() - np.diff(kept[words.first]), pa.int64()),
                    ],
                    ["doc_id", "text", "n_words", "n_removed"],
                )

    kept = joined.mapInArrow(cut, "doc_id long, text string, n_words long, n_removed long")
    return kept.withColumn("doc_id", F.when(F.col("doc_id") <= last, F.col("doc_id")))
