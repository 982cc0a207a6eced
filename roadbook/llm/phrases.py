"""Phrase collocations by prefix-free parsing.

Texts are lower-cased, split into pieces at punctuation and line ends, and pieces into words. A parse cuts
each text before every word whose own characters say so (a hash of some of its bytes and its length, one
word in 32 on average), so equal stretches of text are cut alike wherever they stand. A chunk is the words
from one cut to the next, which it owns, and up to three words after them in the same piece, which the
next one owns; a dot stands where one piece ends and another begins. Every n-gram of up to four words that
starts at an owned word lies inside the chunk and in no other, so overlaps count once. The dictionary of different chunks of a language, with how often the parse has
them, is all that is counted from: n-grams inside a chunk weigh as much as the chunk is frequent.

Counting goes up by length. N-grams are counted by a 64-bit hash first, only where both shorter ones in
them are marked as frequent; the marks are a bit map of fixed size (8 MB) that goes to all tasks. Equal
hashes and equal marks only let more through, so nothing frequent is lost at any size; the fuller the
map, the more n-grams are counted that turn out to be rare. What is left, and every single word, is
counted by its words, exactly; the sum of the words is n.

A candidate has 2 to ``longest`` words and occurs at least ``least`` times (a). Each cut into two parts that
occur l and r times gives floor(2000000 * a / (l + r)); the lowest counts, of equal ones the cut after
the fewest words. A candidate is dropped if a longer one that contains it occurs at least 0.8 times as
often. The best ``top`` of a language remain, by score, then a, then the phrase in order of bytes.

Defined cases: a null or empty text has no words; a null language is ``und``. Repeated rows count as often as
they stand there. An empty table gives no phrases. Common words, lines and chunks are summed within each
task before they are shuffled. The best of a language are taken in two steps, so that one language does
not meet in one task. Only the bit maps come to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.shared import stored
from roadbook.llm.words import LOWER_ASCII, bytes_and_offsets, mix, spans, window_hashes

LEAST, TOP, LONGEST = 30, 2000, 4
GAP = 32  # one word in so many starts a chunk
BREAK = "."  # between pieces of a chunk; no word has this character
MARK_BITS = 26
SALTS = 16
# Chunks of so many bytes are counted together before they leave a task.
BYTES_AT_ONCE = 8 * 1024**2

_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_NEXT = np.uint64(0x9E3779B97F4A7C15)
_CHUNKS = "lang string, chunk string, owned int"


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, chunk (words and breaks joined by a space), owned (words that count), n (times in the parse)."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    chunks = texts.where("text is not null").mapInArrow(_parse, _CHUNKS)
    return chunks.groupBy("lang", "chunk", "owned").agg(F.count(F.lit(1)).alias("n"))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language."""
    chunks = stored(dictionary(docs, text_col, lang_col), "phrase-chunks")
    counts = stored(_counts(chunks, least), "phrase-counts")
    words = counts.where("size = 1").groupBy("lang").agg(F.sum("a").alias("n"))
    best = _best(_scored(counts.where(F.col("a") >= least)), top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = bytes_and_offsets(batch.column("text"))
        for i, j in spans(offsets):
            text_of, chunks, owned = _cut(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            lang = batch.column("lang").take(pa.array(text_of + i))
            yield pa.record_batch([lang.cast(pa.string()), chunks, pa.array(owned, pa.int32())], ["lang", "chunk", "owned"])


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The chunks of some texts: which text each is from, its words, and how many of them it owns."""
    data = LOWER_ASCII[data]
    kind, n = _KIND[data], len(data)
    inside = kind == 0
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    words = len(start)
    if not words:
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)
    breaks = np.cumsum(kind == 2)
    text_of = np.searchsorted(offsets, start, side="right") - 1
    new = np.ones(words, dtype=bool)
    new[1:] = (breaks[start[1:]] != breaks[end[:-1] - 1]) | (text_of[1:] != text_of[:-1])
    length = end - start
    sign = data[start].astype(np.uint64)
    for place in (end - 1, (start + end) // 2, np.minimum(start + 1, end - 1)):
        sign = (sign << np.uint64(8)) | data[place]
    trigger = mix(sign + (length.astype(np.uint64) << np.uint64(32))) % np.uint64(GAP) == 0
    opens_text = np.ones(words, dtype=bool)
    opens_text[1:] = text_of[1:] != text_of[:-1]
    begin = np.flatnonzero(opens_text | trigger)
    last = np.append(begin[1:], words)
    pieces = np.append(np.flatnonzero(new), words)
    piece_end = pieces[np.cumsum(new)[last - 1]]
    reach = np.minimum(last + LONGEST - 1, piece_end)
    # All words with a space after each, and a break before what opens a piece within a text; then a
    # copy of each chunk's share.
    lead = 2 * (new & ~opens_text)
    at = np.concatenate([[0], np.cumsum(lead + length + 1)])
    own = at[:-1] + lead  # where each word begins
    spaced = np.full(at[-1], 32, np.uint8)
    spaced[at[:-1][lead > 0]] = ord(BREAK)
    letters = np.arange(np.sum(length)) + np.repeat(own - (np.cumsum(length) - length), length)
    spaced[letters] = data[inside]
    sizes = at[reach] - 1 - own[begin]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    share = spaced[np.arange(bounds[-1]) + np.repeat(own[begin] - bounds[:-1], sizes)]
    chunks = pa.LargeStringArray.from_buffers(
        len(begin), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(share)
    )
    return text_of[begin], chunks.cast(pa.string()), last - begin


class _Slice:
    """Chunks taken together: the words of all, one after the other, as numbers and hashes."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        lists = pc.split_pattern(table["chunk"].combine_chunks().cast(pa.large_string()), " ")
        words = lists.flatten().dictionary_encode()
        self.names, self.codes = words.dictionary, words.indices.to_numpy()
        data, offsets = bytes_and_offsets(self.names)
        hashes = window_hashes(data.astype(np.uint64), offsets[:-1], offsets[1:])
        langs = table["lang"].combine_chunks().dictionary_encode()
        self.langs = langs.dictionary
        data, offsets = bytes_and_offsets(self.langs)
        of_lang = window_hashes(data.astype(np.uint64), offsets[:-1], offsets[1:])
        bounds = lists.offsets.to_numpy()
        sizes = np.diff(bounds)
        self.lang = np.repeat(langs.indices.to_numpy(), sizes)
        self.weight = np.repeat(table["n"].to_numpy(), sizes)
        at, ends = np.arange(len(self.codes)), np.repeat(bounds[1:] - bounds[0], sizes)
        is_break = self.codes == pc.index(self.names, pa.scalar(BREAK, self.names.type)).as_py()
        before = np.cumsum(~is_break) - ~is_break  # words in front of each
        first = np.repeat(before[bounds[:-1] - bounds[0]], sizes)
        self.owned = ~is_break & (before - first < np.repeat(table["owned"].to_numpy(), sizes))
        stops = np.minimum.accumulate(np.where(is_break, at, len(at))[::-1])[::-1]
        self.left = np.minimum(stops, ends) - at  # words to the end of the piece or the chunk
        self.grams = {1: mix(hashes[self.codes] + of_lang[self.lang])}
        for size in range(2, LONGEST + 1):
            before, following = self.grams[size - 1], np.roll(self.grams[1], 1 - size)
            self.grams[size] = mix(before * _NEXT + following)

    def starts(self, size: int, marks: dict[int, np.ndarray]) -> np.ndarray:
        """Owned places where an n-gram of so many words begins whose parts are marked."""
        fits = self.owned & (self.left >= size)
        for part in (size, size - 1):
            if part in marks:
                known = _is_marked(self.grams[part], marks[part])
                fits &= known
                if part < size:
                    fits[:-1] &= known[1:]
                break
        return np.flatnonzero(fits)


def _is_marked(hashes: np.ndarray, marks: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - MARK_BITS)
    return (marks[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Slice]:
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size >= BYTES_AT_ONCE:
            yield _Slice(pa.Table.from_batches(waiting))
            waiting, size = [], 0
    if waiting and sum(b.num_rows for b in waiting):
        yield _Slice(pa.Table.from_batches(waiting))


def _summed(columns: dict[str, np.ndarray]) -> pa.Table:
    """The sums of n by all other columns."""
    keys = [c for c in columns if c != "n"]
    return pa.table(columns).group_by(keys, use_threads=False).aggregate([("n", "sum")])


def _hash_counts(size: int, marks) -> Callable:
    """Counts of n-grams of so many words by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: v.value for k, v in marks.items()}
        for part in _slices(batches):
            at = part.starts(size, known)
            sums = _summed({"hash": part.grams[size][at].view(np.int64), "n": part.weight[at]})
            sums = sums.select(["hash", "n_sum"]).rename_columns(["hash", "n"])
            yield from sums.to_batches(max_chunksize=1 << 16)

    return run


def _word_counts(marks) -> Callable:
    """Counts of all words, and of longer n-grams that may be frequent by their hashes, by their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: v.value for k, v in marks.items()}
        for part in _slices(batches):
            for size in range(1, LONGEST + 1):
                at = part.starts(size, known if size > 1 else {})
                codes = {f"w{k}": part.codes[at + k] for k in range(size)}
                sums = _summed({"lang": part.lang[at], **codes, "n": part.weight[at]})
                words = [part.names.take(sums[c]) for c in codes]
                phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
                langs = part.langs.take(sums["lang"])
                sizes = pa.array(np.full(sums.num_rows, size, np.int32))
                out = pa.table([langs, sizes, phrase, sums["n_sum"]], names=["lang", "size", "phrase", "a"])
                out = out.cast(pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("a", pa.int64())]))
                yield from out.to_batches(max_chunksize=1 << 16)

    return run


def _counts(chunks: DataFrame, least: int) -> DataFrame:
    """lang, size, phrase and a of all words and of the longer phrases found at least ``least`` times."""
    spark, marks = chunks.sparkSession, {}
    for size in range(1, LONGEST):
        counts = chunks.mapInArrow(_hash_counts(size, marks), "hash long, n long")
        counts = counts.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        marks = {**marks, size: spark.sparkContext.broadcast(_marked(counts))}
    found = chunks.mapInArrow(_word_counts(marks), "lang string, size int, phrase string, a long")
    found = found.groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a"))
    return found.where((F.col("size") == 1) | (F.col("a") >= least))


def _marked(hashes: DataFrame) -> np.ndarray:
    """A map of 2 ** MARK_BITS bits with one set for the first bits of each hash."""
    bit = F.shiftrightunsigned("hash", 64 - MARK_BITS)
    page = F.bitmap_construct_agg("place").alias("bits")  # of 32,768 places
    places = hashes.select(F.shiftright(bit, 15).alias("page"), (bit % 32768).alias("place"))
    marks = np.zeros(1 << (MARK_BITS - 3), np.uint8)
    for number, bits in places.groupBy("page").agg(page).toLocalIterator():
        marks[number * 4096 : number * 4096 + 4096] = np.frombuffer(bytes(bits), np.uint8)
    return marks


def _scored(frequent: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r and score of the candidates that no longer one stands for."""
    candidates = frequent.where("size > 1")
    parts = frequent.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    first = F.expr("substring_index(phrase, ' ', k)")
    cuts = candidates.select("*", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumn("first", first)
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    for name, count in (("first", "l"), ("rest", "r")):
        own = parts.withColumnRenamed("part", name).withColumnRenamed("f", count)
        cuts = cuts.join(own, ["lang", name])
    score = F.expr("2000000BD * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest)

    longer = candidates.where("size > 2").withColumn("words", F.split("phrase", " "))
    longer = longer.select("lang", "a", F.explode(_inside()).alias("phrase")).where("phrase is not null")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | F.expr("100BD * most < 80BD * a")
    )
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _inside() -> Column:
    """The phrases of two words or more within ``words`` (size of them), null where there is none."""
    found = []
    for size in range(2, LONGEST):
        for at in range(1, LONGEST - size + 2):
            fits = (F.col("size") > size) & (F.col("size") >= at + size - 1)
            found.append(F.when(fits, F.array_join(F.slice("words", at, size), " ")))
    return F.array(*found)


def _best(scored: DataFrame, top: int) -> DataFrame:
    """The first rows of each language with their rank: of each of its parts first, then of all."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        salted = salted.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return salted.drop("salt")
