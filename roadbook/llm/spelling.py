"""Spelling variants: words that are one edit apart, and which of them is the usual form.

Words come from maximal runs of letters, counted over all documents. All rotations of every word, marked
with a terminator, go into one sorted order (a permuterm index). A word that is edited at one place
agrees with the unedited one in everything after and before that place, which in the rotation that skips
the edited character is one prefix:

* words ``u c v`` and ``u d v`` (a character replaced) have rotations ``v$u c`` and ``v$u d``;
* the word ``u v`` (the character deleted) has the rotation ``v$u``.

So the words near each other stand together as the group of one stem ``v$u``: at most one word without
the character and one word for each character of the alphabet, however many words there are. A scan of
each group in sorted order gives every member its number of neighbours there and the best of them (from
the group's first two, not from pairs); sums by word follow. A replaced pair shares one stem only. A
deletion in a run of equal characters shares one stem for each of them, of which the last place counts.

Stems of at most 64 characters are the rotations themselves. Those of longer words, whose rotations
together would be the square of the word, are digests of ``u`` and ``v`` by rolling hashes (256 bits), and
words meet again by their MD5; the scan is the same.

A word's form is its neighbour of largest n (ties: the smallest in code-point order) if that n is at least
ten times its own; the root follows forms to the end by pointer doubling. n grows at least tenfold with
each step, so that there are fewer than 20.

Defined cases: null and empty texts have no words. A null id counts as an empty one in the check sum that
picks the runs to shorten. Repeated rows count as often as they stand there. A word without neighbours has
n_near 0, no form, and is its own root. An empty table gives no words. Nothing comes to the driver, and
nothing is broadcast by this module.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.shared import stored
from roadbook.llm.words import ids_and_texts, mix, window_hashes

LEAST_LENGTH, LEAST_COUNT, USUAL = 7, 2, 10
SHORTENED = 31  # one run in so many loses a character
LITERAL = 64  # characters of a stem that is written out
END = "$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEMS = "stem string, first string, edited string, n long, word_key string"


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n: runs of letters, A-Z lower-cased, one in 31 of them shortened; n of two at least."""
    letters = F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{LEAST_LENGTH},}}+")  # shorter runs give no word
    runs = ids_and_texts(docs, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", letters, 0)).alias("run"),
    )
    run = F.translate("run", UPPER, LOWER)
    mark = F.crc32(F.concat_ws(":", "id", "run"))
    runs = runs.select("id", run.alias("run")).select("run", mark.alias("mark"))
    at = F.expr("int(mark % length(run))")
    cut = F.concat(F.substring("run", 1, at), F.expr("substring(run, int(mark % length(run)) + 2)"))
    words = runs.select(F.when(F.col("mark") % SHORTENED == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n for each row of words (word, n; each word once)."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "spell-words")
    near = _near(words)
    best_n, best = F.col("best.minus_n") * -1, F.col("best.word")
    usual = best_n >= F.col("n") * USUAL
    found = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(usual, best).alias("form"),
            F.when(usual, best_n).alias("form_n"),
        ),
        "spell-found",
    )
    roots = _roots(found.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _near(words: DataFrame) -> DataFrame:
    """word, n_near and best (minus_n, word) of the words that have neighbours."""
    found = _scan(_rotations(words)).withColumn("word", _rebuilt(F.col("edited")))
    found = found.select("word", "near", *[_candidate(x) for x in ("other", "base")])
    least = F.least("other", "base")  # null where there is neither; least skips nulls
    found = found.select("word", "near", least.alias("best"))

    long = words.where(F.length("word") >= LITERAL)
    hashed = _scan(long.mapInArrow(_digests, _STEMS))
    named = long.select(F.md5("word").alias("word_key"), "word")
    # The few rows of long words that have a neighbour get its text, which decides ties.
    once = F.when(F.col("other").isNull(), F.col("near")).otherwise(0)
    two = [(F.col("near"), F.col("other")), (once, F.col("base"))]
    two = [F.struct(m.alias("near"), c["minus_n"].alias("minus_n"), c["key"].alias("key")) for m, c in two]
    each = hashed.select(F.col("word_key").alias("of"), F.inline(F.array(*two))).where("minus_n is not null")
    each = each.withColumnRenamed("key", "word_key")
    each = each.join(named, "word_key").select("of", "near", F.struct("minus_n", "word").alias("best"))
    each = each.join(named, F.col("of") == F.col("word_key")).select("word", "near", "best")
    return found.unionByName(each).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _rotations(words: DataFrame) -> DataFrame:
    """Rows (stem, first, edited, n, word_key) of all rotations that are at most LITERAL long."""
    size = F.length("word")
    i = F.col("i")
    before, after = F.substring("word", 1, i), F.expr("substring(word, i + 1)")

    def rows(longest: int, last: Column, stem: Column, edited: Column) -> DataFrame:
        places = words.where(size <= longest).select(
            "word", "n", F.explode(F.sequence(F.lit(0), last)).alias("i")
        )
        first = F.substring(stem, 1, 1)
        no_key = F.lit(None).cast("string")
        return places.select(
            stem.alias("stem"), first.alias("first"), edited.alias("edited"), "n", no_key.alias("word_key")
        )

    skipping = F.concat(F.expr("substring(word, i + 2)"), F.lit(END), before)
    edited = rows(LITERAL, size - 1, skipping, F.expr("substring(word, i + 1, 1)"))
    whole = rows(LITERAL - 1, size, F.concat(after, F.lit(END), before), F.lit(None).cast("string"))
    return edited.unionByName(whole)


def _scan(rotations: DataFrame) -> DataFrame:
    """Rows that have a neighbour in their group: how many (near), the best of the replaced (other: n,
    edited, key) and the one without the character, or the best of those with it (base).
    """
    group = Window.partitionBy("stem")
    ranked = group.orderBy(F.col("edited").isNull(), F.desc("n"), "edited")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct("n", "edited", F.col("word_key").alias("key"))
    rows = rotations.select(
        "*",
        F.row_number().over(ranked).alias("place"),
        F.count("edited").over(whole).alias("with"),
        F.count(F.lit(1)).over(whole).alias("members"),
        F.first(member).over(whole).alias("top"),
        F.nth_value(member, 2).over(whole).alias("second"),
        F.last(member).over(whole).alias("end"),
        F.max((F.col("edited") == F.col("first")).cast("int")).over(whole).alias("repeats"),
    ).where("members > 1")
    is_base = F.col("edited").isNull()
    has_base = F.col("members") > F.col("with")
    # In a run of equal characters only the last place counts: there another one follows.
    counts = F.col("edited") != F.col("first")
    next_best = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("top"))
    of_full = F.when(F.col("with") > 1, next_best)
    of_base = F.when(F.col("top.edited") != F.col("first"), F.col("top")).when(
        F.col("with") > 1, F.col("second")
    )
    near = F.when(is_base, F.col("with") - F.coalesce("repeats", F.lit(0))).otherwise(
        F.col("with") - 1 + (has_base & counts).cast("int")
    )

    def sorted_by(best: Column) -> Column:
        return F.when(best.isNotNull(), F.struct(
            (-best["n"]).alias("minus_n"), best["edited"].alias("edited"), best["key"].alias("key")
        ))

    return rows.select(
        "stem",
        "edited",
        "word_key",
        near.cast("long").alias("near"),
        sorted_by(F.when(~is_base, of_full)).alias("other"),
        sorted_by(F.when(is_base, of_base).when(has_base & counts, F.col("end"))).alias("base"),
    ).where("near > 0")


def _rebuilt(edited: Column) -> Column:
    """The word of a stem v$u with this character, or without one, between u and v."""
    before, after = F.substring_index("stem", END, -1), F.substring_index("stem", END, 1)
    return F.concat(before, F.coalesce(edited, F.lit("")), after)


def _candidate(name: str) -> Column:
    """minus_n and the word of a candidate, so that the least is the best."""
    best = F.struct(F.col(f"{name}.minus_n").alias("minus_n"), _rebuilt(F.col(f"{name}.edited")).alias("word"))
    return F.when(F.col(name).isNotNull(), best).alias(name)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What _rotations gives for the stems of long words, with digests for stems."""
    schema = pa.schema([(c, pa.int64() if c == "n" else pa.string()) for c in ("stem", "first", "edited", "n", "word_key")])
    for batch in batches:
        for word, n in zip(*(batch.column(c).to_pylist() for c in ("word", "n"))):
            size, key = len(word), hashlib.md5(word.encode()).hexdigest()
            codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
            following = [*word, END]

            def stems(skip: int, places: np.ndarray, codes=codes, size=size) -> list[str]:
                parts = []
                for values in (codes, mix(codes + np.uint64(977))):
                    parts.append(window_hashes(values, np.zeros_like(places), places))
                    parts.append(window_hashes(values, places + skip, np.full_like(places, size)))
                return ["#" + row.tobytes().hex() for row in np.stack(parts, axis=1)]

            step = 10_000
            for begin in range(0, size + 1, step):
                places = np.arange(begin, min(begin + step, size + 1))
                columns = [stems(0, places), [following[i] for i in places], [None] * len(places)]
                places = places[places < size] if size > LITERAL else places[:0]
                columns[0] += stems(1, places)
                columns[1] += [following[i + 1] for i in places]
                columns[2] += [word[i] for i in places]
                rows = len(columns[0])
                arrays = [*columns, [n] * rows, [key] * rows]
                yield pa.record_batch([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)


def _roots(forms: DataFrame) -> DataFrame:
    """word and root, where forms (word, root) leads to the next word only."""
    forms = stored(forms, "spell-forms")
    while True:
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = forms.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = stored(moved, "spell-roots")
        forms = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return forms
