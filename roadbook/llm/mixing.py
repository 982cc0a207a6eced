"""Mix sources to target weights: how many copies of each document a mixture takes.

Sources in order of code points (null, a source of its own, last) weigh ``weights``, repeating, and share
the words of all documents by weight. A target stops at ``most`` times its source's words; the excess is
shared by weight among the others until none is above. That level is found by Newton steps on exact
integers, one aggregation of the sources each: the shared sum is concave and piecewise linear in the
level, so the steps rise to the answer without passing it and end when no further source is cut.

Within a source each document is due the same number of copies, target / source words. Its whole part is
taken for certain; the fraction is settled by pivotal dependent rounding in words: in a pair, words are
moved from one side to the other, in a random direction with probabilities that keep both expectations,
until one side has whole copies. The words of the source do not change by that, so all that a source
misses its target by is the rounding of the one document that is left over. Pairs are formed along chains
from long to short. Documents that are due the same fraction go on to be due the same: the longest open
one is paired with all the shorter ones that are left, as one side. A long document is so settled at once
(paired with its neighbour alone it would wander on, and be left over in the end), and what is left over
is short. Documents due other fractions (repeated ones, and what earlier rounds left) come first in a
chain, each paired with the next. A chain is a chunk of some 2,048 documents dealt out by hash; the one
left over of each chunk goes to the next round, where 2,048 chunks make one chain, and so on: a reduction
tree whose depth is the logarithm of the largest source. The random directions of a chain follow from a
hash of its first document, so a rerun, or a task that is run again, decides the same.

Defined cases: a null or empty text has 0 words, takes part in nothing and is taken 0 words. Rows equal in
id, source and text are copies of one document: they are rounded together (of n copies due p more, the
whole part of n * p is certain), and which of them gets a copy more is open. Sources of 0 words have
target 0. Ids may be null or repeat; texts under one id are documents of their own. An empty table gives
none. Nothing but the sources' sums (one row) comes to the driver; only sources with more than a
thousandth of the documents, fewer than a thousand, are broadcast.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from decimal import Decimal
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.shared import stored
from roadbook.llm.words import unused_name

WEIGHTS = (5, 2, 1)
MOST = 3
FAN_IN = 2048
HOT_SHARE_OF = 1000
TINY = 1e-9  # a fraction nearer to 0 or 1 is whole
# Copies of one document that a task writes in one go.
ROWS_AT_ONCE = 10_000
_WORD = r"[^\x20\x09-\x0D]+"
_KEY = ("source", "doc_id", "text_key")


def mixture(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """A row for each different document: source, doc_id, text_key (hash of the text), size (its words),
    rows (how often it is in docs), source_size, target, copies (of every row) and extra (how many of
    the rows get one copy more).
    """
    found = stored(_documents(docs, id_col, text_col, source_col), "mix-documents")
    sources = stored(_targets(_ranked(_sources(found)), weights, most), "mix-sources")
    due = _with_source(found, sources)
    share = F.col("rows") * F.col("part")  # copies due to all equal rows together
    due = due.withColumn("certain", F.floor(share)).withColumn("open", share - F.floor(share))
    return _settled(stored(due, "mix-due"), seed)


def taken_rows(plan: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken for each row of docs, from what mixture returns."""
    words = F.col("size")
    groups = [(F.col("extra"), F.col("copies") + 1), (F.col("rows") - F.col("extra"), F.col("copies"))]
    groups = F.array(*[F.struct(n.alias("n"), (words * c).alias("taken")) for n, c in groups])
    out = ["doc_id", "size", "source_size", "target"]
    each = plan.select(*out, F.inline(groups)).where("n > 0")
    # A document with very many copies is written by many tasks.
    many = each.where(F.col("n") > ROWS_AT_ONCE).select("*", F.posexplode(_blocks()).alias("block", "m"))
    many = many.repartition("doc_id", "size", "block").select(*out, "taken", F.col("m").alias("n"))
    few = each.where(F.col("n") <= ROWS_AT_ONCE).select(*out, "taken", "n")
    one = F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))
    return few.unionByName(many).select(*out, "taken", one.alias("_")).drop("_")


def take(
    docs: DataFrame,
    plan: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixture itself: documents of docs as often as the plan says, with copy (from 1 on), in no order.

    Equal rows (id, source, text) are one document; where they differ in other columns, the values of
    one of them are used.
    """
    names = {"source": source_col, "doc_id": id_col, "text_key": text_col}
    keys = {k: unused_name(docs, f"mix_{k}") for k in _KEY}
    copy = unused_name(docs, "copy")
    total = F.col("rows") * F.col("copies") + F.col("extra")
    plan = plan.select(*[F.col(k).alias(keys[k]) for k in _KEY], total.alias(copy)).where(F.col(copy) > 0)
    own = {k: F.col(f"`{c}`") for k, c in names.items()}
    own = own | {"doc_id": own["doc_id"].cast("long"), "text_key": F.xxhash64(own["text_key"].cast("string"))}
    rows = docs.withColumns({keys[k]: v for k, v in own.items()})
    first = unused_name(docs, "mix_first")
    one = Window.partitionBy(*keys.values()).orderBy(F.lit(0))
    rows = rows.withColumn(first, F.row_number().over(one)).where(F.col(first) == 1)
    same = [rows[k].eqNullSafe(plan[k]) for k in keys.values()]
    chosen = rows.join(plan, same).select(*[rows[f"`{c}`"] for c in docs.columns], copy)
    return chosen.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), copy)))


def _blocks() -> Column:
    """n as an array of parts of at most ROWS_AT_ONCE."""
    whole = F.floor((F.col("n") - 1) / ROWS_AT_ONCE)
    full = F.array_repeat(F.lit(ROWS_AT_ONCE).cast("long"), whole.cast("int"))
    return F.concat(full, F.array(F.col("n") - whole * ROWS_AT_ONCE))


def _documents(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("long").alias("size"),
    )
    return rows.groupBy(*_KEY, "size").agg(F.count(F.lit(1)).alias("rows"))


def _sources(found: DataFrame) -> DataFrame:
    return found.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("documents")
    )


def _ranked(sources: DataFrame) -> DataFrame:
    """sources with rank, from 0 on, by code point and null last: sorted, then numbered task by task."""
    at = F.monotonically_increasing_id()
    ordered = stored(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", at), "mix-order")
    part = F.shiftright("at", 33)
    # A row for each task that wrote some, with where its numbers begin.
    sizes = sorted(map(tuple, ordered.groupBy(part).agg(F.count(F.lit(1))).collect()))
    begins, before = [], 0
    for number, rows in sizes:
        begins.append((number, before - (number << 33)))
        before += rows
    begins = sources.sparkSession.createDataFrame(begins, "part long, begin long")
    return ordered.join(F.broadcast(begins), part == F.col("part")).select(
        *sources.columns, (F.col("at") + F.col("begin")).alias("rank")
    )


def _exact(value: int) -> Column:
    return F.lit(Decimal(value))


def _targets(ranked: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """source, source_size, documents, target; copies due to each document, whole and part."""
    by_rank = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(by_rank, (F.col("rank") % len(weights) + 1).cast("int"))
    rows = stored(ranked.withColumn("weight", weight.cast("decimal(10,0)")), "mix-ranked")
    size = F.col("source_size").cast("decimal(20,0)")
    total, shared = rows.agg(F.sum(size), F.sum("weight")).first()
    total, level, shared = int(total or 0), int(total or 0), int(shared or 1)
    while True:
        # A source stops where weight * level / shared is above most * size.
        stops = F.col("weight") * _exact(level) > size * _exact(most * shared)
        cut, rest = rows.agg(
            F.sum(F.when(stops, size * _exact(most))), F.sum(F.when(~stops, F.col("weight")))
        ).first()
        new_level, new_shared = total - int(cut or 0), int(rest or 1)
        if new_level * shared == level * new_shared:
            break
        level, shared = new_level, new_shared
    due, each = F.col("weight") * _exact(level), size * _exact(shared)
    target = F.when(stops, (size * _exact(most)).cast("double"))
    target = target.otherwise(due.cast("double") / F.lit(float(shared)))
    none = size == 0
    rows = rows.withColumn("due", due).withColumn("each", each)
    copies = F.when(none, 0).when(stops, most).otherwise(F.expr("due div nullif(each, 0)"))
    left = F.expr("double(due % nullif(each, 0)) / double(nullif(each, 0))")
    part = F.when(none | stops, 0.0).otherwise(left)
    return rows.select(
        "source",
        "source_size",
        "documents",
        target.alias("target"),
        copies.cast("long").alias("copies"),
        part.alias("part"),
    )


def _with_source(found: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with the columns of their source; hot sources by broadcast, others by a shuffle."""
    sources = sources.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    all_documents = sources.agg(F.sum("documents")).first()[0] or 0
    is_hot = F.col("documents") * HOT_SHARE_OF > F.lit(all_documents)
    hot = F.broadcast(sources.where(is_hot))
    others = found.join(F.broadcast(sources.where(is_hot).select("of")), same, "left_anti")
    return found.join(hot, same).unionByName(others.join(sources.where(~is_hot), same)).drop("of")


def _settled(due: DataFrame, seed: int) -> DataFrame:
    """due with extra, the certain copies and the one that rounding gives or does not."""
    to_settle = (F.col("open") > 0) & (F.col("size") > 0)
    done = [due.where(~to_settle)]
    rows = due.where(to_settle).withColumn("chunks", F.ceil(F.col("documents") / F.lit(FAN_IN)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(*_KEY, F.lit(seed)), "chunks"))
    largest = due.agg(F.max("documents")).first()[0] or 0
    chunks, level = -(-largest // FAN_IN), 0
    while True:
        level += 1
        # Single documents are all due the same; what is left of a round is not.
        alike = (F.col("rows") == 1) if level == 1 else F.lit(False)
        rows = rows.withColumn("alike", alike)
        rows = rows.withColumn("mark", F.xxhash64(*_KEY, F.lit(seed + level)))
        rows = rows.repartition("source", "chunk").sortWithinPartitions(
            "source", "chunk", "alike", F.desc("size"), "mark", "doc_id", "text_key"
        )
        rows = stored(rows.mapInPandas(_scan, rows.schema), f"mix-round-{level}")
        whole = (F.col("open") == 0) | (F.col("open") == 1)
        done.append(rows.where(whole).select(*due.columns))
        if chunks <= 1:
            break
        chunks = -(-chunks // FAN_IN)
        rows = rows.where(~whole).withColumns(
            {
                "chunk": F.floor(F.col("chunk") / F.lit(FAN_IN)),
                "chunks": F.ceil(F.col("chunks") / F.lit(FAN_IN)),
            }
        )
    # What needs no settling has open 0, or no words.
    extra = F.col("certain") + (F.col("open") == 1).cast("long")
    return reduce(DataFrame.unionByName, done).select(
        *_KEY, "size", "rows", "source_size", "target", "copies", extra.alias("extra")
    )


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by chain, from long to short, with open settled chain by chain."""
    waiting = None  # rows of the last chain, which may go on
    for frame in frames:
        rows = frame if waiting is None else pd.concat([waiting, frame], ignore_index=True)
        chains = list(zip(rows["source"].tolist(), rows["chunk"].tolist()))
        begins = [j for j in range(len(chains)) if j == 0 or chains[j] != chains[j - 1]]
        if len(begins) > 1:
            yield _all_settled(rows.iloc[: begins[-1]], begins)
        waiting = rows.iloc[begins[-1] :] if begins else None
    if waiting is not None:
        yield _all_settled(waiting, [0, len(waiting)])


def _all_settled(rows: pd.DataFrame, begins: list[int]) -> pd.DataFrame:
    sizes, open_, marks = (rows[c].tolist() for c in ("size", "open", "mark"))
    alike, alone = rows["alike"].tolist(), (rows["chunks"] == 1).tolist()
    out: list[float] = []
    for i, j in zip(begins, begins[1:]):
        out += pivot(sizes[i:j], open_[i:j], j - i - sum(alike[i:j]), random.Random(marks[i]), alone[i])
    return rows.assign(open=out)


def pivot(
    sizes: list[int], open_: list[float], alike: int, rng: random.Random, alone: bool
) -> list[float]:
    """Fractions of a chain settled to 0 or 1, but for one at most; if ``alone``, that is drawn too.

    Documents from place ``alike`` on came with one fraction. Each document before them is paired with
    the next; then the open document is paired with all alike ones that are left, which keep a common
    fraction. Words move between the two sides until one of them has whole copies.
    """
    out, held = list(open_), None
    for j in range(alike):
        if held is None:
            held = j
            continue
        out[held], out[j] = _transfer(out[held], sizes[held], out[j], sizes[j], rng)
        held = next((k for k in (held, j) if 0 < out[k] < 1), None)
    common, i, words = out[-1], alike, sum(sizes[alike:])
    while True:
        if held is None:
            if i == len(out) or not 0 < common < 1:
                break
            held, out[i] = i, common
            words -= sizes[i]
            i += 1
        if words == 0 or not 0 < common < 1:
            break
        out[held], common = _transfer(out[held], sizes[held], common, words, rng)
        held = held if 0 < out[held] < 1 else None
    out[i:] = [common] * (len(out) - i)
    if alone and held is not None:
        out[held] = float(rng.random() < out[held])
    return out


def _transfer(q: float, s: int, p: float, t: int, rng: random.Random) -> tuple[float, float]:
    """Fractions q of s words and p of t words, after words have moved until one is 0 or 1."""
    up, down = min(s * (1 - q), t * p), min(s * q, t * (1 - p))
    if rng.random() * (up + down) < down:
        ends = s * (1 - q) - t * p  # the first is whole where it is not above 0, the second where not below
        q, p = (1.0 if ends <= 0 else q + up / s), (0.0 if ends >= 0 else p - up / t)
    else:
        ends = s * q - t * (1 - p)
        q, p = (0.0 if ends <= 0 else q - down / s), (1.0 if ends >= 0 else p + down / t)
    return _whole(q), _whole(p)


def _whole(p: float) -> float:
    return float(round(p)) if p < TINY or p > 1 - TINY else p
