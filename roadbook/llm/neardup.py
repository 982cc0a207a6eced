"""Near-duplicates by a chosen-path set similarity join.

A document's set is its distinct shingles of ``shingle`` lower-cased words, as 64-bit hashes.
Documents of equal sets form a class, found by one aggregation; classes are joined.

Each class has a signature of ``COORDINATES`` minwise tokens. In each of ``trees`` independent trees
the root sends a class to ``BRANCH`` children, one for each pair of coordinates that the node
selects, named after the tokens found there: two steps of a path at a time, so that classes that
share a single token by chance do not meet. A node of at most ``LEAF`` classes is compared exhaustively. A larger
one branches again, by coordinates of its own, unless its classes are alike on the whole: those
would only stay together, and the node stays whole. It is cut into blocks, each a leaf with some
classes that all blocks of the node share, and so most of its classes become one component.
Two sets of similarity s share a path down to any depth with a probability that a branching process
gives (``missed``); ``trees`` follows from the recall wanted.

Leaves compare signatures, a byte for each coordinate, and name candidates: a spanning forest of the
likeliest links, which are confirmed on full sets. Classes that no candidate holds apart are one
component or cannot be linked. A leaf with a candidate that failed and whose ends are still apart is
looked at again, and so is a whole node of several components: there the classes outside its largest
component meet all others, block by block. What else is likely between components travels as pairs,
or, where that would be more than ``PAIRS_EACH`` for each class that takes part, the classes travel
with their sets and are compared in the leaf, all at once. So all pairs of a leaf or node are decided,
while few of them travel. Components are found by alternating large-star and small-star steps over
the confirmed links.

Defined results: without words or text the set is empty and linked with nothing; with fewer words
than a shingle the whole sequence is the one shingle. Rows of one id are one document: their sets
are linked. A row with a null id is a document of its own that comes after all others; its id stays
null, and so does the component of such rows alone, one of which is kept. Ties need no order:
components have the smallest id reachable.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.shared import stored, with_row_keys
from roadbook.llm.substrings import gram_hashes
from roadbook.llm.words import ids_and_texts, mix, unused_name, word_slices

COORDINATES, BRANCH, LEAF, DEEPEST = 64, 2, 1000, 5
# Classes of a large node that are looked at to tell whether they are alike on the whole.
LOOKED_AT, ALIKE = 48, 0.5
# Standard deviations below the threshold at which signatures still leave a link possible: one in
# some 10^7 links at the threshold itself falls below, fewer of closer ones.
SLACK = 5.2
PAIRS_EACH = 2
# Classes that all blocks of a whole node share, and what a block holds where components meet.
PIVOTS, WIDE, WIDE_SHINGLES = 32, 2048, 1 << 20
# Shingles of a leaf that are counted at a time, and columns of a dense count.
COUNTED, COLUMNS = 1 << 21, 2048
# Marks of the documents whose sets are asked for: 8 MB go to all tasks, whatever the input.
FILTER_BITS = 1 << 26

_rng = np.random.default_rng(20240229)
_MULTIPLIERS = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def missed(similarity: float) -> float:
    """Probability that one tree parts two sets of this similarity, at whatever depth."""
    q = 0.0
    for _ in range(200):
        q = (1 - similarity**2 + similarity**2 * q) ** BRANCH
    return q


def trees_for(similarity: float, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(missed(similarity))))


def shingle_sets(words, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes = words.hashes(lower=True)
    grams = gram_hashes(hashes, shingle)
    out = []
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(grams[a : b - shingle + 1]))
        else:  # the whole sequence as one
            out.append(gram_hashes(hashes[a:b], b - a)[:1] if b > a else grams[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minwise tokens for each set; empty sets have zeros."""
    out = np.zeros((len(sets), COORDINATES), np.uint32)
    full = np.array([len(s) > 0 for s in sets], dtype=bool)
    if full.any():
        flat = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets if len(s)])[:-1]])
        for k in range(COORDINATES):
            least = np.minimum.reduceat(flat * _MULTIPLIERS[k], starts)
            out[full, k] = (least >> np.uint64(32)).astype(np.uint32)
    return out


def features(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n, digest, signature, sketch) for docs with doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_slices(batch.column(1)):
                sets = shingle_sets(words, shingle)
                signed = signatures(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(
                            [blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                            pa.binary(),
                        ),
                        pa.array([s.tobytes() for s in signed], pa.binary()),
                        pa.array([s.astype(np.uint8).tobytes() for s in signed], pa.binary()),
                    ],
                    ["doc_id", "n", "digest", "signature", "sketch"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, signature binary, sketch binary")


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(rep, hashes) for docs with doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_slices(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(words, shingle)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(sets, pa.binary())],
                    ["rep", "hashes"],
                )

    return docs.mapInArrow(run, "rep long, hashes binary")


def matrix(column: pa.Array, kind=np.uint32) -> np.ndarray:
    """Signatures or sketches of a column, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, COORDINATES)


def _children(node: np.ndarray, signature: np.ndarray) -> np.ndarray:
    """Child nodes, one column for each pair of coordinates that the node selects."""
    out = np.empty((len(node), BRANCH), np.uint64)
    rows = np.arange(len(node))
    start = mix(node + np.uint64(1)) % np.uint64(COORDINATES)
    # Steps of an odd size meet no coordinate twice.
    step = (mix(node + np.uint64(77)) % np.uint64(COORDINATES // 2)) * np.uint64(2) + np.uint64(1)
    for j in range(BRANCH):
        child = mix(node + np.uint64(1000 + j))
        for k in (2 * j, 2 * j + 1):
            coordinate = (start + np.uint64(k) * step) % np.uint64(COORDINATES)
            child = mix(child + signature[rows, coordinate.astype(np.int64)])
        out[:, j] = child
    return out


def branch(rows: DataFrame, trees: int | None = None) -> DataFrame:
    """(node, rep) of the children: of the roots of all trees, or of the rows' own nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, signature = batch.column(0), matrix(batch.column(1))
            if trees:
                roots = [np.full(len(reps), mix(np.uint64([t]))[0]) for t in range(trees)]
            else:
                roots = [batch.column(2).to_numpy().view(np.uint64)]
            for root in roots:
                children = _children(root, signature)
                for j in range(BRANCH):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(children[:, j].view(np.int64)), reps], ["node", "rep"]
                    )

    return rows.mapInArrow(run, "node long, rep long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each value of the first column, by which they come sorted."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not len(table):
            continue
        keys = table.column(0).to_numpy()
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]).tolist()
        table = table.combine_chunks()
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None and len(rest):
        yield rest


class Threshold:
    """The similarity asked for, as exact per cent, and what it means for sizes and signatures."""

    def __init__(self, percent: int):
        self.percent = percent
        s = percent / 100
        self.agree = math.ceil((s - SLACK * math.sqrt(s * (1 - s) / COORDINATES)) * COORDINATES)

    def likely(self, i: int, sketch, sizes) -> np.ndarray:
        """Agreeing coordinates of row i with each row, a column of sketch; 0 where no link is possible."""
        # or alike in their last byte
        agree = (sketch == sketch[:, i : i + 1]).view(np.uint8).sum(axis=0, dtype=np.uint8)
        least, most = -(-self.percent * sizes[i] // 100), 100 * sizes[i] // self.percent
        possible = (agree >= self.agree) & (sizes >= least) & (sizes <= most)
        possible[i] = False
        return agree * possible

    def holds(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def forest(sketch, sizes, threshold: Threshold) -> list[tuple[int, int]]:
    """A spanning forest of the likeliest links of a leaf, grown from any row on."""
    n = len(sizes)
    best, parent = np.zeros(n, np.uint8), np.zeros(n, np.int64)
    outside = np.ones(n, dtype=bool)
    edges, current = [], 0
    for _ in range(n):
        outside[current], best[current] = False, 0
        agree = threshold.likely(current, sketch, sizes)
        closer = outside & (agree > best)
        best[closer], parent[closer] = agree[closer], current
        current = int(best.argmax())
        if best[current] > 0:
            edges.append((int(parent[current]), current))
        else:
            current = int(outside.argmax())
    return edges


def _leaf_columns(group: pa.Table):
    return (
        group.column("rep").to_numpy(),
        np.ascontiguousarray(matrix(group.column("sketch"), np.uint8).T),
        group.column("n").to_numpy(),
        group.column("side").to_numpy(),
    )


def candidates(leaves: DataFrame, threshold: Threshold) -> DataFrame:
    """(leaf, a, b) with a < b: for each leaf a spanning forest of its likely links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for group in _groups(batches):
            reps, sketch, sizes, _ = _leaf_columns(group)
            leaf = group.column("leaf")[0].as_py()
            for i, j in forest(sketch, sizes, threshold):
                if reps[i] != reps[j]:
                    found.append((leaf, int(min(reps[i], reps[j])), int(max(reps[i], reps[j]))))
            if len(found) > 10_000:
                yield _links(found)
                found = []
        yield _links(found)

    rows = leaves.select("leaf", "side", "rep", "n", "sketch")
    return (
        rows.repartition("leaf")
        .sortWithinPartitions("leaf", "rep")
        .mapInArrow(run, "leaf long, a long, b long")
    )


def _links(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["leaf", "a", "b"])


def _pairs(found) -> pa.RecordBatch:
    a, b = list(zip(*found)) or ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Those pairs whose full sets are similar enough."""
    a = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("hashes_a"))
    b = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("hashes_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                threshold.holds(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            kept = pa.Table.from_batches([batch]).select([0, 1]).filter(pa.array(good, pa.bool_()))
            yield from kept.to_batches()

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "hashes_a", "hashes_b")
    return both.mapInArrow(run, "a long, b long").distinct()


_OPEN = "leaf long, side int, rep long, n long, sketch binary, component long, other long"


def undecided(leaves: DataFrame, threshold: Threshold) -> DataFrame:
    """Likely pairs between components, the tested candidates aside: (rep, other), or whole classes.

    leaves has the component of each class. Where a leaf has two sides, the pairs are those across.
    Where other is null the row is a class that takes part in more pairs than should travel.
    """
    names = [f.split()[0] for f in _OPEN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            reps, sketch, sizes, sides = _leaf_columns(group)
            component = group.column("component").to_numpy()
            values, counts = np.unique(component, return_counts=True)
            if len(values) == 1:
                continue
            tested = {}
            if not sides.any():
                # The largest component is looked at from the others' side.
                rows, others = component != values[counts.argmax()], np.ones(len(reps), dtype=bool)
                for i, j in forest(sketch, sizes, threshold):
                    tested.setdefault(i, []).append(j)
                    tested.setdefault(j, []).append(i)
            else:
                rows, others = sides == 1, sides == 2
            pairs, n, involved = [], 0, np.zeros(len(reps), dtype=bool)
            for i in np.flatnonzero(rows).tolist():
                likely = others & (component != component[i]) & (threshold.likely(i, sketch, sizes) > 0)
                likely[tested.get(i, [])] = False
                found = np.flatnonzero(likely)
                if len(found):
                    involved |= likely
                    involved[i] = True
                    n += len(found)
                    if n <= PAIRS_EACH * len(reps):
                        pairs.append((np.full(len(found), reps[i]), reps[found]))
            if not n:
                continue
            if n <= PAIRS_EACH * involved.sum():
                a, b = (np.concatenate(x) for x in zip(*pairs))
                ends = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
                none = [pa.nulls(len(ends), f.type) for f in kinds]
                none[2], none[6] = pa.array(ends[:, 0]), pa.array(ends[:, 1])
                yield pa.RecordBatch.from_arrays(none, names)
            else:
                rows = group.take(np.flatnonzero(involved))
                other = pa.chunked_array([pa.nulls(len(rows), pa.int64())])
                yield from rows.append_column("other", other).to_batches()

    kinds = [
        pa.field(name, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[kind])
        for name, kind in (f.split() for f in _OPEN.split(", "))
    ]
    rows = leaves.select("leaf", "side", "rep", "n", "sketch", "component")
    return rows.repartition("leaf").sortWithinPartitions("leaf", "rep").mapInArrow(run, _OPEN)


def _shared(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Numbers of hashes that the sorted sets in rows share with each set.

    Hashes of many sets are counted as a product of matrices, others from lists of their sets; COUNTED
    hashes at a time, in ranges of their values.
    """
    m = len(sets)
    out = np.zeros((len(rows), m), np.float32)
    row_of = np.full(m, -1)
    row_of[rows] = np.arange(len(rows))
    parts = -(-sum(map(len, sets)) // COUNTED)
    bounds = np.uint64([(k << 64) // parts for k in range(1, parts)])
    cuts = [[0, *np.searchsorted(s, bounds).tolist(), len(s)] for s in sets]
    for part in range(parts):
        pieces = [s[c[part] : c[part + 1]] for s, c in zip(sets, cuts)]
        owner = np.repeat(np.arange(m), [len(p) for p in pieces])
        _, hashes, df = np.unique(np.concatenate(pieces), return_inverse=True, return_counts=True)
        wide = df > max(8, m // 16)
        for i in range(0, int(wide.sum()), COLUMNS):
            column = np.full(len(df), -1)
            chosen = np.flatnonzero(wide)[i : i + COLUMNS]
            column[chosen] = np.arange(len(chosen))
            at = column[hashes]
            has = np.zeros((m, len(chosen)), np.float32)
            has[owner[at >= 0], at[at >= 0]] = 1
            out += has[rows] @ has.T
        few = (df > 1) & ~wide
        mine, holder = hashes[few[hashes]], owner[few[hashes]]
        holders = holder[np.argsort(mine, kind="stable")]  # the sets of each hash, one hash after another
        sizes = np.where(few, df, 0)
        begins = np.cumsum(sizes) - sizes
        asked = row_of[holder] >= 0
        mine, holder = mine[asked], row_of[holder[asked]]
        ends = np.cumsum(sizes[mine])
        i = 0
        while i < len(mine):
            done = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + COUNTED)))
            each = sizes[mine[i:j]]
            first = np.repeat(begins[mine[i:j]] - (ends[i:j] - each - done), each)
            met = holders[first + np.arange(len(first))]
            np.add.at(out.ravel(), np.repeat(holder[i:j], each) * m + met, np.float32(1))
            i = j
    return out


def decided(members: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Links (a, b) between different components of each leaf, on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            reps, hashes = group.column("rep").to_numpy(), group.column("hashes").to_pylist()
            # A class may be there once for each side, a document with each of its texts.
            once = list(dict(zip(zip(reps.tolist(), hashes), range(len(reps)))).values())
            reps, hashes = reps[once], [np.frombuffer(hashes[i], np.uint64) for i in once]
            sizes = np.array([len(x) for x in hashes])
            component = group.column("component").to_numpy()[once]
            values, counts = np.unique(component, return_counts=True)
            rows = np.flatnonzero(component != values[counts.argmax()])
            found = set()
            for i, both in zip(rows.tolist(), _shared(hashes, rows) if len(rows) else ()):
                alike = 100 * both.astype(np.int64)
                alike = alike >= threshold.percent * (sizes + sizes[i] - both.astype(np.int64))
                others = np.flatnonzero(alike & (component != component[i]))
                while len(others):
                    j = others[0]
                    found.add((int(min(reps[i], reps[j])), int(max(reps[i], reps[j]))))
                    component[component == component[j]] = component[i]
                    others = others[component[others] != component[i]]
            yield _pairs(found)

    rows = members.join(sets, "rep").select("leaf", "rep", "component", "hashes")
    return (
        rows.repartition("leaf").sortWithinPartitions("leaf", "rep").mapInArrow(run, "a long, b long")
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of an edge (a, b) reaches."""
    edges = stored(_sorted_edges(edges), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _sorted_edges(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.withColumnRenamed("m", "b"))
        edges = stored(_sorted_edges(small), "links")
        # Sums that do not depend on order: nothing but these comes to the driver.
        now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(20)"))
        ).first()
        if now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = now


def _sorted_edges(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _alike(rows: DataFrame) -> DataFrame:
    """Nodes whose classes are alike on the whole, from some of them; rows are (node, size, ...)."""
    some = rows.where(
        F.pmod(F.xxhash64("rep", "node"), F.lit(1 << 20)) * F.col("size")
        < F.lit(LOOKED_AT * (1 << 20))
    ).select("node", "signature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            signature = matrix(group.column(1))
            n = len(signature)
            agree = np.mean([(signature == s).mean() for s in signature]) * n - 1
            if n > 1 and agree / (n - 1) >= ALIKE:
                yield pa.RecordBatch.from_arrays([group.column(0).combine_chunks()[:1]], ["node"])

    return some.repartition("node").sortWithinPartitions("node").mapInArrow(run, "node long")


def leaves_of(classes: DataFrame, trees: int) -> tuple[DataFrame, DataFrame | None]:
    """(leaf, side, rep): the leaves of all trees with at least two classes; and the whole nodes.

    Those are (node, rep, n), or None without any; their blocks are leaves with side -1.
    """
    nodes = branch(classes.select("rep", "signature"), trees)
    leaves, wholes = [], []
    for depth in range(1, DEEPEST + 1):
        nodes = stored(nodes, "nodes")
        sizes = nodes.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        sized = stored(nodes.join(sizes, "node"), "sized-nodes")
        leaves.append(
            sized.where(F.col("size") <= LEAF).select(F.col("node").alias("leaf"), F.lit(0).alias("side"), "rep")
        )
        large = sized.where(F.col("size") > LEAF)
        if large.isEmpty():
            break
        large = stored(large.join(classes.select("rep", "n", "signature"), "rep"), "large-nodes")
        if depth < DEEPEST:
            alike = stored(_alike(large.select("node", "size", "rep", "signature")), "alike-nodes")
            whole = large.join(alike, "node")
            nodes = branch(large.join(alike, "node", "left_anti").select("rep", "signature", "node"))
        else:
            whole = large
        wholes.append(whole.select("node", "rep", "n"))
        dealt = F.xxhash64("rep", "node")
        blocks = F.ceil(F.col("size") / (LEAF // 2)).cast("int")
        whole = whole.withColumn("blocks", blocks).withColumn("block", F.pmod(dealt, "blocks").cast("int"))
        # Bits other than those that deal the blocks choose the classes that all of them share.
        chosen = F.pmod(F.shiftright(dealt, 40), F.lit(1 << 20)) * F.col("size") < F.lit(PIVOTS * (1 << 20))
        shared = whole.where(chosen).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        )
        for rows in (whole, shared.where("other <> block").withColumn("block", F.col("other"))):
            leaves.append(
                rows.select(F.xxhash64("node", "block").alias("leaf"), F.lit(-1).alias("side"), "rep")
            )
    whole = stored(reduce(DataFrame.unionByName, wholes), "whole-nodes") if wholes else None
    return stored(reduce(DataFrame.unionByName, leaves), "leaves"), whole


def across(wholes: DataFrame) -> DataFrame:
    """(leaf, side, rep): leaves in which all classes of a whole node meet those outside its largest
    component; wholes is (node, rep, n, component).

    A node without others has no leaf. Side 1 is outside, side 2 is all.
    """
    parts = wholes.groupBy("node", "component").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    nodes = parts.groupBy("node").agg(
        F.max(F.struct("size", "n", "component")).alias("main"),
        F.sum("size").alias("size"),
        F.sum("n").alias("all_n"),
    )

    def blocks(size, n):
        return F.ceil(F.greatest(size / WIDE, n / WIDE_SHINGLES)).cast("int")

    nodes = nodes.where(F.col("size") > F.col("main.size")).select(
        "node",
        F.col("main.component").alias("main"),
        blocks(F.col("size") - F.col("main.size"), F.col("all_n") - F.col("main.n")).alias("few"),
        blocks(F.col("size"), F.col("all_n")).alias("all"),
    )
    rows = wholes.join(nodes, "node")
    dealt = F.xxhash64("rep", "node")
    sides = [
        (rows.where(F.col("component") != F.col("main")), "few", "all", ("own", "other")),
        (rows, "all", "few", ("other", "own")),
    ]
    return reduce(
        DataFrame.unionByName,
        (
            some.withColumn("own", F.pmod(dealt, own).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .select(F.xxhash64("node", *ends).alias("leaf"), F.lit(side).alias("side"), "rep")
            for side, (some, own, other, ends) in enumerate(sides, 1)
        ),
    )


def _maybe_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows without most of those whose doc_id is not in ids, before they are shuffled for a join.

    Ids are marked in a map of FILTER_BITS bits by their hash, which goes to all tasks whatever the
    number of ids; the more there are, the more other rows pass.
    """
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    marks = ids.select(
        F.bitmap_bucket_number(spread).alias("part"), F.bitmap_bit_position(spread).alias("bit")
    )
    marks = marks.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("marks"))
    bit = F.bitmap_bit_position(spread)
    byte = F.expr("cast(conv(hex(substring(marks, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)")
    return (
        rows.withColumn("part", F.bitmap_bucket_number(spread))
        .withColumn("bit", bit)
        .join(F.broadcast(marks), "part")
        .where(byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0)
        .select(*rows.columns)
    )


def _sets_of(texts: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(rep, hashes) of the texts whose doc_id is in wanted, which has no id twice."""
    # Not a semi-join: Spark moves it below the marks, and all texts are shuffled.
    asked = _maybe_among(texts, wanted).join(wanted, "doc_id").select("doc_id", "text")
    return stored(full_sets(asked, shingle), "near-sets")


def near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    shingle: int = 5,
    recall: float = 0.999999,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for each row of docs."""
    rows, last = with_row_keys(ids_and_texts(docs, id_col, text_col), "doc_id", "row_key")
    found = groups_of(rows.select(F.col("row_key").alias("doc_id"), "text"), percent, shingle, recall)
    return found.select(
        F.when(F.col("doc_id") <= last, F.col("doc_id")).alias("doc_id"),
        "n_shingles",
        F.when(F.col("component_id") <= last, F.col("component_id")).alias("component_id"),
        "kept",
    )


def one_of_each(docs: DataFrame, percent: int, shingle: int, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns."""
    key, name = unused_name(docs, "row_key"), unused_name(docs, "dropped_key")
    rows, _ = with_row_keys(docs, id_col, key)
    groups = groups_of(ids_and_texts(rows, key), percent, shingle)
    dropped = groups.where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return rows.join(dropped, F.col(key) == F.col(name), "left_anti").drop(key)


def groups_of(texts: DataFrame, percent: int, shingle: int, recall: float = 0.999999) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for texts with doc_id, which must not be null."""
    threshold = Threshold(percent)
    rows = stored(features(texts, shingle), "near-features")
    reps = rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    named = rows.where("n > 0").join(reps, "digest")
    members = stored(named.select("doc_id", "n", "rep"), "near-members")
    classes = named.where("doc_id = rep").select("rep", "n", "signature", "sketch")
    classes = stored(classes.dropDuplicates(["rep", "signature"]), "near-classes")

    leaves, wholes = leaves_of(classes, trees_for(percent / 100, recall))
    sketches = classes.select("rep", "n", "sketch")
    sketched = leaves.join(sketches, "rep")
    likely = stored(candidates(sketched, threshold), "near-candidates")
    pairs = stored(likely.select("a", "b").distinct(), "near-pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    wanted = stored(wanted, "near-wanted")
    sets = _sets_of(texts, wanted, shingle)
    same_id = (
        members.select("doc_id", "rep")
        .where("doc_id <> rep")
        .groupBy("doc_id")
        .agg(F.collect_set("rep").alias("reps"))  # the different texts of one id
        .select("doc_id", F.explode("reps").alias("rep"))
    )
    # A copy is linked with its class by its rep alone, unless its id has other texts too.
    several = members.groupBy("doc_id").agg(
        F.min("rep").alias("least"), F.max("rep").alias("most")
    ).where("least <> most")
    same_id = same_id.join(several.select("doc_id"), "doc_id", "left_semi")
    links = stored(
        confirmed(pairs, sets, threshold).unionByName(
            same_id.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        ),
        "near-links",
    )
    found = components(links)
    end = [
        found.select(F.col("id").alias(x), F.col("component").alias(f"component_{x}")) for x in "ab"
    ]
    apart = (
        likely.join(end[0], "a", "left")
        .join(end[1], "b", "left")
        .where(F.coalesce("component_a", "a") != F.coalesce("component_b", "b"))
    )
    still = stored(apart.select("leaf").distinct(), "near-open")
    again = sketched.where("side = 0").join(still, "leaf", "left_semi")

    def with_component(rows):
        rows = rows.join(found, F.col("rep") == F.col("id"), "left")
        return rows.withColumn("component", F.coalesce("component", "rep")).drop("id")

    if wholes is not None:
        meeting = stored(across(with_component(wholes)), "near-across")
        again = again.unionByName(meeting.join(sketches, "rep"))
    if wholes is not None or not still.isEmpty():
        again = with_component(again)
        open_rows = stored(undecided(again, threshold), "near-undecided")
        if wholes is not None:  # classes that were no one's candidates in the blocks of their nodes
            asked = open_rows.select(F.col("rep").alias("doc_id")).union(open_rows.select("other"))
            asked = asked.where("doc_id is not null").distinct().join(wanted, "doc_id", "left_anti")
            asked = stored(asked, "near-wanted")
            if not asked.isEmpty():
                sets = sets.unionByName(_sets_of(texts, asked, shingle))
        more_pairs = open_rows.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
        members_left = open_rows.where("other is null").drop("other")
        more = confirmed(more_pairs.distinct(), sets, threshold).unionByName(
            decided(members_left, sets, threshold)
        )
        more = stored(more, "near-more")
        if not more.isEmpty():
            known = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
            found = components(known.unionByName(more))
    in_class = members.join(found, members["rep"] == found["id"], "left").select(
        "doc_id", "n", F.coalesce("component", "rep").alias("component")
    )
    without = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))
    return in_class.unionByName(without).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        (F.col("doc_id") == F.col("component")).alias("kept"),
    )
