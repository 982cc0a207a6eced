"""Personal data by candidate gradient boosting, on DataFrame and SQL functions alone.

Base patterns with their checks give spans that always count. Generators of high recall propose
further spans, which may overlap those and each other: obfuscated addresses, numbers with other
separators, telephone numbers without a plus. Boosted trees score each proposal from its format and
its context. They are trained on proposals from the corpus: one that a checked base span of its kind
overlaps is an example, any other is not. The trees see a proposal in one spelling, without what the
base patterns ask for (the at-sign and dots, the separators, the plus and the country), so that a
base span and the same thing written otherwise look alike to them.

No table says which proposals are personal data, so thresholds follow from examples and two other
classes. Refuted proposals are known not to be what they look like: their digits fail the check, or a
base span of another kind explains them. Open ones are neither. On documents held out from training,
a kind's threshold is the lowest score above which at least ``PRECISION`` of examples and refuted
ones are examples, and examples are nearly (``EVENLY``) as large a share of examples and open ones as
in the surest half. What the trees can tell from the examples thins out below that score; what they
cannot is mixed in evenly, and is added. The trees are written out as SQL, so that scoring is part
of the plan.

Bounds: at most ``SAMPLE`` proposals of each kind, those of smallest hash, are trained on: rows of a
dozen numbers. All held-out proposals calibrate, summed up by score in thousandths. All documents
are searched whole; matches are placed in blocks, so that the work is not the square of their number.

Defined results: a null or empty text has no span; positions are code points, end exclusive; a
proposal that overlaps a base span of any kind is not added. A kind with fewer than ``FEWEST`` examples
held out, or a corpus without proposals other than examples, gets nothing added. Repeated rows are
searched each.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.shared import stored
from roadbook.llm.words import ids_and_texts

KINDS = ("email", "ip", "card", "phone")
SAMPLE, TREES, DEPTH = 5_000, 8, 3
PRECISION, EVENLY, FEWEST = 0.98, 0.9, 20
CONTEXT, BLOCK = 24, 256

_LOCAL = "A-Za-z0-9._%+-"
# The base patterns. A match of theirs starts where a run of its first characters does, or where the
# match before it ended; saying so keeps the search linear.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:[.,]\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){7,14}(?![0-9])",
}
# What a text must contain at all for a pattern to be worth trying.
_NEEDS = {"email": "[@\\[(]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}

FEATURES = (
    "kind_no",
    "chars",
    "digits",
    "letters",
    "marks",
    "groups",
    "longest_group",
    "letter_before",
    "letter_after",
    "sign_before",
    "word_before",
    "count_before",
)
# Words that announce such data, in a few languages: fixed values.
ANNOUNCED = "mail|e-mail|tel|phone|call|fax|mobile|card|visa|credit|ip|host|server|address|contact"
# Words that announce other numbers: fixed values.
COUNTED = "order|invoice|number|ref|serial|isbn|version|page|year|code|ticket|item"


_SPAN = "STRUCT<start: INT, end: INT, found: STRING, before: STRING, after: STRING>"
_JUDGED = f"STRUCT<x: {_SPAN}, example: BOOLEAN, explained: BOOLEAN>"


def _positions(matches: str, gaps: str) -> str:
    """SQL: spans from what a pattern matched and what lay between, with what is beside each."""
    m, g = f"{matches}[i]", f"{gaps}[i]"
    return f"""aggregate(
        sequence(0, CAST((size({matches}) - 1) div {BLOCK} AS INT)),
        named_struct('at', 0, 'out', CAST(array() AS ARRAY<ARRAY<{_SPAN}>>)),
        (s, b) -> aggregate(
            sequence(b * {BLOCK}, least(size({matches}), (b + 1) * {BLOCK}) - 1),
            named_struct('at', s.at, 'out', CAST(array() AS ARRAY<{_SPAN}>)),
            (t, i) -> named_struct(
                'at', t.at + length({g}) + length({m}),
                'out', concat(t.out, array(named_struct(
                    'start', t.at + length({g}),
                    'end', t.at + length({g}) + length({m}),
                    'found', {m},
                    'before', right(concat(IF(i > 0, {matches}[i - 1], ''), {g}), {CONTEXT}),
                    'after', left({gaps}[i + 1], 1))))),
            t -> named_struct('at', t.at, 'out', concat(s.out, array(t.out)))),
        s -> flatten(s.out))"""


def _judged(events: str) -> str:
    """SQL: the proposals among the events, in order of their start, and what overlaps them.

    Events are structs (start, flag, x) sorted by start; flag is 0 for a base span of the kind, 1 for
    one of another kind and 2 for a proposal. Proposals do not overlap each other, so that of a span
    only the proposal open at its start, and of a proposal only the furthest end so far matters.
    """

    def state(own: str, other: str, pending: str, out: str) -> str:
        return f"named_struct('own', {own}, 'other', {other}, 'pending', {pending}, 'out', {out})"

    def marked(example: str, explained: str) -> str:
        return f"""IF(t.pending IS NULL, CAST(NULL AS {_JUDGED}), named_struct('x', t.pending.x,
            'example', t.pending.example OR {example},
            'explained', t.pending.explained OR {explained}))"""

    e = f"{events}[i]"
    inside = f"t.pending.x.end > {e}.start"
    opened = f"""named_struct('x', {e}.x, 'example', t.own > {e}.start,
        'explained', t.other > {e}.start)"""
    closed = "IF(t.pending IS NULL, t.out, concat(t.out, array(t.pending)))"
    return f"""aggregate(
        sequence(0, CAST((size({events}) - 1) div {BLOCK} AS INT)),
        {state("0", "0", f"CAST(NULL AS {_JUDGED})", f"CAST(array() AS ARRAY<ARRAY<{_JUDGED}>>)")},
        (s, b) -> aggregate(
            sequence(b * {BLOCK}, least(size({events}), (b + 1) * {BLOCK}) - 1),
            {state("s.own", "s.other", "s.pending", f"CAST(array() AS ARRAY<{_JUDGED}>)")},
            (t, i) -> CASE
                WHEN {e}.flag = 2 THEN {state("t.own", "t.other", opened, closed)}
                WHEN {e}.flag = 0 THEN
                    {state(f"greatest(t.own, {e}.x.end)", "t.other", marked(inside, "false"), "t.out")}
                ELSE {state("t.own", f"greatest(t.other, {e}.x.end)", marked("false", inside), "t.out")}
                END,
            t -> {state("t.own", "t.other", "t.pending", "concat(s.out, array(t.out))")}),
        s -> IF(s.pending IS NULL, flatten(s.out), concat(flatten(s.out), array(s.pending))))"""


_NONE = f"CAST(array() AS ARRAY<{_SPAN}>)"


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _find(df: DataFrame, name: str, pattern: str, needs: str) -> DataFrame:
    """Adds a column of all matches with their places."""
    quoted = _quoted(pattern)
    tried = F.expr(
        f"CASE WHEN text RLIKE '{_quoted(needs)}' THEN regexp_extract_all(text, '{quoted}', 0) "
        "ELSE CAST(array() AS ARRAY<STRING>) END"
    )
    spans = f"""CASE WHEN size({name}_m) = 0 THEN {_NONE}
        ELSE {_positions(f"{name}_m", f"{name}_g")} END"""
    gaps = F.expr(
        f"CASE WHEN size({name}_m) = 0 THEN CAST(array() AS ARRAY<STRING>) "
        f"ELSE split(text, '{quoted}', -1) END"
    )
    found = df.withColumn(f"{name}_m", tried).withColumn(f"{name}_g", gaps)
    return found.withColumn(name, F.expr(spans)).drop(f"{name}_m", f"{name}_g")


_DIGITS = "regexp_replace(x.found, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + CASE
    WHEN i % 2 = 1 THEN CAST(substring(reverse({_DIGITS}), i, 1) AS INT)
    WHEN substring(reverse({_DIGITS}), i, 1) >= '5'
        THEN 2 * CAST(substring(reverse({_DIGITS}), i, 1) AS INT) - 9
    ELSE 2 * CAST(substring(reverse({_DIGITS}), i, 1) AS INT) END) % 10 = 0"""
CHECKS = {
    "email": "true",
    "ip": "forall(split(x.found, '[.]'), p -> length(trim(LEADING '0' FROM p)) <= 3 AND "
    "coalesce(CAST(nullif(trim(LEADING '0' FROM p), '') AS INT), 0) <= 255)",
    "card": f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}


# A proposal in the one spelling that the trees see.
SHOWN = {
    "email": r"regexp_replace(regexp_replace(x.found, '\x20?[\[(]at[\])]\x20?', '@'), "
    r"'\x20?[\[(]dot[\])]\x20?', '.')",
    "ip": r"regexp_replace(x.found, '[.,]\x20?', '.')",
    "card": "regexp_replace(x.found, '[./-]', ' ')",
    "phone": r"regexp_replace(regexp_replace(x.found, '^[+][0-9]{1,3}[\x20.(-]+', ''), '^[+(]+', '')",
}


def _features(kind: str) -> str:
    """SQL: proposals of one kind with the numbers that the trees see, from judged_<kind>."""
    groups = "filter(split(x.shown, '[^0-9A-Za-z]+'), g -> g <> '')"
    # Of a telephone number, whether its digits are too many or too few is left to the generator.
    check = "true" if kind == "phone" else CHECKS[kind]
    return f"""transform(transform(judged_{kind}, j -> named_struct(
            'start', j.x.start, 'end', j.x.end, 'found', j.x.found, 'before', j.x.before,
            'after', j.x.after, 'example', j.example, 'explained', j.explained,
            'shown', {SHOWN[kind].replace(chr(92), chr(92) * 2).replace("x.found", "j.x.found")})),
        x -> named_struct(
        'start', x.start, 'end', x.end,
        'example', x.example,
        'refuted', NOT x.example AND (x.explained OR NOT ({check.replace("x.found", "x.shown")})),
        'kind_no', {KINDS.index(kind)},
        'chars', length(x.shown),
        'digits', length(regexp_replace(x.shown, '[^0-9]', '')),
        'letters', length(regexp_replace(x.shown, '[^A-Za-z]', '')),
        'marks', length(regexp_replace(x.shown, '[0-9A-Za-z+]', '')),
        'groups', size({groups}),
        'longest_group', coalesce(array_max(transform({groups}, g -> length(g))), 0),
        'letter_before', CAST(x.before RLIKE '[A-Za-z]$' AS INT),
        'letter_after', CAST(x.after RLIKE '^[A-Za-z]' AS INT),
        'sign_before', CAST(x.before RLIKE '[#=/_"-]$' AS INT),
        'word_before', CAST(lower(x.before) RLIKE '({ANNOUNCED})' AS INT),
        'count_before', CAST(lower(x.before) RLIKE '({COUNTED})' AS INT)))"""


def search(docs: DataFrame) -> DataFrame:
    """doc_id, base_<kind> and proposals of each row, for docs with doc_id and text."""
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind in KINDS:
        found = _find(found, f"base_{kind}", BASE[kind], "@" if kind == "email" else _NEEDS[kind])
        found = found.withColumn(
            f"base_{kind}",
            F.expr(
                f"transform(filter(base_{kind}, x -> {CHECKS[kind].replace(chr(92), chr(92) * 2)}), "
                "x -> struct(x.start, x.end))"
            ),
        )
    for kind in KINDS:
        found = _find(found, f"proposed_{kind}", PROPOSED[kind], _NEEDS[kind])
        flagged = [
            f"transform(proposed_{kind}, x -> named_struct('start', x.start, 'flag', 2, 'x', x))",
            *[
                f"transform(base_{k}, x -> named_struct('start', x.start, 'flag', {int(k != kind)}, 'x', "
                "named_struct('start', x.start, 'end', x.end, 'found', '', 'before', '', 'after', '')))"
                for k in KINDS
            ],
        ]
        found = found.withColumn(
            f"events_{kind}",
            F.expr(
                f"CASE WHEN size(proposed_{kind}) > 0 THEN sort_array(concat({', '.join(flagged)})) END"
            ),
        )
        judged = f"CASE WHEN events_{kind} IS NULL THEN CAST(array() AS ARRAY<{_JUDGED}>) ELSE "
        found = found.withColumn(f"judged_{kind}", F.expr(f"{judged}{_judged(f'events_{kind}')} END"))
        found = found.withColumn(f"features_{kind}", F.expr(_features(kind)))
        found = found.drop(f"proposed_{kind}", f"events_{kind}", f"judged_{kind}")
    proposals = F.concat(*[f"features_{k}" for k in KINDS]).alias("proposals")
    return found.select("doc_id", *[f"base_{k}" for k in KINDS], proposals)


def tree_sql(description: str) -> str:
    """SQL of one regression tree from its description."""
    lines = [line.strip() for line in description.splitlines()]
    lines = [x for x in lines if x.startswith(("If", "Else", "Predict"))]

    def node(at: int) -> tuple[str, int]:
        if lines[at].startswith("Predict"):
            return lines[at].split(":")[1].strip(), at + 1
        feature, value = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
        left, at = node(at + 1)
        right, at = node(at + 1)  # past the line of Else
        return f"CASE WHEN x.{FEATURES[int(feature)]} <= {value} THEN {left} ELSE {right} END", at

    return node(0)[0]


def thresholds(steps: list[tuple[int, ...]], kinds: int = len(KINDS)) -> dict[int, int]:
    """The least step that is accepted, for each kind that has one.

    steps are (kind, step, examples, refuted, open), one for each kind and step of the score.
    """
    found: dict[int, int] = {}
    for kind in range(kinds):
        tail, above = [], [0, 0, 0]
        for _, step, *counts in sorted((s for s in steps if s[0] == kind), key=lambda s: -s[1]):
            above = [x + y for x, y in zip(above, counts)]
            tail.append((step, *above))
        least = max(FEWEST, above[0] / 2)
        sure = [good / (good + unknown) for _, good, _, unknown in tail if good >= least]
        for step, good, refuted, unknown in tail:
            precise = good >= PRECISION * (good + refuted)
            if good >= FEWEST and sure and precise and good >= EVENLY * max(sure) * (good + unknown):
                found[kind] = step
    return found


def train(proposals: DataFrame) -> tuple[str, dict[int, int]] | None:
    """SQL of the score of a proposal x in thousandths, and a threshold for each kind that has one.

    proposals has one row for each proposal, with doc_id.
    """
    order = F.xxhash64("doc_id", "start", "end", "kind_no")
    held_out = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0
    rows = proposals.withColumn("label", F.col("example").cast("double")).withColumn("order", order)
    fitted = None
    for number in range(len(KINDS)):
        own = rows.where(~held_out & (F.col("kind_no") == number))
        own = own.orderBy("order", "doc_id", "start", "end").limit(SAMPLE)
        fitted = own if fitted is None else fitted.unionByName(own)
    fitted = stored(fitted, "pii-sample")
    if fitted.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(fitted)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, cacheNodeIds=False).fit(vectors)
    score = " + ".join(
        f"{weight!r} * ({tree_sql(tree.toDebugString)})"
        for weight, tree in zip(model.treeWeights, model.trees)
    )
    score = f"floor(1000 * ({score}))"
    held = rows.where(held_out).select("example", "refuted", F.struct(*FEATURES).alias("x"))
    steps = (
        held.groupBy(F.col("x.kind_no").alias("kind"), F.expr(score).alias("step"))
        .agg(
            F.count_if("example").alias("examples"),
            F.count_if("refuted").alias("refuted"),
            F.count_if(~F.col("example") & ~F.col("refuted")).alias("open"),
        )
        .collect()  # some thousand rows at most: scores of a few small trees lie between -4 and 4
    )
    return score, thresholds([tuple(s) for s in steps])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base_<kind> and spans_<kind> (arrays of start, end) for each row of docs."""
    found = stored(search(ids_and_texts(docs, id_col, text_col)), "pii-spans")
    trained = train(found.select("doc_id", F.explode("proposals").alias("x")).select("doc_id", "x.*"))
    for number, kind in enumerate(KINDS):
        spans = F.col(f"base_{kind}")
        if trained and number in trained[1]:
            score, least = trained
            added = F.expr(
                f"transform(filter(proposals, x -> x.kind_no = {number} AND NOT x.example AND "
                f"NOT x.refuted AND {score} >= {least[number]}), x -> struct(x.start, x.end))"
            )
            spans = F.array_sort(F.concat(spans, added))
        found = found.withColumn(f"spans_{kind}", spans)
    return found.drop("proposals")


def spans_text(prefix: str):
    """kind:start:end of all spans by kind, then start, joined by commas."""
    parts = [
        F.expr(f"transform({prefix}_{kind}, x -> concat('{kind}:', x.start, ':', x.end))")
        for kind in KINDS
    ]
    return F.array_join(F.concat(*parts), ",")
