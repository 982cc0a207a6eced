"""Source mixture, collocations and spelling variants against plain Python on small tables."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from roadbook.llm import mixing, phrases, spelling
from roadbook.llm.queries import CHECKED_BY, QUERIES
from roadbook.llm.shared import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def table(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


# --- mixture ----------------------------------------------------------------------------------

MIX = "doc_id long, text string, source string, copy int, size int"


def mix_rows(seed=1, sources=("a", "b", "ü", "z", None), each=60):
    rng = random.Random(seed)
    rows = []
    for number, source in enumerate(sources):
        for i in range(each * (1 + 3 * (number == 0))):
            words = rng.choice([1, 2, 3, 5, 8, 20, 60, 200])
            rows.append((len(rows), " ".join(["w"] * words), source, i, -1))
    return rows


def targets(rows, weights=(5, 2, 1), most=3):
    sizes = Counter()
    for _, text, source, *_ in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, cut = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in cut]
        left = total - sum(most * sizes[s] for s in cut)
        level = Fraction(left, max(1, sum(weight[s] for s in rest)))
        above = {s for s in rest if weight[s] * level > most * sizes[s]}
        if not above:
            return sizes, {s: most * sizes[s] if s in cut else float(weight[s] * level) for s in order}
        cut |= above


def check_mixture(rows, got, by_id=True):
    sizes, target = targets(rows)
    assert len(got) == len(rows)
    source_of = {r[0]: r[2] for r in rows}
    taken = Counter()
    for r in got:
        if by_id:
            source = source_of[r.doc_id]
            assert r.source_size == sizes[source] and r.target == target[source]
            taken[source] += r.taken
        assert r.taken == 0 if r.size == 0 else r.taken % r.size == 0 and r.taken <= 3 * r.size
    return taken, target


def test_mixture_meets_its_targets(spark):
    rows = mix_rows() + [(9000, None, "a", 0, 0), (9001, " \t\n", "b", 0, 0), (9002, "", "only empty", 0, 0)]
    docs = table(spark, rows, MIX)
    got = mixing.taken_rows(mixing.mixture(docs)).collect()
    taken, target = check_mixture(rows, got)
    for source in target:
        assert abs(taken[source] - target[source]) <= 200, source  # the longest document
    again = mixing.taken_rows(mixing.mixture(docs.repartition(7))).collect()
    assert sorted(got) == sorted(again)


def test_mixture_in_a_deep_tree_of_small_chains(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rows = mix_rows(2, each=40)
    taken, target = check_mixture(rows, mixing.taken_rows(mixing.mixture(table(spark, rows, MIX))).collect())
    for source in target:
        assert abs(taken[source] - target[source]) <= 200, source


@pytest.mark.parametrize("alike", [0, 30, 100])
def test_pairs_keep_the_words_and_every_expectation(alike):
    rng = random.Random(5)
    sizes = [rng.choice([1, 2, 5, 20, 100]) for _ in range(100)]
    sizes = sorted(sizes[:alike], reverse=True) + sorted(sizes[alike:], reverse=True)
    open_ = [rng.uniform(0.01, 0.99) for _ in range(alike)] + [0.37] * (100 - alike)
    due = sum(s * p for s, p in zip(sizes, open_))
    seen, runs, left = [0.0] * 100, 4000, 0
    for _ in range(runs):
        end = mixing.pivot(sizes, open_, alike, rng, alone=False)
        assert sum(0 < p < 1 for p in end) <= 1 and min(end) >= 0 and max(end) <= 1
        assert abs(sum(s * p for s, p in zip(sizes, end)) - due) < 1e-6
        left += max((s for s, p in zip(sizes, end) if 0 < p < 1), default=0)
        seen = [a + b for a, b in zip(seen, end)]
    for p, total in zip(open_, seen):
        assert abs(total / runs - p) < 4.5 * (p * (1 - p) / runs) ** 0.5
    assert left / runs < {0: 8, 30: 15, 100: 100}[alike]  # what is left over of alike ones is short
    assert all(p in (0, 1) for p in mixing.pivot(sizes, open_, alike, rng, alone=True))


def test_mixture_of_repeated_rows_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_AT_ONCE", 100)
    rows = [(None, "one two", "hot", 0, 0)] * 950 + [(7, "one", "hot", 0, 0)] * 30
    rows += [(None, f"w{i} x y", None, 0, 0) for i in range(50)] + [(8, "a b", "q", 0, 0), (8, "c", "q", 0, 0)]
    docs = table(spark, rows, MIX)
    plan = mixing.mixture(docs).persist()
    got = mixing.taken_rows(plan).collect()
    check_mixture(rows, got, by_id=False)
    _, target = targets(rows)
    by_target = Counter()
    for r in got:
        by_target[r.target] += r.taken
    for source, t in target.items():
        assert abs(by_target[t] - t) <= 3, source
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    chosen = mixing.take(docs, plan).collect()
    assert sum(len(r.text.split()) for r in chosen) == sum(r.taken for r in got)
    assert chosen[0].asDict().keys() == {*docs.columns, "_copy"}


def test_mixture_of_nothing(spark):
    assert mixing.taken_rows(mixing.mixture(table(spark, [], MIX))).count() == 0
    rows = [(1, "", "a", 0, 0), (2, None, None, 0, 0)]
    got = mixing.taken_rows(mixing.mixture(table(spark, rows, MIX))).collect()
    assert [(r.target, r.taken) for r in got] == [(0, 0), (0, 0)]


# --- collocations -----------------------------------------------------------------------------


def brute_collocations(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, freq in counts.items():
        candidates = {p: a for p, a in freq.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            cuts = [(2000000 * a // (freq[p[:k]] + freq[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [
                b
                for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * b >= 80 * a for b in longer):
                phrase = " ".join(p)
                found.append((-score, -a, phrase.encode(), phrase, a, freq[p[:k]], freq[p[k:]], score))
        for rank, (_, _, _, phrase, a, left, right, score) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase, a, left, right, total[lang], score))
    return sorted(out)


def test_collocations(spark):
    rng = random.Random(3)
    words = ["of", "the", "End", "ÉTÉ", "straße", "a", "b", "c", "dd", "日本", "x_y", "naïve"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0c"]) for _ in range(60))
        rows.append((text, rng.choice(["en", "fr", None])))
    rows += [("New York City hall is here", "en")] * 40 + [(None, "en"), ("", None), ("...", "en"), ("\xa0 \x85", "fr")]
    rows += [("one two " * 4000, "de"), ("one two three four five six seven " * 20, "de")]
    docs = table(spark, rows, "text string, lang string").selectExpr("*", "1 as n", "'x' as phrase").repartition(4)
    for least, top in ((30, 2000), (5, 40)):
        got = phrases.collocations(docs, least, top).collect()
        assert sorted(map(tuple, got)) == brute_collocations(rows, least, top)


def test_parse_owns_each_word_once(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefghij") + rng.choice([" ", " ", ". ", "\n"]) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    docs = table(spark, [(t, "en") for t in texts], "text string, lang string")
    parsed = phrases.dictionary(docs).collect()
    assert sum(r.owned * r.n for r in parsed) == sum(len(re.findall("[a-z]", t)) for t in texts)
    chunks = [[w for w in r.chunk.split(" ") if w != "."] for r in parsed]
    assert all(r.owned <= len(words) <= r.owned + 3 for r, words in zip(parsed, chunks))
    assert all(not r.chunk.startswith(".") and not r.chunk.endswith(".") for r in parsed)
    assert any(r.n > 1 for r in parsed)


def test_nothing_is_lost_where_all_marks_are_set(spark, monkeypatch):
    rows = [("alpha beta gamma delta epsilon", "en")] * 6 + [("beta gamma zeta", "en")] * 3
    expected = brute_collocations(rows, 5, 10)
    docs = table(spark, rows, "text string, lang string")
    monkeypatch.setattr(phrases, "_marked", lambda hashes: phrases.np.full(1 << 23, 255, "uint8"))
    assert sorted(map(tuple, phrases.collocations(docs, 5, 10).collect())) == expected


def test_collocations_of_nothing(spark):
    assert phrases.collocations(table(spark, [], "text string, lang string")).count() == 0


# --- spelling variants ------------------------------------------------------------------------


def words_by_hand(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants_by_hand(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and is_near(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def edited(word, rng, letters):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])


def test_spelling_variants(spark):
    rng = random.Random(6)
    letters = "abÀÿé×z"
    words = {}
    for base in ["aaaaaaa", "abababab", "letters", "êtreàlà", "b" * 62, "ab" * 32, "a" * 300, "z" + "ab" * 600]:
        family = [base]
        for _ in range(25):
            family.append(edited(rng.choice(family), rng, letters))
        for w in family:
            if len(w) >= 7:
                words[w] = rng.choice([2, 2, 3, 20, 25, 250, 2600])
    got = spelling.variants(table(spark, list(words.items()), "word string, n int").repartition(5))
    expected = variants_by_hand(words)
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert sum(e[4] for e in expected) > 200 and len({e[2] for e in expected}) < len(expected)
    assert any(len(e[0]) > 64 and e[1] for e in expected)


def test_words_of_texts(spark):
    rng = random.Random(8)
    runs = ["Letters", "letters", "ÉCOLES", "straßen", "garçons", "x", "abcdefgh", "Ægypten"]
    rows = [(i if i % 5 else None, rng.choice([" ", "7", "-"]).join(rng.choices(runs, k=30))) for i in range(200)]
    rows += [(1, None), (2, ""), (None, "日本 123"), (3, "q" * 5000 + " " + "q" * 5000)] + [(9, "Letters letters")] * 3
    docs = table(spark, rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as word")
    got = {r.word: r.n for r in spelling.words_of(docs).collect()}
    assert got == words_by_hand(rows)


def test_spelling_of_nothing(spark):
    assert spelling.variants(spelling.words_of(table(spark, [], "doc_id long, text string"))).count() == 0


@pytest.mark.parametrize("name", ["op12_collocations", "op13_spelling_variants"])
def test_queries_equal_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    result = con.execute(CHECKED_BY[name])
    columns = [c[0] for c in result.description]
    found = sorted(map(tuple, QUERIES[name](spark, folder).select(columns).collect()), key=repr)
    assert found == sorted(result.fetchall(), key=repr) and found
