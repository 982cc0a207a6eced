"""Registered queries of this subpackage, one for each operator, and the SQL that checks them.

Each applies its operator with production parameters to the whole table and derives the digest
columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.llm import (
    decontam,
    hosts,
    licenses,
    lines,
    mixing,
    neardup,
    packing,
    phrases,
    pii,
    quality,
    spelling,
    substrings,
    tokens,
)
from roadbook.llm.shared import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = lambda spark, sf_dir: query(ship_package(spark), sf_dir.rstrip("/"))
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_digest(column: str):
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256)


@register
def op1_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", text_digest("text").alias("kept_sha256")
    )


@register
def op2_quality(spark, sf_dir):
    return quality.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@register
def op3_substring_dedup(spark, sf_dir):
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", text_digest("text").alias("kept_sha256"))


@register
def op4_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(table(spark, sf_dir, "documents"), path)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@register
def op5_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85, shingle=3)


@register
def op6_personal_data(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.spans_text("base"), 256).alias("base_sha256"),
        pii.spans_text("spans").alias("spans"),
    )


@register
def op7_license_scan(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@register
def op8_decontamination(spark, sf_dir):
    return decontam.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).select(
        "doc_id",
        "item_id",
        "first_word",
        "n_words",
        F.round("cosine", 4).alias("cosine"),
        F.round("cover", 4).alias("cover"),
    )


@register
def op9_token_counts(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    return tokens.token_counts(table(spark, sf_dir, "documents"), path)


@register
def op10_host_rules(spark, sf_dir):
    judged = hosts.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@register
def op11_source_mixture(spark, sf_dir):
    return mixing.taken_rows(mixing.mixture(table(spark, sf_dir, "documents")))


@register
def op12_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@register
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(spelling.words_of(table(spark, sf_dir, "documents")))


# CRC-32 of a string in DuckDB, which has no function for it: eight steps for each byte.
CRC32_BYTE = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END::UBIGINT)"

CHECKED_BY = {
    "op1_line_dedup": r"""
        WITH cut AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), line AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM cut
        ), keyed AS (
            SELECT *, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM line
        ), owned AS (
            SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1
        ), told AS (
            SELECT doc_id, line, place, owner IS NOT NULL AND owner <> doc_id AS gone
            FROM keyed LEFT JOIN owned USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), ''))
                AS kept_sha256
        FROM told GROUP BY doc_id""",
    "op3_substring_dedup": r"""
        WITH cut AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), spot AS (
            SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM cut WHERE len(w) > 19
        ), placed AS (
            SELECT doc_id, i, row_number() OVER (
                PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS nth FROM spot
        ), gone AS (
            SELECT DISTINCT doc_id, i + k AS i
            FROM placed, (SELECT unnest(range(0, 20)) AS k) WHERE nth > 1
        ), word AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM cut
        ), told AS (
            SELECT word.doc_id, word, word.i, gone.i IS NOT NULL AS removed
            FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i
        ), kept AS (
            SELECT doc_id, count(*) FILTER (removed) AS n_removed,
                string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS text
            FROM told GROUP BY doc_id
        )
        SELECT cut.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
            sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM cut LEFT JOIN kept ON cut.doc_id = kept.doc_id""",
    "op5_near_duplicates": r"""
        WITH RECURSIVE cut AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingle AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM cut
                WHERE len(w) > 0)
        ), size AS (
            SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
        ), pair AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
            FROM shingle AS x JOIN shingle AS y ON x.s = y.s AND x.doc_id < y.doc_id
            GROUP BY x.doc_id, y.doc_id
        ), link AS (
            SELECT a, b FROM pair JOIN size AS x ON x.doc_id = a JOIN size AS y ON y.doc_id = b
            WHERE 100 * shared >= 85 * (x.n + y.n - shared)
        ), either AS (
            SELECT a, b FROM link UNION ALL SELECT b, a FROM link
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT reach.doc_id, either.b FROM reach JOIN either ON either.a = reach.other
        ), least AS (
            SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM least LEFT JOIN size USING (doc_id)""",
    "op10_host_rules": r"""
        WITH cut AS (
            SELECT doc_id, source, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                [x FOR x IN string_split(coalesce(text, ''), chr(10))
                    IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
            FROM documents
        ), spot AS (
            SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut WHERE len(w) > 2
        ), twice AS (
            SELECT doc_id, unnest(list(i)) AS i FROM spot
            GROUP BY doc_id, w[i], w[i + 1], w[i + 2] HAVING count(*) > 1
        ), covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
            FROM twice, (VALUES (0), (1), (2)) AS step(k) GROUP BY doc_id
        ), measured AS (
            SELECT doc_id, source, len(w) AS n_words,
                coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                len(lines) AS n_lines,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM cut LEFT JOIN covered USING (doc_id)
        ), judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
        ), host AS (
            SELECT source, count(*) AS n, sum((base_failed OR 100 * n_symbols > 50 * n_words
                OR 100 * n_dup_lines > 30 * n_lines)::INT) AS f
            FROM judged WHERE source IS NOT NULL GROUP BY source
        ), prior AS (
            SELECT avg(f / n) AS m, avg(n) AS mean_n, var_pop(f / n) AS v FROM host
        ), bad AS (
            SELECT source FROM host, prior
            WHERE (f + m * greatest(1, least(mean_n, CASE WHEN v > 0 THEN m * (1 - m) / v - 1
                    ELSE mean_n END)))
                / (n + greatest(1, least(mean_n, CASE WHEN v > 0 THEN m * (1 - m) / v - 1
                    ELSE mean_n END))) > 0.5
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
        FROM judged""",
    "op12_collocations": r"""
        WITH piece AS (
            SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
        ), cut AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
        ), gram AS (
            SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
            FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM cut, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(w) >= size)
        ), freq AS (
            SELECT lang, size, phrase, count(*) AS a FROM gram GROUP BY lang, size, phrase
        ), total AS (
            SELECT lang, sum(a)::BIGINT AS n FROM freq WHERE size = 1 GROUP BY lang
        ), candidate AS (
            SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM freq
            WHERE size > 1 AND a >= 30
        ), part AS (
            SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS p,
                array_to_string(w[k + 1:], ' ') AS q
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate)
        ), scored AS (
            SELECT part.lang, part.phrase, part.a, k, x.a AS l, y.a AS r,
                (2000000::HUGEINT * part.a // (x.a + y.a))::BIGINT AS score
            FROM part JOIN freq AS x ON x.lang = part.lang AND x.phrase = p
            JOIN freq AS y ON y.lang = part.lang AND y.phrase = q
        ), lowest AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inside AS (
            SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
            FROM (SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS i
                FROM candidate, (VALUES (2), (3)) AS lengths(m) WHERE size > m)
        ), longer AS (
            SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase
        ), ranked AS (
            SELECT lowest.*, row_number() OVER (PARTITION BY lang
                ORDER BY score DESC, a DESC, phrase) AS rank
            FROM lowest LEFT JOIN longer USING (lang, phrase)
            WHERE most IS NULL OR 100 * most < 80 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang)
        WHERE rank <= 2000""",
    "op13_spelling_variants": rf"""
        WITH RECURSIVE crc_table AS (
            SELECT list(c ORDER BY i) AS t FROM (SELECT i,
                list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]), lambda c, x: {CRC32_BYTE}) AS c
                FROM (SELECT unnest(range(256)) AS i))
        ), run AS (
            SELECT doc_id, run, count(*) AS times FROM (
                SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''),
                    '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
                FROM documents)
            WHERE length(run) > 6 GROUP BY doc_id, run
        ), marked AS (
            SELECT run, times, xor(list_reduce(list_prepend(4294967295::UBIGINT, [
                    ('0x' || hex[2 * i - 1:2 * i])::UBIGINT FOR i IN range(1, length(hex) // 2 + 1)]),
                lambda c, b: xor(c >> 8, t[(xor(c, b) % 256)::BIGINT + 1])), 4294967295::UBIGINT) AS h
            FROM (SELECT run, times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hex
                FROM run), crc_table
        ), shortened AS (
            SELECT times, CASE WHEN h % 31 = 0
                THEN run[:(h % length(run))::INT] || run[(h % length(run))::INT + 2:]
                ELSE run END AS word
            FROM marked
        ), word AS (
            SELECT word, sum(times)::BIGINT AS n FROM shortened WHERE length(word) > 6
            GROUP BY word HAVING sum(times) > 1
        ), shorter AS (
            SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
        ), near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM shorter AS a JOIN shorter AS b
                ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM shorter AS a JOIN word AS b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM shorter AS a JOIN word AS b ON a.rest = b.word
        ), best AS (
            SELECT word, min(other) AS other, any_value(most) AS most
            FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS most FROM near)
            WHERE other_n = most GROUP BY word
        ), counted AS (
            SELECT word, count(*) AS n_near FROM near GROUP BY word
        ), formed AS (
            SELECT word.word, n, coalesce(counted.n_near, 0) AS n_near,
                CASE WHEN most >= 10 * n THEN other END AS form,
                CASE WHEN most >= 10 * n THEN most END AS form_n
            FROM word LEFT JOIN best USING (word) LEFT JOIN counted ON counted.word = word.word
        ), chain AS (
            SELECT word, word AS root FROM formed
            UNION SELECT chain.word, formed.form FROM chain JOIN formed
                ON formed.word = chain.root AND formed.form IS NOT NULL
        ), ended AS (
            SELECT chain.word, chain.root FROM chain JOIN formed ON formed.word = chain.root
            WHERE formed.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN ended USING (word)""",
}
