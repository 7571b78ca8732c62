"""The registered queries of the text operators, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    decontaminate, exact_dedup, filter_audit, kneser_ney, language, line_dedup, packing, ppm, secret_scan, simhash, substring,
    toxicity, vector_codes,
)
from ledgerloom.llm.common import remainder, table

Query = Callable[[SparkSession, str], DataFrame]
#: Words of a shingle and bits of distance of the near-duplicate fingerprints.
SHINGLE, RADIUS = 3, 2
#: Words of a window that must not repeat; words from which on a repeated run of lines must not.
WINDOW, MIN_WORDS = 35, 5
#: Part positions, entries of a codebook and rounds of the vector codes; units of a vector component.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public tokenizer's file; on a cluster the file lies at the same place on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 5) == 0
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(table(spark, sf_dir, "documents"), SHINGLE, RADIUS)


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(table(spark, sf_dir, "documents"), remainder("doc_id", 5) == 1)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(table(spark, sf_dir, "documents"), WINDOW).drop("kept")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"), MIN_WORDS)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 1024, 0)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.found_secrets(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"), PARTS, ENTRIES, ROUNDS, SCALE)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


REGISTRY: dict[str, Query] = {f.__name__: f for f in (
    op1_toxicity, op2_exact_dedup, op3_simhash, op4_lm_score, op5_substring_dedup, op6_language, op7_line_dedup, op8_packing,
    op9_quality, op10_decontamination, op11_secret_scan, op12_vector_codes, op13_filter_audit,
)}


def vector_codes_sql() -> str:
    """The rounds of the vector codes one after the other; the key of a distance is distance x entries + index."""
    nearest = f"""SELECT x.r, x.p, min(CAST(list_inner_product(list_transform(list_zip(x.sub, c.sub), lambda z: CAST(z[1] - z[2] AS DOUBLE)),
                list_transform(list_zip(x.sub, c.sub), lambda z: CAST(z[1] - z[2] AS DOUBLE))) AS BIGINT) * {ENTRIES} + c.k) AS v
            FROM parts x JOIN books{{0}} c ON c.p = x.p GROUP BY x.r, x.p"""
    rounds = "".join(f""",
        near{n} AS MATERIALIZED ({nearest.format(n)}),
        books{n + 1} AS MATERIALIZED (
            SELECT c.p, c.k, coalesce(m.sub, c.sub) AS sub FROM books{n} c LEFT JOIN (
                SELECT p, k, list(mean ORDER BY pos) AS sub FROM (
                    SELECT p, k, pos, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS mean FROM (
                        SELECT n.p, n.v % {ENTRIES} AS k, unnest(s.sub) AS x, generate_subscripts(s.sub, 1) AS pos
                        FROM near{n} n JOIN parts s ON s.r = n.r AND s.p = n.p) GROUP BY p, k, pos) GROUP BY p, k) m
            ON m.p = c.p AND m.k = c.k)""" for n in range(ROUNDS))
    return f"""
        WITH whole AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id) AS r FROM whole),
        parts AS MATERIALIZED (
            SELECT r, p, v[CAST(p * len(v) // {PARTS} + 1 AS BIGINT):CAST((p + 1) * len(v) // {PARTS} AS BIGINT)] AS sub
            FROM numbered, range({PARTS}) AS position(p)),
        books0 AS MATERIALIZED (SELECT p, r - 1 AS k, sub FROM parts WHERE r <= {ENTRIES}){rounds},
        near AS MATERIALIZED ({nearest.format(ROUNDS)}),
        codes AS (
            SELECT r, string_agg(printf('%02x', v % {ENTRIES}), '' ORDER BY p) AS code, CAST(sum(v // {ENTRIES}) AS BIGINT) AS error
            FROM near GROUP BY r),
        digest AS (
            SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, pos)) AS codebooks_sha256
            FROM (SELECT p, k, unnest(sub) AS x, generate_subscripts(sub, 1) AS pos FROM books{ROUNDS}))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM numbered JOIN codes USING (r), digest"""


SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH bodies AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM bodies WINDOW same AS (PARTITION BY body)""",
    "op5_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
            FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
        starts AS (
            SELECT doc_id, pos, string_agg(word, ' ') OVER ahead AS run, count(*) OVER ahead AS n
            FROM words WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
        again AS (
            SELECT doc_id, pos FROM starts WHERE n = 35 QUALIFY count(*) OVER (PARTITION BY run) > 1),
        marked AS (
            SELECT w.doc_id, w.word, w.pos,
                   max(a.pos) OVER (PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
            FROM words w LEFT JOIN again a ON a.doc_id = w.doc_id AND a.pos = w.pos),
        sums AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
            FROM marked GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN sums USING (doc_id)""",
    "op7_line_dedup": rf"""
        WITH RECURSIVE lines AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY doc_id, pos) AS r, doc_id, line, dense_rank() OVER (ORDER BY line) AS name,
                   len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
            FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
        shared AS (
            SELECT r, doc_id, 1 AS n, min(r) OVER (PARTITION BY name) AS first FROM lines
            QUALIFY count(*) OVER (PARTITION BY name) > 1
            UNION ALL
            SELECT s.r, s.doc_id, s.n + 1, min(s.r) OVER (PARTITION BY s.first, l.name)
            FROM shared s JOIN lines l ON l.r = s.r + s.n AND l.doc_id = s.doc_id
            QUALIFY count(*) OVER (PARTITION BY s.first, l.name) > 1),
        runs AS (SELECT r, max(n) AS n FROM shared WHERE r <> first GROUP BY r),
        upto AS (SELECT r, sum(words) OVER (ORDER BY r) AS words FROM lines),
        long AS (
            SELECT runs.r, runs.r + runs.n AS past FROM runs JOIN upto a ON a.r = runs.r JOIN lines ON lines.r = runs.r
            JOIN upto b ON b.r = runs.r + runs.n - 1 WHERE b.words - a.words + lines.words >= {MIN_WORDS}),
        marked AS (
            SELECT lines.*, coalesce(max(past) OVER (ORDER BY lines.r) > lines.r, false) AS gone FROM lines LEFT JOIN long USING (r))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY r) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op12_vector_codes": vector_codes_sql(),
    "op13_filter_audit": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        marks AS (
            SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic
            FROM labels GROUP BY doc_id),
        facts AS (
            SELECT part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
                          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
                          regexp_matches(text, '[#$%&*|]'),
                          coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails,
                   coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
            FROM texts LEFT JOIN marks USING (doc_id)),
        cells AS MATERIALIZED (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t FROM facts GROUP BY part, fails),
        letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
        orders AS (
            SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
        steps AS (SELECT o, s.k AS step FROM orders, letters s),
        judged AS (
            SELECT part, o, step, n, g, t, fails[o[step]] AS own,
                   len(list_filter(o[1:step - 1], lambda k: fails[k])) > 0 AS gone,
                   len(list_filter(fails, lambda f: f)) AS failed
            FROM cells, steps),
        sums AS (
            SELECT part, o, step, o[step] AS filter,
                   coalesce(sum(n) FILTER (NOT gone AND NOT own), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND own), 0) AS removed,
                   coalesce(sum(n) FILTER (gone AND own), 0) AS redundant, coalesce(sum(n) FILTER (own AND failed = 1), 0) AS unique_fails,
                   coalesce(sum(g) FILTER (NOT gone AND own), 0) AS good_lost, coalesce(sum(t) FILTER (NOT gone AND own), 0) AS toxic_lost
            FROM judged GROUP BY part, o, step)
        SELECT part, array_to_string(list_transform(o, lambda k: chr(64 + k)), '') AS filter_order, CAST(step AS INTEGER) AS step,
               CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
        FROM sums""",
}
