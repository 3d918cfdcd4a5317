"""One query per operator over its whole table, with the contracted columns, and SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayline.llm import (
    exact_index, graph_search, langid, line_dedup, mixing, ngram_join, packing, periodic_runs, phrases, secret_scan,
    substring_dedup, token_files, url_filter,
)
from wayline.llm.deploy import ship
from wayline.llm.tokens import public_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_documents(spark, sf_dir))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encoded_documents(_documents(spark, sf_dir), public_path("word_bpe_49k.json"), "words", 2)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_report(_documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_index.dedup_report(_documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_documents(spark, sf_dir))


def op7_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(_table(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(_documents(spark, sf_dir))


def op10_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), public_path("byte_bpe_50k.json"), "spaced", 1)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(_documents(spark, sf_dir), periodic_runs.made_periodic)


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_token_files, op3_ngram_join, op4_substring_dedup, op5_exact_dedup, op6_line_dedup,
        op7_graph_search, op8_secret_scan, op9_language_id, op10_curve_packing,
        op11_url_filter, op12_periodic_runs, op13_phrase_mining,
    )
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": """
        WITH rows AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY body)
        SELECT doc_id, keep_id, group_size,
               doc_id IS NOT DISTINCT FROM keep_id AND row_number() OVER (PARTITION BY r.body, doc_id) = 1 AS kept,
               sha256(r.body) AS text_sha256
        FROM rows r JOIN groups g ON r.body = g.body
    """,
    "op13_phrase_mining": r"""
        WITH texts AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
            FROM documents
        ),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
        numbered AS (SELECT row_number() OVER () AS piece_id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
        tokens AS (SELECT piece_id, lang, unnest(words) AS w, generate_subscripts(words, 1) AS place FROM numbered),
        runs AS (
            SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4
            FROM tokens WINDOW o AS (PARTITION BY piece_id ORDER BY place)
        ),
        grams AS (
            SELECT lang, 1 AS k, w AS phrase FROM runs
            UNION ALL SELECT lang, 2, w || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
            UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
            UNION ALL SELECT lang, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
        ),
        counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
        frequent AS MATERIALIZED (
            SELECT lang, phrase, a, k, string_split(phrase, ' ') AS words FROM counts WHERE a >= 30 AND k > 1
        ),
        parts AS (SELECT lang, phrase AS part, a AS part_count FROM counts WHERE a >= 30),
        split AS MATERIALIZED (
            SELECT lang, phrase, a, cut, array_to_string(words[1:cut], ' ') AS head, array_to_string(words[cut + 1:k], ' ') AS tail
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM frequent)
        ),
        cuts AS (
            SELECT s.lang, s.phrase, s.a, s.cut, h.part_count AS l, t.part_count AS r,
                   ((2000000::HUGEINT * s.a) // (h.part_count::HUGEINT + t.part_count))::BIGINT AS score
            FROM split s JOIN parts h ON h.lang = s.lang AND h.part = s.head JOIN parts t ON t.lang = s.lang AND t.part = s.tail
        ),
        lowest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ),
        spans AS (SELECT lang, a, k, words, unnest(range(2, k)) AS size FROM frequent WHERE k > 2),
        inner_spans AS (SELECT *, unnest(range(1, k - size + 2)) AS place FROM spans),
        around AS (
            SELECT lang, array_to_string(words[place:place + size - 1], ' ') AS phrase, max(a) AS a FROM inner_spans GROUP BY ALL
        ),
        ranked AS (
            SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank
            FROM lowest w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
            WHERE o.a IS NULL OR 100::HUGEINT * o.a < 80::HUGEINT * w.a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
