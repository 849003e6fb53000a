"""Queries of the training-data operators on the tables of the driver contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import baseweave.llm

from .common import table
from .decontamination import contaminated
from .divergence import source_divergence
from .exact_dedup import exact_dedup
from .html_extraction import extract_text
from .lexical_search import rank_documents
from .near_dedup import near_duplicates
from .packing import pack_documents
from .quality import score_quality
from .sharding import shard_documents
from .substring_dedup import substring_dedup
from .token_counts import count_tokens
from .toxicity import score_toxicity
from .url_filter import judge_urls, rule_table

# Python workers need not have this package on their path.
cloudpickle.register_pickle_by_value(baseweave.llm)

#: Fixed values of the URL contract: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def small_batches(spark: SparkSession) -> None:
    """Texts may be long: rows go to Python few at a time, as their buffers are beyond the JVM's heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "250")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return substring_dedup(table(spark, sf_dir, "documents"), keep_text=False)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return count_tokens(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return extract_text(table(spark, sf_dir, "pages"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return source_divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_packing, op2_url_filters, op3_substring_dedup, op4_exact_dedup, op5_benchmark_decontamination, op6_quality_classifier, op7_sharding, op8_toxicity, op9_minhash_near_dedup, op10_token_counts)
    return {f.__name__: f for f in (*every, op11_lexical_search, op12_html_extraction, op13_source_divergence)}


ORACLE = {
    "op2_url_filters": r"""
        WITH rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
             ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        p AS (SELECT row_number() OVER () AS r, page_id,
                     coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                     coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
              FROM pages),
        m AS (SELECT p.*, x.host || x.path AS rule, x.verdict,
                     row_number() OVER (PARTITION BY r ORDER BY length(x.host || x.path) DESC) AS k
              FROM p LEFT JOIN rules x
              ON (p.host = x.host OR ends_with(p.host, '.' || x.host)) AND starts_with(p.path, x.path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1""",
    "op3_substring_dedup": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g
              FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
        f AS (SELECT g, min(doc_id) AS first_doc FROM s GROUP BY 1),
        h AS (SELECT DISTINCT s.doc_id, s.i + k AS i FROM s JOIN f ON s.g = f.g AND f.first_doc < s.doc_id, (SELECT unnest(generate_series(0, 12)) AS k)),
        r AS (SELECT doc_id, list(i) AS gone FROM h GROUP BY 1)
        SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
               sha256(coalesce(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
                               ELSE (SELECT string_agg(w[j], ' ' ORDER BY j) FROM (SELECT unnest(generate_series(1, len(w))) AS j) WHERE NOT list_contains(gone, j)) END, '')) AS kept_sha256
        FROM d LEFT JOIN r ON r.doc_id = d.doc_id""",
    "op4_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
                   FROM documents),
        g AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY points DESC, doc_id NULLS LAST) AS k,
                     first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
                     count(*) OVER (PARTITION BY content) AS group_size
              FROM d)
        SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(content) AS text_sha256 FROM g""",
    "op5_benchmark_decontamination": r"""
        WITH t AS (SELECT true AS doc, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark),
        d AS (SELECT doc, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t),
        s AS (SELECT DISTINCT doc, id, array_to_string(w[i : i + 4], ' ') AS g
              FROM (SELECT doc, id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT id, count(*) AS n_item FROM s WHERE NOT doc GROUP BY 1),
        p AS (SELECT a.id AS doc_id, b.id AS item_id, count(*) AS n_shared FROM s a JOIN s b ON a.g = b.g WHERE a.doc AND NOT b.doc GROUP BY 1, 2)
        SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
        FROM p JOIN n ON n.id = item_id WHERE n_shared * 100 >= n_item * 75""",
    "op9_minhash_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
              FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
        r(id, c) AS (SELECT doc_id, doc_id FROM d
                     UNION SELECT f.v, r.c FROM r JOIN (SELECT a AS u, b AS v FROM e UNION ALL SELECT b, a FROM e) f ON r.id = f.u),
        m AS (SELECT id, min(c) AS component_id FROM r GROUP BY 1)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
        FROM d JOIN m ON m.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op11_lexical_search": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
        s AS (SELECT count(*) AS nn, coalesce(sum(len(w)), 0)::BIGINT AS ll FROM d WHERE len(w) > 0),
        t AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d),
        p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM t GROUP BY 1, 2, 3, 4),
        f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
        q AS (SELECT i, item_id, unnest(w) AS term FROM b),
        x AS (SELECT i, item_id, r, doc_id,
                     sum(CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
                         * ((1000000000::BIGINT * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // ll))))::BIGINT AS score
              FROM q JOIN p ON p.term = q.term JOIN f ON f.term = q.term, s GROUP BY 1, 2, 3, 4)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM x WHERE score > 0) WHERE rank <= 10""",
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
        k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
        l AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM k GROUP BY 1),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT t.lang, source, t.term, count(*) AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term GROUP BY 1, 2, 3),
        s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::BIGINT AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2),
        p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::BIGINT * (coalesce(c.n, 0) + 5)) // (s.n + 5 * l.v) AS p,
                     1 + (1000000000::BIGINT * (k.n + 5)) // (l.n + 5 * l.v) AS q
              FROM s JOIN k ON k.lang = s.lang JOIN l ON l.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
        f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
              GROUP BY 1, 2, 4
              UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
        WHERE part = 'pair' OR rank <= 50""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
