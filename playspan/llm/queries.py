"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playspan.llm.common import small_batches
from playspan.llm import (
    alignment, automaton, bestposition, bloom, bpe, covertree, fertility, forest, langid, mixing, ranking, suffix, urlfilter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_language(spark, folder):
    return langid.digest(table(spark, folder, "documents"))


@query
def op2_fertility(spark, folder):
    return fertility.digest(table(spark, folder, "documents"))


@query
def op3_forest(spark, folder):
    return forest.digest(table(spark, folder, "documents"))


SQL["op3_forest"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), places AS (
    SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM words WHERE len(ws) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS shingle FROM places
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM common c JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * c.n >= 80 * (a.n + b.n - c.n)
), edges AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, e.y FROM reached r JOIN edges e ON e.x = r.other
)
SELECT r.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query
def op4_suffix(spark, folder):
    return suffix.digest(table(spark, folder, "documents"))


@query
def op5_ranking(spark, folder):
    return ranking.digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_mix(spark, folder):
    return mixing.digest(table(spark, folder, "documents"))


@query
def op7_bpe(spark, folder):
    return bpe.digest(table(spark, folder, "documents"))


@query
def op8_covertree(spark, folder):
    return covertree.digest(table(spark, folder, "embeddings"))


SQL["op8_covertree"] = """
WITH v AS (
    SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""


@query
def op9_automaton(spark, folder):
    return automaton.digest(table(spark, folder, "documents"))


@query
def op10_urls(spark, folder):
    return urlfilter.digest(table(spark, folder, "pages"))


SQL["op10_urls"] = r"""
WITH hosts AS (
    SELECT page_id, url, CAST((page_id * 37) % 365 AS INTEGER) AS fetch_day,
           nullif(regexp_replace(lower(regexp_extract(translate(url_decode(regexp_replace(regexp_extract(
               replace(regexp_replace(url, '^[\x00-\x20]+|[\x00-\x20]+$|[\t\n\r]+', '', 'g'), '\', '/'),
               '^(?i:https?)://([^/?#]*)', 1), '^.*@', '')), chr(12290) || chr(65294) || chr(65377), '...'),
               '^([^/?#:@\[\]]+)', 1)), '\.+$', ''), '') AS host
    FROM pages
), captures AS (
    SELECT *, string_split(host, '.') AS labels FROM hosts
), names AS (
    SELECT host AS name, page_id FROM captures WHERE host IS NOT NULL
    UNION ALL
    SELECT array_to_string(labels[2:], '.'), page_id FROM captures WHERE len(labels) >= 3
), least AS (
    SELECT name, min(page_id) AS m FROM names GROUP BY name
), daily AS (
    SELECT name, CAST((m * 11 + step) % 365 AS INTEGER) AS day, max(action) AS action
    FROM least, (VALUES (0, 'block'), (120, 'allow'), (250, 'block')) AS e(step, action)
    WHERE m % 3 <> 0
    GROUP BY 1, 2
), spans AS (
    SELECT name, action, day AS valid_from, lead(day) OVER (PARTITION BY name ORDER BY day) AS valid_to FROM daily
), asked AS (
    SELECT page_id, fetch_day, labels, unnest(range(0, greatest(len(labels) - 1, 1))) AS up
    FROM captures WHERE host IS NOT NULL
), hits AS (
    SELECT a.page_id, s.*, row_number() OVER (PARTITION BY a.page_id ORDER BY length(s.name) DESC) AS n
    FROM asked a JOIN spans s ON s.name = array_to_string(a.labels[a.up + 1:], '.')
    WHERE a.fetch_day >= s.valid_from AND (s.valid_to IS NULL OR a.fetch_day < s.valid_to)
)
SELECT c.page_id, c.url, c.fetch_day, c.host, h.name, h.action, h.valid_from, h.valid_to,
       coalesce(h.action <> 'block', TRUE) AS kept
FROM captures c LEFT JOIN hits h ON h.page_id = c.page_id AND h.n = 1
"""


@query
def op11_bestposition(spark, folder):
    return bestposition.digest(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op11_bestposition"] = r"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
    FROM documents
), sizes AS (
    SELECT r, doc_id, len(ws) AS n, ws FROM words WHERE len(ws) > 0
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes
), tfs AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM sizes) GROUP BY 1, 2
), asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY 1, 2
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tfs GROUP BY 1), totals
), scored AS (
    SELECT item_id, s.r, s.doc_id, CAST(sum(
        times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms))))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes s ON s.r = tfs.r, totals
    GROUP BY 1, 2, 3
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""


@query
def op12_bloom(spark, folder):
    return bloom.digest(table(spark, folder, "documents"))


SQL["op12_bloom"] = r"""
WITH bare AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT doc_id, text_sha256, row_number() OVER w AS n, first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM bare WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, n = 1 AS kept, text_sha256 FROM ranked
"""


@query
def op13_alignment(spark, folder):
    return alignment.digest(table(spark, folder, "documents"))
