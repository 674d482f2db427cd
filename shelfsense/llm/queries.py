"""The registered queries of this subpackage, and the SQL that the driver holds them against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.llm import (
    brown, decontaminate, exact_dedup, infill, jaccard, licenses, line_dedup, negatives, packing, passages, pieces,
    toxicity, warc,
)
from shelfsense.llm.common import table
from shelfsense.sources.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


@query(r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i
                  FROM b WHERE len(w) > 0)),
    p AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
          FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
                FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
    hit AS (SELECT doc_id, p.n, i, item_id FROM p JOIN win USING (g)),
    places AS (SELECT doc_id, count(DISTINCT q) AS n_hit
               FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS q FROM hit) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query(r"""
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
               FROM documents),
    g AS (SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
              first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
          FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""")
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@query()
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(
        table(spark, folder, "documents"),
        public_tokenizers.path(packing.TOKENIZER),
        public_tokenizers.path(packing.RANKS),
    )


@query(r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
          FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
             FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
    r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
    SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
    FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
""")
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, folder, "documents"))


@query(r"""
    WITH lines AS (SELECT doc_id, i, line, translate(trim(line, e' \t\n\x0b\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS key
                   FROM (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
                         FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
    many AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
             GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR keeper = doc_id), ''))
            AS kept_sha256
    FROM lines LEFT JOIN many USING (key) GROUP BY doc_id
""")
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.without_repeated_lines(table(spark, folder, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


@query()
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


@query()
def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return brown.score_texts(table(spark, folder, "documents"))


@query()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
    FROM g
""")
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(table(spark, folder, "pages"), fresh_path(spark, "warc"))


@query()
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of a tree of sources and languages."""
    docs = table(spark, folder, "documents")
    files = docs.select(F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text")
    found = licenses.file_licences(files)
    return found.select(F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id"), "*")


@query()
def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path(pieces.MODEL)
    encoded = pieces.encode(table(spark, folder, "documents"), model)
    return pieces.decode(encoded, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query("""
    WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
               AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
              CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
          FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
        CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
""")
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", label)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query(r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h,
                   regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
    c AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x,
              CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y, CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS spm
          FROM d),
    f AS (SELECT *, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
              array_to_string(u[greatest(x, y) + 1:n], '') AS s,
              CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                   WHEN spm THEN 'spm' ELSE 'psm' END AS form
          FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
               ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM f
""")
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = infill.fill_in_middle(table(spark, folder, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )
