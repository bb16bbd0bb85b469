"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact, html_text, language_id, license_scan, near_dup, packing, quality, token_files, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    learn = F.crc32(F.col("id").cast("string")) % 5 != 0
    model = quality.train_quality_model(docs, _table(spark, sf_dir, "labels"), learn)
    score = F.col("quality_score")
    found = quality.score_quality(docs, model)
    return found.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), score.alias("score"), F.when(score >= 0.3, 1).otherwise(0).alias("predicted"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(_table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.train_language_model(language_id.training_rows(docs, held_out))
    found = language_id.identify_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


# The rules of the query.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("block", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    labelled = url_filter.label_by_host_words(pages.where(~url_filter.held_out_host(F.col("url"))))
    model = url_filter.train_url_model(labelled, known=url_filter.BLOCKED_HOST_WORDS)
    return url_filter.filter_urls(pages, URL_RULES, model)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])

    def joined(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"), F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_token_files(_table(spark, sf_dir, "documents"))
    return token_files.read_token_index(spark, folder)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_quality_classifier, op3_decontamination, op4_html_extraction, op5_best_fit_packing, op6_language_id, op7_url_filter, op8_minhash_near_dedup, op9_license_scan, op10_token_files)}

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TEMPLATES = ",\n                ".join(f"({i}, '{t.label}', {str(t.base).lower()}, '{t.text}', '{t.key}')" for i, t in enumerate(license_scan.TEMPLATES))

ORACLE_SQL = {
    "op1_exact_dedup": """
        WITH g AS (
            SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size
            FROM documents GROUP BY 1
        )
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.t) AS text_sha256
        FROM documents d JOIN g ON coalesce(d.text, '') = g.t
    """,
    "op3_decontamination": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), i AS (
            SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), win AS (
            SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, p, p + least(10, len(w)) - 1), ' ') AS k
            FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(p) WHERE len(w) > 0
        ), sizes AS (
            SELECT DISTINCT n FROM win
        ), places AS (
            SELECT doc_id, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p)
        ), hit AS (
            SELECT doc_id, p, n, item FROM places JOIN win USING (n, k)
        ), hits AS (
            SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, p, n FROM hit), unnest(range(p, p + n)) AS t(q) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op8_minhash_near_dedup": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, p, p + 4), ' '), len(list_slice(w, p, p + 4))) AS x
            FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(p) WHERE len(w) > 0
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * ((SELECT n FROM n WHERE doc_id = a.doc_id) + (SELECT n FROM n WHERE doc_id = b.doc_id) - count(*))
        ), reach AS (
            SELECT a AS doc_id, b AS other FROM links
            UNION
            SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
        ), least_one AS (
            SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_one USING (doc_id)
    """,
    "op9_license_scan": f"""
        WITH t AS (
            SELECT template, label, base, len(w) AS size, w, NOT base AND len(w) >= {license_scan.SHORT} AS part,
                CASE WHEN key = '' THEN 0 ELSE len(string_split(key, ' ')) - 2 END AS key_grams,
                len(string_split(trim(split_part(text, key, 1)), ' ')) AS key_first
            FROM (SELECT *, string_split(text, ' ') AS w FROM (VALUES
                {_TEMPLATES}
            ) AS x(template, label, base, text, key))
        ), tg AS (
            SELECT template, p - 1 AS place, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c FROM t, unnest(range(1, len(w) - 1)) AS u(p)
        ), d AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents
        ), dg AS (
            SELECT doc_id, p - 1 AS i, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c FROM d, unnest(range(1, len(w) - 1)) AS u(p)
        ), votes AS (
            SELECT doc_id, template, i, place, i - place AS diagonal FROM dg JOIN tg USING (a, b, c)
        ), fresh AS (
            SELECT doc_id, template, diagonal,
                CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > CASE WHEN part THEN {license_scan.DRIFT} ELSE 0 END THEN 1 ELSE 0 END AS fresh
            FROM (SELECT DISTINCT doc_id, template, diagonal FROM votes) JOIN t USING (template)
        ), numbered AS (
            SELECT doc_id, template, diagonal, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS passage FROM fresh
        ), passages AS (
            SELECT doc_id, template, passage, min(i) AS pos, count(DISTINCT place + j) AS covered,
                count(DISTINCT place) FILTER (key_grams > 0 AND place BETWEEN key_first AND key_first + key_grams - 1) AS key_seen
            FROM votes JOIN numbered USING (doc_id, template, diagonal) JOIN t USING (template), unnest(range(0, 3)) AS u(j)
            GROUP BY doc_id, template, passage
        ), spans AS (
            SELECT doc_id, label, base, pos, CAST(covered AS DOUBLE) / size AS score FROM passages JOIN t USING (template)
            WHERE CAST(covered AS DOUBLE) / size >= CASE WHEN part THEN CAST({license_scan.COVER} AS DOUBLE) ELSE 1 END AND key_seen = key_grams
        ), found AS (
            SELECT doc_id, count(*) FILTER (base) AS n_base, min(pos) FILTER (base) AS first_word, max(pos) FILTER (base) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
            FROM spans GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
        FROM d LEFT JOIN found USING (doc_id)
    """,
}
