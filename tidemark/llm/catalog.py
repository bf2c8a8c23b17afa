"""The operators' queries over the given tables, and SQL where it can express them.

Every query reads its whole table; the parameters are those meant for production.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    ann,
    bpe,
    divergence,
    exact_dedup,
    jaccard_join,
    lang_id,
    packing,
    quality,
    secret_scan,
    simhash,
    token_files,
    warc,
    whitening,
)
from tidemark.session import new_folder

END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"), keep="largest")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_tokens(
        table(spark, sf_dir, "documents"),
        new_folder(spark, "tokens"),
        public_tokenizers.path("byte_bpe_50k.json"),
        END_ID,
    )
    return token_files.read_index(spark, manifest)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_report(table(spark, sf_dir, "documents"), arrivals=2)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_quality,
        op2_best_fit_packing,
        op3_exact_dedup,
        op4_nearest,
        op5_token_files,
        op6_simhash,
        op7_secret_scan,
        op8_byte_bpe,
        op9_language,
        op10_warc,
        op11_source_divergence,
        op12_jaccard_join,
        op13_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op10_warc": """
        WITH payloads AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
            FROM pages
        ), digests AS (
            SELECT *, list_aggregate(list_transform(range(32), lambda i: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(sha1(payload), (i // 4) * 5 + 1, 5))::BIGINT
                    >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS digest
            FROM payloads
        )
        SELECT page_id, octet_length(payload) AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM digests
    """,
    "op11_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), postings AS (
            SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs
            FROM (SELECT lang, source, doc, unnest(terms) AS term FROM docs) GROUP BY ALL
        ), kept AS (
            SELECT lang, term, sum(n)::BIGINT AS n FROM postings GROUP BY ALL HAVING sum(docs) >= 30
        ), languages AS (
            SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY ALL
        ), counts AS (
            SELECT g.lang, g.source, k.term, coalesce(p.n, 0) AS n, k.n AS in_lang, l.v, l.total AS lang_total,
                   sum(coalesce(p.n, 0)) OVER (PARTITION BY g.lang, g.source)::BIGINT AS total
            FROM (SELECT DISTINCT lang, source FROM docs) g
            JOIN kept k USING (lang) JOIN languages l USING (lang) LEFT JOIN postings p USING (lang, source, term)
        ), shares AS (
            SELECT lang, source, term, n,
                   1 + (1000000000::HUGEINT * (n + 5) // (total + 5 * v))::BIGINT AS p,
                   1 + (1000000000::HUGEINT * (in_lang + 5) // (lang_total + 5 * v))::BIGINT AS q
            FROM counts
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
            FROM (SELECT DISTINCT lang, source FROM docs) a
            JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p))::BIGINT AS value
                FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
            ) d ON d.lang = a.lang AND d.source = a.source AND d.other = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
        FROM found
        QUALIFY part = 'pair' OR rank <= 50
    """,
    "op12_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents
        ), sets AS (
            SELECT r, doc_id, list_distinct(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingles
            FROM words
        ), tokens AS (
            SELECT r, len(shingles) AS n, unnest(shingles) AS token FROM sets
        ), links AS (
            SELECT a.r AS x, b.r AS y FROM tokens a JOIN tokens b ON a.token = b.token AND a.r <> b.r
            GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), reached AS (
            SELECT r, r AS other FROM sets
            UNION
            SELECT reached.r, links.y FROM reached JOIN links ON reached.other = links.x
        )
        SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
        FROM sets s JOIN reached USING (r) JOIN sets o ON o.r = reached.other
        GROUP BY s.r, s.doc_id, s.shingles
    """,
}
