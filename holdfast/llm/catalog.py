"""The queries of the corpus operators and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import (
    alignment, bit_slices, bpe, divergence, interpolation, language, line_dedup, line_rules, packing, quality_model, secret_scan, simhash, suffix_dedup,
)
from holdfast.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op4_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_rules.apply_rules(docs, line_rules.fit_line_field(docs, read_table(spark, sf_dir, "labels")))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op5_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_slices.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op5_bit_sliced_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents"), path), path)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_boilerplate(read_table(spark, sf_dir, "documents"), counts=("n_lines", "n_removed"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLES["op1_line_dedup"] = """
WITH l AS (
    SELECT d.doc_id, d.source, g.pos, d.lines[g.pos] AS line, trim(d.lines[g.pos], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS body
    FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL) d,
        LATERAL (SELECT unnest(range(1, len(d.lines) + 1)) AS pos) g
), shared AS (
    SELECT body, min(doc_id) AS first FROM l WHERE body <> '' GROUP BY body HAVING count(DISTINCT source) >= 8
), marked AS (
    SELECT l.*, s.first IS NOT NULL AND l.doc_id > s.first AS gone FROM l LEFT JOIN shared s ON l.body = s.body
), cut AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed, sha256(coalesce(c.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id
"""


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_model.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "posterior", "score", "kept")


@query
def op9_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score_documents(read_table(spark, sf_dir, "documents"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
    SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), groups AS (
    SELECT DISTINCT lang, source FROM d
), v AS (
    SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM groups) g LEFT JOIN kept k ON g.lang = k.lang GROUP BY g.lang
), counts AS (
    SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), grid AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, v.v::HUGEINT AS v
    FROM groups g JOIN kept k ON g.lang = k.lang JOIN v ON v.lang = g.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
    SELECT lang, source, term, n, (1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v)::HUGEINT)::BIGINT AS p FROM grid
), whole AS (
    SELECT lang, term, sum(n)::HUGEINT AS n, any_value(v) AS v FROM grid GROUP BY lang, term
), lang_shares AS (
    SELECT lang, term, (1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v)::HUGEINT)::BIGINT AS q FROM whole
), found AS (
    SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(f.value, 0)::BIGINT AS value
    FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
    LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ) f ON f.lang = g.lang AND f.source = g.source AND f.item = o.source
    UNION ALL
    SELECT s.lang, s.source, 'term', s.term, s.p - l.q FROM shares s JOIN lang_shares l ON s.lang = l.lang AND s.term = l.term WHERE s.n > 0 AND s.p > l.q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER w AS INTEGER) AS rank FROM found
WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) QUALIFY part = 'pair' OR row_number() OVER w <= 50
"""


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(read_table(spark, sf_dir, "documents"), *paths).withColumnRenamed("digest", "groups_sha256")
