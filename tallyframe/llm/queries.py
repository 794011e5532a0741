"""Registered queries on texts, tokens and vectors, and the SQL that checks them.

Each query applies its operator with production parameters to the whole table and
derives the columns of its digest.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.alignment import token_alignment
from tallyframe.llm.common import held_out
from tallyframe.llm.decontaminate import contamination
from tallyframe.llm.licenses import licence_scan, licence_sql
from tallyframe.llm.packing import pack
from tallyframe.llm.parity import jaccard_groups
from tallyframe.llm.pii import KINDS, personal_data
from tallyframe.llm.quality import THRESHOLD as GOOD
from tallyframe.llm.quality import quality
from tallyframe.llm.simhash import simhash_groups
from tallyframe.llm.spelling import spelling_variants, word_counts
from tallyframe.llm.substrings import without_repeats
from tallyframe.llm.tokens import read_tokens, token_index, write_tokens
from tallyframe.llm.topk import exact_top_k
from tallyframe.llm.toxicity import THRESHOLD as TOXIC
from tallyframe.llm.toxicity import toxicity
from tallyframe.plans import Scratch
from tallyframe.sources import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All words of all documents in sequences of 1024, without conflicts."""
    return pack(read_table(spark, folder, "documents"), capacity=1024)


def op2_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence sentences and licences of whole texts."""
    return licence_scan(read_table(spark, folder, "documents")).selectExpr(
        "doc_id", "array_join(sentence_ids, ',') AS sentence_ids", "array_join(licences, ',') AS licences"
    )


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of whole texts that lie in a 10-word window of a benchmark item."""
    found = contamination(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"), window=10
    )
    return found.selectExpr(
        "doc_id",
        "n_words",
        "n_hit",
        "CAST(size(items) AS BIGINT) AS n_items",
        "sha2(array_join(items, ','), 256) AS items_sha256",
        "n_hit > 0 AS contaminated",
    )


def op4_top_products(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 greatest inner products of every hundredth vector with all others."""
    vectors = read_table(spark, folder, "embeddings")
    return exact_top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


TOP_PRODUCTS_SQL = """
    WITH part AS (
        SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
        FROM part q JOIN part c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in whole texts: counts of the rules' spans, and all spans."""
    found = personal_data(read_table(spark, folder, "documents"))
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.selectExpr(
        "doc_id",
        *(f"CAST(size(filter(rules, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in KINDS),
        f"sha2({joined.format('rules')}, 256) AS base_sha256",
        f"{joined.format('spans')} AS spans",
    )


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Place, length and checksum of each document's ids, from the written files."""
    path = Scratch(spark).path()
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    write_tokens(read_table(spark, folder, "documents"), path, tokenizer, end_id=0)
    return token_index(read_tokens(spark, path))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of whole texts."""
    scored = quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of whole texts, with the number of toxic spans."""
    scored = toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts without the passages that stand elsewhere before, and where these were."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return without_repeats(docs).selectExpr(
        "doc_id",
        "aggregate(repeated_spans, 0L, (n, s) -> n + s.end - s.start) AS n_repeated",
        "CAST(size(repeated_spans) AS BIGINT) AS n_spans",
        "array_join(transform(repeated_spans, s -> concat_ws(':', s.start, s.end, s.first_doc_id)), ',') AS spans",
        "sha2(text, 256) AS kept_sha256",
    )


def op10_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of whole texts and the components of those within 4 bits."""
    groups = simhash_groups(read_table(spark, folder, "documents"), shingle=4, max_bits=4)
    return groups.selectExpr(
        "doc_id", "lpad(lower(hex(fingerprint)), 16, '0') AS fingerprint", "component_id"
    )


def op11_jaccard_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Shingles of whole texts and the components of those with a similarity of 85 percent."""
    return jaccard_groups(read_table(spark, folder, "documents"), shingle=4, over=85).drop("row")


JACCARD_SQL = r"""
    WITH RECURSIVE cut AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(
            [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, greatest(len(w) - 3, 1) + 1)]) END AS s
        FROM cut
    ), tokens AS (
        SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
    ), links AS (
        SELECT a.doc_id AS u, b.doc_id AS v
        FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), reached AS (
        SELECT doc_id, doc_id AS other FROM sets
        UNION
        SELECT r.doc_id, l.v FROM reached r JOIN links l ON r.other = l.u
    )
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
    FROM sets s JOIN reached r ON s.doc_id = r.doc_id
    GROUP BY s.doc_id, len(s.s)
"""


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens, groups and links of whole texts under two tokenizers, with corpus counts."""
    return token_alignment(
        read_table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    ).drop("row")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of whole texts, the more frequent words one edit away, and where these lead."""
    return spelling_variants(word_counts(read_table(spark, folder, "documents")))


def registry() -> dict[str, tuple[Query, str | None]]:
    """Query and SQL by name; None where SQL cannot express the query."""
    return {
        "op1_best_fit_packing": (op1_best_fit_packing, None),
        "op2_licence_scan": (op2_licence_scan, licence_sql()),
        "op3_decontamination": (op3_decontamination, None),
        "op4_top_products": (op4_top_products, TOP_PRODUCTS_SQL),
        "op5_personal_data": (op5_personal_data, None),
        "op6_token_files": (op6_token_files, None),
        "op7_quality": (op7_quality, None),
        "op8_toxicity": (op8_toxicity, None),
        "op9_repeated_passages": (op9_repeated_passages, None),
        "op10_simhash_groups": (op10_simhash_groups, None),
        "op11_jaccard_groups": (op11_jaccard_groups, JACCARD_SQL),
        "op12_token_alignment": (op12_token_alignment, None),
        "op13_spelling_variants": (op13_spelling_variants, None),
    }
