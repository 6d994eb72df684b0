"""The registered queries of the corpus operators and their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    byte_bpe,
    conversation_trie,
    embedding_dedup,
    exact_dedup,
    filter_audit,
    html_extract,
    licenses,
    mixing,
    secret_scan,
    simhash,
    substring_dedup,
    toxicity,
)
from ledgerloom.llm.common import read

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Shares of the corpus's words that each labelled domain should have.
TARGETS = {"clean": 0.95, "junk": 0.05}


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def domains(labels: DataFrame) -> DataFrame:
    """The labelled table of the mixture: ``doc_id, domain``."""
    return labels.select("doc_id", F.when(F.col("quality") > 0, "clean").when(F.col("quality") <= 0, "junk")
                         .alias("domain"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), tokenizer_path())


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.flags(read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates, names = mixing.document_rates(read(spark, sf_dir, "documents"), domains(read(spark, sf_dir, "labels")),
                                         TARGETS)
    return mixing.copies(rates).select(
        "doc_id", "words", "rate", "copies", *(F.round(F.col("p")[i], 6).alias(f"p_{d}") for i, d in enumerate(names)))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(read(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(read(spark, sf_dir, "documents"), tokenizer_path(RANKS))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_html": op5_html,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_secrets": op7_secrets,
    "op8_simhash": op8_simhash,
    "op9_licenses": op9_licenses,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_conversation_trie": op13_conversation_trie,
}

# The masks of failed filters per document, then every order by the letters before each step.
_AUDIT_SQL = r"""
WITH l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
           FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
     t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
     w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                  min(doc_id) OVER (PARTITION BY text) AS first FROM t),
     f AS (SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
                  concat(CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
                         CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
                         CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text)
                              THEN 'C' ELSE '' END,
                         CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
                         CASE WHEN w.doc_id > first THEN 'E' ELSE '' END) AS failed
           FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
     c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
     x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
     o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     s AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o),
     p AS (SELECT filter_order, step, substring(filter_order, step, 1) AS letter,
                  '[' || substring(filter_order, 1, step - 1) || '_]' AS earlier FROM s),
     r AS (SELECT c.*, p.*, contains(failed, letter) AS fails, regexp_matches(failed, earlier) AS gone FROM c, p),
     v AS (SELECT part, letter, sum(n) FILTER (fails AND NOT gone) AS shapley FROM r GROUP BY part, letter)
SELECT r.part, filter_order, step,
       coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (failed = r.letter), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost,
       coalesce(any_value(v.shapley), 0)::BIGINT AS shapley
FROM r LEFT JOIN v ON r.part = v.part AND r.letter = v.letter
GROUP BY r.part, filter_order, step"""

# Whole paths as lists; every prefix of every path is a node, every prefix of a node an ancestor.
_TRIE_SQL = """
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations
           WHERE conv_id IS NOT NULL),
     w AS (SELECT c, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST,
                          sha256(strlen(role)::VARCHAR || ':' || role || text)) AS turns FROM t GROUP BY c),
     h AS (SELECT c, turns, c - c % 5 AS base,
                  xor(list_reduce(list_prepend(4294967295::UBIGINT,
                          list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
                      lambda a, x: list_reduce(list_prepend(xor(a, x), list_transform(range(8), lambda i: i::UBIGINT)),
                          lambda v, i: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 9 AS h
           FROM w),
     r AS (SELECT h.c, coalesce(b.turns[1:h.h], []) || h.turns[h.h + 1:] AS path
           FROM h LEFT JOIN w b ON h.base = b.c),
     m AS (SELECT c, len(path) AS size, path, unnest(range(0, len(path) + 1)) AS depth FROM r),
     n AS (SELECT depth, path[1:depth] AS path, min(c) AS conv_id, count(*) AS n_convs,
                  coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = depth), '') AS ends
           FROM m GROUP BY depth, path[1:depth]),
     k AS (SELECT a.*, p.conv_id AS parent_conv_id,
                  (SELECT count(*) FROM n x WHERE x.depth = a.depth + 1 AND x.path[1:a.depth] = a.path) AS n_children
           FROM n a LEFT JOIN n p ON p.depth = a.depth - 1 AND p.path = a.path[1:a.depth - 1]),
     u AS (SELECT unnest(range(0, depth + 1)) AS top, path, (n_children = 0)::INT AS leaf,
                  CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(path[depth].text) END AS saved FROM k),
     s AS (SELECT top, path[1:top] AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
           FROM u GROUP BY top, path[1:top])
SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN s ON s.top = k.depth AND s.path = k.path"""

ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
             g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.h AS text_sha256
        FROM d JOIN g ON d.h = g.h""",
    "op11_filter_audit": _AUDIT_SQL,
    "op13_conversation_trie": _TRIE_SQL,
}
