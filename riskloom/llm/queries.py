"""Registered queries of the text operators, each over its whole table, with check SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import (content_sort, conversation_trie, harmonic, importance_draw, interpolated_lm, lang_gru, prefix_bpe, quality_embed, rule_ledger, secret_links, simhash_trie, simple8b,
                          token_counts)
from riskloom.llm.common import read


def op1_lang_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lang_gru.identified(docs, lang_gru.train(docs))


def op2_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.secrets(read(spark, sf_dir, "documents"))


def op3_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.lm_scores(read(spark, sf_dir, "documents"))


def op4_quality_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_embed.scored(docs, quality_embed.train(docs, read(spark, sf_dir, "labels")))


def op5_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.encoded(read(spark, sf_dir, "documents"))


def op6_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_groups(read(spark, sf_dir, "documents"))


def op7_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(read(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic.packed(read(spark, sf_dir, "documents"))


def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = rule_ledger.ledger(read(spark, sf_dir, "documents"))
    return rule_ledger.apply_policy(book)


def op11_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.round_trip(read(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_draw.drawn(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_lang_gru, op2_secret_links, op3_interpolated_lm, op4_quality_embed, op5_prefix_bpe, op6_content_sort,
                                   op7_simhash_trie, op8_token_counts, op9_harmonic_packing, op10_rule_ledger, op11_simple8b_ids, op12_conversation_trie,
                                   op13_importance_draw)}



def _crc32(text: str) -> str:
    """Check SQL for the crc32 of a text's UTF-8 bytes, bit by bit."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, 2 * octet_length(encode({text})) + 1, 2), lambda i: CAST('0x' || hex(encode({text}))[i:i + 1] AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295)"""


ORACLES = {
    "op6_content_sort": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op10_rule_ledger": r"""
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                     list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
        window3 AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
        again AS (SELECT r, i FROM window3 QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
        covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
        m AS (SELECT t.r, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda v: length(v))), 0)::BIGINT AS word_chars,
                len(regexp_extract_all(x, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
                len(list_filter(w, lambda v: regexp_matches(v, '[A-Z]') AND NOT regexp_matches(v, '[a-z]') AND octet_length(encode(v)) > 1)) AS n_upper_words,
                coalesce(list_max(list_transform(w, lambda v: octet_length(encode(v)))), 0) AS longest_word
              FROM t LEFT JOIN covered ON covered.r = t.r),
        f AS (SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > 3 * n_words)::BIGINT
                + 8 * (100 * n_dup_lines > 30 * n_lines)::BIGINT + 16 * (2 * n_upper_words > n_words)::BIGINT
                + 32 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::BIGINT + 64 * (longest_word > 1000)::BIGINT AS failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper_words, longest_word, failed,
          failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f""",
    "op12_conversation_trie": f"""
        WITH t AS (SELECT conv_id, turn, {{'k': sha256(sha256(coalesce(role, '')) || coalesce(text, '')), 'b': octet_length(encode(coalesce(text, '')))}} AS x
                   FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id AS c, list(x ORDER BY turn NULLS FIRST, x) AS turns, {_crc32('CAST(conv_id AS VARCHAR)')} % 9 AS h FROM t GROUP BY conv_id),
        whole AS (SELECT a.c, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns FROM own a LEFT JOIN own b ON b.c = a.c - a.c % 5),
        member AS (SELECT c, d, turns[1:d] AS p, len(turns) = d AS last FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM whole)),
        node AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
                 FROM member GROUP BY d, p),
        child AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
        own_sums AS (SELECT node.d, node.p, (child.n IS NULL)::BIGINT AS leaf, CASE WHEN node.d > 0 THEN (n_convs - 1) * node.p[node.d].b ELSE 0 END AS saved
                     FROM node LEFT JOIN child USING (d, p)),
        below AS (SELECT a AS d, p[1:a] AS p, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
                  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own_sums) GROUP BY 1, 2)
        SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n, 0) AS n_children, n_leaves, saved_tokens, node.ends_sha256
        FROM node JOIN below USING (d, p) LEFT JOIN child USING (d, p) LEFT JOIN node up ON up.d = node.d - 1 AND up.p = node.p[1:node.d - 1]""",
    "op13_importance_draw": f"""
        WITH word AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), w)) AS w
                      FROM documents, (SELECT '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+' AS w)),
        aim AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), w)) AS w
                FROM benchmark, (SELECT '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+' AS w)),
        place AS (SELECT w, {_crc32("w")} % 10000 AS b FROM (SELECT w FROM word UNION SELECT w FROM aim)),
        source AS (SELECT b, count(*)::DOUBLE AS n FROM word JOIN place USING (w) GROUP BY b),
        target AS (SELECT b, count(*)::DOUBLE AS n FROM aim JOIN place USING (w) GROUP BY b),
        totals AS (SELECT (SELECT count(*)::DOUBLE FROM word) AS s, (SELECT count(*)::DOUBLE FROM aim) AS t),
        gain AS (SELECT b, floor(1000 * ln((coalesce(target.n, 0) + 1) * (s + 10000) / ((source.n + 1) * (t + 10000)))) AS g
                 FROM source LEFT JOIN target USING (b), totals),
        mean AS (SELECT doc_id, count(*) AS n, floor(sum(g) / count(*))::BIGINT AS weight
                 FROM word JOIN place USING (w) JOIN gain USING (b) GROUP BY doc_id),
        score AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                    coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
                  FROM documents LEFT JOIN mean USING (doc_id)),
        placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
                     count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS k FROM score)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= k THEN r END AS rank FROM placed""",
}
