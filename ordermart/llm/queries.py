"""The registered queries of this package, one for each numbered operator, over
whole tables with production parameters, and their SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import conversation_queries, kneser_ney, lattice_lm, minhash_dedup, packing, quality_rules, sentencepiece_codec, sharding, syncmers, toxicity, warc
from .common import ship, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(table(spark, sf_dir, name))

    return run


def _with_labels(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

    return run


_QUALITY = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def queries() -> dict[str, Query]:
    return {
        "op1_warc": _over("pages", warc.round_trip),
        "op2_sentencepiece": _over("documents", lambda d: sentencepiece_codec.round_trip(d, PIECE_BPE)),
        "op3_toxicity": _with_labels(toxicity.score),
        "op4_lm_scoring": _over("documents", lambda d: lattice_lm.score(d, WORD_BPE)),
        "op5_fingerprints": _over("documents", syncmers.with_next),
        "op6_quality_classifier": _with_labels(kneser_ney.perplexity),
        "op7_packing": _over("documents", lambda d: packing.pack(d, WORD_BPE)),
        "op8_minhash_dedup": _over("documents", minhash_dedup.near_duplicates),
        "op9_sharding": _over("documents", sharding.assign),
        "op10_quality_rules": _over("documents", lambda d: quality_rules.divergence(d).select(*_QUALITY)),
        "op11_conversation_trie": _over("conversations", conversation_queries.trie),
        "op12_conversation_repair": _over("conversations", conversation_queries.repaired),
        "op13_chat_formatting": _over("conversations", conversation_queries.formatted),
    }


#: Words of a text, A-Z folded, as a list.
_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '')"""

OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS n, sha1(body) AS hex FROM p),
f AS (SELECT hex, min(page_id) AS first_id FROM h GROUP BY hex)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM h JOIN f USING (hex)
"""

OP8_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM sets JOIN reach ON a = doc_id GROUP BY doc_id, s
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op8_minhash_dedup": OP8_SQL} | conversation_queries.oracle_sql()
