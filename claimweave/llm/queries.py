"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimweave.llm import (
    backoff,
    bpe,
    conversations,
    html_main,
    langid,
    merkle,
    ngram_join,
    rules,
    shards,
    token_counts,
    warc,
    winnow,
    word_bpe,
)
from claimweave.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LM_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents")).drop("usual_rate")


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scores(table(spark, sf_dir, "documents"), LM_RANKS, PATTERN)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), MODEL)


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"))


def op8_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode_documents(table(spark, sf_dir, "documents"), WORD_MODEL)


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_main_text,
        op2_language_id,
        op3_quality_cascade,
        op4_stupid_backoff,
        op5_token_counts,
        op6_winnowing,
        op7_interleaved_shards,
        op8_warc_dictionary,
        op9_byte_bpe,
        op10_ngram_join,
        op11_conversation_repair,
        op12_merkle_manifest,
        op13_word_bpe,
    )
}

_OP3 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)
), rep AS (
  SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1
), pos AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM win JOIN rep USING (doc_id, g), range(8) AS r(o) GROUP BY doc_id
), ln AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), st AS (
  SELECT doc_id, count(*) AS n FROM (SELECT doc_id, w, unnest(range(2, len(w) + 1)) AS i FROM d)
  WHERE w[i] = w[i - 1] GROUP BY doc_id
), f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(ln.dup, 0)::BIGINT AS n_dup_lines,
    coalesce(pos.n, 0)::BIGINT AS n_repeat_words, coalesce(ln.n, 0) AS n_lines, coalesce(st.n, 0) AS n_stutter
  FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ln USING (doc_id) LEFT JOIN st USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR word_chars > 15 * n_words OR word_chars < 2 * n_words
    OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 10 * n_stutter > 3 * n_words) AS kept
FROM f
"""

_OP6 = r"""
WITH r AS (
  SELECT doc_id, coalesce('id:' || doc_id || ':', 'text:') || sha256(coalesce(text, '')) AS name, text FROM documents
), d AS (
  SELECT name, regexp_extract_all(translate(any_value(coalesce(text, '')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM r GROUP BY name
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT name, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT name, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw))
), hit AS (
  SELECT name, item_id, k, i FROM dw JOIN bw USING (k, g)
), words AS (
  SELECT name, count(DISTINCT p) AS n FROM (SELECT name, unnest(range(i, i + k)) AS p FROM hit) GROUP BY name
), items AS (
  SELECT name, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s
  FROM (SELECT DISTINCT name, item_id::VARCHAR AS x FROM hit) GROUP BY name
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM r JOIN d USING (name) LEFT JOIN words USING (name) LEFT JOIN items USING (name)
"""



def _crc32(value: str) -> str:
    """CRC-32 of a text's UTF-8, a byte at a time by the table of its reflected polynomial."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    step = f"xor(({table})[(xor(c, b) & 255) + 1], c >> 8)"
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({value})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce({bytes_}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


_OP7 = f"""
WITH r AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 16 AS size, {_crc32("coalesce(text, '')")} AS text_crc32,
    md5(concat_ws(':', '7', doc_id::VARCHAR)) AS shuffle FROM documents
), w AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY shuffle, doc_id NULLS FIRST) - 1)
    / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS fraction FROM r
), p AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, shuffle, doc_id NULLS FIRST) - 1 AS place,
    count(*) OVER () AS total FROM w
), s AS (SELECT *, place * 40 // total AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM s
"""

_OP8 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (('0x' || substr(hex, k // 4 * 5 + 1, 5))::BIGINT >> (15 - 5 * (k % 4)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def _leaf(**replaced: str) -> str:
    """The leaf's digest; the columns' text is replaced by name."""
    columns = (replaced.get(c, f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars", "text"))
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns) + ")"


#: Trees of language `g` (1 and up, in order) are reduced level by level, then that of the subroots (0).
_OP12 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, {_leaf()} AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf(n_chars="(n_chars + 1)::VARCHAR")} ELSE {_leaf()} END AS now
  FROM documents
), l AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d
), tree(g, level, i, node, n) AS (
  SELECT g, 0, i, leaf, n FROM l
  UNION ALL
  SELECT g, level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY g, level, i // 2, n
), top(level, i, node, n) AS (
  SELECT 0, g - 1, node, (SELECT max(g) FROM d) FROM tree WHERE n = 1
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, i // 2, n
), nodes AS (SELECT * FROM tree UNION ALL SELECT 0, * FROM top), wide AS (
  SELECT DISTINCT g, level FROM nodes WHERE n > 1
), places AS (
  SELECT l.g, l.i, w.g = 0 AS above, w.level, w.g AS h, CASE WHEN w.g = 0 THEN l.g - 1 ELSE l.i END >> w.level AS place
  FROM l JOIN wide w ON w.g IN (0, l.g)
), steps AS (
  SELECT p.g, p.i, string_agg(s.node, '' ORDER BY above, p.level) AS proof,
    list(CASE WHEN s.node IS NULL THEN '-' WHEN place % 2 = 1 THEN '<' || s.node ELSE '>' || s.node END ORDER BY above, p.level) AS folds
  FROM places p LEFT JOIN nodes s ON s.g = h AND s.level = p.level AND s.i = xor(place, 1) GROUP BY p.g, p.i
), f AS (
  SELECT l.doc_id, l.leaf, l.g, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(coalesce(folds, []), lambda x, s: sha256(CASE s[1] WHEN '<' THEN s[2:] || x WHEN '>' THEN x || s[2:] ELSE x END), now)
      AS folded_root
  FROM l LEFT JOIN steps s ON s.g = l.g AND s.i = l.i
)
SELECT doc_id, leaf, t.node AS subroot, r.node AS root, proof_sha256, folded_root, folded_root = r.node AS verified
FROM f JOIN tree t ON t.g = f.g AND t.n = 1 JOIN top r ON r.n = 1
"""

#: SQL for the operators that DuckDB can express. It has no BPE, zstd, HTML or suffix automata.
ORACLE_SQL = {
    "op3_quality_cascade": _OP3,
    "op6_winnowing": _OP6,
    "op7_interleaved_shards": _OP7,
    "op8_warc_dictionary": _OP8,
    "op12_merkle_manifest": _OP12,
}
