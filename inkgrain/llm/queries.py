"""Queries of the operators in this package, each next to its SQL where SQL can say it."""

from __future__ import annotations

import os

from inkgrain.llm.ann import nearest
from inkgrain.llm.bpe import encode_documents
from inkgrain.llm.exact import exact_groups
from inkgrain.llm.htmltext import extract_text, train_pages
from inkgrain.llm.language import judged_languages
from inkgrain.llm.neardup import near_groups
from inkgrain.llm.novelty import secret_digest
from inkgrain.llm.packing import digest, pack
from inkgrain.llm.resample import resample
from inkgrain.llm.shared import table
from inkgrain.llm.spans import remove_repeats
from inkgrain.llm.toxicity import judged_toxicity
from inkgrain.llm.urls import judge_urls, rule_table
from inkgrain.llm.whitening import whiten

QUERIES = {}
#: Folder of the public vocabularies.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
ORACLES = {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


EXACT_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id FROM d)
"""


@query("op3_exact_dedup", EXACT_SQL)
def op3_exact_dedup(spark, sf):
    return exact_groups(table(spark, sf, "documents"))


#: The rules of the contract.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

URL_SQL = """
WITH p AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM p),
rules(verdict, host, path) AS (VALUES %s),
hits AS (
    SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM parts JOIN rules r ON (parts.host = r.host OR ends_with(parts.host, '.' || r.host)) AND starts_with(parts.path, r.path)
    GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN hits USING (page_id)
""" % ", ".join(f"('{v}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in RULES)


@query("op4_url_rules", URL_SQL)
def op4_url_rules(spark, sf):
    return judge_urls(table(spark, sf, "pages"), rule_table(spark, list(RULES)))


@query("op1_language")
def op1_language(spark, sf):
    return judged_languages(table(spark, sf, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


@query("op9_toxicity")
def op9_toxicity(spark, sf):
    return judged_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op7_packing")
def op7_packing(spark, sf):
    return digest(pack(table(spark, sf, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken"))


@query("op5_bpe")
def op5_bpe(spark, sf):
    columns = ("n_tokens", "ids_sha256", "decoded_sha256")
    return encode_documents(table(spark, sf, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", columns=columns)


@query("op6_nearest")
def op6_nearest(spark, sf):
    return nearest(table(spark, sf, "embeddings"))


@query("op8_html_text")
def op8_html_text(spark, sf):
    pages = table(spark, sf, "pages")
    return extract_text(pages, train_pages(pages))


@query("op10_near_dedup")
def op10_near_dedup(spark, sf):
    return near_groups(table(spark, sf, "documents")).drop("text_hash")


@query("op2_substring_dedup")
def op2_substring_dedup(spark, sf):
    return remove_repeats(table(spark, sf, "documents"), texts=False)


@query("op11_whitening")
def op11_whitening(spark, sf):
    return whiten(table(spark, sf, "embeddings"))


@query("op12_secrets")
def op12_secrets(spark, sf):
    return secret_digest(table(spark, sf, "documents"))


#: The checksum of a word is computed bit by bit: SQL has no crc32.
RESAMPLING_SQL = r"""
WITH RECURSIVE crc(k, i, c) AS (
    SELECT 0, CAST(range AS BIGINT), CAST(range AS BIGINT) FROM range(256)
    UNION ALL
    SELECT k + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
bytes AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
words AS MATERIALIZED (
    SELECT side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM (SELECT 's' AS side, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark)),
codes AS (
    SELECT word, list_transform(range(1, length(hex(encode(word))), 2), lambda p: CAST('0x' || substr(hex(encode(word)), CAST(p AS BIGINT), 2) AS BIGINT)) AS b
    FROM (SELECT DISTINCT word FROM words)),
placed AS MATERIALIZED (
    SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM codes, bytes),
sums AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM words JOIN placed USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM sums)::DOUBLE + 10000) / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM sums)::DOUBLE + 10000)))) AS BIGINT) AS gain
    FROM sums),
weights AS (
    SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
    FROM words JOIN placed USING (word) JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id),
scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM documents d LEFT JOIN weights USING (doc_id)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND r <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 THEN r END AS rank
FROM ranked
"""


@query("op13_resampling", RESAMPLING_SQL)
def op13_resampling(spark, sf):
    return resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
