"""Queries of this package: name -> callable(spark, sf_dir); SQL where it can express them."""

from __future__ import annotations

import public_tokenizers

from . import decontaminate, fingerprint, html_text, jaccard_join, language_model, pii, quality, sentence_pieces, token_alignment, token_files, toxicity, url_filter, whitening
from .base import table

WORD_BPE, BYTE_BPE, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op3_sentence_pieces(spark, sf_dir):
    return sentence_pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_token_files(spark, sf_dir):
    return token_files.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op5_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, url_filter.listed_by_host(pages))


def op8_fingerprint(spark, sf_dir):
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op9_language_model(spark, sf_dir):
    return language_model.scores(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark, sf_dir):
    return token_alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES))


def op13_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_jaccard_join, op3_sentence_pieces, op4_token_files, op5_pii, op6_quality, op7_url_filter,
    op8_fingerprint, op9_language_model, op10_decontaminate, op11_whitening, op12_token_alignment, op13_html_text)}

_URL = """
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(act, h, s) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
c AS (SELECT *, regexp_replace(host, '^www\\.|:[0-9]*$', '', 'g') || regexp_replace(path, '/+$', '') AS canonical FROM p),
listed AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '(^|[.-])(spam|pills|casino|viagra|payday|replica|jackpot|lottery)($|[.-])')),
best AS (
  SELECT c.page_id, c.host, c.path, arg_max(r.h || r.s, length(r.h || r.s)) AS rule, arg_max(r.act, length(r.h || r.s)) AS act
  FROM (SELECT DISTINCT page_id, host, path FROM c) c JOIN r ON (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.s)
  GROUP BY ALL)
SELECT c.page_id, c.host, c.path, best.rule,
       CASE WHEN best.act IS NOT NULL THEN best.act WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM c LEFT JOIN best USING (page_id, host, path) LEFT JOIN listed USING (canonical)
"""

ORACLE = {"op7_url_filter": _URL}
