"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers

from . import bpe, collocations, conversation_repair, html_extract, langid, packing, pii, quality, toxicity, url_filter
from .common import stored, table
from .metric_join import near_duplicates
from .mph_dedup import exact_dedup
from .ngram_join import ngram_components


def op1_ngram_jaccard(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents"))


def op2_bpe(spark, sf_dir):
    return bpe.encode_report(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("in_history")


def op4_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"), stored)


def op6_best_fit_packing(spark, sf_dir):
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_extraction(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_embedding_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op12_conversation_repair(spark, sf_dir):
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


def op13_collocations(spark, sf_dir):
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def queries():
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_bpe": op2_bpe,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_toxicity": op4_toxicity,
        "op5_pii": op5_pii,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_language_id": op7_language_id,
        "op8_quality": op8_quality,
        "op9_html_extraction": op9_html_extraction,
        "op10_embedding_near_dedup": op10_embedding_near_dedup,
        "op11_url_filter": op11_url_filter,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_collocations": op13_collocations,
    }


OP3_SQL = r"""
  WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
             FROM documents),
  g AS (SELECT text_sha256, min(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM t GROUP BY text_sha256)
  SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)"""


OP1_SQL = r"""
  WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
          ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
        GROUP BY ALL),
  links AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
            WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
  reach AS (SELECT doc_id AS node, doc_id AS other FROM documents
            UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other)
  SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
  FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
  JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) m ON m.node = d.doc_id"""

OP10_SQL = """
  WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
  reach AS (SELECT vec_id AS node, vec_id AS other FROM embeddings
            UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other)
  SELECT e.vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
  FROM embeddings e LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) k ON k.x = e.vec_id
  JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) m ON m.node = e.vec_id"""


def oracle_sql():
    return {
        "op1_ngram_jaccard": OP1_SQL,
        "op10_embedding_near_dedup": OP10_SQL,
        "op3_exact_dedup": OP3_SQL,
        "op11_url_filter": url_filter.ORACLE,
        "op12_conversation_repair": conversation_repair.ORACLE,
        "op13_collocations": collocations.ORACLE,
    }
