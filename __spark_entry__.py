"""

Every query reads the driver's tables (or data Spark derives from them) in
full.  ``documents`` is the corpus: ``record_id = doc_id``, ``content = text``.
The transform of blocks is made of, and compared on, all blocks of 4,096 characters.
Of the rotations of the whole corpus, which SQL ranks by doubling, positions
divisible by 20 are compared.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

# the package sits next to this file; make it importable however the file is loaded
_HERE = str(Path(__file__).resolve().parent)
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastcol.operators import corpus_rotation as cr
from lastcol.operators import file_index as fi
from lastcol.operators import index as ix
from lastcol.operators import records as rec
from lastcol.operators import rotation as rot
from lastcol.operators import runs as rl
from lastcol.operators import search as se
from lastcol.operators import suffix_table as st
from lastcol.plans import segments as sg
from lastcol.plans.tables import documents, table
from lastcol.session import checkpoint_dir
from lastcol.sources import format_records, read_tagged, records_from, write_tagged_records
from lastcol.functions import encoded_run_bytes
from lastcol.sources.runs_store import compress, decompress, read_runs, write_runs

try:  # the training-data operators are an optional subpackage
    import corpus_pipeline
    from lastcol.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

SF0001 = "/root/testdata/sf0.001"

# The patterns used by the registered queries.
KEYWORD = "tion"
KEYWORD_NON_ASCII = "ción"
BOUNDARY_PATTERN = ".[1"
COUNT_PATTERN = "ana"
INDEXED_PATTERN = "nderou"
HITS_PATTERN = "the"
CHECKPOINT_CHUNK = 4
LOOKUP_IDS = [0, 7, 42, 199, 500, 999, 1_000_000_000]
SOURCE_PATTERN = "rc1"
CHECKED = 20  # of results that SQL cannot give in full, every 20th is compared


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lastcol-{name}-{uuid.uuid4().hex}"


def _doc_blocks(spark, sf):
    return rot.make_blocks(documents(spark, sf)).select("block_id", "text")


def _part_blocks(spark, sf):
    return (table(spark, sf, "part").filter(F.length("p_name") > 0)
            .select(F.col("p_partkey").alias("block_id"), F.col("p_name").alias("text")))


def _part_runs(spark, sf):
    return rl.text_runs(_part_blocks(spark, sf))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every record of the sf0.001 corpus containing ``tion``, by id."""
    return se.keyword_search(documents(spark, SF0001), KEYWORD)


# ---------------------------------------------------------------- queries

def q_keyword_search(spark, sf):
    return se.keyword_search(documents(spark, sf), KEYWORD)


def q_keyword_search_non_ascii(spark, sf):
    return se.keyword_search(documents(spark, sf), KEYWORD_NON_ASCII)


def q_records_from_pages(spark, sf):
    return records_from(table(spark, sf, "pages"), "page_id", "html")


def q_format_records(spark, sf):
    return format_records(documents(spark, sf))


def q_tagged_round_trip(spark, sf):
    path = _scratch(spark, "tagged")
    write_tagged_records(documents(spark, sf), path)
    return read_tagged(spark, path, strip_newline=True).records.select("record_id", "content")


def q_boundary_search(spark, sf):
    return se.search(documents(spark, sf), BOUNDARY_PATTERN)


def q_lookup_records(spark, sf):
    ids = table(spark, sf, "labels").select(F.col("doc_id").alias("record_id"))
    return rec.lookup_records(documents(spark, sf), ids)


def _event_records(spark, sf):
    ev = table(spark, sf, "events").filter(F.col("event_type") != "click")
    return records_from(ev, "event_id", "event_type")


def q_id_audit_events(spark, sf):
    return rec.id_audit(_event_records(spark, sf))


def q_id_audit_lineitem(spark, sf):
    return rec.id_audit(records_from(table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag"))


def q_next_record(spark, sf):
    return rec.next_record(documents(spark, sf))


def q_id_bounds(spark, sf):
    return rec.id_bounds(documents(spark, sf))


def _benchmark_patterns(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", F.col("text").alias("pattern"))


def q_multi_keyword_search(spark, sf):
    return ix.multi_keyword_search(documents(spark, sf), _benchmark_patterns(spark, sf))


def _built_index(spark, sf):
    index, _ = ix.ensure_index(documents(spark, sf), _scratch(spark, "index"))
    return index


def q_multi_keyword_search_grams(spark, sf):
    """On a stored index."""
    recs = documents(spark, sf)
    return ix.multi_keyword_search(recs, _benchmark_patterns(spark, sf), index=_built_index(spark, sf))


def _benchmark_words(spark, sf):
    words = table(spark, sf, "benchmark").select(
        F.explode(F.split(F.col("text"), " ")).alias("pattern"))
    return words.filter(F.length("pattern") > 0).distinct()


def q_multi_keyword_words(spark, sf):
    """On a stored index."""
    recs = documents(spark, sf)
    return ix.multi_keyword_search(recs, _benchmark_words(spark, sf), index=_built_index(spark, sf))


def q_multi_keyword_words_grams(spark, sf):
    return ix.multi_keyword_search(documents(spark, sf), _benchmark_words(spark, sf))


def q_distinct_hits(spark, sf):
    return se.distinct_hits(se.match_positions(documents(spark, sf), HITS_PATTERN))


def q_occurrence_count(spark, sf):
    return se.occurrence_count(documents(spark, sf), COUNT_PATTERN)


def q_occurrence_total(spark, sf):
    return se.occurrence_total(documents(spark, sf), COUNT_PATTERN)


def q_match_positions(spark, sf):
    return se.match_positions(documents(spark, sf), COUNT_PATTERN)


def q_runs_events(spark, sf):
    return rl.run_length_encode(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "event_type")


def q_runs_orders(spark, sf):
    return rl.run_length_encode(table(spark, sf, "orders"), "o_custkey",
                                ["o_orderdate", "o_orderkey"], "o_orderstatus")


def q_runs_conversations(spark, sf):
    return rl.run_length_encode(table(spark, sf, "conversations"), "conv_id", ["turn", "role"], "role")


def q_runs_lineitem_global(spark, sf):
    return rl.run_length_encode(table(spark, sf, "lineitem"), None,
                                ["l_orderkey", "l_linenumber", "l_returnflag"], "l_returnflag")


def q_text_runs(spark, sf):
    return rl.text_runs(_doc_blocks(spark, sf))


def q_run_length_decode(spark, sf):
    return rl.decode_text(rl.text_runs(_doc_blocks(spark, sf)))


def q_run_length_decode_rows(spark, sf):
    return rl.run_length_decode(_part_runs(spark, sf))


def q_runs_store_round_trip(spark, sf):
    path = _scratch(spark, "runs")
    write_runs(_part_runs(spark, sf), path)
    return read_runs(spark, path)


def q_compressed_size(spark, sf):
    return rl.compressed_size(rl.text_runs(_doc_blocks(spark, sf)))


def q_symbol_histogram(spark, sf):
    return rl.symbol_histogram(rl.text_runs(_doc_blocks(spark, sf)), "block_id", weight="run_len")


def q_symbol_histogram_corpus(spark, sf):
    return rl.symbol_histogram(rl.text_runs(_doc_blocks(spark, sf)), [], weight="run_len")


def q_block_checkpoints(spark, sf):
    return rl.block_checkpoints(rl.text_runs(_doc_blocks(spark, sf)), chunk=600)


def _part_positions(spark, sf):
    return rl.symbols(_part_blocks(spark, sf))


def q_symbol_at(spark, sf):
    return rl.symbol_at(_part_runs(spark, sf), _part_positions(spark, sf).select("block_id", "pos"))


def q_rank_at(spark, sf):
    runs = _part_runs(spark, sf)
    cps = rl.block_checkpoints(runs, chunk=CHECKPOINT_CHUNK)
    return rl.rank_at(runs, cps, _part_positions(spark, sf), chunk=CHECKPOINT_CHUNK)


def q_floor_join(spark, sf):
    ev = table(spark, sf, "events")
    purchases = ev.filter(F.col("event_type") == "purchase").select("user_id", "event_id", "ts", "value")
    clicks = ev.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    return sg.floor_join(purchases, clicks, "ts", "click_ts", ["user_id"])


def q_rotation_rank(spark, sf):
    return rot.rotation_rank(_part_blocks(spark, sf))


def q_bwt_part(spark, sf):
    return rot.bwt(_part_blocks(spark, sf))


def q_inverse_bwt_part(spark, sf):
    return rot.inverse_bwt(rot.bwt(_part_blocks(spark, sf)))


def q_bwt_documents(spark, sf):
    return rot.bwt(_doc_blocks(spark, sf))


def q_inverse_bwt_documents(spark, sf):
    return rot.inverse_bwt(rot.bwt(_doc_blocks(spark, sf)))


def q_compressed_size_bwt(spark, sf):
    """The compress path: blocks -> BWT -> runs -> encoded size."""
    b = rot.bwt(_doc_blocks(spark, sf)).select("block_id", F.col("bwt_text").alias("text"))
    return rl.compressed_size(rl.text_runs(b))


def q_corpus_rotation_rank(spark, sf):
    """All documents as one cyclic text."""
    ranks = cr.corpus_rotation_rank(documents(spark, sf))
    return ranks.filter(F.col("pos") % CHECKED == 0).select("pos", "symbol", "rank")


def q_corpus_runs(spark, sf):
    """The corpus compressed as one text: runs of its transform, summed up by symbol."""
    path = _scratch(spark, "corpus")
    cr.write_corpus(documents(spark, sf), path)
    runs = spark.read.parquet(f"{path}/runs")
    return runs.groupBy("symbol").agg(F.count("*").alias("n_runs"), F.sum("run_len").alias("n_chars"),
                                      F.sum(encoded_run_bytes("run_len")).cast("long").alias("encoded_bytes"))


def q_corpus_round_trip(spark, sf):
    """The corpus restored from the runs of its transform."""
    path = _scratch(spark, "corpus")
    cr.write_corpus(documents(spark, sf), path)
    return cr.read_corpus(spark, path)


def _suffixes(spark, sf):
    path = _scratch(spark, "suffixes")
    st.build_suffixes(documents(spark, sf), path)
    return path


def q_suffix_search(spark, sf):
    return st.search(spark, _suffixes(spark, sf), INDEXED_PATTERN)


def q_suffix_counts_words(spark, sf):
    """Occurrences of every benchmark word in every document."""
    return st.count_many(spark, _suffixes(spark, sf), _benchmark_words(spark, sf))


def _view(sf):
    return fi.FileView(f"{sf.rstrip('/')}/documents.parquet", "doc_id", "text")


def q_file_index_search(spark, sf):
    return fi.search(fi.update_index(spark, _view(sf), _scratch(spark, "files")), INDEXED_PATTERN)


def q_file_index_positions(spark, sf):
    """Match positions from positional postings; no text is read for them."""
    return fi.match_positions(fi.update_index(spark, _view(sf), _scratch(spark, "files")), COUNT_PATTERN)


def q_file_index_updates(spark, sf):
    """An index over a folder to which files come one by one, merged on the way."""
    folder, path = _scratch(spark, "folder"), _scratch(spark, "files")
    view = fi.FileView(folder, "doc_id", "text")
    for part in range(4):
        docs = table(spark, sf, "documents").select("doc_id", "text").filter(F.col("doc_id") % 4 == part)
        docs.write.mode("append").parquet(folder)
        index = fi.update_index(spark, view, path, merge_at=2)
    return fi.occurrence_count(index, COUNT_PATTERN)


def q_signed_search(spark, sf):
    """A folder of files searched by their signatures."""
    folder, path = _scratch(spark, "folder"), _scratch(spark, "signatures")
    table(spark, sf, "documents").select("doc_id", "text").repartitionByRange(8, "doc_id").write.parquet(folder)
    view = fi.FileView(folder, "doc_id", "text")
    fi.build_signatures(spark, view, path)
    return fi.signed_search(spark, view, path, INDEXED_PATTERN)


def q_index_reuse_other_view(spark, sf):
    """An index at the same place, of another column of the same files, is not taken for it."""
    path = _scratch(spark, "index")
    ix.build_index(documents(spark, sf), path)
    index, built = ix.ensure_index(records_from(table(spark, sf, "documents"), "doc_id", "source"), path)
    if not built:
        raise RuntimeError("the index of another view was reused")
    return ix.indexed_search(index, SOURCE_PATTERN)


def q_gram_postings(spark, sf):
    return ix.postings(documents(spark, sf))


def q_indexed_search(spark, sf):
    return ix.indexed_search(_built_index(spark, sf), INDEXED_PATTERN)


def q_index_reuse(spark, sf):
    """The index found again by its input's files; no record is read for that."""
    recs, path = documents(spark, sf), _scratch(spark, "index")
    ix.build_index(recs, path)
    index, built = ix.ensure_index(recs, path)
    if built:
        raise RuntimeError("the index was not reused")
    return ix.indexed_search(index, INDEXED_PATTERN)


def q_lookup_ids(spark, sf):
    return rec.lookup_records(documents(spark, sf), LOOKUP_IDS)


def q_tagged_malformed(spark, sf):
    """Every kind of malformed tag, made from all events."""
    path = _scratch(spark, "malformed")
    kind = F.col("event_id") % 5
    line = (F.when(kind == 0, F.concat(F.lit("["), F.col("event_id"), F.lit("]"), F.col("event_type")))
            .when(kind == 1, F.concat(F.lit("["), F.col("event_type"), F.lit("]"), F.col("event_id")))
            .when(kind == 2, F.concat(F.lit("[]"), F.col("event_id")))
            .when(kind == 3, F.concat(F.lit("["), F.col("event_id")))
            .otherwise(F.concat(F.lit("[99999999999999999999]"), F.col("event_id"))))
    table(spark, sf, "events").select(line.alias("value")).write.text(path)
    return read_tagged(spark, path, strip_newline=True).rejects.select(
        F.regexp_replace("raw", r"\n$", "").alias("raw"), "reason")


def q_compressed_store(spark, sf):
    """Blocks, transform, runs, store, and all the way back."""
    path = _scratch(spark, "compressed")
    compress(documents(spark, sf), path)
    return decompress(spark, path)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _core_queries() | _llm_queries()


def _llm_queries():
    if llm_queries is None:
        return {}
    return llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def _core_queries():
    return {
        "keyword_search": q_keyword_search,
        "keyword_search_non_ascii": q_keyword_search_non_ascii,
        "records_from_pages": q_records_from_pages,
        "format_records": q_format_records,
        "tagged_round_trip": q_tagged_round_trip,
        "boundary_search": q_boundary_search,
        "lookup_records": q_lookup_records,
        "id_audit_events": q_id_audit_events,
        "id_audit_lineitem": q_id_audit_lineitem,
        "next_record": q_next_record,
        "id_bounds": q_id_bounds,
        "multi_keyword_search": q_multi_keyword_search,
        "multi_keyword_search_grams": q_multi_keyword_search_grams,
        "multi_keyword_words": q_multi_keyword_words,
        "multi_keyword_words_grams": q_multi_keyword_words_grams,
        "distinct_hits": q_distinct_hits,
        "occurrence_count": q_occurrence_count,
        "occurrence_total": q_occurrence_total,
        "match_positions": q_match_positions,
        "runs_events": q_runs_events,
        "runs_orders": q_runs_orders,
        "runs_conversations": q_runs_conversations,
        "runs_lineitem_global": q_runs_lineitem_global,
        "text_runs": q_text_runs,
        "run_length_decode": q_run_length_decode,
        "run_length_decode_rows": q_run_length_decode_rows,
        "runs_store_round_trip": q_runs_store_round_trip,
        "compressed_size": q_compressed_size,
        "symbol_histogram": q_symbol_histogram,
        "symbol_histogram_corpus": q_symbol_histogram_corpus,
        "block_checkpoints": q_block_checkpoints,
        "symbol_at": q_symbol_at,
        "rank_at": q_rank_at,
        "floor_join": q_floor_join,
        "rotation_rank": q_rotation_rank,
        "bwt_part": q_bwt_part,
        "inverse_bwt_part": q_inverse_bwt_part,
        "bwt_documents": q_bwt_documents,
        "inverse_bwt_documents": q_inverse_bwt_documents,
        "compressed_size_bwt": q_compressed_size_bwt,
        "gram_postings": q_gram_postings,
        "indexed_search": q_indexed_search,
        "index_reuse": q_index_reuse,
        "lookup_ids": q_lookup_ids,
        "tagged_malformed": q_tagged_malformed,
        "compressed_store": q_compressed_store,
        "corpus_rotation_rank": q_corpus_rotation_rank,
        "corpus_runs": q_corpus_runs,
        "corpus_round_trip": q_corpus_round_trip,
        "suffix_search": q_suffix_search,
        "suffix_counts_words": q_suffix_counts_words,
        "file_index_search": q_file_index_search,
        "file_index_positions": q_file_index_positions,
        "file_index_updates": q_file_index_updates,
        "signed_search": q_signed_search,
        "index_reuse_other_view": q_index_reuse_other_view,
    }


# ---------------------------------------------------------------- oracles

def _blocks_sql(size: int) -> str:
    return f"""
  SELECT doc_id * 65536 + s AS block_id, substr(text, CAST(s * {size} + 1 AS BIGINT), {size}) AS text
  FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / {size}.0) AS BIGINT))) AS s
        FROM documents WHERE length(text) > 0)"""


_DOC_BLOCKS = _blocks_sql(4096)

_PART_BLOCKS = "SELECT p_partkey AS block_id, p_name AS text FROM part WHERE length(p_name) > 0"


def _chars(blocks: str) -> str:
    return f"""
  SELECT block_id, CAST(generate_subscripts(c, 1) - 1 AS BIGINT) AS pos, unnest(c) AS symbol
  FROM (SELECT block_id, string_split(text, '') AS c FROM ({blocks}))"""


def _text_runs(blocks: str) -> str:
    return f"""
  WITH ch AS ({_chars(blocks)}),
  f AS (SELECT *, CASE WHEN lag(symbol) OVER (PARTITION BY block_id ORDER BY pos) = symbol
                       THEN 0 ELSE 1 END AS chg FROM ch),
  g AS (SELECT *, sum(chg) OVER (PARTITION BY block_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS run_no FROM f)
  SELECT block_id, CAST(run_no AS BIGINT) AS run_no, min(symbol) AS symbol,
         CAST(min(pos) AS BIGINT) AS start_pos, CAST(count(*) AS BIGINT) AS run_len
  FROM g GROUP BY block_id, run_no"""


def _runs_sql(src: str, by: list[str], order: list[str], value: str) -> str:
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    ordr = ", ".join(order)
    keys = ", ".join(by + ["run_no"])
    sel_by = "".join(f"{b}, " for b in by)
    return f"""
  WITH r AS (SELECT {sel_by}{ordr}{'' if value in order else ', ' + value},
                    row_number() OVER ({part}ORDER BY {ordr}) AS rn FROM {src}),
  f AS (SELECT *, CASE WHEN lag({value}) OVER ({part}ORDER BY rn) IS NOT DISTINCT FROM {value}
                       AND rn > 1 THEN 0 ELSE 1 END AS chg FROM r),
  g AS (SELECT *, sum(chg) OVER ({part}ORDER BY rn ROWS UNBOUNDED PRECEDING) - 1 AS run_no FROM f)
  SELECT {sel_by}CAST(run_no AS BIGINT) AS run_no, min({value}) AS {value},
         min({order[0]}) AS start, CAST(count(*) AS BIGINT) AS run_len
  FROM g GROUP BY {keys}"""


def _encoded_bytes(n: str) -> str:
    return (f"CASE WHEN {n} = 1 THEN 1 WHEN {n} = 2 THEN 2 WHEN {n} - 3 < 128 THEN 2 "
            f"WHEN {n} - 3 < 16384 THEN 3 WHEN {n} - 3 < 2097152 THEN 4 "
            f"WHEN {n} - 3 < 268435456 THEN 5 ELSE 6 END")


def _positions(pattern: str) -> str:
    m = len(pattern)
    return (f"list_filter(range(1, length(text) - {m} + 2), lambda i: substr(text, i, {m}) = '{pattern}')")


def _bwt_sql(blocks: str) -> str:
    return f"""
  WITH b AS ({blocks}),
  r AS (SELECT block_id, text, length(text) AS n, unnest(range(length(text))) AS i FROM b),
  k AS (SELECT block_id, n, i, substr(text, i + 1) || substr(text, 1, i) AS rot,
               substr(text, ((i + n - 1) % n) + 1, 1) AS last FROM r)
  SELECT block_id, string_agg(last, '' ORDER BY rot, i) AS bwt_text,
         CAST(min(CASE WHEN i = 0 THEN rk END) AS BIGINT) AS start_rank,
         CAST(count(DISTINCT rot) AS BIGINT) AS period
  FROM (SELECT *, row_number() OVER (PARTITION BY block_id ORDER BY rot, i) - 1 AS rk FROM k)
  GROUP BY block_id"""


def _corpus_ranks(rounds: int = 6) -> str:
    """CTEs up to ``ranks(pos, symbol, last, r)``: all documents end to end; ranks by the
    first 64 characters, then, where tied, by those of the rotations k, 2k and 3k ahead."""
    out = """
  txt AS MATERIALIZED (SELECT string_agg('[' || doc_id || ']' || coalesce(text, ''), '' ORDER BY doc_id) AS t FROM documents),
  tot AS MATERIALIZED (SELECT length(t) AS n, t || left(t, 64) AS t FROM txt),
  ck AS (SELECT s * 1024 AS base, substr(t, s * 1024 + 1, 1024 + 64) AS t, least(1024, n - s * 1024) AS k
         FROM (SELECT n, t, unnest(range(0, CAST(ceil(n / 1024.0) AS BIGINT))) AS s FROM tot)),
  ch AS MATERIALIZED (SELECT base + i AS pos, substr(t, i + 1, 64) AS key FROM (SELECT base, t, unnest(range(0, k)) AS i FROM ck)),
  r0 AS MATERIALIZED (SELECT pos, rank() OVER (ORDER BY key) - 1 AS r FROM ch)"""
    for i in range(rounds):
        k = 64 * 4 ** i
        out += f""",
  t{i} AS MATERIALIZED (SELECT pos, r, (pos + {k}) % n AS p1, (pos + {2 * k}) % n AS p2, (pos + {3 * k}) % n AS p3 FROM r{i}, tot
    WHERE r IN (SELECT r FROM r{i} GROUP BY r HAVING count(*) > 1)),
  r{i + 1} AS MATERIALIZED (SELECT pos, r FROM r{i} WHERE pos NOT IN (SELECT pos FROM t{i}) UNION ALL
    SELECT a.pos, a.r + rank() OVER (PARTITION BY a.r ORDER BY b.r, c.r, d.r) - 1 AS r
    FROM t{i} a JOIN r{i} b ON b.pos = a.p1 JOIN r{i} c ON c.pos = a.p2 JOIN r{i} d ON d.pos = a.p3)"""
    return out + f""",
  x AS MATERIALIZED (SELECT pos, r, (pos + n - 1) % n AS p FROM r{rounds}, tot),
  ranks AS MATERIALIZED (SELECT x.pos, left(c.key, 1) AS symbol, left(p.key, 1) AS last, x.r
                         FROM x JOIN ch c ON c.pos = x.pos JOIN ch p ON p.pos = x.p)"""


def _size_sql(runs: str) -> str:
    return f"""
  WITH r AS ({runs})
  SELECT block_id, CAST(sum(run_len) AS BIGINT) AS n_chars, CAST(count(*) AS BIGINT) AS n_runs,
         CAST(sum({_encoded_bytes('run_len')}) AS BIGINT) AS encoded_bytes,
         CAST(sum({_encoded_bytes('run_len')}) AS DOUBLE) / CAST(sum(run_len) AS DOUBLE) AS ratio
  FROM r GROUP BY ROLLUP (block_id)"""


def oracle_sql() -> dict[str, str]:
    out = _core_oracles()
    if llm_queries is not None:
        out |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def _core_oracles():
    docs = "SELECT doc_id AS record_id, text AS content FROM documents"
    ev_recs = "SELECT event_id AS record_id, event_type AS content FROM events WHERE event_type <> 'click'"
    li_recs = "SELECT l_orderkey AS record_id, l_returnflag AS content FROM lineitem"

    def audit(src: str) -> str:
        return f"""
  WITH ids AS (SELECT record_id, count(*) AS n FROM ({src}) GROUP BY record_id)
  SELECT record_id, 'gap' AS problem, CAST(1 AS BIGINT) AS n FROM ids
  WHERE record_id <> (SELECT max(record_id) FROM ids)
    AND record_id + 1 NOT IN (SELECT record_id FROM ids)
  UNION ALL
  SELECT record_id, 'duplicate' AS problem, CAST(n AS BIGINT) AS n FROM ids WHERE n > 1"""

    words = """SELECT DISTINCT w AS pattern FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark)
               WHERE length(w) > 0"""
    part_chars = _chars(_PART_BLOCKS)
    return {
        "keyword_search": f"{docs} WHERE contains(text, '{KEYWORD}') ORDER BY doc_id",
        "keyword_search_non_ascii": f"{docs} WHERE contains(text, '{KEYWORD_NON_ASCII}') ORDER BY doc_id",
        "records_from_pages": "SELECT page_id AS record_id, html AS content FROM pages",
        "format_records": "SELECT '[' || CAST(doc_id AS VARCHAR) || ']' || text AS value FROM documents",
        "tagged_round_trip": docs,
        "boundary_search": f"""
  SELECT d.doc_id AS record_id, d.text AS content FROM documents d
  JOIN documents n ON n.doc_id = CASE WHEN d.doc_id = (SELECT max(doc_id) FROM documents)
                                      THEN (SELECT min(doc_id) FROM documents) ELSE d.doc_id + 1 END
  WHERE ends_with(d.text, '.') AND starts_with(CAST(n.doc_id AS VARCHAR), '1')
  ORDER BY d.doc_id""",
        "lookup_records": f"{docs} WHERE doc_id IN (SELECT doc_id FROM labels)",
        "id_audit_events": audit(ev_recs),
        "id_audit_lineitem": audit(li_recs),
        "next_record": """
  SELECT d.doc_id AS record_id, n.doc_id AS next_id, n.text AS next_content FROM documents d
  JOIN documents n ON n.doc_id = CASE WHEN d.doc_id = (SELECT max(doc_id) FROM documents)
                                      THEN (SELECT min(doc_id) FROM documents) ELSE d.doc_id + 1 END""",
        "id_bounds": "SELECT min(doc_id) AS min_id, max(doc_id) AS max_id FROM documents",
        "multi_keyword_search": """
  SELECT b.item_id, b.text AS pattern, d.doc_id AS record_id
  FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE length(b.text) > 0""",
        "multi_keyword_search_grams": """
  SELECT b.item_id, b.text AS pattern, d.doc_id AS record_id
  FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE length(b.text) > 0""",
        "multi_keyword_words": f"""
  SELECT w.pattern, d.doc_id AS record_id FROM ({words}) w JOIN documents d ON contains(d.text, w.pattern)""",
        "multi_keyword_words_grams": f"""
  SELECT w.pattern, d.doc_id AS record_id FROM ({words}) w JOIN documents d ON contains(d.text, w.pattern)""",
        "distinct_hits": f"SELECT DISTINCT doc_id AS record_id FROM documents WHERE contains(text, '{HITS_PATTERN}')",
        "occurrence_count": f"""
  SELECT doc_id AS record_id, CAST(len({_positions(COUNT_PATTERN)}) AS BIGINT) AS n
  FROM documents WHERE contains(text, '{COUNT_PATTERN}')""",
        "occurrence_total": f"""
  SELECT CAST(count(*) AS BIGINT) AS n_records, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_occurrences
  FROM (SELECT len({_positions(COUNT_PATTERN)}) AS n FROM documents WHERE contains(text, '{COUNT_PATTERN}'))""",
        "match_positions": f"""
  SELECT doc_id AS record_id, CAST(unnest({_positions(COUNT_PATTERN)}) AS BIGINT) AS pos
  FROM documents WHERE contains(text, '{COUNT_PATTERN}')""",
        "runs_events": _runs_sql("events", ["user_id"], ["ts", "event_id"], "event_type"),
        "runs_orders": _runs_sql("orders", ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus"),
        "runs_conversations": _runs_sql("conversations", ["conv_id"], ["turn", "role"], "role"),
        "runs_lineitem_global": _runs_sql("lineitem", [], ["l_orderkey", "l_linenumber", "l_returnflag"],
                                          "l_returnflag"),
        "text_runs": _text_runs(_DOC_BLOCKS),
        "run_length_decode": _DOC_BLOCKS,
        "run_length_decode_rows": f"SELECT block_id, pos, symbol FROM ({part_chars})",
        "runs_store_round_trip": _text_runs(_PART_BLOCKS),
        "compressed_size": _size_sql(_text_runs(_DOC_BLOCKS)),
        "compressed_size_bwt": _size_sql(_text_runs(
            f"SELECT block_id, bwt_text AS text FROM ({_bwt_sql(_DOC_BLOCKS)})")),
        "symbol_histogram": f"""
  WITH c AS (SELECT block_id, symbol, CAST(count(*) AS BIGINT) AS cnt FROM ({_chars(_DOC_BLOCKS)})
             GROUP BY block_id, symbol)
  SELECT block_id, symbol, cnt,
         CAST(coalesce(sum(cnt) OVER (PARTITION BY block_id ORDER BY symbol
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cnt_smaller
  FROM c""",
        "symbol_histogram_corpus": f"""
  WITH c AS (SELECT symbol, CAST(count(*) AS BIGINT) AS cnt FROM ({_chars(_DOC_BLOCKS)}) GROUP BY symbol)
  SELECT symbol, cnt,
         CAST(coalesce(sum(cnt) OVER (ORDER BY symbol ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS BIGINT) AS cnt_smaller
  FROM c""",
        "block_checkpoints": f"""
  WITH ch AS ({_chars(_DOC_BLOCKS)}),
  per AS (SELECT block_id, pos // 600 AS chunk_no, symbol, count(*) AS n FROM ch GROUP BY ALL),
  syms AS (SELECT DISTINCT block_id, symbol FROM ch),
  chunks AS (SELECT block_id, unnest(range(0, max(pos) // 600 + 1)) AS chunk_no FROM ch GROUP BY block_id),
  grid AS (SELECT s.block_id, c.chunk_no, s.symbol FROM syms s JOIN chunks c ON s.block_id = c.block_id)
  SELECT g.block_id, CAST(g.chunk_no AS BIGINT) AS chunk_no, g.symbol,
         CAST(coalesce(sum(p.n) OVER (PARTITION BY g.block_id, g.symbol ORDER BY g.chunk_no
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cnt_before
  FROM grid g LEFT JOIN per p ON g.block_id = p.block_id AND g.chunk_no = p.chunk_no AND g.symbol = p.symbol""",
        "symbol_at": f"SELECT block_id, pos, symbol FROM ({part_chars})",
        "rank_at": f"""
  SELECT block_id, pos, symbol,
         CAST(length(substr(text, 1, pos + 1)) - length(replace(substr(text, 1, pos + 1), symbol, ''))
              AS BIGINT) AS occ
  FROM ({part_chars}) JOIN ({_PART_BLOCKS}) USING (block_id)""",
        "floor_join": """
  WITH p AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase'),
       c AS (SELECT user_id, event_id AS click_id, ts AS click_ts FROM events WHERE event_type = 'click')
  SELECT p.user_id, p.event_id, p.ts, p.value, c.click_id, c.click_ts
  FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND c.click_ts <= p.ts""",
        "rotation_rank": f"""
  WITH b AS ({_PART_BLOCKS}),
  r AS (SELECT block_id, text, unnest(range(length(text))) AS i FROM b)
  SELECT block_id, CAST(i AS BIGINT) AS pos, substr(text, i + 1, 1) AS symbol,
         CAST(rank() OVER (PARTITION BY block_id ORDER BY substr(text, i + 1) || substr(text, 1, i)) - 1
              AS BIGINT) AS rank
  FROM r""",
        "bwt_part": _bwt_sql(_PART_BLOCKS),
        "inverse_bwt_part": _PART_BLOCKS,
        "bwt_documents": _bwt_sql(_DOC_BLOCKS),
        "corpus_rotation_rank": f"""
  WITH {_corpus_ranks()}
  SELECT pos, symbol, CAST(r AS BIGINT) AS rank FROM ranks WHERE pos % {CHECKED} = 0""",
        "corpus_runs": f"""
  WITH {_corpus_ranks()},
  f AS (SELECT row_number() OVER (ORDER BY r, pos) AS i, last,
               CASE WHEN lag(last) OVER (ORDER BY r, pos) = last THEN 0 ELSE 1 END AS chg FROM ranks),
  g AS (SELECT last, sum(chg) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM f),
  u AS (SELECT any_value(last) AS symbol, count(*) AS k FROM g GROUP BY run)
  SELECT symbol, CAST(count(*) AS BIGINT) AS n_runs, CAST(sum(k) AS BIGINT) AS n_chars,
         CAST(sum({_encoded_bytes('k')}) AS BIGINT) AS encoded_bytes FROM u GROUP BY symbol""",
        "corpus_round_trip": docs,
        "suffix_search": f"{docs} WHERE contains(text, '{INDEXED_PATTERN}') ORDER BY doc_id",
        "suffix_counts_words": f"""
  WITH w AS ({words}),
  m AS (SELECT max(length(pattern)) AS most FROM w),
  c AS (SELECT doc_id, substr(text, CAST(s * 256 + 1 AS BIGINT), 256 + most) AS t, least(256, length(text) - s * 256) AS k
        FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / 256.0) AS BIGINT))) AS s FROM documents), m),
  i AS (SELECT doc_id, t, unnest(range(1, k + 1)) AS i FROM c),
  g AS (SELECT doc_id, substr(t, i, size) AS pattern FROM i, (SELECT DISTINCT length(pattern) AS size FROM w)
        WHERE i + size - 1 <= length(t))
  SELECT pattern, doc_id AS record_id, CAST(count(*) AS BIGINT) AS n FROM g JOIN w USING (pattern) GROUP BY ALL""",
        "file_index_search": f"{docs} WHERE contains(text, '{INDEXED_PATTERN}') ORDER BY doc_id",
        "file_index_positions": f"""
  SELECT doc_id AS record_id, CAST(unnest({_positions(COUNT_PATTERN)}) AS BIGINT) AS pos
  FROM documents WHERE contains(text, '{COUNT_PATTERN}')""",
        "file_index_updates": f"""
  SELECT doc_id AS record_id, CAST(len({_positions(COUNT_PATTERN)}) AS BIGINT) AS n
  FROM documents WHERE contains(text, '{COUNT_PATTERN}')""",
        "signed_search": f"{docs} WHERE contains(text, '{INDEXED_PATTERN}') ORDER BY doc_id",
        "index_reuse_other_view": f"""
  SELECT doc_id AS record_id, source AS content FROM documents WHERE contains(source, '{SOURCE_PATTERN}') ORDER BY doc_id""",
        "inverse_bwt_documents": _DOC_BLOCKS,
        "gram_postings": """
  SELECT DISTINCT gram, record_id FROM (
    SELECT doc_id AS record_id,
           unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
    FROM (SELECT doc_id, string_split(text, '') AS c FROM documents WHERE length(text) >= 3))""",
        "indexed_search": f"{docs} WHERE contains(text, '{INDEXED_PATTERN}') ORDER BY doc_id",
        "index_reuse": f"{docs} WHERE contains(text, '{INDEXED_PATTERN}') ORDER BY doc_id",
        "lookup_ids": f"{docs} WHERE doc_id IN ({', '.join(map(str, LOOKUP_IDS))})",
        "compressed_store": docs,
        "tagged_malformed": """
  SELECT CASE event_id % 5 WHEN 1 THEN event_type || ']' || event_id WHEN 2 THEN ']' || event_id
              WHEN 3 THEN CAST(event_id AS VARCHAR) ELSE '99999999999999999999]' || event_id END AS raw,
         CASE event_id % 5 WHEN 1 THEN 'id not a number' WHEN 2 THEN 'empty id'
              WHEN 3 THEN 'missing ]' ELSE 'id out of range' END AS reason
  FROM events WHERE event_id % 5 <> 0""",
    }
