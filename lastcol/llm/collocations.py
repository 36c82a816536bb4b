"""Phrase collocations by multikey three-way quicksort of suffix pointers.

A text is lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and
pieces into words.  A suffix is a word with up to four words after it in its
piece.  Three passes:

1. *Survey.*  Words are counted per language, and pairs, triples and
   quadruples in counter tables of a fixed size.  A counter is never below
   the count of what falls on it, so a pair on a counter under the threshold is
   infrequent for certain.
2. *Routing.*  A suffix is cut before its first infrequent pair.  What is
   left goes to the route of its leading words: two, or as many as it takes to
   leave prefixes behind that are too frequent for one route.  Equal suffixes
   of a batch are one row with a weight, so copies cost little.
3. *Sorting.*  A route sorts pointers to its suffixes by multikey three-way
   quicksort, word by word to the greatest depth.  The size of a partition of
   equal words is the count of their phrase; a partition below the threshold is
   abandoned.  Prefixes that were spread over several routes are never
   abandoned, and their partial counts are added up.

Scores, nested phrases and ranks are joins and aggregations on the counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .shingles import mix64

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Counters of pairs, and of triples and quadruples (these only tell what is
#: too frequent for one route).  Larger tables prune more; none changes a result.
PAIR_BITS = 22
LONG_BITS = 18
#: Bits of the table of frequent words.
WORD_BITS = 24
#: Suffixes of a route, and occurrences of a prefix that may share one.
ROUTE_ROWS = 1 << 19
#: Suffixes that a task holds before it sends them on.
HELD_ROWS = 1 << 18
#: Bytes of text handled at once.
WINDOW = 1 << 20
#: Partial rankings of a language.
SALTS = 256

_U = np.uint64
_LONG_WORD = 256
_BLOCK = 1 << 16
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: ends a piece
_KIND[[32, 9]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_TABLE = mix64(np.arange(256, dtype=_U), 11)
_TABLE[65:91] = _TABLE[97:123]  # A-Z count as a-z
_POWERS = np.array([pow(0x9FB21C651E98DF25, i, 1 << 64) for i in range(_LONG_WORD)], dtype=_U)
_STEPS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(MAX_WORDS)], dtype=_U)


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word of ``data``: its hash (never 0), whether it opens a piece,
    its first byte and the byte behind its last."""
    buf, at, pieces = np.frombuffer(data, np.uint8), 0, 0
    hashes, piece, starts, ends = [], [], [], []
    while at < len(buf):
        end = min(len(buf), at + WINDOW)
        while end < len(buf):  # cut behind a separator, so that no word is cut
            gaps = np.flatnonzero(_KIND[buf[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(len(buf), end + WINDOW)
        part = buf[at:end]
        kind = _KIND[part]
        edge = np.diff(np.concatenate([[0], (kind == 0).view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        breaks = np.cumsum(kind == 2)
        if len(first):
            size = last - first
            begin = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(begin, size)
            letters = part[np.repeat(first, size) + place]
            h = np.add.reduceat(_TABLE[letters] * _POWERS[place % _LONG_WORD], begin) + size.astype(_U)
            h = mix64(h, 5)
            for i in np.flatnonzero(size > _LONG_WORD):
                low = part[first[i]:last[i]].tobytes().lower()
                h[i] = int.from_bytes(blake2b(low, digest_size=8).digest(), "little")
            hashes.append(np.maximum(h, _U(1)))
            piece.append(breaks[first] + pieces)
            starts.append(first + at)
            ends.append(last + at)
        pieces += int(breaks[-1])
        at = end
    if not hashes:
        return np.empty(0, _U), np.empty(0, bool), np.empty(0, np.int64), np.empty(0, np.int64)
    piece = np.concatenate(piece)
    return (np.concatenate(hashes), np.diff(piece, prepend=-1) != 0, np.concatenate(starts), np.concatenate(ends))


def _bytes_by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts of one language, joined by line ends, up to WINDOW bytes or one
    text, from the bytes of Arrow batches ``(lang, text)``."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        codes, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
        texts = batch.column(1).cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1].tolist()
        data = memoryview(texts.buffers()[2] or b"")
        for code, lang in enumerate(names):
            held, size = [], 0
            for i in np.flatnonzero(codes == code).tolist():
                raw = data[ends[i]:ends[i + 1]]
                if held and size + len(raw) > WINDOW:
                    yield lang, b"\n".join(held)
                    held, size = [], 0
                held.append(raw)
                size += len(raw) + 1
            yield lang, b"\n".join(held)


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, types[kind]) for v, (_, kind) in zip(columns, fields, strict=True)],
                                      names=[name for name, _ in fields])


def _lang_hash(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _prefix_hashes(h: np.ndarray, lang: str, words: int) -> np.ndarray:
    """Hash of the ``words`` words from each position on (past the end: zeros)."""
    out = np.full(len(h), _lang_hash(lang), _U)
    for j in range(min(words, len(h))):
        out[:len(h) - j] += h[j:] * _STEPS[j]
    return mix64(out, words)


def _and_ahead(flags: np.ndarray, other: np.ndarray, j: int) -> None:
    """``flags`` where ``other`` holds ``j`` places ahead too, in place."""
    left = max(0, len(flags) - j)
    flags[:left] &= other[j:]
    flags[left:] = False


def _joined(fresh: np.ndarray, words: int) -> np.ndarray:
    """Whether the ``words`` words from each position on lie in one piece."""
    inner = np.append(~fresh[1:], False) if len(fresh) else np.zeros(0, bool)
    out = inner.copy()
    for j in range(1, words - 1):
        _and_ahead(out, inner, j)
    return out


def _slots(h: np.ndarray, lang: str, words: int) -> np.ndarray:
    bits = PAIR_BITS if words == 2 else LONG_BITS
    return (_prefix_hashes(h, lang, words) >> _U(64 - bits)).astype(np.int64)


_SURVEY = "lang string, word string, h long, n long, words int, part int, data binary"


def _survey(batches):
    """Distinct words of each stretch of text, and at the end the task's counters."""
    tables = {w: np.zeros(1 << (PAIR_BITS if w == 2 else LONG_BITS), np.uint32) for w in (2, 3, 4)}
    for lang, data in _bytes_by_lang(batches):
        h, fresh, start, end = words_of(data)
        if not len(h):
            continue
        for w, table in tables.items():
            got, count = np.unique(_slots(h, lang, w)[_joined(fresh, w)], return_counts=True)
            table[got] = np.minimum(table[got].astype(np.int64) + count, 0xFFFFFFFF)
        got, first, count = np.unique(h, return_index=True, return_counts=True)
        n, low = len(got), data.lower()  # of bytes: A-Z only
        words = [low[a:b].decode("utf-8", "replace") for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        yield _batch(_SURVEY, [[lang] * n, words, got.view(np.int64), count, np.ones(n, np.int32), np.zeros(n, np.int32), [None] * n])
    for w, table in tables.items():
        some = [p for p in range(0, len(table), _BLOCK) if table[p:p + _BLOCK].any()]
        n = len(some)
        yield _batch(_SURVEY, [[None] * n, [None] * n, [0] * n, [0] * n, [w] * n, [p // _BLOCK for p in some],
                               [zlib.compress(table[p:p + _BLOCK].tobytes(), 1) for p in some]])


_BITS = "words int, part int, salt int, some binary, hot binary, rows long"


def _summed(frames) -> Iterator[tuple[tuple, np.ndarray]]:
    """Sum of the blocks of each ``(words, part, salt)``, which come in order: one
    block is held, however many tasks made one."""
    at, total = None, None
    for pdf in frames:
        for *key, data in zip(pdf["words"], pdf["part"], pdf["salt"], pdf["data"], strict=True):
            if key != at:
                if at is not None:
                    yield at, total
                at, total = key, np.zeros(_BLOCK, np.int64)
            total += np.frombuffer(zlib.decompress(data), np.uint32)
    if at is not None:
        yield at, total


def _add_tables(frames):
    for (w, p, s), total in _summed(frames):
        yield pd.DataFrame({"words": [w], "part": [p], "salt": [s],
                            "data": [zlib.compress(np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)]})


def _table_bits(least: int, hot: int):
    """Per block: bits of the counters from ``least`` and over ``hot`` on, and the sum of the former."""
    def run(frames):
        for (w, p, s), t in _summed(frames):
            yield pd.DataFrame({"words": [w], "part": [p], "salt": [s], "some": [np.packbits(t >= least).tobytes()],
                                "hot": [np.packbits(t > hot).tobytes()], "rows": [int(t[t >= least].sum())]})
    return run


def _word_bits(key, pdf: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(_BLOCK, bool)
    bits[pdf["bit"].to_numpy() % _BLOCK] = True
    return pd.DataFrame({"part": [key[0]], "data": [np.packbits(bits).tobytes()]})


def _bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


_SENT = "route long, lang string, data binary"


def _routed(some: np.ndarray, hot: dict[int, np.ndarray], common: np.ndarray, routes: int, max_words: int):
    """Suffixes of a batch, packed by language and route.  The first three are
    packed bits: pairs that may be frequent, prefixes of too many suffixes for
    one route, frequent words."""
    def packed(lang, cols, depth, led):
        whole = np.full(len(depth), _lang_hash(lang), _U)
        for j, c in enumerate(cols):
            whole += mix64(c, 9 + j)
        _, first, weight = np.unique(whole, return_index=True, return_counts=True)
        cols, depth, led = [c[first] for c in cols], depth[first], led[first]
        lead = np.full(len(first), _lang_hash(lang), _U)
        for j, c in enumerate(cols):
            lead += np.where(np.minimum(led + 1, depth) > j, c, _U(0)) * _STEPS[j]
        route = (mix64(lead, 3) % _U(routes)).astype(np.int64)
        order = np.lexsort((depth, route))
        cuts = np.flatnonzero(np.diff(route[order], prepend=-1))
        numbers, blobs = [], []
        for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            own = order[a:b]
            raw = [np.bincount(depth[own], minlength=MAX_WORDS + 1).astype(np.int32).tobytes(),
                   weight[own].astype(np.int64).tobytes(), led[own].astype(np.uint8).tobytes()]
            raw += [c[own[depth[own] > j]].tobytes() for j, c in enumerate(cols)]
            numbers.append(int(route[own[0]]))
            blobs.append(b"".join(raw))
        return _batch(_SENT, [numbers, [lang] * len(blobs), blobs])

    def run(batches):
        held: dict[str, list] = {}
        size = 0
        for lang, data in _bytes_by_lang(batches):
            h, fresh, _, _ = words_of(data)
            if not len(h):
                continue
            usual = _bit(common, (h >> _U(64 - WORD_BITS)).astype(np.int64))
            pair = _joined(fresh, 2) & _bit(some, _slots(h, lang, 2)) & usual & np.append(usual[1:], False)
            at, depth = pair.copy(), 1 + pair.astype(np.int64)
            for j in range(1, max_words - 1):
                _and_ahead(at, pair, j)
                depth += at
            led, spread = np.ones(len(h), np.int64), np.ones(len(h), bool)
            for w in (2, 3, 4):
                spread &= (depth >= w) & _bit(hot[w], _slots(h, lang, w))
                led += spread
            keep = np.flatnonzero(pair)
            padded = np.append(h, np.zeros(max_words, _U))
            cols = [np.where(depth[keep] > j, padded[keep + j], _U(0)) for j in range(max_words)]
            held.setdefault(lang, []).append((*cols, depth[keep], led[keep]))
            size += len(keep)
            if size > HELD_ROWS:
                yield from flush(held)
                held, size = {}, 0
        yield from flush(held)

    def flush(held):
        for lang, got in held.items():
            *cols, depth, led = (np.concatenate(c) for c in zip(*got, strict=True))
            if len(depth):
                yield packed(lang, cols, depth, led)
    return run


def _unpacked(raw: bytes, max_words: int):
    sizes = np.frombuffer(raw, np.int32, MAX_WORDS + 1)
    m, at = int(sizes.sum()), 4 * (MAX_WORDS + 1)
    weight = np.frombuffer(raw, np.int64, m, at)
    led = np.frombuffer(raw, np.uint8, m, at + 8 * m)
    depth, at, cols = np.repeat(np.arange(MAX_WORDS + 1), sizes), at + 9 * m, []
    for j in range(max_words):
        col = np.zeros(m, _U)
        n = int((depth > j).sum())
        col[depth > j] = np.frombuffer(raw, _U, n, at)
        at += 8 * n
        cols.append(col)
    return (*cols, weight, led)


def frequent_prefixes(cols: list[np.ndarray], weight: np.ndarray, led: np.ndarray, least: int):
    """``(pointer, words, count)`` of the prefixes of two words and more that
    occur ``least`` times, or that other routes hold too (``led`` gives how many
    of a suffix's leading words are such a prefix; 1: none).

    Multikey three-way quicksort: pointers to suffixes are split by their word at
    one depth into smaller, equal and larger; the equal ones go on at the next
    depth.  Partitions that can hold nothing of use are abandoned.
    """
    out = []

    def alive(ptr: np.ndarray, depth: int) -> bool:
        return len(ptr) > 0 and (int(weight[ptr].sum()) >= least or bool((led[ptr] > depth).any()))

    todo = [(np.arange(len(weight)), 0)]
    while todo:
        ptr, depth = todo.pop()
        key = cols[depth][ptr]
        probe = np.sort(key[:: max(1, len(key) // 9)][:9])
        pivot = probe[len(probe) // 2]
        less, more = key < pivot, key > pivot
        for side in (ptr[less], ptr[more]):
            if alive(side, max(depth, 1)):
                todo.append((side, depth))
        if pivot == 0:  # suffixes that end here
            continue
        same = ptr[~(less | more)]
        if depth:
            count = int(weight[same].sum())
            if count >= least or led[same[0]] > depth:
                out.append((int(same[0]), depth + 1, count))
        if depth + 1 < len(cols) and alive(same, depth + 1):
            todo.append((same, depth + 1))
    return out


def _sorted_route(least: int, max_words: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        langs, words, counts = [], [], []
        for lang, own in pdf.groupby("lang", sort=False):
            *cols, weight, led = (np.concatenate(c) for c in zip(*[_unpacked(r, max_words) for r in own["data"]], strict=True))
            for at, n, count in frequent_prefixes(cols, weight, led, least):
                langs.append(lang)
                words.append(np.array([c[at] for c in cols[:n]], _U).view(np.int64))
                counts.append(count)
        return pd.DataFrame({"lang": langs, "ws": words, "a": counts})
    return run


def _survey_tables(survey: DataFrame, least: int):
    """The bits of the counter tables, and how many suffixes may be left."""
    blocks = survey.filter("words > 1").select("words", "part", F.pmod(F.xxhash64("data"), F.lit(64)).cast("int").alias("salt"), "data")
    keys = ["words", "part", "salt"]
    # in two levels, so that no task reads the blocks of all tasks
    blocks = blocks.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_add_tables, "words int, part int, salt int, data binary")
    bits = (blocks.withColumn("salt", F.lit(0)).repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(_table_bits(least, ROUTE_ROWS), _BITS))
    some = np.zeros((1 << PAIR_BITS) // 8, np.uint8)
    hot = {w: np.zeros((1 << (PAIR_BITS if w == 2 else LONG_BITS)) // 8, np.uint8) for w in (2, 3, 4)}
    rows = 0
    for r in bits.collect():  # fixed size: PAIR_BITS and LONG_BITS
        at = slice(r["part"] * _BLOCK // 8, (r["part"] + 1) * _BLOCK // 8)
        hot[r["words"]][at] = np.frombuffer(r["hot"], np.uint8)
        if r["words"] == 2:
            some[at] = np.frombuffer(r["some"], np.uint8)
            rows += r["rows"]
    return some, hot, rows


def count_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, ws, a)``: word hashes and count of every phrase of 2 to
    ``max_words`` words with ``min_count`` occurrences, and the survey's words
    ``(lang, h, word, n)`` with their counts, rare words too."""
    if not 2 <= max_words <= MAX_WORDS:
        raise ValueError(f"max_words from 2 to {MAX_WORDS}")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    survey = stored(texts.mapInArrow(_survey, _SURVEY), "survey")
    words = stored(survey.filter("words = 1").groupBy("lang", "h", "word").agg(F.sum("n").alias("n")), "words")
    some, hot, rows = _survey_tables(survey, min_count)
    common = np.zeros((1 << WORD_BITS) // 8, np.uint8)
    bit = F.shiftrightunsigned("h", 64 - WORD_BITS)
    frequent = words.filter(F.col("n") >= min_count).select(bit.alias("bit")).distinct()
    for r in frequent.groupBy((F.col("bit") / _BLOCK).cast("int").alias("part")).applyInPandas(
            _word_bits, "part int, data binary").collect():  # fixed size: WORD_BITS
        common[r["part"] * _BLOCK // 8:(r["part"] + 1) * _BLOCK // 8] = np.frombuffer(r["data"], np.uint8)
    routes = max(1, -(-rows // ROUTE_ROWS))
    sent = texts.mapInArrow(_routed(some, hot, common, routes, max_words), _SENT)
    found = sent.groupBy("route").applyInPandas(_sorted_route(min_count, max_words), "lang string, ws array<long>, a long")
    phrases = found.groupBy("lang", "ws").agg(F.sum("a").alias("a")).filter(F.col("a") >= min_count)
    return stored(phrases, "phrases"), words


def _floor_score(a, n, left, right) -> Column:
    """``floor(1000 * a * n / (left * right))`` in decimals of 38 digits."""
    return F.expr(f"(cast({a} as decimal(19,0)) * cast({n} as decimal(16,0)) * cast(1000 as decimal(4,0))) "
                  f"div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def mine_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top``
    collocations.

    Candidates are phrases of 2 to ``max_words`` words with ``a >= min_count``
    occurrences (overlapping ones too).  The cut into two parts, with ``l`` and
    ``r`` occurrences, that scores lowest counts, ties to the shorter first part;
    ``n`` is the number of words of the language.  A candidate goes if a longer
    one holds it and occurs as often.  Order: score, count (both descending),
    phrase by its bytes.

    A null language is ``und``, a null text is empty; other columns are ignored;
    rows count as often as they stand there; no candidates, or an empty table,
    give an empty result.  Words are told apart by 64-bit hashes.
    """
    phrases, words = count_phrases(docs, min_count, max_words)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    counts = phrases.select("lang", "ws", "a").unionByName(
        words.filter(F.col("n") >= min_count).select("lang", F.array("h").alias("ws"), F.col("n").alias("a")))

    # a phrase inside a longer one of the same count is inside one that is a word longer
    longer = phrases.filter(F.size("ws") > 2)
    inner = longer.select("lang", F.explode(F.array(F.expr("slice(ws, 1, size(ws) - 1)"), F.expr("slice(ws, 2, size(ws) - 1)"))).alias("ws"),
                          "a").groupBy("lang", "ws").agg(F.max("a").alias("held"))
    kept = stored(phrases.join(inner, ["lang", "ws"], "left").filter("held is null or held < a").select("lang", "ws", "a"), "kept")

    cuts = kept.select("lang", "ws", "a", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k")).select(
        "lang", "ws", "a", "k", F.expr("slice(ws, 1, k)").alias("head"), F.expr("slice(ws, k + 1, size(ws) - k)").alias("tail"))
    side = lambda part, name: counts.select("lang", F.col("ws").alias(part), F.col("a").alias(name))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"]).join(total, "lang")
    best = cuts.withColumn("score", _floor_score("a", "n", "l", "r")).groupBy("lang", "ws").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c")).select("lang", "ws", "c.*")

    names = words.filter(F.col("n") >= min_count).select("lang", F.col("h").alias("w"), "word")
    spelled = (best.select("lang", "ws", F.posexplode("ws").alias("i", "w")).join(names, ["lang", "w"])
               .groupBy("lang", "ws").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("p"))
               .select("lang", "ws", F.array_join(F.transform("p", lambda x: x["word"]), " ").alias("phrase")))
    rows = best.join(spelled, ["lang", "ws"])
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("ws"), F.lit(SALTS))
    some = rows.withColumn("salt", salt).withColumn(
        "at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("at") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return first.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB, over all word sequences.
ORACLE = r"""
  WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
  w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
  g AS (SELECT lang, unnest(flatten(list_transform(range(1, len(ws) + 1), lambda i:
               list_transform(range(i, least(i + 4, len(ws)) + 1), lambda j: ws[i:j])))) AS ph FROM w WHERE len(ws) > 0),
  f AS (SELECT lang, ph, CAST(count(*) AS BIGINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
  n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
  held AS (SELECT lang, ph, max(a) AS m FROM (
             SELECT lang, ph[1:len(ph) - 1] AS ph, a FROM f WHERE len(ph) > 2 UNION ALL
             SELECT lang, ph[2:len(ph)] AS ph, a FROM f WHERE len(ph) > 2 UNION ALL
             SELECT lang, ph[1:len(ph) - 2] AS ph, a FROM f WHERE len(ph) > 3 UNION ALL
             SELECT lang, ph[2:len(ph) - 1] AS ph, a FROM f WHERE len(ph) > 3 UNION ALL
             SELECT lang, ph[3:len(ph)] AS ph, a FROM f WHERE len(ph) > 3 UNION ALL
             SELECT lang, unnest([ph[1:2], ph[2:3], ph[3:4], ph[4:5]]) AS ph, a FROM f WHERE len(ph) = 5) GROUP BY ALL),
  c AS (SELECT f.lang, f.ph, f.a, unnest(range(1, len(f.ph))) AS k FROM f LEFT JOIN held h ON h.lang = f.lang AND h.ph = f.ph
        WHERE len(f.ph) >= 2 AND (h.m IS NULL OR 100 * h.m < 100 * f.a)),
  s AS (SELECT c.lang, c.ph, c.a, c.k, x.a AS l, y.a AS r, n.n,
               CAST((1000::HUGEINT * c.a * n.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
        FROM c JOIN f x ON x.lang = c.lang AND x.ph = c.ph[1:c.k] JOIN f y ON y.lang = c.lang AND y.ph = c.ph[c.k + 1:len(c.ph)]
        JOIN n ON n.lang = c.lang),
  b AS (SELECT *, array_to_string(ph, ' ') AS phrase FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1)
  SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b) WHERE rank <= 2000"""
