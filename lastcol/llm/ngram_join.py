"""N-gram Jaccard self-join with several global token orders.

Two documents link when the Jaccard index of their sets of word shingles is at
least 4/5.  Sorted by any global order, two such sets share a token among their
first ``n - ceil(0.8 n) + 1``.  This holds for every order, so a candidate must
share a prefix token under each of ORDERS orders.  All orders put rare tokens
first (by a count sketch of their own over all documents, in classes of half a
counter's spread) and break ties by their own hash.

1. One pass over the texts gives each document its set's size, fingerprint and
   parity bitmap, and the count sketch.  Documents with equal sets are one node
   from here on.
2. A second pass emits the prefix postings (token, node) of each order, packed
   by range of tokens; a range is sorted where it is read.  Tokens
   shared by few nodes list their pairs, if size and position allow a link;
   pairs listed by every order stay.  A token shared by more than GROUP nodes
   lists none: its nodes are tied to one of them, which is linear.
3. Pairs whose bitmaps already differ in more bits than a link allows are
   dropped.  What is left, with the ties, falls into families.
4. Families are verified exactly: the members' sets are read once more, a
   family of many tokens is cut into cells (size bands, then hashed blocks)
   that meet pairwise, and a cell returns one edge per member, never the pairs.
   A pair that the token lists did not show (because it shares a frequent
   token) is tied into one family in step 2, so no link is lost.
5. Links give components.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, connected_components, null_id, plain_id, stored
from .shingles import mix64, shingle_sets

ORDERS = 2
#: Counters of an order's sketch: what a counter holds by chance grows with the corpus,
#: and with it the number of nodes from which a token is known to be frequent.
SKETCH_BITS = 21
#: Counters in one row of the sketch.
SKETCH_BLOCK = 1 << 18
#: Nodes that share a token and still list their pairs.
GROUP = 64
#: Tokens in a cell of a family.
CELL_TOKENS = 400_000
#: Postings of a range of tokens, which one task holds at a time, and the number that
#: is left together if there are fewer ranges than tasks; rows that are looked at at once.
RANGE_POSTINGS, LEAST_POSTINGS, PIECE = 8_000_000, 400_000, 1 << 18
#: Documents shingled at a time, and the characters that end a batch early.
BATCH, BATCH_CHARS = 1000, 4_000_000
#: Broadcast the families' ids up to this many; joined by id beyond.
BROADCAST_ROWS = 500_000
_U = np.uint64
_MASK = _U((1 << SKETCH_BITS) - 1)


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        size = np.cumsum(pdf["text"].str.len().to_numpy())
        at = 0
        while at < len(pdf):
            base = size[at - 1] if at else 0
            end = min(at + BATCH, max(at + 1, int(np.searchsorted(size, base + BATCH_CHARS))))
            yield pdf.iloc[at:end]
            at = end


def _fingerprints(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One value per set, whatever the order of its members; 0 for the empty set."""
    n = np.diff(offs)
    out = np.zeros(len(n), _U)
    some = n > 0
    if some.any():
        out[some] = mix64(np.add.reduceat(mix64(h, 3), offs[:-1][some]) + n[some].astype(_U), 4)
    return out.view(np.int64)


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens that fall on each bit; about a bit per token."""
    bits = 64
    while bits < len(tokens) and bits < 1 << 16:
        bits *= 2
    odd = np.bincount((tokens >> _U(40)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of tokens in one of two sets only."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x.reshape(-1, len(y))
        x = np.bitwise_xor.reduce(x, axis=0)
    while len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _counter(h: np.ndarray, order: int) -> np.ndarray:
    """Place of a token's counter among those of all orders."""
    return ((h >> _U(SKETCH_BITS * order)) & _MASK).astype(np.int64) + (order << SKETCH_BITS)


def _survey(frames):
    """Rows of nodes (part -1) and, at the end, the sketches of this task."""
    sketch = np.zeros(ORDERS << SKETCH_BITS, np.uint32)
    for pdf in _batches(frames):
        h, offs = shingle_sets(pdf["text"].tolist())
        for order in range(ORDERS):
            np.add.at(sketch, _counter(h, order), np.uint32(1))
        maps = [bitmap(h[a:b]) for a, b in zip(offs[:-1], offs[1:], strict=True)]
        yield pd.DataFrame({"part": -1, "doc_id": pdf["doc_id"].to_numpy(), "n": np.diff(offs),
                            "fp": _fingerprints(h, offs), "bits": maps})
    parts = range(0, len(sketch), SKETCH_BLOCK)
    yield pd.DataFrame({"part": [p // SKETCH_BLOCK for p in parts], "doc_id": 0, "n": 0, "fp": 0,
                        "bits": [_packed_counts(sketch[p:p + SKETCH_BLOCK]) for p in parts]})


def _packed_counts(counts: np.ndarray) -> bytes:
    """In one byte each, if that does."""
    return zlib.compress((counts.astype(np.uint8) if counts.max() < 256 else counts).tobytes(), 1)


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SKETCH_BLOCK, np.int64)
    for raw in pdf["bits"]:
        raw = zlib.decompress(raw)
        total += np.frombuffer(raw, np.uint8 if len(raw) == SKETCH_BLOCK else np.uint32)
    # the square root of a count spreads by a half, whatever the count
    classes = np.minimum(np.floor(4 * np.sqrt(total)), 65535).astype(np.uint16)
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "bits": [classes.tobytes()]})


def rarity_classes(survey: DataFrame) -> np.ndarray:
    """Class of each counter of all orders, of fixed size."""
    rows = survey.filter("part >= 0").select("part", "bits").groupBy("part").applyInPandas(
        _add, "part int, bits binary").collect()
    classes = np.zeros(ORDERS << SKETCH_BITS, np.uint16)
    for r in rows:
        classes[r["part"] * SKETCH_BLOCK:(r["part"] + 1) * SKETCH_BLOCK] = np.frombuffer(r["bits"], np.uint16)
    return classes


def prefix_length(n):
    return n - (4 * n + 4) // 5 + 1


def _postings(classes: np.ndarray, ranges: int):
    """Prefix postings of each distinct set of a batch, in all orders, packed by
    range of tokens (``part`` counts the ranges of all orders).  Within a batch, a
    token shared by more than GROUP sets ties them (``kind`` 1: the pairs)."""
    def run(frames):
        for pdf in _batches(frames):
            h, offs = shingle_sets(pdf["text"].tolist())
            fps, n = _fingerprints(h, offs), np.diff(offs)
            _, first = np.unique(fps, return_index=True)
            use = np.zeros(len(fps), bool)
            use[first] = True
            use &= n > 0
            plen = np.where(use, prefix_length(n), 0)
            total = int(plen.sum())
            if not total:
                continue
            for order in range(ORDERS):
                key = (classes[_counter(h, order)].astype(_U) << _U(48)) | (mix64(h, 11 + order) >> _U(16))
                for a, b in zip(offs[:-1][use].tolist(), offs[1:][use].tolist(), strict=True):
                    key[a:b].sort()
                doc = np.repeat(np.arange(len(n)), plen)
                pos = np.arange(total) - np.repeat(np.cumsum(plen) - plen, plen)
                token = mix64(key[offs[:-1][doc] + pos], 21 + order)
                by = np.argsort(token, kind="stable")
                token, doc, pos = token[by], doc[by], pos[by]
                starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
                size = np.diff(np.r_[starts, total])
                hot = np.repeat(size > GROUP, size)
                lead = np.repeat(starts, size)
                tied = hot & (np.arange(total) != lead)
                if tied.any():
                    pair = np.unique(np.stack([fps[doc[tied]], fps[doc[lead[tied]]]], 1), axis=0)
                    yield pd.DataFrame({"part": [order * ranges], "kind": [np.int8(1)], "body": [pair.tobytes()]})
                token, doc, pos, hot = token[~tied], doc[~tied], pos[~tied], hot[~tied]
                part = ((token >> _U(32)) * _U(ranges)) >> _U(32)  # in the order of the tokens
                cut = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist(), len(part)]
                yield pd.DataFrame({"part": [order * ranges + int(part[a]) for a in cut[:-1]], "kind": np.int8(0), "body": [
                    _pack(token[a:b], doc[a:b], pos[a:b], hot[a:b], fps, n) for a, b in zip(cut, cut[1:])]})
    return run


def _pack(token, doc, pos, hot, fps, n) -> bytes:
    """Postings of one range: the nodes that occur, then the places of the postings' nodes,
    the low halves of their tokens, their positions and marks."""
    used, at = np.unique(doc, return_inverse=True)
    size = n[used]
    kind = np.uint16 if int(size.max()) < 1 << 15 else np.uint64
    node = np.uint16 if len(used) <= 1 << 16 else np.uint32
    head = np.array([len(used), len(token), np.dtype(kind).itemsize], np.int64)
    return b"".join(x.tobytes() for x in (head, fps[used], size.astype(kind), at.astype(node), token.astype(np.uint32),
                                          (pos.astype(np.int64) << 1 | hot).astype(kind)))


def _unpack(body: bytes) -> tuple[np.ndarray, ...]:
    """``fp, n`` of the nodes, ``node, token, pos and mark`` of the postings."""
    nodes, rows, width = np.frombuffer(body, np.int64, 3).tolist()
    kind, at, out = np.uint16 if width == 2 else np.uint64, 24, []
    for dtype, count in ((np.int64, nodes), (kind, nodes), (np.uint16 if nodes <= 1 << 16 else np.uint32, rows),
                         (np.uint32, rows), (kind, rows)):
        out.append(np.frombuffer(body, dtype, count, at))
        at += count * np.dtype(dtype).itemsize
    return tuple(out)


def _range_rows(part: int, bodies: list[bytes], ranges: int) -> Iterator[pd.DataFrame]:
    """The postings of a range in the order of their tokens, as :func:`_pairs` takes them."""
    fps, sizes, nodes, tokens, places, begun = [], [], [], [], [], 0
    while bodies:
        fp, n, node, token, pos = _unpack(bodies.pop())
        fps.append(fp)
        sizes.append(n.astype(np.int64))
        nodes.append(node.astype(np.uint32) + np.uint32(begun))
        tokens.append(token)
        places.append(pos.astype(np.uint32))
        begun += len(fp)
    fp, n, node, token, pos = (np.concatenate(x) for x in (fps, sizes, nodes, tokens, places))
    del fps, sizes, nodes, tokens, places
    by = np.argsort(token)
    for a in range(0, len(by), PIECE):
        at = by[a:a + PIECE]
        place, who = pos[at].astype(np.int64), node[at]
        yield pd.DataFrame({"token": (part << 32) | token[at].astype(np.int64), "fp": fp[who], "np": (n[who] << 32) | (place >> 1),
                            "ord": np.int8(part // ranges), "mark": (place & 1).astype(np.int8)})


def _listed(ranges: int):
    """Packed postings arrive by range; one range at a time is held."""
    def rows(frames):
        last, held = None, []
        for pdf in frames:
            for part, kind, body in zip(pdf["part"], pdf["kind"], pdf["body"], strict=True):
                if kind:
                    pair = np.frombuffer(body, np.int64).reshape(-1, 2)
                    yield pd.DataFrame({"token": pair[:, 0], "fp": pair[:, 0], "np": pair[:, 1], "ord": np.int8(0), "mark": np.int8(2)})
                    continue
                if part != last and held:
                    yield from _range_rows(last, held, ranges)
                    held = []
                last = part
                held.append(body)
        if held:
            yield from _range_rows(last, held, ranges)
    return lambda frames: _pairs(rows(frames))


def _pairs(frames):
    """Postings arrive by order and token.  Gives the pairs of small groups
    (with their order) and the ties of large ones (order -1)."""
    carry = None  # the last group, unfinished; at most GROUP rows
    for pdf in frames:
        tie = pdf["mark"].to_numpy() == 2
        if tie.any():
            yield _edges(pdf["fp"].to_numpy()[tie], pdf["np"].to_numpy()[tie], -1)
        rows = np.stack([pdf[c].to_numpy(np.int64) for c in ("token", "ord", "fp", "np", "mark")], 1)[~tie]
        if carry is not None:
            rows = np.concatenate([carry, rows])
        if not len(rows):
            continue
        cut = int(np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1])).max(initial=-1)) + 1
        yield from _grouped(rows[:cut])
        carry = rows[cut:]
        if len(carry) > GROUP:
            carry = _distinct(carry)  # a node comes once for each batch that holds it
        if len(carry) > GROUP:  # large already: tie what is here, keep its first as a mark
            yield from _grouped(carry)
            carry = carry[:1].copy()
            carry[0, 4] = 1
    if carry is not None:
        yield from _grouped(carry)


def _edges(a, b, order) -> pd.DataFrame:
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "ord": np.int8(order)})


def _distinct(rows: np.ndarray) -> np.ndarray:
    """One row per node of a group, sorted; a node marked hot keeps its mark."""
    rows = rows[np.lexsort((rows[:, 4] == 0, rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = (rows[1:, :3] == rows[:-1, :3]).all(1)
    return rows[np.r_[True, ~same]]


def _grouped(rows: np.ndarray) -> Iterator[pd.DataFrame]:
    if len(rows) < 2:
        return
    rows = _distinct(rows)
    new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]
    starts = np.flatnonzero(new)
    size = np.diff(np.r_[starts, len(rows)])
    marked = np.add.reduceat(rows[:, 4], starts) > 0
    large = np.repeat((size > GROUP) | marked, size)
    lead = np.repeat(starts, size)
    tied = large & (np.arange(len(rows)) != lead)
    if tied.any():
        yield _edges(rows[tied, 2], rows[lead[tied], 2], -1)
    rows, group = rows[~large], np.repeat(np.arange(len(size)), size)[~large]
    found = []
    for d in range(1, GROUP):
        if len(rows) <= d:
            break
        i = np.flatnonzero(group[d:] == group[:-d])
        if not len(i):
            break
        nx, px = rows[i, 3] >> 32, rows[i, 3] & 0xFFFFFFFF
        ny, py = rows[i + d, 3] >> 32, rows[i + d, 3] & 0xFFFFFFFF
        # at the pair's first shared token all other shared ones come later
        most = 1 + np.minimum(nx - px, ny - py) - 1
        ok = (5 * np.minimum(nx, ny) >= 4 * np.maximum(nx, ny)) & (9 * most >= 4 * (nx + ny))
        i = i[ok]
        found.append(np.stack([rows[i, 2], rows[i + d, 2], rows[i, 1]], 1))
    if found:
        pair = np.concatenate(found)
        for order in range(ORDERS):
            own = np.unique(pair[pair[:, 2] == order, :2], axis=0)
            if len(own):
                yield _edges(own[:, 0], own[:, 1], order)


def _near(frames):
    """Pairs whose bitmaps allow a link."""
    for pdf in frames:
        n = pdf["n_a"].to_numpy() + pdf["n_b"].to_numpy()
        most = n - 2 * ((4 * n + 8) // 9)
        ok = [least_difference(a, b) <= m for a, b, m in zip(pdf["bits_a"], pdf["bits_b"], most, strict=True)]
        yield pdf.loc[ok, ["a", "b"]]


def links_of(sets: list[np.ndarray], ids: np.ndarray, left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, id) that give the exact components of the links among
    ``sets`` (with ``left``: only links between the two sides count)."""
    n = np.array([len(s) for s in sets], np.int64)
    by = np.argsort(n, kind="stable")
    sets, ids, n = [sets[i] for i in by], ids[by], n[by]
    side = None if left is None else left[by]
    token, at = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(at) > 1
    col = np.cumsum(often) - 1
    words = max(1, -(-int(often.sum()) // 64))
    owner = np.repeat(np.arange(len(sets)), n)
    keep = often[at]
    bits = np.zeros((len(sets), words), _U)
    c = col[at[keep]]
    np.bitwise_or.at(bits, (owner[keep], c >> 6), _U(1) << (c & 63).astype(_U))
    label = np.arange(len(sets))
    a, b = [], []
    top = np.searchsorted(n, 5 * n // 4, side="right")
    for i in range(len(sets)):
        j = np.arange(i + 1, top[i])
        j = j[label[j] != label[i]]
        if side is not None:
            j = j[side[j] != side[i]]
        for lo in range(0, len(j), 1024):
            part = j[lo:lo + 1024]
            both = np.bitwise_count(bits[part] & bits[i]).sum(1, dtype=np.int64)
            hit = part[9 * both >= 4 * (n[part] + n[i])]
            for k in hit:
                if label[k] != label[i]:
                    a.append(ids[i])
                    b.append(ids[k])
                    label[label == label[k]] = label[i]
    return np.array(a, np.int64), np.array(b, np.int64)


def _verify(frames):
    """Cells arrive whole and in order; one at a time is held."""
    key, held = None, []

    def finish():
        if len(held) > 1:
            sets = [np.frombuffer(x[1], _U) for x in held]
            ids = np.array([x[0] for x in held], np.int64)
            one = held[0][3]  # a cell of one block meets itself
            a, b = links_of(sets, ids, None if one else np.array([x[2] for x in held]))
            if len(a):
                yield pd.DataFrame({"a": a, "b": b})

    for pdf in frames:
        for cell, fp, tokens, left, one in zip(pdf["cell"], pdf["fp"], pdf["tokens"], pdf["left"], pdf["one"], strict=True):
            if cell != key:
                yield from finish()
                key, held = cell, []
            held.append((fp, tokens, left, one))
    yield from finish()


def _sets(frames):
    for pdf in frames:
        for at in range(0, len(pdf), 200):
            part = pdf.iloc[at:at + 200]
            h, offs = shingle_sets(part["text"].tolist())
            out = pd.DataFrame({"fp": part["fp"].to_numpy(), "cells": part["cells"].to_numpy(),
                                "tokens": [h[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:], strict=True)]})
            yield out[_fingerprints(h, offs) == out["fp"].to_numpy()]  # an id may have several texts


_CELLS = "array<struct<cell:string,left:boolean,one:boolean>>"


def _deal(members: DataFrame) -> DataFrame:
    """``fp, doc_id, cells`` for ``members(fp, doc_id, n, family)``."""
    total = members.groupBy("family").agg(F.sum("n").alias("tokens"), F.count("*").alias("size"))
    rows = members.join(total, "family").filter("size > 1")
    family = F.col("family").cast("string")
    small = rows.filter(F.col("tokens") <= CELL_TOKENS).select("fp", "doc_id", F.array(F.struct(
        family.alias("cell"), F.lit(True).alias("left"), F.lit(True).alias("one"))).cast(_CELLS).alias("cells"))
    # sets that may link differ by at most one band: 5/4 is less than the base
    banded = rows.filter(F.col("tokens") > CELL_TOKENS).withColumn(
        "band", F.floor(F.log("n") / F.log(F.lit(1.2501))).cast("int"))
    parts = banded.groupBy("family", "band").agg(F.ceil(F.sum("n") / CELL_TOKENS).cast("int").alias("k"))
    by_family = parts.groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("band", "k"))).alias("ks"))
    big = banded.join(by_family, "family")
    k = lambda d: F.coalesce(F.try_element_at("ks", F.col("band") + d), F.lit(0))
    own = F.pmod(F.xxhash64("fp"), k(0)).cast("int")

    def name(band, i, j):
        return F.concat_ws(":", family, band.cast("string"), i.cast("string"), j.cast("string"))

    def cells(count, make):
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), make)).otherwise(
            F.array().cast(_CELLS))

    within = cells(k(0), lambda t: F.struct(
        name(F.col("band"), F.least(own, t), F.greatest(own, t)).alias("cell"), (own <= t).alias("left"),
        (own == t).alias("one")))
    above = cells(k(1), lambda t: F.struct(
        F.concat(name(F.col("band"), own, t), F.lit("+")).alias("cell"), F.lit(True).alias("left"),
        F.lit(False).alias("one")))
    under = cells(k(-1), lambda t: F.struct(
        F.concat(name(F.col("band") - 1, t, own), F.lit("+")).alias("cell"), F.lit(False).alias("left"),
        F.lit(False).alias("one")))
    big = big.select("fp", "doc_id", F.concat(within, above, under).cast(_CELLS).alias("cells"))
    return small.unionByName(big)


def ngram_components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    A null or empty text, or one of white space, has no shingle and links with
    nothing; fewer words than five are one shingle.  Documents with equal sets
    link.  Rows that repeat an id are joined and returned each.  Rows without an
    id are not joined and return their size with a null component.  An empty table gives an empty
    result; other columns are ignored.
    """
    rows = docs.select(plain_id(), F.coalesce("text", F.lit("")).alias("text"))
    survey = stored(rows.mapInPandas(_survey, "part int, doc_id long, n long, fp long, bits binary"), "survey")
    each = survey.filter("part = -1").select("doc_id", "n", "fp", "bits")
    named = F.col("doc_id") != NO_ID
    nodes = each.filter(named & (F.col("n") > 0)).groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                   F.first("bits").alias("bits"))
    classes = rarity_classes(survey)
    count = each.agg(F.sum((F.col("n") - F.ceil(F.col("n") * 0.8)) + 1)).first()[0] or 0
    ranges = max(1, -(-count // RANGE_POSTINGS), min(docs.sparkSession.sparkContext.defaultParallelism, count // LEAST_POSTINGS))

    postings = rows.filter(named).mapInPandas(_postings(classes, ranges), "part int, kind byte, body binary")
    listed = stored(postings.repartition("part").sortWithinPartitions("part")
                    .mapInPandas(_listed(ranges), "a long, b long, ord byte"), "pairs")
    ties = listed.filter("ord = -1").select("a", "b").distinct()
    every = (listed.filter("ord >= 0").groupBy("a", "b").agg(F.bit_or(F.expr("shiftleft(1, ord)")).alias("m"))
             .filter(F.col("m") == (1 << ORDERS) - 1).select("a", "b"))
    side = lambda s: nodes.select(F.col("fp").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}"))
    near = every.join(side("a"), "a").join(side("b"), "b").mapInPandas(_near, "a long, b long")
    families = stored(connected_components(near.unionByName(ties)), "families")

    members = families.join(nodes, families["node"] == nodes["fp"]).select(
        "fp", "doc_id", "n", F.col("component").alias("family"))
    dealt = stored(_deal(members), "cells")
    few = dealt.count() <= BROADCAST_ROWS
    texts = rows.join(F.broadcast(dealt) if few else dealt, "doc_id")
    sets = texts.select("fp", "cells", "text").mapInPandas(_sets, f"fp long, cells {_CELLS}, tokens binary")
    cells = sets.select("fp", "tokens", F.explode("cells").alias("c")).select(
        F.col("c.cell").alias("cell"), "fp", "tokens", F.col("c.left").alias("left"), F.col("c.one").alias("one"))
    links = (cells.repartition("cell").sortWithinPartitions("cell", "fp")
             .mapInPandas(_verify, "a long, b long"))
    component = connected_components(links)

    known = nodes.select("fp", "doc_id").join(component, F.col("fp") == F.col("node"), "left").select(
        "fp", "doc_id", F.coalesce("component", "fp").alias("c"))
    lowest = known.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    by_fp = known.join(lowest, "c").select("fp", "component_id")
    return each.join(by_fp, "fp", "left").select(
        null_id(), F.col("n").alias("n_shingles"),
        F.when(named, F.coalesce("component_id", "doc_id")).alias("component_id"))
