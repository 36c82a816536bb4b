"""Packing of token sequences by swap-based local search.

1. Every document becomes ids plus an end id; only longer ones than a sequence
   are cut, into full pieces behind one shorter first piece.  Full pieces fill
   a sequence each.
2. The other pieces are dealt to groups of bounded size by a hash of their
   place in the corpus, so that no group's size depends on sources or copies,
   and each group is packed on its own:
   a best-fit start from the longest piece down, then local search over its
   underfull sequences.  A step exchanges one piece for one, two for one, or moves one
   piece, when that raises the sum of squared fills; emptied sequences go.
3. What is left underfull in the groups (a few sequences each) is dealt to
   fewer groups and packed again, until one group is left or a round no longer
   halves their number.  A group never holds more than its share.

Only lengths take part: pieces of one length are interchangeable, so a step
works on the histogram of lengths in a sequence, and texts or ids never move.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder, json_ranks
from .common import null_id, plain_id, scratch, stored

SIZE = 1024
#: The id that ends each document.
END = 2
#: Pieces in a group on average.
GROUP = 20_000
#: Underfull sequences that one search handles together.
SEARCH_BINS = 400
#: Passes over a group's underfull sequences without gain before it stops.
PASSES = 12
#: A sequence with less room than this part of its size is not packed again.
SETTLED = 64
BATCH = 256

PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"
PLACED = "copy long, piece int, length long, sequence_id long, offset long"


def _cut(path: str, size: int, end: int):
    def run(frames):
        enc, tail = encoder(json_ranks, path), np.array([end], "<u4").tobytes()
        for pdf in frames:
            for at in range(0, len(pdf), BATCH):
                rows = []
                part = pdf.iloc[at:at + BATCH]
                for doc, copy, text in zip(part["doc_id"], part["copy"], part["text"], strict=True):
                    ids = enc.ids(text) + tail
                    n = len(ids) // 4
                    first = n % size or size
                    for i, begin in enumerate([0, *range(first, n, size)]):
                        stop = first if i == 0 else begin + size
                        rows.append((doc, copy, i, begin, stop - begin, zlib.crc32(ids[4 * begin:4 * stop])))
                yield pd.DataFrame(rows, columns=["doc_id", "copy", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """PIECES of every document; ``copy`` tells repeated rows apart."""
    rows = docs.select(plain_id(), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("copy", F.monotonically_increasing_id()).mapInPandas(_cut(path, size, end), PIECES)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Sequences (lists of indexes) from placing each piece, the longest
    first, where it leaves the least room."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]  # stacks of sequences by room left
    some = 0  # bit r set: by_room[r] is not empty
    out: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = some >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                some &= ~(1 << room)
            out[b].append(i)
        else:
            room, b = size, len(out)
            out.append([i])
        by_room[room - n].append(b)
        some |= 1 << (room - n)
    return out


def improve(bins: list[list[int]], lengths: np.ndarray, size: int, rng: np.random.Generator) -> list[list[int]]:
    """Local search over underfull sequences.

    Every step makes a fuller sequence fuller at the cost of an emptier one,
    which raises the sum of squared fills, so the search ends.  The best step
    for a sequence with room ``r`` is the one that leaves it the least room:
    move a piece of length up to ``r``, exchange a piece for one that is longer
    by up to ``r``, or two for one, or one for two.
    """
    def fills(bs):
        return [int(lengths[b].sum()) for b in bs]

    work = [(f, b) for f, b in zip(fills(bins), bins, strict=True)]
    done = [b for f, b in work if f == size]
    work = [w for w in work if w[0] < size]
    still = 0
    while len(work) > 1 and still < PASSES:
        if sum(size - f for f, _ in work) < size:
            break  # the room left is less than one sequence: none can be emptied
        work.sort(key=lambda w: w[0])
        # the emptiest sequence gives; the others take in random order
        fill, giver = work.pop(0)
        gained, giver = False, list(giver)
        order = rng.permutation(len(work))[:SEARCH_BINS]
        for t in order:
            room = size - work[t][0]
            if not giver or room == 0:
                continue
            taker = work[t][1]
            own, theirs = lengths[giver], lengths[taker]
            best, step = 0, None
            fits = np.flatnonzero(own <= room)  # move
            if len(fits):
                i = fits[np.argmax(own[fits])]
                best, step = int(own[i]), ([i], [])
            if best < room and len(theirs):  # one for one
                d = own[:, None] - theirs[None, :]
                d = np.where((d <= room) & (d > best), d, 0)
                if d.any():
                    i, j = np.unravel_index(np.argmax(d), d.shape)
                    best, step = int(d[i, j]), ([i], [j])
            if best < room and len(own) > 1 and len(theirs):  # two of the giver's for one
                a, b = np.triu_indices(len(own), 1)
                d = (own[a] + own[b])[:, None] - theirs[None, :]
                d = np.where((d <= room) & (d > best), d, 0)
                if d.any():
                    i, j = np.unravel_index(np.argmax(d), d.shape)
                    best, step = int(d[i, j]), ([a[i], b[i]], [j])
            if best < room and len(theirs) > 1:  # one of the giver's for two
                a, b = np.triu_indices(len(theirs), 1)
                d = own[:, None] - (theirs[a] + theirs[b])[None, :]
                d = np.where((d <= room) & (d > best), d, 0)
                if d.any():
                    i, j = np.unravel_index(np.argmax(d), d.shape)
                    best, step = int(d[i, j]), ([i], [a[j], b[j]])
            # raises the sum of squares: f_t + best and fill - best against f_t and fill
            if step and (work[t][0] + best) ** 2 + (fill - best) ** 2 > work[t][0] ** 2 + fill ** 2:
                give, take = set(map(int, step[0])), set(map(int, step[1]))
                new = [x for k, x in enumerate(taker) if k not in take] + [giver[k] for k in sorted(give)]
                giver = [x for k, x in enumerate(giver) if k not in give] + [taker[k] for k in sorted(take)]
                work[t] = (work[t][0] + best, new)
                fill, gained = fill - best, True
        done += [b for f, b in work if f == size]
        work = [w for w in work if w[0] < size]
        if giver:
            work.append((fill, giver))
        still = 0 if gained else still + 1
        if not gained:  # this one stays as it is; try the next emptiest
            done.append(giver)
            work = [w for w in work if w[1] is not giver]
    return done + [b for _, b in work]


def pack(lengths: np.ndarray, size: int = SIZE, seed: int = 0) -> list[list[int]]:
    """Sequences of one group."""
    return improve(best_fit(lengths, size), lengths, size, np.random.default_rng(seed))


def _pack_group(size: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "copy", "piece"], kind="stable")
        lengths = pdf["length"].to_numpy(np.int64)
        seq, off = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
        for s, members in enumerate(pack(lengths, size, int(key[0]))):
            seq[members] = s
            off[members] = np.cumsum(lengths[members]) - lengths[members]
        full = np.bincount(seq, weights=lengths)[seq] > size - size // SETTLED if len(seq) else np.zeros(0, bool)
        return pd.DataFrame({"copy": pdf["copy"], "piece": pdf["piece"], "length": lengths,
                             "group": np.int64(key[0]), "local": seq, "offset": off, "full": full})
    return run


_GROUPED = "copy long, piece int, length long, group long, local long, offset long, full boolean"


def place(items: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """PLACED for ``items(copy, piece, length)``, all shorter than ``size``."""
    parts, left, base, last = [], items, 0, None
    while True:
        n = left.count()
        groups = max(1, -(-n // group))
        if n == 0:
            break
        # the end: one group, or the last round filled too little for another one to pay
        final = groups == 1 or (last is not None and 2 * groups > last)
        rows = left.select("copy", "piece", "length", F.xxhash64("copy", "piece", F.lit(base)).alias("h"))
        packed = stored(rows.withColumn("g", F.pmod("h", F.lit(groups))).groupBy("g")
                        .applyInPandas(_pack_group(size), _GROUPED), "packed")
        numbered = packed.withColumn("sequence_id", (F.col("local") * groups + F.col("group")) + F.lit(base))
        parts.append((numbered if final else numbered.filter("full")).select(
            "copy", "piece", "length", "sequence_id", "offset"))
        if final:
            break
        base += groups * (group * 8 + 1)
        last, left = groups, packed.filter("not full").select("copy", "piece", "length")
    if not parts:
        return items.sparkSession.createDataFrame([], PLACED)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def best_fit_packing(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    A null or empty text is its end id alone.  Repeated rows are packed each.
    An empty table gives an empty result; other columns are ignored.  Texts
    are read once; the rest works on about 40 bytes per piece.
    """
    all_pieces = stored(pieces(docs, path, size, end), "pieces")
    short = place(all_pieces.filter(F.col("length") < size).select("copy", "piece", "length"), size)
    # full pieces are numbered below zero, where no other sequence is
    full = all_pieces.filter(F.col("length") == size).select(
        "*", (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    joined = all_pieces.filter(F.col("length") < size).join(short.drop("length"), ["copy", "piece"])
    return full.unionByName(joined.select(*full.columns)).select(
        null_id(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
