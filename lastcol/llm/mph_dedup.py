"""Exact dedup against a minimal perfect hash over historical digests.

A corpus arrives in deliveries.  What earlier deliveries held (the history) is
kept as an index: the distinct digests, cut into buckets of bounded size by
digest prefix, each bucket a minimal perfect hash function plus its slot
arrays.  A slot holds the full digest, the winner's locator (its id) and the
number of rows.  A later delivery is looked up: the function gives one slot,
the stored digest is compared byte for byte, so a nonmember is never taken for
a member.  Members join their slot; nonmembers are grouped among themselves.

The function is the collision-free cascade of Limasset et al. (2017): level
``i`` hashes the keys left over from level ``i-1`` into a bit array; a key
alone on its bit stays there.  The rank of its bit is its slot.

Everything after the digest step is 32 bytes per row.  Rows are aggregated by
digest with map-side combine before any bucket sees them, so a digest that
holds a third of the rows is one row per map task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Distinct digests per bucket on average; bounds a bucket's memory (about 1 MB).
BUCKET_KEYS = 8192
#: Locator of a group whose rows have no id.
NO_ID = 2**63 - 1
#: Bits per key of a level of the cascade.
GAMMA = 2.0

INDEX_SCHEMA = "bucket int, levels array<int>, bits binary, digests binary, winners binary, counts binary"
GROUP_SCHEMA = "digest binary, keep_id long, group_size long, in_history boolean"
_U = np.uint64


def normal_text(col: Column) -> Column:
    """Null counts as empty; each run of ASCII white space is one space."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    """64 bits of each 32-byte digest for one level."""
    w = np.ascontiguousarray(keys).view(_U).reshape(-1, 4)
    with np.errstate(over="ignore"):
        x = (w[:, level % 4] ^ _U((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)) * _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(29)
        x = (x + w[:, (level + 1) % 4]) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def build_function(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and the concatenated bit array for distinct ``keys`` of
    shape (n, 32) bytes."""
    levels, parts, left = [], [], keys
    while len(left):
        m = max(64, int(GAMMA * len(left)))
        pos = (_hash(left, len(levels)) % _U(m)).astype(np.int64)
        alone = np.bincount(pos, minlength=m) == 1
        levels.append(m)
        parts.append(alone)
        left = left[~alone[pos]]
    return levels, np.concatenate(parts) if parts else np.zeros(0, bool)


def slot_of(keys: np.ndarray, levels: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where every level turns it away (never for a
    member)."""
    slots = np.full(len(keys), -1, np.int64)
    rank = np.cumsum(bits) - 1
    left, base = np.arange(len(keys)), 0
    for level, m in enumerate(levels):
        at = base + (_hash(keys[left], level) % _U(m)).astype(np.int64)
        hit = bits[at]
        slots[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + m
        if not len(left):
            break
    return slots


def _digest_array(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col), np.uint8).reshape(-1, 32)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = _digest_array(pdf["digest"])
    levels, bits = build_function(keys)
    order = np.empty(len(keys), np.int64)
    order[slot_of(keys, levels, bits)] = np.arange(len(keys))
    return pd.DataFrame({
        "bucket": [int(pdf["bucket"].iloc[0])], "levels": [levels],
        "bits": [np.packbits(bits).tobytes()], "digests": [keys[order].tobytes()],
        "winners": [pdf["winner"].to_numpy(np.int64)[order].tobytes()],
        "counts": [pdf["n"].to_numpy(np.int64)[order].tobytes()]})


def _lookup(key, index: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    """All groups of one bucket: history slots with what the delivery adds,
    then the digests that are no members."""
    parts = []
    digests, ids, counts = new["digest"], new["winner"].to_numpy(np.int64), new["n"].to_numpy(np.int64)
    member = np.zeros(len(new), bool)
    if len(index):
        row = index.iloc[0]
        stored_keys = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        winners = np.frombuffer(row["winners"], np.int64).copy()
        sizes = np.frombuffer(row["counts"], np.int64).copy()
        if len(new):
            levels = [int(x) for x in row["levels"]]
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(levels)).astype(bool)
            keys = _digest_array(digests)
            slot = slot_of(keys, levels, bits)
            member = slot >= 0
            member[member] = (stored_keys[slot[member]] == keys[member]).all(axis=1)
            at = slot[member]  # distinct: a slot holds one digest
            winners[at] = np.minimum(winners[at], ids[member])
            sizes[at] += counts[member]
        parts.append(pd.DataFrame({"digest": [k.tobytes() for k in stored_keys], "keep_id": winners,
                                   "group_size": sizes, "in_history": True}))
    if len(new) and not member.all():
        parts.append(pd.DataFrame({"digest": digests[~member].to_list(), "keep_id": ids[~member],
                                   "group_size": counts[~member], "in_history": False}))
    return pd.concat(parts) if parts else pd.DataFrame(
        {"digest": [], "keep_id": [], "group_size": [], "in_history": []})


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per digest: smallest id, number of rows, bucket."""
    head = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    return (rows.groupBy("digest")
            .agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("winner"), F.count("*").alias("n"))
            .withColumn("bucket", (head % buckets).cast("int")))


def bucket_count(history: DataFrame) -> int:
    """Buckets for a history of rows with a digest: grows with its rows."""
    return max(1, -(-history.count() // BUCKET_KEYS))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The index of ``history(doc_id, digest)``: one row per bucket
    (INDEX_SCHEMA).  An empty history gives an empty index."""
    return _bucketed(history, buckets).groupBy("bucket").applyInPandas(_build, INDEX_SCHEMA)


def lookup(index: DataFrame, delivery: DataFrame, buckets: int) -> DataFrame:
    """Groups (GROUP_SCHEMA) of the history and a delivery together; the
    smallest id of a group stays, wherever it came from."""
    new = _bucketed(delivery, buckets)
    return (index.groupBy("bucket").cogroup(new.groupBy("bucket"))
            .applyInPandas(_lookup, GROUP_SCHEMA))


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest)`` by the normalised whole text; other columns go."""
    return docs.select("doc_id", F.unhex(F.sha2(normal_text(F.col("text")), 256)).alias("digest"))


def exact_dedup(docs: DataFrame, is_history: Column | None = None) -> DataFrame:
    """One row per document, dropped ones too: ``doc_id, keep_id, group_size,
    kept, text_sha256, in_history``.

    ``is_history`` marks the rows of earlier deliveries; by default every
    second id counts as history.  The result but for ``in_history`` does not
    depend on it.  A null text counts as empty; empty texts are one group.
    Repeated rows (one id twice) count each in ``group_size`` and both appear.
    A row without an id never wins against one with an id; a group of rows
    that all lack one keeps them all, since no id tells them apart.  An empty table gives an empty result.  Columns other than ``doc_id`` and
    ``text`` are ignored, whatever their names.
    """
    if is_history is None:
        is_history = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = stored(digests(docs).withColumn("h", F.coalesce(is_history, F.lit(False))), "digests")
    history, delivery = rows.filter("h"), rows.filter("not h")
    buckets = bucket_count(history)
    index = stored(build_index(history, buckets), "mph")
    groups = stored(lookup(index, delivery, buckets), "groups")
    return (rows.drop("h").join(groups, "digest", "left")
            .withColumn("keep_id", F.nullif("keep_id", F.lit(NO_ID)))
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), "in_history"))
