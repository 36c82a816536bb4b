"""Byte-level BPE of whole texts, long texts in overlapping chunks.

A text longer than one chunk is cut into chunks that each run OVERLAP code
points into the next one, and the chunks are pre-tokenised in parallel.  The
pattern looks ahead but never behind, so its state at a boundary is the
position alone: once two neighbouring chunks share a boundary in their overlap,
everything the later one found from there on is what the whole text would give
(up to the look-ahead at its own end, which MARGIN leaves out).  Neighbours are
stitched at the first shared boundary.  A text with an overlap that holds no
shared boundary (one run of letters longer than the overlap, say) is encoded
from its rejoined text instead.

Pieces between boundaries are encoded one by one; decoding concatenates the
ids' raw bytes.
"""

from __future__ import annotations

import base64
import functools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import null_id, plain_id

CHUNK = 16_384
OVERLAP = 512
#: Code points that a match may look beyond its end ('ll, and white space before a word).
MARGIN = 8
#: Distinct pieces remembered by a worker; beyond that it starts afresh.
CACHE_PIECES = 200_000
#: Documents a worker answers at a time.
BATCH = 256

Ranks = dict[bytes, int]


def rank_file(path: str) -> Ranks:
    """Ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def json_ranks(path: str) -> Ranks:
    """Ranks of a byte-level BPE ``.json`` file whose ids follow its merges.
    Its tokens spell each byte as one printable character."""
    from tokenizers import Tokenizer

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if all(c in byte_of for c in t)}


def added_tokens(load: Callable[[str], Ranks], path: str) -> dict[str, int]:
    """Added tokens of a ``.json`` file: a text is split at them before the
    pattern, and each gives its id.  A rank file has none."""
    if load is not json_ranks:
        return {}
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens") or []
    odd = [t["content"] for t in tokens if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
    if odd:
        raise ValueError(f"added tokens that take in white space or whole words only: {odd}")
    return {t["content"]: t["id"] for t in tokens}


class Encoder(dict):
    """Ids of a pre-token as little-endian unsigned 32-bit bytes, remembered."""

    def __init__(self, ranks: Ranks, added: dict[str, int] | None = None):
        super().__init__()
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in (added or {}).items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.splits = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        specials = {k for k in ranks if k.startswith(b"<|")}
        ranks = {k: v for k, v in ranks.items() if k not in specials}
        self.core = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        known = ranks | {t.encode(): i for t, i in (added or {}).items()}
        self.raw = [b""] * (max(known.values(), default=-1) + 1)
        for token, i in known.items():
            self.raw[i] = token

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.core._encode_single_piece(piece), "<u4").tobytes()
        if len(self) >= CACHE_PIECES:
            self.clear()
        self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return b"".join(self.added[part] if part in self.added else self._plain(part)
                            for part in self.splits.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def ids_between(self, text: str, begin: int, end: int) -> bytes:
        """Ids of the pre-tokens of ``text[begin:]`` that begin before ``end``."""
        pieces = []
        for m in self.pattern.finditer(text, begin):
            if m.start() >= end:
                break
            pieces.append(m[0])
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=4)
def encoder(load: Callable[[str], Ranks], path: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(load(path), added_tokens(load, path))


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunk rows of long texts, a bounded number at a time."""
    for pdf in frames:
        for row, doc, text in zip(pdf["row_no"], pdf["doc_id"], pdf["text"], strict=True):
            starts = range(0, max(1, len(text) - OVERLAP), CHUNK)
            for at in range(0, len(starts), BATCH):
                part = starts[at:at + BATCH]
                yield pd.DataFrame({
                    "row_no": row, "doc_id": doc,
                    "chunk_no": [s // CHUNK for s in part], "last": [s == starts[-1] for s in part],
                    "text": [text[s:] if s == starts[-1] else text[s:s + CHUNK + OVERLAP] for s in part]})


def _boundaries(pattern, text: str, last: bool) -> tuple[list[int], list[int]]:
    """Offsets within the overlap where matches begin: those near the chunk's
    start (from 0) and those near its end (from CHUNK), the unsure ones left
    out."""
    starts = [m.start() for m in pattern.finditer(text)]
    sure = len(text) - (0 if last else MARGIN)
    head = [s for s in starts if s < OVERLAP]
    # a match begins at s if the one before it, which ended at s, was not changed by the cut
    tail = [] if last else [s - CHUNK for s in starts if CHUNK <= s <= sure]
    return head, tail


def _pretokenise(frames):
    pattern = regex.compile(public_tokenizers.PATTERN)
    for pdf in frames:
        found = [_boundaries(pattern, t, z) for t, z in zip(pdf["text"], pdf["last"], strict=True)]
        pdf["head"], pdf["tail"] = [h for h, _ in found], [t for _, t in found]
        yield pdf


_CHUNKS = "row_no long, doc_id long, chunk_no long, last boolean, text string"
ENCODED = "doc_id long, n_tokens long, ids binary"


def _encode_whole(load, path):
    def run(frames):
        enc = encoder(load, path)
        for pdf in frames:
            for at in range(0, len(pdf), BATCH):
                part = pdf.iloc[at:at + BATCH]
                ids = [enc.ids(t) for t in part["text"]]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "n_tokens": [len(x) // 4 for x in ids],
                                    "ids": ids})
    return run


def _encode_chunks(load, path):
    """Chunk rows arrive by text and in order.  Keeps one text's ids at a time
    (and, for a text that did not resynchronise, its text)."""
    def run(frames):
        enc, ids, rest = encoder(load, path), [], []
        for pdf in frames:
            for doc, last, text, begin, end, whole in zip(
                    pdf["doc_id"], pdf["last"], pdf["text"], pdf["begin"], pdf["end"], pdf["rejoin"], strict=True):
                if whole:
                    rest.append(text if last else text[:CHUNK])
                else:
                    ids.append(enc.ids_between(text, int(begin), len(text) if last else CHUNK + int(end)))
                if last:
                    out = enc.ids("".join(rest)) if whole else b"".join(ids)
                    yield pd.DataFrame({"doc_id": [doc], "n_tokens": [len(out) // 4],
                                        "ids": [out]})
                    ids, rest = [], []
    return run


def encode(docs: DataFrame, path: str, load: Callable[[str], Ranks] = rank_file) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids`` (little-endian unsigned
    32-bit).  Null and empty texts have no token.  Repeated rows are encoded
    each.  An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(plain_id(), F.coalesce("text", F.lit("")).alias("text"))
    short = F.length("text") <= CHUNK + OVERLAP
    for token in added_tokens(load, path):  # a split that chunks do not see
        short = short | F.col("text").contains(token)
    whole = rows.filter(short).mapInPandas(_encode_whole(load, path), ENCODED)

    long = rows.filter(~short).withColumn("row_no", F.monotonically_increasing_id())
    chunks = (long.mapInPandas(_cut, _CHUNKS)
              .repartition("row_no", "chunk_no")
              .mapInPandas(_pretokenise, _CHUNKS + ", head array<int>, tail array<int>"))
    text = Window.partitionBy("row_no")
    order = text.orderBy("chunk_no")
    shared = lambda a, b: F.array_min(F.array_intersect(a, b))
    begin = F.when(F.col("chunk_no") == 0, 0).otherwise(shared(F.lag("tail").over(order), F.col("head")))
    end = shared(F.col("tail"), F.lead("head").over(order))
    stitched = chunks.select(
        "row_no", "doc_id", "chunk_no", "last", "text", begin.alias("begin"),
        F.when(F.col("last"), 0).otherwise(end).alias("end"))
    missing = (F.col("begin").isNull() | F.col("end").isNull()).cast("int")
    stitched = stitched.withColumn("rejoin", F.max(missing).over(text.orderBy("chunk_no").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)) == 1)
    stitched = stitched.select("doc_id", "last", "text", F.coalesce("begin", F.lit(0)).alias("begin"),
                               F.coalesce("end", F.lit(0)).alias("end"), "rejoin")
    return (whole.unionByName(stitched.mapInPandas(_encode_chunks(load, path), ENCODED))
            .withColumn("doc_id", null_id()))


def decode(encoded: DataFrame, path: str, load: Callable[[str], Ranks] = rank_file) -> DataFrame:
    """``doc_id, n_tokens, ids, bytes``: the raw bytes of the ids, joined."""
    def run(frames):
        enc = encoder(load, path)
        for pdf in frames:
            for at in range(0, len(pdf), BATCH):
                part = pdf.iloc[at:at + BATCH]
                yield part.assign(bytes=[enc.decode(x) for x in part["ids"]])
    return (encoded.withColumn("doc_id", plain_id()).mapInPandas(run, ENCODED + ", bytes binary")
            .withColumn("doc_id", null_id()))


def encode_report(docs: DataFrame, path: str, load: Callable[[str], Ranks] = rank_file) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    return decode(encode(docs, path, load), path, load).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
