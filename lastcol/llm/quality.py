"""Document quality by co-training of two views.

One classifier sees only the text (character and word statistics, and hashed
words), the other only the page's metadata (source, language, recorded length
and how that length sits among the source's).  Both start from the labelled
rows.  In each round each view labels, of all unlabelled rows, the share it is
surest of, and the other view learns them with its own.  At the end each view is
calibrated on labelled rows it did not train on, and the calibrated scores are combined.

Features are computed once for every row and stored.  A round is two passes over
them: the first gives the quantiles of each view's scores over the rows that are
still free, the second adds up the second moments of the newly labelled rows, from
which the pupil is fitted anew.  Only the labelled rows are a bounded sample
(FIT_ROWS of each label).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, NO_ID, null_id, plain_id, stored

#: Labelled rows of each class that are learned from.
FIT_ROWS = 1500
ROUNDS = 4
#: Share of the free unlabelled rows that a view labels in a round, from each end.
SURE = 0.05
HASHED = 256
#: Features of the metadata view.
META = 12
#: Share of the labelled rows kept for calibration.
CALIBRATE = 0.25
#: Sources whose statistics are broadcast; joined beyond.
BROADCAST_ROWS = 100_000
_WORD = re.compile(r"\S+")


def text_features(text: str | None) -> np.ndarray:
    """Statistics of a whole text and the shares of its hashed words."""
    text = text or ""
    words = _WORD.findall(text)
    out = np.zeros(12 + HASHED)
    if not words:
        out[0] = 1
        return out
    n, lower = len(text), [w.lower() for w in words]
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    distinct = set(lower)
    lines = [x for x in text.split("\n") if x.strip()]
    marks = sum(not w[-1].isalnum() for w in words)
    odd = sum(any(c in "|#$%&*<>{}[]=\\^~" for c in w) for w in words)
    runs = sum(a == b for a, b in zip(lower, lower[1:]))
    pairs = len(set(zip(lower, lower[1:])))
    out[1:12] = (letters / n, upper / max(1, letters), len(distinct) / len(words), odd / len(words), marks / len(words),
                 runs / len(words), pairs / max(1, len(words) - 1), len(set(lines)) / len(lines),
                 sum(map(len, words)) / len(words) / 10, sum("!!" in w for w in words) / len(words),
                 np.log1p(len(words)) / 10)
    for w in distinct:
        out[12 + zlib.crc32(w.encode()) % HASHED] += 1
    out[12:] /= max(1.0, np.sqrt((out[12:] ** 2).sum()))
    return out


def _meta_columns() -> list[Column]:
    """Metadata as numbers: never the text, a label or the id."""
    size = F.log1p(F.greatest(F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0)), F.lit(0.0)))
    bucket = lambda c, n: F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(n))
    z = (size - F.coalesce("mean", F.lit(0.0))) / F.greatest(F.coalesce("sd", F.lit(1.0)), F.lit(0.1))
    cols = [size / 10, z / 3, F.least(F.abs(z), F.lit(3.0)) / 3, F.coalesce("share", F.lit(0.0))]
    return cols + [(bucket("lang", 8) == i).cast("double") for i in range(8)]


def with_metadata(docs: DataFrame) -> DataFrame:
    """``doc_id, text, meta``: the metadata view over all rows.  Per source:
    mean and deviation of the log length and the source's share of all rows,
    from one aggregation with map-side combine."""
    size = F.log1p(F.greatest(F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0)), F.lit(0.0)))
    base = docs.select("doc_id", "text", "lang", "n_chars", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))
    stats = stored(base.groupBy("source").agg(F.avg(size).alias("mean"), F.stddev_pop(size).alias("sd"),
                                              F.count("*").alias("rows")), "sources")
    total = stats.agg(F.sum("rows"), F.count("*")).first()
    stats = stats.select("source", "mean", "sd", (F.col("rows") / F.lit(float(total[0] or 1))).alias("share"))
    joined = base.join(F.broadcast(stats) if total[1] <= BROADCAST_ROWS else stats, "source", "left")
    return joined.select("doc_id", "text", F.array(*_meta_columns()).alias("meta"))


@dataclass
class View:
    """A linear score over standardised features, as log odds, with its calibration."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.offset, -30, 30)))


@dataclass
class Model:
    text: View
    meta: View
    mix: np.ndarray  # bias, weight of the text view's log odds, of the metadata view's


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> tuple[np.ndarray, float]:
    """Balanced, ridged logistic regression by Newton steps."""
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    xb, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    reg = np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(xb @ w, -30, 30)))
        grad = xb.T @ (cost * (p - y)) + reg * w
        h = (xb * (cost * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ xb + np.diag(reg)
        step = np.linalg.solve(h, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per class the products of the features and a one, summed over rows: such sums add up."""
    z = np.c_[x, np.ones(len(x))]
    return np.stack([z[y == c].T @ z[y == c] for c in (0, 1)])


def _view(sums: np.ndarray, x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> View:
    """Ridged least squares for the class as -1 and 1, classes of equal weight, from
    moments; turned into log odds on the labelled rows ``x, y``."""
    share = 0.5 / np.maximum(1, sums[:, -1, -1])
    both = (sums * share[:, None, None]).sum(0)
    mean = both[:-1, -1] / both[-1, -1]
    spread = both[:-1, :-1] / both[-1, -1] - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread), 0.02 ** 2))
    towards = sum(sign * share[c] * (sums[c][:-1, -1] - sums[c][-1, -1] * mean) for c, sign in ((0, -1), (1, 1))) / scale
    w = np.linalg.solve(spread / np.outer(scale, scale) + ridge * np.eye(len(mean)), towards)
    slope, offset = _logistic(((x - mean) / scale @ w)[:, None], y, ridge=1e-3)
    return View(mean, scale, w * max(0.0, float(slope[0])), offset)


def _odds(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1 - 1e-6))


PUPIL = {"text": "meta", "meta": "text"}


def taken(events: list, x: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """What the events ``(teacher, view, low, high)`` say about rows with features
    ``x``: per pupil the labels (-1: none), and which rows are still free."""
    n = len(x["text"])
    free, labels = np.ones(n, bool), {k: np.full(n, -1) for k in PUPIL}
    for teacher, view, low, high in events:
        raw = view.raw(x[teacher])
        sure = free & ((raw <= low) | (raw >= high))
        labels[PUPIL[teacher]][sure] = raw[sure] > 0
        free &= ~sure
    return labels, free


class ArrayPool:
    """Unlabelled rows in memory."""

    def __init__(self, xt: np.ndarray, xm: np.ndarray):
        self.x = {"text": xt, "meta": xm}

    def ends(self, events, views):
        """Per view the scores that cut off SURE of the free rows at either end; None without rows."""
        free = taken(events, self.x)[1]
        if not free.any():
            return None
        return {k: tuple(np.quantile(v.raw(self.x[k][free]), [SURE, 1 - SURE])) for k, v in views.items()}

    def moments(self, before, events):
        """Moments of the rows that the events label, and ``before`` do not, per pupil."""
        free, (labels, _) = taken(before, self.x)[1], taken(events, self.x)
        return {k: moments(self.x[k][free & (y >= 0)], y[free & (y >= 0)]) for k, y in labels.items()}


class TablePool:
    """Unlabelled rows as a stored table ``(xt, xm)`` of packed features: every
    answer is a pass over all of them, added up by Spark."""

    def __init__(self, table: DataFrame):
        self.table = table

    def ends(self, events, views):
        def run(frames):
            for pdf in frames:
                pool = _unpacked(pdf)
                free = taken(events, pool)[1]
                yield pd.DataFrame({k: v.raw(pool[k][free]) for k, v in views.items()})

        got = self.table.mapInPandas(run, "text double, meta double").agg(
            F.count("*").alias("n"), *[F.percentile_approx(k, [SURE, 1 - SURE], 10_000).alias(k) for k in views]).first()
        return {k: tuple(got[k]) for k in views} if got["n"] else None

    def moments(self, before, events):
        sizes = {"text": 12 + HASHED + 1, "meta": META + 1}

        def run(frames):
            sums = {k: np.zeros((2, d, d)) for k, d in sizes.items()}
            for pdf in frames:
                for k, m in ArrayPool(*_unpacked(pdf).values()).moments(before, events).items():
                    sums[k] += m
            salt = TaskContext.get().partitionId() % 64
            for k, m in sums.items():
                if m.any():
                    at = list(range(0, sizes[k], SUM_ROWS))
                    yield pd.DataFrame({"view": k, "at": at, "salt": salt, "data": [
                        zlib.compress(np.ascontiguousarray(m[:, i:i + SUM_ROWS]).tobytes(), 1) for i in at]})

        blocks, keys, schema = self.table.mapInPandas(run, _BLOCKS), ["view", "at", "salt"], _BLOCKS
        for _ in range(2):  # in two levels, so that no task reads the blocks of all tasks
            blocks = stored(blocks.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_added, schema), "moments").withColumn(
                "salt", F.lit(0))
        out = {k: np.zeros((2, d, d)) for k, d in sizes.items()}
        for r in blocks.collect():  # fixed size: pairs of features
            part = np.frombuffer(zlib.decompress(r["data"])).reshape(2, -1, sizes[r["view"]])
            out[r["view"]][:, r["at"]:r["at"] + part.shape[1]] = part
        return out


_BLOCKS = "view string, at int, salt int, data binary"
#: Rows of a sum of moments that travel together.
SUM_ROWS = 16


def _added(frames):
    """Sum of the blocks of each ``(view, at, salt)``, which come in order; one is held."""
    key, total = None, None
    row = lambda: pd.DataFrame([(*key, zlib.compress(total.tobytes(), 1))], columns=["view", "at", "salt", "data"])
    for pdf in frames:
        for *now, data in zip(pdf["view"], pdf["at"], pdf["salt"], pdf["data"], strict=True):
            part = np.frombuffer(zlib.decompress(data))
            if now != key:
                if key is not None:
                    yield row()
                key, total = now, np.zeros(len(part))
            total = total + part
    if key is not None:
        yield row()


def _unpacked(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
    n = len(pdf)
    take = lambda c, d: np.frombuffer(b"".join(pdf[c]), np.float32).astype(float).reshape(n, d)
    return {"text": take("xt", 12 + HASHED), "meta": take("xm", META)}


def co_train_views(xt: np.ndarray, xm: np.ndarray, y: np.ndarray, pool, seed: int = 0) -> Model:
    """Model from labelled rows (text and metadata features, labels) and a pool
    of unlabelled ones."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    cut = int(len(y) * CALIBRATE)
    check, fit = order[:cut], order[cut:]
    own = {"text": xt[fit], "meta": xm[fit]}
    sums = {k: moments(x, y[fit]) for k, x in own.items()}
    views = {k: _view(sums[k], own[k], y[fit]) for k in own}
    events: list = []
    for _ in range(ROUNDS):
        ends = pool.ends(events, views)
        if ends is None:
            break
        before = list(events)
        # sure means beyond the teacher's own margin, not merely the end of the list
        events += [(k, views[k], min(low, -1.0), max(high, 1.0)) for k, (low, high) in ends.items()]
        for k, m in pool.moments(before, events).items():
            sums[k] = sums[k] + m
        views = {k: _view(sums[k], own[k], y[fit]) for k in own}
    held = {"text": xt[check], "meta": xm[check]}
    for k, v in views.items():
        w, b = _logistic(v.raw(held[k])[:, None], y[check], ridge=1e-3)
        v.slope, v.offset = max(0.0, float(w[0])), b
    both = np.c_[_odds(views["text"].probability(held["text"])), _odds(views["meta"].probability(held["meta"]))]
    w, b = _logistic(both, y[check], ridge=1e-3)
    return Model(views["text"], views["meta"], np.r_[b, np.maximum(w, 0)])


def co_train(xt: np.ndarray, xm: np.ndarray, y: np.ndarray, pt: np.ndarray, pm: np.ndarray, seed: int = 0) -> Model:
    """:func:`co_train_views` with a pool in memory."""
    return co_train_views(xt, xm, y, ArrayPool(pt, pm), seed)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; a row without an id is one."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def _pack(frames):
    for pdf in frames:
        for at in range(0, len(pdf), 512):
            part = pdf.iloc[at:at + 512]
            yield pd.DataFrame({"doc_id": part["doc_id"], "xt": [text_features(t).astype(np.float32).tobytes() for t in part["text"]],
                                "xm": [np.asarray(m, np.float32).tobytes() for m in part["meta"]]})


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, xt, xm``: both views of every row as packed numbers, stored."""
    rows = with_metadata(docs)
    return stored(rows.select(plain_id(), "text", "meta").mapInPandas(_pack, "doc_id long, xt binary, xm binary"), "features")


def fit(rows: DataFrame, labels: DataFrame) -> Model | None:
    """Model from ``rows(doc_id, xt, xm)`` and a bounded sample of the labels,
    chosen by a hash of the id; None if these hold one class or none."""
    labelled = labels.select(plain_id(), F.col("quality").cast("int").alias("y")).filter(F.col("doc_id") != NO_ID)
    usable = labelled.filter(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    by_hash = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    pick = by_hash(usable.filter("y = 0"), FIT_ROWS).unionByName(by_hash(usable.filter("y = 1"), FIT_ROWS))
    pick = stored(pick.groupBy("doc_id").agg(F.min("y").alias("y")), "sample")
    got = rows.join(F.broadcast(pick), "doc_id").distinct().orderBy("doc_id", "xt").toPandas()
    y = got["y"].to_numpy(int)
    if not (y == 0).any() or not (y == 1).any():
        return None
    x = _unpacked(got)
    known = stored(labelled.select("doc_id").distinct(), "known")
    few = known.count() <= BROADCAST_IDS
    free = rows.filter((F.col("doc_id") != NO_ID) & ~held_out(F.col("doc_id"))).join(
        F.broadcast(known) if few else known, "doc_id", "left_anti")
    return co_train_views(x["text"], x["meta"], y, TablePool(stored(free.select("xt", "xm"), "pool")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, text_score,
    meta_score`` (probabilities of quality 1).

    Null and empty texts are scored as texts without words; missing metadata
    as unknown.  Repeated rows are scored alike.  Without labels of both
    classes every score is 0.5.  An empty table gives an empty result.  Labels
    are never inputs of a score.
    """
    rows = features(docs)
    model = fit(rows, labels)
    if model is None:
        half = F.lit(0.5)
        scored = rows.select("doc_id", half.alias("score"), half.alias("text_score"), half.alias("meta_score"))
    else:
        def run(frames):
            for pdf in frames:
                x = _unpacked(pdf)
                t, m = model.text.probability(x["text"]), model.meta.probability(x["meta"])
                z = model.mix[0] + model.mix[1] * _odds(t) + model.mix[2] * _odds(m)
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": 1 / (1 + np.exp(-np.clip(z, -30, 30))), "text_score": t, "meta_score": m})

        scored = rows.mapInPandas(run, "doc_id long, score double, text_score double, meta_score double")
    scored = scored.withColumn("doc_id", null_id())
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_score", "meta_score")
