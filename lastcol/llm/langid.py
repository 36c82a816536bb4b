"""Language identification by a byte convolutional network.

Filters of several widths slide over the bytes of a fixed-length window; each
filter's largest response (max pooling, rectified) feeds a softmax over the
languages.  Trained here in numpy by gradient steps on windows of labelled
texts.  A whole text is cut into windows (the last one padded); their
probabilities are combined by bytes.

For scoring, the embedding and the filter weights collapse into one table per
width and pair of neighbouring bytes, so that a filter's response is a sum of
table rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Training texts of each language, windows of each text.
FIT_DOCS = 400
FIT_WINDOWS = 3
#: The longest text that may be trained on, in characters.
FIT_CHARS = 50_000
STEPS = 1500
#: Windows scored at a time.
BATCH = 512
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    embed: np.ndarray           # 256 x EMBED; row 0 (padding) is zero
    filters: list[np.ndarray]   # width * EMBED x FILTERS
    bias: np.ndarray            # of all filters
    out: np.ndarray
    out_bias: np.ndarray


def windows(raw: bytes) -> np.ndarray:
    """All windows of a text, the last one padded with zero bytes."""
    n = -(-len(raw) // WINDOW)
    return np.frombuffer(raw + b"\0" * (n * WINDOW - len(raw)), np.uint8).reshape(n, WINDOW)


def _forward(m: Model, x: np.ndarray):
    e = m.embed[x]
    feats, at, cols = [], [], []
    for k, f in zip(WIDTHS, m.filters, strict=True):
        col = np.concatenate([e[:, j:WINDOW - k + 1 + j] for j in range(k)], axis=2)
        r = col @ f
        i = r.argmax(1)
        feats.append(np.take_along_axis(r, i[:, None], 1)[:, 0])
        at.append(i)
        cols.append(col)
    h = np.concatenate(feats, 1) + m.bias
    a = np.maximum(h, 0)
    z = a @ m.out + m.out_bias
    z -= z.max(1, keepdims=True)
    p = np.exp(z)
    return p / p.sum(1, keepdims=True), a, h, at, cols


def train(x: np.ndarray, y: np.ndarray, langs: list[str], seed: int = 0) -> Model:
    """Network for windows ``x`` of languages ``y`` (indexes into ``langs``),
    by Adam over random batches."""
    rng = np.random.default_rng(seed)
    m = Model(langs, rng.normal(0, 0.3, (256, EMBED)), [rng.normal(0, (k * EMBED) ** -0.5, (k * EMBED, FILTERS))
              for k in WIDTHS], np.zeros(FILTERS * len(WIDTHS)),
              rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(langs))), np.zeros(len(langs)))
    m.embed[0] = 0
    params = [m.embed, *m.filters, m.bias, m.out, m.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    if len(langs) < 2:
        return m
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(x), 32)
        xb, yb = x[pick], y[pick]
        p, a, h, at, cols = _forward(m, xb)
        dz = p.copy()
        dz[np.arange(len(yb)), yb] -= 1
        dz /= len(yb)
        dh = (dz @ m.out.T) * (h > 0)
        de = np.zeros_like(m.embed)
        df = []
        for w, k in enumerate(WIDTHS):
            g = dh[:, w * FILTERS:(w + 1) * FILTERS]
            best = np.take_along_axis(cols[w], at[w][:, :, None], 1)  # batch x FILTERS x width*EMBED
            df.append(np.einsum("bfe,bf->ef", best, g))
            back = (g[:, :, None] * m.filters[w].T[None]).reshape(len(xb), FILTERS, k, EMBED)
            where = at[w][:, :, None] + np.arange(k)
            byte = np.take_along_axis(xb[:, None, :].repeat(FILTERS, 1), where, 2)
            np.add.at(de, byte.reshape(-1), back.reshape(-1, EMBED))
        de[0] = 0
        grads = [de, *df, dh.sum(0), a.T @ dz, dz.sum(0)]
        rate = 0.01 if step < STEPS * 0.7 else 0.002
        for i, (v, g) in enumerate(zip(params, grads, strict=True)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            v -= rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return m


class Scorer:
    """Window probabilities from pair tables."""

    def __init__(self, m: Model):
        self.m, self.steps = m, []
        for k, f in zip(WIDTHS, m.filters, strict=True):
            taps = [(m.embed @ f[j * EMBED:(j + 1) * EMBED]).astype(np.float32) for j in range(k)]
            tables = []
            for j in range(0, k - 1, 2):  # index: first byte * 256 + second
                tables.append((j, (taps[j][:, None] + taps[j + 1][None]).reshape(65536, FILTERS)))
            if k % 2:
                tables.append((k - 1, taps[-1]))
            self.steps.append((k, tables))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.m.langs)))
        for lo in range(0, len(x), BATCH):
            part = x[lo:lo + BATCH].astype(np.int32)
            pair = part[:, :-1] * 256 + part[:, 1:]
            feats = []
            for k, tables in self.steps:
                n = WINDOW - k + 1
                r = None
                for j, t in tables:
                    v = t[(pair if len(t) > 256 else part)[:, j:j + n]]
                    r = v if r is None else np.add(r, v, out=r)
                feats.append(r.max(1))
            a = np.maximum(np.concatenate(feats, 1) + self.m.bias, 0)
            z = a @ self.m.out + self.m.out_bias
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            out[lo:lo + BATCH] = p / p.sum(1, keepdims=True)
        return out

    def texts(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Best language and its probability for each text."""
        raw = [t.encode() for t in texts]
        lang, score = [""] * len(raw), [0.0] * len(raw)
        total = np.zeros((len(raw), len(self.m.langs)))
        owner, parts, held = [], [], 0

        def flush():
            nonlocal owner, parts, held
            if parts:
                p = np.log(self.probabilities(np.concatenate(parts)) + 1e-6)
                np.add.at(total, np.repeat([o for o, _ in owner], [len(w) for w in parts]),
                          p * np.concatenate([s for _, s in owner])[:, None])
            owner, parts, held = [], [], 0

        for d, r in enumerate(raw):
            for at in range(0, len(r), BATCH * WINDOW):
                piece = r[at:at + BATCH * WINDOW]
                w = windows(piece)
                share = np.full(len(w), WINDOW / len(r))
                share[-1] = (len(piece) - (len(w) - 1) * WINDOW) / len(r)
                owner.append((d, share))
                parts.append(w)
                held += len(w)
                if held >= BATCH:
                    flush()
        flush()
        z = total - total.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        for d in range(len(raw)):
            i = int(p[d].argmax())
            lang[d], score[d] = self.m.langs[i], float(p[d, i])
        return lang, score


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; a row without an id is one."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def fit(docs: DataFrame) -> Model | None:
    """Network from at most FIT_DOCS texts of each language (of at most
    FIT_CHARS characters), chosen by a hash of the id; None without any."""
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.length("text").between(1, FIT_CHARS)
        & ~held_out(F.col("doc_id")))
    ids = usable.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    pick = F.broadcast(_smallest(ids, FIT_DOCS))
    rows = usable.join(pick, ["doc_id", "lang"]).collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"], r["text"]))
    taken, use = {}, []
    for r in rows:  # an id on several rows may bring more than were picked
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= FIT_DOCS:
            use.append(r)
    langs = sorted(taken)
    rng, x, y = np.random.default_rng(1), [], []
    for r in use:
        w = windows(r["text"].encode())
        for i in rng.permutation(len(w))[:FIT_WINDOWS]:
            x.append(w[i])
            y.append(langs.index(r["lang"]))
    return train(np.array(x), np.array(y), langs) if use else None


def _smallest(ids: DataFrame, k: int) -> DataFrame:
    """Of each language the ``k`` ids with the smallest hashes: first within
    each slice of the rows, so that no language is gathered whole, then over
    the slices' winners."""
    slices = Window.partitionBy("lang", F.pmod(F.col("h"), F.lit(64))).orderBy("h", "doc_id")
    some = ids.withColumn("r", F.row_number().over(slices)).filter(F.col("r") <= k)
    final = Window.partitionBy("lang").orderBy("h", "doc_id")
    return (some.withColumn("r", F.row_number().over(final)).filter(F.col("r") <= k)
            .select("doc_id", "lang").distinct())


_SCORERS: dict[bytes, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """One per worker process and model."""
    key = model.out.tobytes() + model.embed.tobytes()
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    A text without a letter (null and empty ones too) is ``und`` with score 0,
    and so is every text if no row has a language to learn from.  Repeated
    rows are predicted alike.  An empty table gives an empty result.  ``lang``
    is only learned from, on rows that are not held out; other columns are
    ignored.
    """
    model = fit(docs)
    letters = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       F.when(letters, F.col("text")).alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        lang, score = _scorer(model).texts([t or "" for t in texts])
        none = texts.isna().to_numpy()
        return pd.DataFrame({"lang": np.where(none, UNKNOWN, lang), "score": np.where(none, 0.0, score)})

    return rows.select("doc_id", "held_out", predict("text").alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
