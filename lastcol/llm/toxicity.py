"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two words sums over all four-letter subsequences that both hold
within SPAN letters; each counts with DECAY to the power of the stretch it
covers, and words are scaled to unit length.  An inserted letter leaves most
subsequences in place, only a little wider, and signs within a word are left
out, so ``idiiot`` and ``id.iot`` stay near ``idiot``.

Nyström: the words that separate the classes best, and frequent clean words,
are landmarks; a word is mapped by its kernel values with them times
``K_mm**-1/2``.  A sentence is the sum of its words (a set kernel), and the
machine is linear in that space, so it comes down to one weight for each
subsequence of a landmark, and a sentence's value is a sum of word values, each
computed once per worker and word.  Training labels are those of whole documents: the
machine is refitted on the sentences that it itself finds toxic in toxic
documents (multiple-instance SVM).  A document's score is the calibrated value
of its worst sentence.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 6
DECAY = 0.85
#: Landmark words of each class.
LANDMARKS = 48
#: Words of a sentence; a longer one counts as several.
SENTENCE = 32
#: Training documents of each class, and the longest text that may be one.
FIT_DOCS = 1000
#: Clean sentences trained on.
FIT_SENTENCES = 12_000
FIT_CHARS = 20_000
#: Weight of the clean class, to the toxic one, when scores are calibrated.
CLEAN_WEIGHT = 4.0
CACHE_WORDS = 300_000
#: Words handled together (a multiple of SENTENCE).
MANY_WORDS = 3200 * SENTENCE

_GAPS = [(a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]
_SYMBOLS = np.zeros(128, np.int64)  # 0: left out of a word
_SYMBOLS[97:123] = np.arange(1, 27)
_SYMBOLS[65:91] = np.arange(1, 27)
# Digits and signs that stand for letters.
for _c, _l in zip("0134578@$!", "oieastbasi", strict=True):
    _SYMBOLS[ord(_c)] = ord(_l) - 96
_START = "\x01"  # begins every word and counts as a letter
_SYMBOLS[1] = 31
_SPELLED = re.compile(r"(?<!\S)\S(?: \S){3,}(?!\S)")
_ENDS = (".", "!", "?", ":", ";", "…")
_MARK = 4096.0  # added to the value of a word that ends a sentence


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Of all words together: (word index, id of the four letters, weight), by
    gaps.  Signs within a word are left out first."""
    if not words:
        return
    lens = np.array([len(w) + 1 for w in words], np.int64)
    chars = np.frombuffer((_START + _START.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sym = np.where(chars < 128, _SYMBOLS[np.minimum(chars, 127)], 27 + chars % 4)
    word = np.repeat(np.arange(len(words)), lens)
    word, sym = word[sym > 0], sym[sym > 0]
    n = len(sym)
    for a, b, c in _GAPS:
        if n > c:
            ok = word[:-c] == word[c:]
            ids = ((sym[:-c] * 32 + sym[a:n - c + a]) * 32 + sym[b:n - c + b]) * 32 + sym[c:]
            yield word[:-c][ok], ids[ok], DECAY ** (c + 1)


def _norms(words: list[str]) -> np.ndarray:
    total = np.zeros(len(words))
    for word, _, v in subsequences(words):
        total += v * v * np.bincount(word, minlength=len(words))
    return np.sqrt(np.maximum(total, 1e-12))


def landmark_vectors(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids of the landmarks' subsequences and, by id, the landmarks'
    (unit) vectors."""
    parts = list(subsequences(landmarks))
    ids = np.unique(np.concatenate([i for _, i, _ in parts])) if parts else np.empty(0, np.int64)
    table, norm = np.zeros((len(ids), len(landmarks))), _norms(landmarks)
    for word, i, v in parts:
        np.add.at(table, (np.searchsorted(ids, i), word), v / norm[word])
    return ids, table


def kernel(words: list[str], ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Kernel of each word with each landmark."""
    out = np.zeros((len(words), table.shape[1]))
    if not len(ids):
        return out
    row = np.full(1 << 20, -1, np.int32)
    row[ids] = np.arange(len(ids))
    for word, i, v in subsequences(words):
        at = row[i]
        word, at = word[at >= 0], at[at >= 0]
        if len(word):  # words come in order: one sum per stretch
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            for lo in range(0, len(starts), 4096):
                s = starts[lo:lo + 4096]
                end = starts[lo + 4096] if lo + 4096 < len(starts) else len(word)
                out[word[s]] += v * np.add.reduceat(table[at[s[0]:end]], s - s[0])
    return out / _norms(words)[:, None]


@dataclass
class Model:
    """The machine as a weight per subsequence: the weighted sum of the
    landmarks' vectors."""
    ids: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def tokens(text: str) -> list[str]:
    """White-space words in lower case; letters spelled one by one are one
    word."""
    text = text.lower()
    if _SPELLED.search(text):
        text = _SPELLED.sub(lambda m: m[0].replace(" ", ""), text)
    return text.split()


class Scorer:
    """Values of words, remembered; scores of texts."""

    def __init__(self, model: Model):
        self.model = model
        self.table = np.zeros(1 << 20, np.float32)
        self.table[model.ids] = model.weights
        self.number: dict[str, int] = {}
        self.values = np.empty(0)

    def word_values(self, words: list[str]) -> np.ndarray:
        total, square = np.zeros(len(words)), np.zeros(len(words))
        for word, i, v in subsequences(words):
            total += v * np.bincount(word, weights=self.table[i], minlength=len(words))
            square += v * v * np.bincount(word, minlength=len(words))
        return total / np.sqrt(np.maximum(square, 1e-12))

    def _learn(self, words: set[str]) -> None:
        if len(self.number) > CACHE_WORDS:
            self.number, self.values = {}, np.empty(0)
        new = [w for w in words if w not in self.number]
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            self.number.update(zip(part, range(len(self.number), len(self.number) + len(part)), strict=True))
            ends = np.array([w.endswith(_ENDS) for w in part])
            self.values = np.concatenate([self.values, self.word_values(part) + _MARK * ends])

    def sentences(self, words: list[str]) -> np.ndarray:
        """Decision value of each sentence of one text; a word counts once in
        a sentence, however often it is repeated."""
        if not words:
            return np.array([self.model.bias])
        if len(words) > MANY_WORDS:
            return np.concatenate([self.sentences(words[i:i + MANY_WORDS]) for i in range(0, len(words), MANY_WORDS)])
        self._learn(set(words))
        number = np.array([self.number[w] for w in words], np.int64)
        ends = self.values[number] > _MARK / 2
        at = np.flatnonzero(np.r_[True, ends[:-1]])
        since = np.arange(len(words)) - np.repeat(at, np.diff(np.r_[at, len(words)]))
        sentence = np.cumsum(since % SENTENCE == 0) - 1
        once = np.unique((sentence << 32) | number)
        number = once & 0xFFFFFFFF
        v = self.values[number]
        return np.bincount(once >> 32, weights=np.where(v > _MARK / 2, v - _MARK, v)) + self.model.bias

    def score(self, text: str | None) -> float:
        worst = float(self.sentences(tokens(text or "")).max())
        z = self.model.slope * worst + self.model.offset
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, z)))))


def _split(text: str) -> list[list[str]]:
    out, cur = [], []
    for w in map(sys.intern, tokens(text)):  # a word is held once, however often it occurs
        cur.append(w)
        if w.endswith(_ENDS) or len(cur) == SENTENCE:
            out.append(cur)
            cur = []
    return out + [cur] if cur else out


def _parts(words: list[str]) -> list[list[str]]:
    return [words[i:i + 5000] for i in range(0, len(words), 5000)]


def _noisy(word: str, rng: np.random.Generator) -> str:
    """The word with one character put in."""
    at = int(rng.integers(1, len(word))) if len(word) > 1 else 1
    return word[:at] + str(rng.choice(list(".-*_~aeiou"))) + word[at:]


def _svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge, classes balanced) by accelerated gradient steps."""
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    xb = np.c_[x, np.ones(len(x), np.float32)].astype(np.float32)
    y, cost = y.astype(np.float32), cost.astype(np.float32)
    lam = 1e-4
    lip = 2 * np.linalg.eigvalsh(xb.T @ (cost[:, None] * xb))[-1] + lam
    w = np.zeros(xb.shape[1], np.float32)
    z, t = w.copy(), 1.0
    for _ in range(150):
        slack = np.maximum(0, 1 - y * (xb @ z))
        grad = -2 * xb.T @ (cost * y * slack) + lam * z
        new = z - grad / lip
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1], float(w[-1])


def train(texts: list[str], toxic: list[int], seed: int = 0) -> Model:
    """Model of labelled texts.  One class only, or none: a model that scores
    every text alike, near the share of toxic ones."""
    rng = np.random.default_rng(seed)
    y = np.array(toxic, int)
    if len(set(toxic)) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.0, 0.01, 0.99))
        return Model(np.empty(0, np.int64), np.empty(0, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    docs = [_split(t) for t in texts]
    seen: dict[str, list[int]] = {}
    for label, sents in zip(toxic, docs, strict=True):
        for w in {w.strip(".,!?:;\"'()") for s in sents for w in s}:
            if len(w) >= 4:
                seen.setdefault(w, [0, 0])[label] += 1
    pos, neg = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    rate = {w: (n[1] / pos, n[0] / neg) for w, n in seen.items()}
    gain = {w: a * np.log((a + 1e-4) / (c + 1e-4)) for w, (a, c) in rate.items() if a > c}
    lead = sorted(gain, key=lambda w: (-gain[w], w))[:LANDMARKS]
    n_lead = len(lead)
    # clean landmarks: the commonest clean words, and those most like the others
    clean = sorted((w for w in seen if rate[w][1] >= rate[w][0]), key=lambda w: (-seen[w][0], w))
    first = landmark_vectors(lead)
    near = (np.concatenate([kernel(part, *first).max(1) for part in _parts(clean)]) if clean and lead
            else np.zeros(len(clean)))
    lead += clean[:LANDMARKS // 2]
    lead += [clean[i] for i in np.argsort(-near, kind="stable")[:LANDMARKS] if clean[i] not in lead]
    ids, table = landmark_vectors(lead)
    k_mm = kernel(lead, ids, table)
    val, vec = np.linalg.eigh((k_mm + k_mm.T) / 2)
    keep = val > 1e-6 * val.max()
    root = vec[:, keep] / np.sqrt(val[keep])  # K_mm^-1/2 up to a rotation

    sents, owner = [], []
    clean_total = max(1, sum(len(s) for s, t in zip(docs, toxic, strict=True) if not t))
    for d, own in enumerate(docs):
        for s in own:
            if toxic[d] or rng.random() < FIT_SENTENCES / clean_total:
                sents.append(s)
                owner.append(d)
    # copies with a character put into each word, so that weights rest on what survives it
    extra = rng.permutation(len(sents))[:len(sents) // 2]
    all_sents = sents + [[_noisy(w, rng) if len(w) > 3 else w for w in sents[i]] for i in extra]
    own = np.array(owner + [owner[i] for i in extra], int)
    all_sents = [sorted(set(s)) for s in all_sents]
    vocab = {w: i for i, w in enumerate(sorted({w for s in all_sents for w in s}))}
    # how purely a landmark stands for toxic documents
    tie = np.array([np.log((rate[w][0] + 1e-4) / (rate[w][1] + 1e-4)) for w in lead[:n_lead]])
    tie = tie / tie.max() if n_lead else tie
    phi, lead_value = [], []
    for part in _parts(list(vocab)):
        k = kernel(part, ids, table)
        phi.append((k @ root).astype(np.float32))
        lead_value.append((np.minimum(k[:, :n_lead], 1) * tie).max(1, initial=0.0))
    phi, lead_value = np.concatenate(phi), np.concatenate(lead_value)
    flat = np.array([vocab[w] for s in all_sents for w in s], int)
    starts = np.cumsum([0] + [len(s) for s in all_sents[:-1]])
    x = np.empty((len(starts), phi.shape[1]), np.float32)
    for lo in range(0, len(starts), 4096):
        at = starts[lo:lo + 4096]
        end = starts[lo + 4096] if lo + 4096 < len(starts) else len(flat)
        x[lo:lo + 4096] = np.add.reduceat(phi[flat[at[0]:end]], at - at[0])

    lab = y[own] * 2 - 1
    # start: sentences of toxic documents that hold the word most tied to the label
    strong = np.maximum.reduceat(lead_value[flat], starts)
    cut = min(0.8, np.quantile(strong[lab < 0], 0.999)) if (lab < 0).any() else 0.0
    sl = np.where((lab > 0) & (strong > cut), 1, -1)
    use = (lab < 0) | (sl > 0)
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(4):
        if not (sl[use] > 0).any():
            use, sl = np.ones(len(x), bool), lab
        w, b = _svm(x[use], sl[use].astype(float))
        f = x @ w + b
        new = np.where((lab > 0) & (f > 0), 1, -1)
        for d in np.flatnonzero(y):  # a toxic document keeps its worst sentence, unless it holds nothing toxic
            mine = np.flatnonzero(own == d)
            if len(mine) and not (new[mine] > 0).any() and f[mine].max() > -0.5:
                new[mine[np.argmax(f[mine])]] = 1
        if (new == sl).all():
            break
        sl, use = new, (lab < 0) | (new > 0)
    model = Model(ids, (table @ (root @ w)).astype(np.float32), b, 1.0, 0.0)
    scorer = Scorer(model)  # calibrated on whole documents
    model.slope, model.offset = _calibrate(
        np.array([scorer.sentences(tokens(t)).max() for t in texts]), y)
    return model


def _calibrate(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling; clean documents, the larger class of any corpus, weigh
    CLEAN_WEIGHT times as much as toxic ones."""
    clean = CLEAN_WEIGHT / (1 + CLEAN_WEIGHT)
    cost = np.where(y > 0, (1 - clean) / max(1, y.sum()), clean / max(1, (1 - y).sum()))
    a, b = 1.0, 0.0
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(a * f + b, -60, 60)))
        e = cost * (p - y)
        a, b = max(0.05, a - 2.0 * float((e * f).sum() + 1e-3 * (a - 1))), b - 2.0 * float(e.sum())
    return a, b


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; a row without an id is one."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, size: int = FIT_DOCS) -> DataFrame:
    """At most ``size`` labelled rows of each class, by a hash of the id:
    ``text, toxic``.  The ids are chosen first (a bounded list, so it may be
    broadcast); texts are joined to that list only."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    pick = None
    for c in (0, 1):
        one = usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * size)
        pick = one if pick is None else pick.unionByName(one)
    pick = pick.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return (docs.select("doc_id", "text").filter(F.length("text").between(1, FIT_CHARS))
            .join(F.broadcast(pick), "doc_id").select("doc_id", "text", "toxic"))


def fit(docs: DataFrame, labels: DataFrame, size: int = FIT_DOCS) -> Model:
    """Model of a bounded sample (at most ``2 * size`` texts of each class,
    each of at most FIT_CHARS)."""
    rows = sample(docs, labels, size).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    taken, use = {0: 0, 1: 0}, []
    for r in rows:
        if taken[r["toxic"]] < size:
            taken[r["toxic"]] += 1
            use.append(r)
    return train([r["text"] for r in use], [r["toxic"] for r in use])


def score_column(model: Model):
    """Column function: text -> score."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scorer = _scorer(model)
        return pd.Series([scorer.score(t) for t in texts], dtype=float)
    return score


_SCORERS: dict[bytes, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """One per worker process and model."""
    key = model.weights.tobytes() + model.ids.tobytes()
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Null and empty texts get the score of no words.  Repeated rows are scored
    alike.  An empty table, or labels of one class, give constant scores.
    Other columns are ignored and labels never reach a score.
    """
    score = score_column(fit(docs, labels))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
