"""Personal data by weak supervision, in DataFrame functions only.

1. Candidates: matches of the four base patterns and of looser ones (spelled
   out or defanged addresses, numbers without a leading plus), with offsets in
   code points, 40 code points of text before and one after.
2. Labelers vote +1, 0 or -1 on each candidate: the checked pattern (regex), a
   gazetteer of prefixes and endings, cue words in the context, and the
   neighbouring characters.
3. Expectation-maximisation over the counts of vote patterns estimates, per
   kind, how often each labeler is right.  Counts come from one aggregation
   over all documents; there are at most 3**4 patterns per kind, so only that
   table reaches the driver.
4. A span classifier (logistic regression over votes and shape) is trained on
   the estimated probabilities, again from an aggregated table, and scored as a
   SQL expression.  It may add loose candidates; base spans always stay.

Patterns are written with possessive loops and start-of-run conditions, which
match the same spans as the plain forms: Java's matcher then neither recurses
per repetition nor rescans a long run from each of its characters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]

# The base patterns.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    # a maximal run of digits, each after at most one separator; 12 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]{{1,63}}+"
             r"(?:\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:[\[(]\.[\])][0-9]{1,3}){3}+(?![0-9.])",
    "card": r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){3}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.@-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}
# Gazetteers and cue words (English, German, French, Spanish).
_ENDINGS = "com|org|net|edu|gov|info|io|co|eu|uk|us|de|fr|es|it|nl|at|ch|be|pt|mx|ar|ca|au|int|biz|example|test"
_CUES = {
    "email": "e-?mail|mail|contact|kontakt|write|schreib|courriel|correo|reach",
    "ip": "ip|address|adresse|server|host|login|logged|dirección|from",
    "card": "card|visa|master|amex|credit|karte|carte|tarjeta|payment|paid|billing",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|anruf|appel|teléfono|llam|contact|kontakt",
}
_AGAINST = "version|isbn|issn|order|invoice|serial|build|release|part no|article|ticket"

#: Working columns, named so that no table has them.
FOUND, SPANS = "_pii_candidates", "_pii_spans"
CONTEXT = 40
MIN_P = 0.5
EM_ROUNDS = 50
FIT_ROUNDS = 400


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    """The check a base match must pass."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(
            "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.call_function("luhn_check", _digits(m))
    return F.length(_digits(m)).between(9, 15)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


#: Lengths that are added up at once; keeps running sums near linear.
SUM_BLOCK = 256


def _sums_by_block(sizes: Column) -> Column:
    """Sum of the entries before each block of SUM_BLOCK."""
    add = lambda arr: F.aggregate(arr, F.lit(0), lambda acc, x: acc + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / SUM_BLOCK).cast("int")),
                         lambda b: add(F.slice(sizes, b * SUM_BLOCK + 1, SUM_BLOCK)))
    return _bound(blocks, lambda q: F.transform(q, lambda _x, b: add(F.slice(q, F.lit(1), b))))


def _matches(text: Column, kind: str, base: bool) -> Column:
    """Array of candidate structs of one pattern.  The pieces between the
    matches (``split``) and the matches themselves alternate, so their running
    lengths give the offsets."""
    pattern = (BASE if base else LOOSE)[kind]

    def one(s, i, m):
        block = F.floor(i / SUM_BLOCK).cast("int")
        before = s["sums"][block] + F.aggregate(F.slice(s["sizes"], block * SUM_BLOCK + 1, i - block * SUM_BLOCK),
                                                F.lit(0), lambda acc, x: acc + x)
        start = before + F.length(s["gaps"][i])
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("rank"), start.alias("start"),
            (start + F.length(m)).alias("end"), m.alias("match"),
            F.right(s["gaps"][i], F.lit(CONTEXT)).alias("before"), F.left(s["gaps"][i + 1], F.lit(1)).alias("after"),
            F.lit(base).alias("checked"), (_valid(kind, m) if base else F.lit(False)).alias("base"))

    def placed(found):
        sized = lambda p: F.struct(p["gaps"].alias("gaps"), F.zip_with(
            F.slice(p["gaps"], F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m)).alias("sizes"))
        summed = lambda p: F.struct(p["gaps"].alias("gaps"), p["sizes"].alias("sizes"), _sums_by_block(p["sizes"]).alias("sums"))
        whole = lambda p: _bound(summed(p), lambda s: F.transform(found, lambda m, i: one(s, i, m)))
        return _bound(F.struct(F.split(text, pattern, -1).alias("gaps")), lambda p: _bound(sized(p), whole))

    # most texts hold none: they skip the second pass over the text
    return _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, placed(found)).otherwise(F.array().cast(CANDIDATES)))


CANDIDATES = ("array<struct<kind:string,rank:int,start:int,end:int,match:string,before:string,after:string,"
              "checked:boolean,base:boolean>>")


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with the array column FOUND.  A null text counts as
    empty and has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn(FOUND, F.concat(*(
        F.coalesce(_matches(text, k, b), F.array().cast(CANDIDATES)) for k in KINDS for b in (True, False))))


def votes(c: Column) -> dict[str, Column]:
    """The labelers: +1 personal data, -1 not, 0 no opinion."""
    kind, m, before = c["kind"], c["match"], F.lower(c["before"])
    digits = _digits(m)

    def by_kind(make):
        col = F.lit(0)
        for k in KINDS:
            col = F.when(kind == k, make(k)).otherwise(col)
        return col

    sign = lambda cond: F.when(cond, 1).otherwise(-1)
    gazetteer = {
        "email": sign(F.lower(m).rlike(rf"(?:{_ENDINGS})$")),
        "ip": sign(~m.rlike(r"^(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-9])[.\[(]")),
        "card": sign(digits.rlike("^(?:4|5[0-9]|2[2-7]|3[0-9]|6)")),
        "phone": sign(digits.rlike("^(?:1?[2-9][0-9]{2}[0-9]{7}|[2-9][0-9]{8,14})$")),
    }
    return {
        "regex": F.when(c["base"], 1).when(c["checked"], -1).otherwise(0),
        "gazetteer": by_kind(lambda k: gazetteer[k]),
        "context": F.when(before.rlike(_AGAINST), -1)
                    .when(by_kind(lambda k: before.rlike(rf"(?:{_CUES[k]})").cast("int")) == 1, 1).otherwise(0),
        "edges": F.when(before.rlike(r"[\p{L}\p{N}]$") | c["after"].rlike(r"[\p{L}\p{N}]"), -1).otherwise(1),
    }


LABELERS = ["regex", "gazetteer", "context", "edges"]


def _features(c: Column) -> dict[str, Column]:
    """Votes as two-sided features plus two of shape, all 0/1."""
    out = {}
    for name, v in votes(c).items():
        out[f"{name}_for"] = (v > 0).cast("int")
        out[f"{name}_against"] = (v < 0).cast("int")
    out["checked"] = c["checked"].cast("int")
    out["grouped"] = c["match"].rlike(r"[\x20().\[/_-]").cast("int")
    return out


FEATURES = [f"{n}_{s}" for n in LABELERS for s in ("for", "against")] + ["checked", "grouped"]


@dataclass
class Model:
    """Per kind: labeler accuracies (EM), the classifier's bias and weights."""
    accuracy: dict[str, dict[str, float]]
    weights: dict[str, list[float]]


def estimate(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[list[float], dict[tuple, float]]:
    """EM for one kind over (votes, count): the accuracy of each labeler and
    the probability of every vote pattern.  A labeler that abstains says
    nothing; a Beta(4, 2) prior keeps accuracies off 0 and 1, and starts each
    labeler as better than chance."""
    acc, prior, post = [0.8] * len(LABELERS), 0.5, {}
    for _ in range(EM_ROUNDS):
        post = {}
        for v, _n in patterns:
            yes, no = math.log(prior), math.log(1 - prior)
            for a, x in zip(acc, v, strict=True):
                if x:
                    yes += math.log(a if x > 0 else 1 - a)
                    no += math.log(1 - a if x > 0 else a)
            post[v] = 1 / (1 + math.exp(min(60.0, max(-60.0, no - yes))))
        total = sum(n for _, n in patterns)
        prior = (1 + sum(n * post[v] for v, n in patterns)) / (2 + total)
        for j in range(len(acc)):
            right = sum(n * (post[v] if v[j] > 0 else 1 - post[v]) for v, n in patterns if v[j])
            acc[j] = (3 + right) / (4 + sum(n for v, n in patterns if v[j]) + 0.5)
    return acc, post


def _train(rows: list[tuple[tuple[int, ...], float, int]]) -> list[float]:
    """Weighted logistic regression by gradient steps on (features, target
    probability, count)."""
    total = sum(n for _, _, n in rows)
    w = [0.0] * (len(FEATURES) + 1)
    for _ in range(FIT_ROUNDS):
        grad = [0.0] * len(w)
        for x, target, n in rows:
            p = 1 / (1 + math.exp(-(w[0] + sum(a * b for a, b in zip(w[1:], x, strict=True)))))
            e = (p - target) * n / total
            grad[0] += e
            for i, b in enumerate(x):
                grad[i + 1] += e * b
        w = [a - 1.0 * (g + 1e-3 * a) for a, g in zip(w, grad, strict=True)]
    return w


def fit(cands: DataFrame) -> Model:
    """Labeler reliabilities and classifier from all candidates.  What reaches
    the driver has at most ``4 * 3**4 * 4`` rows, whatever the input."""
    each = cands.select(F.explode(FOUND).alias("c"))
    v, f = votes(F.col("c")), _features(F.col("c"))
    cols = [F.col("c.kind").alias("kind")] + [v[n].alias(f"v_{n}") for n in LABELERS] + [
        f[n].alias(f"f_{n}") for n in FEATURES]
    rows = each.select(*cols).groupBy("kind", *[f"v_{n}" for n in LABELERS],
                                      *[f"f_{n}" for n in FEATURES]).count().collect()
    rows.sort(key=lambda r: tuple(r))  # the same sums in the same order each run
    model = Model({}, {})
    for kind in KINDS:
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        counts: dict[tuple, int] = {}
        for r in own:
            key = tuple(r[f"v_{n}"] for n in LABELERS)
            counts[key] = counts.get(key, 0) + r["count"]
        acc, post = estimate(sorted(counts.items()))
        model.accuracy[kind] = dict(zip(LABELERS, acc, strict=True))
        model.weights[kind] = _train([
            (tuple(r[f"f_{n}"] for n in FEATURES), post[tuple(r[f"v_{n}"] for n in LABELERS)], r["count"])
            for r in own])
    return model


def score(c: Column, model: Model) -> Column:
    """The classifier's probability for a candidate, as a SQL expression."""
    f, out = _features(c), F.lit(0.0)
    for kind, w in model.weights.items():
        z = F.lit(w[0])
        for weight, name in zip(w[1:], FEATURES, strict=True):
            z = z + F.lit(weight) * f[name]
        out = F.when(c["kind"] == kind, F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).otherwise(out)
    return out


def _label(arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def decide(cands: DataFrame, model: Model) -> DataFrame:
    """Replaces FOUND by SPANS: base spans, plus loose candidates
    that the classifier accepts and that overlap no base span, by start and
    then kind as listed in KINDS.  A base match that failed its check is
    evidence for the labelers and never a span."""
    base = F.filter(FOUND, lambda c: c["base"])
    loose = F.filter(FOUND, lambda c: ~c["checked"] & (score(c, model) >= MIN_P))
    added = F.filter(loose, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    spans = F.sort_array(F.transform(F.concat(base, added), lambda c: F.struct(
        c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind"),
        c["base"].alias("base"))))
    return cands.withColumn(SPANS, spans).drop(FOUND)


def report(decided: DataFrame) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans and
    all spans as text."""
    of = lambda k: F.size(F.filter(SPANS, lambda s: s["kind"] == k)).cast("long")
    return decided.select(
        "doc_id", *(of(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(_label(F.filter(SPANS, lambda s: s["base"])), 256).alias("base_sha256"),
        _label(F.col(SPANS)).alias("spans"))


def redact(decided: DataFrame) -> DataFrame:
    """Replaces SPANS by taking effect: every span of ``text`` becomes its
    kind in brackets.  Overlapping spans count as one stretch, named after the
    first."""
    text = F.col("text")
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["pos"] + 1, F.greatest(s["start"] - acc["pos"], F.lit(0)))
        mark = F.when(s["start"] < acc["pos"], "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.concat(acc["out"], gap, mark).alias("out"))

    clean = F.aggregate(SPANS, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    return decided.withColumn("text", F.when(F.size(SPANS) > 0, clean).otherwise(text)).drop(SPANS)


def find_pii(docs: DataFrame, store) -> DataFrame:
    """Report over all rows of ``docs(doc_id, text)``; ``store`` keeps the
    candidates (no texts) between the two passes.

    Null and empty texts have no span.  Repeated rows give repeated results.
    An empty table gives an empty result.  Other columns are ignored.
    """
    cands = store(candidates(docs.select("doc_id", "text")).select("doc_id", FOUND), "pii")
    return report(decide(cands, fit(cands)))
