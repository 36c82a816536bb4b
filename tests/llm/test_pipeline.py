import sys
from pathlib import Path

import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tests.llm import test_ngram_join, test_pii, test_toxicity  # noqa: E402


def test_stages_equal_brute_force(spark, tmp_path):
    texts, toxic = test_toxicity.corpus(400)
    near = [t + " extra" for t in texts[:40]]
    copies = [t.replace(" ", "  ", 3) for t in texts[40:80]]
    personal = [f"write to a{i}@b.org or +1 (456) 555-{2000 + i} today {'ta ri so ne ' * i}" for i in range(20)]
    rows = [*texts, *near, *copies, *personal, None, "", " "]
    docs = pd.DataFrame({"doc_id": range(len(rows)), "text": rows, "lang": "en", "source": "s",
                         "n_chars": [len(t or "") for t in rows]})
    docs.to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame({"doc_id": range(400), "quality": 1, "toxic": toxic}).to_parquet(tmp_path / "labels.parquet")

    frames, df = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / f"out-{name}")
        stage(spark, df, str(tmp_path)).write.parquet(path)
        df = spark.read.parquet(path)
        frames.append(df.toPandas())
    clean, exact, one, redacted, packed = frames
    assert all(list(f.columns) == list(docs.columns) for f in frames[:4])

    text = dict(zip(docs.doc_id, rows, strict=True))
    gone = set(docs.doc_id) - set(clean.doc_id)
    bad = {i for i, t in text.items() if any(w in (t or "") for w in test_toxicity.BAD)}
    assert len(bad - gone) <= 0.05 * len(bad) and len(gone - bad) <= 2

    first = {}
    for i in sorted(clean.doc_id):
        first.setdefault(" ".join((text[i] or "").split()) if (text[i] or "").strip() else bool(text[i]), i)
    assert set(exact.doc_id) == set(first.values())
    comp = test_ngram_join.brute([(i, text[i]) for i in exact.doc_id])
    assert set(one.doc_id) == {i for i, (_, c) in comp.items() if i == c}

    for r in redacted.itertuples():
        t, out = text[r.doc_id], []
        if t is None:
            assert r.text is None
            continue
        at = 0
        for kind, start, end in test_pii.brute(t):
            out += [t[at:start], f"[{kind.upper()}]"]
            at = end
        assert r.text == "".join(out) + t[at:] and r.n_chars == len(r.text)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in redacted.itertuples()}
    assert packed.groupby("doc_id").length.sum().to_dict() == want
    assert packed.groupby("sequence_id").length.sum().max() <= 1024


def test_dedup_of_repeated_ids_and_rows_without_one(spark):
    words = lambda c: " ".join(f"{c}{i}" for i in range(30))
    equal, near = words("a"), words("b")
    rows = [(2, equal), (1, equal), (1, equal), (1, equal.replace(" ", "  ", 2)), (2, words("c")), (1, words("d")),
            (None, equal), (None, words("e")), (None, words("e")), (5, near + " x"), (3, near), (3, near + " y"),
            (5, words("f")), (None, near + " z"), (None, words("g") + " x"), (None, words("g"))]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string").repartition(4)
    exact = corpus_pipeline.drop_exact_copies(spark, df, "")
    assert exact.columns == df.columns
    got = sorted((r.doc_id or 0, r.text) for r in exact.collect())
    plain = [(r[0] or 0, " ".join(r[1].split())) for r in rows]
    want = {(i, t) for i, t in plain if not (t == equal and i != 1)}
    assert sorted((i, " ".join(t.split())) for i, t in got) == sorted(want)
    one = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.drop_near_copies(spark, exact, "").collect())
    ids = [(i, t[0]) for i, t in one]
    assert sorted(ids) == [(0, "e"), (0, "g"), (1, "a"), (1, "d"), (2, "c"), (3, "b"), (5, "f")]


def test_columns_of_the_input_that_stages_use_for_themselves_stay(spark):
    rows = [(1, "one two three four five six", "d1", 7, "k1"), (2, "one two  three four five six", "d2", 8, "k2"),
            (2, "other words of another text here", "d3", 9, "k3"), (3, "other words of another text here", "d4", 10, "k4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, row_id long, row_key string")
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies):
        got = {tuple(r) for r in stage(spark, docs, "").collect()}
        assert got <= set(rows) and {r[0] for r in got} >= {1}
    assert {tuple(r) for r in corpus_pipeline.drop_exact_copies(spark, docs, "").collect()} == {rows[0], rows[2]}
