import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from lastcol.llm import bpe

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.rank_file(MULTI),
                             special_tokens={})


def long_texts():
    rng = random.Random(3)
    step = bpe.CHUNK
    words = ["the", "'ll", "don't", "  ", "\n\n", " ", "été", "12345", "!?", "\U0001F600", "ß", "漢字", "\t", "we're"]
    out = ["".join(rng.choice(words) + rng.choice(["", " ", " ", "   "]) for _ in range(n)) for n in (9000, 20000, 40000)]
    for around in ["'ll", "   x", "\n \n  y", "'", " 're"]:  # at and near every cut
        for shift in range(-4, 3):
            body = list("ab cd " * (step // 2))
            for cut in (step, 2 * step, step + bpe.OVERLAP, 2 * step + bpe.OVERLAP):
                body[cut + shift:cut + shift + len(around)] = around
            out.append("".join(body))
    out += ["a" * (3 * step), " " * (3 * step), "x " + "b" * (2 * step) + " y", "1" * (step + bpe.OVERLAP + 1),
            ("ab " * 40_000) + "z" * 2000 + (" cd" * 9000)]
    return out


def test_same_ids_as_the_library_and_round_trip(spark, library):
    texts = [None, "", " ", "a", "it's  so", "<|endoftext|>", "a" * 300, *long_texts()]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(df, MULTI), MULTI).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(want)
        assert bytes(got[i].ids) == b"".join(x.to_bytes(4, "little") for x in want), repr((t or "")[:80])
        assert bytes(got[i].bytes) == (t or "").encode()


def test_most_long_texts_are_stitched():
    pattern = bpe.Encoder(bpe.rank_file(MULTI)).pattern
    text = "some words here " * 4000
    _, tail = bpe._boundaries(pattern, text[:bpe.CHUNK + bpe.OVERLAP], False)
    head, _ = bpe._boundaries(pattern, text[bpe.CHUNK:], True)
    assert set(head) & set(tail)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "x"), (2, "y z " * 9000), (2, "y z " * 9000)],
                               "doc_id long, text string")
    rows = bpe.encode(df, MULTI).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 1, 2, 2]
    assert len({bytes(r.ids) for r in rows if r.doc_id == 2}) == 1
    assert bpe.encode_report(df.limit(0), MULTI).count() == 0


def test_json_vocabulary_gives_the_library_ids():
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    enc = bpe.Encoder(bpe.json_ranks(JSON))
    import numpy as np
    for t in ["", "Hello  world's\n\n été ß 漢字 \U0001F600 1234", "<|endoftext|> x", *long_texts()[:2]]:
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
