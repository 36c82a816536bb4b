import time
import hashlib
import random
import re

from lastcol.llm import pii
from lastcol.llm.common import stored

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    total = 0
    for i, d in enumerate(reversed(s)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"\D", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return [(k, s, e) for s, _, e, k in sorted(out)]


EDGE = [
    None, "", "no data", "é" * 50 + " a.b@c-d.org x", "a@b.c_d@e.f", "a@b@c.de", "x@y.z.", "@a.b", "a@b..c",
    "1.2.3.4.5.6.7.8", "1.2.3.4", "256.1.1.1 and 0001.02.3.255", "1.2.3", "4111 1111 1111 1111",
    "4111-1111-1111-1111 4111111111111111", "41111111111111112", "4111  1111 1111 1111", "12345678901234567890123",
    "+1 (456) 555-2186", "+49 (0) 30 1234567", "+12", "+1((((((", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "1-" * 3000 + "1", "9" * 9000, ".a" * 9000, "a@" + "b." * 9000 + "c", "a" * 9000, "1." * 9000,
    "tel +1 (456) 555-2186, mail a@b.com, ip 10.0.0.1", "\U0001F600 a@b.co \U0001F600 10.0.0.1",
    "+1 4111111111111111 2", "4111111111111111.1.1.1", "a@1.2.3.4", "0" * 12, "00 00 00 00 00 00 -0",
]


def texts():
    rng = random.Random(5)
    alphabet = "0123456789" * 3 + "..--  ()++@ab%_\né"
    return EDGE + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 200))) for _ in range(1500)]


def test_base_spans_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, candidates string")
    got = {r.doc_id: r for r in pii.find_pii(df, stored).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = brute(t)
        label = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[i].base_sha256 == hashlib.sha256(label.encode()).hexdigest(), (t, label, got[i].spans)
        assert set(filter(None, label.split(","))) <= set(filter(None, got[i].spans.split(",")))
        listed = [x.split(":")[0] for x in got[i].spans.split(",") if x]
        for k in pii.KINDS:
            assert getattr(got[i], f"n_{k}") == listed.count(k)


def test_added_spans_need_agreeing_labelers(spark):
    good = [f"call my phone ({200 + i}) 555-{1000 + i} now, mail ann{i} [at] host{i} [dot] com" for i in range(60)]
    base = [f"phone +1 (456) 555-{1000 + i}, e-mail a{i}@b.com" for i in range(200)]
    bad = [f"order 555 123 {4000 + i}x9" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(good + base + bad)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(df, stored).collect()}
    assert all(got[i].n_phone == 1 and got[i].n_email == 1 for i in range(60))
    assert all(got[i].spans == "" for i in range(260, 320))


def test_estimate_ranks_labelers():
    acc, post = pii.estimate([((1, 1, 1, 1), 900), ((1, -1, 0, 1), 50), ((-1, -1, -1, -1), 300), ((-1, 1, 0, -1), 60)])
    assert acc[0] > acc[1]
    assert post[(1, 1, 1, 1)] > 0.95 and post[(-1, -1, -1, -1)] < 0.05


def test_redact(spark):
    df = spark.createDataFrame([(1, "é a@b.co, +1 (456) 555-2186!"), (2, None), (3, "plain"), (4, "")],
                               "doc_id long, text string")
    cands = pii.candidates(df)
    out = {r.doc_id: r.text for r in pii.redact(pii.decide(cands, pii.fit(cands))).collect()}
    assert out == {1: "é [EMAIL], [PHONE]!", 2: None, 3: "plain", 4: ""}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(df, stored).count() == 0


def test_no_python_on_the_executors(spark):
    df = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    plan = pii.report(pii.decide(pii.candidates(df), pii.fit(pii.candidates(df))))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_many_matches_in_one_text_take_time_in_proportion(spark):
    n = 100_000
    texts = [" ".join(f"é user{i}@ex{i}.org" for i in range(n)), "a@b.c", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    rows = {r.doc_id: r for r in pii.report(pii.decide(pii.candidates(df), pii.Model({}, {}))).collect()}
    assert time.time() - began < 60
    assert rows[0].n_email == n and rows[1].n_email == 1 and rows[3].n_email == 0
    spans = [tuple(map(int, x.split(":")[1:])) for x in rows[0].spans.split(",")]
    assert [texts[0][a:b] for a, b in spans] == [f"user{i}@ex{i}.org" for i in range(n)]
