import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from lastcol.llm import conversation_repair as cr

BLANK = "\x20\t\n\x0b\x0c\r"
PATTERN = re.compile(r"(s?(ua)+)?")


def sp(x):
    return " " if x is None else str(x)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def edits(rows):
    """Least (cost, audit, lines) by trying every sequence of edits up to the
    cheapest cost, breadth first; no states, no merging but of equal outputs."""
    best = {("", 0): (0, "", ())}
    for i in range(len(rows) + 1):
        todo = list(best.items())
        while todo:  # insertions before row i
            (out, _), (cost, audit, lines) = todo.pop()
            for c, role in (("u", "user"), ("a", "assistant")):
                if PATTERN.fullmatch(out + c) or PATTERN.fullmatch(out + c + "a"):
                    key, val = (out + c, 0), (cost + 2, audit + "I", lines + (f"{role}:",))
                    if val[0] <= 3 * len(rows) + 4 and (key not in best or val[:2] < best[key][:2]):
                        best[key] = val
                        todo.append((key, val))
        if i == len(rows):
            break
        role, text, fault = rows[i]
        nxt = {}

        def add(out, val, nxt=nxt):
            if (out, 0) not in nxt or val[:2] < nxt[out, 0][:2]:
                nxt[out, 0] = val
        extra = fault == "t"
        for (out, _), (cost, audit, lines) in best.items():
            add(out, (cost + 3, audit + "D", lines))
            if fault not in ("b", "d"):
                for c, name, price, edit in ((role[:1], role, 0, "K"), ("u", "user", 2, "R"), ("a", "assistant", 2, "R")):
                    if c and any(PATTERN.fullmatch(out + c + more) for more in ("", "a", "ua")):
                        add(out + c, (cost + price + extra, audit + edit, lines + (f"{name}:{text}",)))
        best = nxt
    return min(v for (out, _), v in best.items() if PATTERN.fullmatch(out))


def brute(original):
    out = {}
    for conv in {r[0] for r in original}:
        rows = sorted((r for r in damaged(original) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        marked, seen, counts = [], set(), dict.fromkeys("bdt", 0)
        for _, _, role, text in rows:
            t = text.rstrip(BLANK)
            fault = "b" if not t else "d" if (role, text) in seen else "t" if t[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault))
        turns = [r[1] for r in rows if r[1] is not None]
        cost, audit, lines = edits(marked) if rows else (0, "", ())
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["b"], counts["d"], counts["t"],
                     illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def report(spark, rows):
    got = cr.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}


def conversations(seed, n, longest, convs=None):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut off", "ends. \n\t", "", " \x0b", None, "é.", "a\x00b."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for c in convs or [*range(n), None]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(roles) if rng.random() < .4 else roles[turn % 2]
            t = rng.choice([turn, turn, turn, turn + 3, None, turn // 2])
            text = rng.choice(texts) if rng.random() < .5 else f"word {turn} {rng.random()}."
            rows += [(c, t, role, text)] * (2 if rng.random() < .1 else 1)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = conversations(seed, 60, 9)
    assert report(spark, rows) == brute(rows)


def test_long_conversation_over_many_slices_and_segments(spark, monkeypatch):
    monkeypatch.setattr(cr, "SEGMENT", 7)
    rows = conversations(3, 0, 400, convs=[5]) + conversations(4, 10, 6) + conversations(5, 0, 60, convs=[7, 8])
    assert report(spark, rows) == {**brute(rows)}


def test_no_rows_nulls_and_clashing_columns(spark):
    assert report(spark, []) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert report(spark, [(gone, 0, "user", "hi.")])[gone] == nothing
    rows = conversations(6, 5, 5)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as nil", "2 as cid", "'x' as audit", "3 as _at", "4 as _pid", "5 as kind")
    assert {r.conv_id: r.audit for r in cr.repair_report(df).collect()} == {c: v[6] for c, v in brute(rows).items()}


def test_least_edits_by_hand():
    k = lambda roles: [(r, False, False) for r in roles]
    assert cr.repair_roles([]) == (0, "")
    assert cr.repair_roles(k("sua")) == (0, "KKK")
    assert cr.repair_roles(k("s")) == (3, "D")
    assert cr.repair_roles(k("u")) == (2, "KI")
    assert cr.repair_roles(k("a")) == (2, "IK")
    assert cr.repair_roles(k("uaua" * 3)) == (0, "K" * 12)
    assert cr.repair_roles(k("uu")) == (2, "KR")
    assert cr.repair_roles(k("us")) == (2, "KR")
    assert cr.repair_roles([("u", True, False)]) == (3, "D")  # KI costs as much
    assert cr.repair_roles([("u", False, True), ("a", False, False)]) == (5, "DIK")


def test_stacks_stay_few_and_every_role_pattern_is_judged_right():
    parser = cr.Parser()
    assert len(parser.under_way()) <= 12
    for roles, _ in groupby(sorted("".join(random.Random(i).choices("suax", k=i % 7)) for i in range(200))):
        legal = bool(PATTERN.fullmatch(roles))
        assert (cr.repair_roles([(c, False, False) for c in roles])[0] == 0) == legal
