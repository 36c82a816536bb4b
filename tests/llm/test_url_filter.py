import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest

from lastcol.llm import url_filter as uf


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return low(host), re.match(r"[^?#]*", rest[len(host):])[0], rest


def toks(url):
    host, path, rest = parts(url)
    segs = [s for s in path.split("/") if s][:3]
    out = {"h:" + x for x in [x for x in host.split(".") if x][-5:]}
    out |= {"p:" + re.sub("[0-9]+", "0", s) for s in segs} | {"d:" + s[0] for s in segs if s[0] in "0123456789"}
    query = re.match(r"[^?#]*\?([^#]*)", rest)
    out |= {"q:" + k for k in sorted({k.split("=")[0] for k in (query[1] if query else "").split("&")} - {""})[:3]}
    if end := re.search(r"\.([A-Za-z0-9]+)$", path):
        out.add("x:" + low(end[1]))
    if "#" in rest:
        out.add("f:")
    if url and url.find("://") > 0:
        out.add("s:" + low(url.split("://")[0]))
    return frozenset(out)


def fixed(url):
    host, path, _ = parts(url)
    best = max(((len(h + p), h + p, v) for v, h, p in uf.RULES if ("." + host).endswith("." + h) and path.startswith(p)), default=None)
    return best[1:] if best else (None, None)


def brute(urls, labelled):
    n, f, g = len(labelled), Counter(), Counter()
    for url, verdict in labelled:
        for k in (1, 2, 3):
            for c in combinations(sorted(toks(url)), k):
                f[c] += 1
                g[c, verdict] += 1
    least = math.ceil(min(1.0, max(uf.MIN_SUPPORT, uf.MIN_URLS / n)) * n) if n else 0
    rules = {(c, v): (k / f[c], k / n) for (c, v), k in g.items() if k >= least and k / f[c] >= uf.MIN_CONFIDENCE}
    rules = {(c, v): s for (c, v), s in rules.items() if not any(
        rules.get((p, v), (0,))[0] >= s[0] for k in range(1, len(c)) for p in combinations(c, k))}
    out = []
    for url in urls:
        rule, verdict = fixed(url)
        if verdict is None:
            fits = [(-conf, -sup, len(c), v != "block", " ".join(c), v) for (c, v), (conf, sup) in rules.items() if set(c) <= toks(url)]
            verdict = min(fits)[-1] if fits else "allow"
        out.append((*parts(url)[:2], rule, verdict))
    return out


ODD = [None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.ORG", "http://example.org/es/", "http://xexample.org/es/1",
       "https://a.example.org/en/1", "http://example.org/en/2", "http://com/fr/", "http://ÄB.Com/de/x?y=1#z", "ftp://com?x/fr/",
       "http://a.com#/de/", "http://x.net/a//b/c/d/e.HTML", "http://.../..", "a://b://c/d", "http://x.net/" + "seg/" * 5000,
       "http://" + "l." * 3000 + "com/de/1", "http://x.net/?" + "&".join(f"k{i}=1" for i in range(3000))]


def urls(seed, n=250):
    rng = random.Random(seed)
    return ODD + [f"{rng.choice(['http', 'https'])}://{rng.choice(['m.', 'blog.', ''])}{rng.choice(['spam', 'news', 'shop', 'Ads'])}."
                  f"{rng.choice(['example.', ''])}{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(1, 300)}"
                  f"{rng.choice(['', '/', '.html', '?page=2&ref=x', '#top'])}" for _ in range(n)]


def judged(spark, rows, **more):
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    return [tuple(r)[1:] for r in sorted(uf.judge(df, **more).collect())]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_learning_from_the_fixed_rules(spark, seed):
    rows = urls(seed)
    known = [(u, fixed(u)[1]) for u in rows if fixed(u)[1]]
    got = judged(spark, rows)
    assert got == brute(rows, known)
    assert {v for _, _, rule, v in got if rule is None} == {"allow", "block"}  # mined rules block some


def test_learns_from_given_labels(spark):
    rows = urls(3)
    known = [(u, "block" if "spam" in u else "allow") for u in urls(4)[len(ODD):]]
    df = spark.createDataFrame(known, "url string, verdict string")
    got = judged(spark, rows, labelled=df)
    assert got == brute(rows, known)
    assert all(v == "block" for (_, _, rule, v), u in zip(got, rows, strict=True) if rule is None and u and "//spam." in u)


def test_shuffled_join_finds_the_same(spark, monkeypatch):
    rows = urls(5, 80)
    monkeypatch.setattr(uf, "BROADCAST_IDS", 0)
    assert judged(spark, rows) == brute(rows, [(u, fixed(u)[1]) for u in rows if fixed(u)[1]])


def test_nothing_to_learn_repeats_nulls_and_clashing_columns(spark):
    assert judged(spark, []) == []
    assert judged(spark, ["http://x.net/es/1", None]) == [("x.net", "/es/1", None, "allow"), ("", "", None, "allow")]
    df = spark.createDataFrame([(None, "http://a.org/", "h", "t", "r"), (1, "http://a.org/", "h", "t", "r")] * 2,
                               "page_id long, url string, host string, tokens string, rest string")
    assert sorted(map(str, uf.judge(df).collect())) == sorted(map(str, uf.judge(df.select("page_id", "url")).collect()))
    assert uf.judge(df).count() == 4


@pytest.mark.parametrize("mark", ["http://x{}.a.b.c.d.e.net/z", "http://a.net/q/r/s/t/x{}", "http://a.net/z?a=1&b=1&c=1&d=1&x{}=1"])
def test_far_parts_of_a_url_count(spark, mark):
    known = [(mark.format("bad") + f"#{i}", "block") for i in range(10)] + [(mark.format("good") + f"#{i}", "allow") for i in range(10)]
    df = spark.createDataFrame(known, "url string, verdict string")
    got = judged(spark, [mark.format("bad"), mark.format("good")], labelled=df)
    assert [v for _, _, _, v in got] == ["block", "allow"]
