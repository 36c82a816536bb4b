"""URL filters: fixed rules first, then association rules that FP-growth mines.

A url is a set of tokens: scheme, host labels, path segments, query keys, extension.
From labelled urls Spark's FP-growth mines token combinations that go with one
verdict.  Rules below a support or a confidence go, and so does a rule that
says no more than one with fewer tokens.  What is left is an inverted index:
a rule stands under its rarest token, a url looks up its own tokens and takes the best
rule that it holds whole.  Urls of equal tokens are judged once.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, stored

#: Verdict, host and path of the given rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
#: A mined rule's least share of the labelled urls, and least number of them.
MIN_SUPPORT = 0.01
MIN_URLS = 5
MIN_CONFIDENCE = 0.9
#: Tokens of a rule.
RULE_TOKENS = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, and nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host`` and ``path`` of ``url`` (both empty if it is null or has no
    ``://``), and ``rest``, what follows the first ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    return (pages.withColumn("rest", F.coalesce(rest, F.lit("")))
            .withColumn("host", lowered(F.regexp_extract("rest", "^[^/?#]*", 0)))
            .withColumn("path", F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1)))


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits ``host`` and ``path``; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text, verdict = F.when(fits, host + path).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def tokens(url: str = "url") -> Column:
    """Sorted distinct tokens of a row with ``url, host, path, rest``: every label of
    the host, segment of the path and key of the query."""
    labels = F.filter(F.split("host", r"\."), lambda x: x != "")
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    query = F.regexp_extract("rest", r"^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)
    return F.array_sort(F.array_distinct(F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0"))),
        F.transform(F.filter(segments, lambda x: x.rlike("^[0-9]")), lambda x: F.concat(F.lit("d:"), F.left(x, F.lit(1)))),
        F.transform(keys, lambda x: F.concat(F.lit("q:"), x)),
        F.when(ending != "", F.array(F.concat(F.lit("x:"), lowered(ending)))).otherwise(F.array().cast("array<string>")),
        F.when(F.instr("rest", "#") > 0, F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>")),
        F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 1, F.array(F.concat(F.lit("s:"), lowered(
            F.substring_index(url, "://", 1))))).otherwise(F.array().cast("array<string>")))))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               rule_tokens: int = RULE_TOKENS) -> DataFrame:
    """``(ante, verdict, confidence, support, n_tokens)`` from ``labelled(tokens,
    verdict)``: token combinations of at most ``rule_tokens`` that go with a verdict."""
    schema = "ante array<string>, verdict string, confidence double, support double, n_tokens int"
    marked = labelled.filter("verdict is not null").select(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    marked = stored(marked, "labelled")
    n = marked.count()
    if not n:
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, MIN_URLS / n)), minConfidence=min_confidence).fit(marked)
    found = model.associationRules.filter(F.col("consequent")[0].startswith("=")).select(
        F.array_sort("antecedent").alias("ante"), F.expr("substring(consequent[0], 2)").alias("verdict"), "confidence", "support",
        F.size("antecedent").alias("n_tokens")).filter(F.col("n_tokens") <= rule_tokens)
    found = stored(found, "rules")
    # a rule goes if one with fewer of its tokens is as sure
    parts = F.expr("transform(sequence(1, cast(pow(2, n_tokens) as int) - 2), m -> filter(ante, (x, i) -> shiftright(m, i) % 2 = 1))")
    part = found.filter("n_tokens > 1").select("ante", "verdict", F.explode(parts).alias("part"), "confidence")
    held = (part.join(found.select(F.col("ante").alias("part"), "verdict", F.col("confidence").alias("c")), ["part", "verdict"])
            .filter("c >= confidence").select("ante", "verdict").distinct())
    return stored(found.join(held, ["ante", "verdict"], "left_anti").select(*[c.split()[0] for c in schema.split(", ")]), "pruned")


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``(tokens, mined)`` for the distinct token sets ``sets(tokens)`` that hold a
    rule whole: the verdict of the surest (then the best supported, the shortest, block,
    the first by name)."""
    few = rules.count() <= BROADCAST_IDS  # rows of at most RULE_TOKENS tokens
    small = F.broadcast if few else (lambda x: x)
    per_token = rules.select(F.explode("ante").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rarest = (rules.withColumn("token", F.explode("ante")).join(small(per_token), "token")
              .groupBy("ante", "verdict", "confidence", "support", "n_tokens").agg(F.min_by("token", F.struct("n", "token")).alias("token")))
    index = stored(rarest, "index")
    order = F.struct(-F.col("confidence"), -F.col("support"), "n_tokens", (F.col("verdict") != "block").alias("mild"),
                     F.array_join("ante", " ").alias("name"), "verdict")
    hits = (sets.select("tokens", F.explode("tokens").alias("token")).join(small(index), "token")
            .filter(F.size(F.array_except("ante", "tokens")) == 0))
    return hits.groupBy("tokens").agg(F.min(order).alias("best")).select("tokens", F.col("best.verdict").alias("mined"))


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    The longest fixed rule that fits decides; else the best mined rule, else
    ``allow``.  ``labelled(url, verdict)`` are the urls to learn from; without
    it, the urls that fixed rules decide.  A null url or one without ``://`` has an
    empty host and path, and no token but its own text's; rows stay as they are, repeated
    ones and those without an id too; other columns are ignored.  With nothing to
    learn from no rule is mined.
    """
    text, verdict = rule_columns(rules)
    rows = with_parts(pages.select("page_id", "url")).select(
        "page_id", "host", "path", text.alias("rule"), verdict.alias("fixed"), tokens().alias("tokens"))
    if labelled is None:
        known = rows.select("tokens", F.col("fixed").alias("verdict"))
    else:
        known = with_parts(labelled.select("url", "verdict")).select(tokens().alias("tokens"), "verdict")
    mined = match_rules(rows.filter("fixed is null").select("tokens").distinct(), mine_rules(known))
    return rows.join(mined, "tokens", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", "mined", F.lit(DEFAULT)).alias("verdict"))


def _sql_tokens(rows: str) -> str:
    return rf"""
    SELECT *, list_sort(list_distinct(flatten([
      list_transform(labels, lambda x: 'h:' || x),
      list_transform(segs, lambda x: 'p:' || regexp_replace(x, '[0-9]+', '0', 'g')),
      list_transform(list_filter(segs, lambda x: regexp_matches(x, '^[0-9]')), lambda x: 'd:' || x[1]),
      list_transform(keys, lambda x: 'q:' || x),
      CASE WHEN ending <> '' THEN ['x:' || lower(ending)] ELSE [] END,
      CASE WHEN contains(rest, '#') THEN ['f:'] ELSE [] END,
      CASE WHEN coalesce(instr(url, '://'), 0) > 1 THEN ['s:' || lower(split_part(url, '://', 1))] ELSE [] END]))) AS tokens
    FROM (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels,
            list_filter(string_split(path, '/'), lambda x: x <> '') AS segs,
            list_sort(list_distinct(list_filter(list_transform(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
              lambda x: split_part(x, '=', 1)), lambda x: x <> ''))) AS keys,
            regexp_extract(path, '\.([A-Za-z0-9]+)$', 1) AS ending FROM ({rows}))"""


#: The same in DuckDB: every combination of up to three tokens is counted.
ORACLE = rf"""
  WITH u AS (SELECT page_id, url, row_number() OVER () AS id,
               CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
  t AS ({_sql_tokens("SELECT * FROM h")}),
  f AS (SELECT *, '.' || host AS dotted FROM t),
  r AS (SELECT *, CASE WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                       WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                       WHEN ends_with(dotted, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                       WHEN ends_with(dotted, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
                       WHEN ends_with(dotted, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM f),
  v AS (SELECT *, CASE WHEN rule IN ('com/fr/', 'org/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS fixed FROM r),
  n AS (SELECT count(*) AS n, ceil(least(1.0, greatest({MIN_SUPPORT}, {MIN_URLS} / count(*))) * count(*)) AS least FROM v WHERE fixed IS NOT NULL),
  x AS (SELECT id, fixed, unnest(tokens) AS tok FROM v WHERE fixed IS NOT NULL),
  c AS (SELECT id, fixed, [tok] AS ante FROM x
        UNION ALL SELECT a.id, a.fixed, [a.tok, b.tok] FROM x a JOIN x b ON a.id = b.id AND a.tok < b.tok
        UNION ALL SELECT a.id, a.fixed, [a.tok, b.tok, d.tok] FROM x a JOIN x b ON a.id = b.id AND a.tok < b.tok
                         JOIN x d ON d.id = a.id AND b.tok < d.tok),
  s AS (SELECT ante, fixed, count(*) AS k, CAST(sum(count(*)) OVER (PARTITION BY ante) AS BIGINT) AS m FROM c GROUP BY ante, fixed),
  g AS (SELECT ante, fixed, CAST(k AS DOUBLE) / m AS conf, CAST(k AS DOUBLE) / n AS sup FROM s, n WHERE k >= least AND CAST(k AS DOUBLE) / m >= {MIN_CONFIDENCE}),
  p AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM g o WHERE o.fixed = g.fixed AND o.conf >= g.conf AND len(o.ante) < len(g.ante)
                                          AND list_has_all(g.ante, o.ante))),
  w AS (SELECT v.id, p.fixed AS mined FROM v JOIN p ON list_has_all(v.tokens, p.ante) WHERE v.fixed IS NULL
        QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY conf DESC, sup DESC, len(ante), p.fixed <> 'block', array_to_string(ante, ' ')) = 1)
  SELECT page_id, host, path, rule, coalesce(fixed, mined, '{DEFAULT}') AS verdict FROM v LEFT JOIN w USING (id)"""
