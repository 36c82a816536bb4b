"""Conversation structure repair by a generalised LR parse with edits.

The roles of a conversation, by initial, must read ``(s?(ua)+)?``: nothing, or
an optional system turn and then user and assistant in turn.  A parser for a
grammar of that language keeps all its stacks at once in a graph-structured
stack: a node is a state on top of another node, and equal nodes are one, shared by
all stacks that go through it.  For every row each stack top may keep it
(shift its role), rerole it (shift another), delete it (stay), and before that insert
rows (shift without reading).  Every top carries its least ``(cost, audit)``;
where two ways lead to equal tops the lesser one stays.  The audit spells the
edits in order, so equal costs are decided by it.

Rows are ordered once over all conversations and cut into slices and segments
of bounded length, so a conversation may span many tasks.  A segment is parsed
from every stack that can be under way where it begins; its table (stack before,
stack behind, cost, audit) is joined with its neighbour's until a conversation
has one.  Where ties are broken by audits that are stretches over the same rows,
a least whole is made of least parts.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastcol.plans.segments import sliced

from .common import stored

#: The prices of edits, and their initials in the audit.
RULES = (("C", ()), ("C", ("s", "P")), ("C", ("P",)), ("P", ("u", "a")), ("P", ("P", "u", "a")))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
#: Rows of a segment.
SEGMENT = 512
_SPACE = "\x20\t\n\x0b\x0c\r"


class Grammar:
    """The LR(0) automaton of ``rules``; the first rule's left side is the start."""

    def __init__(self, rules=RULES):
        self.rules, self.start = rules, rules[0][0]
        names = {left for left, _ in rules}
        first = self._closure({(r, 0) for r, (left, _) in enumerate(rules) if left == self.start}, names)
        states, self.goto = [first], []
        for items in states:  # grows
            moves: dict[str, set] = {}
            for r, dot in items:
                if dot < len(rules[r][1]):
                    moves.setdefault(rules[r][1][dot], set()).add((r, dot + 1))
            self.goto.append({})
            for symbol in sorted(moves):
                nxt = self._closure(moves[symbol], names)
                if nxt not in states:
                    states.append(nxt)
                self.goto[-1][symbol] = states.index(nxt)
        done = [[rules[r] for r, dot in sorted(items) if dot == len(rules[r][1])] for items in states]
        #: per state: rules to reduce by, and the lengths of whole sentences that end there
        self.reduce = [[(left, len(right)) for left, right in d if left != self.start] for d in done]
        self.final = [[len(right) for left, right in d if left == self.start] for d in done]

    def _closure(self, items, names):
        items = set(items)
        todo = list(items)
        while todo:
            r, dot = todo.pop()
            right = self.rules[r][1]
            if dot < len(right) and right[dot] in names:
                for i, (left, _) in enumerate(self.rules):
                    if left == right[dot] and (i, 0) not in items:
                        items.add((i, 0))
                        todo.append((i, 0))
        return frozenset(items)


class Node:
    """A state on top of a node below (None: the bottom)."""

    __slots__ = ("state", "below", "over")

    def __init__(self, state, below):
        self.state, self.below, self.over = state, below, {}

    def push(self, state) -> Node:
        if state not in self.over:
            self.over[state] = Node(state, self)
        return self.over[state]

    def pop(self, n) -> Node:
        node = self
        for _ in range(n):
            node = node.below
        return node

    def name(self) -> str:
        return f"{self.state}" if self.below is None else f"{self.below.name()}.{self.state}"


class Parser:
    """A graph-structured stack over a grammar, with the prices of edits."""

    def __init__(self, rules=RULES, inserted="ua"):
        self.grammar, self.inserted = Grammar(rules), inserted
        self.root = Node(0, None)

    @staticmethod
    def _lay(front, node, cost, audit):
        old = front.get(node)
        if old is None or (cost, audit) < old:
            front[node] = (cost, audit)
            return True
        return False

    def settle(self, front):
        """All tops that reductions and insertions lead to, before the next row."""
        todo, g = list(front), self.grammar
        while todo:
            node = todo.pop()
            cost, audit = front[node]
            for left, n in g.reduce[node.state]:
                base = node.pop(n)
                nxt = base.push(g.goto[base.state][left])
                if self._lay(front, nxt, cost, audit):
                    todo.append(nxt)
            for symbol in self.inserted:
                if symbol in g.goto[node.state]:
                    nxt = node.push(g.goto[node.state][symbol])
                    if self._lay(front, nxt, cost + INSERT, audit + "I"):
                        todo.append(nxt)
        return front

    def read(self, front, symbol, truncated, dropped):
        """The tops behind one row: of role initial ``symbol``, to be deleted if ``dropped``."""
        out, g, extra = {}, self.grammar, TRUNCATED if truncated else 0
        for node, (cost, audit) in self.settle(front).items():
            moves = g.goto[node.state]
            if g.reduce[node.state]:
                continue  # its reduction stands for it
            self._lay(out, node, cost + DELETE, audit + "D")
            if dropped:
                continue
            if symbol in moves and symbol not in ("C", "P"):
                self._lay(out, node.push(moves[symbol]), cost + KEEP + extra, audit + "K")
            for other in self.inserted:
                if other in moves and other != symbol:
                    self._lay(out, node.push(moves[other]), cost + REROLE + extra, audit + "R")
        return out

    def ending(self, front):
        """Least ``(cost, audit)`` of a whole sentence."""
        best = [w for node, w in self.settle(front).items() for n in self.grammar.final[node.state]
                if node.pop(n) is self.root]
        return min(best)

    def stack(self, name: str) -> Node:
        node = self.root
        for state in name.split(".")[1:]:
            node = node.push(int(state))
        return node

    @lru_cache(maxsize=None)  # noqa: B019  (one parser for each task)
    def under_way(self) -> tuple[str, ...]:
        """Every stack that can lie between two rows."""
        seen, todo = {self.root.name()}, [self.root]
        while todo:
            front = {todo.pop(): (0, "")}
            for symbol in "sua":
                for node in self.read(dict(front), symbol, False, False):
                    if node.name() not in seen:
                        seen.add(node.name())
                        todo.append(node)
        return tuple(sorted(seen))


def repair_roles(rows) -> tuple[int, str]:
    """``(cost, audit)`` of one sequence of ``(initial, truncated, dropped)``."""
    parser = Parser()
    front = {parser.root: (0, "")}
    for row in rows:
        front = parser.read(front, *row)
    return parser.ending(front)


_KEY = ["nil", "cid"]
_TABLE = "nil boolean, cid long, slice long, part long, rows long, blank long, duplicate long, truncated long, illegal long, " \
         "head string, last string, before string, behind string, cost long, audit string"


def _segments(limit: int):
    """Tables of the segments, of at most ``limit`` rows, of a slice, whose rows come in order."""
    def run(frames):
        parser = Parser()
        every, legal = parser.under_way(), {"su", "ua", "au"}
        key, part, rows, first = None, 0, [], True

        def table():
            pairs = [a[0] + b[0] for a, b in zip(rows, rows[1:], strict=False)]
            faults = [r[1] for r in rows]
            out = []
            # only a slice's first conversation may have begun in the slice before
            for before in (every if first or part else every[:1]):
                front = {parser.stack(before): (0, "")}
                for initial, fault in rows:
                    front = parser.read(front, initial, fault == "t", fault in ("b", "d"))
                out += [(*key[1:], key[0], part, len(rows), faults.count("b"), faults.count("d"), faults.count("t"),
                         sum(p not in legal for p in pairs), rows[0][0], rows[-1][0], before, node.name(), *w)
                        for node, w in front.items()]
            return out

        held = []
        for pdf in frames:
            for *now, initial, fault in pdf[["_pid", "nil", "cid", "initial", "fault"]].itertuples(index=False, name=None):
                if now != key or len(rows) >= limit:
                    if rows:
                        held += table()
                    part, first = (part + 1, first) if now == key else (0, key is None or key[0] != now[0])
                    key, rows = now, []
                rows.append((initial, fault))
                if len(held) > 5000:
                    yield pd.DataFrame(held, columns=_columns(_TABLE))
                    held = []
        if rows:
            held += table()
        yield pd.DataFrame(held, columns=_columns(_TABLE))
    return run


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _chained(tables: DataFrame, place: str, keys: list[str]) -> DataFrame:
    """Tables of neighbours ``2i`` and ``2i + 1`` by ``place`` as one, numbered ``i``;
    one without a neighbour stays."""
    half = F.floor(F.col(place) / 2).cast("long").alias("half")
    left = tables.filter(F.col(place) % 2 == 0).select(*keys, half, "before", F.col("behind").alias("mid"), "cost", "audit")
    right = tables.filter(F.col(place) % 2 == 1).select(*keys, half, F.col("before").alias("mid"), "behind",
                                                        F.col("cost").alias("c2"), F.col("audit").alias("a2"))
    on = [*keys, "half"]
    both = left.join(right, [*on, "mid"]).groupBy(*on, "before", "behind").agg(
        F.min(F.struct((F.col("cost") + F.col("c2")).alias("cost"), F.concat("audit", "a2").alias("audit"))).alias("w")).select(
        *on, "before", "behind", "w.*")
    lone = left.join(right.select(*on).distinct(), on, "left_anti").withColumnRenamed("mid", "behind").unionByName(
        right.select(*on, F.col("mid").alias("before"), "behind", F.col("c2").alias("cost"), F.col("a2").alias("audit"))
        .join(left.select(*on).distinct(), on, "left_anti"))
    return stored(both.unionByName(lone.select(*both.columns)).withColumnRenamed("half", place), "chained")


def _whole(tables: DataFrame) -> DataFrame:
    """``nil, cid, behind, cost, audit`` of whole conversations from their segments."""
    cols = [*_KEY, "slice", "part", "before", "behind", "cost", "audit"]
    spans = tables.groupBy(*_KEY).agg(F.min("slice").alias("lo"), (F.max("slice") - F.min("slice")).alias("slices"),
                                      F.max("part").alias("parts"))
    long = stored(spans.filter("slices > 0 or parts > 0"), "long")
    start = str(0)
    short = tables.join(long, _KEY, "left_anti").filter(F.col("before") == start).select(*_KEY, "behind", "cost", "audit")
    size = long.agg(F.max("slices"), F.max("parts")).first()
    if size[0] is None:
        return short
    rest = tables.join(long, _KEY).withColumn("slice", F.col("slice") - F.col("lo")).select(*cols)
    for place, last, keys in (("part", size[1], [*_KEY, "slice"]), ("slice", size[0], _KEY)):
        while last > 0:
            rest, last = _chained(rest, place, keys), last // 2
    return short.unionByName(rest.filter(F.col("before") == start).select(*_KEY, "behind", "cost", "audit"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows in order with ``initial`` and their first fault: ``b`` blank, ``d``
    duplicate (role and text stand earlier in the conversation), ``t``
    truncated, else null.  ``rows`` has ``nil, cid, turn, role, text``."""
    text = F.rtrim(F.col("text"), F.lit(_SPACE))
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    ordered = sliced(rows.select(*_KEY, "turn", "role", "text"), [*_KEY, "turn", "role", "text"])
    ordered = ordered.withColumn("same", same)
    seen = ordered.groupBy(*_KEY, "same").agg(F.min("_at").alias("first"), F.count("*").alias("n")).filter("n > 1")
    fault = (F.when(text == "", "b").when(F.col("_at") > F.col("first"), "d")
             .when(~F.right(text, F.lit(1)).isin(".", "!", "?"), "t"))
    return ordered.join(seen.drop("n"), [*_KEY, "same"], "left").select(
        "_pid", "_at", *_KEY, "turn", "role", "text", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))


_REPAIRED = "nil boolean, cid long, place long, role string, text string, edit string"


def _repaired(frames):
    """Rows of repaired conversations, from each audit and the rows behind it."""
    audit, at, place, last = "", 0, 0, None
    held = []

    def out(key, role, text, edit):
        nonlocal place, last
        held.append((*key, place, role, text, edit))
        place, last = place + 1, role[:1]

    def inserts(key):
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            out(key, ROLES["a" if last == "u" else "u"], "", "I")
            at += 1

    for pdf in frames:
        for nil, cid, kind, role, text, word in pdf[["nil", "cid", "kind", "role", "text", "audit"]].itertuples(index=False, name=None):
            key = (nil, cid)
            if kind == 0:
                audit, at, place, last = word, 0, 0, None
            else:
                edit = audit[at]
                at += 1
                if edit != "D":
                    out(key, role if edit == "K" else ROLES["a" if last == "u" else "u"], text, edit)
            inserts(key)
        yield pd.DataFrame(held, columns=_columns(_REPAIRED))
        held = []


def parse(rows: DataFrame):
    """``(facts, repaired)`` of conversations ``nil, cid, turn, role, text``.

    ``facts``: per conversation ``blank, duplicate, truncated, illegal, cost,
    audit``.  ``repaired``: its rows after repair, ``place, role, text, edit``,
    each conversation in order within one partition (streamed, not held).
    """
    marked = stored(with_faults(rows), "faults")
    codes = marked.select("_pid", "_at", *_KEY, "initial", "fault")
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tables = stored(codes.repartition(n, "_pid").sortWithinPartitions("_pid", "_at").mapInPandas(_segments(SEGMENT), _TABLE), "tables")
    parser = Parser()
    ends = {name: parser.ending({parser.stack(name): (0, "")}) for name in parser.under_way()}
    ended = F.create_map(*[F.lit(x) for name, (c, a) in ends.items() for x in (name, f"{c}:{a}")])[F.col("behind")]
    whole = _whole(tables).withColumn("end", ended)
    best = stored(whole.groupBy(*_KEY).agg(F.min(F.struct(
        (F.col("cost") + F.substring_index("end", ":", 1).cast("long")).alias("cost"),
        F.concat("audit", F.substring_index("end", ":", -1)).alias("audit"))).alias("w")).select(*_KEY, "w.*"), "best")

    facts = tables.groupBy(*_KEY, "slice", "part").agg(*[F.first(c).alias(c) for c in (
        "blank", "duplicate", "truncated", "illegal", "head", "last")])
    near = Window.partitionBy(*_KEY).orderBy("slice", "part")
    before = F.concat(F.lag("last").over(near), "head")
    facts = facts.withColumn("illegal", F.col("illegal") + F.when(~before.isin("su", "ua", "au"), 1).otherwise(0))
    facts = facts.groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]).join(best, _KEY)

    void = F.lit(None).cast("string")
    stream = best.select(*_KEY, F.lit(0).alias("kind"), F.lit(0).cast("long").alias("_at"), void.alias("role"), void.alias("text"), "audit")
    stream = stream.unionByName(marked.select(*_KEY, F.lit(1).alias("kind"), "_at", "role", "text", void.alias("audit")))
    repaired = stream.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "kind", "_at").mapInPandas(_repaired, _REPAIRED)
    return facts, repaired


def _digests(frames):
    key, sha = None, None
    for pdf in frames:
        done = []
        for nil, cid, role, text in pdf[["nil", "cid", "role", "text"]].itertuples(index=False, name=None):
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            if (nil, cid) != key:
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = (nil, cid), hashlib.sha256(line)
            else:
                sha.update(b"\n" + line)
        yield pd.DataFrame(done, columns=["nil", "cid", "sha"])
    if key is not None:
        yield pd.DataFrame([(*key, sha.hexdigest())], columns=["nil", "cid", "sha"])


def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that a checksum of ``conv_id:turn`` deals out:
    a twentieth each dropped, emptied, robbed of its sentence ends, repeated and
    given to the user."""
    kind = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))) % 20
    text = _or_space("text")
    rows = conversations.select(
        F.col("conv_id").isNull().alias("nil"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("cid"),
        F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(_or_space("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
    return rows.filter("kind <> 0").withColumn("copy", F.explode(F.when(
        F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select("nil", "cid", "turn", "role", "text")


def repair_report(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``, of ``rows``
    (``nil, cid, turn, role, text``; by default the damaged conversations).

    Rows go by turn, null turns first, rows of one turn by role and text.  Null
    roles and texts are one space.  A null ``conv_id`` is a conversation of its
    own.  Without rows: zeros, an empty audit and the hash of nothing.  Other
    columns are ignored; an empty table gives an empty result.  Nothing is
    bounded by the length of a conversation but the last step: its repaired text
    goes through one task, line by line, since a SHA-256 is a sequence.
    """
    rows = damage(conversations) if rows is None else rows
    facts, repaired = parse(rows)
    sha = repaired.mapInPandas(_digests, "nil boolean, cid long, sha string")
    turns = rows.groupBy(*_KEY, "turn").agg(F.lit(1).alias("one")).filter("turn is not null").groupBy(*_KEY).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    ids = conversations.select(F.col("conv_id").isNull().alias("nil"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("cid")).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (ids.join(facts, _KEY, "left").join(turns, _KEY, "left").join(sha, _KEY, "left")
            .select(F.when(~F.col("nil"), F.col("cid")).alias("conv_id"),
                    *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))


#: In DuckDB: the same least edits by a fold over four positions in the role
#: pattern (E nothing yet, S behind system, U behind user, A behind assistant),
#: each a string of the padded cost and the audit.
ORACLE = r"""
  WITH k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' ||
      coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i:
        xor(x >> 1, 3988292384 * (x & 1)))) AS c FROM conversations),
  d AS (SELECT conv_id, turn, xor(c, 4294967295) % 20 AS kind, role, text FROM k),
  r AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d WHERE kind <> 0),
  o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS seq,
               substr(role, 1, 1) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS t FROM r),
  f AS (SELECT *, CASE WHEN t = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY seq) > 1 THEN 'd'
               WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
               lag(i) OVER (PARTITION BY conv_id ORDER BY seq) || i AS pair FROM o),
  c AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank,
               count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
               list({i: i, f: fault} ORDER BY seq) AS rows, list(role || ':' || text ORDER BY seq) AS lines,
               list(text ORDER BY seq) AS texts FROM f GROUP BY conv_id),
  p AS (SELECT *, list_reduce(list_prepend({e: '000000', s: 'x', u: 'x', a: 'x', i: '', f: ''},
      list_transform(rows, lambda x: {e: '', s: '', u: '', a: '', i: x.i, f: x.f})), lambda z, x:
      list_transform([{z: z, w: CASE WHEN least(z.e, z.s, z.a) = 'x' THEN 'x' ELSE
          least(z.u, printf('%06d', CAST(substr(least(z.e, z.s, z.a), 1, 6) AS INT) + 2) || substr(least(z.e, z.s, z.a), 7) || 'I') END}],
        lambda y: list_transform([{z: y.z, u: y.w, a: least(y.z.a, printf('%06d', CAST(substr(y.w, 1, 6) AS INT) + 2) || substr(y.w, 7) || 'I')}],
          lambda v: list_transform([{z: v.z, u: v.u, a: v.a, o: least(v.z.e, v.z.s, v.a), t: CASE WHEN x.f = 't' THEN 1 ELSE 0 END, g: x.f IN ('b', 'd')}],
            lambda q: {
              e: CASE WHEN q.z.e = 'x' THEN 'x' ELSE printf('%06d', CAST(substr(q.z.e, 1, 6) AS INT) + 3) || substr(q.z.e, 7) || 'D' END,
              s: least(CASE WHEN q.z.s = 'x' THEN 'x' ELSE printf('%06d', CAST(substr(q.z.s, 1, 6) AS INT) + 3) || substr(q.z.s, 7) || 'D' END,
                       CASE WHEN q.g OR x.i <> 's' OR q.z.e = 'x' THEN 'x' ELSE printf('%06d', CAST(substr(q.z.e, 1, 6) AS INT) + q.t) || substr(q.z.e, 7) || 'K' END),
              u: least(printf('%06d', CAST(substr(q.u, 1, 6) AS INT) + 3) || substr(q.u, 7) || 'D',
                       CASE WHEN q.g THEN 'x' ELSE printf('%06d', CAST(substr(q.o, 1, 6) AS INT) + q.t + CASE WHEN x.i = 'u' THEN 0 ELSE 2 END)
                         || substr(q.o, 7) || CASE WHEN x.i = 'u' THEN 'K' ELSE 'R' END END),
              a: least(printf('%06d', CAST(substr(q.a, 1, 6) AS INT) + 3) || substr(q.a, 7) || 'D',
                       CASE WHEN q.g THEN 'x' ELSE printf('%06d', CAST(substr(q.u, 1, 6) AS INT) + q.t + CASE WHEN x.i = 'a' THEN 0 ELSE 2 END)
                         || substr(q.u, 7) || CASE WHEN x.i = 'a' THEN 'K' ELSE 'R' END END),
              i: '', f: ''})[1])[1])[1]) AS fin FROM c),
  b AS (SELECT *, least(fin.e, fin.a,
          CASE WHEN fin.u = 'x' THEN 'x' ELSE printf('%06d', CAST(substr(fin.u, 1, 6) AS INT) + 2) || substr(fin.u, 7) || 'I' END,
          CASE WHEN fin.s = 'x' THEN 'x' ELSE printf('%06d', CAST(substr(fin.s, 1, 6) AS INT) + 4) || substr(fin.s, 7) || 'II' END) AS best FROM p),
  e AS (SELECT conv_id, unnest(string_split(substr(best, 7), '')) AS edit, generate_subscripts(string_split(substr(best, 7), ''), 1) AS n,
               lines, texts FROM b WHERE length(best) > 6),
  g AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY n) AS row_no FROM e),
  h AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n) AS place,
               max(CASE WHEN edit = 'K' AND starts_with(lines[row_no], 's') THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys
        FROM g WHERE edit <> 'D'),
  m AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN lines[row_no] ELSE
                 CASE WHEN (place - sys) % 2 = 1 THEN 'user:' ELSE 'assistant:' END ||
                 CASE WHEN edit = 'R' THEN texts[row_no] ELSE '' END END, chr(10) ORDER BY place) AS body FROM h GROUP BY conv_id)
  SELECT o.conv_id, CAST(coalesce(b.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(b.blank, 0) AS BIGINT) AS blank,
         CAST(coalesce(b.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(b.truncated, 0) AS BIGINT) AS truncated,
         CAST(coalesce(b.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(CAST(substr(b.best, 1, 6) AS INT), 0) AS BIGINT) AS cost,
         coalesce(substr(b.best, 7), '') AS audit, sha256(coalesce(m.body, '')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM o.conv_id"""
