"""Main text of web pages by a site style tree.

Pages of one host share their layout.  Their DOMs are merged into one tree per
host: a node is the path of presentation steps (tag, and its class or id) from
the root, and holds how many pages have it and how its content varies over
them.  As in Yi, Liu and Li (2003), a node matters when its content differs
from page to page (entropy near 1) and not when pages repeat it (near 0), and
so does each block in a node (a feature of the node): a line that k of the
node's m pages hold has importance 1 - log k / log m.  Branches and blocks of
low importance are removed from each page, wherever they stand, also within an
article or main element, and all others are kept.  Elements that HTML itself
marks as no content (nav, header, footer, aside, form, script, style and so on)
and those whose class, id or role says so get importance 0, since such a branch
may well vary over pages (a menu of neighbours, say).

Pages whose blocks are equal count as one page, so copies of an article do not
make it a repeated branch.  Statistics are aggregated with map-side combine
over (host, node, content), so a host with a third of all pages is no larger
per task than its number of different branches.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import null_id, plain_id, stored

#: Branches below this importance are removed, if at least MIN_PAGES pages of
#: the host hold them.  Of fewer pages a near copy, not a layout, is the likely reason
#: why a line repeats, and removing it would take the text of an article.
MIN_IMPORTANCE = 0.3
MIN_PAGES = 8
#: Removed branches and blocks are handed to all tasks up to this many rows, each a
#: path or a number; beyond, they meet the pages of their host in groups.
BROADCAST_ROWS = 200_000
GROUP_PAGES = 256

# HTML's element classes.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg math object canvas".split())
_SKIP = frozenset("""nav header footer aside form script style noscript template iframe svg math object canvas select
button input textarea label fieldset dialog menu menuitem head title audio video map applet""".split())
_BLOCK = frozenset("""address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4
h5 h6 hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_NOISE = re.compile(r"""(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header|
    masthead|footer|sidebar|side|aside|widget|cookies?|consent|notice|gdpr|popup|modal|overlay|newsletter|subscribe|
    signup|login|share|sharing|social|related|recommend\w*|comments?|respond|replies|reply|disqus|pagination|pager|
    copyright|legal|toolbar|search\w*|skip|hidden|byline|tags?)(?=$|[\s_-])""", re.I | re.X)
#: Words that say nothing of their own beside one of _NOISE, in names within an article.
_PLAIN = frozenset("""list box item items wrap wrapper container area section block bar button buttons link links
posts articles form thread inner outer body text content title icon icons top bottom left right inline slot unit""".split())
_CLOSES = {  # a start tag that ends an open element of these, within its block
    **dict.fromkeys("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                    "header hr main menu nav ol p pre section table ul".split(), frozenset(["p"])),
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
}
_FENCES = frozenset("html body div article section main td th table ul ol dl blockquote aside header footer nav".split())
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRS = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_END = re.compile(r"[^>]*>")
_OTHER = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
                   re.I)
_SPACE = re.compile(r"\s+")
#: Steps of a path; an element deeper down counts as its ancestor at that depth.
MAX_DEPTH = 64


def _named_noise(names: str, within: bool) -> bool:
    """Whether a class or id says that an element is no content.  Outside an
    article a part of a name is enough; within one a whole name must say so, beside
    plain words at most (``comment-list``, but not ``related-work``)."""
    if not within:
        return _NOISE.search(names) is not None
    for name in names.split():
        parts = [p for p in re.split(r"[_-]+", name.lower()) if p and not p.isdigit()]
        said = [_NOISE.fullmatch(p) is not None for p in parts]
        if any(said) and all(n or p in _PLAIN for n, p in zip(said, parts, strict=True)):
            return True
    return False


def _step(tag: str, attrs: str, within: bool = False) -> tuple[str, bool]:
    """The presentation step of an element, and whether it is marked as none
    of the content; ``within`` an article or main element."""
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return tag, tag in _SKIP
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
    names = f"{found.get('class', '')} {found.get('id', '')}".strip()
    role = found.get("role", "").lower()
    noise = (tag in _SKIP or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
             or role in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
             or re.search(r"display\s*:\s*none", found.get("style", ""), re.I) is not None
             or tag not in ("body", "html", "article", "main") and bool(names) and _named_noise(names, within))
    label = re.sub(r"\d+", "#", names)  # ids that count pages are one step
    return (f"{tag}.{label}" if label else tag), noise


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of ``>`` and quotes, and for each where a tag ends that is read on
    from there: at the next ``>`` outside quotes (-1: nowhere).  One pass."""
    at = [m.start() for m in re.finditer("[>\"']", page)]
    ends, after = [-1] * (len(at) + 1), {}
    for j in range(len(at) - 1, -1, -1):
        c = page[at[j]]
        ends[j] = at[j] if c == ">" else ends[after[c] + 1] if c in after else -1
        after[c] = j
    return at, ends


class _Open:
    """Open elements, and where the last one of each tag stands."""

    def __init__(self):
        self.stack: list[tuple[str, str, bool, bool, str, bool]] = []  # tag, path, marked, ends a block, block's path, within article
        self.at: dict[str, list[int]] = {}

    def last(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def push(self, tag, path, marked, block):
        owner = path if block else self.stack[-1][4] if self.stack else ""
        within = tag in ("article", "main") or bool(self.stack) and self.stack[-1][5]
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, path, marked, block, owner, within))

    def cut(self, to: int) -> bool:
        """Close all from ``to`` on; whether a block was among them."""
        block = any(e[3] for e in self.stack[to:])
        for e in self.stack[to:]:
            self.at[e[0]].pop()
        del self.stack[to:]
        return block


_INLINE_FENCES = ("article", "body", "main", "td")


def parse(page: str) -> list[tuple[str, str]]:
    """Blocks of a page as (path of its element, text), in page order; marked
    branches are left out.  Unclosed and stray tags are taken as HTML does for
    paragraphs, list items and table cells; a raw element that is never closed
    runs to the end.  Time is linear in the page, also of broken ones."""
    opened = _Open()
    stack = opened.stack
    out: list[tuple[str, str]] = []
    text: list[str] = []
    owner, marked = "", False
    pos, n = 0, len(page)
    last_end = page.rfind(">")
    tag_ends, endless = None, set()

    def flush(path: str) -> None:
        nonlocal text
        if text:
            joined = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
            if joined:
                out.append((path, joined))
            text = []

    def close(to: int) -> None:
        nonlocal owner, marked
        if opened.cut(to):
            flush(owner)
        owner = stack[-1][4] if stack else ""
        marked = stack[-1][2] if stack else False

    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            lt = n
        if lt > pos and not marked:
            text.append(page[pos:lt])
        if lt == n:
            break
        start = tail = None  # a start tag and its attributes, or an end tag
        name = _NAME.match(page, lt)
        if name is None:
            m = _OTHER.match(page, lt) if page.startswith(("<!", "<?"), lt) else None
            end = m.end() if m else -1
        elif name[1]:
            end = _END.match(page, name.end(), last_end + 1).end() if lt < last_end else -1
            tail = name[2]
        else:
            if tag_ends is None:
                m = _ATTRS.match(page, name.end())
                end = m.end() if m else -1
                if not m:  # the first tag that never ends: from here on by the table
                    tag_ends = _tag_ends(page)
            if tag_ends is not None:
                end = tag_ends[1][bisect_left(tag_ends[0], name.end())] + 1 or -1
            start = name[2]
        if end < 0:  # a bare sign
            if not marked:
                text.append("<")
            pos = lt + 1
            continue
        pos = end
        if start:
            tag, attrs = start.lower(), page[name.end():end - 1]
            ends = _CLOSES.get(tag)
            while ends:
                i = opened.last(ends)
                if i <= opened.last(_FENCES - ends):
                    break
                close(i)
                if tag not in ("tr", "td", "th", "li", "dt", "dd"):
                    break
            block = tag in _BLOCK or tag in _SKIP and tag not in ("label", "button", "input", "select")
            if block:
                flush(owner)
            elif tag == "br" and not marked:
                text.append(" ")
            if tag in _VOID or attrs.endswith("/") and tag in ("svg", "math"):
                continue
            within = bool(stack) and stack[-1][5]
            step, noise = _step(tag, attrs, within)
            if tag == "header" and noise and within:
                noise = step != "header" and _named_noise(step[7:], True)  # holds the article's own title
            above = stack[-1][1] if stack else ""
            path = f"{above}/{step}" if len(stack) < MAX_DEPTH else above
            if tag in _RAW and tag not in endless:
                if found := re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, pos, last_end + 1):
                    pos = found.end()
                    continue
                endless.add(tag)
            if tag in _RAW and tag not in ("object", "svg", "math", "canvas", "noscript", "template"):
                break
            opened.push(tag, path, marked or noise, block)
            marked = marked or noise
            if block:
                owner = path
        elif tail:
            tag = tail.lower()
            i = opened.last((tag,))
            if i >= 0 and (tag in _BLOCK or tag in _SKIP or i >= opened.last(_INLINE_FENCES)):
                close(i)
    close(0)
    flush("")
    return out


def _prefixes(path: str) -> list[str]:
    steps = path.split("/")[1:]
    out, cur = [], ""
    for s in steps:
        cur = f"{cur}/{s}"
        out.append(cur)
    return out or [""]


def _hash(text: str) -> int:
    raw = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) << 31 ^ zlib.adler32(raw) ^ len(raw) << 7


def _key(path: str, text: str) -> int:
    return _hash(f"{path}\t{text}")


def branches(blocks: list[tuple[str, str]]) -> dict[str, int]:
    """For every node that holds text: a hash of all text below it."""
    below: dict[str, list[str]] = {}
    for path, text in blocks:
        for p in _prefixes(path):
            below.setdefault(p, []).append(text)
    return {p: _hash("\n".join(t)) for p, t in below.items()}


def _nodes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Branches (``block`` false) and distinct blocks (true) of each page."""
    for pdf in frames:
        for at in range(0, len(pdf), 256):
            rows = []
            for host, page in zip(pdf["host"].iloc[at:at + 256], pdf["html"].iloc[at:at + 256], strict=True):
                blocks = parse(page)
                own = _hash("\n".join(f"{p}\t{t}" for p, t in blocks))
                rows += [(host, p, h, own, False) for p, h in branches(blocks).items()]
                rows += [(host, p, _key(p, t), own, True) for p, t in set(blocks)]
            yield pd.DataFrame(rows, columns=["host", "path", "content", "page", "block"])


def host_of(url: str = "url"):
    """Host of a url column, lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)",
                                               1), F.lit("")))


def _counts(pages: DataFrame, copies: bool) -> DataFrame:
    """``host, path, block, content, count``: pages by branch and block, with
    or without the pages whose blocks equal another's."""
    nodes = pages.select("host", "html").mapInPandas(
        _nodes, "host string, path string, content long, page long, block boolean")
    return (nodes if copies else nodes.distinct()).groupBy("host", "path", "block", "content").count()


def _trees(counts: DataFrame) -> DataFrame:
    sums = counts.filter("not block").groupBy("host", "path").agg(
        F.sum("count").alias("n_pages"), F.sum(F.col("count") * F.log("count")).alias("s"))
    return sums.select("host", "path", "n_pages", F.when(F.col("n_pages") > 1, (
        F.log("n_pages") - F.col("s") / F.col("n_pages")) / F.log("n_pages")).otherwise(1.0).alias("importance"))


def importance(pages: DataFrame) -> DataFrame:
    """The site style trees: ``host, path, n_pages, importance``.  A node's
    importance is the entropy of its content over the host's pages that hold
    it, to the base of their number: 1 when all differ, 0 when all agree."""
    return _trees(_counts(pages, copies=True))


def _main_text(page: str | None, removed: frozenset[str], repeated: frozenset[int] = frozenset()) -> str:
    """Blocks outside the removed branches that are none of the repeated ones."""
    return "\n".join(t for p, t in parse(page or "") if not (removed and any(x in removed for x in _prefixes(p)))
                     and not (repeated and _key(p, t) in repeated))


_TEXTS = "page_id long, url string, text string, n_chars long"


def _extracted(pdf: pd.DataFrame, held: dict[str, tuple[set, set]]) -> pd.DataFrame:
    none = (frozenset(), frozenset())
    text = [_main_text(page, *held.get(host, none)) for host, page in zip(pdf["host"], pdf["html"], strict=True)]
    return pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": text, "n_chars": [len(t) for t in text]})


def _extracted_group(pages: pd.DataFrame, low: pd.DataFrame) -> pd.DataFrame:
    paths = low["path"].notna()
    own = (set(low["path"][paths]), {int(x) for x in low["content"][~paths]})
    return _extracted(pages, dict.fromkeys(pages["host"].unique(), own))


def extract(pages: DataFrame, min_importance: float = MIN_IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    A null or empty html gives an empty text; pages without a url are one
    host of their own, and are judged by their marks alone.  Repeated rows are
    extracted alike, and a page with the same blocks as another says nothing
    about variation.  An empty table gives an empty result; other columns are
    ignored.
    """
    rows = pages.select(plain_id("page_id"), "url", host_of().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    counts = stored(_counts(rows.filter(F.col("host") != ""), copies=False), "branches")
    trees = _trees(counts).filter(F.col("n_pages") >= min_pages)
    branch = trees.filter(F.col("importance") < min_importance).select(
        "host", "path", F.lit(None).cast("long").alias("content"))
    # the first filter follows from the last and n_pages >= min_pages; it keeps the join small
    block = (counts.filter(F.col("block") & (F.col("count") > min_pages ** (1 - min_importance) * 0.999))
             .join(trees, ["host", "path"]).filter(1 - F.log("count") / F.log("n_pages") < min_importance)
             .select("host", F.lit(None).cast("string").alias("path"), "content"))
    low = stored(branch.unionByName(block), "style-tree")
    cols = ["host", "page_id", "url", "html"]
    if low.count() <= BROADCAST_ROWS:
        held: dict[str, tuple[set, set]] = {}
        for r in low.collect():
            own = held.setdefault(r["host"], (set(), set()))
            own[r["path"] is None].add(r["content"] if r["path"] is None else r["path"])

        def run(frames):
            for pdf in frames:
                for at in range(0, len(pdf), 256):
                    yield _extracted(pdf.iloc[at:at + 256], held)

        out = rows.select(*cols).mapInPandas(run, _TEXTS)
    else:  # pages of a host meet its lists in groups of bounded size
        groups = rows.groupBy("host").agg(F.ceil(F.count("*") / GROUP_PAGES).cast("int").alias("groups"))
        turn = F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.col("groups")).cast("int").alias("turn")
        lists = low.join(groups, "host").select("host", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("turn"), "path",
                                               F.col("content").cast("string").alias("content"))  # pandas would round it beside nulls
        out = stored(rows.join(groups, "host").select(*cols, turn), "pages").groupBy("host", "turn").cogroup(
            stored(lists, "lists").groupBy("host", "turn")).applyInPandas(_extracted_group, _TEXTS)
    return out.withColumn("page_id", null_id("page_id"))
