"""Column expressions over text, all JVM-side built-ins (no Python UDF).

Positions count characters (code points) and are 1-based in content, as in
SQL ``substr``.  Per-character work goes through ``split(text, '')`` so that
element access stays O(1); ``substr`` on a non-ASCII string walks from the
start and would make a per-position loop quadratic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters that are regex syntax in Java patterns.
_REGEX_SYNTAX = set("\\^$.|?*+()[]{}-&~#!:<>=/,'\"%@`;_ ")


def regex_literal(pattern: str) -> str:
    """Java-regex source that matches ``pattern`` literally."""
    out = []
    for ch in pattern:
        if ch in _REGEX_SYNTAX:
            out.append("\\" + ch)
        elif ch == "\n":
            out.append("\\n")
        elif ch == "\r":
            out.append("\\r")
        elif ch == "\t":
            out.append("\\t")
        else:
            out.append(ch)
    return "".join(out)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def chars(text) -> Column:
    """Array of the characters of ``text`` (empty array for '')."""
    t = _col(text)
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, ""))


def occurrences(text, pattern: str) -> Column:
    """Number of overlapping occurrences of ``pattern`` in ``text``."""
    if not pattern:
        raise ValueError("empty pattern")
    return F.regexp_count(_col(text), F.lit("(?=" + regex_literal(pattern) + ")"))


def grams(char_array, n: int = 3) -> Column:
    """Distinct character n-grams from a character array column (see :func:`chars`).

    Takes the array, not the text: project ``chars(text)`` once, then call
    this on the projected column, so the split is not re-run per element.
    """
    c = _col(char_array)
    idx = F.sequence(F.lit(0), F.size(c) - n)
    gram = F.transform(idx, lambda i: F.concat(*[F.get(c, i + k) for k in range(n)]))
    return F.when(F.size(c) >= n, F.array_distinct(gram)).otherwise(
        F.array().cast("array<string>"))


def pattern_grams(pattern: str, n: int = 3) -> list[str]:
    """Distinct n-grams of a literal pattern, in first-seen order."""
    seen: dict[str, None] = {}
    for i in range(len(pattern) - n + 1):
        seen.setdefault(pattern[i:i + n], None)
    return list(seen)


def encoded_run_bytes(run_len) -> Column:
    """Bytes of one run in the encoded form.

    A run of 1 is the symbol, a run of 2 the symbol twice, a longer run the
    symbol plus ``run_len - 3`` written in 7-bit groups (any length).
    """
    n = _col(run_len)
    v = n - 3
    groups = (F.when(v < 1 << 7, 1).when(v < 1 << 14, 2).when(v < 1 << 21, 3)
              .when(v < 1 << 28, 4).when(v < 1 << 35, 5).when(v < 1 << 42, 6).when(v < 1 << 49, 7)
              .when(v < 1 << 56, 8).otherwise(9))
    return F.when(n == 1, F.lit(1)).when(n == 2, F.lit(2)).otherwise(1 + groups).cast("long")


def match_positions(char_array, pattern: str) -> Column:
    """Array of the 1-based start positions of ``pattern``, overlapping, from a
    character array column (see :func:`chars`).

    One pass over the array; the whole-pattern test runs only where the
    first character already matches.
    """
    if not pattern:
        raise ValueError("empty pattern")
    c = _col(char_array)
    m = len(pattern)
    first = pattern[0]

    def hit(i):
        head = F.get(c, i - 1) == F.lit(first)
        if m == 1:
            return head
        return head & (F.array_join(F.slice(c, i, m), "") == F.lit(pattern))

    found = F.filter(F.sequence(F.lit(1), F.size(c) - m + 1), hit)
    return F.when(F.size(c) >= m, found).otherwise(F.array().cast("array<int>"))


def escaped_path(path: str) -> str:
    """``path`` with the characters that readers take for patterns escaped."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def file_name(path: Column) -> Column:
    """One spelling of a local file's url; others are left as they are."""
    return F.regexp_replace(path, "^file:/+", "file:/")
