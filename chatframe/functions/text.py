"""Column-level text helpers (all JVM-side expressions, no Python per row).

Python's ``str.strip()`` / ``str.split()`` treat every character with
``str.isspace()`` as whitespace, which is wider than Spark's ``trim`` (spaces
only) and wider than Java's ``\\s``.  The character class below is derived
from Python itself by rule, so the JVM regex strips exactly what Python strips.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ranges(codepoints: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for cp in codepoints:
        if out and cp == out[-1][1] + 1:
            out[-1] = (out[-1][0], cp)
        else:
            out.append((cp, cp))
    return out


def _char_class(codepoints: list[int]) -> str:
    parts = []
    for lo, hi in _ranges(codepoints):
        parts.append(f"\\x{{{lo:X}}}" if lo == hi else f"\\x{{{lo:X}}}-\\x{{{hi:X}}}")
    return "[" + "".join(parts) + "]"


# Every code point Python's str.isspace() accepts (rule, not a table).
PY_SPACE_CODEPOINTS = [cp for cp in range(0x110000) if chr(cp).isspace()]
WS_CLASS = _char_class(PY_SPACE_CODEPOINTS)
# Works in Java regex and in RE2 (both understand \x{HHHH}, \A and \z).
STRIP_PATTERN = f"\\A{WS_CLASS}+|{WS_CLASS}+\\z"
SPLIT_PATTERN = f"{WS_CLASS}+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


PY_SPACE = "".join(map(chr, PY_SPACE_CODEPOINTS))


def py_strip(col) -> Column:
    """``str.strip()``: remove leading/trailing Python whitespace (native
    ``btrim`` with that character set, no regex)."""
    return F.btrim(_c(col), F.lit(PY_SPACE))


def cut(col, n: int) -> Column:
    """``s[:n]`` in code points."""
    return F.substring(_c(col), 1, n)


def preview(col, n: int, always: bool = False) -> Column:
    """``s[:n] + '...'`` always, or only when the text is longer than ``n``."""
    c = _c(col)
    head = F.concat(F.substring(c, 1, n), F.lit("..."))
    if always:
        return head
    return F.when(F.length(c) > n, head).otherwise(c)


def sanitize(col) -> Column:
    """Replace invalid UTF-8 (binary or string input) by U+FFFD."""
    return F.make_valid_utf8(_c(col).cast("string"))


def words(col) -> Column:
    """``s.split()`` as an array; empty array for blank text."""
    s = py_strip(col)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, SPLIT_PATTERN))


def count_words(col) -> Column:
    """``len(s.split())`` as bigint (the fallback token count)."""
    s = py_strip(col)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, SPLIT_PATTERN))).cast("bigint")


def new_tokens(ids, input_len) -> Column:
    """Generated suffix after the prompt's ``input_len`` ids; empty if nothing new."""
    ids = _c(ids)
    n = _c(input_len) if not isinstance(input_len, int) else F.lit(input_len)
    return F.slice(ids, n + 1, F.greatest(F.size(ids) - n, F.lit(0)))


def truncate_ids(ids, max_len: int) -> Column:
    """First ``max_len`` ids (training sequence limit)."""
    return F.slice(_c(ids), 1, max_len)
