"""Secret scans: keyword prefilter, anchored expressions, checksums.

1. An Aho-Corasick automaton reads the text (A-Z lower-cased) once and reports
   where a keyword of a kind ends.
2. Only there the kind's regular expression is tried, anchored at the
   keyword's start.  Going from left to right and skipping keywords inside the
   last match gives the leftmost non-overlapping matches.  ``hex`` has no
   keyword; its runs are found directly.
3. Kinds with an embedded checksum (``CHECKED``) add a span only if the CRC-32
   in the token's last characters is that of the rest.

Spans count code points, end exclusive, and cover the whole match.

Defined cases: null text is empty; overlapping spans of different kinds all
stay; ties are ordered as in ``KINDS``; texts of any length are scanned whole, one
at a time; repeated rows and null ``doc_id`` keep their rows; an empty table gives
no rows; other columns are ignored, whatever their names (``redacted`` keeps
them).
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.llm.kernels import held

# The kinds' expressions and public token formats.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = ("assign", "access", "hex")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
}
ASSIGN = re.compile(
    rb"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    rb"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    rb"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ASSIGN_CHARS, ACCESS_CHARS = 6, 20


def checksum62(body: bytes) -> bytes:
    """CRC-32 as six base-62 digits."""
    n, out = zlib.crc32(body), b""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d:d + 1] + out
    return out


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def _match(kind: str, text: bytes, at: int) -> tuple[int, bool] | None:
    """End of the kind's match at ``at`` and whether it passes; None: no match."""
    if kind == "assign":
        m = ASSIGN.match(text, at)
        return m and (m.end(), len(m[1]) >= ASSIGN_CHARS)
    if kind == "access":
        m = ACCESS.match(text, at)
        return m and (m.end(), m.end() - at >= ACCESS_CHARS)
    m = CHECKED.match(text, at)
    return m and (m.end(), checksum62(m[1]) == m[2])


def byte_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, by start and then kind."""
    out = [(m.start(), KINDS.index("hex"), m.end()) for m in HEX.finditer(text)]
    done = dict.fromkeys(KINDS, 0)
    # one character per byte, so positions are byte positions
    for last, (size, kind) in _automaton().iter(text.lower().decode("latin-1")):
        at = last + 1 - size
        if at < done[kind]:
            continue
        if m := _match(kind, text, at):
            done[kind] = m[0]
            if m[1]:
                out.append((at, KINDS.index(kind), m[0]))
    return sorted(out)


def spans(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points."""
    found = byte_spans(text)
    if not found or text.isascii():
        return [(KINDS[k], s, e) for s, k, e in found]
    marks, at, chars, point = sorted({x for s, _, e in found for x in (s, e)}), 0, 0, {}
    for x in marks:
        chars += len(text[at:x].decode("utf-8", "replace"))
        point[x] = chars
        at = x
    return [(KINDS[k], point[s], point[e]) for s, k, e in found]


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, found (array of kind, start, end)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        held("secrets")
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans(x.as_py() or b"")]
                     for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)], ["doc_id", "found"])

    return (docs.select("doc_id", F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, found array<struct<kind:string,start:long,end:long>>"))


def redact(text: str, mark: str) -> str:
    data, out, at = text.encode(), [], 0
    for s, _, e in byte_spans(data):
        if s >= at:
            out += [data[at:s], mark.encode()]
        at = max(at, e)
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its texts replaced; null texts stay null."""
    at = docs.columns.index("text")

    def run(batches):
        held("secrets")
        for b in batches:
            cols = list(b.columns)
            cols[at] = pa.array([None if x is None else redact(x, mark) for x in cols[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return docs.mapInArrow(run, docs.schema)
