"""Byte-level BPE as a lazily determinised finite-state transducer.

A token sequence is the encoding of its bytes exactly if each two neighbours
encode to themselves, so every prefix of a piece has one encoding, and the
encodings of all prefixes are the paths of a nondeterministic transducer: a
configuration is a node of the vocabulary trie and the token before it.
Determinising by subsets, a state is the set of live configurations, and its
output is the last token of the prefix that has been read.  Walking back over
these outputs gives the tokens.  Live configurations start at most a token's
length back, which bounds the lookahead: in a long piece, tokens up to the last
boundary that all of them share are written while reading goes on.  States and
moves are made when first met and kept in tables of bounded size, which start
anew when full.

Decoding joins token bytes in chunks and pushes them through an incremental
UTF-8 state machine: what it carries from chunk to chunk is the unfinished
sequence of at most three bytes.

Defined cases: null and empty texts have no tokens; texts of any length are
encoded whole and decoded ``CHUNK`` tokens at a time; merges of equal rank apply
from the left; repeated rows and null ``doc_id`` keep their rows; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chatframe.llm.kernels import held

MAX_STATES = 1 << 18
MAX_PAIRS = 1 << 18
MEMO_PIECES = 1 << 17   # pieces whose ids a task remembers, in each of two generations
MEMO_CHARS = 32
CHUNK = 1 << 14         # tokens decoded at once
_NEVER = 1 << 40
_TOKEN = (1 << 24) - 1
LOOK = 4096             # bytes read before settled tokens are written


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines()) }


class Transducer:
    """``encode(piece)`` gives the token ids of one piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.child: dict[int, int] = {}      # node << 8 | byte -> node
        self.token: list[int] = [-1]         # node -> token id
        self.depth: list[int] = [0]
        for t, i in ranks.items():
            node = 0
            for c in t:
                nxt = self.child.get(node << 8 | c)
                if nxt is None:
                    nxt = self.child[node << 8 | c] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.token[node] = i
        self.inner = {k >> 8 for k in self.child}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.self_ok: dict[int, bool] = {}
        self.pair_ok: dict[int, bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[bytes, int]]] = {}
        self._reset()

    def _reset(self) -> None:
        self.moves: dict[int, int] = {}           # state << 8 | byte -> state
        self.live: list[tuple[int, ...]] = []     # state -> configurations, oldest first
        self.last: list[int] = []                 # state -> last token of the prefix
        self.number: dict[tuple[int, ...], int] = {}
        self._state((0,))

    def _state(self, live: tuple[int, ...]) -> int:
        """The state of these configurations, ``node << 24 | token before + 1``;
        the last one is at the root, behind the prefix's last token."""
        s = self.number.get(live)
        if s is None:
            s = self.number[live] = len(self.live)
            self.live.append(live)
            self.last.append((live[-1] & _TOKEN) - 1)
        return s

    def _merged(self, data: bytes, stop: int = 1) -> list[bytes]:
        """Plain merging of a token's bytes, lowest rank first, down to ``stop`` parts."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > stop:
            rank, i = min((self.ranks.get(a + b, _NEVER), i)
                          for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == _NEVER:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _spine(self, t: int, side: int) -> list[tuple[bytes, int]]:
        """The parts of token ``t`` that stood at its left (0) or right (1)
        edge while it was merged, from a byte to the token, each with the rank
        at which it was absorbed into the next."""
        key = (t, side)
        out = self.spines.get(key)
        if out is None:
            data = self.bytes_of[t]
            out = [(data, _NEVER)]
            while len(data) > 1:
                rank = self.ranks[data]
                data = self._merged(data, 2)[side]
                out.append((data, rank))
            out = self.spines[key] = out[::-1]
        return out

    def _reachable(self, t: int) -> bool:
        ok = self.self_ok.get(t)
        if ok is None:
            ok = self.self_ok[t] = len(self._merged(self.bytes_of[t])) == 1
        return ok

    def _follows(self, a: int, b: int) -> bool:
        """Whether tokens ``a b`` are the encoding of their bytes: at no time
        would the parts that meet at the boundary have merged first."""
        ok = self.pair_ok.get(a << 32 | b)
        if ok is None:
            left, right = self._spine(a, 1), self._spine(b, 0)
            i = j = 0
            while True:
                (x, ends_x), (y, ends_y) = left[i], right[j]
                # a tie goes to the merge further left
                rank = self.ranks.get(x + y, _NEVER)
                if rank < ends_x and rank <= ends_y and rank != _NEVER:
                    ok = False
                    break
                if ends_x == ends_y == _NEVER:
                    ok = True
                    break
                if ends_x <= ends_y:
                    i += 1
                else:
                    j += 1
            if len(self.pair_ok) >= MAX_PAIRS:
                self.pair_ok = {}
            self.pair_ok[a << 32 | b] = ok
        return ok

    def _move(self, state: int, byte: int) -> int:
        live, whole = [], -1
        child, token, inner, pair_ok = self.child, self.token, self.inner, self.pair_ok
        for cfg in self.live[state]:
            nxt = child.get((cfg >> 24) << 8 | byte)
            if nxt is None:
                continue
            prev = (cfg & _TOKEN) - 1
            if nxt in inner:
                live.append(nxt << 24 | prev + 1)
            t = token[nxt]
            if whole < 0 <= t and self._reachable(t):
                ok = True if prev < 0 else pair_ok.get(prev << 32 | t)
                if ok or (ok is None and self._follows(prev, t)):
                    whole = t
        live.append(whole + 1)  # each prefix has exactly one encoding
        nxt = self.moves[state << 8 | byte] = self._state(tuple(live))
        return nxt

    def _back(self, seen: list[int], at: int) -> list[int]:
        """Tokens of the first ``at`` bytes that ``seen`` covers."""
        out, size = [], self.size
        while at:
            t = seen[at - 1]
            out.append(t)
            at -= size[t]
        return out[::-1]

    def _settled(self, state: int, seen: list[int]) -> int:
        """The last boundary that all live configurations share."""
        common: set[int] | None = None
        for cfg in self.live[state]:
            at, chain = len(seen) - self.depth[cfg >> 24], set()
            while at > 0:
                chain.add(at)
                at -= self.size[seen[at - 1]]
            common = chain if common is None else common & chain
        return max(common or (), default=0)

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(self.live) > MAX_STATES:
            self._reset()
        state, out, seen = 0, [], []
        moves, last = self.moves, self.last
        for c in piece:
            nxt = moves.get(state << 8 | c)
            if nxt is None:
                if len(self.live) > 2 * MAX_STATES:  # within one very long piece
                    live = self.live[state]
                    self._reset()
                    state, moves, last = self._state(live), self.moves, self.last
                nxt = self._move(state, c)
            state = nxt
            seen.append(last[state])
            if len(seen) >= LOOK:
                done = self._settled(state, seen)
                out += self._back(seen, done)
                del seen[:done]
        return out + self._back(seen, len(seen))


class Utf8Stream:
    """Incremental decoder; ``tail`` is the unfinished sequence."""

    def __init__(self) -> None:
        self.tail = b""

    def push(self, data: bytes) -> str:
        data = self.tail + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            c = data[-back]
            if c >= 0xC0:  # a lead byte: does its sequence end here?
                need = 2 if c < 0xE0 else 3 if c < 0xF0 else 4
                cut -= back if back < need else 0
                break
            if c < 0x80:
                break
        self.tail = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        out, self.tail = self.tail.decode("utf-8", "replace"), b""
        return out


_CLASSES = (r"\p{L}", r"\p{N}", r"\s", r"\S")
_LATIN = 0x250
_BEYOND = re.compile(f"[^\0-{chr(_LATIN - 1)}]").search


def latin_pattern(pattern: str) -> re.Pattern:
    """The same pattern for texts below U+0250: character properties become
    explicit ranges, which the plain ``re`` module matches much faster."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        name = next((c for c in _CLASSES if pattern.startswith(c, i)), None)
        if name:
            prop = regex.compile(name.lower() if name == r"\S" else name)
            hits = [i for i in range(_LATIN) if prop.match(chr(i))]
            runs, start = [], 0
            for k in range(1, len(hits) + 1):
                if k == len(hits) or hits[k] != hits[k - 1] + 1:
                    runs.append(f"\\u{hits[start]:04x}-\\u{hits[k - 1]:04x}")
                    start = k
            body = "".join(runs)
            out.append(body if inside and name != r"\S" else f"[^{body}]" if name == r"\S" else f"[{body}]")
            i += len(name)
            continue
        inside = (inside or pattern[i] == "[") and pattern[i] != "]"
        out.append(pattern[i])
        i += 1
    return re.compile("".join(out))


class Codec:
    """Whole texts to packed ids and back."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.fst = Transducer(ranks)
        self.split = regex.compile(pattern).findall
        self.split_latin = latin_pattern(pattern).findall
        self.vocabulary = [self.fst.bytes_of.get(i, b"") for i in range(max(ranks.values()) + 1)]
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = self.split(text) if _BEYOND(text) else self.split_latin(text)
        if len(self.memo) > MEMO_PIECES:  # frequent pieces come back from the older generation
            self.memo, self.older = {}, self.memo
        memo, older, encode = self.memo, self.older, self.fst.encode
        new = set(pieces).difference(memo)
        for p in new:
            ids = older.get(p)
            if ids is None:
                ids = encode(p.encode())
                ids = struct.pack(f"<{len(ids)}I", *ids)
            memo[p] = ids
        out = b"".join(map(memo.__getitem__, pieces))
        for p in new:
            if len(p) > MEMO_CHARS:
                del memo[p]
        return out

    def decode(self, ids: bytes):
        """Yields (bytes, text) of chunks of the ids."""
        stream, word = Utf8Stream(), self.vocabulary.__getitem__
        for i in range(0, len(ids), 4 * CHUNK):
            data = b"".join(map(word, np.frombuffer(ids[i:i + 4 * CHUNK], "<u4").tolist()))
            yield data, stream.push(data)
        yield b"", stream.close()


def codec(path: str, pattern: str) -> Codec:
    return held(("bpe", path, pattern), lambda: Codec(path, pattern))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256,
    decoded_sha256, decoded_chars."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            n, ids_sha, dec_sha, chars = [], [], [], []
            for x in b.column("text"):
                ids = c.encode(x.as_py() or "")
                h, k = hashlib.sha256(), 0
                for data, text in c.decode(ids):
                    h.update(data)
                    k += len(text)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                dec_sha.append(h.hexdigest())
                chars.append(k)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(dec_sha, pa.string()), pa.array(chars, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_chars"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long")


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            ids = [np.frombuffer(c.encode(x.as_py() or ""), "<u4").astype(np.int32) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, ids array<int>")
