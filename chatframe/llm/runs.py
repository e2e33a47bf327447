"""Periodic runs of words, from Lyndon roots found by Baier's grouping.

A run ``(start, length, period)`` is a stretch of words with smallest period
``period`` and at least two of them, that no neighbouring word extends.

1. *Stretches.*  A run of at least ``2 * G`` words is covered by ``G``-grams
   that occur again in the same text: ``length - period >= G`` words equal the
   ones a period later.  So runs lie within the stretches that repeated
   ``G``-grams cover, and only these are grouped.  This drops no run, whatever
   the text; a text that is periodic throughout is one stretch.
2. *Grouping* (phase one of Baier's suffix sorter).  Suffixes start in groups
   by first word.  Groups are taken from the highest down: where ``l``
   suffixes of the group follow each other, the unprocessed suffix before them
   appends their contexts to its own and moves to a new group directly above
   its old one (below those with larger ``l``).  When a group is taken, its
   context is the longest Lyndon word at each of its suffixes, so phase one
   yields the Lyndon array without sorting.  It is linear, and is done for the
   order of the words and for the reverse order.
3. *Roots.*  Every run has a Lyndon root that is the longest Lyndon word at its
   start under one of the two orders.  Each such word is extended to both
   sides by longest common extensions of its two ends (prefix hashes and
   binary search, all positions at once); at least two periods make a run.
   Runs are then compared word by word, so hashes decide nothing.

Work is by rows: nothing is shuffled, and no group of documents meets.

Defined cases: null and empty texts have no words; texts of any length are
worked on whole, memory grows with the longest one; equal runs found from
several roots (ties) are one; repeated rows and null ``doc_id`` keep their
rows; an empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.llm.kernels import group_hash, held, mix64, prefix_hash, span_hash

MIN_WORDS = 12
SLICE_WORDS = 1 << 18
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


# ------------------------------------------------------------- Lyndon arrays ---
def lyndon_array(s: list[int], letters: int) -> list[int]:
    """Length of the longest Lyndon word at every position of ``s`` (values
    below ``letters``, each of which occurs)."""
    n = len(s)
    members: list[list[int]] = [[] for _ in range(letters)]  # by position
    for i, c in enumerate(s):
        members[c].append(i)
    context = [1] * letters
    below = list(range(-1, letters - 1))
    above = list(range(1, letters + 1))
    group = [*s, -1]                      # the last entry stands for both ends
    left, right = list(range(-1, n)), list(range(1, n + 1))  # suffixes not taken yet
    out = [0] * n
    top = letters - 1
    while top >= 0:
        size = context[top]
        moved: dict[tuple[int, int], list[int]] = {}
        for i in members[top]:
            if group[i] != top or out[i]:
                continue                  # moved to another group, or taken with the one before it
            at, count = i, 0
            while group[at] == top:
                out[at] = size
                count += 1
                at = right[at]
            j = left[at] = left[i]
            if j >= 0:
                right[j] = at
                moved.setdefault((count, group[j]), []).append(j)
        for count, old in sorted(moved, reverse=True):
            new, rows = len(members), moved[count, old]
            members.append(rows)
            context.append(context[old] + count * size)
            below.append(old)
            above.append(above[old])
            if above[old] < new:
                below[above[old]] = new
            above[old] = new
            for j in rows:
                group[j] = new
        top = below[top]
    return out


# ---------------------------------------------------------------------- runs ---
def _extension(h: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words from ``a`` and ``b`` on (``back``: before them) agree."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while len(at := np.flatnonzero(low < high)):
        mid = (low[at] + high[at] + 1) // 2
        x, y = a[at], b[at]
        same = (span_hash(h, x - mid, x) == span_hash(h, y - mid, y)) if back else \
            (span_hash(h, x, x + mid) == span_hash(h, y, y + mid))
        low[at] = np.where(same, mid, low[at])
        high[at] = np.where(same, high[at], mid - 1)
    return low


def exact_extent(ids: np.ndarray, start: int, end: int, first: int, last: int, period: int) -> tuple[int, int]:
    """Start and length of the stretch of ``period`` within ``first..last``
    that begins as ``ids[start:start + period]`` does, word by word."""
    while end < last and ids[end] == ids[end - period]:
        end += 1
    while start > first and ids[start - 1] == ids[start - 1 + period]:
        start -= 1
    return start, end - start


def stretch_runs(ids: np.ndarray, bounds: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of at least ``min_words`` words in
    the stretches ``ids[bounds[k]:bounds[k + 1]]``."""
    n = len(ids)
    if not n:
        return []
    first = np.repeat(bounds[:-1], np.diff(bounds))
    last = np.repeat(bounds[1:], np.diff(bounds))
    size = np.empty((2, n), np.int64)
    for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        found, rank = np.unique(ids[s:e], return_inverse=True)
        size[0, s:e] = lyndon_array(rank.tolist(), len(found))
        size[1, s:e] = lyndon_array((len(found) - 1 - rank).tolist(), len(found))
    at = np.tile(np.arange(n), 2)
    period = size.ravel()
    ok = at + period < last[at]
    ok[n:] &= size[0] != size[1]  # the same root under both orders
    at, period = at[ok], period[ok]
    h = prefix_hash(mix64(ids.astype(np.uint64) + np.uint64(1)))
    length = period + _extension(h, at, at + period, last[at] - at - period, False)
    back = _extension(h, at, at + period, at - first[at], True)
    long = length + back >= np.maximum(min_words, 2 * period)
    out: dict[tuple[int, int, int], None] = {}
    for s, n_words, p, root_at in zip((at - back)[long].tolist(), (length + back)[long].tolist(),
                                      period[long].tolist(), at[long].tolist(), strict=True):
        if (s, n_words, p) in out:
            continue
        if not (ids[s:s + n_words - p] == ids[s + p:s + n_words]).all():  # equal hashes of different words
            s, n_words = exact_extent(ids, root_at, root_at + p, int(first[root_at]), int(last[root_at]), p)
        if n_words >= max(min_words, 2 * p):
            out[s, n_words, p] = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def covered(ids: np.ndarray, text: np.ndarray, gram: int) -> np.ndarray:
    """Whether each word lies in a ``gram``-gram that its text has twice or more."""
    out = np.zeros(len(ids), bool)
    h = group_hash(mix64(ids.astype(np.uint64)), gram)
    if not len(h):
        return out
    whole = np.flatnonzero(text[:len(h)] == text[gram - 1:])
    key = mix64(h[whole] ^ mix64(text[whole].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    step = np.zeros(len(ids) + 1, np.int64)
    step[whole[again]] += 1
    step[whole[again] + gram] -= 1
    return np.cumsum(step[:-1]) > 0


def text_runs(texts: list[list], min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of every list of words, by start and period."""
    name = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
    size = np.array([len(t) for t in texts], np.int64)
    base = np.concatenate([[0], np.cumsum(size)])
    ids = np.fromiter((name[w] for t in texts for w in t), np.int64, int(base[-1]))
    text = np.repeat(np.arange(len(texts)), size)
    inside = np.flatnonzero(covered(ids, text, max(1, min_words // 2)))
    cut = np.flatnonzero((np.diff(inside) != 1) | (np.diff(text[inside]) != 0)) + 1
    bounds = np.concatenate([[0], cut, [len(inside)]]) if len(inside) else np.zeros(1, np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, n, p in stretch_runs(ids[inside], bounds, min_words):
        t = int(text[inside[s]])
        out[t].append((int(inside[s] - base[t]), n, p))
    return out


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run contains after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for s, n, p in runs:
        drop[s + p] += 1
        drop[s + n] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def periodic_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start,
    length, period, by start and period) and the collapsed text: kept words
    joined by one space.  Words are ``[^\\x20\\x09-\\x0D]+``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        held("runs")
        for b in batches:
            done, left, n = [], [], 0

            def work(left=left):
                for words, found in zip(left, text_runs(left, min_words), strict=True):
                    kept = collapsed(words, found) if found else words
                    done.append((len(words), [{"start": s, "length": n, "period": p} for s, n, p in found],
                                 b" ".join(kept).decode()))
                left.clear()

            for x in b.column(1):
                left.append((x.as_py() or b"").split())
                n += len(left[-1])
                if n >= SLICE_WORDS:
                    work()
                    n = 0
            work()
            size, found, out = zip(*done, strict=True) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(found, RUNS), pa.array(out, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    return (docs.select(F.col("doc_id"), F.col(text).cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, n_words long, "
                             "runs array<struct<start:long,length:long,period:long>>, collapsed string"))
