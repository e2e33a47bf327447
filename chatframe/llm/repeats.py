"""Exact removal of repeated byte strings with common-prefix interval trees.

A byte is removed where a ``min_len``-byte string that covers it also starts
anywhere else (same text included, overlaps count), judged on the input.

*Anchors.*  Every window of ``min_len`` bytes names the leftmost of its
smallest ``K``-byte hashes as its anchor, so equal windows have equal anchors
at equal offsets and only suffixes that start at anchors (about one byte in
60) need sorting: a sparse suffix array.  An anchor's *context* is the text
its windows cover; its *class* is its ``K`` bytes.

1. One pass over the texts stores the anchors; counts by class (combined
   before the shuffle) mark classes that occur more than once in a ``BitSet``
   of fixed size, which keeps unique anchors out of every later shuffle.
2. Contexts that occur twice or more are covered as they stand.  This settles
   copies of texts and hot passages by one aggregate, without their bytes.
3. Each other context of a class with several ones is fetched once.  Two of
   them can only share ``min_len`` bytes around the anchor if they share
   ``SPLIT`` bytes to the right, or ``min_len - SPLIT`` to the left, so
   classes are split by these longer strings before they are sorted.
   Classes with over ``HOT`` contexts are split by ``FINE`` steps instead, which
   leaves at most that many of the ``min_len`` bytes open.
4. Per class: sort by right context (enhanced suffix array) and stack-scan the
   common-prefix values into the interval tree.  The members of an interval of
   depth ``d`` are scanned the same way by left context; a node of depth ``l``
   is left-diverse, and if its members' right contexts share no more than ``d``
   it is right-diverse too.  Then it is a maximal repeat of ``l + d`` bytes, with
   all its occurrences in the class (``maximal_groups``).  Every member of a group
   of at least ``min_len`` bytes is covered by it.

Defined cases: null text is empty; texts shorter than ``min_len`` bytes keep
all bytes; texts of any length are read whole, in slices that share no window;
repeated rows count as other places, so both lose all their bytes (if long
enough); groups that tie in length stand side by side; null ``doc_id`` is kept;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.llm.kernels import BitSet, mix64, prefix_hash, row_slices, span_hash, text_buffer
from chatframe.llm.spark_util import bit_set, stored

MIN_LEN = 200
K = 80              # bytes that define a class
SPLIT = 150         # right bytes of the first split; the second has MIN_LEN - SPLIT left bytes
HOT = 1024          # contexts of a class that is split in finer steps
FINE = 12
SLICE = 1 << 18
SET_BITS = 25       # 4 MB bit sets
_POS = np.uint64((1 << 22) - 1)

GROUP_SCHEMA = "ah long, ch long, l int, r int"


# ------------------------------------------------------------ interval tree ---
def lcp_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Stack-scan: ``(depth, first, last)`` of every common-prefix interval.

    ``lcp[i]`` is the common prefix of the sorted suffixes ``i`` and ``i + 1``;
    intervals hold at least two suffixes and come children first.
    """
    stack: list[list[int]] = []
    for i, d in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > d:
            depth, first = stack.pop()
            yield depth, first, i
        if d >= 0 and (not stack or stack[-1][0] < d):
            stack.append([d, first])


def _rows(buf: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, back: bool) -> np.ndarray:
    """Byte matrix of spans, read forwards, or backwards from their end."""
    step = np.arange(width)
    at = start[:, None] + ((size[:, None] - 1 - step) if back else step)
    return np.where(step < size[:, None], buf[np.clip(at, 0, max(0, len(buf) - 1))], 0).astype(np.uint8)


def _common(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Common prefix lengths of the rows of two byte matrices."""
    same = a == b
    first = np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))
    return np.minimum(first, np.minimum(na, nb))


class Least:
    """Least value of any range of an array."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while len(self.rows[-1]) > 1 << (len(self.rows) - 1):
            step = 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(self.rows[-1][:-step], self.rows[-1][step:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least of ``lo..hi - 1`` (not empty)."""
        k = np.frexp(hi - lo)[1] - 1
        out = np.empty(len(lo), self.rows[0].dtype)
        for j in np.unique(k).tolist():
            at = k == j
            out[at] = np.minimum(self.rows[j][lo[at]], self.rows[j][hi[at] - (1 << j)])
        return out


def _sorted_lcp(texts: list[bytes]) -> np.ndarray:
    """Common prefixes of neighbours in a sorted list."""
    size, out = np.array([len(t) for t in texts], np.int64), []
    for i in range(0, len(texts) - 1, 8192):
        part, n = texts[i:i + 8193], size[i:i + 8193]
        mat = _rows(np.frombuffer(b"".join(part) or b"\0", np.uint8), np.concatenate([[0], np.cumsum(n)[:-1]]), n,
                    max(1, int(n.max())), False)
        out.append(_common(mat[1:], mat[:-1], n[1:], n[:-1]))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def maximal_groups(right: list[bytes], left: list[bytes], lcp: np.ndarray, min_len: int,
                   ) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(l, d, members)`` of every left- and right-maximal repeat of at least
    ``min_len`` bytes of one class: the members (numbers into ``right``, which is
    sorted and has common prefixes ``lcp``) that share ``l`` bytes to the left and
    ``d`` to the right of their anchor.  ``left`` holds the left contexts reversed."""
    order = sorted(range(len(left)), key=left.__getitem__)
    rank = np.empty(len(left), np.int64)
    rank[order] = np.arange(len(left))
    order = np.array(order)
    shared_left = Least(_sorted_lcp([left[x] for x in order]))
    shared_right = Least(np.asarray(lcp, np.int64))
    for d, i, j in lcp_intervals(list(lcp)):
        at = np.sort(rank[i:j + 1])
        near = shared_left.of(at[:-1], at[1:])
        least = max(0, min_len - d)
        long = near >= least
        if not long.any():
            continue
        # runs of members that share enough to the left
        edge = np.flatnonzero(np.diff(np.concatenate([[False], long, [False]]).astype(np.int8)))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            for l, a, b in lcp_intervals(near[s:e].tolist()):
                members = np.sort(order[at[s + a:s + b + 1]])
                if shared_right.of(members[:1], members[-1:])[0] == d:
                    yield l, d, members


def maximal_repeats(texts: list[bytes], min_len: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups ``(length, [(text, start), ...])`` of the left- and right-maximal
    repeats of one block of texts, with all occurrences.  The block's suffixes
    are sorted in memory; callers bound the block."""
    where = sorted(((t, s) for t, x in enumerate(texts) for s in range(len(x))), key=lambda p: texts[p[0]][p[1]:])
    right, left = [texts[t][s:] for t, s in where], [texts[t][:s][::-1] for t, s in where]
    # every position of a repeat finds it; only at its start nothing is shared to the left
    return [(d, sorted(where[m] for m in members))
            for l, d, members in maximal_groups(right, left, _sorted_lcp(right), min_len) if l == 0]


def class_cover(right: list[bytes], left: list[bytes], lcp: np.ndarray, min_len: int) -> tuple[list[int], list[int]]:
    """Left and right reach of every member of one sorted class over its maximal
    repeats of at least ``min_len`` bytes (0, 0: in none)."""
    reach = np.zeros((2, len(right)), np.int64)
    for l, d, members in maximal_groups(right, left, lcp, min_len):
        reach[0, members] = np.maximum(reach[0, members], l)
        reach[1, members] = np.maximum(reach[1, members], d)
    return reach[0].tolist(), reach[1].tolist()


# ------------------------------------------------------------------ anchors ---
def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    span, cur = 1, x
    while span * 2 <= w:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    rest = w - span
    return np.minimum(cur[:len(cur) - rest], cur[rest:]) if rest else cur


def anchors(buf: np.ndarray, off: np.ndarray, min_len: int = MIN_LEN,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor position, first and last window start, class and context hash
    for texts ``buf[off[i]:off[i+1]]``; positions are within ``buf``."""
    n = len(buf)
    if n < min_len:
        z = np.empty(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    h = prefix_hash(buf)
    at = np.arange(n - K + 1)
    gram = span_hash(h, at, at + K)
    low = _sliding_min((gram & ~_POS) | at.astype(np.uint64), min_len - K + 1)
    mark = np.zeros(len(low) + 1, np.int32)
    long = off[1:] - off[:-1] >= min_len
    np.add.at(mark, off[:-1][long], 1)
    np.add.at(mark, off[1:][long] - min_len + 1, -1)
    win = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    a = (low[win] & _POS).astype(np.int64)
    new = np.ones(len(win), bool)
    new[1:] = (a[1:] != a[:-1]) | (win[1:] != win[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(win)) - 1
    a, lo, hi = a[first], win[first], win[last]
    ctx = mix64(span_hash(h, lo, hi + min_len) + (a - lo).astype(np.uint64))
    # anchors have the smallest hashes, so their classes are hashed anew
    return a, lo, hi, mix64(gram[a] + np.uint64(K)), ctx


def text_anchors(buf: np.ndarray, off: np.ndarray, min_len: int = MIN_LEN):
    """``anchors`` in slices of bounded size, with the row of each anchor and
    positions within its text.  A long text is cut into runs of window starts,
    which splits an anchor's windows at most; every window keeps one anchor."""
    for lo, hi in row_slices(off, SLICE):
        base, end = int(off[lo]), int(off[hi])
        cuts = [(base, end)]
        if hi - lo == 1:
            cuts = [(s, min(end, s + 2 * SLICE + min_len - 1))
                    for s in range(base, max(base + 1, end - min_len + 1), 2 * SLICE)]
        for s, e in cuts:
            bounds = off[lo:hi + 1] - s if hi - lo > 1 else np.array([0, e - s])
            pos, first, last, ah, ch = anchors(buf[s:e], bounds, min_len)
            row = lo + np.searchsorted(bounds, pos, side="right") - 1
            shift = s - off[row]
            yield row, pos + shift, first + shift, last + shift, ah, ch


def anchor_table(docs: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """doc_id, n_bytes, tid (SHA-256 of the text) and the anchors as arrays."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            buf, off = text_buffer(b.column("text"))
            tid = [hashlib.sha256(buf[i:j]).digest() for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            parts = list(text_anchors(buf, off, min_len))
            row, pos, lo, hi, ah, ch = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [
                np.empty(0, np.int64)] * 6
            cut = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32))

            def lists(x, t, cut=cut):
                return pa.ListArray.from_arrays(cut, pa.array(x.astype(t)))

            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(off)), pa.array(tid, pa.binary()),
                 lists(pos, np.int32), lists(pos - lo, np.int32), lists(hi - lo, np.int32),
                 lists(ah.view(np.int64), np.int64), lists(ch.view(np.int64), np.int64)],
                ["doc_id", "n_bytes", "tid", "pos", "back", "run", "ah", "ch"])

    return (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, n_bytes long, tid binary, pos array<int>, back array<int>, "
                             "run array<int>, ah array<long>, ch array<long>"))


def _flat(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(name).flatten().to_numpy(zero_copy_only=False)


def class_counts(table: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            u, n = np.unique(_flat(b, "ah"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(n, pa.int64())], ["ah", "n"])
    return table.select("ah").mapInArrow(run, "ah long, n long").groupBy("ah").agg(F.sum("n").alias("n"))


def kept_anchors(table: DataFrame, keep: BitSet) -> DataFrame:
    """The anchors, as rows, whose class may occur again."""
    def run(batches):
        for b in batches:
            size = np.diff(b.column("ah").offsets.to_numpy())
            rid = np.repeat(b.column("rid").to_numpy(), size)
            ah = _flat(b, "ah")
            ok = keep.has(ah.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[ok]) for x in (rid, _flat(b, "pos"), _flat(b, "back"), _flat(b, "run"), ah, _flat(b, "ch"))],
                ["rid", "pos", "back", "run", "ah", "ch"])
    return table.select("rid", "pos", "back", "run", "ah", "ch").mapInArrow(
        run, "rid long, pos int, back int, run int, ah long, ch long")


# ----------------------------------------------------------------- contexts ---
def _texts(docs: DataFrame, keep: BitSet) -> DataFrame:
    """doc_id, tid and compressed text of the rows whose tid may be wanted."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            tid = [hashlib.sha256(x).digest() for x in map(memoryview, (v.as_buffer() for v in b.column("text")))]
            key = np.frombuffer(b"".join(x[:8] for x in tid), ">u8").astype(np.uint64)
            rows = np.flatnonzero(keep.has(key)).tolist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array([tid[i] for i in rows], pa.binary()),
                 pa.array([pack.compress(b.column("text")[i].as_buffer()) for i in rows], pa.binary())],
                ["doc_id", "tid", "z"])

    return (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, tid binary, z binary"))


def _tid_set(df: DataFrame) -> BitSet:
    return bit_set(df, F.conv(F.hex(F.substring("tid", 1, 8)), 16, -10).cast("long"), SET_BITS)


def split_keys(l: bytes, r: bytes, min_len: int, hot: bool) -> list[bytes]:
    """Strings of which two contexts share one if they share ``min_len`` bytes
    around their anchor (``K`` of them to its right)."""
    if hot:
        # of n shared bytes to the left, the multiple of FINE below n and what is then shared to the right
        return [bytes([n]) + l[len(l) - n:] + r[:m] for n in range(0, min_len - K + FINE, FINE)
                if len(l) >= n and len(r) >= (m := max(K, min_len - n - FINE + 1))]
    return ([b"r" + r[:SPLIT]] if len(r) >= SPLIT else []) + (
        [b"l" + l[-(min_len - SPLIT):] + r[:K]] if len(l) >= min_len - SPLIT else [])


def contexts(wanted: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """Left and right bytes of the wanted anchors, once for each split class.

    ``wanted``: z (compressed text), at (array of struct(ah, ch, pos, back, run, hot)).
    """
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[tuple] = []
            for z, at in zip(b.column("z"), b.column("at").to_pylist(), strict=True):
                t = unpack.decompress(z.as_buffer())
                for x in at:
                    p = x["pos"]
                    lo = p - x["back"]
                    r, l = t[p:lo + x["run"] + min_len], t[lo:p]
                    for k in split_keys(l, r, min_len, x["hot"]):
                        rk = int.from_bytes(hashlib.blake2b(k, digest_size=8).digest(), "big", signed=True)
                        out.append((rk, x["ah"], x["ch"], l[::-1], r))
                if len(out) > 20_000:
                    yield _ctx_batch(out)
                    out = []
            yield _ctx_batch(out)

    return wanted.mapInArrow(run, "rk long, ah long, ch long, lft binary, rgt binary")


def _ctx_batch(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.binary()] * 2, strict=True)],
        ["rk", "ah", "ch", "lft", "rgt"])


def _classes(rows: list[tuple], min_len: int) -> pa.RecordBatch:
    """Interval trees of complete classes: rows ``(rk, rgt, lft, ah, ch)``."""
    rows.sort()
    seen: list[tuple] = []
    for r in rows:  # a context that was fetched from repeated rows is one
        if not seen or seen[-1][0] != r[0] or seen[-1][1] != r[1] or seen[-1][2] != r[2]:
            seen.append(r)
    lcp = _sorted_lcp([r[1] for r in seen])
    ah, ch, reach_l, reach_r, i = [], [], [], [], 0
    while i < len(seen):
        j = i + 1
        while j < len(seen) and seen[j][0] == seen[i][0]:
            j += 1
        if j - i > 1:
            l, r = class_cover([x[1] for x in seen[i:j]], [x[2] for x in seen[i:j]], lcp[i:j - 1], min_len)
            for x, a, z in zip(seen[i:j], l, r, strict=True):
                if z:
                    ah.append(x[3]), ch.append(x[4]), reach_l.append(a), reach_r.append(z)
        i = j
    return pa.RecordBatch.from_arrays(
        [pa.array(ah, pa.int64()), pa.array(ch, pa.int64()), pa.array(reach_l, pa.int32()), pa.array(reach_r, pa.int32())],
        ["ah", "ch", "l", "r"])


def class_reach(ctx: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """Reach of every context over the repeats it shares with others of its class."""
    def run(batches):
        held: list[tuple] = []
        for b in batches:
            held += zip(*(b.column(c).to_pylist() for c in ("rk", "rgt", "lft", "ah", "ch")), strict=True)
            if len(held) > 4096 and held[0][0] != held[-1][0]:
                cut = next(i for i in range(len(held) - 1, -1, -1) if held[i][0] != held[-1][0]) + 1
                yield _classes(held[:cut], min_len)
                held = held[cut:]
        if held:
            yield _classes(held, min_len)

    parts = ctx.repartition("rk").sortWithinPartitions("rk")
    return (parts.mapInArrow(run, GROUP_SCHEMA)
            .groupBy("ah", "ch").agg(F.max("l").alias("l"), F.max("r").alias("r")))


# ------------------------------------------------------------------ removal ---
def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for x in sorted((s["s"], s["e"]) for s in spans):
        if out and x[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x[1])
        else:
            out.append(list(x))
    return out


def repeated_spans(table: DataFrame, docs: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """rid, spans: maximal runs of repeated bytes of the rows that have any."""
    keep = bit_set(class_counts(table).where("n > 1"), "ah", SET_BITS)
    again = stored(kept_anchors(table, keep), "anchors")
    ctx = stored(again.groupBy("ah", "ch").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "pos", "back", "run")).alias("at")), "contexts")
    mixed = (ctx.groupBy("ah").agg(F.count("*").alias("m"), F.min("n").alias("least"))
             .where("m > 1 AND least = 1").select("ah", (F.col("m") > HOT).alias("hot")))
    wanted = (ctx.join(mixed, "ah").select("at.rid", F.struct("ah", "ch", "at.pos", "at.back", "at.run", "hot").alias("x"))
              .groupBy("rid").agg(F.collect_list("x").alias("at"))
              .join(table.select("rid", "doc_id", "tid"), "rid").drop("rid"))
    wanted = stored(wanted, "wanted")
    text = _texts(docs, _tid_set(wanted))
    fetched = (wanted.alias("w").join(text.alias("t"), F.expr("w.tid = t.tid AND w.doc_id <=> t.doc_id"))
               .select("t.z", "w.at"))
    reach = class_reach(contexts(fetched, min_len), min_len)
    cover = (ctx.where("n > 1").select("ah", "ch", F.lit(min_len).alias("l"), F.lit(2 * min_len).alias("r"))
             .unionByName(reach.join(ctx.where("n = 1").select("ah", "ch"), ["ah", "ch"])))
    spans = again.join(cover, ["ah", "ch"]).select(
        "rid", F.struct((F.col("pos") - F.least("l", "back")).alias("s"),
                        F.least(F.col("pos") - F.col("back") + F.col("run") + min_len,
                                F.col("pos") + F.col("r")).alias("e")).alias("x"))

    def run(batches):
        for b in batches:
            m = [_merged(x) for x in b.column("x").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), pa.array([[{"s": s, "e": e} for s, e in x] for x in m],
                                           pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))],
                ["rid", "spans"])

    return (spans.groupBy("rid").agg(F.collect_set("x").alias("x"))
            .mapInArrow(run, "rid long, spans array<struct<s:int,e:int>>"))


def without_repeats(docs: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (the removed runs),
    n_removed, kept_sha256 (of the remaining bytes)."""
    table = stored(anchor_table(docs, min_len).withColumn("rid", F.monotonically_increasing_id()), "anchor-rows")
    spans = repeated_spans(table, docs, min_len)
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    rows = stored(table.select("rid", "doc_id", "n_bytes", "tid").join(spans, "rid", "left")
                  .withColumn("n_removed", F.coalesce(total, F.lit(0).cast("long"))), "spans")
    part = rows.where("n_removed > 0 AND n_removed < n_bytes").select("tid", "spans")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for z, spans in zip(b.column("z"), b.column("spans").to_pylist(), strict=True):
                t, at, h = unpack.decompress(z.as_buffer()), 0, hashlib.sha256()
                for x in spans:
                    h.update(t[at:x["s"]])
                    at = x["e"]
                h.update(t[at:])
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("tid"), pa.array(out, pa.string())], ["tid", "kept"])

    # a text that keeps some bytes has no copy: copies lose everything
    kept = (part.join(_texts(docs, _tid_set(part)).select("tid", "z"), "tid").select("tid", "z", "spans")
            .mapInArrow(run, "tid binary, kept string"))
    return rows.join(kept, "tid", "left").select(
        "doc_id", "n_bytes", "spans", "n_removed",
        F.when(F.col("n_removed") == 0, F.lower(F.hex("tid")))
        .when(F.col("n_removed") == F.col("n_bytes"), F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.col("kept")).alias("kept_sha256"))
