"""Benchmark decontamination as a prefix-filtered set join.

A *window* is ``width`` consecutive words of a benchmark item (an item with
fewer words, but not none, is one window).  A document is contaminated where a
whole window occurs in it.  Each window is a set of word shingles that a match
must contain completely, so the prefix of the set join is one shingle:

1. Count how often the items' shingles occur in the documents (one pass whose
   output is partial counts only) and order them by rarity.  A window whose
   rarest shingle does not occur at all is settled.
2. Second pass: look for prefix shingles only; the shingle's offset gives the
   window's start, the text's ends give the length bound, and a hash of the
   whole window prunes what is left.  Overlapping candidates of a text become
   disjoint word *spans*.
3. Distinct span texts are compared word by word with the window texts in an
   equi-join, so a passage that a third of the documents share is verified
   once; the documents then only look up their spans.

What the tasks share are two ``BitSet`` objects of fixed size.  They admit
false candidates, never lose one, and step 3 is exact.

Defined cases: null or empty text has no words; null ``doc_id`` and repeated
rows each keep their row; items without words have no windows; repeated items
all count, and equal windows of several items are hits of each; texts of any
length are searched whole; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.llm.kernels import (LOWER, RUN_BASE, BitSet, group_hash, held, mix64, row_slices,
                                   text_buffer, words_of)
from chatframe.llm.spark_util import bit_set, stored

WIDTH = 10       # words of a window
SHINGLE = 3      # words of a shingle
SET_BITS = 23    # 1 MB bit sets
WHOLE = 99       # stands for an offset where a window's own hash is meant


def _sliced(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows ``lo:hi`` of a batch with their word arrays; ``doc`` counts from ``lo``."""
    buf, off = text_buffer(batch.column("text"))
    for lo, hi in row_slices(off):
        low = LOWER[buf[off[lo]:off[hi]]]
        at = off[lo:hi + 1] - off[lo]
        s, e, h = words_of(low, at)
        doc = np.searchsorted(at, s, side="right") - 1
        yield lo, hi, low, s, e, h, doc


def _runs(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n``-word runs; a run that crosses texts is marked by 0."""
    g = group_hash(h, n)
    if len(g) and n > 1:
        g[doc[:len(g)] != doc[n - 1:]] = 0
    return g


def _shift(offset: np.ndarray | int, length: np.ndarray | int) -> np.ndarray:
    return mix64(np.atleast_1d(offset).astype(np.uint64) * np.uint64(64) + np.atleast_1d(length).astype(np.uint64))


def item_windows(items: DataFrame, width: int = WIDTH, shingle: int = SHINGLE) -> DataFrame:
    """One row per window: item_id, len, win (its words, space-joined), whash,
    shingles (their hashes by offset)."""
    id_type = items.schema["item_id"].dataType

    def run(batches):
        for b in batches:
            out = {k: [] for k in ("item", "len", "win", "whash", "shingles")}
            for lo, _, low, s, e, h, doc in _sliced(b):
                text = low.tobytes()
                words = [text[i:j] for i, j in zip(s.tolist(), e.tolist(), strict=True)]
                for d in np.unique(doc).tolist():
                    a, z = np.searchsorted(doc, [d, d + 1])
                    n = min(width, int(z - a))
                    k = min(shingle, n)
                    sh = group_hash(h[a:z], k).view(np.int64).tolist()
                    wh = group_hash(h[a:z], n).view(np.int64).tolist()
                    for i in range(int(z - a) - n + 1):
                        out["item"].append(lo + d)
                        out["len"].append(n)
                        out["win"].append(b" ".join(words[a + i:a + i + n]).decode())
                        out["whash"].append(wh[i])
                        out["shingles"].append(sh[i:i + n - k + 1])
            ids = b.column("item_id").take(pa.array(out["item"], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(out["len"], pa.int32()), pa.array(out["win"], pa.string()),
                 pa.array(out["whash"], pa.int64()), pa.array(out["shingles"], pa.list_(pa.int64()))],
                ["item_id", "len", "win", "whash", "shingles"])

    src = items.select("item_id", F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(run, f"item_id {id_type.simpleString()}, len int, win string, "
                               "whash long, shingles array<long>")


def shingle_counts(docs: DataFrame, wanted: BitSet, widths: list[int]) -> DataFrame:
    """How often each shingle whose hash is in ``wanted`` occurs: (sh, n)."""
    def run(batches):
        held("decontam")
        for b in batches:
            hits = [np.empty(0, np.uint64)]
            for _, _, _, _, _, h, doc in _sliced(b):
                for k in widths:
                    g = _runs(h, doc, k)
                    hits.append(g[wanted.has(g)])
            u, n = np.unique(np.concatenate(hits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], ["sh", "n"])

    return (docs.select(F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, "sh long, n long").groupBy("sh").agg(F.sum("n").alias("n")))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rarest shingle of each window that can occur: (whash, len, sh, off)."""
    w = windows.select("whash", "len", "shingles").distinct()
    each = w.select("whash", "len", F.posexplode("shingles").alias("off", "sh"))
    rare = (each.join(counts, "sh", "left")
            .groupBy("whash", "len")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "sh", "off")).alias("p")))
    return rare.where("p.n > 0").select("whash", "len", "p.sh", "p.off")


def _starts(h, doc, pre: BitSet, plan: BitSet, lens: list[int], shingle: int):
    """Candidate window starts and their lengths, by prefix, offset, ends and hash."""
    found = []
    for n in lens:
        k = min(shingle, n)
        g = _runs(h, doc, k)
        at = np.flatnonzero(pre.has(g) & (g != 0))
        for o in range(n - k + 1):
            i = at - o
            keep = (i >= 0) & (i + n <= len(h))
            i, p = i[keep], at[keep]
            i = i[plan.has(mix64(g[p] ^ _shift(o, n)))]
            i = i[doc[i] == doc[i + n - 1]]
            w = np.zeros(len(i), np.uint64)
            for j in range(n):
                w = w * RUN_BASE + h[i + j]
            i = i[plan.has(mix64(mix64(w + np.uint64(n)) ^ _shift(WHOLE, n)))]
            found.append(np.stack([i, np.full(len(i), n)]))
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)


def candidate_spans(docs: DataFrame, pre: BitSet, plan: BitSet, lens: list[int],
                    shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, n_words and the texts of its disjoint candidate spans."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches):
        held("decontam")
        for b in batches:
            n_words = np.zeros(b.num_rows, np.int64)
            spans: list[list[str]] = [[] for _ in range(b.num_rows)]
            for lo, hi, low, s, e, h, doc in _sliced(b):
                n_words[lo:hi] = np.bincount(doc, minlength=hi - lo)
                i, n = _starts(h, doc, pre, plan, lens, shingle)
                if not len(i):
                    continue
                cover = np.zeros(len(h) + 1, np.int64)
                np.add.at(cover, i, 1)
                np.add.at(cover, i + n, -1)
                hit = np.cumsum(cover[:-1]) > 0
                new = hit.copy()
                new[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                tail = hit.copy()
                tail[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
                text = low.tobytes()
                for a, z in zip(first.tolist(), np.flatnonzero(tail).tolist(), strict=True):
                    spans[lo + int(doc[a])].append(
                        b" ".join(text[x:y] for x, y in zip(s[a:z + 1], e[a:z + 1], strict=True)).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_words), pa.array(spans, pa.list_(pa.string()))],
                ["doc_id", "n_words", "spans"])

    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(run, f"doc_id {id_type.simpleString()}, n_words long, spans array<string>")


def _span_windows(spans: DataFrame, lens: list[int]) -> DataFrame:
    """Every run of ``lens`` words of each distinct span text: (span, at, len, win)."""
    words = F.split("span", " ")
    parts = None
    for n in lens:
        run = (spans.where(F.size(words) >= n)
               .select("span", F.lit(n).alias("len"), words.alias("w"),
                       F.explode(F.sequence(F.lit(0), F.size(words) - n)).alias("at"))
               .select("span", "len", "at",
                       F.array_join(F.slice("w", F.col("at") + 1, n), " ").alias("win")))
        parts = run if parts is None else parts.unionByName(run)
    return parts


def verified_spans(spans: DataFrame, windows: DataFrame, lens: list[int]) -> DataFrame:
    """Per distinct span text with a real window: covered words and item ids."""
    hits = (_span_windows(spans, lens)
            .join(windows.select("item_id", "len", "win").distinct(), ["len", "win"]))
    cover = F.aggregate(
        F.array_sort(F.collect_set(F.struct("at", "len"))),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["at"] + x["len"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["at"] + x["len"] - F.greatest(a["end"], x["at"]))).alias("n")),
        lambda a: a["n"])
    return hits.groupBy("span").agg(cover.alias("covered"),
                                    F.collect_set("item_id").alias("items"))


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH,
                  shingle: int = SHINGLE, set_bits: int = SET_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items (sorted
    distinct ids, as strings)."""
    windows = stored(item_windows(items, width, shingle), "windows")
    lens = sorted(r[0] for r in windows.select("len").distinct().toLocalIterator())
    widths = sorted({min(shingle, n) for n in lens})
    wanted = bit_set(windows.select(F.explode("shingles").alias("sh")), "sh", set_bits)
    pre = stored(prefixes(windows, shingle_counts(docs, wanted, widths)), "prefixes")

    def keys(batches):  # prefix at its offset, and the window itself
        for b in batches:
            n = b.column("len").to_numpy().astype(np.uint64)
            p = mix64(b.column("sh").to_numpy().view(np.uint64) ^ _shift(b.column("off").to_numpy(), n))
            w = mix64(b.column("whash").to_numpy().view(np.uint64) ^ _shift(WHOLE, n))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p, w]).view(np.int64))], ["k"])

    plan = bit_set(pre.mapInArrow(keys, "k long"), "k", set_bits)
    found = stored(candidate_spans(docs, bit_set(pre, "sh", set_bits), plan, lens, shingle)
                   .withColumn("rid", F.monotonically_increasing_id()), "spans")
    each = found.select("rid", F.explode("spans").alias("span"))
    ok = verified_spans(each.select("span").distinct(), windows, lens) if lens else None
    if ok is None:
        return found.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                            F.array().cast("array<string>").alias("items"))
    per_doc = (each.join(ok, "span").groupBy("rid")
               .agg(F.sum("covered").cast("long").alias("n_hit"),
                    F.array_sort(F.array_distinct(F.transform(
                        F.flatten(F.collect_list("items")), lambda x: x.cast("string")))).alias("items")))
    return (found.select("rid", "doc_id", "n_words").join(per_doc, "rid", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
