"""Language identification by prediction by partial matching (PPM).

For each language a variable-order context tree over bytes holds how often a
byte follows its 0..``ORDER`` predecessors.  A byte's exact code length under
a tree is that of the longest known context: ``n_s / (n + d)`` for a byte seen
there, else the escape ``d / (n + d)`` (``n`` bytes, ``d`` different ones)
times the byte's chance in the next shorter context, down to equal chances.
The language with the shortest code of the whole text wins.

Statistics are frozen after training, so a byte's code length depends on its
``ORDER`` predecessors only.  All (context, byte) pairs that any language has seen
are in one hash table with their bits by language, and all contexts in another
with the bits of their escapes: a byte's bits are those of the longest context
that has it plus the escapes from the longer ones.

*Bounds.*  Trees are fitted on labelled texts, drawn by hash, of at most
``TRAIN_BYTES`` bytes for all languages together (equal shares).  Texts are
whole, but of one that alone exceeds its language's share one ``RUN``-th
of the share is learned; every label has texts.  Nothing learned is left out:
the tables have at most ``ORDER + 1`` pairs for each byte of the sample (of prose
about one in ten).

Defined cases: null texts and texts without a letter get ``und`` and score 0;
ties go to the smaller name; without any training text all get ``und``;
repeated rows and null ``doc_id`` keep their rows (a null ``doc_id`` is never
held out nor learned from by queries); texts of any length are coded whole, in
pieces with their history; an empty table gives no rows; other columns are
ignored, whatever their names (``accepted`` keeps them).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chatframe.llm.kernels import held, mix64, row_slices, text_buffer

ORDER = 3
START = 256               # stands before a text
BASE = 257
EQUAL = 8.0               # bits of a byte at equal chances
TRAIN_BYTES = 8 << 20
RUN = 4                   # a text longer than the share gives this part of the share
DRAWN = 8                 # expected draws of a language at least, however long its texts
UND = "und"


class Numbers:
    """Distinct keys (not negative) numbered as given, found by hash."""

    def __init__(self, keys: np.ndarray):
        self.mask = (1 << max(4, (2 * len(keys)).bit_length())) - 1
        self.key = np.full(self.mask + 1, -1, np.int64)
        self.number = np.full(self.mask + 1, -1, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.key[at] < 0)
            slot, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.key[slot], self.number[slot] = keys[left[placed]], left[placed]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys.astype(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 for those that are not there."""
        at = self._slot(keys)
        found = self.key[at]
        out = np.where(found == keys, self.number[at], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            found = self.key[at]
            hit = found == keys[left]
            out[left[hit]] = self.number[at[hit]]
            on = ~hit & (found >= 0)
            left, at = left[on], at[on]
        return out


@dataclass
class Model:
    langs: list[str]
    pairs: Numbers        # ((context * BASE) + byte) * 4 + order
    bits: np.ndarray      # by pair and language
    contexts: Numbers     # context * 4 + order
    escape: np.ndarray    # bits by context and language, 0 where it was not seen


def training_sample(docs: DataFrame, lang: str = "lang", total: int = TRAIN_BYTES) -> list[tuple[str, bytes]]:
    """Texts by language, of at most ``total`` bytes together and some of every
    label.  In order of hash each text is taken that still fits its language's
    share; of texts longer than the share only a run of bytes."""
    known = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull() & (F.octet_length("text") > 0)).select(
        F.col(lang).alias("lang"), F.col("text").cast("binary").alias("text"),
        F.octet_length("text").cast("long").alias("n"), F.xxhash64("text").alias("h"))
    size = known.groupBy("lang").agg(F.sum("n").alias("all"), F.count("*").alias("texts"), F.min("h").alias("first")).toPandas()
    if not len(size):
        return []
    share = max(1, total // len(size))
    run = max(1, share // RUN)

    def by_lang(values) -> Column:
        return F.create_map(*[x for l, v in zip(size["lang"], values, strict=True) for x in (F.lit(l), F.lit(v))])[F.col("lang")]

    # twice the share, by hash, before anything is ordered
    rate = by_lang([min(1.0, max(2 * share / a, DRAWN / t)) for a, t in zip(size["all"], size["texts"], strict=True)])
    drawn = (known.where((F.pmod("h", F.lit(1 << 20)) < rate * (1 << 20)) | (F.col("h") == by_lang(map(int, size["first"]))))
             .withColumn("text", F.when(F.col("n") > share, F.substring("text", 1, run)).otherwise(F.col("text"))))

    rows = drawn.dropDuplicates(["lang", "h", "n"]).select("lang", "h", "n", "text").toLocalIterator()
    left, out = dict.fromkeys(size["lang"], share), []
    for name, _, _, text in sorted((r[0], r[1], r[2], bytes(r[3])) for r in rows):
        if len(text) <= left[name]:
            left[name] -= len(text)
            out.append((name, text))
    return sorted(out)


def _contexts(sym: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ``ORDER`` bytes before each position as one number, the nearest one
    lowest; the start mark fills in."""
    out = np.zeros(len(sym), np.int64)
    for k in range(1, ORDER + 1):
        h = np.full(len(sym), START, np.int64)
        h[k:] = sym[:-k]
        for j in range(k):  # positions whose k-th predecessor is in the text before
            at = starts + j
            h[at[at < len(sym)]] = START
        out += h * BASE ** (k - 1)
    return out


def train(texts: list[tuple[str, bytes]]) -> Model:
    langs = sorted({l for l, _ in texts})
    counts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER + 1)]
    for lang in langs:
        own = [t for l, t in texts if l == lang]
        sym = np.frombuffer(b"".join(own), np.uint8).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in own])[:-1]]).astype(np.int64)
        ctx = _contexts(sym, starts)
        for k in range(ORDER + 1):
            counts[k].append(np.unique(ctx % BASE ** k * BASE + sym, return_counts=True))
    pairs, bits, contexts, escape = [], [], [], []
    lower, lower_bits = np.empty(0, np.int64), np.empty((0, len(langs)))
    for k in range(ORDER + 1):
        pair = np.unique(np.concatenate([c for c, _ in counts[k]]))
        ctx, at = np.unique(pair // BASE, return_inverse=True)
        if k:  # what the suffix without the oldest byte says
            short = pair // BASE % BASE ** (k - 1) * BASE + pair % BASE
            cost = lower_bits[np.searchsorted(lower, short)]
        else:
            cost = np.full((len(pair), len(langs)), EQUAL)
        out = np.zeros((len(ctx), len(langs)))
        for li, (seen, n) in enumerate(counts[k]):
            mine = np.searchsorted(pair, seen)
            total = np.bincount(at[mine], weights=n, minlength=len(ctx))
            kinds = np.bincount(at[mine], minlength=len(ctx))
            some = total > 0
            out[some, li] = -np.log2(kinds[some] / (total[some] + kinds[some]))
            cost[:, li] += out[at, li]
            cost[mine, li] = -np.log2(n / (total + kinds)[at[mine]])
        lower, lower_bits = pair, cost
        pairs.append(pair * 4 + k)
        bits.append(cost)
        contexts.append(ctx * 4 + k)
        escape.append(out)
    return Model(langs, Numbers(np.concatenate(pairs)), np.concatenate(bits).astype(np.float32),
                 Numbers(np.concatenate(contexts)), np.concatenate(escape).astype(np.float32))


def byte_bits(model: Model, sym: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """Bits of every byte behind its context, by language."""
    out = np.zeros((len(sym), len(model.langs)), np.float32)
    left = np.arange(len(sym))
    for k in range(ORDER, -1, -1):
        short = ctx % BASE ** k
        found = model.pairs.of((short * BASE + sym) * 4 + k)
        hit = found >= 0
        out[left[hit]] += model.bits[found[hit]]
        left, sym, ctx, short = left[~hit], sym[~hit], ctx[~hit], short[~hit]
        if not len(left):
            return out
        known = model.contexts.of(short * 4 + k)
        out[left[known >= 0]] += model.escape[known[known >= 0]]
    out[left] += EQUAL
    return out


def code_lengths(model: Model, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits of every text under every language."""
    out = np.zeros((len(off) - 1, len(model.langs)))
    step = 1 << 17
    for lo, hi in row_slices(off, step):
        base, end = int(off[lo]), int(off[hi])
        for s in range(base, end, 4 * step):  # a long text in pieces with their history
            e = min(end, s + 4 * step)
            before = min(ORDER, s - base)
            sym = buf[s - before:e].astype(np.int64)
            # a piece inside a text has its history before it, not a start
            starts = (off[lo:hi] - s + before) if hi - lo > 1 else np.zeros(int(s == base), np.int64)
            cost = byte_bits(model, sym[before:], _contexts(sym, starts)[before:])
            if hi - lo == 1:
                out[lo] += cost.sum(axis=0, dtype=np.float64)
                continue
            full = np.flatnonzero(np.diff(off[lo:hi + 1]))
            out[lo + full] = np.add.reduceat(cost, (off[lo:hi] - s)[full], axis=0, dtype=np.float64)
            break
    return out


def _predicted(m: Model | None, text: pa.Array, letter: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and bits per byte of every text of a batch."""
    n = len(text)
    lang, score, per = np.full(n, UND, object), np.zeros(n), np.zeros(n)
    ok = letter.to_numpy(zero_copy_only=False).astype(bool)
    if m is not None and n:
        buf, off = text_buffer(text)
        bits = code_lengths(m, buf, off)
        best = bits.argmin(axis=1)
        low = bits[np.arange(n), best]
        share = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(axis=1)
        lang[ok] = np.array(m.langs, object)[best[ok]]
        score[ok] = share[ok]
        per[ok] = low[ok] / np.maximum(1, np.diff(off))[ok]
    return lang, score, per


def _inputs() -> list[Column]:
    return [F.coalesce(F.col("text"), F.lit("")).cast("binary"),
            F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))]


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (the winner's
    share among the languages' probabilities of the text), bits_per_byte."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        held("langid")
        for b in batches:
            lang, score, per = _predicted(shared.value, b.column(1), b.column(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(per)],
                ["doc_id", "lang_pred", "score", "bits_per_byte"])

    return docs.select("doc_id", *_inputs()).mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, bits_per_byte double")


def accepted(docs: DataFrame, model: Model | None, most_bits: float = EQUAL) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text has a language: not
    ``und``, and coded in less than ``most_bits`` a byte (equal chances)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        held("langid")
        for b in batches:
            lang, _, per = _predicted(shared.value, b.column(1), b.column(2))
            keep = pa.array((lang != UND) & (per < most_bits), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0)], ["row"]).filter(keep)

    # the row travels as one struct, so its columns may have any names
    rows = docs.select(F.struct("*").alias("row"), *_inputs())
    kind = StructType([StructField("row", rows.schema["row"].dataType)])
    return rows.mapInArrow(run, kind).select("row.*")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that queries never learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame) -> Model | None:
    """Trees from the labelled documents that are not held out."""
    texts = training_sample(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    return train(texts) if texts else None
