"""Jaccard join of word n-grams by the universe-partition pigeonhole.

A text's set holds its distinct shingles of ``words`` words, as 64-bit hashes.
Two sets link when ``100 * intersection >= percent * union``; linked texts form
components.

1. *Classes.*  Equal sets are one class, found by one aggregate; copies are
   never paired.
2. *Size bands.*  Bands are wide enough that the larger set of a link is in the
   smaller one's band or the next.  In a band with sizes up to ``U`` linked
   sets differ in at most ``H = U * (100 - percent) // percent`` shingles.
3. *Segments.*  In each band hashing cuts the universe of shingles into ``m``
   segments, and a set into ``m`` subsets.  Segments have thresholds 0 (subsets
   equal) or 1 (subsets differ in one shingle); where ``sum(threshold + 1)`` is
   ``H + 1``, linked sets meet the threshold in at least one segment.  How many
   have threshold 1 is chosen for each band by estimated cost: rows, and pairs
   of unrelated sets that agree by chance.
4. *Signatures.*  Every subset is a key, and so is, at threshold 1, every
   subset less one shingle.  A set has keys in its own band, and in the one
   below as the larger partner.  Keys are counted first (combined before the
   shuffle), and a ``BitSet`` of those that repeat keeps all others out of the
   later steps.
5. *Verification* on the whole sets, in two passes.  First every set meets one
   partner: of its keys' most connected sets the most connected.  Where a key
   still joins different components afterwards, all its pairs between these
   are compared; pairs that sizes or the counts of 64 buckets rule out are
   dropped, the others verified.  Keys with over ``BLOCK`` sets are dealt to
   pairs of blocks.  No link between different components is lost, and the
   pairs within one needn't be listed.

Shingles are compared as 64-bit hashes of 64-bit word hashes.

Defined cases: null and empty texts, and texts without words, have an empty
set and link with nothing; fewer words than ``words`` are one shingle; texts of
any length are worked on whole; repeated rows are copies and keep their rows;
rows with a null ``doc_id`` link others but name no component; a component is
named by its smallest doc_id (ties can't occur); an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.llm.components import components
from chatframe.llm.kernels import BitSet, group_hash, held, mix64
from chatframe.llm.spark_util import bit_set, small_batches, stored

WORDS = 3
PERCENT = 90
SET_BITS = 24
BUCKETS = 64
BLOCK = 2048
SLICE = 1 << 18        # shingles worked on at a time
OWN, LESS = 1, 2       # flags of a key: of the set's own band; of a subset less one shingle


# ---------------------------------------------------------------------- sets ---
def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct shingle hashes (uint64, sorted) of a text."""
    found = text.lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    return np.unique(group_hash(h, min(words, len(found)))) if found else h


def buckets(s: np.ndarray) -> bytes:
    """Shingles by their highest bits, up to 255 each: the sum of the
    differences of two such counts is at most that of the sets."""
    n = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=BUCKETS)
    return np.minimum(n, 255).astype(np.uint8).tobytes()


def most_apart(a, b, percent: int):
    """How many shingles two linked sets of these sizes may differ in."""
    return (a + b) * (100 - percent) // (100 + percent)


# --------------------------------------------------------- bands, allocation ---
@dataclass(frozen=True)
class Band:
    top: int          # largest size
    segments: int     # 0: linked sets are equal
    ones: int         # segments 0..ones-1 have threshold 1


def band_tops(largest: int, percent: int) -> list[int]:
    """Largest size of every band, up to one that holds ``largest``."""
    tops = [0]
    while tops[-1] < largest:
        low = tops[-1] + 1
        apart = low * (100 - percent) // percent
        alike = ((apart + 1) * percent - 1) // (100 - percent)  # the last size with the same bound
        tops.append(max(alike, tops[-1] * 100 // percent))
    return tops[1:]


def allocate(apart: int, own: int, larger: int, size: float) -> tuple[int, int]:
    """Segments and how many of them have threshold 1, by least estimated cost.

    ``own`` and ``larger``: sets of the band and of the next one, of mean
    ``size``.  Subsets of unrelated sets agree by chance when both are empty
    (Poisson counts), or, at threshold 1, one is and the other has one shingle."""
    if apart == 0:
        return 0, 0
    best = None
    for ones in range((apart + 1) // 2 + 1):
        m = apart + 1 - ones
        mean = size / m
        rows = (own + larger) * (m + ones * mean)
        chance = exp(-2 * mean) * (m + ones * 2 * mean)
        cost = rows + own * (own / 2 + larger) * chance
        if best is None or cost < best[0]:
            best = (cost, m, ones)
    return best[1], best[2]


def make_bands(tops: list[int], sizes: dict[int, tuple[int, int]], percent: int) -> list[Band]:
    """Bands with their allocation; ``sizes``: band -> (sets, shingles of all)."""
    out = []
    for i, top in enumerate(tops):
        (n, s), (more, t) = sizes.get(i, (0, 0)), sizes.get(i + 1, (0, 0))
        out.append(Band(top, *allocate(top * (100 - percent) // percent, n, more, (s + t) / max(1, n + more))))
    return out


# ---------------------------------------------------------------- signatures ---
def signatures(sets: list[np.ndarray], bands: list[Band]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of non-empty sets, the number of the set and the flags of each."""
    size = np.array([len(s) for s in sets], np.int64)
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    home = np.searchsorted([b.top for b in bands], size)
    keys, owner, flags = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int8)]
    value = mix64(items)
    for own in (True, False):
        band = home if own else home - 1
        there = band >= 0
        m = np.where(there, [bands[i].segments for i in band], 0)
        ones = np.where(there, [bands[i].ones for i in band], 0)
        base = np.cumsum(m) - m
        total = int(m.sum())
        if not total:
            continue
        used = np.repeat(m > 0, size)
        of = np.repeat(np.arange(len(sets)), size)[used]
        item, val = items[used], value[used]
        salt = mix64(band.astype(np.uint64) + np.uint64(1))
        seg = (mix64(item ^ salt[of]) % m[of].astype(np.uint64)).astype(np.int64)
        slot = base[of] + seg
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, slot, val)
        whose = np.repeat(np.arange(len(sets)), m)
        place = mix64(salt[whose] + (np.arange(total) - base[whose]).astype(np.uint64))
        keys.append(mix64(sums + place))
        owner.append(whose)
        flags.append(np.full(total, OWN * own, np.int8))
        less = seg < ones[of]
        keys.append(mix64(sums[slot[less]] - val[less] + place[slot[less]]))
        owner.append(of[less])
        flags.append(np.full(int(less.sum()), OWN * own + LESS, np.int8))
    return np.concatenate(keys), np.concatenate(owner), np.concatenate(flags)


# -------------------------------------------------------------- verification ---
def _close(i: np.ndarray, j: np.ndarray, flag, part, n, counts, percent: int) -> np.ndarray:
    """Whether rows ``i`` and ``j`` of a key have to be verified."""
    ok = ((flag[i] | flag[j]) & OWN > 0) & (flag[i] & flag[j] & LESS == 0) & (part[i] != part[j])
    a, b = n[i], n[j]
    ok &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    at = np.flatnonzero(ok)
    for s in range(0, len(at), 1 << 16):
        k = at[s:s + (1 << 16)]
        apart = np.abs(counts[i[k]].astype(np.int16) - counts[j[k]]).sum(axis=1)
        ok[k] = apart <= most_apart(a[k], b[k], percent)
    return ok


def open_pairs(group: np.ndarray, block: np.ndarray, across: np.ndarray, flag, part, n, counts, percent: int,
               small: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs to verify in groups of consecutive rows.  In a
    group that is ``across`` two blocks only pairs of different blocks count."""
    cut = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]).astype(np.int64)
    size = np.diff(cut)
    out_i, out_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def take(i, j):
        ok = (~across[i]) | (block[i] != block[j])
        i, j = i[ok], j[ok]
        ok = _close(i, j, flag, part, n, counts, percent)
        out_i.append(i[ok])
        out_j.append(j[ok])

    few = np.flatnonzero(np.repeat(size <= small, size))
    for d in range(1, small):
        i = few[:-d] if d < len(few) else few[:0]
        j = few[d:] if d < len(few) else few[:0]
        same = group[i] == group[j]
        take(i[same], j[same])
    for s, e in zip(cut[:-1][size > small].tolist(), cut[1:][size > small].tolist(), strict=True):
        for at in range(s, e, 128):
            i, j = np.meshgrid(np.arange(at, min(e, at + 128)), np.arange(at + 1, e), indexing="ij")
            later = i < j
            take(i[later], j[later])
    return np.concatenate(out_i), np.concatenate(out_j)


# -------------------------------------------------------------------- Spark ---
def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id").alias("h"), F.col("text").cast("binary").alias("text"))


def text_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, sid (hash of the set; null: empty) and bucket counts of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        held("ngrams")
        for b in batches:
            sets = [shingles(x.as_py() or b"", words) for x in b.column("text")]
            sid = np.array([xxhash.xxh3_64_intdigest(s) for s in sets], np.uint64).view(np.int64)
            none = np.array([len(s) == 0 for s in sets], bool)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sid, mask=none),
                 pa.array([buckets(s) for s in sets], pa.binary())], ["doc_id", "n", "sid", "counts"])

    return _texts(docs).mapInArrow(run, f"doc_id {id_type}, n long, sid long, counts binary")


def _chosen_sets(batches, chosen: BitSet, words: int):
    """(sids, sets), without empty sets, of rows whose id may be ``chosen``; a
    set is given once a slice."""
    sets: dict[int, np.ndarray] = {}
    n = 0
    for b in batches:
        go = chosen.has(b.column("h").to_numpy().view(np.uint64))
        for x in b.column("text").filter(pa.array(go)):
            s = shingles(x.as_py() or b"", words)
            if len(s):
                n += len(s)
                sets[xxhash.xxh3_64_intdigest(s)] = s
            if n >= SLICE:
                yield np.array(list(sets), np.uint64).view(np.int64), list(sets.values())
                sets, n = {}, 0
    if sets:
        yield np.array(list(sets), np.uint64).view(np.int64), list(sets.values())


def _ids_of(classes: DataFrame, bits: int = SET_BITS) -> BitSet:
    """The ids that stand for classes; a text of another id is a copy."""
    return bit_set(classes, F.xxhash64("least"), bits)


def repeated_keys(docs: DataFrame, classes: DataFrame, bands: list[Band], words: int) -> DataFrame:
    """key, sid, flag of keys that several sets may share."""
    chosen = docs.sparkSession.sparkContext.broadcast(_ids_of(classes))

    def all_keys(batches):
        held("ngrams")
        for _, sets in _chosen_sets(batches, chosen.value, words):
            keys, _, _ = signatures(sets, bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])

    again = _texts(docs).mapInArrow(all_keys, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    twice = docs.sparkSession.sparkContext.broadcast(bit_set(again, "key", SET_BITS))

    def some_keys(batches):
        held("ngrams")
        for sid, sets in _chosen_sets(batches, chosen.value, words):
            keys, of, flag = signatures(sets, bands)
            ok = twice.value.has(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[ok].view(np.int64)), pa.array(sid[of[ok]]), pa.array(flag[ok].astype(np.int32))],
                ["key", "sid", "flag"])

    rows = stored(_texts(docs).mapInArrow(some_keys, "key long, sid long, flag int").distinct(), "keys")
    shared = (rows.groupBy("key").agg(F.count("*").alias("m"), F.min("sid").alias("lo"), F.max("sid").alias("hi"))
              .where("lo <> hi").select("key", "m"))
    return stored(rows.join(shared, "key"), "shared-keys")


def whole_sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """sid and set (array of long) of ``classes``, once each, and maybe of some others."""
    chosen = docs.sparkSession.sparkContext.broadcast(_ids_of(classes))

    def run(batches):
        held("ngrams")
        for sid, sets in _chosen_sets(batches, chosen.value, words):
            off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sid), pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(sets).view(np.int64)))],
                ["sid", "items"])

    return _texts(docs).mapInArrow(run, "sid long, items array<long>").dropDuplicates(["sid"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    left = sets.select(F.col("sid").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b").withColumn("both", both)
            .where(100 * F.col("both") >= percent * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b"))


def first_partners(keys: DataFrame) -> DataFrame:
    """Per set one pair (a, b): with the most connected of the sets that lead
    its keys.  How connected a set is: the sum of its keys' sizes."""
    rank = keys.groupBy("sid").agg(F.sum("m").alias("rank"))
    ranked = keys.join(rank, "sid")
    plain = F.col("flag") == OWN
    lead = ranked.groupBy("key").agg(F.max(F.struct(plain.alias("plain"), "rank", "sid")).alias("lead"))
    met = ranked.join(lead, "key").where("lead.plain AND lead.sid <> sid")
    return met.groupBy("sid").agg(F.max(F.struct("lead.rank", "lead.sid")).alias("best")).select(
        F.col("sid").alias("a"), F.col("best.sid").alias("b"))


def other_pairs(keys: DataFrame, classes: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one key but different components that sizes and bucket
    counts leave open."""
    known = classes.join(parts, classes.sid == parts.node, "left").select(
        "sid", "n", "counts", F.coalesce("root", "sid").alias("part"))
    rows = keys.select("key", "sid", "flag").join(known.select("sid", "part"), "sid")
    mixed = (rows.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("m"))
             .where("lo <> hi").select("key", F.ceil(F.col("m") / BLOCK).alias("blocks")))
    mine = F.pmod(F.xxhash64("sid"), F.col("blocks"))
    dealt = (rows.join(mixed, "key").withColumn("block", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("g"), F.greatest("block", "other").alias("h"), "block", "sid", "flag")
             .join(known, "sid"))

    def run(batches):
        held("ngrams")
        hold = None
        cols = ("key", "g", "h", "block", "sid", "flag", "n", "part")

        def pairs(t, counts):
            new = (np.diff(t[0]) != 0) | (np.diff(t[1]) != 0) | (np.diff(t[2]) != 0)
            group = np.concatenate([[0], np.cumsum(new)]).astype(np.int64)
            i, j = open_pairs(group, t[3], t[1] != t[2], t[5], t[7], t[6], counts, percent)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(t[4][i], t[4][j])), pa.array(np.maximum(t[4][i], t[4][j]))],
                                              ["a", "b"])

        for b in batches:
            t = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in cols])
            c = np.frombuffer(b"".join(x.as_py() for x in b.column("counts")), np.uint8).reshape(-1, BUCKETS)
            hold = (t, c) if hold is None else (np.concatenate([hold[0], t], axis=1), np.concatenate([hold[1], c]))
            if not hold[0].shape[1]:
                continue
            last = (hold[0][:3] == hold[0][:3, -1:]).all(axis=0)
            end = int(last.argmax())
            if end:
                yield pairs(hold[0][:, :end], hold[1][:end])
                hold = hold[0][:, end:], hold[1][end:]
        if hold is not None and hold[0].shape[1]:
            yield pairs(*hold)

    return (dealt.select("key", "g", "h", "block", "sid", "flag", "n", "part", "counts")
            .repartition("key", "g", "h").sortWithinPartitions("key", "g", "h")
            .mapInArrow(run, "a long, b long").distinct())


def linked_texts(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the
    smallest doc_id that links reach)."""
    small_batches(docs.sparkSession)
    rows = stored(text_sets(docs, words), "sets")
    classes = stored(rows.where("n > 0").groupBy("sid").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("counts").alias("counts")), "classes")
    tops = band_tops(classes.agg(F.max("n")).first()[0] or 0, percent)
    band = F.size(F.filter(F.array(*[F.lit(t).cast("long") for t in tops]), lambda t: t < F.col("n")))
    found = classes.groupBy(band.alias("band")).agg(F.count("*"), F.sum("n")).collect() if tops else []  # a row a band
    bands = make_bands(tops, {r[0]: (r[1], r[2]) for r in found}, percent)

    keys = repeated_keys(docs, classes, bands, words)
    involved = classes.join(keys.select("sid").distinct(), "sid", "left_semi")
    sets = stored(whole_sets(docs, involved, words), "whole-sets")
    links = stored(verified(first_partners(keys), sets, percent), "links")
    more = other_pairs(keys, involved, components(links), percent)
    parts = components(links.unionByName(verified(stored(more, "pairs"), sets, percent)))
    named = stored(classes.join(parts, classes.sid == parts.node, "left").select(
        "sid", "least", F.coalesce("root", "sid").alias("root")), "roots")
    low = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_sid = named.join(low, "root").select(F.col("sid").alias("of"), "component_id")
    return rows.join(by_sid, F.col("sid") == F.col("of"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
