"""SimHash near-duplicates by the generalised pigeonhole principle.

*Fingerprints.*  A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, and a
text's shingles (repeats included) are hashed by XXH64 (UTF-8, seed 42); a bit
is 1 where over half of the hashes have it.

*Links.*  Distinct fingerprints at most ``distance`` bits apart:

1. The 64 bits are dealt to ``parts`` partitions, correlated bits together, by
   a 64 x 64 matrix of co-occurrences that the tasks pre-aggregate.  Fewer,
   wider partitions mean more probes and fewer chance candidates: 3 suit up to
   some 10^8 fingerprints at distance 4, beyond that 2.
2. If the partitions have thresholds that sum to ``distance - parts + 1``, two
   linked fingerprints agree within the threshold in at least one partition.
   Dynamic programming picks unequal thresholds (-1: not probed) by estimated
   rows: probes, and candidates from the partitions' bit frequencies and
   measured exact collisions.
3. Index rows hold a partition's value; probe rows the values up to the
   threshold away.  Both are shuffled once by that value.
4. Each index row of a value is compared with all rows of it.  Index rows come
   first and stay, the others stream past them, and every batch emits the edges
   of a spanning forest, never all of its pairs, which loses no connection.  A
   value with ``n > BLOCK`` index rows (by the counts of 2) is dealt to pairs of
   ``ceil(n / BLOCK)`` blocks, so no task holds more than about ``BLOCK`` index
   rows or compares them with more than one block of the others.

Groups follow from connected components.  Copies share a fingerprint and are
never paired.

Defined cases: null text has no words; texts without words have fingerprint
zero and link like any other; fewer words than ``shingle``: one shingle of
them all; texts of any length are hashed whole, 65,536 shingles at a time;
repeated rows and null ``doc_id`` keep their rows; a component of null ids only
has a null id; shingles that tie on a bit (half of them have it) leave it 0; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.llm.components import components
from chatframe.llm.kernels import BitSet, held, mix64
from chatframe.llm.spark_util import bit_set, stored

SHINGLE = 4
DISTANCE = 4
PARTS = 3
SEED = 42
BLOCK = 4096
PIECE = 1 << 20      # probes made at a time
SET_BITS = 20


# ------------------------------------------------------------- fingerprints ---
def _majority(h: np.ndarray) -> int:
    """Bit set where over half of the uint64 hashes have it."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    end = np.cumsum(size)[shingle - 1:] - 1
    hashes = [xxhash.xxh64_intdigest(line[i:j], SEED)
              for i, j in zip(start[:len(end)].tolist(), end.tolist(), strict=True)]
    return _majority(np.array(hashes, np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (``fp``, a signed long) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        held("simhash")
        for b in batches:
            fp = np.array([simhash(x.as_py() or b"", shingle) for x in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return (docs.select("doc_id", F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, fp long"))


# --------------------------------------------------------------- partitions ---
def _bits(fp: np.ndarray) -> np.ndarray:
    """Bit ``i`` (from the highest) of each fingerprint as column ``i``."""
    return np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def bit_matrix(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together.
    Tasks emit one 64 x 64 matrix for a batch; 64 rows reach the driver."""
    def run(batches):
        for b in batches:
            x = _bits(b.column("fp").to_numpy().view(np.uint64)).astype(np.float64)
            m = (x.T @ x).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(64), 64)), pa.array(np.tile(np.arange(64), 64)), pa.array(m.ravel()),
                 pa.array(np.full(4096, len(x)))], ["i", "j", "c", "n"])

    rows = (fps.select("fp").mapInArrow(run, "i long, j long, c long, n long")
            .groupBy("i", "j").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).toPandas())
    m = np.zeros((64, 64))
    if len(rows):
        m[rows["i"], rows["j"]] = rows["c"]
    return int(rows["n"].max()) if len(rows) else 0, m


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits to partitions of nearly equal width, each bit to the open
    partition whose bits it correlates with most."""
    if n:
        p = np.diag(together) / n
        sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
        corr = np.abs((together / n - np.outer(p, p)) / np.outer(sd, sd))
    else:
        corr = np.zeros((64, 64))
    np.fill_diagonal(corr, 0)
    width = [64 // parts + (i < 64 % parts) for i in range(parts)]
    left, out = set(range(64)), []
    for w in width:
        seed = max(sorted(left), key=lambda b: corr[b, sorted(left)].sum())
        group = [seed]
        left.discard(seed)
        while len(group) < w:
            best = max(sorted(left), key=lambda b: corr[b, group].mean())
            group.append(best)
            left.discard(best)
        out.append(sorted(group))
    return out


def near_share(p: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in exactly 0..most bits of a
    partition whose bits are set with chances ``p``, taken as independent."""
    dist = np.zeros(most + 1)
    dist[0] = 1.0
    for q in 2 * p * (1 - p):
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return dist


def allocate(cost: np.ndarray, total: int) -> list[int]:
    """Thresholds (-1..) with sum ``total`` and least ``sum(cost[part, t + 1])``,
    by dynamic programming over the partitions."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for s, (c, pick) in best.items():
            for t in range(-1, len(row) - 1):
                v = (c + row[t + 1], [*pick, t])
                if s + t not in nxt or v[0] < nxt[s + t][0]:
                    nxt[s + t] = v
        best = nxt
    return best[total][1]


def part_costs(n: int, together: np.ndarray, groups: list[list[int]], distance: int,
               collisions: list[float] | None = None) -> np.ndarray:
    """Estimated rows by partition and threshold + 1: probes, and candidates
    under independent bits.  ``collisions``, the measured pairs that agree in a
    partition, scale them, since correlated bits collide more often."""
    p = np.diag(together) / max(n, 1)
    top = max(0, distance)
    cost = np.zeros((len(groups), top + 2))
    for g, bits in enumerate(groups):
        share = near_share(p[bits], top)
        scale = collisions[g] / max(share[0] * n * n / 2, 1e-9) if collisions and n else 1.0
        for t in range(top + 1):
            probes = n * sum(comb(len(bits), k) for k in range(t + 1))
            cost[g, t + 1] = probes + max(scale, 1.0) * share[:t + 1].sum() * n * n / 2
    return cost


def _part_value(bits: np.ndarray, group: list[int]) -> np.ndarray:
    """The partition's bits packed into the low bits of an int64."""
    out = np.zeros(len(bits), np.int64)
    for b in group:
        out = (out << 1) | bits[:, b]
    return out


@lru_cache(maxsize=8)
def _flips(width: int, t: int) -> np.ndarray:
    """All masks of 1..t of ``width`` bits."""
    masks = [sum(1 << b for b in bits) for k in range(1, min(t, width) + 1) for bits in combinations(range(width), k)]
    return np.array(masks, np.uint64).view(np.int64)


def probe_rows(fps: DataFrame, groups: list[list[int]], limits: list[int], hot: BitSet | None = None) -> DataFrame:
    """(key, fp, idx, warm): a partition's value (idx) or one near it, and
    whether it may be one of the ``hot`` values.  The partition is in the key's
    high bits."""
    def run(batches):
        for b in batches:
            all_fp = b.column("fp").to_numpy()
            for g, (group, t) in enumerate(zip(groups, limits, strict=True)):
                if t < 0:
                    continue
                masks = np.concatenate([[0], _flips(len(group), t)])
                step = max(1, PIECE // len(masks))
                for at in range(0, len(all_fp), step):
                    fp = all_fp[at:at + step]
                    value = _part_value(_bits(fp.view(np.uint64)), group)
                    key = ((np.int64(g) << np.int64(58)) | (value[:, None] ^ masks[None, :])).ravel()
                    warm = np.zeros(len(key), bool) if hot is None else hot.has(mix64(key.view(np.uint64)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(np.repeat(fp, len(masks))), pa.array(np.tile(masks == 0, len(fp))), pa.array(warm)],
                        ["key", "fp", "idx", "warm"])
    return fps.select("fp").mapInArrow(run, "key long, fp long, idx boolean, warm boolean")


def dealt(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, cell, fp, idx): rows of a value with over ``BLOCK`` index rows go to
    cells, pairs of a block of its index rows and a block of all its rows."""
    hot = counts.where(F.col("n") > BLOCK).select(F.col("key").alias("value"), F.ceil(F.col("n") / BLOCK).alias("blocks"))
    cool = rows.where("NOT warm").select("key", F.lit(0).cast("long").alias("cell"), "fp", "idx")
    warm = rows.where("warm").join(hot, F.col("key") == F.col("value"), "left").select(
        "key", "fp", "idx", F.coalesce("blocks", F.lit(1).cast("long")).alias("blocks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    as_probe = warm.select("key", "fp", F.lit(False).alias("idx"), "blocks", mine.alias("mine"), F.explode(every).alias("i")).select(
        "key", (F.col("i") * F.col("blocks") + F.col("mine")).alias("cell"), "fp", "idx")
    as_index = warm.where("idx").select("key", "fp", "idx", "blocks", mine.alias("mine"), F.explode(every).alias("j")).select(
        "key", (F.col("mine") * F.col("blocks") + F.col("j")).alias("cell"), "fp", "idx")
    return cool.unionByName(as_probe).unionByName(as_index)


# ------------------------------------------------------------- verification ---
def _forest(fp: np.ndarray, idx: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between index rows and all rows of a group."""
    label = np.arange(len(fp))
    out = []
    for a in np.flatnonzero(idx).tolist():
        near = np.flatnonzero(np.bitwise_count(fp ^ fp[a]) <= distance)
        near = near[label[near] != label[a]]
        # one edge to each part that ``a`` is not connected with yet
        for part, i in zip(*np.unique(label[near], return_index=True), strict=True):
            out.append((int(fp[a]), int(fp[near[i]])))
            label[label == part] = label[a]
    return out


def _verify(key: np.ndarray, fp: np.ndarray, idx: np.ndarray, distance: int, most: int = 8):
    """Links of groups (rows sorted by key): groups of at most ``most`` rows all
    at once, larger ones by ``_forest``."""
    cut = np.flatnonzero(np.diff(key)) + 1
    start, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
    size = end - start
    small = np.repeat(size <= most, size)
    k, f, x = key[small], fp[small], idx[small]
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for d in range(1, most):
        i = np.flatnonzero(k[d:] == k[:-d])
        i = i[(np.bitwise_count(f[i] ^ f[i + d]) <= distance) & (x[i] | x[i + d])]
        a.append(f[i])
        b.append(f[i + d])
    for i, j in zip(start[size > most].tolist(), end[size > most].tolist(), strict=True):
        if idx[i:j].any() and (found := _forest(fp[i:j], idx[i:j], distance)):
            pairs = np.array(found, np.uint64)
            a.append(pairs[:, 0])
            b.append(pairs[:, 1])
    return np.concatenate(a), np.concatenate(b)


def links(fps: DataFrame, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect every two
    fingerprints whose link chain exists."""
    fps = stored(fps.select("fp").distinct(), "fps")
    n, together = bit_matrix(fps)
    groups = group_bits(n, together, parts)
    counts = stored(probe_rows(fps, groups, [0] * parts).groupBy("key").agg(F.count("*").alias("n")).where("n > 1"),
                    "collisions")
    same = {r[0]: float(r[1]) for r in counts.groupBy(F.shiftright("key", 58).alias("g"))
            .agg(F.expr("sum(n * (n - 1) / 2D)")).collect()}
    cost = part_costs(n, together, groups, distance, [same.get(g, 0.0) for g in range(parts)])

    def mixed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(mix64(b.column(0).to_numpy().view(np.uint64)).view(np.int64))], ["h"])

    hot = bit_set(counts.where(F.col("n") > BLOCK).select("key").mapInArrow(mixed, "h long"), "h", SET_BITS)
    rows = dealt(probe_rows(fps, groups, allocate(cost, distance - parts + 1), hot), counts)

    def run(batches):
        held = [np.empty(0, np.int64)] * 4  # index rows of the last group: rows of it may still come
        for bt in batches:
            new = [bt.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "cell", "fp", "idx")]
            key, cell, fp, idx = (np.concatenate(x) for x in zip(held, new, strict=True))
            if not len(key):
                continue
            group = np.cumsum(np.append(0, (np.diff(key) != 0) | (np.diff(cell) != 0)))
            a, b = _verify(group, fp.view(np.uint64), idx.astype(bool), distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
            stay = (group == group[-1]) & (idx > 0)
            held = [key[stay], cell[stay], fp[stay], idx[stay]]

    order = ["key", "cell", F.desc("idx")]
    return rows.repartition("key", "cell").sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    parts: int = PARTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (the smallest
    doc_id that links reach)."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comp = components(links(rows, distance, parts))
    by_fp = least.join(comp, least.fp == comp.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    by_fp = stored(by_fp, "roots")
    low = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(by_fp.join(low, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")
