"""Operators that compare texts: SimHash, decontamination, repeats, language ID."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from chatframe.llm import components, decontam, langid, repeats, simhash
from chatframe.llm.kernels import BitSet
from chatframe.llm.spark_util import bit_set, without_ids


def words(rng, n, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ------------------------------------------------------------------ SimHash ---
def brute_simhash(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
         .replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows, distance=4):
    fp = [brute_simhash(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= distance and find(i) != find(j):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((str(d), fp[i], low.get(find(i))) for i, (d, _) in enumerate(rows))


def test_groups_match_brute_force(docs):
    rng, rows = random.Random(5), [(900, None), (901, ""), (902, "\x85\xa0"), (903, "One"), (904, "one"), (904, "one"), (None, "x y")]
    for i in range(60):
        base = words(rng, 60 if i % 2 else 400).split()
        rows.append((i * 5, " ".join(base)))
        for k in range(1, rng.randrange(1, 4)):
            base[rng.randrange(len(base))] = f"e{k}"
            rows.append((i * 5 + k, " ".join(base)))
    got = simhash.near_duplicates(docs(rows, extra=True)).collect()
    assert sorted((str(r[0]), r[1] % 2 ** 64, r[2]) for r in got) == brute_groups(rows)
    assert simhash.near_duplicates(docs([])).count() == 0


def test_blocks_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(400):  # a dense ball: many fingerprints in the same keys
        x = centre
        for b in rng.sample(range(64), rng.randrange(1, 6)):
            x ^= 1 << b
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    fps = np.array(sorted(fps), np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(fps))])
        if (new == label).all():
            break
        label = new
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = simhash.links(df, 4)
    assert edges.count() < 60 * len(fps)  # forests, not all pairs
    roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
    got = defaultdict(set)
    for i, x in enumerate(fps.view(np.int64).tolist()):
        got[roots.get(x, x)].add(i)
    want = defaultdict(set)
    for i, x in enumerate(label.tolist()):
        want[x].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def ball(rng, n, most):
    """Fingerprints around a few centres, at most ``most`` bits away."""
    centres = [rng.getrandbits(64) for _ in range(3)]
    out = set(centres)
    while len(out) < n:
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.randrange(1, most + 1)):
            x ^= 1 << b
        out.add(x)
    return np.array(sorted(out), np.uint64)


def brute_parts(fps, distance):
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    label = np.arange(len(fps))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(fps))])
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("distance,parts", [(1, 1), (6, 2), (9, 3), (3, 6), (4, 3)])
def test_any_distance_and_number_of_parts(spark, monkeypatch, distance, parts):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    fps = ball(random.Random(distance), 60 if distance > 8 else 150, distance + 8)
    edges = simhash.links(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long"), distance, parts)
    roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
    at = {x: i for i, x in enumerate(fps.view(np.int64).tolist())}
    got = [at[roots.get(x, x)] for x in at]
    want = brute_parts(fps, distance)
    assert len(set(zip(got, want.tolist(), strict=True))) == len(set(got)) == len(set(want.tolist()))


def test_a_hot_value_is_spread(spark):
    """10^5 rows of one value: cells hold a block, and every pair of rows meets."""
    n = 100_000
    rows = spark.range(n).select(F.lit(7).cast("long").alias("key"), F.col("id").alias("fp"), (F.col("id") % 2 == 0).alias("idx"),
                                 F.lit(True).alias("warm"))
    counts = spark.createDataFrame([(7, n // 2)], "key long, n long")
    cells = simhash.dealt(rows, counts).groupBy("cell").agg(F.sum(F.col("idx").cast("int")).alias("i"), F.count("*").alias("n")).collect()
    blocks = -(-n // 2 // simhash.BLOCK)
    assert len(cells) == blocks ** 2 and max(r["i"] for r in cells) < 1.2 * simhash.BLOCK
    assert max(r["n"] for r in cells) < 1.2 * (n / blocks + simhash.BLOCK)


def test_one_very_long_text(docs):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    got = simhash.near_duplicates(docs([(1, long), (2, long + " end"), (3, "short")])).collect()
    fp = {r["doc_id"]: r["fp"] % 2 ** 64 for r in got}
    assert fp[1] == simhash.simhash(long.encode()) and {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("parts", [2, 3, 4, 5])
@pytest.mark.parametrize("n", [10, 10**6, 10**10])
def test_thresholds_cover_the_distance(n, parts):
    m = np.full((64, 64), n / 4)
    np.fill_diagonal(m, n / 2)
    groups = simhash.group_bits(n, m, parts)
    assert sorted(b for g in groups for b in g) == list(range(64))
    pick = simhash.allocate(simhash.part_costs(n, m, groups, 4), 4 - parts + 1)
    assert sum(t + 1 for t in pick) == 4 + 1


def test_probing_skewed_bits_costs_more():
    n, m = 10**6, np.full((64, 64), 10**6 / 4)
    np.fill_diagonal(m, 10**6 / 2)
    groups = simhash.group_bits(n, m, 3)
    for b in groups[0]:  # nearly constant bits: everything collides there
        m[b, b] = n * 0.999
    assert simhash.allocate(simhash.part_costs(n, m, groups, 4), 2)[0] == -1


def test_correlated_bits_go_together():
    x = np.random.default_rng(1).integers(0, 2, (500, 64))
    x[:, 40] = x[:, 3]
    groups = simhash.group_bits(500, (x.T @ x).astype(float), 4)
    assert any({3, 40} <= set(g) for g in groups)


# ---------------------------------------------------------- decontamination ---
def brute_contamination(rows, items, width=10):
    def split(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return "".join(c if ord(c) > 127 or c.isdigit() or c.islower() else " " for c in low).split(" ")
    win = defaultdict(set)
    for i, t in items:
        w = [x for x in split(t) if x]
        n = min(width, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            win[tuple(w[p:p + n])].add(i)
    out = []
    for d, t in rows:
        w, hit, ids = [x for x in split(t) if x], set(), set()
        for n in {len(k) for k in win}:
            for p in range(len(w) - n + 1):
                if k := win.get(tuple(w[p:p + n])):
                    hit |= set(range(p, p + n))
                    ids |= k
        out.append((str(d), len(w), len(hit), ",".join(sorted(map(str, ids)))))
    return sorted(out)


def test_contamination_matches_brute_force(spark, docs):
    rng = random.Random(8)
    items = [(i, words(rng, rng.choice([3, 9, 10, 11, 30]), 40)) for i in range(12)]
    items += [(20, "Ünï-Code 日本 x"), (21, items[3][1]), (22, ""), (23, None), (24, "solo")]
    rows = [(i, words(rng, 80, 40)) for i in range(20)]
    for i in range(30):
        t = items[i % 12][1].split()
        a = rng.randrange(len(t))
        rows.append((100 + i, " ".join([words(rng, rng.randrange(12), 40), *t[a // 2:], "X;" if i % 3 else "", *t[:a]])))
    rows += [(200, None), (201, ""), (202, "ÜNï ünï code 日本 X solo"), (202, "ÜNï ünï code 日本 X solo"), (None, items[4][1]),
             (203, items[5][1].upper() + "! " + items[5][1]), (204, "w1 " * 30_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(docs(rows, extra=True), bench, set_bits=12).collect()
    assert sorted((str(r[0]), r[1], r[2], ",".join(r[3])) for r in got) == brute_contamination(rows, items)
    none = decontam.contamination(docs(rows[:3]), bench.limit(0)).collect()
    assert [r["n_hit"] for r in none] == [0, 0, 0]
    assert decontam.contamination(docs([]), bench).count() == 0


# ------------------------------------------------------------------ repeats ---
def brute_kept(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[s:s + size] for t in texts for s in range(len(t) - size + 1))
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, np.int64)
        for s in range(len(t) - size + 1):
            if seen[t[s:s + size]] > 1:
                gone[s] += 1
                gone[s + size] -= 1
        m = np.cumsum(gone[:-1]) > 0
        runs = int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~m]) if t else b""
        out.append((str(d), len(t), int(m.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeat_rows():
    rng = random.Random(4)
    line = "".join(rng.choices("abcdé \n", k=190))
    passage = "".join(rng.choices("abcdefgh ", k=260))
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (4, "a" * 700), (5, "ab" * 150), (6, "\0" * 230 + "x" + "\0" * 230)]
    for i in range(25):
        left, right = ("".join(rng.choices("abcdefgh ", k=rng.randrange(300))) for _ in "ab")
        cut = rng.randrange(40)
        rows.append((10 + i, left + (line if i % 2 else passage[cut:]) + right))
        if i % 5 == 0:
            rows.append((50 + i, left + passage + right))
    same = "".join(rng.choices("abcdefgh ", k=900))
    return [*rows, (90, same), (91, same), (91, same), (None, same), (92, same[:500] + "!" + same[500:])]


def test_kept_bytes_match_brute_force(docs):
    rows = repeat_rows()
    got = repeats.without_repeats(docs(rows, extra=True)).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], len(r["spans"] or []), r["kept_sha256"])
                  for r in got) == brute_kept(rows, 200)
    assert repeats.without_repeats(docs([])).count() == 0


def test_long_texts_in_pieces(docs, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 300)  # texts of over 600 bytes are cut
    parts = [x for r in repeat_rows() for x in [r[1] or ""]]
    rows = [(1, "".join(parts)), (2, "".join(parts[::-1])), (3, "z")]
    buf = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for _, t in rows])])
    windows = set()
    for row, pos, lo, hi, _, _ in repeats.text_anchors(buf, off):
        for r, p, a, z in zip(row, pos, lo, hi, strict=True):
            assert a <= p <= a + 200 - repeats.K and z <= p
            new = {(r, s) for s in range(a, z + 1)}
            assert not windows & new
            windows |= new
    assert windows == {(i, s) for i, (_, t) in enumerate(rows) for s in range(len(t.encode()) - 199)}


def test_hot_classes_in_finer_steps(docs, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 1)
    rows = repeat_rows()
    got = repeats.without_repeats(docs(rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], len(r["spans"] or []), r["kept_sha256"])
                  for r in got) == brute_kept(rows, 200)


def test_one_very_long_text_of_repeats(docs):
    rng = random.Random(8)
    line = "".join(rng.choices("abcdefgh ", k=230))
    rows = [(1, "".join("".join(rng.choices("abcdefgh ", k=700)) + line for _ in range(300))), (2, line[:150]), (3, "x" * 100_000)]
    got = repeats.without_repeats(docs(rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], len(r["spans"] or []), r["kept_sha256"])
                  for r in got) == brute_kept(rows, 200)


@pytest.mark.parametrize("hot", [False, True])
def test_split_keys_meet(hot):
    """Contexts that share 200 bytes with the anchor's K among them share a key."""
    rng = random.Random(3)
    for _ in range(400):
        l, r = rng.randrange(0, 160), rng.randrange(repeats.K, 260)
        both = bytes(rng.choices(b"abc", k=l)), bytes(rng.choices(b"abc", k=r))
        one, two = ((c + bytes(rng.choices(b"abc", k=20)) + both[0], both[1] + d + bytes(rng.choices(b"abc", k=20)))
                    for c, d in ((b"xx", b"x"), (b"yy", b"y")))
        met = set(repeats.split_keys(*one, 200, hot)) & set(repeats.split_keys(*two, 200, hot))
        assert met or l + r < 200


def test_maximal_groups_of_a_class_match_brute_force():
    """All left- and right-maximal repeats around the anchor, with all members."""
    rng = random.Random(5)
    for _ in range(150):
        ctx = {("".join(rng.choices("ab", k=rng.randrange(9))).encode(), "".join(rng.choices("ab", k=rng.randrange(9))).encode())
               for _ in range(rng.randint(2, 14))}  # (reversed left, right)
        ctx = sorted(ctx, key=lambda x: (x[1], x[0]))
        want = set()
        for a, (la, ra) in enumerate(ctx):
            for l in range(len(la) + 1):
                for d in range(len(ra) + 1):
                    group = [i for i, (x, y) in enumerate(ctx) if x[:l] == la[:l] and y[:d] == ra[:d]]
                    left = {ctx[i][0][l:l + 1] or i for i in group}    # the end differs from everything
                    right = {ctx[i][1][d:d + 1] or i for i in group}
                    if len(group) > 1 and len(left) > 1 and len(right) > 1 and l + d >= 4:
                        want.add((l, d, tuple(group)))
        right, left = [x[1] for x in ctx], [x[0] for x in ctx]
        got = [(l, d, tuple(m.tolist())) for l, d, m in repeats.maximal_groups(right, left, repeats._sorted_lcp(right), 4)]
        assert len(got) == len(set(got)) and set(got) == want
        reach = repeats.class_cover(right, left, repeats._sorted_lcp(right), 4)
        for i in range(len(ctx)):
            mine = [(l, d) for l, d, m in want if i in m]
            assert (reach[0][i], reach[1][i]) == (max((l for l, _ in mine), default=0), max((d for _, d in mine), default=0))


def test_maximal_repeats_match_brute_force():
    rng = random.Random(6)
    for _ in range(40):
        texts = ["".join(rng.choices("ab", k=rng.randrange(14))).encode() for _ in range(3)]
        where = defaultdict(list)
        for t, x in enumerate(texts):
            for s in range(len(x)):
                for e in range(s + 2, len(x) + 1):
                    where[x[s:e]].append((t, s))
        want = []
        for x, at in where.items():
            left = {texts[t][s - 1] if s else None for t, s in at}
            right = {texts[t][s + len(x)] if s + len(x) < len(texts[t]) else None for t, s in at}
            if len(at) > 1 and (len(left) > 1 or None in left) and (len(right) > 1 or None in right):
                want.append((len(x), sorted(at)))
        assert sorted(repeats.maximal_repeats(texts, 2)) == sorted(want)


# -------------------------------------------------------------- language ID ---
def slow_bits(trees, text):
    s = [256] * 3 + list(text)
    total = 0.0
    for i in range(3, len(s)):
        for k in (3, 2, 1, 0):
            c = trees.get(tuple(s[i - k:i]))
            if c is None:
                continue
            n, d = sum(c.values()), len(c)
            if s[i] in c:
                total -= np.log2(c[s[i]] / (n + d))
                break
            total -= np.log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_match_a_plain_tree():
    """Also of bytes that no language has seen, and of a hundred scripts' bytes."""
    rng = random.Random(1)
    every = bytes(range(256))
    texts = [("x", "".join(rng.choices("abc ", k=300)).encode()), ("y", "".join(rng.choices("abcdé ", k=300)).encode()),
             ("x", b"abab"), ("z", bytes(rng.choices(every[:200], k=5000)))]
    m = langid.train(sorted(texts))
    probe = [b"", b"abc", "é?z".encode(), b"ab" * 50, every * 3, bytes(rng.choices(every, k=400))]
    off = np.concatenate([[0], np.cumsum([len(p) for p in probe])]).astype(np.int64)
    got = langid.code_lengths(m, np.frombuffer(b"".join(probe), np.uint8), off)
    for li, lang in enumerate(m.langs):
        trees = defaultdict(Counter)
        for l, t in texts:
            if l == lang:
                s = [256] * 3 + list(t)
                for i in range(3, len(s)):
                    for k in range(4):
                        trees[tuple(s[i - k:i])][s[i]] += 1
        assert np.allclose(got[:, li], [slow_bits(trees, p) for p in probe], rtol=1e-5)


def test_numbers_find_all_keys_and_no_others():
    rng = np.random.default_rng(3)
    keys = rng.permutation(10 ** 6)[:20_000].astype(np.int64)
    n = langid.Numbers(keys)
    assert (n.of(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(np.arange(10 ** 6), keys)
    assert (n.of(other) == -1).all() and (langid.Numbers(keys[:0]).of(keys) == -1).all()


def test_long_texts_code_alike():
    m = langid.train([("a", b"abcabcabd" * 50), ("b", b"bcabdd" * 50)])
    buf = np.frombuffer("".join(random.Random(3).choices("abcd", k=2_500_000)).encode(), np.uint8)
    sym = buf.astype(np.int64)
    whole = langid.byte_bits(m, sym, langid._contexts(sym, np.zeros(1, np.int64))).sum(axis=0, dtype=np.float64)
    assert np.allclose(langid.code_lengths(m, buf, np.array([0, len(buf)]))[0], whole, rtol=1e-9)


def test_identify_rows(docs):
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(8)] + [(10 + i, "le chat et le chien " * 5, "fr") for i in range(8)]
    rows += [(30, None, "en"), (31, "", None), (32, "12 34 !!", "fr"), (33, "the dog", None), (33, "the dog", None), (None, "le chien", "en")]
    df = docs(rows, extra=True)
    out = langid.identify(df, langid.fit(df)).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert got[30] == got[31] == got[32] == ("und", 0.0)
    assert got[33][0] == got[1][0] == "en" and got[12][0] == got[None][0] == "fr" and 0 < got[1][1] <= 1
    assert {r["lang_pred"] for r in langid.identify(df, None).collect()} == {"und"}
    kept = langid.accepted(df, langid.fit(df))
    assert kept.columns == df.columns and kept.count() == len(rows) - 3


def test_sample_has_every_label(docs):
    """Also those whose texts are few and longer than the share."""
    rows = [(i, f"short {i}", "en") for i in range(500)] + [(1000 + i, f"{i} long " * 300, "fr") for i in range(3)]
    rows += [(2000 + i, f"{i} " + "very long " * 90_000, f"l{i}") for i in range(20)]
    got = langid.training_sample(docs(rows), total=22 * 400)
    size = Counter()
    for l, t in got:
        size[l] += len(t)
    assert set(size) == {r[2] for r in rows} and max(size.values()) <= 400
    assert size["fr"] == 300 and all(t.decode() in {r[1] for r in rows} for l, t in got if l == "en")


def test_sample_skips_only_what_does_not_fit(docs):
    rng = random.Random(8)
    rows = [(i, chr(97 + i) * rng.randint(1, 90), "en") for i in range(12)]
    share = sum(len(r[1]) for r in rows) * 2 // 3
    got = {t.decode() for _, t in langid.training_sample(docs(rows), total=share)}
    left = share - sum(map(len, got))
    assert left >= 0 and all(len(r[1]) > left for r in rows if r[1] not in got)


def test_one_text_longer_than_the_sample(docs):
    df = docs([(1, "the cat and the dog " * 450_000, "en"), (3, "the dog", None)])
    model = langid.fit(df)
    assert model is not None and model.langs == ["en"]
    assert langid.accepted(df, model).count() == 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs, langid.fit(docs)).join(docs.where(langid.held_out()).select("doc_id", "lang"), "doc_id")
    rows = out.where("lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


# ------------------------------------------------------------------ helpers ---
def test_bit_sets_agree(spark):
    h = np.random.default_rng(0).integers(-2**63, 2**63 - 1, 500)
    df = spark.createDataFrame([(int(x),) for x in h], "h long")
    mine = BitSet(10)
    mine.add(h.view(np.uint64))
    assert (bit_set(df, "h", 10).words == mine.words).all() and mine.has(h.view(np.uint64)).all()


@pytest.mark.parametrize("bits", [7, 20])
def test_without_ids_is_exact(spark, bits):
    df = spark.createDataFrame([(i if i % 50 else None, i) for i in range(400)], "doc_id long, _x int").repartition(3)
    gone = spark.createDataFrame([(i,) for i in range(0, 400, 3)], "doc_id long")
    got = sorted(r["_x"] for r in without_ids(df, gone, "doc_id", bits).collect())
    assert got == [i for i in range(400) if i % 50 == 0 or i % 3]
    assert without_ids(df, gone.limit(0), "doc_id", bits).count() == 400


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(159, 200), (7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 100}
