"""The n-gram Jaccard join against brute force over all pairs."""

import random

import numpy as np
import pytest

from chatframe.llm import ngram_join as nj


def word_sets(text, words=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, percent=90, words=3):
    sets = [word_sets(t, words) for _, t in rows]
    part = list(range(len(rows)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                part[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def changed(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(3)
        at = rng.randrange(len(out) or 1)
        if k == 0 and len(out) > 1:
            del out[at]
        elif k == 1:
            out.insert(at, f"x{rng.randrange(10 ** 6)}")
        elif out:
            out[at] = f"y{rng.randrange(10 ** 6)}"
    return out


def family(rng, first, n):
    """Texts of all sizes with near copies around the threshold, and copies."""
    rows = []
    while len(rows) < n:
        base = prose(rng, rng.choice([2, 3, 9, 11, 20, 40, 80, 150, 300]))
        group = [base]
        for _ in range(rng.randint(0, 8)):
            words = rng.choice(group)
            group.append(changed(rng, words, rng.randint(0, max(1, len(words) // 20))))
        rows += [(first + len(rows) + i, " ".join(w)) for i, w in enumerate(group)]
    rng.shuffle(rows)
    return rows


# -------------------------------------------------------------------- kernel ---
@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_bands_hold_both_partners(percent):
    tops = nj.band_tops(3000, percent)
    for a in range(1, 2500):
        i, j = np.searchsorted(tops, [a, a * 100 // percent])
        assert j - i <= 1 and nj.most_apart(a, a * 100 // percent, percent) <= tops[i] * (100 - percent) // percent


@pytest.mark.parametrize("ones", [0, 1, 99])
def test_linked_sets_share_a_key(ones):
    """Under any allocation whose thresholds sum as they have to."""
    rng, seen = np.random.default_rng(ones), 0
    bands = []
    for top in nj.band_tops(3000, 80):
        apart = top * 20 // 80
        k = min(ones, (apart + 1) // 2)
        bands.append(nj.Band(top, apart + 1 - k if apart else 0, k if apart else 0))
    for _ in range(300):
        base = rng.integers(0, 2 ** 63, int(rng.integers(1, 300)), dtype=np.uint64)
        cut, more = rng.integers(0, len(base) // 8 + 1, 2)
        a, b = np.unique(base), np.unique(np.concatenate([base[cut:], rng.integers(0, 2 ** 63, more, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if both == len(a) == len(b) or 100 * both < 80 * (len(a) + len(b) - both):
            continue
        seen += 1
        keys, of, flag = nj.signatures([a, b], bands)
        mine = {(k, f) for k, o, f in zip(keys.tolist(), of.tolist(), flag.tolist(), strict=True) if o == 0}
        assert any(o == 1 and (k, g) in mine and (f | g) & nj.OWN and not f & g & nj.LESS
                   for k, o, f in zip(keys.tolist(), of.tolist(), flag.tolist(), strict=True) for g in range(4))
    assert seen > 100


def test_allocation_follows_the_cost():
    assert nj.allocate(0, 10, 10, 5.0) == (0, 0)
    m, ones = nj.allocate(3, 100, 100, 30.0)
    assert (m, ones) == (4, 0)                       # few sets: fewest rows
    m, ones = nj.allocate(3, 10 ** 8, 10 ** 8, 30.0)
    assert ones > 0 and m + ones == 4                # many sets: chance pairs cost more than deletions


# ------------------------------------------------------------------ operator ---
@pytest.mark.parametrize("percent", [80, 90])
def test_components_equal_brute_force(docs, percent):
    rng = random.Random(percent)
    rows = family(rng, 0, 250) + [(1000 + i, t) for i, (_, t) in enumerate(family(rng, 0, 60))]
    assert got(nj.linked_texts(docs(rows, extra=True), percent=percent)) == brute(rows, percent)


def test_with_deletions_and_small_blocks(docs, monkeypatch):
    """All segments at threshold 1, and keys dealt to pairs of tiny blocks."""
    monkeypatch.setattr(nj, "allocate", lambda apart, *_: (apart + 1 - (apart + 1) // 2, (apart + 1) // 2) if apart else (0, 0))
    monkeypatch.setattr(nj, "BLOCK", 3)
    rng = random.Random(4)
    base = prose(rng, 100)
    rows = family(rng, 0, 120) + [(500 + i, " ".join(changed(rng, base, rng.randint(1, 3)))) for i in range(60)]
    assert got(nj.linked_texts(docs(rows))) == brute(rows)


def test_other_pairs_find_what_first_partners_miss(spark, docs, monkeypatch):
    """Without the first pass every link comes from the keys' pairs."""
    monkeypatch.setattr(nj, "first_partners", lambda keys: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(nj, "BLOCK", 16)
    rng = random.Random(6)
    line = " ".join(f"common{i}" for i in range(18))  # a passage that many small texts share
    rows = family(rng, 0, 120) + [(700 + i, f"{line} " + " ".join(prose(rng, rng.randint(0, 4)))) for i in range(80)]
    assert got(nj.linked_texts(docs(rows))) == brute(rows)


def test_defined_cases(docs):
    rng = random.Random(8)
    long = prose(rng, 60_000, 5000)
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (4, "One two"), (5, "one TWO"), (6, "two one"), (7, "x"), (8, "x"),
            (20, " ".join(long)), (21, " ".join(changed(rng, long, 300))), (22, " ".join(prose(rng, 60_000, 5000))),
            (9, "a b c d"), (9, "a b c d"), (10, "AÉ b c"), (11, "aé b c")]
    bridge = prose(rng, 60)
    near = changed(rng, bridge, 1)
    rows += [(30, " ".join(bridge)), (None, " ".join(near)), (None, "nobody knows this text")]
    assert got(nj.linked_texts(docs(rows))) == brute(rows)
    assert got(nj.linked_texts(docs([]))) == []
    assert got(nj.linked_texts(docs([(1, None), (2, "")]))) == [(1, 0, 1), (2, 0, 2)]
