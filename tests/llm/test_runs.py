"""Periodic runs against plain definitions of Lyndon words and of runs."""

import random

import numpy as np
import pytest

from chatframe.llm import runs
from conftest import by_id


def plain_lyndon(s):
    """Longest prefix of each suffix that is smaller than all of its own suffixes."""
    def lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))
    return [max(j - i for j in range(i + 1, len(s) + 1) if lyndon(s[i:j])) for i in range(len(s))]


def plain_runs(s, least):
    """Islands of equal words ``p`` apart, but those with a smaller period."""
    out = []
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            n = j + p - i
            if n >= 2 * p and not any(a <= i and i + n <= a + m for a, m, q in out if q < p):
                out.append((i, n, p))
            i = j + 1
    return sorted((r for r in out if r[1] >= least), key=lambda r: (r[0], r[2]))


def periodic(rng, n, letters):
    s = [f"w{rng.randrange(letters)}" for _ in range(n)]
    if n > 5 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 6)
        s = [s[i] if i < a else s[a + (i - a) % p] for i in range(n)]
    return s


def test_lyndon_array_under_both_orders():
    rng = random.Random(1)
    for _ in range(600):
        s = [rng.randrange(rng.randint(1, 3)) for _ in range(rng.randint(1, 14))]
        letters = sorted(set(s))
        up = [letters.index(c) for c in s]
        down = [len(letters) - 1 - c for c in up]
        assert runs.lyndon_array(up, len(letters)) == plain_lyndon(up)
        assert runs.lyndon_array(down, len(letters)) == plain_lyndon(down)


@pytest.mark.parametrize("least", [2, 3, 7, 12])
def test_runs_of_texts(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = [periodic(rng, rng.randint(0, 70), rng.randint(1, 5)) for _ in range(4)]
        for words, got in zip(texts, runs.text_runs(texts, least), strict=True):
            assert got == plain_runs(words, least)


def test_equal_hashes_decide_nothing(monkeypatch):
    """Every span hash equal: extensions go too far, and are walked anew."""
    rng = random.Random(5)
    texts = [periodic(rng, 60, 3) for _ in range(20)]
    monkeypatch.setattr(runs, "span_hash", lambda h, s, e: np.zeros(len(s), np.uint64))
    assert runs.text_runs(texts, 12) == [plain_runs(t, 12) for t in texts]


def test_operator_and_defined_cases(docs):
    rng = random.Random(3)
    long = " ".join(periodic(rng, 40_000, 30)) + "\n" + "tail of it " * 5000
    rows = [(i, " ".join(periodic(rng, rng.randint(0, 90), 4))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n\x0b\x0c\r "), (103, "é x " * 9), (104, long), (None, "a b " * 8),
             (105, "a b " * 8), (105, "a b " * 8), (106, "a b a b " * 8)]
    out = runs.periodic_runs(docs(rows, extra=True)).collect()
    assert len(out) == len(rows)
    text = {i: t for i, t in rows}
    for r in out:
        words = (text[r["doc_id"]] or "").encode().split()
        found = [(x["start"], x["length"], x["period"]) for x in r["runs"]]
        assert r["n_words"] == len(words)
        if r["doc_id"] == 104:
            assert (40_000, 15_000, 3) in [(max(s, 40_000), s + n - max(s, 40_000), p) for s, n, p in found]
        else:
            assert found == plain_runs(words, 12)
        gone = {i for s, n, p in found for i in range(s + p, s + n)}
        assert r["collapsed"] == b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
    one = by_id(runs.periodic_runs(docs([(1, "x y " * 6 + "z")])))[1]
    assert [tuple(r) for r in one["runs"]] == [(0, 12, 2)] and one["collapsed"] == "x y z"
    assert runs.periodic_runs(docs([])).count() == 0


def test_planted_periods(spark, docs):
    """The query's input: words from ``a`` on repeat with period ``p``."""
    import zlib

    from chatframe.llm.queries import with_periods
    rng = random.Random(7)
    rows = [(i, " ".join(f"v{rng.randrange(999)}" for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows += [(None, "a b"), (1_000, None)]
    got = by_id(with_periods(docs(rows)))
    for i, t in rows:
        h, w = 0 if i is None else zlib.crc32(str(i).encode()), (t or "").split()
        g, n = h // 10, len(w)
        if i is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert got[i]["text"] == " ".join(w[j] if j < a else w[a + (j - a) % p] for j in range(n))
        else:
            assert got[i]["text"] == t
