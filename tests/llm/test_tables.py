"""Vector search, archives, the pipeline and the registered queries."""

import io
import random
import zipfile

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from chatframe.llm import queries, vptree, warc_zip
from chatframe.session import work_dir
from check_oracle import table_hash

SMOKE = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ vectors ---
def vectors(rng, n, dim=8):
    centre = rng.normal(size=(6, dim)) * 3
    return (centre[rng.integers(0, 6, n)] + rng.normal(size=(n, dim))).astype(np.float32)


def brute_nearest(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(map(float, v))), None)
    out = []
    for i, q in ok:
        if i % 20 == 0:
            found = []
            for j, x in ok:
                if j != i:
                    s = 0.0
                    for a, b in zip(q, x, strict=False):
                        s += a * b
                    found.append((-s, j))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(found)[:k])]
    return sorted(out)


def frame(spark, rows):
    return (spark.createDataFrame(rows, "vec_id long, embedding array<float>")
            .selectExpr("*", "1 as id", "2 as e", "'x' as shard", "0 as rank").repartition(3))


def test_exact_search_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 40)
    monkeypatch.setattr(vptree, "SAMPLE", 64)
    monkeypatch.setattr(vptree, "LEAF", 8)
    rng = np.random.default_rng(3)
    x = vectors(rng, 300).tolist()
    rows = list(enumerate(x)) + [(1000 + i, x[7]) for i in range(60)] + [(1060 + i, x[40]) for i in range(30)]
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [float("nan")] * 8), (2080, [None, 1.0]), (2100, [1.0, 2.0]),
             (None, x[3]), (20, x[20]), (2120, [float("inf")] * 8)]
    got = vptree.nearest(frame(spark, rows), "vec_id", "embedding", vptree.F.col("id") % 20 == 0, 5).collect()
    assert sorted(map(tuple, got)) == brute_nearest(rows, 5)


@pytest.mark.parametrize("kind", ["one-hot", "binary", "quantised"])
def test_ties_at_the_cut_go_to_smaller_ids(spark, monkeypatch, kind):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 40)
    monkeypatch.setattr(vptree, "SAMPLE", 64)
    monkeypatch.setattr(vptree, "LEAF", 8)
    monkeypatch.setattr(vptree, "PIECE", 256)
    rng = np.random.default_rng(9)
    x = {"one-hot": np.eye(120), "binary": rng.integers(0, 2, (200, 10)), "quantised": rng.integers(-2, 3, (200, 4)) / 4}[kind]
    rows = list(zip(rng.permutation(len(x)).tolist(), x.astype(np.float32).tolist(), strict=True))
    got = vptree.nearest(frame(spark, rows), "vec_id", "embedding", vptree.F.col("id") % 20 == 0, 5).collect()
    assert sorted(map(tuple, got)) == brute_nearest(rows, 5)


def test_relaxed_search_recall(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 100)
    monkeypatch.setattr(vptree, "SAMPLE", 256)
    monkeypatch.setattr(vptree, "LEAF", 8)
    rows = list(enumerate(vectors(np.random.default_rng(4), 800).tolist()))
    want = {(a, c) for a, _, c, _ in brute_nearest(rows, 10)}
    got = vptree.nearest(frame(spark, rows), "vec_id", "embedding", vptree.F.col("id") % 20 == 0, 10, factor=1.2).collect()
    assert len({(r[0], r[2]) for r in got} & want) >= 0.9 * len(want)


def test_relaxing_visits_less():
    rng = np.random.default_rng(5)
    x = vectors(rng, 2000, 4).astype(float)
    tree, seen = vptree.build(x, np.arange(len(x)), 8), {}
    for factor in (1.0, 3.0):
        found = vptree.Found(20, 5)
        count = [0]
        add = found.add
        found.add = lambda q, d, r: (count.__setitem__(0, count[0] + d.size), add(q, d, r))
        vptree.search(tree, x, x[:20], np.arange(20), found, factor)
        seen[factor] = count[0]
    assert seen[3.0] < seen[1.0] < 20 * len(x)


def test_few_or_no_vectors(spark):
    f = vptree.F.col("id") % 20 == 0
    assert vptree.nearest(frame(spark, [(0, None)]), "vec_id", "embedding", f).count() == 0
    assert vptree.nearest(frame(spark, [(0, [1.0])]), "vec_id", "embedding", f).count() == 0
    got = vptree.nearest(frame(spark, [(0, [1.0]), (1, [-2.0]), (2, [1.0])]), "vec_id", "embedding", f).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2, 1.0), (0, 2, 1, -2.0)]


# ----------------------------------------------------------------- archives ---
def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "SET_BITS", 8)  # many false hits
    rng = random.Random(1)
    body = ["<p>" + "".join(rng.choices("abcé", k=1200)) for _ in range(60)]
    pages = [(i, f"http://h/{i}", body[i % 60] if i % 3 else body[5]) for i in range(200)]
    pages += [(500, None, None), (501, "a\r\nb c", ""), (502, "u", "x" * 999), (503, "u", "x" * 999), (504, "u", "x" * 1000),
              (505, "u", "x" * 1000), (505, "u", "x" * 1000), (None, "u", "x" * 1000), (None, "v", "z" * 2000), (506, "w", "é" * 500)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr(
        "*", "1 as n", "'a' as sha", "2 as body", "3 as copies").repartition(4)
    path = work_dir(spark, "warc-test")
    warc_zip.write_archives(df, path, archive_bytes=20_000)
    got = warc_zip.read_archives(spark, path).collect()
    assert len(got) == len(pages)
    last = {}
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    for r in got:
        i = int(r["id"]) if r["id"] else None
        if r["record_type"] == "response":
            text = r["payload"].decode()
            assert i is None or len(text.encode()) < 1000 or i == last[text]
            assert r["refers_to"] is None and r["payload_bytes"] == len(text.encode())
        else:
            text = next(h for j, _, h in pages if j == i)
            assert int(r["refers_to"]) == last[text] > i and r["payload"] is None and r["payload_bytes"] >= 1000
    files = [x for x, in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").collect()]
    assert len(files) > 4
    for data in files:  # the standard library reads them too
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            assert z.testzip() is None and z.namelist() == [warc_zip.WARC_MEMBER, warc_zip.INDEX_MEMBER]


def test_no_pages_no_archives(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zip.round_trip(df).count() == 0


def test_zip_directories():
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:  # no ZIP64 records; one member is not stored
        z.writestr("a", b"hello")
        z.writestr("b", b"x" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 in a comment"
    for data in (plain.getvalue(), warc_zip.zip_archive([("a", b"hello"), ("ü", b"")])):
        z = warc_zip.ZipArchive(io.BytesIO(data), len(data))
        assert z.read("a") == b"hello" and z.read("a", 1, 3) == b"ell"
        with pytest.raises(ValueError, match="range"):
            z.read("a", 4, 3)
        with pytest.raises(ValueError, match=r".+"):
            warc_zip.ZipArchive(io.BytesIO(data[:-3]), len(data) - 3).read("a")
    with pytest.raises(ValueError, match="not stored"):
        warc_zip.ZipArchive(plain, len(plain.getvalue())).read("b")


# ----------------------------------------------------- pipeline and queries ---
def test_pipeline_stages(spark, docs):
    rng = random.Random(9)

    def prose(lang, n=80):
        pick = {"en": ["the", "and", "house", "of", "water"], "fr": ["le", "et", "maison", "de", "eau"]}[lang]
        return " ".join(rng.choice(pick) + rng.choice(["", "s", "r", "ment", "ing"]) + str(rng.randrange(9)) * (rng.random() < .1)
                        for _ in range(n))
    item = spark.read.parquet(f"{SMOKE}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(i, prose(l), l) for i, l in enumerate(["en", "fr"] * 10)]
    same = rows[3][1]
    rows += [(100, None, "en"), (101, "123 456", "en"), (102, same, "fr"), (103, same, "fr"),
             (104, prose("en") + " " + item, "en"), (105, prose("en") + " password: hunter2222", "en")]
    df = docs(rows)
    for name, stage in corpus_pipeline.STAGES:
        before = df
        df = stage(spark, df, SMOKE)
        if name != "tokenize":
            assert df.columns == before.columns and dict(df.dtypes) == dict(before.dtypes)
        kept = {r[0] for r in df.select("doc_id").collect()}
        if name == "language_id":
            assert kept == {r[0] for r in rows} - {100, 101}
        if name == "near_dedup":
            assert kept == {r[0] for r in rows} - {100, 101, 102, 103}
        if name == "remove_secrets":
            text = {r["doc_id"]: r["text"] for r in df.collect()}
            assert 104 not in text and text[105].endswith(" [SECRET]") and text[3] == same
    assert kept == set(range(20)) | {105} and [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontaminate", "remove_secrets", "tokenize"]


def test_pipeline_of_no_documents(spark, docs):
    df = docs([])
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SMOKE)
    assert df.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SMOKE)
    cur = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(cols)
    assert table_hash(df.columns, rows) == table_hash(cols, cur.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
