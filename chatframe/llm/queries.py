"""Registered queries of the subpackage: one ``opN_<name>`` per operator over
its whole table, and the DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatframe.llm import (
    bpe_fst, covertree, decontam, html_paths, langid, ngram_join, repeats, runs, secret_scan, simhash, token_counts,
    vptree, warc_zip,
)
from chatframe.llm.spark_util import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE["op6_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n,
          array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS t
        FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT rid, p, n, array_to_string(w[p:p + n - 1], ' ') AS t
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p
             FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT dw.rid, dw.p, dw.n, win.item_id FROM dw JOIN win ON dw.n = win.n AND dw.t = win.t),
cov AS (SELECT rid, count(DISTINCT q) AS n_hit
        FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hit) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN it USING (rid)"""


@register
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed",
                      F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "kept_sha256")


@register
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@register
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.secret_spans(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def n(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda x: x["kind"].isin(*secret_scan.BASE))
    return out.select("doc_id", n("assign"), n("access"), n("hex"),
                      F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                      joined(F.col("found")).alias("spans"))


@register
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_fst.round_trip(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.fit(docs))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@register
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_paths.extracted(table(spark, sf_dir, "pages"))


@register
def op5_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc_zip.round_trip(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


ORACLE["op5_warc_archives"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN strlen(h) >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(h) >= 1000 AND page_id < last THEN last END AS refers_to
FROM g"""


@register
def op1_vptree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vptree.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0,
                         k=20, factor=1.0)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLE["op1_vptree_search"] = """
WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""


def with_periods(docs: DataFrame) -> DataFrame:
    """The input that the contract of ``op13_periodic_runs`` states: doc_id and
    text, where a hash of the id makes the words of a tenth of the texts
    periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    d = d.withColumn("n", F.size("words").cast("long"))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    d = d.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    period = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    new = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), tail), " ")
    return d.select("doc_id", F.when(F.col("a").isNotNull(), new).otherwise(F.col("text")).alias("text"))


@register
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    d = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
                   F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                   F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("top.length"), -F.col("top.period")
    return d.select("doc_id", "n_runs", (-F.col("top.start")).alias("start"), length.alias("length"),
                    period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256")


# crc32 by bits; equal words of a text by distance, their islands, and of these the ones of smallest period
ORACLE["op13_periodic_runs"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
          lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END),
        4294967295) AS h FROM documents),
k AS (SELECT rid, doc_id, w, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS hit FROM d),
m AS (SELECT *, CASE WHEN hit THEN g % n END AS a FROM k),
q AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM m),
t AS (SELECT rid, doc_id, n, CASE WHEN hit THEN list_transform(range(n), lambda i:
        CASE WHEN i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END) ELSE w END AS w FROM q),
x AS (SELECT rid, unnest(w) AS v, unnest(range(n)) AS i FROM t),
e AS (SELECT a.rid, a.i, b.i - a.i AS q FROM x a JOIN x b ON a.rid = b.rid AND a.v = b.v AND b.i > a.i),
f AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS isle FROM e),
s AS (SELECT rid, q AS period, min(i) AS start, count(*) + q AS length FROM f GROUP BY rid, q, isle
      HAVING count(*) >= q AND count(*) + q >= 12),
r AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.rid = s.rid AND o.period < s.period
        AND o.start <= s.start AND o.start + o.length >= s.start + s.length)),
g AS (SELECT rid, count(*) AS n_runs, max({'l': length, 's': -start, 'p': -period}) AS top,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
      FROM r GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT x.rid, string_agg(v, ' ' ORDER BY x.i) AS c FROM x LEFT JOIN gone ON gone.rid = x.rid AND gone.i = x.i
         WHERE gone.i IS NULL GROUP BY x.rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -top.s AS start, top.l AS length, -top.p AS period,
       1000 * top.l // -top.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(c, '')) AS collapsed_sha256
FROM t LEFT JOIN g USING (rid) LEFT JOIN kept USING (rid)"""


@register
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("id") % 50 == 0)


ORACLE["op11_hard_negatives"] = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS a, a.e AS ae, a.label = c.label AND NOT (a.vec_id = c.vec_id AND a.e = c.e) AS same,
             a.label <> c.label AS other, c.vec_id AS c, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a, v c WHERE a.vec_id % 50 = 0),
p AS (SELECT a, ae, c, score, row_number() OVER (PARTITION BY a, ae ORDER BY score DESC, c) AS n FROM s WHERE same),
w AS (SELECT p.a AS anchor_id, p.ae, p.c AS positive_id, p.score AS positive_score, s.c AS negative_id, s.score AS negative_score
      FROM p JOIN s ON p.a = s.a AND p.ae = s.ae
      WHERE n <= 5 AND other AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score),
r AS (SELECT *, row_number() OVER (PARTITION BY anchor_id, ae, positive_id, positive_score
                                   ORDER BY negative_score DESC, negative_id) AS rank FROM w)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM r WHERE rank <= 3"""


@register
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_texts(table(spark, sf_dir, "documents"), words=3, percent=90)


ORACLE["op12_ngram_join"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT rid, array_to_string(w[p:p + 2], ' ') AS t
     FROM (SELECT rid, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY rid),
b AS (SELECT x.rid AS a, y.rid AS b, count(*) AS common FROM s x JOIN s y ON x.t = y.t AND x.rid <> y.rid GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM b JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b
                   WHERE 100 * common >= 90 * (na.n + nb.n - common)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS rid, min(doc_id) AS least FROM r JOIN d ON d.rid = r.b GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(c.least, doc_id)) AS component_id
FROM d LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)"""
