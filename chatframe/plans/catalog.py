"""Registered queries: one per SURVEY §2 operator group, each over the whole
driver tables, plus the DuckDB oracle SQL that must return the same rows.

Every query is ``(spark, sf_dir) -> DataFrame``; doubles are rounded to 6
digits after the final aggregate on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatframe.functions import text as tx
from chatframe.functions.prompts import DEFAULT_TEMPLATE, render_chat, render_judge_prompt, to_messages
from chatframe.operators import context as ctx
from chatframe.operators import judging as jd
from chatframe.operators import sampling as sp
from chatframe.operators import tokens as tk
from chatframe.plans import sqltext as q
from chatframe.sources import fixtures as fx
from chatframe.sources.tables import table

SEED = 42
SAMPLE_K = 10
HISTORY_BUDGET = 200
MAX_SEQ_LEN = 1024

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def r6c(c: F.Column) -> F.Column:
    return F.round(c, 6)


# ---------------------------------------------------------------- judging ---
def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = fx.judge_replies(spark, sf_dir).drop("base_is_a")
    return jd.score_replies(replies.withColumn("base_is_a", jd.ab_coin(SEED)))


@register("judge_details", q.with_views("SELECT * FROM judge_details", "judge_details"))
def judge_details(spark, sf_dir):
    return judged(spark, sf_dir).select(
        "sample_id", "base_is_a", "error", "base_correctness", "lora_correctness",
        "base_completeness", "lora_completeness")


_SCOREBOARD_SQL = q.with_views("""
SELECT dimension, round(base, 6) AS base, round(lora, 6) AS lora, round(lora - base, 6) AS diff FROM (
  SELECT 'correctness' AS dimension, coalesce(avg(base_correctness), 0) AS base,
         coalesce(avg(lora_correctness), 0) AS lora FROM judge_details
  UNION ALL
  SELECT 'completeness', coalesce(avg(base_completeness), 0), coalesce(avg(lora_completeness), 0)
  FROM judge_details) s""", "judge_details")


@register("judge_scoreboard", _SCOREBOARD_SQL)
def judge_scoreboard(spark, sf_dir):
    long = jd.scoreboard_long(jd.scoreboard_wide(judged(spark, sf_dir)))
    return long.select("dimension", r6("base").alias("base"), r6("lora").alias("lora"),
                       r6("diff").alias("diff"))


_TOTAL_SQL = q.with_views("""
SELECT round((coalesce(sum(base_correctness), 0) + coalesce(sum(base_completeness), 0))
             / (2 * greatest(count(base_correctness), 1)), 6) AS base_total,
       round((coalesce(sum(lora_correctness), 0) + coalesce(sum(lora_completeness), 0))
             / (2 * greatest(count(lora_correctness), 1)), 6) AS lora_total,
       count(*) FILTER (WHERE error IS NULL) AS n_evaluated,
       count(*) FILTER (WHERE error IS NOT NULL) AS n_failed
FROM judge_details""", "judge_details")


@register("judge_total", _TOTAL_SQL)
def judge_total(spark, sf_dir):
    w = jd.scoreboard_wide(judged(spark, sf_dir))
    return w.select(r6("base_total").alias("base_total"), r6("lora_total").alias("lora_total"),
                    "n_evaluated", "n_failed")


@register("ab_assignment", q.with_views("""
SELECT sample_id, substr(md5(concat('42:ab:', CAST(sample_id AS VARCHAR))), 1, 1) >= '8' AS base_is_a,
       CASE WHEN substr(md5(concat('42:ab:', CAST(sample_id AS VARCHAR))), 1, 1) >= '8'
            THEN base_answer ELSE lora_answer END AS answer_a,
       CASE WHEN substr(md5(concat('42:ab:', CAST(sample_id AS VARCHAR))), 1, 1) >= '8'
            THEN lora_answer ELSE base_answer END AS answer_b
FROM answers""", "answers"))
def ab_assignment(spark, sf_dir):
    return jd.assign_ab(fx.answers(spark, sf_dir), SEED).select(
        "sample_id", "base_is_a", "answer_a", "answer_b")


_JP = q.judge_prompt("question", "reference", "answer_a", "answer_b")


@register("judge_prompt", q.with_views(f"""
SELECT sample_id, base_is_a, md5({_JP}) AS prompt_md5, CAST(length({_JP}) AS BIGINT) AS prompt_len
FROM (SELECT *, CASE WHEN base_is_a THEN base_answer ELSE lora_answer END AS answer_a,
                CASE WHEN base_is_a THEN lora_answer ELSE base_answer END AS answer_b
      FROM (SELECT *, substr(md5(concat('42:ab:', CAST(sample_id AS VARCHAR))), 1, 1) >= '8' AS base_is_a
            FROM answers) a) b""", "answers"))
def judge_prompt(spark, sf_dir):
    a = jd.assign_ab(fx.answers(spark, sf_dir), SEED)
    p = render_judge_prompt()
    return a.select("sample_id", "base_is_a", F.md5(p).alias("prompt_md5"),
                    F.length(p).cast("bigint").alias("prompt_len"))


# --------------------------------------------------------------- sampling ---
@register("sample_k", q.with_views(f"""
SELECT sample_id, instruction, input, output FROM sft
ORDER BY md5(concat('{SEED}:', CAST(sample_id AS VARCHAR))), sample_id LIMIT {SAMPLE_K}""", "sft"))
def sample_k(spark, sf_dir):
    return sp.sample_k(fx.sft(spark, sf_dir), SAMPLE_K, SEED)


@register("sample_positions", q.with_views(f"""
SELECT * FROM (SELECT row_number() OVER (ORDER BY md5(concat('{SEED}:', CAST(sample_id AS VARCHAR))), sample_id) AS position, *
               FROM sft) s WHERE position <= 100""", "sft"))
def sample_positions(spark, sf_dir):
    """C1 with each row's place, so that the order of the sample is kept."""
    return sp.sample_k(fx.sft(spark, sf_dir), 100, SEED, position="position")


@register("question_list", q.with_views("""
SELECT row_number() OVER (ORDER BY question) AS question_id, question
FROM (SELECT DISTINCT input AS question FROM sft) s""", "sft"))
def question_list(spark, sf_dir):
    """A2 over the questions of the conversations."""
    from chatframe.sources.readers import questions
    return questions(spark, fx.sft(spark, sf_dir), column="input")


@register("row_counts", q.with_views("""
SELECT 'conversations' AS source, count(*) AS n FROM conversations UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'sft', count(*) FROM sft""", "sft"))
def row_counts(spark, sf_dir):
    """A4: the number of rows of three sources."""
    from chatframe.sources.readers import row_count
    sources = {"conversations": fx.conversations(spark, sf_dir), "documents": table(spark, sf_dir, "documents"),
               "sft": fx.sft(spark, sf_dir)}
    return spark.createDataFrame([(name, row_count(df)) for name, df in sources.items()], "source string, n long")


@register("select_ids", q.with_views("""
SELECT * FROM sft s
WHERE EXISTS (SELECT 1 FROM labels l WHERE concat(l.doc_id // 100, ':', l.doc_id % 100) = s.sample_id)""", "sft"))
def select_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select(_label_key().alias("sample_id"))
    return sp.select_ids(fx.sft(spark, sf_dir), ids)


def _label_key():
    d = F.col("doc_id")
    return F.concat_ws(":", F.floor(d / 100).cast("string"), (d % 100).cast("string"))


@register("replay_ids", q.with_views("""
SELECT l.doc_id AS position, s.* FROM labels l JOIN sft s
  ON concat(l.doc_id // 100, ':', l.doc_id % 100) = s.sample_id""", "sft"))
def replay_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select(_label_key().alias("sample_id"), F.col("doc_id").alias("position"))
    return sp.select_ids(fx.sft(spark, sf_dir), ids, position="position")


@register("sft_from_conversations", q.with_views("SELECT * FROM sft", "sft"))
def sft_from_conversations(spark, sf_dir):
    return fx.sft(spark, sf_dir)


# ---------------------------------------------------------------- prompts ---
_SFT_TEXT = q.render([("'system'", "instruction"), ("'user'", "input"), ("'assistant'", "output")], False)


@register("sft_text", q.with_views(f"SELECT sample_id, {_SFT_TEXT} AS text FROM sft", "sft"))
def sft_text(spark, sf_dir):
    s = fx.sft(spark, sf_dir)
    return s.select("sample_id", render_chat(to_messages("sft"), DEFAULT_TEMPLATE).alias("text"))


_GEN_PROMPT = q.render([("'system'", "instruction"), ("'user'", "input")], True)


@register("generation_prompt", q.with_views(f"SELECT sample_id, {_GEN_PROMPT} AS prompt FROM sft", "sft"))
def generation_prompt(spark, sf_dir):
    s = fx.sft(spark, sf_dir)
    return s.select("sample_id", render_chat(to_messages("system_user"), DEFAULT_TEMPLATE,
                                             add_generation_prompt=True).alias("prompt"))


# ----------------------------------------------------------------- tokens ---
@register("token_counts", f"""
SELECT conv_id, turn, {q.count_words('text')} AS n_tokens FROM conversations""")
def token_counts(spark, sf_dir):
    c = fx.conversations(spark, sf_dir)
    return c.select("conv_id", "turn", tk.count_tokens("text").alias("n_tokens"))


@register("length_profile", f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE n > {MAX_SEQ_LEN}) AS n_over,
       CAST(sum(greatest(n - {MAX_SEQ_LEN}, 0)) AS BIGINT) AS tokens_cut,
       min(n) AS min_len, max(n) AS max_len, round(avg(n), 6) AS avg_len,
       round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90,
       round(quantile_cont(n, 0.99), 6) AS p99
FROM (SELECT {q.count_words('text')} AS n FROM documents) d""")
def length_profile(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(tk.count_tokens("text").alias("n"))
    p = tk.length_profile(d, "n", MAX_SEQ_LEN)
    return p.select("n_rows", "n_over", "tokens_cut", "min_len", "max_len",
                    *[r6(c).alias(c) for c in ("avg_len", "p50", "p90", "p99")])


@register("new_tokens", f"""
SELECT doc_id, CAST(len(nw) AS BIGINT) AS n_new, md5(array_to_string(nw, ' ')) AS new_md5
FROM (SELECT doc_id, list_slice(w, CAST(doc_id % 40 AS BIGINT) + 1, len(w)) AS nw
      FROM (SELECT doc_id, {q.words('text')} AS w FROM documents) a) b""")
def new_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    nw = tx.new_tokens(tx.words("text"), (F.col("doc_id") % 40).cast("int"))
    return d.select("doc_id", nw.alias("nw")).select(
        "doc_id", F.size("nw").cast("bigint").alias("n_new"),
        F.md5(F.array_join("nw", " ")).alias("new_md5"))


@register("truncate_tokens", f"""
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, CAST(len(list_slice(w, 1, {MAX_SEQ_LEN})) AS BIGINT) AS n_kept,
       len(w) > {MAX_SEQ_LEN} AS truncated, md5(array_to_string(list_slice(w, 1, {MAX_SEQ_LEN}), ' ')) AS kept_md5
FROM (SELECT doc_id, {q.words('text')} AS w FROM documents) a""")
def truncate_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", tx.words("text").alias("w"))
    t = tk.truncate_tokens(d, "w", MAX_SEQ_LEN)
    return t.select("doc_id", F.size("w").cast("bigint").alias("n_tokens"),
                    F.size("w_kept").cast("bigint").alias("n_kept"), "truncated",
                    F.md5(F.array_join("w_kept", " ")).alias("kept_md5"))


@register("text_clean", f"""
SELECT doc_id, CAST(length(s) AS BIGINT) AS stripped_len, left(s, 200) AS cut_200,
       concat(left(s, 60), '...') AS preview_60,
       CASE WHEN length(s) > 200 THEN concat(left(s, 200), '...') ELSE s END AS preview_200,
       CAST(length(text) AS BIGINT) AS valid_len
FROM (SELECT doc_id, text, {q.strip('text')} AS s FROM documents) d""")
def text_clean(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("s", tx.py_strip("text"))
    return d.select("doc_id", F.length("s").cast("bigint").alias("stripped_len"),
                    tx.cut("s", 200).alias("cut_200"),
                    tx.preview("s", 60, always=True).alias("preview_60"),
                    tx.preview("s", 200).alias("preview_200"),
                    F.length(tx.sanitize("text")).cast("bigint").alias("valid_len"))


# ---------------------------------------------------------- conversations ---
_TOK = f"SELECT conv_id, turn, role, text, {q.count_words('text')} AS n FROM conversations"


@register("clip_history", q.with_views(f"""
SELECT conv_id, turn, role, n AS n_tokens FROM (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS suffix
  FROM tok) x
WHERE suffix <= {HISTORY_BUDGET}""", extra=[("tok", _TOK)]))
def clip_history(spark, sf_dir):
    c = ctx.clip_history(fx.conversations(spark, sf_dir), HISTORY_BUDGET)
    return c.select("conv_id", "turn", "role", "n_tokens")


_CUM = "SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS cum FROM tok"


@register("context_at_turn", q.with_views(f"""
SELECT t.conv_id, t.turn, t.role, min(i.turn) AS first_turn, count(i.turn) AS n_messages,
       CAST(coalesce(sum(i.n), 0) AS BIGINT) AS n_tokens
FROM c t LEFT JOIN c i
  ON i.conv_id = t.conv_id AND i.turn <= t.turn AND t.cum - i.cum + i.n <= {HISTORY_BUDGET}
GROUP BY t.conv_id, t.turn, t.role""", extra=[("tok", _TOK), ("c", _CUM)]))
def context_at_turn(spark, sf_dir):
    return ctx.context_at_turn(fx.conversations(spark, sf_dir), HISTORY_BUDGET)


_SESSION = f"""SELECT conv_id, turn, role,
       CASE WHEN role = 'user' THEN {q.strip('text')} ELSE text END AS text FROM (
  SELECT *, max(CASE WHEN role = 'user' AND lower({q.strip('text')}) IN ('exit', 'quit') THEN 1 ELSE 0 END)
              OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
  FROM {{src}}) x
WHERE stopped = 0 AND NOT (role = 'user' AND {q.strip('text')} = '')"""


@register("session_until_exit", q.with_views(
    "SELECT * FROM sess", "turns_with_exit",
    extra=[("sess", _SESSION.replace("{src}", "turns_with_exit"))]))
def session_until_exit(spark, sf_dir):
    return ctx.session_filter(fx.turns_with_exit(spark, sf_dir))


_PROMPT_MSG = q.message("i.role", "i.text")


@register("turn_prompts", q.with_views(f"""
SELECT t.conv_id, t.turn, count(i.turn) AS n_messages,
       concat({q.lit(DEFAULT_TEMPLATE.bos)},
              coalesce(string_agg({_PROMPT_MSG}, '' ORDER BY i.turn), ''),
              {q.lit(DEFAULT_TEMPLATE.generation_prompt())}) AS prompt
FROM c t LEFT JOIN c i
  ON i.conv_id = t.conv_id AND i.turn <= t.turn AND t.cum - i.cum + i.n <= {HISTORY_BUDGET}
WHERE t.role = 'user'
GROUP BY t.conv_id, t.turn""", "turns_with_exit", extra=[
    ("sess", _SESSION.replace("{src}", "turns_with_exit")),
    ("tok", f"SELECT conv_id, turn, role, text, {q.count_words('text')} AS n FROM sess"),
    ("c", _CUM)]))
def turn_prompts(spark, sf_dir):
    return ctx.prompts_for_turns(fx.turns_with_exit(spark, sf_dir), HISTORY_BUDGET)


# ------------------------------------------------------- answers / reports ---
@register("answers_wide", q.with_views("""
SELECT sample_id, max(CASE WHEN variant = 'base' THEN answer END) AS base_answer,
       max(CASE WHEN variant = 'lora' THEN answer END) AS lora_answer
FROM answers_long GROUP BY sample_id""", "answers_long"))
def answers_wide(spark, sf_dir):
    from chatframe.operators.reports import attach_variants
    return attach_variants(fx.answers_long(spark, sf_dir))


@register("side_by_side", q.with_views("""
SELECT row_number() OVER (ORDER BY sample_id) AS question_no, sample_id, question,
       CASE WHEN length(base_answer) > 200 THEN concat(left(base_answer, 200), '...') ELSE base_answer END AS base_preview,
       CASE WHEN length(lora_answer) > 200 THEN concat(left(lora_answer, 200), '...') ELSE lora_answer END AS lora_preview
FROM answers""", "answers"))
def side_by_side(spark, sf_dir):
    from chatframe.operators.reports import side_by_side as sbs
    return sbs(fx.answers(spark, sf_dir))


# -------------------------------------------------------------- bertscore ---
def pair_scores(spark, sf_dir):
    from chatframe.operators.bertscore import bertscore
    return bertscore(fx.token_pairs(spark, sf_dir))


_BS_SQL = """
c AS (SELECT pair_id, side AS variant, tok_id, CAST(vec AS DOUBLE[]) AS vec FROM token_pairs WHERE side <> 'ref'),
r AS (SELECT pair_id, tok_id, CAST(vec AS DOUBLE[]) AS vec FROM token_pairs WHERE side = 'ref'),
s AS (SELECT c.pair_id, c.variant, c.tok_id AS ct, r.tok_id AS rt, list_cosine_similarity(c.vec, r.vec) AS sim
      FROM c JOIN r ON c.pair_id = r.pair_id),
pp AS (SELECT pair_id, variant, avg(m) AS precision FROM
         (SELECT pair_id, variant, ct, max(sim) AS m FROM s GROUP BY pair_id, variant, ct) x GROUP BY pair_id, variant),
rr AS (SELECT pair_id, variant, avg(m) AS recall FROM
         (SELECT pair_id, variant, rt, max(sim) AS m FROM s GROUP BY pair_id, variant, rt) x GROUP BY pair_id, variant),
scores AS (SELECT pp.pair_id, pp.variant, precision, recall,
           CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1
           FROM pp JOIN rr ON pp.pair_id = rr.pair_id AND pp.variant = rr.variant),
diffs AS (SELECT pair_id, max(CASE WHEN variant = 'base' THEN f1 END) AS base_f1,
                 max(CASE WHEN variant = 'lora' THEN f1 END) AS lora_f1
          FROM scores GROUP BY pair_id),
d AS (SELECT *, lora_f1 - base_f1 AS f1_diff FROM diffs)"""


def _bs(body: str, *views: str) -> str:
    return q.with_views(body, "token_pairs", *views, extra=[("bs_dummy", "SELECT 1")]).replace(
        "bs_dummy AS (\nSELECT 1\n)", _BS_SQL.strip())


@register("bertscore_pairs", _bs("""
SELECT pair_id, variant, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM scores"""))
def bertscore_pairs(spark, sf_dir):
    s = pair_scores(spark, sf_dir)
    return s.select("pair_id", "variant", r6("precision").alias("precision"),
                    r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("bertscore_blocks", ORACLE["bertscore_pairs"])
def bertscore_blocks(spark, sf_dir):
    """The same pairs in blocks of 3 ids, so that every pair has several."""
    from chatframe.operators.bertscore import bertscore
    s = bertscore(fx.token_pairs(spark, sf_dir), block=3)
    return s.select("pair_id", "variant", r6("precision").alias("precision"),
                    r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("bertscore_tiles", ORACLE["bertscore_pairs"])
def bertscore_tiles(spark, sf_dir):
    """The same pairs as grids of tiles of 4 x 4 ids, in blocks of 2."""
    from chatframe.operators.bertscore import bertscore
    s = bertscore(fx.token_pairs(spark, sf_dir), block=2, tile=4)
    return s.select("pair_id", "variant", r6("precision").alias("precision"),
                    r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("bertscore_rows", ORACLE["bertscore_pairs"])
def bertscore_rows(spark, sf_dir):
    """The same pairs with each side's vectors in one row, without Python."""
    from chatframe.operators.bertscore import bertscore_rows as rows
    side = [F.collect_list(F.when(F.col("side") == s, F.col("vec"))).alias(s) for s in ("base", "lora", "ref")]
    s = rows(fx.token_pairs(spark, sf_dir).groupBy("pair_id").agg(*side))
    return s.select("pair_id", "variant", r6("precision").alias("precision"),
                    r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("bertscore_summary", _bs("""
SELECT variant, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM (
  SELECT variant, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM scores GROUP BY variant
  UNION ALL
  SELECT 'delta', avg(CASE WHEN variant = 'lora' THEN precision END) - avg(CASE WHEN variant = 'base' THEN precision END),
         avg(CASE WHEN variant = 'lora' THEN recall END) - avg(CASE WHEN variant = 'base' THEN recall END),
         avg(CASE WHEN variant = 'lora' THEN f1 END) - avg(CASE WHEN variant = 'base' THEN f1 END)
  FROM scores) x"""))
def bertscore_summary(spark, sf_dir):
    from chatframe.operators.bertscore import summary
    s = summary(pair_scores(spark, sf_dir))
    return s.select("variant", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"))


def _ranked_sql(desc: bool) -> str:
    o = "DESC" if desc else "ASC"
    return _bs(f"""
SELECT CAST(row_number() OVER (ORDER BY f1_diff {o}, pair_id) AS INT) AS rank, pair_id,
       round(base_f1, 6) AS base_f1, round(lora_f1, 6) AS lora_f1, round(f1_diff, 6) AS f1_diff
FROM (SELECT * FROM d ORDER BY f1_diff {o}, pair_id LIMIT 3) t""")


def _ranked(spark, sf_dir, desc: bool):
    from chatframe.operators.bertscore import f1_diffs
    from chatframe.operators.reports import top_k
    t = top_k(f1_diffs(pair_scores(spark, sf_dir)), "f1_diff", 3, descending=desc)
    return t.select(F.col("rank").cast("int").alias("rank"), "pair_id",
                    r6("base_f1").alias("base_f1"), r6("lora_f1").alias("lora_f1"),
                    r6("f1_diff").alias("f1_diff"))


@register("bertscore_top", _ranked_sql(True))
def bertscore_top(spark, sf_dir):
    return _ranked(spark, sf_dir, True)


@register("bertscore_bottom", _ranked_sql(False))
def bertscore_bottom(spark, sf_dir):
    return _ranked(spark, sf_dir, False)


@register("ranked_few", _bs("""
SELECT CAST(row_number() OVER (ORDER BY f1_diff, pair_id) AS INT) AS rank, pair_id, round(f1_diff, 6) AS f1_diff
FROM d"""))
def ranked_few(spark, sf_dir):
    """J3 without a cap: every pair from the largest loss to the largest gain."""
    from chatframe.operators.bertscore import f1_diffs
    pairs = f1_diffs(pair_scores(spark, sf_dir))
    t = sp.number_rows(pairs.withColumn("at", F.struct("f1_diff", "pair_id")), "at", name="rank")
    return t.select(F.col("rank").cast("int").alias("rank"), "pair_id", r6("f1_diff").alias("f1_diff"))


@register("ranked_variants", _bs("""
SELECT CAST(row_number() OVER (ORDER BY f1 DESC, variant) AS INT) AS rank, variant, round(f1, 6) AS f1 FROM (
  SELECT variant, avg(f1) AS f1 FROM scores GROUP BY variant
  UNION ALL
  SELECT 'delta', avg(CASE WHEN variant = 'lora' THEN f1 END) - avg(CASE WHEN variant = 'base' THEN f1 END)
  FROM scores) x"""))
def ranked_variants(spark, sf_dir):
    """More rows are asked for than the three of the summary over all pairs."""
    from chatframe.operators.bertscore import summary
    from chatframe.operators.reports import top_k
    t = top_k(summary(pair_scores(spark, sf_dir)), "f1", 10, tiebreak="variant")
    return t.select(F.col("rank").cast("int").alias("rank"), "variant", r6("f1").alias("f1"))


@register("bertscore_report", _bs("""
SELECT CASE variant WHEN 'base' THEN 'Base Model' WHEN 'lora' THEN 'LoRA Model' ELSE '提升幅度' END AS label,
       CASE WHEN variant = 'delta' THEN printf('%+.4f', precision) ELSE printf('%.4f', precision) END AS precision,
       CASE WHEN variant = 'delta' THEN printf('%+.4f', recall) ELSE printf('%.4f', recall) END AS recall,
       CASE WHEN variant = 'delta' THEN printf('%+.4f', f1) ELSE printf('%.4f', f1) END AS f1
FROM (
  SELECT variant, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM scores GROUP BY variant
  UNION ALL
  SELECT 'delta', avg(CASE WHEN variant = 'lora' THEN precision END) - avg(CASE WHEN variant = 'base' THEN precision END),
         avg(CASE WHEN variant = 'lora' THEN recall END) - avg(CASE WHEN variant = 'base' THEN recall END),
         avg(CASE WHEN variant = 'lora' THEN f1 END) - avg(CASE WHEN variant = 'base' THEN f1 END)
  FROM scores) x"""))
def bertscore_report(spark, sf_dir):
    from chatframe.operators.bertscore import summary
    from chatframe.operators.reports import bertscore_report_table
    return bertscore_report_table(summary(pair_scores(spark, sf_dir)))


# -------------------------------------------------------------- inference ---
STUB_NEW_TOKENS = 16


@register("generate_stub", q.with_views(f"""
SELECT sample_id, 'base' AS variant, array_to_string(list_slice(w, 1, {STUB_NEW_TOKENS}), ' ') AS answer FROM p
UNION ALL
SELECT sample_id, 'lora' AS variant,
       array_to_string(list_slice(w, greatest(len(w) - {STUB_NEW_TOKENS - 1}, 1), len(w)), ' ') AS answer FROM p""",
    "sft", extra=[("p", f"SELECT sample_id, {q.words(_GEN_PROMPT)} AS w FROM sft")]))
def generate_stub(spark, sf_dir):
    from chatframe.operators.inference import generate_variants
    from chatframe.sources.standins import EchoModel
    s = fx.sft(spark, sf_dir).select(
        "sample_id", render_chat(to_messages("system_user"), DEFAULT_TEMPLATE,
                                 add_generation_prompt=True).alias("prompt"))
    return generate_variants(s, {"base": EchoModel, "lora": lambda: EchoModel(tail=True)},
                             max_new_tokens=STUB_NEW_TOKENS)


@register("judge_stub", q.with_views(f"""
SELECT sample_id, base_is_a, CAST(NULL AS VARCHAR) AS error,
       CAST(CASE WHEN base_is_a THEN 1 + n % 10 ELSE 1 + (n // 100) % 10 END AS DOUBLE) AS base_correctness,
       CAST(CASE WHEN base_is_a THEN 1 + (n // 100) % 10 ELSE 1 + n % 10 END AS DOUBLE) AS lora_correctness,
       CAST(CASE WHEN base_is_a THEN 1 + (n // 10) % 10 ELSE 1 + (n // 7) % 10 END AS DOUBLE) AS base_completeness,
       CAST(CASE WHEN base_is_a THEN 1 + (n // 7) % 10 ELSE 1 + (n // 10) % 10 END AS DOUBLE) AS lora_completeness
FROM (SELECT sample_id, base_is_a, length({_JP}) AS n
      FROM (SELECT *, CASE WHEN base_is_a THEN base_answer ELSE lora_answer END AS answer_a,
                      CASE WHEN base_is_a THEN lora_answer ELSE base_answer END AS answer_b
            FROM (SELECT *, substr(md5(concat('42:ab:', CAST(sample_id AS VARCHAR))), 1, 1) >= '8' AS base_is_a
                  FROM answers) a) b) c""", "answers"))
def judge_stub(spark, sf_dir):
    from chatframe.functions.prompts import judge_messages
    from chatframe.operators.inference import judge
    from chatframe.sources.standins import length_judge
    a = jd.assign_ab(fx.answers(spark, sf_dir), SEED)
    calls = a.select("sample_id", "base_is_a",
                     judge_messages(render_judge_prompt()).alias("messages"))
    replies = judge(calls, length_judge, model="stand-in", min_interval_s=0.0,
                    keep=("sample_id", "base_is_a"))
    return jd.score_replies(replies).select(
        "sample_id", "base_is_a", "error", "base_correctness", "lora_correctness",
        "base_completeness", "lora_completeness")


@register("judge_resume", q.with_views("""
SELECT sample_id, question FROM answers a
WHERE NOT EXISTS (SELECT 1 FROM judge_details j WHERE j.sample_id = a.sample_id AND j.error IS NULL)""",
    "answers", "judge_details"))
def judge_resume(spark, sf_dir):
    from chatframe.operators.inference import materialize, pending
    from chatframe.session import work_dir
    # resume compares against the *stored* judgements (written once, read back)
    done = materialize(judged(spark, sf_dir).select("sample_id", "error"), work_dir(spark, "judged"))
    return pending(fx.answers(spark, sf_dir), done).select("sample_id", "question")


@register("judge_runs", q.with_views("""
SELECT run_id, count(*) AS n_rows, count(*) FILTER (WHERE error IS NULL) AS n_evaluated,
       round(avg(base_correctness), 6) AS base_correctness, round(avg(lora_correctness), 6) AS lora_correctness
FROM (SELECT 'first' AS run_id, * FROM judge_details UNION ALL SELECT 'second', * FROM judge_details WHERE base_is_a) r
GROUP BY run_id""", "judge_details"))
def judge_runs(spark, sf_dir):
    """Two runs in one table; the first is stored twice and counts once."""
    from chatframe.operators.inference import read_run, store_run
    from chatframe.session import work_dir
    scored, path = judged(spark, sf_dir), work_dir(spark, "runs")
    for run_id, rows in (("first", scored), ("second", scored.where("base_is_a")), ("first", scored)):
        kept = store_run(rows, path, run_id)
    return read_run(spark, path, kept.drop("run_id").schema).groupBy("run_id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("error").isNull()).alias("n_evaluated"),
        r6c(F.avg("base_correctness")).alias("base_correctness"), r6c(F.avg("lora_correctness")).alias("lora_correctness"))


@register("judge_rounds", ORACLE["judge_stub"])
def judge_rounds(spark, sf_dir):
    """The calls of ``judge_stub`` in stored rounds, two at a time; a second
    round of asking finds nothing left to call."""
    from chatframe.functions.prompts import judge_messages
    from chatframe.operators.inference import judge_stored
    from chatframe.session import work_dir
    from chatframe.sources.standins import length_judge
    a = jd.assign_ab(fx.answers(spark, sf_dir), SEED)
    calls = a.select("sample_id", "base_is_a", judge_messages(render_judge_prompt()).alias("messages"))
    path = work_dir(spark, "judged")
    for _ in range(2):
        replies = judge_stored(calls, path, length_judge, "stand-in", keep=("sample_id", "base_is_a"), min_interval_s=0.0,
                               concurrency=2, round_rows=1000)
    return jd.score_replies(replies).select("sample_id", "base_is_a", "error", "base_correctness", "lora_correctness",
                                            "base_completeness", "lora_completeness")


_BT_WORDS = {c: q.words(c) for c in ("base_answer", "lora_answer", "reference")}
_BT = [
    ("toks", f"""SELECT sample_id AS pair_id, 'base' AS side, unnest({_BT_WORDS['base_answer']}) AS w FROM answers
UNION ALL SELECT sample_id, 'lora', unnest({_BT_WORDS['lora_answer']}) FROM answers
UNION ALL SELECT sample_id, 'ref', unnest({_BT_WORDS['reference']}) FROM answers"""),
    ("bk", "SELECT pair_id, side, substr(md5(w), 1, 1) AS b FROM toks"),
    ("refb", "SELECT DISTINCT pair_id, b FROM bk WHERE side = 'ref'"),
    ("candb", "SELECT DISTINCT pair_id, side, b FROM bk WHERE side <> 'ref'"),
    ("grid", "SELECT sample_id AS pair_id, variant FROM answers, (VALUES ('base'), ('lora')) v(variant)"),
    ("has", "SELECT DISTINCT pair_id, side FROM bk"),
    ("p", """SELECT c.pair_id, c.side AS variant, avg(CASE WHEN r.b IS NULL THEN 0.0 ELSE 1.0 END) AS precision
FROM bk c LEFT JOIN refb r ON r.pair_id = c.pair_id AND r.b = c.b
WHERE c.side <> 'ref' GROUP BY 1, 2"""),
    ("rc", """SELECT r.pair_id, v.side AS variant, avg(CASE WHEN cb.b IS NULL THEN 0.0 ELSE 1.0 END) AS recall
FROM bk r JOIN has v ON v.pair_id = r.pair_id AND v.side <> 'ref'
LEFT JOIN candb cb ON cb.pair_id = r.pair_id AND cb.side = v.side AND cb.b = r.b
WHERE r.side = 'ref' GROUP BY 1, 2"""),
    ("ts", """SELECT g.pair_id, g.variant, coalesce(p.precision, 0) AS precision, coalesce(rc.recall, 0) AS recall,
  CASE WHEN coalesce(p.precision, 0) + coalesce(rc.recall, 0) = 0 THEN 0
       ELSE 2 * coalesce(p.precision, 0) * coalesce(rc.recall, 0) / (coalesce(p.precision, 0) + coalesce(rc.recall, 0)) END AS f1
FROM grid g LEFT JOIN p ON p.pair_id = g.pair_id AND p.variant = g.variant
LEFT JOIN rc ON rc.pair_id = g.pair_id AND rc.variant = g.variant"""),
    ("td", """SELECT *, lora_f1 - base_f1 AS f1_diff FROM (
  SELECT pair_id, max(CASE WHEN variant = 'base' THEN f1 END) AS base_f1,
         max(CASE WHEN variant = 'lora' THEN f1 END) AS lora_f1 FROM ts GROUP BY pair_id) x"""),
]


def _bt(body: str) -> str:
    return q.with_views(body, "answers", extra=_BT)


def text_scores(spark, sf_dir, a: DataFrame) -> DataFrame:
    """K1 of every answer row from its own tokens, encoded once and stored."""
    from chatframe.operators.bertscore import bertscore
    from chatframe.operators.inference import encode_tokens, materialize
    from chatframe.session import work_dir
    from chatframe.sources.standins import bucket_encoder
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("text"))
                      for s, c in (("base", "base_answer"), ("lora", "lora_answer"), ("ref", "reference"))])
    texts = a.select(F.col("sample_id").alias("pair_id"), F.explode(sides).alias("t")) \
             .select("pair_id", "t.side", "t.text")
    toks = materialize(encode_tokens(texts, bucket_encoder), work_dir(spark, "tokens"))
    return bertscore(toks, pairs=a.select(F.col("sample_id").alias("pair_id")))


@register("bertscore_text", _bt("""
SELECT pair_id, variant, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM ts"""))
def bertscore_text(spark, sf_dir):
    s = text_scores(spark, sf_dir, fx.answers(spark, sf_dir))
    return s.select("pair_id", "variant", r6("precision").alias("precision"),
                    r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("bertscore_details", _bt("""
SELECT d.pair_id, a.question, left(a.reference, 200) AS reference, left(a.base_answer, 200) AS base_pred,
       left(a.lora_answer, 200) AS lora_pred, round(d.base_f1, 6) AS base_f1, round(d.lora_f1, 6) AS lora_f1,
       round(d.f1_diff, 6) AS f1_diff
FROM answers a JOIN td d ON a.sample_id = d.pair_id"""))
def bertscore_details(spark, sf_dir):
    from chatframe.operators.bertscore import result_details
    a = fx.answers(spark, sf_dir)
    d = result_details(a, text_scores(spark, sf_dir, a))
    return d.select("pair_id", "question", *[tx.cut(c, 200).alias(c) for c in ("reference", "base_pred", "lora_pred")],
                    *[r6(c).alias(c) for c in ("base_f1", "lora_f1", "f1_diff")])


@register("bertscore_document", _bt("""
SELECT count(*) AS n, round(avg(base_f1), 6) AS base_f1, round(avg(lora_f1), 6) AS lora_f1 FROM td"""))
def bertscore_document(spark, sf_dir):
    """B3 written in document form and read back line by line."""
    from chatframe.operators.bertscore import result_details
    from chatframe.session import work_dir
    from chatframe.sources.writers import write_bertscore_results
    a = fx.answers(spark, sf_dir)
    d = result_details(a, text_scores(spark, sf_dir, a))
    path = work_dir(spark, "bertscore-document")
    write_bertscore_results(d, {"num_samples": None}, path, document=True)
    lines = spark.read.text(path).where("value rlike '^,?.\"question\"'")
    row = F.from_json(F.regexp_replace("value", "^,", ""), "base_f1 double, lora_f1 double")
    return lines.select(row.alias("r")).agg(F.count("*").alias("n"), r6c(F.avg("r.base_f1")).alias("base_f1"),
                                            r6c(F.avg("r.lora_f1")).alias("lora_f1"))


# ---------------------------------------------------------------- reports ---
@register("judge_report", q.with_views("""
SELECT label, printf('%.2f', base) AS base, printf('%.2f', lora) AS lora, printf('%+.2f', lora - base) AS diff FROM (
  SELECT '正確性' AS label, coalesce(avg(base_correctness), 0) AS base, coalesce(avg(lora_correctness), 0) AS lora
  FROM judge_details
  UNION ALL
  SELECT '完整性', coalesce(avg(base_completeness), 0), coalesce(avg(lora_completeness), 0) FROM judge_details
  UNION ALL
  SELECT '總平均',
         (coalesce(sum(base_correctness), 0) + coalesce(sum(base_completeness), 0)) / (2 * greatest(count(base_correctness), 1)),
         (coalesce(sum(lora_correctness), 0) + coalesce(sum(lora_completeness), 0)) / (2 * greatest(count(lora_correctness), 1))
  FROM judge_details) x""", "judge_details"))
def judge_report(spark, sf_dir):
    from chatframe.operators.reports import judge_report_table
    return judge_report_table(jd.scoreboard_wide(judged(spark, sf_dir)))


def _examples_sql() -> str:
    parts = []
    for direction, o in (("gain", "DESC"), ("loss", "ASC")):
        parts.append(f"""
SELECT '{direction}' AS direction, CAST(row_number() OVER (ORDER BY f1_diff {o}, t.pair_id) AS INT) AS rank, t.pair_id,
       printf('%+.4f', f1_diff) AS diff, concat(left(question, 60), '...') AS question,
       printf('%.4f', base_f1) AS base_f1, printf('%.4f', lora_f1) AS lora_f1
FROM (SELECT pair_id, base_f1, lora_f1, round(f1_diff, 9) AS f1_diff FROM td ORDER BY round(f1_diff, 9) {o}, pair_id LIMIT 3) t
JOIN answers a ON a.sample_id = t.pair_id""")
    return _bt("\nUNION ALL\n".join(parts))


@register("bertscore_examples", _examples_sql())
def bertscore_examples(spark, sf_dir):
    from chatframe.operators.bertscore import f1_diffs
    from chatframe.operators.inference import materialize
    from chatframe.operators.reports import ranked_examples
    from chatframe.session import work_dir
    a = fx.answers(spark, sf_dir)
    d = materialize(f1_diffs(text_scores(spark, sf_dir, a)).withColumn("f1_diff", F.round("f1_diff", 9)),
                    work_dir(spark, "diffs"))
    qs = a.select(F.col("sample_id").alias("pair_id"), "question")
    gain = ranked_examples(d, qs, 3, descending=True).withColumn("direction", F.lit("gain"))
    loss = ranked_examples(d, qs, 3, descending=False).withColumn("direction", F.lit("loss"))
    return gain.unionByName(loss).select(
        "direction", F.col("rank").cast("int").alias("rank"), "pair_id", "diff", "question", "base_f1", "lora_f1")


# ------------------------------------------------------------ sources/sinks ---
@register("training_text_sink", q.with_views(f"SELECT {_SFT_TEXT} AS text FROM sft", "sft"))
def training_text_sink(spark, sf_dir):
    from chatframe.session import work_dir
    from chatframe.sources.writers import write_training_text
    path = work_dir(spark, "training-text")
    write_training_text(sft_text(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("answers_document", q.with_views(
    "SELECT sample_id, instruction, question, reference, base_answer, lora_answer FROM answers", "answers"))
def answers_document(spark, sf_dir):
    from chatframe.session import work_dir
    from chatframe.sources.readers import read_answers
    from chatframe.sources.writers import write_answers
    path = work_dir(spark, "answers")
    write_answers(fx.answers(spark, sf_dir), {"num_samples": None, "adapter_path": "stand-in",
                                              "max_new_tokens": 512, "seed": SEED}, path)
    return read_answers(spark, path)


@register("answers_parts", ORACLE["answers_document"])
def answers_parts(spark, sf_dir):
    """B1/A3 in document form: ordered parts of one JSON document."""
    from chatframe.session import work_dir
    from chatframe.sources.readers import read_answers
    from chatframe.sources.writers import write_answers
    path = work_dir(spark, "answers-parts")
    write_answers(fx.answers(spark, sf_dir), {"seed": SEED}, path, document=True)
    return read_answers(spark, path)


@register("answers_nested", ORACLE["answers_document"])
def answers_nested(spark, sf_dir):
    """A3 over one nested JSON file, written and read by several tasks."""
    from chatframe.session import work_dir
    from chatframe.sources.readers import read_answers
    from chatframe.sources.writers import join_parts, write_answers
    path = work_dir(spark, "answers-parts")
    write_answers(fx.answers(spark, sf_dir), {"seed": SEED}, path, document=True)
    return read_answers(spark, join_parts(spark, path))


@register("read_sft_keys", q.with_views("SELECT * FROM sft", "sft"))
def read_sft_keys(spark, sf_dir):
    """A1 over a JSON copy of the rows: the source's keys stay."""
    from chatframe.session import work_dir
    from chatframe.sources.readers import read_sft
    path = work_dir(spark, "sft-json")
    fx.sft(spark, sf_dir).write.json(path)
    return read_sft(spark, path, "json")


@register("judge_document", q.with_views("""
SELECT j.sample_id, a.question, j.error, CASE WHEN error IS NULL THEN base_correctness END AS base_correctness,
       CASE WHEN error IS NULL THEN lora_completeness END AS lora_completeness,
       CASE WHEN error IS NULL THEN 'ok' END AS comment,
       (SELECT count(*) FILTER (WHERE error IS NULL) FROM judge_details) AS num_evaluated
FROM judge_details j JOIN answers a ON a.sample_id = j.sample_id""", "answers", "judge_details"))
def judge_document(spark, sf_dir):
    """B2 written in document form and read back."""
    from chatframe.session import work_dir
    from chatframe.sources.writers import write_judge_results
    scored = judged(spark, sf_dir).join(fx.answers(spark, sf_dir).select("sample_id", "question"), "sample_id")
    path = work_dir(spark, "judge-document")
    write_judge_results(scored, {"num_samples": None}, path, document=True)
    lines = spark.read.text(path)
    kind = "struct<correctness:double,completeness:double,comment:string>"
    row = F.from_json(F.regexp_replace("value", "^,", ""),
                      f"sample_id string, question string, base_scores {kind}, lora_scores {kind}, error string")
    head = lines.where("value like '{\"config\"%'").select(F.regexp_extract(
        "value", r'"num_evaluated": (\d+)', 1).cast("bigint")).first()
    return (lines.where("value rlike '^,?.\"sample_id\"'").select(row.alias("r")).select("r.*")
            .select("sample_id", "question", "error", F.col("base_scores.correctness").alias("base_correctness"),
                    F.col("lora_scores.completeness").alias("lora_completeness"),
                    F.col("base_scores.comment").alias("comment"), F.lit(head[0]).alias("num_evaluated")))


@register("map_batches", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents")
def map_batches(spark, sf_dir):
    from chatframe.operators.inference import map_batches as mb
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mb(d, lambda b: b[["doc_id"]].assign(n=b["text"].str.len()), "doc_id long, n long")


@register("page_clean", f"""
SELECT page_id, CAST(length(html) AS BIGINT) AS valid_len, md5(html) AS html_md5,
       concat(left({q.strip('html')}, 60), '...') AS preview_60
FROM pages""")
def page_clean(spark, sf_dir):
    """T11 over bytes: each page gets an invalid byte, which sanitize replaces."""
    raw = F.concat(F.lit(b"\xff"), F.col("html").cast("binary"))
    d = table(spark, sf_dir, "pages").select("page_id", tx.sanitize(raw.cast("string")).alias("c"))
    body = F.when(F.startswith("c", F.lit("\ufffd")), F.substr("c", F.lit(2)))
    d = d.select("page_id", body.alias("html"))
    return d.select("page_id", F.length("html").cast("bigint").alias("valid_len"), F.md5("html").alias("html_md5"),
                    tx.preview(tx.py_strip("html"), 60, always=True).alias("preview_60"))


@register("generate_judge_pipeline", q.with_views(f"""
SELECT sample_id, substr(md5(concat('42:ab:', sample_id)), 1, 1) >= '8' AS base_is_a,
       array_to_string(list_slice(w, 1, {STUB_NEW_TOKENS}), ' ') AS base_answer,
       array_to_string(list_slice(w, greatest(len(w) - {STUB_NEW_TOKENS - 1}, 1), len(w)), ' ') AS lora_answer,
       CAST(NULL AS VARCHAR) AS error FROM p""", "sft", extra=[("p", f"SELECT sample_id, {q.words(_GEN_PROMPT)} AS w FROM sft")]))
def generate_judge_pipeline(spark, sf_dir):
    """Generate, store, judge, store: nothing is generated or judged twice."""
    from chatframe.functions.prompts import judge_messages
    from chatframe.operators.inference import generate_variants, judge, materialize, pending
    from chatframe.operators.reports import attach_variants
    from chatframe.session import work_dir
    from chatframe.sources.standins import EchoModel, length_judge
    s = materialize(fx.sft(spark, sf_dir).select(
        "sample_id", "input", "output", render_chat(to_messages("system_user"), DEFAULT_TEMPLATE,
                                                    add_generation_prompt=True).alias("prompt")), work_dir(spark, "prompts"))
    long = materialize(generate_variants(s, {"base": EchoModel, "lora": lambda: EchoModel(tail=True)},
                                         max_new_tokens=STUB_NEW_TOKENS), work_dir(spark, "answers"))
    a = jd.assign_ab(attach_variants(long).join(s.select(
        "sample_id", F.col("input").alias("question"), F.col("output").alias("reference")), "sample_id"), SEED)
    calls = a.select("sample_id", "base_is_a", judge_messages(render_judge_prompt()).alias("messages"))
    store = work_dir(spark, "judged")
    done = materialize(judge(calls.where("base_is_a"), length_judge, model="stand-in", min_interval_s=0.0,
                             keep=("sample_id", "base_is_a"), concurrency=4), store)
    done = materialize(judge(pending(calls, done), length_judge, model="stand-in", min_interval_s=0.0,
                             keep=("sample_id", "base_is_a"), concurrency=4), store)
    return jd.score_replies(done).join(a.select("sample_id", "base_answer", "lora_answer"), "sample_id").select(
        "sample_id", "base_is_a", "base_answer", "lora_answer", "error")


# -------------------------------------------------------------- streaming ---
_TURNS_SESSION = [
    ("sess", _SESSION.replace("{src}", "turns_with_exit")),
    ("tok", f"SELECT conv_id, turn, role, text, {q.count_words('text')} AS n FROM sess"), ("c", _CUM)]


@register("stream_context", q.with_views(f"""
SELECT t.conv_id, t.turn, t.role, min(i.turn) AS first_turn, count(i.turn) AS n_messages,
       CAST(coalesce(sum(i.n), 0) AS BIGINT) AS n_tokens
FROM c t LEFT JOIN c i
  ON i.conv_id = t.conv_id AND i.turn <= t.turn AND t.cum - i.cum + i.n <= {HISTORY_BUDGET}
GROUP BY t.conv_id, t.turn, t.role""", "turns_with_exit", extra=_TURNS_SESSION))
def stream_context(spark, sf_dir):
    """Turns arrive in three parts, and the query goes on after each of them;
    session rules apply in the stream."""
    from chatframe.operators.inference import materialize
    from chatframe.schemas import TURN
    from chatframe.session import work_dir
    from chatframe.streaming.context import stream_context as sc
    from chatframe.streaming.runner import run_append
    turns, path, base = fx.turns_with_exit(spark, sf_dir), work_dir(spark, "turns"), work_dir(spark, "stream-context")
    for part in ("turn < 2 OR turn IS NULL", "turn >= 2 AND turn < 4", "turn >= 4"):
        materialize(turns.where(part), path)
        arrived = spark.readStream.schema(TURN).parquet(path)
        out = run_append(sc(arrived, HISTORY_BUDGET), "stream-context", base)
    return out.where("status = 'ok'").drop("status")


@register("stream_scoreboard", ORACLE["judge_scoreboard"])
def stream_scoreboard(spark, sf_dir):
    """Every reply's call fails in the first micro-batch and is retried; the
    board after the last one."""
    from chatframe.operators.inference import materialize
    from chatframe.session import work_dir
    from chatframe.streaming.scoreboard import board_long, run_boards
    replies = fx.judge_replies(spark, sf_dir).withColumn("error", F.lit(None).cast("string")).withColumn(
        "run_id", F.lit("run")).withColumn("attempt", F.lit(1))
    failed = replies.withColumn("reply", F.lit(None).cast("string")).withColumn(
        "error", F.lit("timeout")).withColumn("attempt", F.lit(0))
    path, base = work_dir(spark, "replies"), work_dir(spark, "boards")
    for rows in (failed, replies):
        materialize(rows, path)
        arrived = spark.readStream.schema(replies.schema).parquet(path)
        boards = run_boards(arrived, base=base, at=F.col("attempt"))
    return board_long(boards).select("dimension", r6("base").alias("base"), r6("lora").alias("lora"), r6("diff").alias("diff"))
