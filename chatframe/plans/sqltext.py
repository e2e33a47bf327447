"""Helpers that write the oracle SQL (DuckDB dialect) from the same constants
the Spark operators use, so the two sides cannot drift apart."""

from __future__ import annotations

from chatframe.functions.prompts import DEFAULT_TEMPLATE, ChatTemplate, template_pieces, JUDGE_SLOT_CUT
from chatframe.functions.text import SPLIT_PATTERN, STRIP_PATTERN


def lit(s: str) -> str:
    """A SQL string literal; newlines become ``chr(10)``."""
    pieces = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in pieces]
    return "(" + " || chr(10) || ".join(quoted) + ")" if len(quoted) > 1 else quoted[0]


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {lit(STRIP_PATTERN)}, '', 'g')"


def words(expr: str) -> str:
    s = strip(expr)
    return f"(CASE WHEN {s} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split_regex({s}, {lit(SPLIT_PATTERN)}) END)"


def count_words(expr: str) -> str:
    return f"CAST(len({words(expr)}) AS BIGINT)"


def message(role: str, content: str, t: ChatTemplate = DEFAULT_TEMPLATE) -> str:
    body = strip(content) if t.trim_content else content
    return f"concat({lit(t.header_start)}, {role}, {lit(t.header_end)}, {body}, {lit(t.end_of_turn)})"


def render(messages: list[tuple[str, str]], add_generation_prompt: bool,
           t: ChatTemplate = DEFAULT_TEMPLATE) -> str:
    parts = [lit(t.bos)] + [message(r, c, t) for r, c in messages]
    if add_generation_prompt:
        parts.append(lit(t.generation_prompt()))
    return "concat(" + ", ".join(parts) + ")"


def judge_prompt(question: str, reference: str, answer_a: str, answer_b: str) -> str:
    cols = {"question": question, "reference": reference, "answer_a": answer_a, "answer_b": answer_b}
    parts = []
    for kind, val in template_pieces():
        if kind == "lit":
            parts.append(lit(val))
        else:
            n = JUDGE_SLOT_CUT[val]
            parts.append(f"left({cols[val]}, {n})" if n else cols[val])
    return "concat(" + ", ".join(parts) + ")"


# -- derived views (FIXTURES.md §2), as CTE bodies ---------------------------
SFT = """SELECT concat(conv_id, ':', turn) AS sample_id, coalesce(sys, '') AS instruction, text AS input, nxt AS output
FROM (SELECT *, lead(text) OVER w AS nxt, lead(role) OVER w AS nrole,
             max(CASE WHEN role = 'system' THEN text END) OVER (PARTITION BY conv_id) AS sys
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) q
WHERE role = 'user' AND nrole = 'assistant'"""

ANSWERS = """SELECT sample_id, instruction, input AS question, output AS reference,
       substring(output, 1, CAST(floor(length(output) / 2) AS INT)) AS base_answer,
       concat(substring(output, 1, CAST(floor(length(output) * 9 / 10) AS INT)), ' ', substring(input, 1, 20)) AS lora_answer
FROM sft"""

ANSWERS_LONG = """SELECT sample_id, 'base' AS variant, base_answer AS answer FROM answers
UNION ALL SELECT sample_id, 'lora' AS variant, lora_answer AS answer FROM answers"""

TOKEN_PAIRS = """SELECT CAST(floor(vec_id / 20) AS BIGINT) AS pair_id,
       CASE WHEN vec_id % 20 < 5 THEN 'base' WHEN vec_id % 20 < 10 THEN 'lora' ELSE 'ref' END AS side,
       vec_id AS tok_id, embedding AS vec
FROM embeddings"""

TURNS_WITH_EXIT = """SELECT conv_id, turn, role,
       CASE WHEN role = 'user' AND turn = 2 AND conv_id % 5 = 0 THEN '  EXIT '
            WHEN role = 'user' AND turn = 4 AND conv_id % 7 = 0 THEN '   ' ELSE text END AS text
FROM conversations"""

JUDGE_TRUTH = """SELECT sample_id, substr(md5(concat('42:ab:', CAST(sample_id AS STRING))), 1, 1) >= '8' AS base_is_a,
       n % 13 AS kind,
       1 + ((n % 97) * 7) % 10 AS bc, 1 + ((n % 89) * 3 + 4) % 10 AS lc,
       1 + ((n % 83) * 9 + 1) % 10 AS bp, 1 + ((n % 79) * 7 + 7) % 10 AS lp
FROM (SELECT *, CAST(split_part(sample_id, ':', 1) AS BIGINT) * 100
                + CAST(split_part(sample_id, ':', 2) AS BIGINT) AS n FROM sft) s"""

# formula-based expected decode of judge_replies (no parsing): see FIXTURES §2.3
JUDGE_DETAILS = """SELECT sample_id, base_is_a,
  CASE kind WHEN 2 THEN 'bad_json' WHEN 4 THEN 'bad_json' WHEN 7 THEN 'bad_json' WHEN 8 THEN 'bad_json' WHEN 3 THEN 'missing_score'
            WHEN 5 THEN 'bad_score_type' WHEN 6 THEN 'missing_model' END AS error,
  CASE WHEN kind IN (2, 4, 5, 6, 7, 8) THEN NULL ELSE CAST(bc AS DOUBLE) END AS base_correctness,
  CASE WHEN kind IN (2, 4, 5, 6, 7, 8) THEN NULL ELSE CAST(lc AS DOUBLE) END AS lora_correctness,
  CASE WHEN kind IN (2, 4, 5, 6, 7, 8) THEN NULL ELSE CAST(bp AS DOUBLE) END AS base_completeness,
  CASE WHEN kind IN (2, 3, 4, 5, 6, 7, 8) THEN NULL ELSE CAST(lp AS DOUBLE) END AS lora_completeness
FROM judge_truth"""

VIEWS = {
    "sft": SFT, "answers": ANSWERS, "answers_long": ANSWERS_LONG, "token_pairs": TOKEN_PAIRS,
    "turns_with_exit": TURNS_WITH_EXIT, "judge_truth": JUDGE_TRUTH, "judge_details": JUDGE_DETAILS,
}
_DEPS = {"answers": ["sft"], "answers_long": ["answers"], "judge_truth": ["sft"],
         "judge_details": ["judge_truth"]}


def with_views(body: str, *names: str, extra: list[tuple[str, str]] = ()) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first), then the
    query's own ``extra`` CTEs."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    defs = [(n, VIEWS[n]) for n in order] + list(extra)
    if not defs:
        return body
    ctes = ",\n".join(f"{n} AS (\n{q}\n)" for n, q in defs)
    return f"WITH {ctes}\n{body}"
