"""Message lists, chat-template rendering and the judge prompt.

The chat template is a parameter (the reference takes it from the model's
tokenizer).  The default follows the public Llama-3 header style.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatframe.functions.text import cut, py_strip


@dataclass(frozen=True)
class ChatTemplate:
    bos: str = "<|begin_of_text|>"
    header_start: str = "<|start_header_id|>"
    header_end: str = "<|end_header_id|>\n\n"
    end_of_turn: str = "<|eot_id|>"
    trim_content: bool = True

    def message(self, role: Column, content: Column) -> Column:
        body = py_strip(content) if self.trim_content else content
        return F.concat(F.lit(self.header_start), role, F.lit(self.header_end), body,
                        F.lit(self.end_of_turn))

    def generation_prompt(self) -> str:
        return f"{self.header_start}assistant{self.header_end}"


DEFAULT_TEMPLATE = ChatTemplate()


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def msg(role: str, content) -> Column:
    return F.struct(F.lit(role).alias("role"), _c(content).alias("content"))


def to_messages(mode: str, instruction="instruction", question="input", answer="output") -> Column:
    """``user`` (1 message), ``system_user`` (2) or ``sft`` (3)."""
    if mode == "user":
        return F.array(msg("user", question))
    if mode == "system_user":
        return F.array(msg("system", instruction), msg("user", question))
    if mode == "sft":
        return F.array(msg("system", instruction), msg("user", question), msg("assistant", answer))
    raise ValueError(f"unknown message mode {mode!r}")


def render_chat(messages, template: ChatTemplate = DEFAULT_TEMPLATE,
                add_generation_prompt: bool = False) -> Column:
    """Template over an ``array<struct<role, content>>`` column."""
    parts = F.transform(_c(messages), lambda m: template.message(m["role"], m["content"]))
    out = F.concat(F.lit(template.bos), F.array_join(parts, ""))
    if add_generation_prompt:
        out = F.concat(out, F.lit(template.generation_prompt()))
    return out


# ---------------------------------------------------------------------------
# The judge's system prompt and user prompt, word for word as the
# evaluation sends them (the user prompt has four slots; braces around the
# JSON example are literal text).
JUDGE_SYSTEM_PROMPT = """你是一位嚴格且公正的 AI 回答品質評審。你的任務是評估兩個模型對同一個問題的回答品質。
請根據提供的「標準答案」作為參考，從以下四個維度分別為每個模型的回答打分（1-10 分）。
你必須嚴格按照指定的 JSON 格式輸出結果，不要輸出任何其他內容。"""

JUDGE_USER_TEMPLATE = """## 問題
{question}

## 標準答案（參考）
{reference}

## 模型 A 的回答
{answer_a}

## 模型 B 的回答
{answer_b}

請從以下兩個維度分別為模型 A 和模型 B 打分（1-10 分）：

1. **正確性 (Correctness)**：回答的事實是否與標準答案一致？有無錯誤資訊？
2. **完整性 (Completeness)**：是否涵蓋了標準答案中的所有重點？有無遺漏關鍵內容？

請嚴格以以下 JSON 格式回覆，不要附加任何解釋：
{
  "model_a": {
    "correctness": <分數>,
    "completeness": <分數>,
    "comment": "<一句話簡評>"
  },
  "model_b": {
    "correctness": <分數>,
    "completeness": <分數>,
    "comment": "<一句話簡評>"
  }
}"""

# per-slot cut applied before filling (question is not cut)
JUDGE_SLOT_CUT = {"question": None, "reference": 1500, "answer_a": 1500, "answer_b": 1500}
# ---------------------------------------------------------------------------

_SLOT = re.compile(r"\{(question|reference|answer_a|answer_b)\}")


def template_pieces(template: str = JUDGE_USER_TEMPLATE) -> list[tuple[str, str]]:
    """Split a slot template into ("lit", text) / ("slot", name) pieces."""
    out, last = [], 0
    for m in _SLOT.finditer(template):
        out.append(("lit", template[last:m.start()]))
        out.append(("slot", m.group(1)))
        last = m.end()
    out.append(("lit", template[last:]))
    return [p for p in out if p != ("lit", "")]


def render_judge_prompt(question="question", reference="reference",
                        answer_a="answer_a", answer_b="answer_b",
                        template: str = JUDGE_USER_TEMPLATE) -> Column:
    """T6 + T7: fill the judge template with plain ``concat`` (no format
    strings, so ``%`` or braces in the data are harmless)."""
    cols = {"question": question, "reference": reference,
            "answer_a": answer_a, "answer_b": answer_b}
    parts = []
    for kind, val in template_pieces(template):
        if kind == "lit":
            parts.append(F.lit(val))
        else:
            n = JUDGE_SLOT_CUT[val]
            c = _c(cols[val])
            parts.append(cut(c, n) if n else c)
    return F.concat(*parts)


def judge_messages(user_prompt) -> Column:
    """The two messages of one judge call."""
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(JUDGE_SYSTEM_PROMPT).alias("content")),
                   F.struct(F.lit("user").alias("role"), _c(user_prompt).alias("content")))
