"""Stateful context clipping on a stream of turns.

Keyed by ``conv_id`` with ``transformWithStateInPandas``.  The state of a
session is the list of retained (turn, tokens) pairs, which the token budget
and ``max_messages`` bound, the last turn seen and whether the session has
ended.  Session rules (F1, F2) apply as in ``session_filter``: a blank user turn
is skipped, and a user turn that says exit or quit ends the session with itself.
Texts stay on the JVM side; the step gets token counts and flags only, and
keeps some 40 bytes of each turn of a micro-batch, batch by batch, to bring them
into order.

Every input turn gives one output row.  ``status`` tells what became of it:
``ok`` (the columns match the batch ``context_at_turn``), ``blank``, ``ended``,
``late`` (not newer than the last turn of an earlier micro-batch, or a repeated
number) or ``no_turn`` (null number; nothing else changes).

With ``idle_s`` a session that gets no turn for so long ends by a timer: one
row with status ``idle`` reports its last turn and what it held, and its state
goes.  A later turn of that conversation starts a new session.  Without
``idle_s`` state stays as long as the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chatframe.operators.context import MAX_MESSAGES, _is_exit, first_seen, said
from chatframe.operators.tokens import count_tokens
from chatframe.streaming.runner import keep_state_in_rocksdb

OUT_ROWS = 4096  # rows of an output frame
LONGS = ("turn", "first_turn", "n_messages", "n_tokens")


class Sessions(StatefulProcessor):
    """What every turn of a session sees."""

    def __init__(self, max_tokens: int, max_messages: int, idle_ms: int | None):
        self.max_tokens, self.max_messages, self.idle_ms = max_tokens, max_messages, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "turn long, n long")
        self.session = handle.getValueState("session", "last_turn long, ended boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        turn, n, flags, role, roles = _compact(rows)
        last, ended = self.session.get() if self.session.exists() else (None, False)
        held = np.array(list(self.held.get()), np.int64).reshape(-1, 2) if last is not None else np.empty((0, 2), np.int64)
        order = np.lexsort((np.arange(len(turn)), turn))
        turn, n, flags, role = turn[order], n[order], flags[order], role[order]
        none = (flags & NO_TURN) > 0
        late = np.append(False, turn[1:] == turn[:-1]) & ~np.append(False, none[:-1]) if len(turn) else none
        if last is not None:
            late = late | (turn <= last)
        late &= ~none
        stop = ended | (np.cumsum(((flags & IS_EXIT) > 0) & ~late & ~none) > 0)
        status = np.select([none, late, stop, (flags & IS_BLANK) > 0], ["no_turn", "late", "ended", "blank"], "ok")
        ok = np.flatnonzero(status == "ok")
        size, at_turn = np.concatenate([held[:, 1], n[ok]]), np.concatenate([held[:, 0], turn[ok]])
        first = first_seen(np.zeros(len(size), np.int64), size, self.max_tokens, self.max_messages)
        at = np.arange(len(held), len(size))
        seen = at + 1 - first[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        out = {c: np.full(len(turn), -1, np.int64) for c in LONGS[1:]}
        out["n_messages"][ok], out["n_tokens"][ok] = seen, upto[at + 1] - upto[first[at]]
        out["first_turn"][ok] = at_turn[np.minimum(first[at], max(0, len(size) - 1))] if len(ok) else 0
        known = {"turn": ~none, "n_messages": status == "ok", "n_tokens": status == "ok"}
        known["first_turn"] = known["n_messages"] & (out["n_messages"] > 0)
        out["turn"] = turn
        in_time = ~late & ~none
        if in_time.any():
            last = int(turn[in_time].max()) if last is None else max(int(last), int(turn[in_time].max()))
        if last is not None:
            keep = int(first[-1]) if len(first) else 0
            if keep < len(size):
                self.held.put([(int(t), int(x)) for t, x in zip(at_turn[keep:], size[keep:], strict=True)])
            elif len(held):
                self.held.clear()
            self.session.update((last, bool(stop.any() or ended)))
            if self.idle_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        names = np.array([*roles, None], object)
        for s in range(0, len(turn), OUT_ROWS):
            part = slice(s, s + OUT_ROWS)
            frame = {c: pd.array(np.where(known[c][part], out[c][part], 0), "Int64") for c in LONGS}
            for c in LONGS:
                frame[c][~known[c][part]] = pd.NA
            yield pd.DataFrame({"conv_id": key[0], **{"turn": frame["turn"], "role": names[role[part]]},
                                **{c: frame[c] for c in LONGS[1:]}, "status": status[part]},
                               index=range(len(status[part])))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.session.exists():
            return
        last, ended = self.session.get()
        held = [] if ended else list(self.held.get())
        self.held.clear()
        self.session.clear()
        first = held[0][0] if held else None
        row = {"turn": last, "role": None, "first_turn": first, "n_messages": len(held), "n_tokens": sum(h[1] for h in held)}
        yield pd.DataFrame([{"conv_id": key[0], **row, "status": "idle"}]).astype({c: "Int64" for c in LONGS})

    def close(self) -> None:
        pass


NO_TURN, IS_EXIT, IS_BLANK = 1, 2, 4


def _compact(rows: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Turn, tokens, flags, role number (-1: null) of all rows, and the roles."""
    roles: dict = {}
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int8), np.empty(0, np.int32))]
    for b in rows:
        none = b["turn"].isna().to_numpy()
        flags = none * NO_TURN + b["is_exit"].to_numpy(bool) * IS_EXIT + b["is_blank"].to_numpy(bool) * IS_BLANK
        number = [-1 if r is None else roles.setdefault(r, len(roles)) for r in b["role"]]
        parts.append((b["turn_known"].to_numpy(np.int64), b["n_tokens"].to_numpy(np.int64), flags.astype(np.int8),
                      np.array(number, np.int32)))
    return (*(np.concatenate(c) for c in zip(*parts, strict=True)), list(roles))


def stream_context(turns: DataFrame, max_tokens: int, tokenizer_factory=None, max_messages: int = MAX_MESSAGES,
                   idle_s: float | None = None) -> DataFrame:
    """Streaming (or batch) ``<conv_id, turn, role, text>`` (turn a long) -> the
    visible history of every turn, with its ``status``."""
    keep_state_in_rocksdb(turns.sparkSession)
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    t = t.withColumn("text", F.coalesce(said(), F.col("text")))
    blank = F.coalesce((F.col("role") == "user") & (F.col("text") == ""), F.lit(False))
    t = t.select("conv_id", "turn", F.coalesce("turn", F.lit(0)).alias("turn_known"), "role",
                 F.coalesce(count_tokens("text", tokenizer_factory), F.lit(0)).cast("long").alias("n_tokens"),
                 _is_exit().alias("is_exit"), blank.alias("is_blank"))
    out = StructType([turns.schema["conv_id"], StructField("turn", LongType()), StructField("role", StringType()),
                      *[StructField(c, LongType()) for c in LONGS[1:]], StructField("status", StringType())])
    idle_ms = None if idle_s is None else int(idle_s * 1000)
    return t.groupBy("conv_id").transformWithStateInPandas(
        Sessions(max_tokens, max_messages, idle_ms), out, "append", "none" if idle_ms is None else "processingTime")
