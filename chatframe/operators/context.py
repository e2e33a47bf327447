"""Conversation operators: session rules, token-budget clipping and the
point-in-time context of every turn (F1, F2, G1-G4, I6).

Input rows are ``<conv_id, turn, role, text>``, with ``conv_id`` and ``turn`` of
any type that has an order.  All ordered work runs over a range-partitioned
table (``scans``), so no conversation, however long, is one task's, and null
keys keep their rows: turns without a ``conv_id`` are a conversation, turns
without a number come first.

*Histories.*  What a turn sees is a contiguous run of messages that ends with
it: the longest whose tokens fit ``max_tokens``, of at most ``max_messages``
messages (messages without tokens would otherwise make it unbounded).  One scan
over each partition keeps only the run of the last message (the *halo* of what
follows) and writes every turn's history, with its messages where they are
wanted.  Turns whose history reaches the start of their partition are a bounded
number a partition; they are solved anew behind the halo of the partitions
before.  No history is joined together, and none is sent per turn.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatframe.functions.prompts import DEFAULT_TEMPLATE, ChatTemplate, render_chat
from chatframe.functions.text import py_strip
from chatframe.operators.scans import DEFAULT_CHUNK, Groups, chunks, content_columns, in_order, ordered_scan
from chatframe.operators.tokens import with_token_counts
from chatframe.session import stored

EXIT_WORDS = ("exit", "quit")  # fixed values: words that end a chat session
MAX_MESSAGES = 4096
ITEM_BYTES = 16 << 20  # texts of histories written at a time

TURN = ("conv_id", "turn", "role", "text")


def said(role: str = "role", text: str = "text") -> Column:
    """The stripped words of a user turn ('' for null)."""
    return F.when(F.col(role) == "user", F.coalesce(py_strip(F.col(text)), F.lit("")))


def conversations_to_sft(turns: DataFrame, key: Column | None = None, chunk_size: int = DEFAULT_CHUNK,
                         partitions: int | None = None) -> DataFrame:
    """Each user turn answered by the next (assistant) turn becomes an
    instruction row; the conversation's largest system text is the instruction.
    ``sample_id`` defaults to the text ``conv_id:turn``, one for each turn (a
    null part is left out of it)."""
    s = ordered_scan(turns.select(*TURN), "conv_id", "turn", nexts=["role", "text"], chunk_size=chunk_size,
                     partitions=partitions)
    key = key if key is not None else F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    pairs = s.where("role = 'user' AND next_role = 'assistant'").select(
        key.alias("sample_id"), "conv_id", F.col("text").alias("input"), F.col("next_text").alias("output"))
    system = s.where("role = 'system' AND text IS NOT NULL").groupBy(F.col("conv_id").alias("of")).agg(
        F.max("text").alias("instruction"))
    return pairs.join(system, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "sample_id", F.coalesce("instruction", F.lit("")).alias("instruction"), "input", "output")


def session_filter(turns: DataFrame, chunk_size: int = DEFAULT_CHUNK, partitions: int | None = None) -> DataFrame:
    """F1 + F2: drop blank user turns (user text is stored stripped) and end
    each session at the first user turn saying exit/quit (that turn and all
    later ones are dropped)."""
    t = turns.select(*TURN).withColumn("text", F.coalesce(said(), F.col("text")))
    t = t.where(~F.coalesce((F.col("role") == "user") & (F.col("text") == ""), F.lit(False)))
    s = ordered_scan(t, "conv_id", "turn", sums={"exit": _is_exit().cast("long")}, chunk_size=chunk_size,
                     partitions=partitions)
    return s.where("cum_exit = 0").select(*TURN)


def _is_exit() -> Column:
    return F.coalesce((F.col("role") == "user") & F.lower("text").isin(*EXIT_WORDS), F.lit(False))


def clip_history(turns: DataFrame, max_tokens: int, tokenizer_factory=None, chunk_size: int = DEFAULT_CHUNK,
                 partitions: int | None = None) -> DataFrame:
    """G1: drop the oldest messages of each conversation until the rest fits
    ``max_tokens``; keeps a message iff the token sum from it to the end of the
    conversation is within budget (a single oversized last message empties it)."""
    t = with_token_counts(turns.select(*TURN), tokenizer_factory)
    s = ordered_scan(t, "conv_id", "turn", sums={"n": F.col("n_tokens")}, descending=True, chunk_size=chunk_size,
                     partitions=partitions)
    return s.where(F.col("cum_n") <= max_tokens).select(*TURN, "n_tokens")


# ------------------------------------------------------------------ histories ---
def first_seen(group: np.ndarray, n: np.ndarray, max_tokens: int, max_messages: int) -> np.ndarray:
    """For each row the first row of its history, itself + 1 if that is empty.
    Rows are in order, those of a group together."""
    total = np.cumsum(n)
    number = np.cumsum(np.append(0, group[1:] != group[:-1])) if len(group) else group
    start = np.searchsorted(number, number)
    before = total - n - np.where(start > 0, total[start - 1], 0)  # tokens of the group before a row
    # a row is seen if the tokens before it reach the total less the budget
    width = int(before.max(initial=0)) + int(n.max(initial=0)) + 1
    seen = np.searchsorted(number * width + before, number * width + np.maximum(before + n - max_tokens, 0))
    at = np.arange(len(n))
    return np.maximum(np.minimum(seen, at + 1), at - max_messages + 1)


def _histories(key: str, max_tokens: int, max_messages: int, chunk_size: int, items: bool, edges: bool = True):
    """The scan over one sorted partition: a record a row (``kind`` 0), and with
    ``edges`` the halo of the next partition (1) and one edge (2)."""
    def scan(batches):
        part, found, kept, ended_in = TaskContext.get().partitionId(), Groups(1), None, {0: False}
        group = np.empty(0, np.int64)    # of the rows in ``kept``
        whole = True                     # ``kept`` starts with the partition's first row
        schema, number = None, np.empty(0, np.int64)
        seq = 0

        def record(kind, rows, **cols):
            n = rows.num_rows
            cols |= {"kind": pa.array(np.full(n, kind, np.int32)), "part": pa.array(np.full(n, part, np.int32))}
            given = rows.schema.names
            return pa.RecordBatch.from_arrays(
                [cols[f.name] if f.name in cols else rows.column(f.name) if f.name in given else pa.nulls(n, f.type)
                 for f in schema], schema=schema)

        for b in chunks(batches, chunk_size):
            if schema is None:
                schema = _history_schema(b.schema)
            number = found.of([b.column(key)])
            stop = b.column("is_exit").to_numpy(zero_copy_only=False)
            new = np.append(True, number[1:] != number[:-1]) if len(number) else stop
            last = {int(number[0]): ended_in.get(int(number[0]), False)}
            ended = np.cumsum(stop)
            ended = (ended - np.where(new, ended - stop, 0)[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]) > 0
            ended |= (number == number[0]) & last[int(number[0])]
            ended_in = {0: bool(ended_in.get(0, False) or ended[number == 0].any()), int(number[-1]): bool(ended[-1])}
            live = np.flatnonzero(~ended)
            fresh = b.take(pa.array(live))
            n_old = 0 if kept is None else kept.num_rows
            rows = fresh if not n_old else pa.Table.from_batches([kept, fresh]).combine_chunks().to_batches()[0]
            group = np.concatenate([group, number[live]])
            if not rows.num_rows:
                continue
            n = rows.column("n_tokens").to_numpy(zero_copy_only=False)
            first = first_seen(group, n, max_tokens, max_messages)
            at = np.arange(n_old, rows.num_rows)
            seen = at + 1 - first[at]
            upto = np.concatenate([[0], np.cumsum(n)])
            tokens = upto[at + 1] - upto[first[at]]
            short = (group[at] == 0) & (first[at] == 0) & whole & (seen > 0)
            some = pa.array(first[at], mask=seen == 0)
            cols = {"head": pa.array(group[at] == 0), "short": pa.array(short), "seq": pa.array(seq + np.arange(len(at))),
                    "first_turn": rows.column("turn").take(some), "n_messages": pa.array(seen),
                    "history_tokens": pa.array(tokens)}
            seq += len(at)
            out = record(0, rows.slice(n_old), **cols)
            if items:
                wanted = rows.column("wanted").to_numpy(zero_copy_only=False)[at] & (seen > 0)
                yield from _with_items(out, rows, np.where(wanted, first[at], at + 1), at)
            elif out.num_rows:
                yield out
            # what the next row may see besides itself
            keep = int(first[-1])
            whole = whole and keep == 0 and group[-1] == 0
            kept, group = rows.slice(keep), group[keep:]
        if schema is None or not edges:
            return
        mine = kept is not None and len(group) > 0 and group[-1] == number[-1] and not ended_in[int(number[-1])]
        if mine:
            yield record(1, kept, seq=pa.array(np.arange(kept.num_rows)))
        one = int(number[-1]) == 0
        edge = {"first": found.first, "last": found.last}
        edge = {k: pa.StructArray.from_arrays(v, fields=list(schema.field(k).type)) for k, v in edge.items()}
        tokens = int(np.sum(kept.column("n_tokens").to_numpy(zero_copy_only=False))) if mine else 0
        nothing = pa.RecordBatch.from_arrays([pa.array([None], pa.int32())], ["kind"])
        yield record(2, nothing, **edge, flags=pa.array([[one, ended_in[0], ended_in[int(number[-1])],
                                                          whole or kept is None]], pa.list_(pa.bool_())),
                     sizes=pa.array([[tokens, kept.num_rows if mine else 0]], pa.list_(pa.int64())))
    return scan


def _with_items(out: pa.RecordBatch, rows: pa.RecordBatch, first: np.ndarray, at: np.ndarray):
    """``out`` with the messages ``first..at`` of ``rows``, about ``ITEM_BYTES`` at a time."""
    size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(rows.column("text")), 0).to_numpy(zero_copy_only=False) + 16)])
    cost = np.cumsum(size[at + 1] - size[np.minimum(first, at + 1)])
    cut = np.flatnonzero(np.diff(cost // ITEM_BYTES)) + 1
    for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(at)], strict=True):
        if s == e:
            continue
        n = at[s:e] + 1 - first[s:e]
        flat = np.repeat(first[s:e], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        off = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        kind = out.schema.field("items").type
        values = pa.StructArray.from_arrays([rows.column(c).take(pa.array(flat)) for c in ("turn", "role", "text")],
                                            fields=list(kind.value_type))
        lists = pa.ListArray.from_arrays(off, values, type=kind)
        part = out.slice(s, e - s)
        yield pa.RecordBatch.from_arrays([lists if f.name == "items" else part.column(i) for i, f in enumerate(out.schema)],
                                         schema=out.schema)


_MADE = (("kind", T.IntegerType()), ("part", T.IntegerType()), ("head", T.BooleanType()), ("short", T.BooleanType()),
         ("seq", T.LongType()), ("n_messages", T.LongType()), ("history_tokens", T.LongType()))
_GIVEN = ("conv_id", "turn", "role", "text", "n_tokens", "is_exit", "wanted")


def _history_schema(given: pa.Schema) -> pa.Schema:
    simple = {T.BooleanType: pa.bool_(), T.IntegerType: pa.int32(), T.LongType: pa.int64()}
    turn, conv = given.field("turn").type, given.field("conv_id").type
    keys = pa.struct([pa.field("conv_id", conv)])
    item = pa.struct([pa.field(c, given.field(c).type) for c in ("turn", "role", "text")])
    return pa.schema([*[pa.field(n, simple[type(t)]) for n, t in _MADE], *[given.field(c) for c in _GIVEN],
                      pa.field("first_turn", turn), pa.field("items", pa.list_(pa.field("element", item))),
                      pa.field("first", keys), pa.field("last", keys), pa.field("flags", pa.list_(pa.bool_())),
                      pa.field("sizes", pa.list_(pa.int64()))])


def _table_schema(given: T.StructType) -> T.StructType:
    keys = T.StructType([T.StructField("conv_id", given["conv_id"].dataType)])
    item = T.StructType([T.StructField(c, given[c].dataType) for c in ("turn", "role", "text")])
    return T.StructType([*[T.StructField(n, t) for n, t in _MADE], *[T.StructField(c, given[c].dataType) for c in _GIVEN],
                         T.StructField("first_turn", given["turn"].dataType), T.StructField("items", T.ArrayType(item)),
                         T.StructField("first", keys), T.StructField("last", keys),
                         T.StructField("flags", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.LongType()))])


def _halos(edges: Sequence, max_tokens: int, max_messages: int) -> tuple[list[tuple[int, int]], list[int]]:
    """(partition, partition before it whose halo it needs) and the partitions
    whose first group ended before them; ``edges`` in order of partitions."""
    needs, over, ended = [], [], False
    for i, e in enumerate(edges):
        goes_on = i > 0 and edges[i - 1].last == e.first
        if goes_on and ended:
            over.append(e.part)
        if goes_on and not ended:
            tokens = count = 0
            for j in range(i - 1, -1, -1):
                back = edges[j]
                needs.append((e.part, back.part))
                tokens, count = tokens + back.sizes[0], count + back.sizes[1]
                all_kept, goes_back = back.flags[3], back.flags[0] and j > 0 and edges[j - 1].last == back.first
                if not all_kept or not goes_back or tokens > max_tokens or count >= max_messages:
                    break
        one, first_ended, last_ended, _ = e.flags
        ended = bool((goes_on and ended) or first_ended) if one else bool(last_ended)
    return needs, over


def histories(turns: DataFrame, max_tokens: int, *, max_messages: int = MAX_MESSAGES, wanted: Column | None = None,
              is_exit: Column | None = None, chunk_size: int = DEFAULT_CHUNK, partitions: int | None = None) -> DataFrame:
    """Rows ``<conv_id, turn, role, first_turn, n_messages, n_tokens>`` for the
    turns (with ``n_tokens``) before the first ``is_exit`` of their conversation:
    the first turn, messages and tokens of their history.  Where ``wanted``
    holds, ``items`` has its messages (turn, role, text).  Runs jobs when called."""
    t = turns.select(*TURN, F.coalesce(F.col("n_tokens").cast("long"), F.lit(0).cast("long")).alias("n_tokens"),
                     (F.lit(False) if is_exit is None else is_exit).alias("is_exit"),
                     (F.lit(False) if wanted is None else F.coalesce(wanted, F.lit(False))).alias("wanted"))
    if wanted is None:
        t = t.withColumn("text", F.lit(None).cast("string"))
    ranged = in_order(t, [F.col("conv_id").asc(), F.col("turn").asc()], content_columns(t), partitions)
    kind = _table_schema(t.schema)
    items = wanted is not None
    table = stored(ranged.mapInArrow(_histories("conv_id", max_tokens, max_messages, chunk_size, items), kind), "histories")
    edges = sorted(table.where("kind = 2").select("part", "first", "last", "flags", "sizes").collect(),
                   key=lambda e: e.part)  # a row a partition
    needs, over = _halos(edges, max_tokens, max_messages)
    rows = table.where("kind = 0")
    if over:
        rows = rows.where(~(F.col("head") & F.col("part").isin(over)))
    if needs:
        onto = t.sparkSession.createDataFrame(needs, "of int, source int")
        again = table.where("kind = 1").join(F.broadcast(onto), F.col("part") == F.col("source")).select(
            F.col("of"), F.col("source"), *_GIVEN, "seq")
        open_parts = sorted({p for p, _ in needs})
        late = F.col("short") & F.col("part").isin(open_parts)
        anew = rows.where(late).select(F.col("part").alias("of"), F.col("part").alias("source"), *_GIVEN, "seq")
        # a group a partition: its halo, then its first turns
        both = again.withColumn("own", F.lit(False)).unionByName(anew.withColumn("own", F.lit(True)))
        small = both.repartition("of").sortWithinPartitions("of", "source", "seq")
        solved = small.mapInArrow(_solve_again(max_tokens, max_messages, chunk_size, items), kind).where("head")
        rows = rows.where(~late).unionByName(solved)
    return rows.select("conv_id", "turn", "role", "first_turn", "n_messages", F.col("history_tokens").alias("n_tokens"), "items")


def _solve_again(max_tokens: int, max_messages: int, chunk_size: int, items: bool):
    """Histories of the rows that are a partition's ``own``, behind its halo;
    these rows come out with ``head`` set."""
    inner = _histories("of", max_tokens, max_messages, chunk_size, items, edges=False)

    def run(batches):
        own: list[np.ndarray] = []

        def tee():
            for b in batches:
                own.append(b.column("own").to_numpy(zero_copy_only=False))
                yield b
        at, flags = 0, np.empty(0, bool)
        for out in inner(tee()):
            flags = np.concatenate([flags, *own])
            own.clear()
            mine = flags[at:at + out.num_rows]
            at += out.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(mine) if f.name == "head" else out.column(i)
                                              for i, f in enumerate(out.schema)], schema=out.schema)
    return run


def context_at_turn(turns: DataFrame, max_tokens: int, tokenizer_factory=None, chunk_size: int = DEFAULT_CHUNK,
                    max_messages: int = MAX_MESSAGES, partitions: int | None = None) -> DataFrame:
    """Per turn, the visible history after clipping: its first turn,
    message count and token count (no pair enumeration)."""
    t = with_token_counts(turns.select(*TURN), tokenizer_factory)
    return histories(t, max_tokens, max_messages=max_messages, chunk_size=chunk_size, partitions=partitions).drop("items")


def _session_turns(turns: DataFrame, tokenizer_factory) -> DataFrame:
    """turns with user text stripped and token counts, without blank user turns."""
    t = turns.select(*TURN).withColumn("text", F.coalesce(said(), F.col("text")))
    t = t.where(~F.coalesce((F.col("role") == "user") & (F.col("text") == ""), F.lit(False)))
    return with_token_counts(t, tokenizer_factory)


def prompts_for_turns(turns: DataFrame, max_tokens: int, template: ChatTemplate = DEFAULT_TEMPLATE,
                      tokenizer_factory=None, chunk_size: int = DEFAULT_CHUNK, max_messages: int = MAX_MESSAGES,
                      partitions: int | None = None) -> DataFrame:
    """G3 (+F1/F2): the rendered prompt the model sees at every user turn."""
    h = histories(_session_turns(turns, tokenizer_factory), max_tokens, max_messages=max_messages,
                  wanted=F.col("role") == "user", is_exit=_is_exit(), chunk_size=chunk_size, partitions=partitions)
    messages = F.transform("items", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")))
    return h.where("role = 'user'").select("conv_id", "turn", "n_messages",
                                           render_chat(messages, template, add_generation_prompt=True).alias("prompt"))


def context_messages(turns: DataFrame, max_tokens: int, at: Column | None = None, tokenizer_factory=None,
                     chunk_size: int = DEFAULT_CHUNK, max_messages: int = MAX_MESSAGES,
                     partitions: int | None = None) -> DataFrame:
    """One row per turn (those ``at`` holds for) and message of its history:
    conv_id, at_turn, pos (0 is the turn itself, 1 the message before it), turn,
    role, text.  Turns with an empty history keep one row without a message."""
    wanted = F.lit(True) if at is None else at
    h = histories(with_token_counts(turns.select(*TURN), tokenizer_factory), max_tokens, max_messages=max_messages,
                  wanted=wanted, chunk_size=chunk_size, partitions=partitions)
    h = h if at is None else h.where(at)
    m = h.select("conv_id", F.col("turn").alias("at_turn"), "n_messages", F.posexplode_outer("items").alias("i", "m"))
    return m.select("conv_id", "at_turn", (F.col("n_messages") - 1 - F.col("i")).alias("pos"), "m.*")
