"""Token counts by batch encoding inside Arrow functions.

Only lengths leave the tasks.  Texts are encoded in batches of about
``BATCH_BYTES`` bytes, so one batch of long texts holds few of them.

*Safe boundaries* (``.model`` files): the library writes a space as U+2581.
Where no piece has a U+2581 after another character, and the normaliser
neither rewrites characters nor drops spaces, no merge can cross the gap
before a single space; the dummy prefix then restores the space of what
follows.  Texts are split there, long ones first into chunks, and the pieces
of a batch that were not met yet are encoded once.  A model without these
properties, and ``.json`` tokenizers, get whole texts.

Defined cases: null text is empty; an empty text has no tokens; special
strings are handled as the library's default does; very long texts are split at
safe boundaries, and encoded whole where they have none (no interior space, or a
``.json`` tokenizer); repeated rows and null ``doc_id`` keep their rows; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.llm.kernels import held, row_slices, text_buffer

BATCH_BYTES = 1 << 20
MEMO_PIECES = 1 << 18   # pieces whose counts a task remembers
MEMO_CHARS = 48         # longest piece that is remembered
_GAP = "▁"
_SAFE = re.compile(f"(?<=[^ {_GAP}]) (?=[^ {_GAP}])")


class PieceCounter:
    """Counts for a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb2
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        self.safe = (norm.add_dummy_prefix and norm.escape_whitespaces and not norm.precompiled_charsmap
                     and not norm.remove_extra_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
                     and not any(_GAP in p.piece.lstrip(_GAP) for p in spec.pieces))
        self.memo: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        if not self.safe or not text:
            return [text]
        if "  " in text or _GAP in text or text[0] == " " or text[-1] == " ":
            return _SAFE.split(text)
        return text.split(" ")

    def chunks(self, text: str) -> Iterator[str]:
        """The text cut at safe boundaries about every ``BATCH_BYTES``."""
        at = 0
        while self.safe and len(text) - at > BATCH_BYTES:
            m = _SAFE.search(text, at + BATCH_BYTES)
            if m is None:
                break
            yield text[at:m.start()]
            at = m.end()
        yield text[at:] if at else text

    def counts(self, texts: list[str]) -> list[int]:
        parts = [self.split(t) for t in texts]
        new = set().union(*parts).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_PIECES:
            self.memo = {}
            new = set().union(*parts)
        pieces = list(new)
        size = dict(zip(pieces, map(len, self.model.encode(pieces, num_threads=1)), strict=True)) if pieces else {}
        self.memo.update(size)
        get = self.memo.__getitem__
        out = [sum(map(get, p)) for p in parts]
        for p in pieces:
            if len(p) > MEMO_CHARS:
                del self.memo[p]
        return out


class WholeCounter:
    """Counts for a tokenizers file; nothing is known of safe boundaries."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def chunks(self, text: str) -> Iterator[str]:
        yield text

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch(texts, add_special_tokens=False)]


def counter(path: str) -> PieceCounter | WholeCounter:
    return held(("counter", path), lambda: (PieceCounter if path.endswith(".model") else WholeCounter)(path))


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = counter(path)
        for b in batches:
            buf, off = text_buffer(b.column("text"))
            n = np.zeros(b.num_rows, np.int64)
            for lo, hi in row_slices(off, BATCH_BYTES):
                rows, texts = [], []
                for i in range(lo, hi):
                    for c in model.chunks(buf[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace")):
                        rows.append(i)
                        texts.append(c)
                        if len(c) >= BATCH_BYTES:
                            np.add.at(n, rows, model.counts(texts))
                            rows, texts = [], []
                if rows:
                    np.add.at(n, rows, model.counts(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean"))
