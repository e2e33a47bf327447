"""Deterministic stand-ins for models, judges and encoders, whose outputs
DuckDB can recompute.  Only registered queries and tests use them."""

from __future__ import annotations

from collections.abc import Callable, Sequence


class EchoModel:
    """Word-level stand-in: 'generates' by repeating ``max_new_tokens`` words
    of the prompt, from the start (``tail=False``) or from the end."""

    def __init__(self, tail: bool = False):
        self.tail = tail

    def encode(self, texts: list[str]) -> list[list[str]]:
        return [t.split() for t in texts]

    def generate(self, ids: list[list[str]], max_new_tokens: int) -> list[list[str]]:
        return [x + (x[-max_new_tokens:] if self.tail else x[:max_new_tokens]) for x in ids]

    def decode(self, ids: list[list[str]]) -> list[str]:
        return [" ".join(x) for x in ids]


def length_judge() -> Callable[..., str]:
    """Stand-in judge: scores are digits of the user prompt's length."""
    def call(messages, model=None, temperature=None, max_tokens=None) -> str:
        n = len(messages[-1]["content"])
        a = (1 + n % 10, 1 + (n // 10) % 10)
        b = (1 + (n // 100) % 10, 1 + (n // 7) % 10)
        return ('{"model_a": {"correctness": %d, "completeness": %d, "comment": "ok"}, '
                '"model_b": {"correctness": %d, "completeness": %d, "comment": "ok"}}' % (*a, *b))
    return call


def bucket_encoder(dims: int = 16) -> Callable[[list[str]], list[Sequence[Sequence[float]]]]:
    """Stand-in encoder: each whitespace word becomes the one-hot vector of
    the first hex digit of its md5 (so cosine is 1 for equal buckets)."""
    import hashlib

    import numpy as np
    eye = np.eye(dims, dtype=np.float32)

    def enc(texts: list[str]):
        return [eye[[int(hashlib.md5(w.encode("utf-8")).hexdigest()[0], 16) % dims for w in t.split()]]
                for t in texts]
    return enc
