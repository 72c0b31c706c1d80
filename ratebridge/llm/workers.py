"""Helpers for code that runs in Python workers: caches with a bound, words, Arrow batches."""

from __future__ import annotations

import re
import sys
import types

#: A word is a run of characters other than the space and U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)


class TwoGenerationCache(dict):
    """A mapping that computes missing values and holds at most twice ``cap`` entries.

    When the young generation is full it becomes the old one; an old entry that
    is asked for again moves back, so frequent keys stay.
    """

    def __init__(self, compute, cap: int):
        super().__init__()
        self.compute, self.cap, self.old = compute, cap, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.cap:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    module = sys.modules.setdefault("ratebridge_worker_state", types.ModuleType("ratebridge_worker_state"))
    return module.__dict__.setdefault("state", {})


def per_worker(key, make):
    """The object of that key in this worker, made on first use; the one of another key goes.

    Workers serve one step after another, so only the step at hand keeps memory.
    """
    state = worker_state()
    if key not in state:
        state.clear()
        state[key] = make()
    return state[key]


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves; the others take code points from 256 on.
    """
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in keep else next(spare)) for b in range(256)]
