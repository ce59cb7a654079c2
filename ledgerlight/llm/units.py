"""Cuts of a text that no piece of the byte-level pattern spans, and a memo of what they encode to."""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np

#: A space beside another white-space character: such texts are cut with look-arounds.
_RUN = re.compile(r" (?:(?=\s)|(?<=\s ))")
_CUT = re.compile(r"(?<=\S)(?= \S)")

#: Distinct units that a worker remembers before it starts anew; bounds its memory.
MEMO_UNITS = 300_000


def units(text: str) -> list[str]:
    """Consecutive parts of ``text``, cut before each single space between two other characters.

    The pattern takes such a space as the first character of the next piece, so encoding the parts
    one by one gives what encoding the whole text gives.
    """
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or "\0" in text or _RUN.search(text):
        return _CUT.split(text)
    return text.replace(" ", "\0 ").split("\0")


class Memo:
    """Remembers the ids of units; :meth:`encode` gives the ids of whole texts.

    ``encode_new`` gets distinct units and returns them in an order of its own, their ids in that order,
    concatenated, and the count of each.  ``cut`` gives the units of a text.
    """

    def __init__(self, encode_new: Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray]], limit: int = MEMO_UNITS,
                 cut: Callable[[str], list[str]] = units):
        self.encode_new, self.limit, self.cut = encode_new, limit, cut
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids, self.offset = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)

    def _add(self, new: list[str]) -> None:
        new, ids, counts = self.encode_new(new)
        n, used = len(self.at), int(self.offset[len(self.at)])
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(new) + 1 > len(self.offset):
            self.offset = np.concatenate([self.offset, np.zeros_like(self.offset)])
        self.ids[used:used + len(ids)] = ids
        self.offset[n + 1:n + len(new) + 1] = used + np.cumsum(counts)
        self.at.update(zip(new, range(n, n + len(new))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, concatenated, and each text's count of ids."""
        cut = [self.cut(t) for t in texts]
        if len(self.at) > self.limit:
            self.clear()
        new = dict.fromkeys(chain.from_iterable(cut)).keys() - self.at.keys()
        if new:
            self._add(list(new))
        parts = np.fromiter(map(self.at.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        first = self.offset[parts]
        counts = self.offset[parts + 1] - first
        flat = spans(self.ids, first, counts)
        ends = np.concatenate([[0], np.cumsum(counts)])
        text_ends = ends[np.cumsum([0, *map(len, cut)])]
        return flat, np.diff(text_ends)


def spans(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values at ``first[i]`` to ``first[i] + counts[i] - 1`` for all i, concatenated."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(first - (ends - counts), counts)]
