"""White-space chunks of texts turned into token ids, each distinct chunk once per task."""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

import numpy as np
import regex

# What the tokenizer's pattern calls white space.
WHITE = "\u0009-\u000d \u0085   -     　"
_SPLIT = regex.compile(f"[^{WHITE}]+")
# str.split() also cuts at these four, which the tokenizer takes for ordinary characters.
_ODD = regex.compile("[\u001c-\u001f]")
# Memory bounds of the cache; beyond them the cache starts anew. They never change a result.
CACHE_CHUNKS = 400_000
CACHE_IDS = 16 << 20


def chunks_of(text: str) -> list[str]:
    return _SPLIT.findall(text) if _ODD.search(text) else text.split()


def take_segments(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The segments flat[start:start + size], one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


class Numbers(dict):
    """Numbers chunks in order of first appearance."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


class ChunkEncoder:
    """Token ids of texts whose tokens never cross white space.

    `resolve` turns a list of chunks into their ids: all ids in one array, and the number of ids of each chunk.
    """

    def __init__(self, resolve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self._resolve = resolve
        self._clear()

    def _clear(self) -> None:
        self._numbers = Numbers()
        self._flat = np.zeros(0, np.uint32)
        self._starts = np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids start (one entry more than texts)."""
        if len(self._numbers) > CACHE_CHUNKS or len(self._flat) > CACHE_IDS:
            self._clear()
        known = len(self._numbers)
        number, parts, counts = self._numbers.__getitem__, [], [0]
        for text in texts:
            cut = chunks_of(text) if text else []
            parts.append(np.fromiter(map(number, cut), np.int32, len(cut)))
            counts.append(len(cut))
        if len(self._numbers) > known:
            new = list(islice(self._numbers, known, None))
            flat, sizes = self._resolve(new)
            self._flat = np.concatenate([self._flat, flat])
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
        which = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        begin = self._starts[which]
        sizes = self._starts[which + 1] - begin
        ends = np.zeros(len(which) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        return take_segments(self._flat, begin, sizes), ends[np.cumsum(counts)]
