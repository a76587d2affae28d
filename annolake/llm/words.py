"""Words of whole texts as spans over one byte buffer: runs of digits, letters (A-Z lower-cased) and all of non-ASCII."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from annolake.llm.common import mixed, prefix_hashes, slices, span_hash, text_buffers

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0") : ord("9") + 1] = _IN_WORD[ord("a") : ord("z") + 1] = _IN_WORD[0x80:] = True


@dataclass
class Words:
    """Lower-cased bytes, and the words of all rows one after the other; row k has words first[k] .. first[k + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(data: np.ndarray, offsets: np.ndarray) -> Words:
        """``data``: bytes of all texts, ``offsets``: where each text starts in them. No word crosses from one text into the next."""
        low = _LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _IN_WORD[low]
        begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges] |= inside[1:-1][edges]
        stops[edges - 1] |= inside[1:-1][edges - 1]
        starts = np.flatnonzero(begins)
        return Words(low, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hash(prefix_hashes(self.data), self.starts, self.ends)

    def text(self, a: int, b: int) -> bytes:
        """Words a .. b with one blank between."""
        raw = self.data
        return b" ".join([raw[s:e].tobytes() for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True)])


def blocks(texts: pa.Array, most_bytes: int, most_rows: int = 1 << 16) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) for runs of rows of about ``most_bytes``; a longer text is a run of its own."""
    data, offsets = text_buffers(texts)
    for a, b in slices(offsets, most_bytes):
        for first in range(a, b, most_rows):
            end = min(first + most_rows, b)
            lo, hi = offsets[first], offsets[end]
            yield first, end, Words.of(data[lo:hi], offsets[first : end + 1] - lo)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 words have none."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n])
    return out
