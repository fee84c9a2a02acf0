"""Texts in blocks: the distinct words of a block once, and the places where they stand."""

from __future__ import annotations

import numpy as np


class LocalCodes(dict):
    """Word -> its number in the order of first sight."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


def by_frequency(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes renumbered so that frequent ones are small, old number of each new one, its count)."""
    counts = np.bincount(codes, minlength=n)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(n, np.uint32)
    rank[order] = np.arange(n, dtype=np.uint32)
    return rank[codes], order, counts[order]


def squeeze(numbers: np.ndarray) -> bytes:
    """Byte planes of the numbers, compressed: small numbers leave the upper planes empty."""
    import zstandard

    planes = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).data)


def unsqueeze(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches flat[start : start + length], one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    small = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.repeat((starts - (ends - lengths)).astype(small), lengths)
    at += np.arange(total, dtype=small)
    return flat[at]
