"""Words of whole texts as arrays: hashes, runs of words, and their places.

A word is a run of bytes other than space and 0x09-0x0D. Texts are hashed over their UTF-8
bytes with numpy, many texts at a time, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: For second hashes: another base, and a value for each byte.
_OTHER_BASE = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(20240301).integers(0, 2**64, size=256, dtype=np.uint64)
CHUNK_BYTES = 2 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finishing step of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    """Words of several texts: ``hashes`` and, for text i, words ``bounds[i]:bounds[i+1]``."""

    hashes: np.ndarray
    bounds: np.ndarray
    base: np.uint64 = _BASE
    #: Place of each word in the texts joined by one byte.
    places: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each position; meaningless where they leave the text."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, dtype=np.uint64)
        h = self.hashes[: n - k + 1].copy()
        for j in range(1, k):
            h *= self.base
            h += self.hashes[j : n - k + 1 + j]
        return mix(h)

    def starts(self, k: int) -> np.ndarray:
        """Whether k words from each position stay inside one text."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, dtype=bool)
        left = np.repeat(self.bounds[1:], self.counts) - np.arange(n)
        return left[: n - k + 1] >= k


def _piece(data: bytes, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``data``."""
    a = np.frombuffer(data, dtype=np.uint8)
    body = ~_BLANK[a]
    at = np.flatnonzero(body)
    if not len(at):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    first = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(length.max()), _OTHER_BASE if second else _BASE, dtype=np.uint64))
        if second:
            sums = np.add.reduceat(mix(_BYTES[a[at]] ^ powers[place]), first)
        else:
            sums = np.add.reduceat((a[at].astype(np.uint64) + np.uint64(1)) * powers[place], first)
    return at[first], mix(sums ^ length.astype(np.uint64))


def _cuts(data: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Pieces of about ``size`` bytes that end between words."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + size)
        while end < len(data) and not _BLANK[data[end]]:
            nearest = [p for p in (data.find(bytes([c]), end) for c in (9, 10, 11, 12, 13, 32)) if p >= 0]
            end = min(nearest, default=len(data))
        yield begin, end
        begin = end


def hashed(texts: list[bytes | None], lower: bool = False, second: bool = False) -> Words:
    """Words of ``texts`` (None has none); ``lower`` folds A-Z first.

    With ``second`` the hashes are made another way, so equal ones are independent evidence.
    """
    data = b"\n".join(t or b"" for t in texts)
    if lower:
        data = data.translate(_LOWER)
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    starts, hashes = [], []
    for begin, end in _cuts(data, CHUNK_BYTES):
        s, h = _piece(data[begin:end], second)
        starts.append(s + begin)
        hashes.append(h)
    start = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    bounds = np.concatenate(([0], np.searchsorted(start, ends)))
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), bounds, _OTHER_BASE if second else _BASE, start)


def sliced(texts: list[bytes | None], size: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of ``texts`` of about ``size`` bytes, so that memory does not follow batch sizes."""
    begin = total = 0
    for i, t in enumerate(texts):
        total += len(t or b"")
        if total >= size:
            yield slice(begin, i + 1)
            begin, total = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def utf8(column) -> list[bytes | None]:
    """Values of an Arrow text column as UTF-8 bytes."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def parts(batch_iter: Iterable, column: str = "text", size: int = CHUNK_BYTES) -> Iterator:
    """Arrow batches cut into slices of about ``size`` bytes of a text or binary column."""
    import pyarrow.compute as pc

    for batch in batch_iter:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        full = np.cumsum(lengths.astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            done = full[begin - 1] if begin else 0
            end = min(batch.num_rows, int(np.searchsorted(full, done + size)) + 1)
            yield batch.slice(begin, end - begin)
            begin = end


def spark_hash(ids: np.ndarray) -> np.ndarray:
    """What ``xxhash64`` of Spark SQL gives for 64-bit integers (seed 42)."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (turn(ids.astype(np.int64).view(np.uint64) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return (h ^ (h >> np.uint64(32))).view(np.int64)
