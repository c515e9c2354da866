"""Hashed words, and postings that travel as packed blobs instead of single rows.

A posting is (64-bit value, owner, more numbers). A map task sorts a batch of postings by
bucket and writes one compressed blob per bucket, so the shuffle carries a few bytes per
posting and no row overhead. The number of buckets follows the size of the input, and tasks take
one bucket at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard

BATCH_POSTINGS = 1_000_000
BUCKET_BYTES = 12 << 20
MIN_BUCKETS = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def bucket_count(total_bytes: int) -> int:
    """Buckets for an input of so many bytes of text."""
    return max(MIN_BUCKETS, -(-int(total_bytes or 0) // BUCKET_BYTES))


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def scrambled(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(31))) * _MIX
    values = (values ^ (values >> np.uint64(27))) * _ODD
    return values ^ (values >> np.uint64(33))


def runs_of_words(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive words."""
    count = len(hashes) - length + 1
    total = hashes[:count].copy()
    for step in range(1, length):
        total *= _ODD
        total += hashes[step : step + count]
    return scrambled(total)


def dump(*parts) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, protocol=5))


def load(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _planes(values: np.ndarray) -> np.ndarray:
    """Byte planes of the differences of sorted numbers: the high planes are nearly empty."""
    steps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)


def _unplaned(planes: np.ndarray) -> np.ndarray:
    steps = np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)
    return np.cumsum(steps, dtype=np.uint64)


def _name_planes(names: list[bytes]):
    """Byte planes of names of one length, which need no framing; other names as they are."""
    width = len(names[0])
    if not width or any(len(one) != width for one in names):
        return names
    return np.ascontiguousarray(np.frombuffer(b"".join(names), np.uint8).reshape(-1, width).T)


def _names(planes) -> list[bytes]:
    if isinstance(planes, list):
        return planes
    width, flat = len(planes), np.ascontiguousarray(planes.T).tobytes()
    return [flat[at : at + width] for at in range(0, len(flat), width)]


class Postings:
    """Collects postings of many owners and hands them out as (bucket, blob)."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.values: list[np.ndarray] = []
        self.more: list[np.ndarray] = []
        self.owners: list[bytes] = []
        self.size = 0

    def add(self, owner: bytes, values: np.ndarray, more: np.ndarray | None = None) -> None:
        self.values.append(values)
        if more is not None:
            self.more.append(more)
        self.owners.append(owner)
        self.size += len(values)

    def full(self) -> bool:
        return self.size >= BATCH_POSTINGS

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if not self.size:
            return
        values = np.concatenate(self.values)
        lengths = [len(part) for part in self.values]
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        more = np.concatenate(self.more) if self.more else None
        bucket = (values % np.uint64(self.buckets)).astype(np.int32)
        order = np.lexsort((values, bucket))
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        owners = self.owners
        self.clear()
        for number in range(self.buckets):
            part = order[edges[number] : edges[number + 1]]
            if len(part):
                used, at = np.unique(owner[part], return_inverse=True)
                yield number, dump(
                    _planes(values[part]),
                    at.astype(np.uint16 if len(used) < 65536 else np.int32),
                    _name_planes([owners[one] for one in used]),
                    None if more is None else more[part],
                )


def gather(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray | None]:
    """All postings of a bucket: values, owner numbers, owners, more. Equal owners get one number."""
    numbers: dict[bytes, int] = {}
    values, owner, more = [], [], []
    for blob in blobs:
        planes, at, names, extra = load(blob)
        owners = _names(names)
        known = np.fromiter(
            (numbers.setdefault(one, len(numbers)) for one in owners), np.int32, len(owners)
        )
        values.append(_unplaned(planes))
        owner.append(known[at])
        if extra is not None:
            more.append(extra)
    return (
        np.concatenate(values),
        np.concatenate(owner),
        list(numbers),
        np.concatenate(more) if more else None,
    )


def by_key(batches, key: str, columns: list[str]) -> Iterator[tuple[object, list[tuple]]]:
    """Rows of a partition sorted by ``key``, one key at a time, across batch borders."""
    current, rows = None, []
    for frame in batches:
        lists = [frame[name].tolist() for name in columns]
        for at, value in enumerate(frame[key].tolist()):
            if rows and value != current:
                yield current, rows
                rows = []
            current = value
            rows.append(tuple(part[at] for part in lists))
    if rows:
        yield current, rows
