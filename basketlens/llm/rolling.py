"""Words, lines and rolling hashes of many texts at once, in numpy.

A polynomial in an odd base over 64-bit wrapping numbers can be divided by
powers of the base, so the hash of any stretch comes from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; one longer text goes alone.
GROUP_BYTES = 1 << 18
#: Rows of which the texts are Python strings at once.
SLICE_ROWS = 512

_BASES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of a split-mix generator)."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_BYTE_VALUES = [mixed(np.arange(256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) for k in range(2)]


class _Powers:
    """Powers of a base and of its inverse, extended as needed."""

    def __init__(self, base: int):
        self.steps = (base, pow(base, -1, 2**64))
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            n = max(n, 2 * len(self.tables[0]))
            for i, step in enumerate(self.steps):
                factors = np.full(n, step, np.uint64)
                factors[0] = 1
                self.tables[i] = np.cumprod(factors)
        return self.tables


_POWERS = [_Powers(b) for b in _BASES]


class Rolling:
    """Hashes of stretches of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, kind: int = 0):
        powers, self.inverse = _POWERS[kind].upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def windows(self, n: int) -> np.ndarray:
        """Hashes of all stretches of length ``n``."""
        last = len(self.sums) - n
        if last <= 0:
            return np.empty(0, np.uint64)
        return mixed((self.sums[n:] - self.sums[:last]) * self.inverse[:last] + np.uint64(n))


def byte_values(data: np.ndarray, kind: int = 0) -> np.ndarray:
    return _BYTE_VALUES[kind][data]


def as_bytes(text: str | bytes | None) -> bytes:
    return b"" if text is None else text if isinstance(text, bytes) else text.encode()


def grouped(texts: Iterable[str | bytes | None], limit: int = GROUP_BYTES) -> Iterator[list[bytes]]:
    """Texts in UTF-8, in groups of about ``limit`` bytes."""
    group, held = [], 0
    for text in texts:
        raw = as_bytes(text)
        group.append(raw)
        held += len(raw)
        if held >= limit:
            yield group
            group, held = [], 0
    if group:
        yield group


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few rows, without a copy."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


class Words:
    """The words of a group of texts: maximal runs of bytes other than the
    space and 0x09 to 0x0D."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_ends = np.cumsum(sizes)
        self.text_starts = self.text_ends - sizes
        self.space = _IS_SPACE[self.data]
        edges = np.flatnonzero(np.diff(self.space, prepend=True))
        self.starts, self.ends = edges[0::2], edges[1::2]
        #: Words before each text, and in it.
        self.firsts = np.searchsorted(self.starts, self.text_starts)
        self.counts = np.searchsorted(self.starts, self.text_ends) - self.firsts
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self, kind: int = 0) -> np.ndarray:
        """A hash of each word, from ``GROUP_BYTES`` at a time: the powers
        that a worker holds are then few, however long the texts are."""
        found, at = np.empty(len(self.starts), np.uint64), 0
        while at < len(self.starts):
            begin = self.starts[at]
            after = max(at + 1, int(np.searchsorted(self.ends, begin + GROUP_BYTES, side="right")))
            rolling = Rolling(byte_values(self.data[begin : self.ends[after - 1]], kind), kind)
            found[at:after] = rolling.of(self.starts[at:after] - begin, self.ends[at:after] - begin)
            at = after
        return found

    def whole(self, n: int) -> np.ndarray:
        """Which windows of ``n`` words lie in one text."""
        last = max(0, len(self.starts) - n + 1)
        return self.text_of[n - 1 :][:last] == self.text_of[:last]


def covered(starts: np.ndarray, lengths: np.ndarray | int, size: int) -> np.ndarray:
    """Which of ``size`` places some stretch covers."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, starts + lengths, 1)
    return np.cumsum(steps[:-1]) > 0


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later
