"""Words and word windows of many texts at once, as numpy arrays over their UTF-8 bytes.

Bytes are split in runs of a few hundred kilobytes, whatever the size of the batch Spark hands
over, so that the memory used does not grow with it; one longer text makes one longer run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 512 * 1024
# Odd multipliers of the rolling hash and of the finishing mix.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
MIX_A = 0xBF58476D1CE4E5B9
MIX_B = 0x94D049BB133111EB


def byte_table(separators: bytes) -> np.ndarray:
    """True for bytes that belong to words."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


# Words are runs of bytes that are no ASCII white space, or runs of ASCII letters, digits and
# everything beyond ASCII.
NOT_SPACE = byte_table(b" \t\n\x0b\x0c\r")
ALNUM = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# What the operator that a Python worker ran last has left for its next task there.
_left: dict[str, object] = {}


def left_over(name: str, make: Callable[[], object]) -> object:
    """What an earlier task of this worker made under this name, or else a new one. Only one thing
    is kept; another operator's first task drops it."""
    if name not in _left:
        _left.clear()
        _left[name] = make()
    return _left[name]


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, RUN_BYTES + 1)
        for i, base in enumerate((BASE, BASE_INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class Run:
    """Some whole texts: `first` is the index of the first in the batch, `n` how many.

    `start` and `end` are the byte places of the words in `data`, `hash` the words' hashes and
    `bounds[i]:bounds[i + 1]` the words of text i.
    """

    def __init__(self, first: int, data: np.ndarray, cuts: np.ndarray, table: np.ndarray):
        self.first, self.n, self.data, self.cuts = first, len(cuts) - 1, data, cuts
        inside = table[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = cuts[(cuts > 0) & (cuts < len(data))]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.start, cuts)
        power, inverse = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * inverse[self.start])

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of k words, and whether each lies within one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        total = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            total *= np.uint64(BASE)
            total += self.hash[j : j + n]
        within = np.ones(n, dtype=bool)
        for cut in range(1, k):
            ends = self.bounds[1:-1] - cut
            within[ends[(ends >= 0) & (ends < n)]] = False
        return mix(total + np.uint64(k)), within

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def runs(texts: pa.Array | pa.ChunkedArray, table: np.ndarray, lower: bool = True) -> Iterator[Run]:
    """The texts of one Arrow column, in order; a null text has no words."""
    _left.clear()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(cuts, cuts[first] + RUN_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = data[cuts[first] : cuts[last]]
        yield Run(first, LOWER[part] if lower else part, cuts[first : last + 1] - cuts[first], table)
        first = last
