"""Whole texts as byte arrays: word positions and word hashes for many texts at once.

Everything works on blocks of consecutive texts of about ``BLOCK_BYTES`` (one longer text is its own
block), so the memory of a task follows the longest text, not the size of its partition.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

# Separators of the word rule [^\x20\x09-\x0D]+, as bytes; UTF-8 keeps all other characters above them.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of the splitmix generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


_powers = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for later blocks unless very long."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if len(have) <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


@dataclass
class Block:
    """Consecutive texts: their bytes and where each one begins; ``first`` is the row of the first one."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column (NULL as empty) in blocks of about ``size`` bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    _, ends, values = texts.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield Block(raw[ends[start] : ends[stop]], ends[start : stop + 1] - ends[start], start)
        start = stop


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


@lru_cache(maxsize=1)
def _word_bytes() -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(SEPARATORS)] = False
    return table


@dataclass
class Words:
    """Words of a block: byte spans, and for each text the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def owner(self) -> np.ndarray:
        """The text each word belongs to, by position in the block."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(block: Block, table: np.ndarray | None = None) -> Words:
    """Maximal runs of word bytes; a run never crosses from one text to the next."""
    inside = (_word_bytes() if table is None else table)[block.data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = block.offsets[:-1]
    edges = edges[edges < len(inside)]
    begin[edges] |= inside[edges]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    last = block.offsets[1:] - 1
    last = last[last >= 0]
    finish[last] |= inside[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return Words(starts, ends, np.searchsorted(starts, block.offsets))


@lru_cache(maxsize=1)
def _term_bytes() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[ord("0") : ord("9") + 1] = True
    table[ord("a") : ord("z") + 1] = True
    table[0x80:] = True
    return table


def terms(texts: pa.Array) -> Iterator[tuple[Block, Words]]:
    """Case-folded blocks with their terms: runs of digits, a-z and characters beyond ASCII."""
    for block in blocks(pc.utf8_lower(texts.fill_null(""))):
        yield block, words(block, _term_bytes())


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[data] * _power(_BASE, n), dtype=np.uint64, out=sums[1:])
    values = (sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts]
    return mix(values + (ends - starts).astype(np.uint64))


_STEPS = mix(np.arange(101, 133, dtype=np.uint64))


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width`` consecutive words within each text, and the range of windows of each text.

    A text with fewer words has no window.
    """
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    out_bounds = np.concatenate(([0], np.cumsum(counts)))
    total = len(hashes) - width + 1
    if total <= 0 or not out_bounds[-1]:
        return np.zeros(0, dtype=np.uint64), out_bounds
    rolled = np.zeros(total, dtype=np.uint64)
    for i in range(width):
        rolled += hashes[i : i + total] * (_STEPS[i] | np.uint64(1))
    position = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
    return mix(rolled[position]), out_bounds


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """One hash of a whole short sequence of words, different from any window hash of the same words."""
    out = np.uint64(len(hashes) + 1)
    for h in hashes:
        out = mix(np.array([(int(out) * _BASE + int(h)) & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0]
    return out
