"""Words, lines and rolling hashes of whole Arrow columns of text, in numpy.

All functions work on bytes of UTF-8: the characters that end a word are ASCII,
so no word boundary lies inside a character. A batch is cut into blocks of whole
texts, so memory is bounded by the block size or one text, whichever is larger.
Hashes are polynomials modulo 2**64 over mixed values (Rabin-Karp), so that any
run of symbols is one subtraction and one product, and are mixed once more.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20
# Powers that a worker keeps from block to block; making them anew takes little beside what they are used for.
KEPT_POWERS = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _word_table(breaks: list[int]) -> np.ndarray:
    table = np.ones(256, bool)
    table[breaks] = False
    return table


SPACES = [*range(0x09, 0x0E), 0x20]
# Bytes of a word: everything but white space; and letters of either case, digits and all beyond ASCII.
NOT_SPACE = _word_table(SPACES)
ALNUM = _word_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)``; kept for the next block where they are not many."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= KEPT_POWERS:
            _powers[name] = have
    return have[:n]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run ``symbols[start:end]`` of 64-bit symbols."""
    n = len(symbols)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(symbols * _power("up", _BASE, n), out=sums[1:])
    inverse = _power("down", _INVERSE, n + 1)
    runs = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(runs + (ends - starts).astype(np.uint64) * _BASE)


@dataclass
class Block:
    """Whole texts, one after the other: ``data[offsets[i]:offsets[i + 1]]`` is text i."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words by their byte ranges; those of text i are ``first[i]`` to ``first[i + 1] - 1``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def text_block(column: pa.Array | pa.ChunkedArray) -> Block:
    """The column as one block; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Block(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def give_back() -> None:
    """Return what was freed to the system: workers outlive their tasks and share their executor's memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """The rows of the batches in blocks of about ``size`` bytes of text; a longer text is a block of its own."""
    for batch in batches:
        whole = text_block(batch[column])
        begin = 0
        while begin < len(whole):
            end = int(np.searchsorted(whole.offsets, whole.offsets[begin] + size, "right")) - 1
            end = min(max(end, begin + 1), len(whole))
            offsets = whole.offsets[begin : end + 1]
            yield batch.slice(begin, end - begin), Block(whole.data[offsets[0] : offsets[-1]], offsets - offsets[0])
            begin = end
        del batch, whole
        give_back()


def find_words(block: Block, table: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of bytes that ``table`` accepts, none across two texts."""
    inside = table[block.data]
    n = len(inside)
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    bounds = block.offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < n)]
    begins[bounds] = inside[bounds]
    stops[bounds - 1] = inside[bounds - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(starts, ends, np.searchsorted(starts, block.offsets))


def word_hashes(block: Block, words: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, A-Z as a-z if ``lower``."""
    data = LOWER[block.data] if lower else block.data
    return span_hashes(_SYMBOLS[data], words.starts, words.ends)


def windows(hashes: np.ndarray, words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of one text, and the index of each one's first word."""
    counts = np.maximum(words.counts() - n + 1, 0)
    total = int(counts.sum())
    skipped = np.repeat(words.first[:-1] - (np.cumsum(counts) - counts), counts)
    at = np.arange(total) + skipped
    return span_hashes(hashes, at, at + n), at


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in one of the runs of ``n`` that start at ``at``."""
    begins, ends = (np.bincount(x, minlength=total + 1).astype(np.int32) for x in (at, at + n))
    return np.cumsum(begins - ends)[:total] > 0


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]``."""
    running = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=running[1:])
    return np.diff(running[bounds])


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs twice or more, and whether it occurred before (in array order)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys), bool)
    same[1:] = ranked[1:] == ranked[:-1]
    twice = same.copy()
    twice[:-1] |= same[1:]
    several, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    several[order], later[order] = twice, same
    return several, later


_CODEC = "zstd"


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers in few bytes: equal bytes of neighbours side by side, then compressed."""
    raw = np.ascontiguousarray(values, np.uint64)
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(raw).to_bytes(4, "little") + pa.compress(planes, codec=_CODEC, asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    planes = pa.decompress(packed[4:], decompressed_size=8 * n, codec=_CODEC, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view(np.uint64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """``pack`` of ascending numbers by their differences."""
    return pack(np.diff(values, prepend=np.zeros(1, np.uint64)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64)
