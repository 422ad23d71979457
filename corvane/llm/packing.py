"""Packing of token sequences by cutting-stock column generation.

Documents are tokenized once, in the tasks; a document longer than a sequence is cut into
whole sequences and a rest, and a rest of more than half a sequence into a half and the
remainder, since nothing but rare complements would fit beside it. What is left to do is the cutting-stock problem over the
histogram of piece lengths, which has at most ``capacity`` entries whatever the corpus: a
linear program over patterns (how many pieces of each length share a sequence), to which
a knapsack dynamic program adds the pattern that pays most at the current prices until none
does. Patterns are used a rounded-down number of times, and the few pieces left over are
packed largest first. Pieces of one length are then ranked in Spark, by blocks so that no
length is one task's, and a piece's rank tells its pattern, sequence and offset.

Nulls and edge cases: a null or empty text is the one closing id 0. Repeated rows are packed
each for itself; a null ``doc_id`` is passed through. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.exchange import written
from corvane.llm.tokens import default_vocabulary, encode

CAPACITY = 1024
END = 0
# Pieces that are ranked together; a length of more pieces is ranked in several blocks.
PIECES_PER_BLOCK = 5_000
# The linear program ends when its value is proven to be within this share of the optimum, or
# at the latest after so many columns; what it has then holds all pieces as well.
GAP = 2e-3
MAX_COLUMNS = 2_000

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _cutter(vocabulary: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encode(vocabulary, text.as_py(), special=True), np.uint32(END)).astype("<u4")
                whole, half = len(ids) // capacity * capacity, capacity // 2
                starts = [*range(0, len(ids), capacity)]
                if len(ids) - whole > half:
                    starts.append(whole + half)
                for start, end in zip(starts, [*starts[1:], len(ids)], strict=True):
                    piece = ids[start:end]
                    rows.append((doc_id.as_py(), start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return cut


def pieces(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The documents' ids in pieces of at most ``capacity``: place, length and checksum."""
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(_cutter(vocabulary or default_vocabulary(), capacity), PIECES)


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each length make the dearest pattern that fits."""
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = np.searchsorted(lengths, room, "right")
        best[room] = best[room - 1]
        if fit:
            worth = prices[:fit] + best[room - lengths[:fit]]
            k = int(worth.argmax())
            if worth[k] > best[room] + 1e-12:
                best[room], chosen[room] = worth[k], k
    pattern, room = np.zeros(len(lengths)), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
        else:
            pattern[chosen[room]] += 1
            room -= lengths[chosen[room]]
    return pattern


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns ``{length: pieces}`` and how often each is used; together they hold the histogram exactly.

    A revised simplex over a square basis of patterns; it starts with those of ``_first_basis``.
    """
    wanted = {k: n for k, n in sorted(histogram.items()) if n > 0 and k < capacity}
    used: list[tuple[dict[int, int], int]] = []
    if full := histogram.get(capacity, 0):
        used.append(({capacity: 1}, full))
    left = Counter(wanted)
    if wanted:
        lengths, demand = np.array(list(wanted)), np.array(list(wanted.values()), float)
        basis, amount = _first_basis(lengths, demand, capacity)
        inverse = None
        volume = float(lengths @ demand) / capacity
        for _ in range(MAX_COLUMNS):
            if amount.sum() - volume < max(0.5, GAP * volume):
                break
            inverse = _inverse(basis) if inverse is None else inverse
            prices = inverse.sum(axis=0)
            pattern = _knapsack(lengths, prices, capacity)
            worth, total = float(prices @ pattern), float(amount.sum())
            least = max(total / worth, volume)
            if worth <= 1 + 1e-9 or total - least < max(0.5, GAP * total):
                break
            parts = np.flatnonzero(pattern)
            change = (inverse[:, parts] * pattern[parts]).sum(axis=1)
            steps = np.divide(amount, change, out=np.full(len(amount), np.inf), where=change > 1e-9)
            out = int(steps.argmin())
            amount -= steps[out] * change
            amount[out] = steps[out]
            np.maximum(amount, 0, out=amount)
            basis[:, out] = pattern
            pivot = inverse[out] / change[out]
            inverse -= np.outer(change, pivot)
            inverse[out] = pivot
        for column in np.argsort(-amount, kind="stable"):
            pattern = {int(lengths[i]): int(basis[i, column]) for i in np.flatnonzero(basis[:, column])}
            times = min(int(amount[column] + 1e-6), *(left[k] // n for k, n in pattern.items()))
            if times > 0:
                used.append((pattern, times))
                left.subtract({k: n * times for k, n in pattern.items()})
    return used + _best_fit(+left, capacity)


def _filling(left: dict[int, float], capacity: int) -> Counter:
    """A pattern of the largest length and, of the others, a set that fills it best (subset sums as bits of a number)."""
    largest = max(left)
    room = capacity - largest
    repeats = 1 if len(left) > 40 else capacity
    items = [k for k in sorted(left, reverse=True) for _ in range(min(int(left[k]) - (k == largest), room // k, repeats))]
    mask = (1 << (room + 1)) - 1
    reached = [1]
    for k in items:
        reached.append((reached[-1] | reached[-1] << k) & mask)
        if reached[-1] >> room:
            break
    pattern, filled = Counter({largest: 1}), reached[-1].bit_length() - 1
    for i in range(len(reached) - 1, 0, -1):
        if not reached[i - 1] >> filled & 1:
            pattern[items[i - 1]] += 1
            filled -= items[i - 1]
    return pattern


def _first_basis(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns, each used until it has used up a length: as many as lengths, and independent."""
    at = {int(k): i for i, k in enumerate(lengths)}
    left = {int(k): float(n) for k, n in zip(lengths, demand, strict=True)}
    basis, amount = np.diag((capacity // lengths).astype(float)), np.zeros(len(lengths))
    while left:
        pattern = _filling({k: max(1.0, n) for k, n in left.items()}, capacity)
        used_up = min(pattern, key=lambda k: left[k] / pattern[k])
        times = left[used_up] / pattern[used_up]
        basis[:, at[used_up]] = 0
        for k, n in pattern.items():
            basis[at[k], at[used_up]] = n
            left[k] -= n * times
        amount[at[used_up]] = times
        left = {k: n for k, n in left.items() if k != used_up and n > 1e-9}
    return basis, amount


def _inverse(basis: np.ndarray) -> np.ndarray:
    """By elimination, pivot by pivot, in plain array operations: a threaded linear algebra
    library beside the driver's JVM has been seen to stall."""
    m = len(basis)
    both = np.hstack([basis, np.eye(m)])
    for k in range(m):
        pivot = k + int(np.abs(both[k:, k]).argmax())
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        factors = both[:, k].copy()
        factors[k] = 0
        rows = np.flatnonzero(factors)
        both[rows] -= factors[rows, None] * both[k]
    return both[:, m:]


def _best_fit(left: Counter, capacity: int) -> list[tuple[dict[int, int], int]]:
    """The left-over pieces, fewer than fill a sequence for each pattern."""
    patterns: Counter = Counter()
    while left:
        pattern = _filling(left, capacity)
        times = min(left[k] // n for k, n in pattern.items())
        left = left - Counter({k: n * times for k, n in pattern.items()})
        patterns[tuple(sorted(pattern.items()))] += times
    return [(dict(p), n) for p, n in patterns.items()]


def _slots(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first rank, next rank, first sequence, pieces per sequence, offset)`` of each pattern's share of a length."""
    slots, ranks, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            slots.append((length, ranks[length], ranks[length] + n * times, sequence, n, offset))
            ranks[length] += n * times
            offset += n * length
        sequence += times
    return slots


def pack(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Each piece with its sequence and its offset there; sequences have no gap before their padding."""
    spark = documents.sparkSession
    cut = written(pieces(documents, vocabulary, capacity), "pieces")
    blocks = -(-cut.count() // PIECES_PER_BLOCK) or 1
    # Equal pieces, of repeated rows, are one row with its number of copies, so they are in no one's way.
    cut = cut.groupBy(*cut.columns).agg(F.count("*").alias("copies"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)))
    counts = cut.groupBy("length", "block").agg(F.sum("copies").alias("n"))
    # At most ``capacity`` rows, whatever the corpus.
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        _slots(plan(histogram, capacity)) or [(0, 0, 0, 0, 1, 0)],
        "length bigint, low bigint, high bigint, sequence bigint, per bigint, base bigint",
    )
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32", "doc_tokens").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("begin") + F.coalesce(F.sum("copies").over(within), F.lit(0))
    ranked = cut.join(begins, ["length", "block"]).withColumn("first", first)
    ranked = ranked.withColumn("rank", F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)))
    # The slots follow from at most ``capacity`` patterns and the left-over ones: bounded, whatever the corpus.
    placed = ranked.join(F.broadcast(slots), "length").where("rank >= low and rank < high")
    return placed.selectExpr(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        "sequence + (rank - low) div per as sequence_id",
        "base + (rank - low) % per * length as offset",
    )
