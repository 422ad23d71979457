"""Similarity join of documents by word shingles, with parity sketches.

Two sets of a and b shingles reach the Jaccard similarity ``PERCENT`` only if they differ in at
most d = (a + b)(100 - PERCENT) / (100 + PERCENT) shingles. Every shingle flips one bit of a wide
sketch, so the Hamming distance of two sketches is at most the number of shingles in which the
sets differ. Sketches are cut into m segments, some more than 3d; of two similar documents at
least m - d segments are equal (pigeonhole). d depends on the size, so sketches are laid out per
size band, and a document near the upper end of its band is laid out for the next one as well. A
segment is one number, the XOR of a random number per set bit.

Documents with the same set of shingles are one class throughout, so copies never make pairs. Segments are counted over
the classes, and with all classes putting their segments in the same order, rare
ones first, the first d + 1 of one and of the other must have one in common, as only d of either
can be missing in the other. Segments that no other class has cannot be that one, so a class with d + 1 of these is
similar to none, and others look at the few that are left. Segments in which no bit was set come last.

How it moves:

1. Tasks read texts and send the segments of their classes by ranges of the numbers (``_sender``).
2. A range counts the classes of each segment and tells those that several have to these classes' homes (``_counter``).
3. A home chooses the segments that its classes must look at and sends the classes with a short sketch by ranges of these (``_chooser``).
4. A range compares the classes of each segment: sizes and short sketches leave the pairs that may be similar. Of these
   only a spanning forest is given out, from smaller to larger class, so a group of near copies gives one row per member and not all its pairs (``_pairer``).
5. The forest's trees are gathered over all ranges, so two similar classes are in one tree. Its pairs are verified with their whole sets. Where all of a tree's
   pairs hold, the tree is a component. Where some do not, the tree's classes are held against each other once
   more, those outside its largest proven part against all, with whole sets, until the parts are joined or proven apart (``_crosser``).

A segment of very many classes would fill a range. Such segments are found in a sample of the classes (one in ``SAMPLE_SHARE``): they
are not counted in step 2 but have the sample's count, and in step 4 their classes are dealt out over cells of about ``CELL``, differently for
each segment. If a segment's classes are in several trees after that, every two of its cells are compared. The sample
only says in what order segments come and which are dealt out; the result is the same with any. Trees whose parts must be
compared are likewise cut into cells of about ``CELL_SHINGLES``.

Shingles, classes and segments are 64-bit hashes.

Nulls and edge cases: a text without words has no shingle and is linked with nothing. Repeated rows
give a row each and are one class. A row without ``doc_id`` is linked like any other; the smallest id
of a component is that of its rows that have one. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import texts
from corvane.llm.exchange import shuffle_partitions, written
from corvane.llm.window_dedup import _part_of

SHINGLE = 4
PERCENT = 85
BAND = 1.6
# 64-bit words of the short sketch that a pair is judged by before its sets are read.
SKETCH_WORDS = 8
# Bytes of text handled together, segments that a task holds before it sends them, and about how many a range gets.
BLOCK_BYTES = 1 << 20
SEGMENTS_HELD = 1 << 20
SEGMENTS_PER_RANGE = 2_000_000
# Classes of one segment that are compared in one task, and one in how many classes is sampled for segments with more.
CELL = 1 << 15
SAMPLE_SHARE = 64
# No more segments than this are dealt out, those of the most classes first.
HOT_SEGMENTS = 100_000
# Classes of one segment that are compared all at once, not one against the others.
SMALL_GROUP = 8
# Bits of the filter by which the texts to read again are picked: so many for an id, and at most in all.
FILTER_BITS_PER_ID = 32
FILTER_BITS = 1 << 26
# Bits of one of the bitmaps that Spark's functions make.
BITMAP_BITS = 1 << 15
# Shingles of classes that are held against others in one task, and 64-bit words of the sketches used there.
CELL_SHINGLES = 2_000_000
LONG_SKETCH_WORDS = 32

# The order of segments without a bit: behind all counts.
EMPTY = 255

SIGNED = "doc_id bigint, n_shingles bigint, class bigint, sampled binary"
SENT = "part int, kind int, classes binary, segments binary, members binary, extra binary, sketches binary"
PAIRED = "kind int, segment bigint, a bigint, b bigint, size bigint, sketch binary"
SETS = "class bigint, n bigint, sketch binary, grams binary"
# Kinds of rows that are sent: segments to their range, facts of classes to their home, counted segments to their home, and chosen ones.
TO_RANGE, FACTS, COUNTED, CHOSEN, HOT = range(5)
# Kinds of rows of PAIRED: a pair to verify, and a class of a segment that was dealt out.
EDGE, DEALT = range(2)


def shingle_sets(block: texts.Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text in ascending order, and where those of each text begin.

    A text of fewer words is one shingle.
    """
    words = texts.find_words(block)
    hashes = texts.word_hashes(block, words, lower=True)
    grams, at = texts.windows(hashes, words, size)
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    grams = np.concatenate([grams, texts.span_hashes(hashes, words.first[short], words.first[short + 1])])
    owner = np.concatenate([words.owners()[at], short])
    if len(short):
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(block) + 1))
    for a, b in pairwise(bounds):  # many short sorts take less than one of all
        grams[a:b].sort()
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(block) + 1))


def _classes(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number for each set of shingles."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(texts.mix(grams + np.uint64(1)), out=sums[1:])
    return texts.mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def _bands(largest: int) -> np.ndarray:
    """The smallest size of each band, up to one beyond that of ``largest``."""
    bounds = [1]
    while bounds[-2:][0] <= largest:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * BAND)))
    return np.array(bounds + [max(bounds[-1] + 1, int(bounds[-1] * BAND))])


def _most_apart(both: np.ndarray, percent: int) -> np.ndarray:
    """In how many shingles two similar sets of so many together can differ."""
    return both * (100 - percent) // (100 + percent)


def _layout(sizes: np.ndarray, ahead: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sets of these sizes, in their own band or the one ``ahead``: the band, how many segments there are, and how many must be looked at."""
    bounds = _bands(int(sizes.max(initial=1)))
    band = np.searchsorted(bounds, sizes, "right") - 1
    most = _most_apart(2 * (bounds[1:] - 1), percent)
    of_band = np.where(most > 0, 3 * most + 2, 0)
    layout = np.minimum(band + ahead, len(of_band) - 1)
    takes = (sizes > 0) & (layout == band + ahead) & (100 * sizes >= percent * bounds[layout])
    segments = np.where(takes, of_band[layout], 0)
    partner = np.maximum(sizes, np.minimum(bounds[layout + 1] - 1, 100 * sizes // percent))
    return layout, segments, np.where(segments > 0, _most_apart(sizes + partner, percent) + 1, 0)


@dataclass
class Sketches:
    """Segments of sketches. Sketch 2i is that of text i in its own band, 2i + 1 that in the next one, where it has one."""

    numbers: np.ndarray
    sketch: np.ndarray
    filled: np.ndarray
    needed: np.ndarray  # for each sketch, how many of its segments must be looked at


def _sketches(grams: np.ndarray, first: np.ndarray, percent: int) -> Sketches:
    """The sketches of texts ``i`` with the shingles ``grams[first[i]:first[i + 1]]``."""
    sizes = np.diff(first)
    needed = np.zeros(2 * len(sizes), np.int64)
    found = []
    placed = texts.mix(grams ^ np.uint64(0x5851F42D4C957F2D))
    bits = texts.mix(grams >> np.uint64(16))  # a random number for each bit of the sketch
    for ahead in (0, 1):
        layout, segments, needed[ahead::2] = _layout(sizes, ahead, percent)
        base = np.cumsum(segments) - segments
        per_gram = np.repeat(segments, sizes)
        used = per_gram > 0
        slot = np.repeat(base, sizes)[used] + (placed[used] % per_gram[used].astype(np.uint64)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot = slot[order]
        heads = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else slot
        total = int(segments.sum())
        words, filled = np.zeros(total, np.uint64), np.zeros(total, bool)
        if len(heads):
            words[slot[heads]] = np.bitwise_xor.reduceat(bits[used][order], heads)
            filled[slot[heads]] = True
        owner = np.repeat(np.arange(len(sizes)), segments)
        within = (np.arange(total) - base[owner]).astype(np.uint64)
        place = texts.mix(layout[owner].astype(np.uint64) << np.uint64(40) | within)
        found.append((texts.mix(words ^ place), 2 * owner + ahead, filled))
    return Sketches(*(np.concatenate(x) for x in zip(*found, strict=True)), needed)


def _chosen(sketches: Sketches, orders: np.ndarray, alone: np.ndarray | None = None) -> np.ndarray:
    """The places of the segments that must be looked at and that more than one text may have.

    ``orders`` is 0 for a segment that only one text has, and equal for equal segments; where such segments are left out, ``alone`` counts them by sketch.
    """
    if alone is None:
        alone = np.bincount(sketches.sketch[orders == 0], minlength=len(sketches.needed))
    left = sketches.needed - alone
    at = np.flatnonzero((orders > 0) & (left[sketches.sketch] > 0))
    at = at[np.lexsort((sketches.numbers[at], orders[at], sketches.sketch[at]))]
    ranked = sketches.sketch[at]
    rank = np.arange(len(at)) - np.searchsorted(ranked, ranked)
    return at[rank < left[ranked]]


def _short_sketches(grams: np.ndarray, first: np.ndarray, size: int = SKETCH_WORDS) -> np.ndarray:
    """The parity of each of ``64 * size`` bits, a row of so many numbers for each text."""
    bits = texts.mix(grams ^ np.uint64(0x9FB21C651E98DF25)) % np.uint64(64 * size)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    words = np.zeros((len(first) - 1) * size, np.uint64)
    np.bitwise_xor.at(words, owner * size + (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
    return words.reshape(-1, size)


def _orders(counts: np.ndarray) -> np.ndarray:
    """The place of a segment of so many classes in the order that all keep: 0 for one of a single class."""
    return np.minimum(np.ceil(4 * np.log2(counts)), EMPTY - 1).astype(np.uint64)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _home(classes: np.ndarray, parts: int) -> np.ndarray:
    """The range of each class, for what is gathered by class."""
    return _part_of(texts.mix(classes.view(np.uint64)), parts).astype(np.int64)


def _by_part(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of the entries of each part, in their order."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    return ((p, order[a:b]) for p, (a, b) in enumerate(pairwise(cuts)) if b > a)


def _sent_classes(classes: np.ndarray, flags: np.ndarray) -> tuple[bytes, bytes]:
    """The different classes, and for each entry the place of its class there, above two bits of flags."""
    known, place = np.unique(classes, return_inverse=True)
    return known.tobytes(), texts.pack(place.astype(np.uint64) << np.uint64(2) | flags.astype(np.uint64))


def _got_classes(classes: bytes, members: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = texts.unpack(members)
    return np.frombuffer(classes, np.int64)[(found >> np.uint64(2)).astype(np.int64)], (found & np.uint64(3)).astype(np.int64)


@dataclass
class _Held:
    """Classes and segments that a task has found and not sent yet."""

    classes: np.ndarray  # of each class: number, size, how many segments each of its two sketches has, short sketch
    sizes: np.ndarray
    totals: np.ndarray
    sketches: np.ndarray
    numbers: np.ndarray  # of each segment: number, its class, flags (next band, without a bit)
    of_class: np.ndarray
    flags: np.ndarray


def _held(block: texts.Block, size: int, percent: int) -> _Held:
    """What a block holds, each class once."""
    grams, first = shingle_sets(block, size)
    classes, sizes = _classes(grams, first), np.diff(first)
    new = np.zeros(len(classes), bool)
    new[np.unique(classes, return_index=True)[1]] = True
    new &= sizes > 0
    grams, classes, sizes = grams[np.repeat(new, sizes)], classes[new], sizes[new]
    first = np.concatenate([[0], np.cumsum(sizes)])
    found = _sketches(grams, first, percent)
    # Segments without a bit are needed only where those with one do not suffice.
    with_bit = np.bincount(found.sketch[found.filled], minlength=len(found.needed))
    wanted = found.filled | (with_bit < found.needed)[found.sketch]
    sketch = found.sketch[wanted]
    totals = np.bincount(sketch, minlength=len(found.needed)).reshape(-1, 2)
    flags = 2 * (sketch % 2) + ~found.filled[wanted]
    return _Held(classes, sizes, totals, _short_sketches(grams, first), found.numbers[wanted], classes[sketch // 2], flags)


def _signer(size: int, percent: int, share: int):
    """Size and class of each text; of one class in ``share`` the segments as well, once a block."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in texts.blocks(batches, size=BLOCK_BYTES):
            grams, first = shingle_sets(block, size)
            classes, sizes = _classes(grams, first), np.diff(first)
            sampled: list[bytes | None] = [None] * len(classes)
            known, once = np.unique(classes, return_index=True)
            for at in once[(known % share == 0) & (sizes[once] > 0)]:
                found = _sketches(grams[first[at] : first[at + 1]], np.array([0, sizes[at]]), percent)
                sampled[at] = texts.pack(found.numbers[found.filled])
            columns = [rows["doc_id"], pa.array(sizes), pa.array(classes), pa.array(sampled, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "class", "sampled"])

    return sign


def _sender(size: int, percent: int, parts: int, hot: np.ndarray, hot_orders: np.ndarray):
    """Step 1. ``hot`` are the segments whose order is known already, ascending."""

    def flush(held: list[_Held]) -> pa.RecordBatch:
        one = _Held(*(np.concatenate([getattr(x, f) for x in held]) for f in _Held.__dataclass_fields__))
        rows = []
        kept = np.unique(one.classes, return_index=True)[1]
        for p, at in _by_part(_home(one.classes[kept], parts), parts):
            at = kept[at]
            facts = np.concatenate([one.sizes[at], one.totals[at, 0], one.totals[at, 1]])
            rows.append((parts + p, FACTS, one.classes[at].tobytes(), None, None, texts.pack(facts), one.sketches[at].tobytes()))
        is_hot = np.zeros(len(one.numbers), bool)
        if len(hot):
            place = np.minimum(np.searchsorted(hot, one.numbers), len(hot) - 1)
            is_hot = hot[place] == one.numbers
            entries = np.flatnonzero(is_hot)
            for p, at in _by_part(_home(one.of_class[entries], parts), parts):
                at = entries[at]
                orders = np.where(one.flags[at] & 1, EMPTY, hot_orders[place[at]])
                rows.append((parts + p, COUNTED, *_segment_rows(one.of_class[at], one.numbers[at], one.flags[at], orders), None))
        entries = np.flatnonzero(~is_hot)
        entries = entries[np.argsort(one.numbers[entries])]
        for p, at in _by_part(_part_of(one.numbers[entries], parts).astype(np.int64), parts):
            at = entries[at]
            classes, members = _sent_classes(one.of_class[at], one.flags[at])
            rows.append((p, TO_RANGE, classes, texts.pack_sorted(one.numbers[at]), members, None, None))
        return _table(rows, SENT).combine_chunks()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Held] = []
        for _, block in texts.blocks(batches, size=BLOCK_BYTES):
            held.append(_held(block, size, percent))
            if sum(len(x.numbers) for x in held) >= SEGMENTS_HELD:
                yield from flush(held).to_batches()
                held = []
        if held:
            yield from flush(held).to_batches()

    return send


def _segment_rows(classes: np.ndarray, numbers: np.ndarray, flags: np.ndarray, orders: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    known, members = _sent_classes(classes, flags)
    return known, texts.pack(numbers), members, texts.pack(orders)


def _counter(parts: int):
    """Step 2, for one range of segments. Rows for homes are handed on as they are."""

    def count(table: pa.Table) -> pa.Table:
        if table["part"][0].as_py() >= parts:
            return table
        numbers, classes, flags = [], [], []
        for row in table.select(["classes", "segments", "members"]).to_pylist():
            numbers.append(texts.unpack_sorted(row["segments"]))
            of_class, flag = _got_classes(row["classes"], row["members"])
            classes.append(of_class)
            flags.append(flag)
        numbers, classes, flags = np.concatenate(numbers), np.concatenate(classes), np.concatenate(flags)
        several, _ = texts.repeated(numbers)
        numbers, classes, flags = numbers[several], classes[several], flags[several]
        order = np.lexsort((flags, classes, numbers))
        numbers, classes, flags = numbers[order], classes[order], flags[order]
        new = np.ones(len(numbers), bool)
        new[1:] = (numbers[1:] != numbers[:-1]) | (classes[1:] != classes[:-1])
        numbers, classes, flags = numbers[new], classes[new], flags[new]
        heads = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]])) if len(numbers) else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, len(numbers)))
        orders = np.where(flags & 1, EMPTY, np.repeat(_orders(np.maximum(counts, 1)), counts)).astype(np.uint64)
        told = np.flatnonzero(np.repeat(counts > 1, counts))
        rows = []
        for p, at in _by_part(_home(classes[told], parts), parts):
            at = told[at]
            rows.append((parts + p, COUNTED, *_segment_rows(classes[at], numbers[at], flags[at], orders[at]), None))
        return _table(rows, SENT)

    return count


def _chooser(percent: int, parts: int, cell: int):
    """Step 3, for the classes of one home."""

    def choose(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        facts, told = ([r for r in rows if r["kind"] == kind] for kind in (FACTS, COUNTED))
        if not facts or not told:
            return _table([], SENT)
        classes = np.concatenate([np.frombuffer(r["classes"], np.int64) for r in facts])
        numbers_of = np.concatenate([texts.unpack(r["extra"]).astype(np.int64).reshape(3, -1) for r in facts], axis=1)
        sketches = np.concatenate([np.frombuffer(r["sketches"], np.uint64).reshape(-1, SKETCH_WORDS) for r in facts])
        classes, once = np.unique(classes, return_index=True)
        (sizes, *totals), sketches = numbers_of[:, once], sketches[once]
        needed = np.stack([_layout(sizes, ahead, percent)[2] for ahead in (0, 1)], 1).ravel()

        found = [(texts.unpack(r["segments"]), texts.unpack(r["extra"]), *_got_classes(r["classes"], r["members"])) for r in told]
        numbers, orders, of_class, flags = (np.concatenate(x) for x in zip(*found, strict=True))
        sketch = 2 * np.searchsorted(classes, of_class) + flags // 2
        by = np.lexsort((numbers, sketch))
        new = np.ones(len(by), bool)  # a segment whose order is known is told by every task that has the class
        new[1:] = (numbers[by][1:] != numbers[by][:-1]) | (sketch[by][1:] != sketch[by][:-1])
        numbers, orders, sketch = (x[by[new]] for x in (numbers, orders, sketch))
        alone = np.stack(totals, 1).ravel() - np.bincount(sketch, minlength=len(needed))
        look = _chosen(Sketches(numbers, sketch, orders < EMPTY, needed), orders, alone)
        numbers, orders, place = numbers[look], orders[look], sketch[look] // 2

        rows = []
        cells = np.where(orders < EMPTY, np.exp2(np.maximum(0, np.ceil(orders / 4 - np.log2(cell)))), 1).astype(np.uint64)
        dealt = np.flatnonzero(cells > 1)
        for p, at in _by_part(_home(classes[place[dealt]], parts), parts):
            at = dealt[at]
            rows.append((p, HOT, *_sized(classes, sizes, sketches, place[at], numbers[at])))
        in_cell = texts.mix(classes[place[dealt]].view(np.uint64) ^ numbers[dealt]) % cells[dealt]
        numbers[dealt] = texts.mix(numbers[dealt] + texts.mix(in_cell + np.uint64(1)))
        by = np.argsort(numbers)
        for p, at in _by_part(_part_of(numbers[by], parts).astype(np.int64), parts):
            at = by[at]
            rows.append((p, CHOSEN, *_sized(classes, sizes, sketches, place[at], numbers[at])))
        return _table(rows, SENT)

    return choose


def _sized(classes: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, place: np.ndarray, numbers: np.ndarray) -> tuple:
    """Segments and, once each, the classes that look at them, with size and short sketch."""
    used, member = np.unique(place, return_inverse=True)
    return classes[used].tobytes(), texts.pack(numbers), texts.pack(member.astype(np.uint64)), texts.pack(sizes[used]), sketches[used].tobytes()


def _similar(size: np.ndarray, sketch: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """In how many bits the short sketches differ, and whether the sets may be similar."""
    bits = np.bitwise_count(sketch ^ sketches).sum(-1, dtype=np.int64)
    near = (100 * np.minimum(size, sizes) >= percent * np.maximum(size, sizes)) & (bits <= _most_apart(size + sizes, percent))
    return bits, near


class _Forest:
    """Classes that pairs connect, by the smallest of them."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        root = self.up[at]
        while np.any((next_up := self.up[root]) != root):
            root = next_up
        self.up[at] = root
        return root

    def connect(self, one: int, other: int) -> bool:
        """Whether the two were apart."""
        up = self.up
        while up[one] != one:
            one = up[one] = up[up[one]]
        while up[other] != other:
            other = up[other] = up[up[other]]
        up[max(one, other)] = min(one, other)
        return one != other


def _near_in_small_groups(begins: np.ndarray, lengths: np.ndarray, member: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, percent: int) -> np.ndarray:
    """The different pairs of classes of groups ``member[begin:begin + length]`` that may be similar, the nearer ones of a class first."""
    found = [np.zeros((0, 3), np.int64)]
    for n in range(2, SMALL_GROUP + 1):
        low, high = np.triu_indices(n, 1)
        of_size = begins[lengths == n]
        for some in np.array_split(of_size, -(-len(of_size) * len(low) // (1 << 18)) or 1):
            i, j = member[(some[:, None] + low).ravel()], member[(some[:, None] + high).ravel()]
            pairs = np.unique(i * len(sizes) + j)
            i, j = pairs // len(sizes), pairs % len(sizes)
            bits, near = _similar(sizes[i], sketches[i], sizes[j], sketches[j], percent)
            found.append(np.column_stack([i, bits, j])[near])
    return np.unique(np.concatenate(found), axis=0)


def _forest_pairs(segments: np.ndarray, member: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a spanning forest over all classes that share a segment and may be similar, and each class's root.

    Entries are sorted by segment and class; classes are numbered in ascending order. In the end any two classes of a
    segment are connected or cannot be similar: of small groups all pairs are judged, in others each class is held against the later ones
    that it is not connected with yet.
    """
    forest, pairs = _Forest(len(sizes)), []
    bounds = np.flatnonzero(np.concatenate([[True], segments[1:] != segments[:-1], [True]])) if len(segments) else np.zeros(1, np.int64)
    lengths = np.diff(bounds)
    for i, _, j in _near_in_small_groups(bounds[:-1], lengths, member, sizes, sketches, percent).tolist():
        if forest.connect(i, j):
            pairs.append((i, j))
    for begin, length in zip(bounds[:-1][lengths > SMALL_GROUP], lengths[lengths > SMALL_GROUP], strict=True):
        group = member[begin : begin + length]
        size, sketch = sizes[group], sketches[group]
        for k in range(length - 1):
            roots = forest.roots(group[k:])
            apart = np.flatnonzero(roots[1:] != roots[0]) + 1 + k
            if not len(apart):
                break
            bits, near = _similar(size[k], sketch[k], size[apart], sketch[apart], percent)
            if near.any():
                at = apart[near]
                at = at[np.argsort(bits[near], kind="stable")]
                for x in group[at[np.unique(forest.roots(group[at]), return_index=True)[1]]]:  # the nearest class of each tree
                    forest.connect(int(group[k]), int(x))
                    pairs.append((group[k], x))
    return np.array(pairs, np.int64).reshape(-1, 2), forest.roots(np.arange(len(sizes)))


def _paired_rows(segments: np.ndarray, classes: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, percent: int) -> pa.Table:
    """Pairs to verify among the entries ``(segment, class)``, which may be repeated."""
    known, once, member = np.unique(classes, return_index=True, return_inverse=True)
    order = np.lexsort((member, segments))
    segments, member = segments[order], member[order]
    new = np.ones(len(segments), bool)
    new[1:] = (segments[1:] != segments[:-1]) | (member[1:] != member[:-1])
    segments, member = segments[new], member[new]
    several, _ = texts.repeated(segments)
    pairs, _ = _forest_pairs(segments[several], member[several], sizes[once], sketches[once], percent)
    ends = known[pairs]
    n, ints = len(pairs), pa.int64()
    columns = [pa.array(np.full(n, EDGE), pa.int32()), pa.nulls(n, ints), pa.array(ends[:, 0], ints), pa.array(ends[:, 1], ints), pa.nulls(n, ints), pa.nulls(n, pa.binary())]
    return pa.table(columns, names=[x.split()[0] for x in PAIRED.split(", ")])


def _pairer(percent: int):
    """Step 4, for one range of chosen segments."""

    def pair(table: pa.Table) -> pa.Table:
        found, dealt = [], []
        for r in table.to_pylist():
            member = texts.unpack(r["members"]).astype(np.int64)
            sketches = np.frombuffer(r["sketches"], np.uint64).reshape(-1, SKETCH_WORDS)[member]
            classes, sizes = np.frombuffer(r["classes"], np.int64)[member], texts.unpack(r["extra"]).astype(np.int64)[member]
            (found if r["kind"] == CHOSEN else dealt).append((texts.unpack(r["segments"]), classes, sizes, sketches))
        parts = []
        if found:
            parts.append(_paired_rows(*(np.concatenate(x) for x in zip(*found, strict=True)), percent))
        if dealt:
            segments, classes, sizes, sketches = (np.concatenate(x) for x in zip(*dealt, strict=True))
            n, ints = len(segments), pa.int64()
            columns = [pa.array(np.full(n, DEALT), pa.int32()), pa.array(segments.view(np.int64)), pa.array(classes), pa.nulls(n, ints)]
            columns += [pa.array(sizes), pa.array([x.tobytes() for x in sketches], pa.binary())]
            parts.append(pa.table(columns, names=[x.split()[0] for x in PAIRED.split(", ")]))
        return pa.concat_tables(parts)

    return pair


def _cell_pairer(percent: int):
    """Step 4 again, for two cells of a segment that was dealt out."""

    def pair(table: pa.Table) -> pa.Table:
        sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(-1, SKETCH_WORDS)
        segments = texts.mix(sum((texts.mix(table[c].to_numpy().astype(np.int64).view(np.uint64) + np.uint64(k)) for k, c in enumerate(("segment", "i", "j"))), np.zeros(len(table), np.uint64)))
        return _paired_rows(segments, table["a"].to_numpy().astype(np.int64), table["size"].to_numpy().astype(np.int64), sketches, percent)

    return pair


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets of ascending shingles are similar."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _crosser(percent: int):
    """Step 5, for classes of a tree whose pairs did not all hold: pairs of similar sets that join its parts, until what is here is joined or proven apart."""

    def cross(table: pa.Table) -> pa.Table:
        classes, component, sizes = (table[c].to_numpy().astype(np.int64) for c in ("class", "component", "n"))
        sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(classes), -1)
        grams = [texts.unpack_sorted(x) for x in table["grams"].to_pylist()]
        all_of = table["against"].to_numpy(zero_copy_only=False).astype(bool)
        parts, part = np.unique(component, return_inverse=True)
        forest, pairs = _Forest(len(parts)), []
        others = np.flatnonzero(~all_of)
        for k in np.flatnonzero(all_of):
            at = others[forest.roots(part[others]) != forest.roots(part[k : k + 1])]
            bits, near = _similar(sizes[k], sketches[k], sizes[at], sketches[at], percent)
            for x in at[near][np.argsort(bits[near], kind="stable")]:
                if forest.roots(part[[x]])[0] != forest.roots(part[[k]])[0] and _alike(grams[k], grams[x], percent):
                    forest.connect(int(part[k]), int(part[x]))
                    pairs.append((int(classes[k]), int(classes[x])))
        return _table(pairs, "a bigint, b bigint")

    return cross


def _set_maker(size: int, wanted: np.ndarray):
    """Sets of the texts whose ``spot`` is a bit of ``wanted`` or null."""

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = batch["spot"].fill_null(-1).to_numpy()
            keep = (spot < 0) | (wanted[np.maximum(spot, 0) >> 3] >> (spot & 7) & 1).astype(bool)
            yield batch.filter(pa.array(keep))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in texts.blocks(picked(batches), size=BLOCK_BYTES):
            grams, first = shingle_sets(block, size)
            sets = [texts.pack_sorted(grams[a:b]) for a, b in pairwise(first)]
            sketches = [x.tobytes() for x in _short_sketches(grams, first, LONG_SKETCH_WORDS)]
            columns = [pa.array(_classes(grams, first)), pa.array(np.diff(first)), pa.array(sketches, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["class", "n", "sketch", "grams"])

    return make


def _verifier(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_alike(texts.unpack_sorted(x.as_py()), texts.unpack_sorted(y.as_py()), percent) for x, y in zip(batch["grams_a"], batch["grams_b"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for all ends of ``links (a, b)``: the smallest id that can be reached.

    Every id takes the smallest component of its neighbours, then that one's own, until
    none changes; each step is written, and only counts come to the driver.
    """
    both = links.select("a", "b").unionByName(links.selectExpr("b as a", "a as b")).distinct()
    both = written(both, "links")
    found = both.selectExpr("a as id").distinct().withColumn("component", F.col("id"))
    while True:
        near = both.join(found.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        hooked = found.join(near.withColumnRenamed("a", "id"), "id").select("id", "component", F.least("component", "near").alias("next"))
        hooked = written(hooked, "hooked")
        up = hooked.selectExpr("id as next", "next as above")
        jumped = written(hooked.join(up, "next").selectExpr("id", "component as before", "above as component"), "components")
        found = jumped.select("id", "component")
        if jumped.where("before != component").isEmpty():
            return found


def _merged(known: DataFrame, similar: DataFrame) -> DataFrame:
    """``known (class, component)`` after the links ``similar (a, b)``: only components are linked anew, not all their classes."""
    ends = similar.selectExpr("explode(array(a, b)) as class").distinct()
    known = known.join(ends, "class", "full_outer").select("class", F.coalesce("component", "class").alias("component"))
    for end in ("a", "b"):
        similar = similar.join(known.withColumnsRenamed({"class": end, "component": f"of_{end}"}), end)
    joined = components(similar.selectExpr("of_a as a", "of_b as b").where("a != b").distinct())
    above = joined.selectExpr("id as component", "component as above")
    return known.join(above, "component", "left").select("class", F.coalesce("above", "component").alias("component"))


def _id_filter(ids: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """A bitmap with a bit for each of about ``count`` ids ``(first_id)``, and how many bits it has: a power of 2, ``FILTER_BITS`` at most."""
    bits = min(FILTER_BITS, max(BITMAP_BITS, 1 << (FILTER_BITS_PER_ID * count).bit_length()))
    spots = ids.select(_spot("first_id", bits).alias("spot"))
    maps = spots.groupBy(F.expr(f"spot div {BITMAP_BITS}").alias("at")).agg(F.bitmap_construct_agg(F.col("spot") % BITMAP_BITS).alias("bitmap"))
    wanted = np.zeros((bits // BITMAP_BITS, BITMAP_BITS // 8), np.uint8)
    for r in maps.collect():
        wanted[r["at"]] = np.frombuffer(r["bitmap"], np.uint8)
    return wanted.ravel(), bits


def _spot(column: str, bits: int) -> Column:
    """The bit of an id; null for none."""
    return F.when(F.col(column).isNotNull(), F.pmod(F.xxhash64(column), F.lit(bits)))


def _text_sets(rows: DataFrame, classes: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """``SETS`` of the classes ``needed (class)``, from one text of each: that of its smallest id in ``classes (class, first_id)``.

    Texts are picked where they are read, by a filter of their ids, and none moves. A text that passes by chance, or has no id, makes a set
    that is dropped by its class if that is not needed.
    """
    ids = classes.join(needed, "class").select("first_id").where("first_id is not null")
    wanted, bits = _id_filter(ids, needed.count())
    made = rows.select(_spot("doc_id", bits).alias("spot"), "text").mapInArrow(_set_maker(size, wanted), SETS)
    firsts = [F.first(c).alias(c) for c in ("n", "sketch", "grams")]
    return made.join(needed, "class", "left_semi").groupBy("class").agg(*firsts)


def _edges(paired: DataFrame) -> DataFrame:
    return written(paired.where(F.col("kind") == EDGE).select("a", "b").distinct(), "pairs")


def _across_cells(paired: DataFrame, trees: DataFrame, percent: int, cell: int) -> DataFrame:
    """Pairs ``(a, b)`` that may be similar between the cells of the segments that were dealt out and whose classes are in several trees."""
    dealt = paired.where(F.col("kind") == DEALT).selectExpr("segment", "a as class", "size", "sketch")
    placed = dealt.join(trees, "class", "left").withColumn("component", F.coalesce("component", "class"))
    spread = placed.groupBy("segment").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
    mixed = placed.join(spread.where("low < high").select("segment", "members"), "segment")
    cells = F.ceil(F.col("members") / cell).cast("int")
    own, other = F.pmod(F.xxhash64("class"), cells).cast("int"), F.explode(F.sequence(F.lit(0), cells - 1))
    grid = mixed.select("segment", F.col("class").alias("a"), "size", "sketch", own.alias("own"), other.alias("other"))
    grid = grid.select("segment", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "a", "size", "sketch")
    return _edges(grid.groupBy("segment", "i", "j").applyInArrow(_cell_pairer(percent), PAIRED))


def _verified(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose sets are similar."""
    one = edges.join(sets.selectExpr("class as a", "grams as grams_a"), "a")
    both = one.join(sets.selectExpr("class as b", "grams as grams_b"), "b")
    return written(both.mapInArrow(_verifier(percent), "a bigint, b bigint"), "similar")


def _joined_parts(parts: DataFrame, sets: DataFrame, percent: int, cell_shingles: int) -> DataFrame:
    """Pairs of similar classes that join the parts of trees; ``parts (class, tree, component)``.

    Every class outside a tree's largest part is held against all others. Both are cut into cells by their shingles, and a task gets one of each.
    """
    spark = parts.sparkSession
    members = parts.join(sets, "class")
    sizes = parts.join(sets.select("class", "n"), "class").groupBy("tree", "component").agg(F.sum("n").alias("shingles"))
    of_tree = sizes.groupBy("tree").agg(F.sum("shingles").alias("shingles"), F.max(F.struct("shingles", "component")).alias("largest"))
    cells = lambda shingles: F.ceil(shingles / cell_shingles).cast("int")
    of_tree = of_tree.select("tree", F.col("largest.component").alias("largest"), cells(F.col("shingles")).alias("cells"), cells(F.greatest(F.col("shingles") - F.col("largest.shingles"), F.lit(1))).alias("few"))
    placed = members.join(of_tree, "tree")
    dealt = lambda count: F.pmod(F.xxhash64("class"), count).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    columns = ["tree", "class", "component", "n", "sketch", "grams"]
    others = placed.select(*columns, F.lit(False).alias("against"), dealt(F.col("cells")).alias("i"), every(F.col("few")).alias("j"))
    outside = placed.where("component != largest").select(*columns, F.lit(True).alias("against"), every(F.col("cells")).alias("i"), dealt(F.col("few")).alias("j"))
    tasks = outside.unionByName(others).repartition(4 * shuffle_partitions(spark), "tree", "i", "j")
    return written(tasks.groupBy("tree", "i", "j").applyInArrow(_crosser(percent), "a bigint, b bigint"), "joining")


def _linked(rows: DataFrame, classes: DataFrame, paired: DataFrame, size: int, percent: int, cell: int, cell_shingles: int) -> DataFrame:
    """Step 5: ``(class, component)`` of the classes that are similar to another one."""
    edges = _edges(paired)
    trees = components(edges).withColumnsRenamed({"id": "class"})
    if not paired.where(F.col("kind") == DEALT).isEmpty():
        more = _across_cells(paired, trees, percent, cell)
        if not more.isEmpty():
            trees = written(_merged(trees, more), "trees")
            edges = edges.unionByName(more).distinct()
    if trees.isEmpty():
        return trees
    sets = written(_text_sets(rows, classes, trees.select("class"), size), "sets")
    similar = _verified(edges, sets, percent)
    failed = written(edges.join(similar, ["a", "b"], "left_anti").selectExpr("a as class").join(trees, "class").selectExpr("component as tree").distinct(), "failed")
    if failed.isEmpty():
        return trees
    # Trees with failed pairs: first the parts that the others prove, then what joins these.
    torn = written(trees.withColumnRenamed("component", "tree").join(failed, "tree", "left_semi"), "torn")
    proven = components(similar.join(torn.select(F.col("class").alias("a")), "a", "left_semi")).withColumnsRenamed({"id": "class"})
    parts = torn.join(proven, "class", "left").select("class", "tree", F.coalesce("component", "class").alias("component"))
    parts = written(parts, "parts")
    joining = _joined_parts(parts, sets, percent, cell_shingles)
    parts = parts.select("class", "component")
    if not joining.isEmpty():
        parts = _merged(parts, joining)
    return written(trees.join(torn, "class", "left_anti").unionByName(parts), "components")


def _hot_segments(signed: DataFrame, cell: int, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments that about ``cell`` classes or more have, and their orders, from the sampled classes: ``HOT_SEGMENTS`` at most."""

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [texts.unpack(x.as_py()) for x in batch["sampled"]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64))], ["segment"])

    once = signed.where("sampled is not null").groupBy("class").agg(F.first("sampled").alias("sampled"))
    counts = once.select("sampled").mapInArrow(numbers, "segment bigint").groupBy("segment").count()
    top = counts.where(F.col("count") * share >= cell).orderBy(F.desc("count"), "segment").limit(HOT_SEGMENTS).collect()
    found = np.array([(r["segment"], r["count"] * share) for r in top], np.int64).reshape(-1, 2)
    found = found[np.argsort(found[:, 0].view(np.uint64))]
    return np.ascontiguousarray(found[:, 0]).view(np.uint64), _orders(np.maximum(found[:, 1], 1))


def _by_parts(sent: DataFrame, count: int, task: Callable[[pa.Table], pa.Table], schema: str = SENT) -> DataFrame:
    """``task`` over the rows of each part, in as many partitions as there are parts."""
    return sent.repartition(count, "part").groupBy("part").applyInArrow(task, schema)


def similar_documents(
    documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT, cell: int = CELL, sample_share: int = SAMPLE_SHARE, cell_shingles: int = CELL_SHINGLES
) -> DataFrame:
    """``(doc_id, n_shingles, class, component_id)`` per row of ``documents (doc_id, text)``.

    ``component_id`` is the smallest id that links of at least ``percent`` similarity reach.
    """
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    signed = written(rows.mapInArrow(_signer(size, percent, sample_share), SIGNED), "signed")
    # Nearly as many segments as shingles, twice for the classes with sketches in two bands.
    total = signed.agg(F.sum("n_shingles")).first()[0] or 0
    parts = max(shuffle_partitions(documents.sparkSession), -(-total // SEGMENTS_PER_RANGE))
    hot, hot_orders = _hot_segments(signed, cell, sample_share)
    sent = rows.mapInArrow(_sender(size, percent, parts, hot, hot_orders), SENT)
    counted = _by_parts(sent, 2 * parts, _counter(parts))
    chosen = _by_parts(counted, parts, _chooser(percent, parts, cell))
    paired = written(_by_parts(chosen, parts, _pairer(percent), PAIRED), "paired")

    classes = signed.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"))
    found = _linked(rows, classes, paired, size, percent, cell, cell_shingles)
    named = classes.join(found, "class", "left").select("class", "first_id", F.coalesce("component", "class").alias("component"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(least, "component").select("class", "component_id")
    joined = signed.join(of_class, "class", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", "class", component_id.alias("component_id"))

