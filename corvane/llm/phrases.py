"""Benchmark decontamination by a positional inverted index of the training texts.

``build_index`` stores the index partitioned by documents, as search engines do: a
segment holds a block of whole documents, its terms in ascending order and for each
term the ascending places where it stands. Segments need no shuffle and are written to
the shared folder. ``search`` looks up every window of the benchmark in every segment:
starting from the window's rarest term there, it intersects the other terms' lists,
shifted by their offsets. A shift that fits within ``slop`` places gives a proximity
match, one that fits exactly for all terms a phrase match.

The benchmark is a stated query set: it is taken in blocks of bounded size, each sent
to the tasks and held against all segments. Terms are 64-bit hashes of words.

Nulls and edge cases: null texts have no word, of documents as of items. Items of equal
id count as one; an item without id has the id ''. Repeated documents give a row each. Empty
tables: no documents, no rows; no items, nothing is hit. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import texts
from corvane.llm.exchange import written

WINDOW = 13
SLOP = 2
# Contaminated: at least one word in this many is hit.
HIT_SHARE = 20
# Characters of the benchmark that are searched for in one pass.
QUERY_CHARS = 8 << 20

INDEX = "segment bigint, ids array<bigint>, n_words binary, terms binary, counts binary, places binary"
FOUND = "segment bigint, at int, doc_id bigint, n_words bigint, hits binary, items array<string>, near_items array<string>"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    for k, (rows, block) in enumerate(texts.blocks(batches)):
        words = texts.find_words(block, texts.ALNUM)
        hashes = texts.word_hashes(block, words, lower=True)
        places = np.argsort(hashes, kind="stable").astype(np.uint64)
        ranked = hashes[places.astype(np.int64)]
        heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 32) + k], pa.int64()),
                pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())),
                pa.array([texts.pack(words.counts())]),
                pa.array([texts.pack_sorted(ranked[heads])]),
                pa.array([texts.pack(np.diff(np.append(heads, len(ranked))))]),
                pa.array([texts.pack(places)]),
            ],
            ["segment", "ids", "n_words", "terms", "counts", "places"],
        )


def build_index(documents: DataFrame) -> DataFrame:
    """The index of ``documents (doc_id, text)``, one row per segment, as a written table."""
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return written(rows.mapInArrow(_index, INDEX), "phrase-index")


def _item_windows(items: list, n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By window length: the term hashes of each window, and each window's item in ``items``."""
    block = texts.text_block(pa.array([x.text for x in items], pa.string()))
    words = texts.find_words(block, texts.ALNUM)
    hashes = texts.word_hashes(block, words, lower=True)
    found: dict[int, list] = {}
    for i, count in enumerate(words.counts()):
        length = min(n, int(count))
        for start in range(words.first[i], words.first[i + 1] - length + 1 if length else 0):
            found.setdefault(length, []).append((start, i))
    return {
        length: (hashes[np.array([s for s, _ in x])[:, None] + np.arange(length)], np.array([i for _, i in x]))
        for length, x in found.items()
    }


class _Segment:
    """The postings of one segment as one ascending array of term rank and place."""

    def __init__(self, row: dict):
        self.n_words = texts.unpack(row["n_words"]).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n_words)])
        self.terms = texts.unpack_sorted(row["terms"])
        self.counts = texts.unpack(row["counts"]).astype(np.int64)
        self.begins = np.cumsum(self.counts) - self.counts
        self.places = texts.unpack(row["places"]).astype(np.int64)
        self.width = int(self.first[-1]) + 1
        self.postings = np.repeat(np.arange(len(self.terms)), self.counts) * self.width + self.places

    def holds(self, term: np.ndarray, place: np.ndarray, slop: int) -> np.ndarray:
        """Whether the term stands within ``slop`` of the place."""
        low, high = (np.clip(place + d, 0, self.width - 1) + term * self.width for d in (-slop, slop))
        at = np.minimum(np.searchsorted(self.postings, low), len(self.postings) - 1)
        return (self.postings[at] >= low) & (self.postings[at] <= high)

    def find(self, windows: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matches within ``slop``: window, place of its first word, and whether exact."""
        none = np.zeros(0, np.int64)
        if not len(self.terms):
            return none, none, none.astype(bool)
        rank = np.minimum(np.searchsorted(self.terms, windows), len(self.terms) - 1)
        known = np.flatnonzero((self.terms[rank] == windows).all(axis=1))
        rank = rank[known]
        if not len(known):
            return none, none, none.astype(bool)
        by_rarity = np.argsort(self.counts[rank], axis=1, kind="stable")
        lead = np.take_along_axis(rank, by_rarity[:, :1], 1)[:, 0]
        n = self.counts[lead]
        which = np.repeat(np.arange(len(known)), n)
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        start = self.places[self.begins[lead][which] + within] - by_rarity[which, 0]
        length = windows.shape[1]
        # A phrase lies in one document; its lead word is in it, so both ends must be.
        owner = np.searchsorted(self.first, start + by_rarity[which, 0], "right") - 1
        whole = (start >= self.first[owner]) & (start + length <= self.first[owner + 1])
        which, start = which[whole], start[whole]
        exact = np.ones(len(which), bool)
        for k in range(1, length):
            offset = by_rarity[which, k]
            near = self.holds(rank[which, offset], start + offset, slop)
            which, start, exact, offset = which[near], start[near], exact[near], offset[near]
            exact &= self.holds(rank[which, offset], start + offset, 0)
        return known[which], start, exact


def _searcher(items: list, n: int, slop: int):
    ids = np.array(["" if x.item_id is None else str(x.item_id) for x in items], object)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _item_windows(items, n)
        for batch in batches:
            for row in batch.to_pylist():
                segment = _Segment(row)
                hit = np.zeros(segment.width - 1, bool)
                pairs: list[set] = [set(), set()]  # (document, item): exact ones, near ones
                for length, (terms, owner) in windows.items():
                    which, start, exact = segment.find(terms, slop)
                    hit |= texts.covered(start[exact], length, len(hit))
                    document = np.searchsorted(segment.first, start, "right") - 1
                    for to, keep in zip(pairs, (exact, slice(None)), strict=True):
                        to.update(zip(document[keep].tolist(), owner[which][keep].tolist(), strict=True))
                by_document: list[dict] = [{}, {}]
                for to, found in zip(by_document, pairs, strict=True):
                    for document, item in found:
                        to.setdefault(document, set()).add(ids[item])
                count = len(segment.n_words)
                hits = [hit[a:b] for a, b in zip(segment.first[:-1], segment.first[1:], strict=True)]
                columns = [
                    pa.array([row["segment"]] * count, pa.int64()),
                    pa.array(range(count), pa.int32()),
                    pa.array(row["ids"], pa.int64()),
                    pa.array(segment.n_words),
                    pa.array([np.packbits(x).tobytes() if x.any() else b"" for x in hits], pa.binary()),
                    *(pa.array([sorted(x.get(i, ())) for i in range(count)], pa.list_(pa.string())) for x in by_document),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["segment", "at", "doc_id", "n_words", "hits", "items", "near_items"])

    return search


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the passes' rows of a document, gathered in lists, to its verdict."""
    for batch in batches:
        n_words = batch["n_words"].to_numpy(zero_copy_only=False).astype(np.int64)
        n_hit, items, near = [], [], []
        for hits, found, close in zip(batch["hits"].to_pylist(), batch["items"].to_pylist(), batch["near_items"].to_pylist(), strict=True):
            marked = [np.frombuffer(x, np.uint8) for x in hits if x]
            n_hit.append(int(np.unpackbits(reduce(np.bitwise_or, marked)).sum()) if marked else 0)
            items.append(sorted({i for x in found for i in x}))
            near.append(sorted({i for x in close for i in x}))
        hit = np.array(n_hit, np.int64)
        columns = {
            "doc_id": batch["doc_id"],
            "n_words": pa.array(n_words),
            "n_hit": pa.array(hit),
            "n_items": pa.array([len(x) for x in items], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
            "contaminated": pa.array((hit > 0) & (HIT_SHARE * hit >= n_words)),
            "items": pa.array(items, pa.list_(pa.string())),
            "near_items": pa.array(near, pa.list_(pa.string())),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


VERDICTS = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "items array<string>, near_items array<string>"
)


def search(index: DataFrame, benchmark: DataFrame, n: int = WINDOW, slop: int = SLOP, query_chars: int = QUERY_CHARS) -> DataFrame:
    """One row per indexed document: words hit by phrases of ``benchmark (item_id, text)``, and the items.

    ``near_items`` also holds items of which a window occurs with words moved by up to ``slop`` places.
    """
    items = benchmark.selectExpr("item_id", "cast(text as string) as text")
    passes = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // query_chars))
    found = []
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        found.append(index.mapInArrow(_searcher(part.collect(), n, slop), FOUND))
    rows = reduce(DataFrame.unionByName, found)
    lists = ("hits", "items", "near_items")
    if passes == 1:
        gathered = rows.select("doc_id", "n_words", *(F.array(c).alias(c) for c in lists))
    else:
        # One row per pass, and their number is that of the query set's blocks.
        gathered = rows.groupBy("segment", "at").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *(F.collect_list(c).alias(c) for c in lists)
        )
        gathered = gathered.drop("segment", "at")
    return gathered.mapInArrow(_verdicts, VERDICTS)


def decontaminate(documents: DataFrame, benchmark: DataFrame, n: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """``search`` over a new index of ``documents``."""
    return search(build_index(documents), benchmark, n, slop)
