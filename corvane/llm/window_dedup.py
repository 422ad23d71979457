"""Substring deduplication: removal of passages that an earlier document holds as well.

Rabin-Karp hashes of every window of ``n`` words are counted in Spark: documents are
dealt into buckets of bounded text; a bucket sends each different window hash once,
with its smallest document, packed by hash range; a range's task finds the hashes whose
smallest document lies in another bucket and answers each bucket with these. A bucket
then knows for every window whether a smaller document has it, and merges the repeated
windows to maximal removal intervals. A passage that a third of all documents share
is one entry per bucket, wherever it occurs.

Windows are equal when their 64-bit hashes are. Among 10 billion different windows about three
pairs are expected to share a hash by chance, each of which can cost 13 words.

Nulls and edge cases: a null text has no word. Of equal ids neither row is the smaller, so
repeated rows keep what they share only with each other. A null ``doc_id`` comes after all
others. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from corvane.llm import texts
from corvane.llm.exchange import bucketed, ranges_for, text_bytes

WINDOW = 13
LAST = np.iinfo(np.int64).max

SENT = "part int, bucket int, hashes binary, docs binary"
ANSWER = "bucket int, earlier binary"


def _ids(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(table["doc_id"], LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(table: pa.Table) -> Iterator[tuple[pa.RecordBatch, texts.Block]]:
    return texts.blocks(iter(table.to_batches()))


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of each hash; ranges are of equal width."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _smallest(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each different hash in ascending order, with the smallest of its documents."""
    order = np.argsort(hashes)
    hashes, docs = hashes[order], docs[order]
    heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[heads], np.minimum.reduceat(docs, heads) if len(heads) else docs


def _bucket_windows(table: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_smallest`` over the windows of a whole bucket."""
    found = []
    for rows, block in _blocks(table):
        words = texts.find_words(block)
        hashes, at = texts.windows(texts.word_hashes(block, words), words, n)
        found.append(_smallest(hashes, _ids(rows)[words.owners()[at]]))
    return _smallest(np.concatenate([h for h, _ in found]), np.concatenate([d for _, d in found]))


def _sender(n: int, parts: int):
    def send(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        hashes, docs = _bucket_windows(table, n)
        cuts = np.searchsorted(_part_of(hashes, parts), np.arange(parts + 1, dtype=np.uint64))
        rows = [
            (part, bucket, texts.pack_sorted(hashes[a:b]), texts.pack(docs[a:b]))
            for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
            if b > a
        ]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "bucket", "hashes", "docs"])

    return send


def _answer(table: pa.Table) -> pa.Table:
    """For one hash range: to each bucket the hashes that a smaller document of another bucket has."""
    buckets = table["bucket"].to_numpy()
    hashes = [texts.unpack_sorted(x.as_py()) for x in table["hashes"]]
    docs = np.concatenate([texts.unpack(x.as_py()) for x in table["docs"]]).view(np.int64)
    senders = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes)
    ranked, docs = hashes[order], docs[order]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    least = np.repeat(np.minimum.reduceat(docs, heads), np.diff(np.append(heads, len(ranked))))
    behind = docs > least
    to, told = senders[order][behind], ranked[behind]
    by = np.argsort(to, kind="stable")  # stays ascending within a bucket
    to, told = to[by], told[by]
    cuts = np.searchsorted(to, np.arange(len(buckets) + 1))
    rows = [(int(buckets[i]), texts.pack_sorted(told[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "earlier"])


def _remover(n: int, give_text: bool):
    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        own, least = _bucket_windows(table, n)
        earlier = [texts.unpack_sorted(x.as_py()) for x in answers["earlier"]]
        if earlier:
            told = np.concatenate(earlier)
            least[np.searchsorted(own, told)] = -LAST  # smaller than any document here
        out = []
        for rows, block in _blocks(table):
            words = texts.find_words(block)
            hashes, at = texts.windows(texts.word_hashes(block, words), words, n)
            ids = _ids(rows)
            again = ids[words.owners()[at]] > least[np.searchsorted(own, hashes)]
            gone = texts.covered(at[again], n, len(words.starts))
            raw = block.data.tobytes()
            kept = []
            for i in range(len(block)):
                a, b = words.first[i], words.first[i + 1]
                stay = np.flatnonzero(~gone[a:b]) + a
                kept.append(b" ".join([raw[s:e] for s, e in zip(words.starts[stay], words.ends[stay], strict=True)]))
            columns = {
                "doc_id": rows["doc_id"],
                "n_words": pa.array(words.counts()),
                "n_removed": pa.array(texts.sums(gone, words.first)),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
            }
            if give_text:
                columns["kept_text"] = pa.array(kept, pa.binary()).cast(pa.string())
            out.append(pa.RecordBatch.from_arrays(list(columns.values()), list(columns)))
        return pa.Table.from_batches(out)

    return remove


def remove_repeated_windows(documents: DataFrame, n: int = WINDOW, give_text: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256[, kept_text])`` per row of ``documents (doc_id, text)``.

    A word goes if it lies in a window of ``n`` words that also starts in a document of a
    smaller id; the kept words are joined by single spaces.
    """
    total = text_bytes(documents)
    parts = ranges_for(documents.sparkSession, total)
    texts_by_bucket = bucketed(documents, total)
    sent = texts_by_bucket.groupBy("bucket").applyInArrow(_sender(n, parts), SENT)
    answers = sent.groupBy("part").applyInArrow(_answer, ANSWER)
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * give_text
    both = texts_by_bucket.groupBy("bucket").cogroup(answers.groupBy("bucket"))
    return both.applyInArrow(_remover(n, give_text), schema)
