"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers cut the same bytes. The incidence matrix of a text has a row per token and a column
per byte; for tokenizers A and B the product A x B' of these, by Gustavson's row products over
compressed rows (``csr.py``), has an entry for each pair of tokens that overlap, its value the bytes
they share. Overlapping tokens that end at the same byte are linked; where that happens the text falls
into groups, the smallest pieces that both cut alike. The incidence matrix of groups and bytes times that
of bytes and tokens gives the tokens of each group, for A and for B, and these two matrices multiply to the
pairs of tokens that share a group.

One pass encodes every text; its digest and its packed links are written. Links are counted by pair of
ids over the whole corpus: tasks add up what they hold before anything is moved, so a pair that every
text holds is one row per task. Linked tokens end together, so the bytes of one are the end of those of
the other: a token of n bytes is linked with at most n shorter ones, and the counted pairs are no more
than the lengths of all tokens of both vocabularies together (each byte may have a second id) - under a
million for the default ones, whatever the corpus. That table is sent to the tasks, which look up each
text's links in a second pass over what was written, not over the texts.

Nulls and edge cases: a null or empty text, and one whose bytes a tokenizer does not give back (a
normalised or reserved character), has no tokens and gives zeros and an empty string. Special tokens'
strings in a text are ordinary text. Repeated rows count each. A null ``doc_id`` is passed through. An
empty table gives an empty result; other columns are not read. A text is held by one task, whole;
memory is that of a block of texts or of the longest text, and products are made some rows at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm import texts
from corvane.llm.csr import Csr, row_products, runs
from corvane.llm.exchange import written
from corvane.llm.tokens import default_pieces, default_vocabulary, encode, pieces, vocabulary

BLOCK_BYTES = 1 << 20

ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, groups_sha256 string, links binary"
COUNTS = "link bigint, n bigint"
DIGEST = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, n_shared bigint"
OVERLAPS = "doc_id bigint, a_at bigint, b_at bigint, a_id bigint, b_id bigint, n_bytes bigint, end_together boolean"
SHARED = "doc_id bigint, a_at bigint, b_at bigint, a_id bigint, b_id bigint, group_at bigint"


@dataclass
class Side:
    """The tokens of one tokenizer in a block of texts that follow one another: ids, bytes, and where each text's tokens begin."""

    ids: np.ndarray
    lengths: np.ndarray
    first: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.lengths)


@dataclass
class Tokenizers:
    """How to encode, the bytes of each id, and the strings that groups are written with."""

    encode_a: Callable[[str], np.ndarray]
    encode_b: Callable[[str], np.ndarray]
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    names: np.ndarray  # ids followed by "," , "|" and ";"

    def sides(self, values: list[str | None]) -> tuple[Side, Side]:
        found = [[], []]
        for text in values:
            pair = [np.zeros(0, np.int64)] * 2
            if text:
                whole = f" {text}".encode()
                encoded = [(self.encode_a(text), self.bytes_a), (self.encode_b(text), self.bytes_b)]
                if all(b"".join(map(known.__getitem__, ids.tolist())) == whole for ids, known in encoded):
                    pair = [ids for ids, _ in encoded]
            for side, ids in zip(found, pair, strict=True):
                side.append(ids)
        sizes = [np.array([len(x) for x in known], np.int64) for known in (self.bytes_a, self.bytes_b)]
        return tuple(
            Side(ids := np.concatenate([*side, np.zeros(0, np.int64)]).astype(np.int64), size[ids], np.concatenate([[0], np.cumsum([len(x) for x in side], dtype=np.int64)]))
            for side, size in zip(found, sizes, strict=True)
        )


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    model, bytes_b = pieces(path_b)
    bytes_a = vocabulary(path_a).token_bytes
    ids = range(max(len(bytes_a), len(bytes_b)))
    names = np.array([f"{i}{sign}" for sign in ",|;" for i in ids], object)
    return Tokenizers(lambda x: encode(path_a, f" {x}"), lambda x: np.asarray(model.encode(x), np.int64), bytes_a, bytes_b, names)


def overlaps(a: Side, b: Side) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(token of a, token of b, shared bytes)`` of all overlapping tokens: the product of the incidence matrices of tokens and bytes."""
    return row_products(runs(a.lengths), runs(b.lengths).transposed())


def end_links(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of overlapping tokens that end together."""
    ends_a, ends_b = a.ends, b.ends
    found = [(i[same], j[same]) for i, j, _ in overlaps(a, b) for same in [ends_a[i] == ends_b[j]]]
    return tuple(np.concatenate([*x, np.zeros(0, np.int64)]) for x in (zip(*found, strict=True) if found else ((), ())))


def _members(groups: Csr, side: Side) -> Csr:
    """The matrix of groups (rows) and the tokens that share a byte with them: the product of the incidence matrices of groups and tokens with bytes."""
    found = [(g, i) for g, i, _ in row_products(groups, runs(side.lengths).transposed())]
    rows, tokens = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (zip(*found, strict=True) if found else ((), ())))
    indptr = np.zeros(len(groups) + 1, np.int64)
    np.cumsum(np.bincount(rows, minlength=len(groups)), out=indptr[1:])
    return Csr(indptr, tokens, len(side.ids))


def group_incidence(a: Side, b: Side, links: tuple[np.ndarray, np.ndarray]) -> tuple[Csr, Csr]:
    """For A and for B the matrix of groups (rows) and their tokens; a group holds the bytes up to where a link ends."""
    groups = runs(np.diff(a.ends[links[0]], prepend=0))
    return _members(groups, a), _members(groups, b)


def shared_groups(groups_a: Csr, groups_b: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(token of a, token of b, 1)`` of all tokens that share a group: the product of the incidence matrices of tokens and groups."""
    return row_products(groups_a.transposed(), groups_b)


def _written_groups(names: np.ndarray, a: Side, b: Side, groups_a: Csr, groups_b: Csr) -> np.ndarray:
    """The strings of all tokens in the order of ``a1,a2|b1;a3|b2,b3``, each with the sign after it."""
    n_ids = len(names) // 3
    of_a = np.repeat(np.arange(len(groups_a)), np.diff(groups_a.indptr))
    of_b = np.repeat(np.arange(len(groups_b)), np.diff(groups_b.indptr))
    codes = np.empty(len(a.ids) + len(b.ids), np.int64)
    last_a, last_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    last_a[groups_a.indptr[1:] - 1] = True
    last_b[groups_b.indptr[1:] - 1] = True
    codes[np.arange(len(a.ids)) + groups_b.indptr[of_a]] = a.ids + n_ids * last_a
    codes[np.arange(len(b.ids)) + groups_a.indptr[of_b + 1]] = b.ids + 2 * n_ids * last_b
    return names[codes]


def _aligner(path_a: str, path_b: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(path_a, path_b)
        for rows, _ in texts.blocks(batches, size=BLOCK_BYTES):
            a, b = known.sides(rows["text"].to_pylist())
            i, j = end_links(a, b)
            groups_a, groups_b = group_incidence(a, b, (i, j))
            strings = _written_groups(known.names, a, b, groups_a, groups_b)
            first = np.searchsorted(i, a.first)  # a text's last tokens are linked, so its groups and links are those of its tokens
            pairs = (a.ids[i] * len(known.bytes_b) + b.ids[j]).astype(np.uint64)
            shared = np.zeros(len(rows), np.int64)
            for of_a, _, _ in shared_groups(groups_a, groups_b):
                shared += np.bincount(np.searchsorted(a.first, of_a, "right") - 1, minlength=len(rows))
            digests, packed = [], []
            both = a.first + b.first
            for k in range(len(rows)):
                written_out = "".join(strings[both[k] : both[k + 1]].tolist())[:-1]
                digests.append(hashlib.sha256(written_out.encode()).hexdigest() if written_out else "")
                packed.append(texts.pack(pairs[first[k] : first[k + 1]]))
            n = np.diff(first)
            columns = [np.diff(a.first), np.diff(b.first), n, n, shared]
            names = [x.split()[0] for x in ALIGNED.split(", ")]
            yield pa.RecordBatch.from_arrays([rows["doc_id"], *map(pa.array, columns), pa.array(digests, pa.string()), pa.array(packed, pa.binary())], names)

    return align


def _batch_links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The links of all texts of a batch, and where those of each begin."""
    links = [texts.unpack(x.as_py()) for x in batch["links"]]
    return np.concatenate([*links, np.zeros(0, np.uint64)]).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in links], dtype=np.int64)])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task, each different pair once. There are no more of these than the vocabularies allow."""
    links, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        new, n = np.unique(_batch_links(batch)[0], return_counts=True)
        either, place = np.unique(np.concatenate([links, new]), return_inverse=True)
        links, counts = either, np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(either)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(links), pa.array(counts)], ["link", "n"])


def link_counts(aligned: DataFrame, ids_b: int) -> DataFrame:
    """``(link, n, best)`` of each pair of ids: its links in the whole corpus, and whether no pair of its B id has more."""
    counts = aligned.select("links").mapInArrow(_added, COUNTS).groupBy("link").agg(F.sum("n").alias("n"))
    of_b = Window.partitionBy(F.col("link") % ids_b)
    return counts.select("link", "n", (F.col("n") == F.max("n").over(of_b)).alias("best"))


def aligned_documents(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per row of ``documents (doc_id, text)`` its tokens, groups, links and the packed pairs ``a_id * B's ids + b_id`` of its links."""
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(_aligner(path_a or default_vocabulary(), path_b or default_pieces()), ALIGNED)


def alignment(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row of ``DIGEST`` per row of ``documents (doc_id, text)``.

    ``n_best`` are the links whose pair no other pair of the same B id outnumbers in the corpus, ``count_sum`` the sum of the pairs'
    counts over the links, ``n_shared`` the pairs of tokens that share a group.
    """
    spark = documents.sparkSession
    aligned = written(aligned_documents(documents, path_a, path_b), "aligned")
    table = link_counts(aligned, len(pieces(path_b or default_pieces())[1])).orderBy("link").toArrow()
    known = spark.sparkContext.broadcast(tuple(np.asarray(table[c].combine_chunks().to_numpy(zero_copy_only=False)) for c in ("link", "n", "best")))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, counts, best = known.value
        for batch in batches:
            own, first = _batch_links(batch)
            at = np.searchsorted(links, own)
            columns = {c: batch[c] for c in batch.schema.names if c != "links"}
            columns["n_best"] = pa.array(texts.sums(best[at].astype(np.int64), first))
            columns["count_sum"] = pa.array(texts.sums(counts[at], first))
            names = [x.split()[0] for x in DIGEST.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return aligned.mapInArrow(looked_up, DIGEST)


def _link_rows(path_a: str, path_b: str, kind: str):
    """Links as rows, some at a time; places count a text's own tokens and groups."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(path_a, path_b)
        for rows, _ in texts.blocks(batches, size=BLOCK_BYTES):
            a, b = known.sides(rows["text"].to_pylist())
            ends_a, ends_b = a.ends, b.ends
            if kind == "shared":
                groups = group_incidence(a, b, end_links(a, b))
                group_of = np.repeat(np.arange(len(groups[0])), np.diff(groups[0].indptr))
                group_first = np.concatenate([group_of, [len(groups[0])]])[a.first]
            for i, j, value in shared_groups(*groups) if kind == "shared" else overlaps(a, b):
                owner = np.searchsorted(a.first, i, "right") - 1
                columns = [rows["doc_id"].take(pa.array(owner)), i - a.first[owner], j - b.first[owner], a.ids[i], b.ids[j]]
                columns += [group_of[i] - group_first[owner]] if kind == "shared" else [value, ends_a[i] == ends_b[j]]
                names = [x.split()[0] for x in (SHARED if kind == "shared" else OVERLAPS).split(", ")]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)

    return links


def overlap_links(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Every pair of overlapping tokens of ``documents (doc_id, text)``: their places and ids, the bytes they share, and whether they end together."""
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(_link_rows(path_a or default_vocabulary(), path_b or default_pieces(), "overlap"), OVERLAPS)


def shared_group_links(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Every pair of tokens of ``documents (doc_id, text)`` that share a group: their places and ids, and the group's place."""
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(_link_rows(path_a or default_vocabulary(), path_b or default_pieces(), "shared"), SHARED)
