"""Toxicity scores by a factorization machine over hashed terms.

A text's score is the logistic of a bias, the weights of its terms and, for every pair of
terms, the product of their factor vectors: an insult next to a mention of a group can count
for more than the two apart. Terms are the words and, since insults are inflected, their first
4, 5 and 6 bytes, all hashed to ``BUCKETS`` numbers. The model is fitted on a bounded sample of the labelled
rows: about ``TRAIN_ROWS``, chosen by a hash of the id, and of each label a quarter of that where there are so many. It keeps the terms
that tell the labels apart there by themselves, and those that do so with another one, though each may be neutral
alone: for any two of the ``PAIR_TERMS`` most frequent terms the texts that hold both are held against what the two
let expect apart. Scoring is one pass over all whole texts without a shuffle.

Nulls and edge cases: a null or empty text has no term and scores the bias alone. Repeated rows
are scored each for itself. Labels that are null or without a document are left out; without
any label of both kinds every score is the share of label 1, or 0.5. A null ``doc_id`` is
scored and never learned from. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import texts

STEMS = (4, 5, 6)
BUCKETS = 1 << 20
FACTORS = 4
# At most about so many labelled rows are learned from; terms in at least so many of them whose
# share of label 1 differs from that of all rows by at least so much are kept.
TRAIN_ROWS = 12_000
MIN_ROWS_OF_TERM = 4
MIN_CHI_SQUARE = 12.0
# Frequent terms of which all pairs are looked at, and how far and in how many rows a pair must differ from what its terms let expect.
PAIR_TERMS = 1024
MIN_PAIR_CHI_SQUARE = 50.0
MIN_ROWS_OF_PAIR = 12
ROUNDS = 120
RATE = 0.05
DECAY = 3e-4


@dataclass
class Model:
    bias: float
    keys: np.ndarray  # the buckets it knows, ascending
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of texts whose different terms are the keys at ``terms[first[i]:first[i + 1]]``."""
        total = self.bias + _row_sums(self.weights[terms], first)
        for k in range(self.factors.shape[1]):
            v = self.factors[terms, k]
            total += 0.5 * (_row_sums(v, first) ** 2 - _row_sums(v * v, first))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    running = np.zeros(len(values) + 1)
    np.cumsum(values, out=running[1:])
    return np.diff(running[first])


def _terms(block: texts.Block, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each text's different hashed terms, and where those of each text begin; with ``place`` by bucket, the places of those that have one."""
    words = texts.find_words(block, texts.ALNUM)
    symbols = texts._SYMBOLS[texts.LOWER[block.data]]
    found = []
    for size in (None, *STEMS):
        ends = words.ends if size is None else np.minimum(words.ends, words.starts + size)
        terms = texts.span_hashes(symbols, words.starts, ends)
        terms = (texts.mix(terms + np.uint64(size or 0)) % np.uint64(BUCKETS)).astype(np.int64)
        owner = words.owners().astype(np.int64)
        if place is not None:
            terms = place[terms]
            hit = terms >= 0
            terms, owner = terms[hit], owner[hit]
        found.append(owner << 32 | terms)
    keys = np.unique(np.concatenate(found))
    return keys & 0xFFFFFFFF, np.searchsorted(keys >> 32, np.arange(len(block) + 1))


def _labelled_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, block in texts.blocks(batches):
        terms, first = _terms(block)
        packed = [terms[a:b].astype("<u4").tobytes() for a, b in pairwise(first)]
        yield pa.RecordBatch.from_arrays([rows["label"], pa.array(packed, pa.binary())], ["label", "terms"])


def _told_by_pairs(terms: np.ndarray, first: np.ndarray, y: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The frequent terms whose texts, where they hold another one as well, have other labels than the two let expect."""
    few = min(PAIR_TERMS, int((seen >= MIN_ROWS_OF_PAIR).sum()))
    frequent = np.sort(np.argpartition(-seen, few - 1)[:few]) if few else np.zeros(0, np.int64)
    place = np.full(BUCKETS, -1, np.int32)
    place[frequent] = np.arange(few)
    both, toxic = np.zeros((few, few)), np.zeros((few, few))
    for begin in range(0, len(y), 1000):  # so many rows at once
        end = min(begin + 1000, len(y))
        here = place[terms[first[begin] : first[end]]]
        rows = np.repeat(np.arange(end - begin), np.diff(first[begin : end + 1]))[here >= 0]
        held = np.zeros((end - begin, few), np.float32)
        held[rows, here[here >= 0]] = 1
        both += held.T @ held
        toxic += (held * y[begin:end, None].astype(np.float32)).T @ held
    if not few:
        return frequent
    share = np.diag(toxic) / np.diag(both)
    expected = np.clip(share[:, None] + share[None, :] - y.mean(), 0.02, 0.98)
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.where(both >= MIN_ROWS_OF_PAIR, (toxic - both * expected) ** 2 / (both * expected * (1 - expected)), 0)
    # A stem and its word are nearly one term and no pair.
    alike = both >= 0.8 * np.sqrt(np.outer(np.diag(both), np.diag(both)))
    return frequent[(np.where(alike, 0, apart) >= MIN_PAIR_CHI_SQUARE).any(1)]


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model for ``labelled (doc_id, text, label)``, of which a sample by the id's hash is used."""
    rows = labelled.where("label in (0, 1) and doc_id is not null").selectExpr("doc_id", "cast(text as string) as text", "cast(label as int) as label")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    chosen = F.lit(False)
    for label, count in counts.items():
        share = min(1.0, max(train_rows / sum(counts.values()), train_rows / 4 / count))
        chosen = chosen | ((F.col("label") == label) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < math.ceil(share * (1 << 40))))
    sample = rows.where(chosen).select("text", "label").mapInArrow(_labelled_terms, "label int, terms binary").collect()
    sample.sort(key=lambda r: (r.label, r.terms))
    y = np.array([r.label for r in sample], float)
    if len(np.unique(y)) < 2:
        p = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        return Model(float(np.log(p / (1 - p))), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    first = np.concatenate([[0], np.cumsum([len(r.terms) // 4 for r in sample])])
    terms = np.frombuffer(b"".join(r.terms for r in sample), "<i4")
    del sample
    toxic = np.bincount(terms[first[np.searchsorted(y, 1)] :], minlength=BUCKETS)  # rows are sorted by label
    seen, share = np.bincount(terms, minlength=BUCKETS), y.mean()
    apart = (toxic - seen * share) ** 2 / np.maximum(seen * share * (1 - share) * (1 - seen / (len(y) + 1)), 1e-9)
    alone = np.flatnonzero((seen >= MIN_ROWS_OF_TERM) & (apart >= MIN_CHI_SQUARE))
    used = np.union1d(alone, _told_by_pairs(terms, first, y, seen))
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    column = place[terms]
    del terms
    kept = [column[a:b][column[a:b] >= 0] for a, b in pairwise(first)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in kept])])
    column = np.concatenate(kept)
    del kept
    owner = np.repeat(np.arange(len(y)), np.diff(first))
    bias, weights, factors = _descend(column, owner, first, y, len(used))
    return Model(bias, used, weights.astype(np.float32), factors.astype(np.float32))


def _descend(column: np.ndarray, owner: np.ndarray, first: np.ndarray, y: np.ndarray, n: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by Adam on the whole sample's logistic loss."""
    size = 1 + n * (1 + FACTORS)
    x = np.concatenate([[np.log(y.mean() / (1 - y.mean()))], np.zeros(n), np.random.default_rng(7).normal(0, 0.01, n * FACTORS)])
    m, s = np.zeros(size), np.zeros(size)
    gather = lambda per_row: np.bincount(column, weights=per_row, minlength=n)
    for step in range(1, ROUNDS + 1):
        model = Model(x[0], column, x[1 : n + 1], x[n + 1 :].reshape(n, FACTORS))
        miss = (model.scores(column, first) - y) / len(y)
        by_entry = miss[owner]
        slope = [np.array([miss.sum()]), gather(by_entry)]
        of_factors = np.empty((n, FACTORS))
        weight_sum = slope[1]
        for k in range(FACTORS):
            v = model.factors[:, k]
            of_factors[:, k] = gather(by_entry * _row_sums(v[column], first)[owner]) - v * weight_sum
        g = np.concatenate([*slope, of_factors.ravel()]) + DECAY * np.concatenate([[0.0], x[1:]])
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return float(x[0]), x[1 : n + 1], x[n + 1 :].reshape(n, FACTORS)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` per row of ``documents (doc_id, text)``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's terms

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, np.int64)
        place[shared.value.keys] = np.arange(len(shared.value.keys))
        for rows, block in texts.blocks(batches):
            values = shared.value.scores(*_terms(block, place))
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(values)], ["doc_id", "score"])

    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(scored, "doc_id bigint, score double")


def labelled_documents(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """``(doc_id, text, label)`` of the documents that have a label."""
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.join(labels.selectExpr("cast(doc_id as bigint) as doc_id", f"cast({label} as int) as label"), "doc_id")
