"""Token counts that follow edits without encoding whole texts again.

A document's text is cut into leaves at places where the tokenizer's pre-token split cannot
depend on either side: before a single space between two other characters, and between a letter or digit and a sign, as no pre-token
reaches over these. A segment tree holds the
leaves' token counts and their sums. An edit re-encodes only the leaves it touches, together with
the neighbour where it comes within ``CONTEXT`` characters of a cut, and adds the difference
to the sums on the way to the root. Counts equal those of encoding the edited text.

Each step is one pass over the rows without a shuffle; memory is bounded by a batch of texts.

Nulls and edge cases: a null text is empty and has no tokens; null edits are none. Edits are
``(start, stop, put)`` in characters of the old text, ascending and apart; bounds beyond the
text are taken as its end. Repeated rows are counted each for itself; a null ``doc_id`` is passed
through. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from corvane.llm.tokens import WHITE, default_vocabulary, encode

# Between two characters that are no white space before a space, or after a letter or digit before a sign.
SAFE = regex.compile(rf"(?<=[^{WHITE}])(?= [^{WHITE}])|(?<=[\p{{L}}\p{{N}}])(?=[^{WHITE}\p{{L}}\p{{N}}])")
LEAF_CHARS = 400
CONTEXT = 2

COUNTED = "doc_id bigint, text string, cuts array<int>, sums array<bigint>"
EDITED = COUNTED + ", edits array<struct<start:int,stop:int,put:string>>"
RECOUNTED = "doc_id bigint, n_tokens bigint, n_edits bigint, n_tokens_after bigint, n_chars_encoded bigint"


def leaf_cuts(text: str, size: int = LEAF_CHARS) -> list[int]:
    """Where leaves begin: 0, then the first safe place after each ``size`` characters."""
    cuts = [0]
    while place := SAFE.search(text, cuts[-1] + size):
        cuts.append(place.start())
    return cuts


class Tree:
    """Sums over leaves in a binary heap: node i has the children 2 i and 2 i + 1, leaves come last."""

    def __init__(self, sums: list[int]):
        self.sums = sums

    @classmethod
    def over(cls, counts: list[int]) -> Tree:
        n = len(counts)
        sums = [0] * n + list(counts)
        for i in range(n - 1, 0, -1):
            sums[i] = sums[2 * i] + sums[2 * i + 1]
        return cls(sums)

    @property
    def total(self) -> int:
        return self.sums[1]

    def set(self, leaf: int, count: int) -> None:
        node = len(self.sums) // 2 + leaf
        change = count - self.sums[node]
        while node >= 1:
            self.sums[node] += change
            node //= 2


def recount(text: str, cuts: list[int], tree: Tree, edits: list, vocabulary: str) -> int:
    """Update the tree for the edits; returns how many characters were encoded."""
    bounds = [*cuts, len(text)]
    leaf_of = lambda at: min(max(bisect_right(cuts, at) - 1, 0), len(cuts) - 1)
    regions: list[list] = []
    for start, stop, put in edits:
        first, last = leaf_of(start - CONTEXT), leaf_of(stop + CONTEXT)
        if regions and first <= regions[-1][1]:
            regions[-1][1] = max(last, regions[-1][1])
            regions[-1][2].append((start, stop, put))
        else:
            regions.append([first, last, [(start, stop, put)]])
    encoded = 0
    for first, last, inside in regions:
        at, parts = bounds[first], []
        for start, stop, put in inside:
            parts += [text[at:start], put]
            at = max(at, stop)
        parts.append(text[at : bounds[last + 1]])
        new = "".join(parts)
        encoded += len(new)
        tree.set(first, len(encode(vocabulary, new)))
        for leaf in range(first + 1, last + 1):
            tree.set(leaf, 0)
    return encoded


def count(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, text, cuts, sums)``: each text with its tree; ``sums[1]`` is its token count."""
    vocabulary = vocabulary or default_vocabulary()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts, sums = [], []
            for value in batch["text"]:
                text = value.as_py() or ""
                own = leaf_cuts(text)
                leaves = [len(encode(vocabulary, text[a:b])) for a, b in zip(own, [*own[1:], len(text)], strict=True)]
                cuts.append(own)
                sums.append(Tree.over(leaves).sums)
            trees = [pa.array(cuts, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], *trees], ["doc_id", "text", "cuts", "sums"])

    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(counted, COUNTED)


def with_masking(counted: DataFrame, pattern: str = "[0-9]{4,}", put: str = "0") -> DataFrame:
    """``counted`` with ``edits`` that replace every match of a pattern, as for personal data."""
    found = re.compile(pattern)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("put", pa.string())]))

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = [[{"start": m.start(), "stop": m.end(), "put": put} for m in found.finditer(x.as_py() or "")] for x in batch["text"]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, kind)], [*batch.schema.names, "edits"])

    return counted.mapInArrow(masked, EDITED)


def recounted(edited: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Token counts before and after the ``edits`` of each row of ``count``, and what was encoded for it."""
    vocabulary = vocabulary or default_vocabulary()

    def updated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, value, cuts, sums, edits in zip(*(batch[c] for c in ("doc_id", "text", "cuts", "sums", "edits")), strict=True):
                tree, text = Tree(sums.as_py()), value.as_py() or ""
                before = tree.total
                changes = [(min(e["start"], len(text)), min(e["stop"], len(text)), e["put"]) for e in edits.as_py() or ()]
                encoded = recount(text, cuts.as_py(), tree, changes, vocabulary)
                rows.append((doc_id.as_py(), before, len(changes), tree.total, encoded))
            names = [x.split()[0] for x in RECOUNTED.split(", ")]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return edited.mapInArrow(updated, RECOUNTED)
