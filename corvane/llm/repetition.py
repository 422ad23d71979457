"""Quality rules: how much of a text repeats itself, and which texts to keep.

Rolling hashes of several n-gram lengths mark the words that lie in duplicated
n-grams; their characters are measured against those of all words. Lines are
hashed likewise. One pass over the texts and no shuffle.

Nulls and edge cases: a null or empty text has no word and fails the basic rule
(fewer than ``MIN_WORDS`` words). Repeated rows are judged each for itself. A null
``doc_id`` is passed through. An empty table gives an empty result. Other columns
are not read by ``measure`` and are passed through by ``kept_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.llm import texts

# Bytes of text measured together: some twenty numbers of 8 bytes are held for each.
BLOCK_BYTES = 1 << 20
MIN_WORDS = 20
BASE_WINDOW, BASE_PERCENT = 8, 30
# Largest share of the words' characters that duplicated n-grams of a length may hold.
NGRAM_LIMITS = {5: 0.35, 6: 0.33, 7: 0.31, 8: 0.30, 9: 0.28, 10: 0.26}
# The same for words that repeat the word before them, and for duplicated lines.
ECHO_LIMIT = 0.30
LINE_CHARS_LIMIT = 0.30

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
MEASURES = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, dup_ngram_share double, echo_share double, dup_line_share double"
)


def _measure(block: texts.Block) -> dict[str, np.ndarray]:
    words = texts.find_words(block)
    owners, n_words = words.owners(), words.counts()
    hashes = texts.word_hashes(block, words)
    first_bytes = (block.data & 0xC0) != 0x80
    chars = texts.sums(first_bytes & texts.NOT_SPACE[block.data], np.stack([words.starts, words.ends], 1).ravel())[::2]
    word_chars = texts.sums(chars, words.first)
    share = lambda marked: texts.sums(np.where(marked, chars, 0), words.first) / np.maximum(word_chars, 1)

    failed = np.zeros(len(block), bool)
    dup_share = np.zeros(len(block))
    n_repeat = np.zeros(len(block), np.int64)
    salts = texts.mix(np.arange(len(block), dtype=np.uint64) + np.uint64(1))
    for n, limit in NGRAM_LIMITS.items():
        grams, at = texts.windows(hashes, words, n)
        several, _ = texts.repeated(texts.mix(grams ^ salts[owners[at]]))
        marked = texts.covered(at[several], n, len(hashes))
        part = share(marked)
        dup_share = np.maximum(dup_share, part)
        failed |= part > limit
        if n == BASE_WINDOW:
            n_repeat = texts.sums(marked, words.first)

    echo = np.zeros(len(hashes), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])
    echo_share = share(echo)

    # Lines: each text is cut at its line feeds; lines without a word do not count.
    feeds = np.flatnonzero(block.data == 0x0A)
    # One line for each place: empty texts and the empty last line after a feed begin where the next text does.
    begins = np.unique(np.concatenate([block.offsets[:-1], feeds + 1]))
    line_of = np.searchsorted(block.offsets, begins, "right") - 1
    ends = np.minimum(np.searchsorted(feeds, begins), len(feeds))
    next_feed = np.concatenate([feeds, [len(block.data)]])[ends]
    stops = np.maximum(np.minimum(next_feed, block.offsets[np.minimum(line_of + 1, len(block))]), begins)
    low, high = np.searchsorted(words.starts, begins), np.searchsorted(words.starts, stops)
    real = high > low
    begins, stops, line_of, low, high = (x[real] for x in (begins, stops, line_of, low, high))
    lines = texts.span_hashes(texts._SYMBOLS[block.data], begins, stops)
    _, later = texts.repeated(texts.mix(lines ^ salts[line_of]))
    n_dup_lines = np.bincount(line_of[later], minlength=len(block))
    running = np.concatenate([[0], np.cumsum(chars)])
    dup_chars = np.bincount(line_of[later], (running[high] - running[low])[later], minlength=len(block))
    line_share = dup_chars / np.maximum(word_chars, 1)

    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > BASE_PERCENT * n_words)
    failed |= (echo_share > ECHO_LIMIT) | (line_share > LINE_CHARS_LIMIT)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": texts.sums(SYMBOLS[block.data], block.offsets),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": ~base_failed & ~failed,
        "dup_ngram_share": dup_share,
        "echo_share": echo_share,
        "dup_line_share": line_share,
    }


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, block in texts.blocks(batches, size=BLOCK_BYTES):
        values = _measure(block)
        yield pa.RecordBatch.from_arrays([rows["doc_id"], *map(pa.array, values.values())], ["doc_id", *values])


def measure(documents: DataFrame) -> DataFrame:
    """One row of measures and verdicts per row of ``documents (doc_id, text)``."""
    return documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").mapInArrow(_measured, MEASURES)


def kept_documents(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose text passes, with all their columns."""

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in texts.blocks(batches, size=BLOCK_BYTES):
            yield rows.filter(pa.array(_measure(block)["kept"]))

    return documents.mapInArrow(passing, documents.schema)
