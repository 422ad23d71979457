"""Sparse matrices of zeros and ones by compressed rows, and Gustavson's row products of them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Products of single entries that are held at once; one row may have more.
PRODUCTS = 1 << 20


@dataclass
class Csr:
    """Row i holds ones in the columns ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self)), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable")
        indptr = np.zeros(self.width + 1, np.int64)
        np.cumsum(np.bincount(self.indices, minlength=self.width), out=indptr[1:])
        return Csr(indptr, rows[order], len(self))


def runs(lengths: np.ndarray) -> Csr:
    """Row i holds the ``lengths[i]`` columns after those of the rows before it: the bytes of a token, or the tokens of a group."""
    indptr = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return Csr(indptr, np.arange(indptr[-1]), int(indptr[-1]))


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i]`` to ``starts[i] + lengths[i] - 1``, for all i in turn."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def row_products(a: Csr, b: Csr, most: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``a @ b`` as ``(row, column, value)`` in row order, some rows at a time.

    Row i of the product is the sum of the rows of ``b`` that row i of ``a`` names: their
    entries are laid one after the other and equal columns are added up.
    """
    sizes = np.diff(b.indptr)
    work = np.concatenate([[0], np.cumsum(sizes[a.indices])])[a.indptr]
    begin = 0
    while begin < len(a):
        end = max(begin + 1, int(np.searchsorted(work, work[begin] + most, "right")) - 1)
        named = a.indices[a.indptr[begin] : a.indptr[end]]
        columns = b.indices[_spread(b.indptr[named], sizes[named])]
        rows = np.repeat(np.arange(begin, end), np.diff(work[begin : end + 1]))
        keys = rows * b.width + columns
        if np.any(keys[1:] < keys[:-1]):
            keys.sort()
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        yield keys[heads] // b.width, keys[heads] % b.width, np.diff(np.append(heads, len(keys)))
        begin = end
