"""Sparse matrices in compressed rows, on numpy arrays, with Gustavson's row-wise product."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BLOCK = 1 << 21  # products formed at a time


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of each one's values."""
    if len(keys) > 1 and not (keys[1:] >= keys[:-1]).all():
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
    first = _starts(keys)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


class CSR(NamedTuple):
    """Row ``i`` has the columns ``col[ptr[i]:ptr[i + 1]]``, ascending, with the values ``val``."""

    ptr: np.ndarray
    col: np.ndarray
    val: np.ndarray
    width: int

    @classmethod
    def of(cls, rows: np.ndarray, cols: np.ndarray, shape: tuple[int, int],
           values: np.ndarray | None = None) -> CSR:
        """From entries in any order; those of one place are added up."""
        if values is None:
            values = np.ones(len(rows), np.int64)
        keys, values = _summed(rows.astype(np.int64) * shape[1] + cols, values)
        return cls._from_keys(keys, values, *shape)

    @classmethod
    def _from_keys(cls, keys: np.ndarray, values: np.ndarray, height: int, width: int) -> CSR:
        ptr = np.searchsorted(keys, np.arange(height + 1) * width)
        return cls(ptr, keys % max(width, 1), values, width)

    @property
    def height(self) -> int:
        return len(self.ptr) - 1

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.height), np.diff(self.ptr))

    def transposed(self) -> CSR:
        return CSR.of(self.col, self.rows(), (self.width, self.height), self.val)

    def __matmul__(self, other: CSR) -> CSR:
        """Row i is the sum of the rows of ``other`` that row i's entries select.

        Rows are taken in blocks of about ``BLOCK`` products, so that memory is bounded by a block
        or by the products of one row.
        """
        reach = np.diff(other.ptr)[self.col]
        upto = np.append(0, np.cumsum(reach))
        at_row = upto[self.ptr]
        own_row = self.rows()
        parts, first = [], 0
        while first < self.height:
            last = max(int(np.searchsorted(at_row, at_row[first] + BLOCK, "right")) - 1, first + 1)
            a, b = self.ptr[first], self.ptr[last]
            times = reach[a:b]
            shift = other.ptr[self.col[a:b]] - (upto[a:b] - upto[a])
            at = np.repeat(shift, times) + np.arange(at_row[last] - at_row[first])
            keys = np.repeat(own_row[a:b], times) * other.width + other.col[at]
            parts.append(_summed(keys, np.repeat(self.val[a:b], times) * other.val[at]))
            first = last
        keys = np.concatenate([k for k, _ in parts]) if parts else np.empty(0, np.int64)
        values = np.concatenate([v for _, v in parts]) if parts else np.empty(0, np.int64)
        return CSR._from_keys(keys, values, self.height, other.width)

    def times(self, vector: np.ndarray) -> np.ndarray:
        """The product with a column."""
        total = np.append(0, np.cumsum(self.val * vector[self.col]))
        return total[self.ptr[1:]] - total[self.ptr[:-1]]
