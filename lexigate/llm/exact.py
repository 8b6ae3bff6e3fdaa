"""Exact integer inner products of vectors that are kept as whole-numbered floats."""

from __future__ import annotations

import numpy as np

LONGEST = 2**63


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b``, as longs.

    Sums that stay below 2^53 are exact in floats; only cells that might exceed it are computed in
    Python's integers. A product beyond a long is an error.
    """
    found = a @ b.T
    most_a, most_b = (np.abs(x).max(axis=1, initial=0) for x in (a, b))
    width = max(1, a.shape[1])
    if most_a.max(initial=0) * most_b.max(initial=0) * width < 2**53:
        return found.astype(np.int64)
    safe = most_a[:, None] * most_b[None, :] * width < 2**53
    result = np.where(safe, found, 0).astype(np.int64)
    left = {i: [int(x) for x in a[i].tolist()] for i in np.flatnonzero(~safe.all(axis=1)).tolist()}
    right = {j: [int(x) for x in b[j].tolist()] for j in np.flatnonzero(~safe.all(axis=0)).tolist()}
    for i, j in np.argwhere(~safe).tolist():
        value = sum(x * y for x, y in zip(left[i], right[j], strict=True))
        if not -LONGEST <= value < LONGEST:
            raise OverflowError(f"an inner product needs more than 64 bits: {value}")
        result[i, j] = value
    return result


def whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of finite components."""
    found = np.floor(vectors.astype(np.float64) * scale)
    if not np.isfinite(found).all():
        raise OverflowError(f"{scale} times a component is beyond a double")
    return found
