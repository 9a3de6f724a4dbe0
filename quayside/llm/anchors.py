"""Content-defined anchors of byte strings, in numpy: the same places in every copy of a long enough passage."""

from __future__ import annotations

import numpy as np

from quayside.llm import hashing as H


def running(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any substring follows (one more than there are bytes)."""
    up, _ = H.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(H.BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    return total


def substring_hashes(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to before each end."""
    _, down = H.powers(len(total))
    return H.mixed((total[end] - total[start]) * down[start])


def window_minima(value: np.ndarray, window: int) -> np.ndarray:
    """Least value of each ``window`` neighbours; len(value) - window + 1 of them."""
    n = len(value) - window + 1
    blocks = -(-len(value) // window)
    padded = np.full(blocks * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(value)] = value
    grid = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[window - 1 : window - 1 + n])


def minima(value: np.ndarray, ok: np.ndarray, window: int) -> np.ndarray:
    """Places whose value is the least of some ``window`` neighbours; ``ok`` says which windows count. Ties are all taken."""
    low = np.where(ok, window_minima(value, window), np.uint64(0))
    # a place is taken if its value is the largest of the minima of the windows that hold it
    edge = np.zeros(window - 1, np.uint64)
    most = ~window_minima(~np.concatenate([edge, low, edge]), window)
    return np.flatnonzero(value == most)


def anchors(texts: H.Texts, total: np.ndarray, seed: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the slice) and hashes of the ``seed``-byte strings that are least among ``window`` neighbours.

    Every string of seed + window - 1 bytes of a document holds one at least, and where it stands depends on
    that string alone. Shorter documents have none.
    """
    n = len(texts.data) - seed + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    _, down = H.powers(n)
    value = H.mixed((total[seed : seed + n] - total[:n]) * down)
    # a window that reaches over a document's end gives no anchor
    place = minima(value, H.in_one_document(texts.bounds, n - window + 1, seed + window - 1), window)
    return place, value[place]
