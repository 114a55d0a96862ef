"""SuperMinHash signatures, many sets at a time.

Each element draws one pseudo-random permutation of the ``m`` slots step by
step (Fisher-Yates) and offers slot ``p(j)`` the value ``j + r(j)``; a slot
keeps its smallest value.  Because all elements offer distinct slots at a step
the slots of a signature are negatively correlated, which gives less variance
than independent hash functions.  A set is done (early stopping) once its
largest slot value is below the next step: sets of a few hundred elements
need one or two steps, sets of one element all ``m``.

Values are integers, ``j`` in the upper and 32 random bits in the lower half.
"""

from __future__ import annotations

import numpy as np

from fathom.llm.textbatch import mix

SLOTS = 64
_GOLDEN = 0x9E3779B97F4A7C15
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def signatures(elements: np.ndarray, owner: np.ndarray, n_sets: int, m: int = SLOTS) -> np.ndarray:
    """(n_sets, m) array; ``owner`` is the set of each element.  Empty sets keep the largest value everywhere."""
    sig = np.full(n_sets * m, _NONE, dtype=np.uint64)
    live, own, perm = elements, owner.astype(np.int64), None
    for j in range(m):
        if not len(live):
            break
        rnd = mix(live + np.uint64((j + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF))
        k = j + ((rnd >> np.uint64(32)).astype(np.int64) * (m - j) >> 32)
        if j == 0:
            slot = k
        else:
            row = np.arange(len(live))
            slot = perm[row, k].astype(np.int64)
            perm[row, k] = perm[row, j]
        np.minimum.at(sig, own * m + slot, np.uint64(j << 32) | (rnd & np.uint64(0xFFFFFFFF)))
        done = (sig.reshape(n_sets, m).max(axis=1) >> np.uint64(32)) <= np.uint64(j)
        stay = ~done[own]
        if j == 0:
            live, own = live[stay], own[stay]
            perm = np.tile(np.arange(m, dtype=np.uint8), (len(live), 1))
            perm[np.arange(len(live)), k[stay]] = 0
        elif not stay.all():
            live, own, perm = live[stay], own[stay], perm[stay]
    return sig.reshape(n_sets, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n_sets, bands) keys: a hash of each band's number and its ``rows`` slots."""
    out = np.empty((len(sig), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(sig), (b + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + sig[:, b * rows + r])
        out[:, b] = key
    return out
