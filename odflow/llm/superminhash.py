"""SuperMinHash signatures of sets of 64-bit hashes, vectorised over all elements of a slab.

Every element has its own random order of the signature's places, and in step j puts the value
j + (a number in 0..1) at its j-th place; a place keeps the smallest value. The ranks of one element are
those of a permutation, so no place gets two equal ranks from it, which makes estimates vary less than
with independent hashes. After step j all values below j + 1 are final: a set whose places are all filled with
such values stops there, which long sets do after the first steps.
"""

from __future__ import annotations

import numpy as np

from odflow.llm.textarrays import mix

_ODD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)


def _draws(elements: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Per element 32 random bits for the value, and 32 for the place."""
    bits = mix(elements + np.array([step + 1], dtype=np.uint64) * _ODD)
    return bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)


def signatures(elements: np.ndarray, bounds: np.ndarray, places: int) -> np.ndarray:
    """One row of ``places`` values per set (64 bits: step, then 32 random bits); sets are distinct hashes in
    elements[bounds[i]:bounds[i + 1]]. Empty sets have the largest value everywhere."""
    n = len(bounds) - 1
    out = np.full(n * places, _EMPTY, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    live, perm = elements, None
    for step in range(places):
        if not len(live):
            break
        value, at = _draws(live, step)
        pick = step + ((at * np.uint64(places - step)) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            place = pick
        else:
            if perm is None:  # places swapped so far: only step 0 happened
                perm = np.broadcast_to(np.arange(places, dtype=np.uint16), (len(live), places)).copy()
                rows = np.arange(len(live))
                _, before = _draws(live, 0)
                first = ((before * np.uint64(places)) >> np.uint64(32)).astype(np.int64)
                perm[rows, first] = 0
                perm[:, 0] = first
            rows = np.arange(len(live))
            place = perm[rows, pick].astype(np.int64)
            perm[rows, pick] = perm[:, step]
            perm[:, step] = place
        np.minimum.at(out, owner * places + place, (np.uint64(step) << np.uint64(32)) | value)
        done = out.reshape(n, places).max(axis=1) < (np.uint64(step + 1) << np.uint64(32))
        keep = ~done[owner]
        if not keep.all():
            live, owner = live[keep], owner[keep]
            if perm is not None:
                perm = perm[keep]
    return out.reshape(n, places)
