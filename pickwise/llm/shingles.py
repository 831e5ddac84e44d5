"""Shingle sets and minwise signatures of texts, as NumPy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd 64-bit constants of the mixing steps below (fixed values).
MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX2
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, width: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles. A-Z are lower-cased and
    words are what ASCII white space separates; fewer words than ``width`` make one
    shingle of the whole sequence; no word, no shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\n".join(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    out = hashes[:n].copy()
    for k in range(1, width):
        out = _mix(out * MIX1 + hashes[k:n + k])
    return np.unique(out)


def minwise_tokens(sets: list[np.ndarray], functions: np.ndarray) -> np.ndarray:
    """Row by row the minwise token of each non-empty set under each hash function (odd multipliers), as uint32."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.empty((len(sets), len(functions)), np.uint32)
    for k, f in enumerate(functions):
        h = flat * f
        h ^= h >> np.uint64(31)
        h *= MIX2
        out[:, k] = np.minimum.reduceat(h >> np.uint64(32), starts).astype(np.uint32)
    return out


def hash_functions(n: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
