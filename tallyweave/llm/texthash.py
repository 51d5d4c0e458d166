"""Hashes of words and word shingles that are alike on every machine."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def word_hashes(words: Sequence[str]) -> np.ndarray:
    """64-bit hash of each (non-empty) word, all at once."""
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    position = (np.arange(len(codes)) - np.repeat(starts, lengths)).astype(np.uint64)
    return mixed(np.add.reduceat(mixed(codes + (position << np.uint64(24))), starts) + lengths.astype(np.uint64))


def shingle_sets(texts: Sequence[str], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of `size` lower-case words; a shorter text's words are one run."""
    tokens = [t.lower().split() for t in texts]
    ids: dict[str, int] = {}
    flat = np.array([ids.setdefault(w, len(ids)) for own in tokens for w in own], dtype=np.int64)
    hashes = word_hashes(list(ids))[flat] if len(flat) else np.zeros(0, np.uint64)
    runs = np.zeros(max(0, len(flat) - size + 1), dtype=np.uint64)
    for k in range(size):
        runs += hashes[k : len(flat) - size + 1 + k] * _ODD[k % len(_ODD)] + np.uint64(k // len(_ODD))
    runs = mixed(runs)
    out, at = [], 0
    for own in tokens:
        n = len(own)
        if n >= size:
            out.append(np.unique(runs[at : at + n - size + 1]))
        else:
            short = np.zeros(1, np.uint64)
            for k in range(n):
                short += hashes[at + k : at + k + 1] * _ODD[k % len(_ODD)]
            out.append(mixed(short + np.uint64(n)) if n else np.zeros(0, np.uint64))
        at += n
    return out
