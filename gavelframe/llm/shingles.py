"""Hashed word shingles of many texts at once, inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on each other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words between ASCII white space, A-Z lower-cased, and the bounds of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets -= offsets[0]
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    real = np.array([w != "" for w in words], bool)
    codes = coded.indices.to_numpy()
    keep = real[codes]
    bounds = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return hashes[codes[keep]], bounds


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words is one shingle, one without words none."""
    words, bounds = word_hashes(texts)
    rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        rolled = rolled * _STEP + words[j : j + len(rolled)]
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    whole = whole * _STEP + w
            out.append(mix(np.array([whole])))
        else:
            out.append(np.empty(0, np.uint64))
    return out
