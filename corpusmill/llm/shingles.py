"""Words of a text, hashes of their shingles, and the fingerprint of such hashes.

Words are runs without ASCII white space, A-Z in lower case; a text with fewer words than a shingle
has one shingle, all its words.
"""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
SEED = 42


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWER).split()


def shingle_hashes(words: list[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of ``hashes``, as a signed number."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low : low + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])
