"""Word shingles of whole texts as 64-bit hashes, with numpy over batches.

Words are the maximal runs of bytes other than space, tab, line feed,
vertical tab, form feed and carriage return of the UTF-8 text, with A-Z
lower-cased. A text with fewer words than a shingle takes has one shingle,
its whole word sequence; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from tidewater.llm.common import ship_by_value

_CHUNK = 1 << 20   # bytes hashed together; a longer text is a chunk of its own
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every word of ``data`` (which ends with white space)."""
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_LOWER[raw] + np.uint64(1)) * _powers(_B, len(raw)), out=total[1:])
    h = (total[end] - total[start]) * _powers(_B_INV, len(raw))[start]
    return start, _mix(h + (end - start).astype(np.uint64))


def _chunk_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    start, word = _word_hashes(b"\n".join(texts) + b"\n")
    first = np.searchsorted(start, bounds)          # first word of each text
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), counts)
    h = np.zeros(0, np.uint64)
    owner = np.zeros(0, np.int64)
    if len(word) >= k:
        m = len(word) - k + 1
        h = word[:m].copy()
        for i in range(1, k):
            h = _mix(h * _B + word[i:m + i])
        whole = doc[:m] == doc[k - 1:]
        h, owner = h[whole], doc[:m][whole]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    at = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = [h[a:b] for a, b in zip(at[:-1], at[1:])]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        v = word[first[i]:first[i] + 1].copy()
        for w in word[first[i] + 1:first[i + 1]]:
            v = _mix(v * _B + w)
        out[i] = v + np.uint64(counts[i])           # apart from k-word shingles
    return out


def shingle_sets(texts: Sequence[str | None], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text, in order."""
    group: list[bytes] = []
    size = 0
    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass")
        if group and size + len(b) > _CHUNK:
            yield from _chunk_sets(group, k)
            group, size = [], 0
        group.append(b)
        size += len(b) + 1
    if group:
        yield from _chunk_sets(group, k)


ship_by_value(__name__)
