"""Word and shingle hashes of whole texts, vectorised over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Words of a shingle.
SHINGLE = 5
#: Bytes that one vectorised pass takes, so that its working arrays stay small; a longer text is taken in parts.
PASS_BYTES = 1 << 20
#: A fixed odd multiplier, and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first bytes, ends) of the words of UTF-8 bytes. The hash of a word is a scrambled polynomial of its bytes."""
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        # words of one pass: as many as fit, one at least
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PASS_BYTES, side="right")))
        low, high = starts[first], ends[last - 1]
        up, down = _powers(max(PASS_BYTES, int(high - low)) + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out, starts, ends


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the windows of `size` words; with fewer words, of all of them as one; none without words."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(size, len(words))):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mixed(out + np.uint64(min(size, len(words))))


def many(texts: Sequence[bytes | None]) -> list[np.ndarray]:
    """Word hashes of each text, in order."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not group:
            return
        data = np.frombuffer(b"\n".join(group) + b"\n", dtype=np.uint8)
        hashes, starts, _ = word_hashes(data)
        ends = np.cumsum([len(t) + 1 for t in group])
        cut = np.searchsorted(starts, ends)
        out.extend(np.split(hashes, cut[:-1]))
        group.clear()
        size = 0

    for t in texts:
        group.append(t or b"")
        size += len(group[-1])
        if size >= PASS_BYTES:
            flush()
    flush()
    return out
