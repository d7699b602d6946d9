"""64-bit hashes of the words of texts, computed on whole arrays of bytes.

Words are what lies between the six white spaces of ASCII.  Sums of byte keys
times powers of an odd base give the hash of any stretch from two prefix sums,
wherever it stands; a final mix spreads it over all bits.
"""

from __future__ import annotations

import re

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed together; a longer text is cut at white space.
BLOCK = 1 << 20

_KEYS = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_GAP = re.compile(rb"[\x09-\x0d\x20]")


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of ``x`` (the finaliser of splitmix64)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as they have been needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            full = lambda x: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)]))
            self.up, self.down = full(_U(_BASE)), full(_U(_INVERSE))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of ``values`` times the powers, with a leading zero."""
        self.reach(len(values) + 1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)])])

    def parts(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the stretches ``starts:ends``, the same wherever equal values stand."""
        return (sums[ends] - sums[starts]) * self.down[starts]


def word_table(data: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of ``data``."""
    view = np.frombuffer(data, np.uint8)
    space = np.ones(len(view) + 2, np.int8)
    space[1:-1] = _SPACE[view]
    edges = np.flatnonzero(np.diff(space))
    starts, ends = edges[0::2], edges[1::2]
    hashes = scramble(powers.parts(powers.sums(_KEYS[view]), starts, ends) + (ends - starts).astype(np.uint64))
    return hashes, starts, ends


def hashed_words(texts: list[bytes], powers: Powers) -> list[np.ndarray]:
    """The hashes of the words of each text."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0

    def finish() -> None:
        found, starts, _ = word_table(b"\n".join(group), powers)
        sizes = np.array([len(t) + 1 for t in group], np.int64)
        bounds = np.searchsorted(starts, np.cumsum(sizes)[:-1]) if len(group) > 1 else []
        out.extend(np.split(found, bounds))

    for text in texts:
        if group and held + len(text) > BLOCK:
            finish()
            group, held = [], 0
        if len(text) <= BLOCK:
            group.append(text)
            held += len(text) + 1
            continue
        parts, at = [], 0
        while at < len(text):
            gap = _GAP.search(text, at + BLOCK)
            end = gap.start() if gap else len(text)
            parts.append(word_table(text[at:end], powers)[0])
            at = end
        out.append(np.concatenate(parts))
    if group:
        finish()
    return out
