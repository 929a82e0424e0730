"""Fingerprints of all words of many texts at once, with numpy."""

from functools import lru_cache

import numpy as np

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit fingerprint of each word (bytes between white space, A-Z lower-cased) of all texts in
    order, and the bounds of each text among them."""
    raw = [(t or "").encode().lower() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    size = 1 << max(16, int(len(data) - 1).bit_length())
    up, down = (p[: len(data)] for p in _powers(size))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _BLANK[data])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTES[data] * up)))
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)) if len(starts) else np.empty(0, np.uint64)
    after = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return words, np.searchsorted(starts, after)
