"""Word shingles and HyperMinHash sketches with numpy.

Words are runs of non-space bytes, A-Z lowered. A word's hash is a polynomial
over the bytes (a random number per byte value), read off running sums, so a
batch of texts is hashed without a loop over words.
"""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
REGISTERS = 128
MANTISSA_BITS = 10
# a band is this many registers; with 42 of them, sets with similarity 0.75 share
# none with a chance of (1 - 0.75 ** 3) ** 42 = 1e-10
BAND = 3
BANDS = REGISTERS // BAND

_RANDOM = np.random.RandomState(20240601)


def _odd(n: int) -> np.ndarray:
    return (_RANDOM.randint(0, 1 << 62, n, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


_BYTE = _odd(256)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = int(_odd(1)[0])
_PLACE = _odd(WORDS)
_SHORT = _odd(WORDS)
_BAND_PLACE = _odd(REGISTERS)
# each register's order of the others to borrow from when it is empty
_BORROW = np.stack([_RANDOM.permutation(REGISTERS) for _ in range(REGISTERS)])
# bytes hashed at once (a longer word is hashed whole)
_SLICE = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of 64-bit ``h``."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int):
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps))
        return cls.up[:n], cls.down[:n]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of ``raw``."""
    buffer = np.frombuffer(raw, np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(buffer):
        end = min(len(buffer), at + _SLICE)
        while end < len(buffer):  # cut at a space
            spaces = np.flatnonzero(_SPACE[buffer[end:end + 4096]])
            if len(spaces):
                end += int(spaces[0])
                break
            end = min(len(buffer), end + 4096)
        part = buffer[at:end]
        inside = np.concatenate([[False], ~_SPACE[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[0::2], edges[1::2]
        up, down = _Powers.get(len(part) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * up[:len(part)])])
        h = (sums[last] - sums[first]) * down[first]
        hashes.append(mixed(h + (last - first).astype(np.uint64)))
        starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Per text its distinct shingles, sorted: hashes of five words in a row, of
    all words if there are fewer, none without words."""
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    words, starts = word_hashes(b"\n".join(texts) + b"\n")
    cut = np.searchsorted(starts, bounds)
    out: list[np.ndarray] = []
    n = len(words) - WORDS + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for j in range(WORDS):
        if n > 0:
            rolled += words[j:j + n] * _PLACE[j]
    rolled = mixed(rolled)
    for low, high in zip(cut[:-1], cut[1:]):
        k = high - low
        if k >= WORDS:
            out.append(np.unique(rolled[low:high - WORDS + 1]))
        elif k:
            whole = (words[low:high] * _PLACE[:k]).sum(dtype=np.uint64, keepdims=True)
            out.append(mixed(whole + _SHORT[k:k + 1]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(shingles: np.ndarray) -> bytes:
    """16 bytes that stand for the set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketch(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a non-empty set, 16 bits each.

    A hash's first 7 bits choose the register; of the least rest in a register
    the count of leading zeros (6 bits) and the bits after the first one (10
    bits) are stored. An empty register takes over the first filled register in
    its own random order, so small sets have a full sketch too.
    """
    h = np.sort(mixed(shingles ^ np.uint64(0x9E3779B97F4A7C15)))
    register = (h >> np.uint64(57)).astype(np.int64)
    filled, at = np.unique(register, return_index=True)
    rest = (h[at] >> np.uint64(8)) & np.uint64((1 << 49) - 1)
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    top = rest << (49 - length).astype(np.uint64)
    mantissa = (top >> np.uint64(48 - MANTISSA_BITS)) & np.uint64((1 << MANTISSA_BITS) - 1)
    values = np.zeros(REGISTERS, np.uint16)
    has = np.zeros(REGISTERS, bool)
    values[filled] = (((49 - length).astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    has[filled] = True
    if len(filled) < REGISTERS:
        empty = np.flatnonzero(~has)
        order = _BORROW[empty]
        values[empty] = values[order[np.arange(len(empty)), has[order].argmax(axis=1)]]
    return values


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys: a hash of the band's number and registers."""
    used = sketches[:, :BANDS * BAND].astype(np.uint64).reshape(len(sketches), BANDS, BAND)
    places = _BAND_PLACE[:BANDS * BAND].reshape(BANDS, BAND)
    return mixed((mixed(used + np.uint64(1)) * places).sum(axis=2, dtype=np.uint64)).view(np.int64)


def chance_match(n: np.ndarray | float) -> np.ndarray:
    """Chance that a register of two disjoint sets of ``n`` shingles agrees: both
    minima have the same leading zeros (their share of the shingles decides) and
    the same stored bits."""
    share = np.maximum(np.asarray(n, np.float64) / REGISTERS, 1.0)[..., None]
    zeros = np.arange(50)
    at_least = 1 - (1 - 2.0 ** -zeros) ** share
    exactly = at_least[..., :-1] - at_least[..., 1:]
    return (exactly ** 2).sum(axis=-1) / (1 << MANTISSA_BITS)


def similarity(pivot: np.ndarray, others: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of a sketch against others; ``n``:
    shingles of the larger set of each pair."""
    same = (others == pivot).mean(axis=1)
    chance = chance_match(n)
    return (same - chance) / (1 - chance)
