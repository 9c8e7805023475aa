"""Words of many texts at once, as arrays over their UTF-8 bytes, and rolling hashes of them."""

from __future__ import annotations

import numpy as np

# White space as the contracts of word operators define it: space and 0x09 to 0x0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
# Everything in ASCII that is neither letter nor digit; bytes of other characters belong to words.
PUNCTUATION = np.array([value < 128 and not chr(value).isalnum() for value in range(256)])

_MULTIPLIER = 0x9E3779B97F4A7C15
# A fixed random value for each byte.
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values over all places."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def split_words(
    flat: np.ndarray, offsets: np.ndarray, separator: np.ndarray, breaks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n + 1 offsets of the texts among the words.

    A word also ends at each byte in `breaks`, where another may begin.
    """
    inside = ~separator[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[offsets] = True
    if breaks is not None:
        edge[breaks] = True
    before = np.r_[False, inside[:-1]] & ~edge[:-1]
    after = np.r_[inside[1:], False] & ~edge[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class RollingHash:
    """Hashes of any stretch of a sequence from prefix sums; equal stretches have equal hashes.

    The hash of values v_0 .. v_n-1 is the sum of v_i * B^i modulo 2^64, with random 64-bit values.
    """

    def __init__(self, values: np.ndarray, multiplier: int = _MULTIPLIER) -> None:
        step, size = np.uint64((multiplier | 1) & ((1 << 64) - 1)), len(values) + 1
        self.inverse = np.cumprod(
            np.full(size, pow(int(step), -1, 1 << 64), np.uint64), dtype=np.uint64
        )
        powers = np.cumprod(np.full(len(values), step, np.uint64), dtype=np.uint64)
        self.sums = np.zeros(size, np.uint64)
        np.cumsum(values * powers, out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def every(self, length: int) -> np.ndarray:
        """The stretch of `length` from each place on."""
        count = max(0, len(self.sums) - length)
        return mixed((self.sums[length : length + count] - self.sums[:count]) * self.inverse[:count])


def byte_values(flat: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[flat]


def word_hashes(
    flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, multiplier: int = _MULTIPLIER
) -> np.ndarray:
    return RollingHash(byte_values(flat), multiplier)(starts, ends)


def lowered(flat: np.ndarray) -> np.ndarray:
    """A to Z in lower case."""
    return np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
