"""Counting quotient filters of packed word-id n-grams, without loss.

An n-gram is packed into one to three limbs of ``width`` bits.  An invertible permutation of
the limbs spreads the n-grams evenly; its leading bits are the quotient, everything else is the
remainder, kept in full, so that equal entries are equal n-grams and every n-gram can be read
back.  A filter holds its entries in the order of quotient and remainder:

* ``unary``: for each quotient as many ones as it has entries, then a zero;
* ``rests``: the remainders, in whole bytes;
* ``counts``: seven bits to a byte, the eighth says that more follow.

With about one entry for each quotient an entry takes two bits, its remainder and one byte.
Filters of one range of quotients (a shard) are merged by merging their entries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64

# Odd multipliers of the permutation; any odd numbers of 64 bits will do.
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]


@dataclass(frozen=True)
class Code:
    """How ``words`` ids of ``bits`` bits are packed."""

    words: int
    bits: int

    @property
    def limbs(self) -> int:
        return -(-self.words // (64 // self.bits))

    @property
    def per_limb(self) -> int:
        return -(-self.words // self.limbs)

    @property
    def width(self) -> int:
        return self.per_limb * self.bits

    @property
    def _mask(self) -> U:
        return U((1 << self.width) - 1)

    def pack(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """One array for each word of the n-grams, to permuted limbs."""
        limbs = []
        for j in range(0, self.words, self.per_limb):
            limb = ids[j].astype(U)
            for i, more in enumerate(ids[j + 1 : j + self.per_limb], 1):
                limb = limb | more.astype(U) << U(i * self.bits)
            limbs.append(limb)
        limbs = [self._mix(x) for x in limbs]
        for i, x in enumerate(limbs[1:]):
            limbs[0] = limbs[0] ^ self._mix(x ^ U(i))
        return [self._mix(limbs[0]), *limbs[1:]]

    def unpack(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs = [self._unmix(limbs[0]), *limbs[1:]]
        for i, x in enumerate(limbs[1:]):
            limbs[0] = limbs[0] ^ self._mix(x ^ U(i))
        limbs = [self._unmix(x) for x in limbs]
        one = U((1 << self.bits) - 1)
        return [limbs[w // self.per_limb] >> U(w % self.per_limb * self.bits) & one for w in range(self.words)]

    def _mix(self, x: np.ndarray) -> np.ndarray:
        half, mask = U((self.width + 1) // 2), self._mask
        for odd in _ODD:
            x = (x ^ x >> half) * U(odd) & mask
        return x ^ x >> half

    def _unmix(self, x: np.ndarray) -> np.ndarray:
        half, mask = U((self.width + 1) // 2), self._mask  # twice the shift is the whole width
        for odd in reversed(_ODD):
            x = (x ^ x >> half) * U(pow(odd, -1, 1 << 64)) & mask
        return x ^ x >> half


def combine(limbs: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries in order, equal ones added up."""
    if not len(counts):
        return limbs, counts
    order = np.lexsort(limbs[::-1]) if len(limbs) > 1 else np.argsort(limbs[0], kind="stable")
    limbs, counts = [x[order] for x in limbs], counts[order]
    new = np.zeros(len(counts), bool)
    new[0] = True
    for x in limbs:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return [x[first] for x in limbs], np.add.reduceat(counts, first)


def merge(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    limbs = [np.concatenate(x) for x in zip(*(limbs for limbs, _ in parts))]
    return combine(limbs, np.concatenate([counts for _, counts in parts]))


def _low_bytes(x: np.ndarray, bits: int) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)]


def _numbers(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, : raw.shape[1]] = raw
    return out.view("<u8").ravel().astype(U)


def varints(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, seven bits to a byte."""
    left = values.astype(U)
    if not len(left):
        return b""
    size = np.ones(len(left), np.int64)
    for at in range(7, 64, 7):
        size += left >> U(at) > 0
    start = np.cumsum(size) - size
    packed = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max())):
        own = size > k
        more = (size[own] > k + 1).astype(np.uint8) << 7
        packed[start[own] + k] = (left[own] >> U(7 * k) & U(127)).astype(np.uint8) | more
    return packed.tobytes()


def from_varints(raw: bytes) -> np.ndarray:
    packed = np.frombuffer(raw, np.uint8)
    if not len(packed):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(packed < 128)
    start = np.r_[0, ends[:-1] + 1]
    shift = np.arange(len(packed)) - np.repeat(start, ends - start + 1)
    values = (packed & 127).astype(U) << (7 * shift).astype(U)
    return np.add.reduceat(values, start).astype(np.int64)


def write(code: Code, limbs: list[np.ndarray], counts: np.ndarray, skip: int) -> tuple[int, bytes, bytes, bytes]:
    """Filter of entries in order whose ``skip`` leading bits agree: quotient bits, unary, rests, counts."""
    quotient_bits = min(code.width - skip, (len(counts) - 1).bit_length())
    rest_bits = code.width - skip - quotient_bits
    rest = limbs[0] & U((1 << rest_bits) - 1)
    quotient = (limbs[0] >> U(rest_bits) if rest_bits < 64 else np.zeros_like(rest)) & U((1 << quotient_bits) - 1)
    unary = np.zeros((1 << quotient_bits) + len(counts), np.uint8)
    unary[quotient.astype(np.int64) + np.arange(len(counts))] = 1
    rests = np.hstack([_low_bytes(rest, rest_bits), *[_low_bytes(x, code.width) for x in limbs[1:]]])
    return quotient_bits, np.packbits(unary).tobytes(), rests.tobytes(), varints(counts)


def read(
    code: Code, shard: int, skip: int, quotient_bits: int, unary: bytes, rests: bytes, counts: bytes
) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries of a filter of :func:`write`; ``shard`` are the leading bits that it left out."""
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))
    n = len(ones)
    quotient = (ones - np.arange(n)).astype(U)
    rest_bits = code.width - skip - quotient_bits
    rest_bytes, limb_bytes = -(-rest_bits // 8), -(-code.width // 8)
    raw = np.frombuffer(rests, np.uint8).reshape(n, rest_bytes + limb_bytes * (code.limbs - 1))
    first = _numbers(raw[:, :rest_bytes])
    if rest_bits < 64:
        first = first | quotient << U(rest_bits)
    if skip:
        first = first | U(shard << (code.width - skip))
    limbs = [first]
    for at in range(rest_bytes, raw.shape[1], limb_bytes):
        limbs.append(_numbers(raw[:, at : at + limb_bytes]))
    return limbs, from_varints(counts)
