"""Words of whole texts as 64-bit codes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_ODD, _ODD_TOO = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, 2, 1 << 64))
STEP, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
SEGMENT = 1 << 18  # bytes whose words are hashed at once; a word as long as that is hashed first
_BLANK = bytes(32 if 9 <= c <= 13 else c for c in range(256))
_powers: list[np.ndarray] = []


def _hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``raw``, whose only blanks are spaces."""
    if not _powers:
        for m in (STEP, _BACK):
            _powers.append(np.multiply.accumulate(np.r_[np.uint64(1), np.full(2 * SEGMENT, m, np.uint64)]))
    a = np.frombuffer(raw, np.uint8)
    word = np.zeros(len(a) + 2, bool)
    word[1:-1] = a != 32
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[::2], edges[1::2]
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(a.astype(np.uint64) * _powers[0][: len(a)], out=sums[1:])
    h = (sums[end] - sums[start]) * _powers[1][start] + (end - start).astype(np.uint64)
    return start, mixed(h)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * _ODD_TOO
    return h ^ (h >> np.uint64(32))


def _segments(raw: bytes) -> Iterator[bytes]:
    """A text cut between words; a word of a whole segment is replaced by a digest."""
    if len(raw) < SEGMENT:
        yield raw
        return
    at = 0
    while at < len(raw):
        cut = len(raw) if len(raw) - at < SEGMENT else raw.rfind(b" ", at, at + SEGMENT)
        if cut < 0:
            cut = raw.find(b" ", at)
            cut = len(raw) if cut < 0 else cut
            yield b"\x00" + xxhash.xxh64_hexdigest(raw[at:cut]).encode()
        else:
            yield raw[at:cut]
        at = cut + 1


def coded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code for each word of the texts, A-Z in lower case, and the words of each text."""
    pieces, of = [], []
    for i, text in enumerate(texts):
        if text:
            for piece in _segments(text.encode("utf-8", "surrogatepass").lower().translate(_BLANK)):
                pieces.append(piece)
                of.append(i)
    codes, sizes = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    at = 0
    while at < len(pieces):
        end, size = at, 0
        while end < len(pieces) and (end == at or size + len(pieces[end]) < SEGMENT):
            size += len(pieces[end]) + 1
            end += 1
        start, h = _hashes(b" ".join(pieces[at:end]))
        begin = np.cumsum([0] + [len(p) + 1 for p in pieces[at:end]])
        np.add.at(sizes, of[at:end], np.diff(np.searchsorted(start, begin)))
        codes.append(h)
        at = end
    return np.concatenate(codes), sizes
