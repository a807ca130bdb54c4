"""Bit-sliced Hamming distances: planes of bits, carry-save counters, early abandoning."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
STEP = 15  # planes between two looks at which blocks are beyond the radius
LANES = 64


def planes(fingerprints: np.ndarray) -> np.ndarray:
    """(n, words) uint64 to (64 * words, ceil(n / 64)): bit i of all fingerprints side by side."""
    n = len(fingerprints)
    bits = np.unpackbits(np.ascontiguousarray(fingerprints).view(np.uint8).reshape(n, -1), axis=1, bitorder="little")
    wide = np.zeros((bits.shape[1], -(-n // LANES) * LANES), np.uint8)
    wide[:, :n] = bits.T
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def lanes(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and lane of each bit set."""
    return np.nonzero(np.unpackbits(np.ascontiguousarray(mask).view(np.uint8).reshape(len(mask), 8), axis=1, bitorder="little"))


def _add(levels: list[np.ndarray], at: int, bits: np.ndarray) -> np.ndarray:
    """Adds ``bits`` to the counters at weight 2**at; the carry beyond the highest level comes back."""
    for k in range(at, len(levels)):
        carry = levels[k] & bits
        levels[k] = levels[k] ^ bits
        bits = carry
    return bits


def _beyond(levels: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above ``radius``."""
    above, same = np.zeros_like(levels[0]), np.full_like(levels[0], ALL)
    for k in reversed(range(len(levels))):
        if radius >> k & 1:
            same = same & levels[k]
        else:
            above = above | (same & levels[k])
            same = same & ~levels[k]
    return above


def within(differ: Callable[[int, np.ndarray], np.ndarray], valid: np.ndarray, count: int, radius: int):
    """Lanes at distance ``radius`` or less.

    ``differ(i, blocks)`` gives plane i of the differences for some blocks of 64 lanes.
    Planes are added three at a time (carry-save: sum and carry), and a block is left as
    soon as all its lanes are beyond the radius.  Returns blocks and their masks of near lanes.
    """
    blocks = np.flatnonzero(valid)
    over = ~valid[blocks]
    levels = [np.zeros(len(blocks), np.uint64) for _ in range(max(2, (radius + 1).bit_length()))]
    dead = over
    for start in range(0, count, STEP):
        stop = min(start + STEP, count)
        for i in range(start, stop, 3):
            three = [differ(j, blocks) for j in range(i, min(i + 3, stop))]
            if len(three) == 3:
                x, y, z = three
                half = x ^ y
                over = over | _add(levels, 0, half ^ z) | _add(levels, 1, (x & y) | (half & z))
            else:
                for x in three:
                    over = over | _add(levels, 0, x)
        dead = over | _beyond(levels, radius)
        keep = dead != ALL
        if not keep.all():
            blocks, over, dead = blocks[keep], over[keep], dead[keep]
            levels = [level[keep] for level in levels]
            if not len(blocks):
                break
    return blocks, ~dead


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a and b; ``label`` holds each element's smallest member."""
    while True:
        a, b = label[a], label[b]
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, shorter := label[label]):
            label[:] = shorter


def link_neighbours(fingerprints: np.ndarray, group: np.ndarray, largest: int, radius: int, label: np.ndarray) -> None:
    """Unites near rows inside groups of at most ``largest`` rows; groups stand together.

    All groups are compared at once: the rows are laid against themselves shifted by 1, 2,
    ... places, and a lane counts where both rows are of one group.
    """
    n, bits = len(group), planes(fingerprints)
    for lag in range(1, largest):
        same = np.zeros(-(-n // LANES) * LANES, np.uint8)
        same[: n - lag] = group[:-lag] == group[lag:]
        valid = np.packbits(same, bitorder="little").view(np.uint64)
        if not valid.any():
            return
        skip, shift = divmod(lag, LANES)

        def differ(i: int, blocks: np.ndarray, skip=skip, shift=shift) -> np.ndarray:
            plane = np.concatenate([bits[i], np.zeros(skip + 2, np.uint64)])
            moved = plane[blocks + skip]
            if shift:
                moved = (moved >> np.uint64(shift)) | (plane[blocks + skip + 1] << np.uint64(LANES - shift))
            return plane[blocks] ^ moved

        blocks, near = within(differ, valid, len(bits), radius)
        word, lane = lanes(near)
        row = blocks[word] * LANES + lane
        unite(label, row, row + lag)


def link_blocks(queries: np.ndarray, rows: np.ndarray, fingerprints: np.ndarray, radius: int, label: np.ndarray) -> None:
    """Unites each of ``queries`` with the near ones of ``rows`` (both index ``fingerprints``).

    Blocks whose lanes are all in the query's set already are not looked at again.
    """
    bits = planes(fingerprints[rows])
    width, padded = bits.shape[1], np.concatenate([rows, np.repeat(rows[-1:], -len(rows) % LANES)])
    held = np.packbits(np.arange(len(padded)) < len(rows), bitorder="little").view(np.uint64)
    own = np.where(np.unpackbits(np.ascontiguousarray(fingerprints[queries]).view(np.uint8).reshape(len(queries), -1), axis=1, bitorder="little").T, ALL, np.uint64(0))
    start, slab = 0, 16
    while start < len(queries):
        some = queries[start : start + slab]
        sets = label[padded].reshape(width, LANES)
        uniform = np.where((sets == sets[:, :1]).all(axis=1), sets[:, 0], -1)
        q, w = np.nonzero(label[some][:, None] != uniform[None, :])
        if len(q):
            mine = own[:, start : start + slab]
            blocks, near = within(lambda i, at: bits[i][w[at]] ^ mine[i][q[at]], held[w], len(bits), radius)
            word, lane = lanes(near)
            unite(label, some[q[blocks[word]]], padded[w[blocks[word]] * LANES + lane])
        start, slab = start + slab, min(max(16, 32768 // width), 2 * slab)
