"""Simple-8b: a selector in the top four bits of a 64-bit word tells how many numbers of how many bits the other sixty hold.

Numbers are coded in blocks. A block chooses the largest width it packs; wider numbers are escapes: a zero is packed in their
place, and position and value follow the words. All blocks of a call are coded at once, word by word side by side, and a block
is decoded selector by selector.
"""

from __future__ import annotations

import struct

import numpy as np

#: Numbers per word and bits per number of each selector. Fixed values of the published code.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BLOCK = 4096
HEAD = struct.Struct("<III")  # numbers, words, escapes
_ESCAPE = 10  # bytes: two of position, eight of value


_SMALL = np.array([k.bit_length() for k in range(1 << 16)], np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each number, 0 for zero."""
    if values.max(initial=0) < 1 << 16:
        return _SMALL[values]
    out = np.zeros(values.shape, np.uint8)
    rest = values.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        big = rest >> np.uint64(shift) > 0
        out[big] += shift
        rest = np.where(big, rest >> np.uint64(shift), rest)
    return out + (values > 0).astype(np.uint8)


def _selectors(width: np.ndarray) -> np.ndarray:
    """For every place of every row the selector that packs most numbers from there. width: padded by 240 zeros."""
    n = width.shape[1] - 240
    most = {1: width}
    for k in (2, 4, 8, 16, 32, 64, 128):
        half = most[k // 2]
        most[k] = np.maximum(half[:, :half.shape[1] - k // 2], half[:, k // 2:])

    def highest(count: int) -> np.ndarray:
        k = 1 << (count.bit_length() - 1)
        own = most[k]
        return np.maximum(own[:, :n], own[:, count - k:count - k + n])

    out = np.full((width.shape[0], n), 15, np.uint8)
    for s in range(14, -1, -1):
        fits = highest(int(COUNTS[s])) <= BITS[s]
        if s >= 8 or fits.any():
            out[fits] = s
    return out


def encode_blocks(values: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """The blocks of numbers below 2**64, each with its head."""
    n = len(values)
    if not n:
        return []
    rows = -(-n // block)
    grid = np.zeros((rows, block + 240), np.uint64)
    grid[:, :block].flat[:n] = values if n == rows * block else np.concatenate([values, np.zeros(rows * block - n, values.dtype)])
    size = np.full(rows, block)
    size[-1] = n - (rows - 1) * block
    width = _widths(grid)
    # The width above which a block escapes: fewest bytes by the room that numbers of each width need on their own.
    allowed = np.array([7, 8, 10, 12, 15, 20, 30, 60])
    each = 8 / COUNTS[np.searchsorted(BITS, allowed)]
    seen = np.bincount((np.arange(rows)[:, None] * 65 + width[:, :block]).ravel(), minlength=rows * 65).reshape(rows, 65)
    shares = np.cumsum(seen, axis=1)[:, allowed]
    steps = np.diff(np.concatenate([np.zeros((rows, 1)), shares], axis=1), axis=1)
    cost = np.cumsum(steps * each, axis=1) + (block - shares) * (_ESCAPE + each)
    limit = allowed[cost.argmin(axis=1)]
    escaped = width > limit[:, None]
    some = escaped.any()
    flat = (np.where(escaped, np.uint64(0), grid) if some else grid).ravel()
    select = _selectors(np.where(escaped, 0, width).astype(np.uint8) if some else width)
    at = np.zeros(rows, np.int64)
    live = np.arange(rows)
    who, where, which = [], [], []
    while len(live):
        s = select[live, at[live]]
        who.append(live)
        where.append(at[live])
        which.append(s)
        at[live] += COUNTS[s]
        live = live[at[live] < size[live]]
    who, where, which = np.concatenate(who), np.concatenate(where), np.concatenate(which)
    order = np.argsort(who * block + where)
    who, where, which = who[order], where[order], which[order]
    words = which.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        k = np.flatnonzero(which == s)
        if len(k):
            base = who[k] * grid.shape[1] + where[k]
            own = words[k]
            for j in range(COUNTS[s]):
                own |= flat[base + j] << np.uint64(BITS[s] * j)
            words[k] = own
    ends = np.searchsorted(who, np.arange(rows), side="right")
    out, begin = [], 0
    for r in range(rows):
        extra = np.flatnonzero(escaped[r, :size[r]])
        out.append(HEAD.pack(int(size[r]), int(ends[r] - begin), len(extra)) + words[begin:ends[r]].astype("<u8").tobytes()
                   + extra.astype("<u2").tobytes() + grid[r, extra].astype("<u8").tobytes())
        begin = int(ends[r])
    return out


def decode_block(data: bytes, at: int = 0) -> np.ndarray:
    """The numbers of the block that begins at a byte."""
    n, n_words, n_extra = HEAD.unpack_from(data, at)
    at += HEAD.size
    words = np.frombuffer(data, "<u8", n_words, at)
    which = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[which]
    begin = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) if n_words else 0, np.uint64)
    for s in np.unique(which).tolist():
        if s < 2:
            continue
        k = np.flatnonzero(which == s)
        mask, own, to = np.uint64((1 << int(BITS[s])) - 1), words[k], begin[k]
        for j in range(COUNTS[s]):
            out[to + j] = (own >> np.uint64(BITS[s] * j)) & mask
    out = out[:n]
    at += 8 * n_words
    if n_extra:
        out[np.frombuffer(data, "<u2", n_extra, at)] = np.frombuffer(data, "<u8", n_extra, at + 2 * n_extra)
    return out
