"""Sets of hashed word shingles, in numpy.

Words are hashed all at once: every letter is mixed with its place in the word to 64 bits, and the hash of a word is the sum of
these, which is a difference of running sums. Word hashes are mixed into shingles.
"""

from __future__ import annotations

import hashlib

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes hashed at once; a longer word is still hashed whole.
CHUNK = 1 << 18


def _scattered(x: np.ndarray) -> np.ndarray:
    """Every 64-bit number to another one, each bit depending on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> _SHIFT)


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each of the runs codes[starts:ends] (ascending, apart from each other)."""
    size = ends - starts
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    letters = codes[np.repeat(starts, size) + inside].astype(np.uint64)
    sums = np.zeros(len(inside) + 1, np.uint64)
    np.cumsum(_scattered((inside.astype(np.uint64) << np.uint64(24) | letters) * _MIX + _MIX), out=sums[1:])
    edges = np.concatenate([[0], np.cumsum(size)])
    return _scattered((sums[edges[1:]] - sums[edges[:-1]]) ^ size.astype(np.uint64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word between ASCII white space."""
    raw = np.frombuffer(data, np.uint8)
    starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    at = 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        if end < len(raw):
            space = np.flatnonzero(_SPACE[raw[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
            else:
                while end < len(raw):
                    space = np.flatnonzero(_SPACE[raw[end:end + CHUNK]])
                    if len(space):
                        end += int(space[0]) + 1
                        break
                    end = min(end + CHUNK, len(raw))
        part = raw[at:end]
        inside = np.concatenate([[False], ~_SPACE[part], [False]])
        first = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        last = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        h = run_hashes(part, first, last)
        starts.append(first + at)
        hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[str], size: int = 4) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes; A-Z count as lower case.

    A text of fewer words than a shingle has its whole sequence as the only one; without words there is none.
    """
    out: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0
    for text in texts:
        group.append(text.encode("utf-8", "surrogatepass"))
        held += len(group[-1])
        if held > 4 * CHUNK:
            out += _sets(group, size)
            group, held = [], 0
    return out + _sets(group, size)


def _sets(group: list[bytes], size: int) -> list[np.ndarray]:
    starts, h = word_hashes(b"\n".join(group).lower())
    ends = np.cumsum([len(x) + 1 for x in group])
    upto = np.searchsorted(starts, ends)
    whole = _mixed(h, size)
    out, at = [], 0
    for end in upto.tolist():
        n = end - at
        s = np.sort(whole[at:end - size + 1] if n >= size else _mixed(h[at:end], n) if n else whole[:0])
        if len(s) > 1:
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        out.append(s)
        at = end
    return out


def _mixed(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    n = max(0, len(h) - size + 1)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k:n + k]) * _MIX
        out ^= out >> _SHIFT
    return out


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.astype("<u8").tobytes(), usedforsecurity=False).digest()


def bucket(shingles: np.ndarray, bits: int) -> np.ndarray:
    """The counter a shingle falls on."""
    return ((shingles * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int64)


def parity_bits(shingles: np.ndarray) -> bytes:
    """Parity of the items that fall on each of at least as many bits as there are items (a power of two, 64 or more).

    Two sets differ in at least as many items as their parities differ in bits. The halves of a bitmap xor to that of half
    the size, so sets of different sizes can be compared.
    """
    size = max(64, 1 << max(0, len(shingles) - 1).bit_length())
    at = (shingles & np.uint64(size - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=size) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()
