"""Gumbel top-k sampling of segmentations without replacement, over the lattices of a SentencePiece model.

A text is normalized by the model and cut into units over which no piece reaches: white-space marks with the word that follows, and
runs of those punctuation marks that the vocabulary never joins with other characters. Each
distinct unit gets a lattice of all pieces that match, and the backward sums that turn piece weights into conditional
probabilities. The segmentations of the text are the leaves of a tree whose nodes are beginnings. A node's key is the
highest Gumbel-perturbed log-probability of its leaves; best-first search by this key, an upper bound that the best child
attains, is A* sampling: the first leaf reached is a sample, and the next ones are samples without replacement, in order.

The search goes down from the best open node to a leaf for all texts of a batch at once; units advance side by side. At a node
the child that attains the node's key is drawn by its probability. The other children together are one open node, whose key is a
Gumbel draw by their total probability, cut off at the key of the node; which of them it is, is drawn only when it becomes the best.
Each text keeps as many open nodes as it can still emit. Noise is a hash of the row's seed, the sample, the unit and the place, so
results depend on nothing else.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import sentencepiece

MARK = "▁"
PUNCTUATION = set(".,;:!?\"'()[]{}#$%&*+/<=>@^_`|~-\\")
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Units drawn at once.
SECTION = 60_000
#: Characters at the end of a unit whose nodes are shared with other units.
SHARED = 5
#: Bits of a hash by which it is looked up.
JUMP = 18


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def uniform(keys: np.ndarray) -> np.ndarray:
    """A draw from (0, 1) per key."""
    return ((mixed(keys) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def depths(location, keys: np.ndarray) -> np.ndarray:
    """A Gumbel draw per key at a location, with its sign turned."""
    x = uniform(keys)
    np.log(x, out=x)
    np.negative(x, out=x)
    np.log(x, out=x)
    x -= location
    return x


def below(bound, depth) -> np.ndarray:
    """The draws of `depths`, given that they are below a bound. Their order does not change."""
    return -np.logaddexp(-bound, depth)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


class Vocabulary:
    """The pieces of a model with their weights.

    A unigram model's scores are log-probabilities. A BPE model's are ranks; their weight is -log(2 + rank), Zipf's law.
    """

    def __init__(self, path: str, temperature: float = 1.0):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        ids = [k for k in range(m.get_piece_size()) if not (m.is_control(k) or m.is_unknown(k) or m.is_byte(k) or m.is_unused(k))]
        scores = np.array([m.get_score(k) for k in ids])
        whole = not np.mod(scores, 1).any()
        weights = (-np.log(2 + np.maximum(0, -scores)) if whole else scores) / temperature
        self.byte_weight = (float(weights.min()) - 1.0) if len(ids) else -1.0
        self.bytes = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(k == m.unk_id() for k in self.bytes):
            self.bytes = None
        pieces = [m.id_to_piece(k) for k in ids]
        self.longest = max(map(len, pieces), default=1)
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model reach over words")
        self.ids, self.weights = np.array(ids), weights
        mixing = {c for p in pieces for c in p if any(x != MARK and (x in PUNCTUATION) != (c in PUNCTUATION) for x in p)}
        alone = "".join(re.escape(c) for c in PUNCTUATION if c not in mixing)
        self.unit = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}*[{alone}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+")
        # Texts without these are cut at their marks only.
        self.cuts = [" ", MARK + MARK, *(c for c in PUNCTUATION if c not in mixing)]
        # One table of all beginnings of pieces: its piece (or -1), and whether a longer piece begins so.
        longer = {p[:n] for p in pieces for n in range(1, len(p))}
        names = [*pieces, *(longer - set(pieces))]
        self.powers = self._powers(1 << 19)
        heads = np.frombuffer("".join(names).encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(p) for p in names])
        known = self._hashes(heads, ends - [len(p) for p in names], ends)
        order = np.argsort(known)
        self.known = known[order]
        self.piece = np.concatenate([np.array(ids, np.int64), np.full(len(names) - len(pieces), -1)])[order]
        self.weight = np.concatenate([weights, np.zeros(len(names) - len(pieces))])[order]
        self.longer = np.array([p in longer for p in names])[order]
        # Where the hashes of each beginning start; a hash that no other follows ends the table.
        self.jump = np.searchsorted(self.known, np.arange(1 << JUMP, dtype=np.uint64) << np.uint64(64 - JUMP)).astype(np.int32)
        self.known = np.append(self.known, np.uint64(2**64 - 1))

    def cut(self, text: str) -> list[str]:
        """The units of a normalized text."""
        if any(c in text for c in self.cuts):
            return self.unit.findall(text)
        units = text.replace(MARK, " " + MARK).split(" ")
        return units if units[0] else units[1:]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of every hash in the table, and whether it stands there."""
        place = self.jump[h >> np.uint64(64 - JUMP)]
        found = self.known[place]
        behind = np.flatnonzero(found < h)
        while len(behind):
            place[behind] += 1
            found[behind] = self.known[place[behind]]
            behind = behind[found[behind] < h[behind]]
        return place, (found == h) & (place < len(self.piece))

    @staticmethod
    def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, base, np.uint64)
            steps[:1] = 1
            out.append(np.cumprod(steps))
        return out[0], out[1]

    def _hashes(self, codes, starts, ends) -> np.ndarray:
        sums, inverse = self._sums(codes)
        return (sums[ends] - sums[starts]) * inverse[starts]

    def _sums(self, codes):
        n = len(codes) + 1
        powers, inverse = (x[:n] for x in (self.powers if n <= len(self.powers[0]) else self._powers(n)))
        sums = np.zeros(n, np.uint64)
        np.cumsum(mixed((codes.astype(np.uint64) + np.uint64(1)) * _GOLD) * powers[:-1], out=sums[1:])
        return sums, inverse

    @lru_cache(maxsize=4096)  # noqa: B019  (one vocabulary per process)
    def fallback(self, code: int) -> list[int]:
        if self.bytes is None:
            return [self.model.unk_id()]
        return [self.bytes[b] for b in chr(code).encode("utf-8", "replace")]


class _Numbers(dict):
    """Numbers units as they come."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


@dataclass
class Lattices:
    """The lattices of the distinct units met so far, as edges sorted by the node they leave.

    What follows a node depends on the rest of its unit alone, so units share the nodes of their last `SHARED` characters; node 0 is
    the end of all. When there are too many nodes, those of units that a later batch met again stay, if they are less than half.
    """

    vocabulary: Vocabulary
    remember: int = 2_000_000
    units: _Numbers = field(default_factory=_Numbers)
    ends: dict[str, int] = field(default_factory=dict)  # the node of an ending

    def __post_init__(self):
        self.ends[""] = 0
        self.n_nodes, self.n_edges = 1, 0
        # Arrays have room to grow; only their beginnings are in use.
        self.first = np.zeros(1 << 12, np.int64)  # first node of each unit
        self.size = np.zeros(1 << 12, np.int64)
        self.again = np.zeros(1 << 12, bool)  # met by a later batch than its first
        self.edge_at = np.zeros(1 << 16, np.int64)  # edges of node k: edge_at[k] to edge_at[k + 1]
        self.left = np.zeros(1 << 16, np.int32)  # characters from a node to the end
        self.tail = np.zeros(1 << 16, np.int32)  # the node one character further
        self.beta = np.zeros(1 << 16)  # log of the weight of all ways from a node to the end
        self.rest = np.full(1 << 16, -np.inf)  # log of the probability of all edges of a node but its first
        self.to = np.zeros(1 << 16, np.int32)
        self.id = np.zeros(1 << 16, np.int32)  # piece, or -1 - character
        self.logp = np.zeros(1 << 16)

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        held = getattr(self, name)
        if at + len(values) > len(held):
            more = np.zeros(len(held) + max(len(held), len(values)), held.dtype)
            more[:at] = held[:at]
            setattr(self, name, more)
            held = more
        held[at:at + len(values)] = values

    def forget(self) -> None:
        """Drop the units that no batch met again since the last time."""
        kept = np.flatnonzero(self.again[:len(self.units)])
        stay = np.zeros(self.n_nodes, bool)
        stay[0] = True
        # Nodes made for one unit follow each other; the last of them leads to those of an ending.
        stops = np.flatnonzero(self.tail[:self.n_nodes] != np.arange(1, self.n_nodes + 1))
        nodes = self.first[kept]
        while len(nodes := np.unique(nodes[~stay[nodes]])):
            stop = stops[np.searchsorted(stops, nodes)]
            stay[ragged(nodes, stop + 1 - nodes)] = True
            nodes = self.tail[stop]
        if 2 * int(stay.sum()) > self.remember:
            kept, stay[1:] = kept[:0], False
        nodes = np.flatnonzero(stay)
        number = np.cumsum(stay) - 1
        counts = self.edge_at[nodes + 1] - self.edge_at[nodes]
        edges = ragged(self.edge_at[nodes], counts)
        names = list(self.units)
        self.units.clear()
        self.units.update((names[k], n) for n, k in enumerate(kept.tolist()))
        held = np.array(list(self.ends.values()))
        self.ends = {end: n for end, n, own in zip(self.ends, number[held].tolist(), stay[held].tolist(), strict=True) if own}
        self.again[:] = False
        for name, values in (("first", number[self.first[kept]]), ("size", self.size[kept]), ("edge_at", np.concatenate([[0], np.cumsum(counts)])),
                             ("left", self.left[nodes]), ("tail", number[self.tail[nodes]]), ("beta", self.beta[nodes]), ("rest", self.rest[nodes]),
                             ("to", number[self.to[edges]]), ("id", self.id[edges]), ("logp", self.logp[edges])):
            self._put(name, 0, values)
        self.n_nodes, self.n_edges = len(nodes), len(edges)

    def numbers(self, docs: list[list[str]]) -> list[np.ndarray]:
        """The number of every unit of every text."""
        if self.n_nodes > self.remember:
            self.forget()
        known = len(self.units)
        out = [np.fromiter(map(self.units.__getitem__, d), np.int64, len(d)) for d in docs]
        for numbers in out:
            self.again[numbers[numbers < known]] = True
        fresh = list(islice(reversed(self.units), len(self.units) - known))[::-1]
        for k in range(0, len(fresh), 20_000):
            self._add(fresh[k:k + 20_000], known + k)
        return out

    def _add(self, units: list[str], known: int) -> None:
        v, base = self.vocabulary, self.n_nodes
        size = np.fromiter(map(len, units), np.int64, len(units))
        # Each unit has new nodes up to an ending that has its nodes already.
        new, join, n = [], [], base
        ends = self.ends
        for unit in units:
            own = max(0, len(unit) - SHARED)
            end = unit[own:]
            while (node := ends.get(end)) is None:
                ends[end] = n + own
                own += 1
                end = end[1:]
            new.append(own)
            join.append(node)
            n += own
        new, join, n_new = np.array(new), np.array(join), n - base
        first = base + np.cumsum(new) - new
        self._put("first", known, np.where(new > 0, first, join))
        self._put("size", known, size)
        self._put("again", known, np.zeros(len(units), bool))
        if not n_new:
            return
        fresh = np.flatnonzero(new)
        codes = np.frombuffer("".join([units[k] for k in fresh.tolist()]).encode("utf-32-le", "surrogatepass"), "<u4")
        length, new, join, first = size[fresh], new[fresh], join[fresh], first[fresh]
        opens = np.cumsum(length) - length
        here = ragged(opens, new)  # the character of every new node
        left = np.repeat(opens + length, new) - here
        tail = np.arange(base + 1, n + 1)
        tail[first + new - 1 - base] = join
        self._put("left", base, left)
        self._put("tail", base, tail)
        # The node at every place of the units, their ends included.
        node = np.zeros(len(codes) + len(fresh), np.int64)
        unit = np.repeat(np.arange(len(fresh)), new)
        node[here + unit] = np.arange(base, n)
        spot, rest_of, to = opens + np.arange(len(fresh)) + new, length - new, join
        while len(spot):
            node[spot] = to
            some = rest_of > 0
            spot, rest_of, to = spot[some] + 1, rest_of[some] - 1, self.tail[to[some]]
        sums, inverse = v._sums(codes)
        leaving = np.zeros(n_new, np.int64)  # edges of every node so far
        pieces = []
        single = np.zeros(n_new, bool)
        source, spots, room, before, turn = np.arange(n_new), here, left, sums[here], inverse[here]
        for n in range(1, v.longest + 1):
            if n > 1:
                some = v.longer[place] & (room >= n)
                source, spots, room, before, turn = source[some], spots[some], room[some], before[some], turn[some]
            if not len(source):
                break
            place, same = v.find((sums[spots + n] - before) * turn)
            source, spots, room, place, before, turn = source[same], spots[same], room[same], place[same], before[same], turn[same]
            hit = v.piece[place] >= 0
            at_hit = source[hit]
            pieces.append((n, at_hit, place[hit], leaving[at_hit]))
            leaving[at_hit] += 1
            if n == 1:
                single[at_hit] = True
        lone = np.flatnonzero(~single)
        last_of = leaving[lone]
        leaving[lone] += 1
        # Edges by the node they leave, shorter ones first and the character itself last.
        begins = np.cumsum(leaving) - leaving
        n_edges = int(leaving.sum())
        span, ids, weights = np.ones(n_edges, np.int64), np.empty(n_edges, np.int64), np.empty(n_edges)
        for n, source, place, rank in pieces:
            k = begins[source] + rank
            span[k], ids[k], weights[k] = n, v.piece[place], v.weight[place]
        k = begins[lone] + last_of
        code = codes[here[lone]].astype(np.int64)
        ids[k] = -1 - code
        weights[k] = v.byte_weight * (1 + (code > 0x7F).astype(int) + (code > 0x7FF) + (code > 0xFFFF))
        out_of = np.repeat(np.arange(n_new), leaving)
        into = node[(here + unit)[out_of] + span]
        # Nodes by their distance from the end of their unit, and the edges in that order.
        self._put("beta", base, np.zeros(n_new))
        beta = self.beta
        back = left.astype(np.uint16) if left.max() < 1 << 16 else left  # short ones are sorted by radix
        nodes = np.argsort(back, kind="stable")
        rows = np.cumsum(np.bincount(back)).tolist()
        fan = leaving[nodes]
        k = ragged(begins[nodes], fan)
        weight, target = weights[k], into[k]
        cuts = np.concatenate([[0], np.cumsum(fan)])
        nodes += base
        for a, b in zip(rows, rows[1:]):
            if a == b:
                continue
            x = cuts[a]
            value = weight[x:cuts[b]] + beta[target[x:cuts[b]]]
            top = np.maximum.reduceat(value, cuts[a:b] - x)
            value -= np.repeat(top, fan[a:b])
            beta[nodes[a:b]] = top + np.log(np.add.reduceat(np.exp(value, out=value), cuts[a:b] - x))
        logp = weights + beta[into] - beta[base + out_of]
        # The likeliest edge of a node goes first.
        top = np.maximum.reduceat(logp, begins)
        lead = np.flatnonzero(logp == np.repeat(top, leaving))
        lead = lead[np.diff(out_of[lead], prepend=-1) > 0]
        moved = np.flatnonzero(lead != begins)
        head, lead = begins[moved], lead[moved]
        for values in (into, ids, logp):
            values[head], values[lead] = values[lead], values[head]
        rest = np.full(n_new, -np.inf)
        forks = np.flatnonzero(leaving > 1)
        if len(forks):
            others = np.ones(n_edges, bool)
            others[begins] = False
            value, fan = logp[others], leaving[forks] - 1
            cuts = np.cumsum(fan) - fan
            top = np.maximum.reduceat(value, cuts)
            value -= np.repeat(top, fan)
            rest[forks] = top + np.log(np.add.reduceat(np.exp(value, out=value), cuts))
        more = self.n_edges
        self._put("edge_at", base, np.append(begins, n_edges) + more)
        self._put("rest", base, rest)
        for name, values in (("to", into), ("id", ids), ("logp", logp)):
            self._put(name, more, values)
        self.n_nodes += n_new
        self.n_edges += n_edges


@dataclass
class Sample:
    ids: np.ndarray
    log_prob: float
    key: float
    inclusion: float


@dataclass
class _Walk:
    """A path: its edges, the log-probability of each beginning, and the unit (counted in the text) of each edge."""

    edges: np.ndarray
    unit: np.ndarray
    phi: np.ndarray


class Sampler:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.lattices = Lattices(vocabulary)

    def units(self, text: str) -> list[str]:
        return self.vocabulary.cut(self.vocabulary.model.normalize(text.encode("utf-8", "replace").decode())) if text else []

    def samples(self, texts: list[str], seeds: np.ndarray, k: int) -> list[list[Sample]]:
        """Up to k distinct segmentations of each text in the order of their keys; fewer if there are not as many."""
        lat = self.lattices
        docs = lat.numbers([self.units(t) for t in texts])
        n = len(docs)
        seeds = mixed(seeds.astype(np.uint64) * _GOLD + np.uint64(1))
        root = -np.log(-np.log(uniform(seeds)))
        walks: list[list[_Walk]] = [[] for _ in range(n)]
        keys: list[list[float]] = [[] for _ in range(n)]
        # Open nodes of each text: key, walk it branches from, place in it, edges that have been taken there.
        open_: list[list[tuple[float, int, int, tuple[int, ...]]]] = [[(float(root[d]), -1, 0, ())] for d in range(n)]
        for turn in range(k):
            starts = []
            for d in range(n):
                if not open_[d]:
                    continue
                best = max(range(len(open_[d])), key=lambda i: open_[d][i][0])
                starts.append((d, *open_[d].pop(best)))
            if not starts:
                break
            self._descend(docs, seeds, starts, turn, walks, open_, k - turn)
            for d, key, *_ in starts:
                keys[d].append(key)
        spelled = iter(self._ids([walk.edges for own in walks for walk in own]))
        out: list[list[Sample]] = []
        for d in range(n):
            bound = max((o[0] for o in open_[d]), default=None)
            found = []
            for walk, key in zip(walks[d], keys[d], strict=True):
                phi = float(walk.phi[-1]) if len(walk.phi) else 0.0
                found.append(Sample(next(spelled), phi, key, 1.0 if bound is None else float(-np.expm1(-np.exp(min(phi - bound, 700.0))))))
            out.append(found)
        return out

    def _ids(self, paths: list[np.ndarray]) -> list[np.ndarray]:
        """The pieces of every path; a character that is no piece is spelled in bytes."""
        ids = self.lattices.id[np.concatenate([np.zeros(0, np.int64), *paths])]
        ends = np.cumsum([0, *map(len, paths)])
        lone = np.flatnonzero(ids < 0)
        if len(lone):
            codes, which = np.unique(-1 - ids[lone], return_inverse=True)
            spelled = [self.vocabulary.fallback(c) for c in codes.tolist()]
            size = np.array([len(x) for x in spelled])
            count = np.ones(len(ids), np.int64)
            count[lone] = size[which]
            at = np.concatenate([[0], np.cumsum(count)])
            ids, ends = np.repeat(ids, count), at[ends]
            ids[ragged(at[lone], count[lone])] = np.array(list(chain.from_iterable(spelled)))[ragged((np.cumsum(size) - size)[which], size[which])]
        ids = ids.astype(np.uint32)
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _branches(self, seed: np.ndarray, key: np.ndarray, before: np.ndarray, taken: list[tuple[int, ...]]):
        """For each of some nodes one of its edges not taken yet, and the key of what is then left there (-inf if nothing is)."""
        lat = self.lattices
        node = np.searchsorted(lat.edge_at[:lat.n_nodes], [t[0] for t in taken], side="right") - 1
        begin, last, n_taken = lat.edge_at[node], lat.edge_at[node + 1] - 1, np.array([len(t) for t in taken])
        edges = begin[:, None] + np.arange(int((last - begin).max()) + 1)
        left = edges <= last[:, None]
        row = np.repeat(np.arange(len(taken)), n_taken)
        left[row, np.fromiter(chain.from_iterable(taken), np.int64) - begin[row]] = False
        logp = np.where(left, lat.logp[np.minimum(edges, last[:, None])], -np.inf)
        share = np.cumsum(np.exp(logp - logp.max(axis=1, keepdims=True)), axis=1)
        seed = seed + n_taken.astype(np.uint64), (seed ^ _MIX2) + n_taken.astype(np.uint64)
        pick = (share < (uniform(mixed(seed[0])) * share[:, -1])[:, None]).sum(axis=1)
        logp[np.arange(len(taken)), pick] = -np.inf
        others = np.logaddexp.reduce(logp, axis=1)
        rest = np.full(len(taken), -np.inf)
        some = np.flatnonzero(others > -np.inf)
        rest[some] = below(key[some], depths(before[some] + others[some], mixed(seed[1][some])))
        return begin + pick, rest

    def _descend(self, docs, seeds, starts, turn, walks, open_, keep) -> None:
        """From the start of each text named, walk to a leaf; adds the walk, and the children not taken to the open nodes."""
        lat = self.lattices
        # Units to walk: the rest of the unit of the branch, then those after it.
        numbers, place, begin = [], [], []
        base: list[_Walk] = []
        seed = mixed(seeds[[s[0] for s in starts]] + _GOLD * np.full(1, turn + 1, np.uint64))
        branches = [s for s, start in enumerate(starts) if start[2] >= 0]
        if branches:
            at = [(walks[d][parent].phi[j - 1] if j else 0.0) for d, _, parent, j, _ in (starts[s] for s in branches)]
            edges, rests = self._branches(seed[branches], np.array([starts[s][1] for s in branches]), np.array(at), [starts[s][4] for s in branches])
            drawn = dict(zip(branches, zip(edges.tolist(), rests.tolist(), strict=True), strict=True))
        for s, (d, _, parent, j, taken) in enumerate(starts):
            if parent < 0:
                head = _Walk(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                numbers.append(docs[d])
                place.append(np.arange(len(docs[d])))
                begin.append(lat.first[docs[d]])
            else:
                w = walks[d][parent]
                u = int(w.unit[j])
                before = float(w.phi[j - 1]) if j else 0.0
                edge, rest = drawn[s]
                if rest > -np.inf:
                    open_[d].append((rest, parent, j, (*taken, edge)))
                head = _Walk(np.append(w.edges[:j], edge), np.append(w.unit[:j], u), np.append(w.phi[:j], before + lat.logp[edge]))
                numbers.append(docs[d][u:])
                place.append(np.arange(u, len(docs[d])))
                first = lat.first[docs[d][u:]].copy()
                first[0] = int(lat.to[edge])
                begin.append(first)
            base.append(head)
        owner = np.repeat(np.arange(len(starts)), [len(x) for x in numbers])
        number, place, node = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (numbers, place, begin))
        phi = np.array([b.phi[-1] if len(b.phi) else 0.0 for b in base])
        key = np.array([s[1] for s in starts])
        parts: list[list[tuple]] = [[] for _ in starts]
        done = np.array([len(b.edges) for b in base])
        for a in range(0, len(number), SECTION):
            b = min(a + SECTION, len(number))
            self._section(owner[a:b], number[a:b], place[a:b], node[a:b], seed, key, phi, done, parts, starts, open_, walks, keep)
        for s, (d, *_rest) in enumerate(starts):
            head = base[s]
            walks[d].append(_Walk(np.concatenate([head.edges, *(p[0] for p in parts[s])]), np.concatenate([head.unit, *(p[1] for p in parts[s])]),
                                  np.concatenate([head.phi, *(p[2] for p in parts[s])])))

    def _section(self, owner, number, place, node, seed, key, phi, done, parts, starts, open_, walks, keep) -> None:
        """Walk some units to their ends. phi, done: log-probability and edges of each text before them; both go on."""
        lat = self.lattices
        live = np.flatnonzero(node)
        at = node[live]
        stem = (mixed(seed[owner] + place.astype(np.uint64) * _GOLD) + lat.size[number].view(np.uint64))[live]
        taken = []
        step = 0
        while len(live):
            keys = mixed(stem - lat.left.take(at).astype(np.uint64) + np.uint64(step << 32))  # a place is a number of characters before it
            u = uniform(keys)
            edge = lat.edge_at.take(at)
            logp = lat.logp.take(edge)
            others = lat.rest.take(at)
            p = np.exp(logp)
            todo = np.flatnonzero((u >= p) & (others > -np.inf))
            if len(todo):
                # Those that leave the first edge go on alone.
                u, p, final, later = u[todo], p[todo], lat.edge_at.take(at[todo] + 1) - 1, edge[todo]
                own, some = np.empty(len(todo)), np.arange(len(todo))
                while len(some):
                    u[some] -= p[some]
                    later[some] += 1
                    own[some] = lat.logp.take(later[some])
                    p[some] = np.exp(own[some])
                    some = some[(u[some] >= p[some]) & (later[some] < final[some])]
                edge[todo], logp[todo] = later, own
                others[todo] = np.log1p(-np.minimum(p, 0.75))  # an edge after the first has at most half
            taken.append((live, edge, logp, keys, others))
            at = lat.to.take(edge).astype(np.int64)
            on = np.flatnonzero(at)
            live, at, stem = live[on], at[on], stem[on]
            step += 1
        if not taken:
            return
        # A unit's edges one after the other.
        steps = np.zeros(len(number), np.int64)
        for live, *_ in taken:
            steps[live] += 1
        begins = np.cumsum(steps) - steps
        unit = np.repeat(np.arange(len(number)), steps)
        edge, after, drawn, other = np.empty(len(unit), np.int64), np.empty(len(unit)), np.empty(len(unit), np.uint64), np.empty(len(unit))
        for step, (live, edges, logp, keys, others) in enumerate(taken):
            k = begins[live] + step
            edge[k], after[k], drawn[k], other[k] = edges, logp, keys, others
        drawn ^= _MIX2
        text = owner[unit]
        bounds = np.searchsorted(text, np.arange(len(seed) + 1))
        before = -after
        for s in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            # One after the other within a text, so that sums depend on no other text and no section.
            own = after[bounds[s]:bounds[s + 1]]
            own[0] += phi[s]
            np.cumsum(own, out=own)
        before += after
        spot = np.arange(len(edge)) - bounds[:-1][text] + done[text]
        for s in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            x, y = bounds[s], bounds[s + 1]
            parts[s].append((edge[x:y], place[unit[x:y]], after[x:y]))
            phi[s] = after[y - 1]
            done[s] += y - x
        # The key of what was not taken at each node, given that the key of the node is that of the walk.
        forks = np.flatnonzero(other > -np.inf)
        of = text[forks]
        depth = depths(before[forks] + other[forks], drawn[forks])
        cut = np.searchsorted(of, np.arange(len(seed) + 1))
        for s in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
            x, y = cut[s], cut[s + 1]
            some = np.argpartition(depth[x:y], keep - 1)[:keep] if y - x > keep else np.arange(y - x)
            own = below(key[s], depth[x + some])
            d = starts[s][0]
            open_[d].extend((float(o), len(walks[d]), int(spot[forks[x + i]]), (int(edge[forks[x + i]]),)) for o, i in zip(own, some.tolist(), strict=True))
            open_[d].sort(reverse=True)
            del open_[d][keep:]
