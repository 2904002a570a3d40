"""Bidirectional gated recurrent network with attention pooling over words, in numpy.

A word enters as two vectors side by side: its own embedding, and the mean of the embeddings of its character n-grams, so
that a word never seen in training is still judged by its spelling. The two are projected once per distinct word, both
directions of the recurrent network run over windows of words, and a learned query pools the states. Trained by hand-written
back-propagation with Adam.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
PAD = ""


@dataclass(frozen=True)
class Shape:
    window: int = 64
    step: int = 48
    hidden: int = 8
    word_dim: int = 8
    char_dim: int = 12
    word_rows: int = 1 << 15
    char_rows: int = 1 << 14
    grams: tuple[int, ...] = (2, 3, 4)
    longest_word: int = 32


def words_of(text: str, shape: Shape = Shape()) -> list[str]:
    """The words of a text; longer ones than longest_word as pieces that share as many characters as the longest n-gram has."""
    words = WORD.findall(text.lower())
    size = shape.longest_word
    if not words or max(map(len, words)) <= size:
        return words
    step = size - max(shape.grams)
    return [w[i:i + size] for w in words for i in (range(0, max(1, len(w) - size + step), step) if len(w) > size else (0,))]


def word_row(word: str, shape: Shape) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % shape.word_rows


def gram_rows(words: list[str], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character n-grams of the words between marks, word after word, and how many each word has."""
    marked = ["^" + w + "$" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = ends[owner] - np.arange(len(codes))
    owners, rows = [], []
    for n in shape.grams:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h ^ codes[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        owners.append(owner[at])
        rows.append((h % np.uint64(shape.char_rows)).astype(np.int64))
    owners, rows = np.concatenate(owners), np.concatenate(rows)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.bincount(owners, minlength=len(words))


def window_starts(n: int, shape: Shape) -> list[int]:
    """Starts of overlapping windows that cover n words to the last one; one window if there are none."""
    if n <= shape.window:
        return [0]
    starts = list(range(0, n - shape.window, shape.step))
    return [*starts, n - shape.window]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    shape: Shape
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(shape: Shape, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        d, h = shape.word_dim + shape.char_dim, shape.hidden

        def draw(*size, scale):
            return (rng.standard_normal(size) * scale).astype(np.float32)

        return Network(shape, {
            "Ew": draw(shape.word_rows, shape.word_dim, scale=0.1),
            "Ec": draw(shape.char_rows, shape.char_dim, scale=0.3),
            "W": draw(d, 6 * h, scale=d**-0.5), "b": np.zeros(6 * h, np.float32),
            "Uf": draw(h, 3 * h, scale=0.5 * h**-0.5), "Ub": draw(h, 3 * h, scale=0.5 * h**-0.5),
            "q": draw(2 * h, scale=0.5), "o": draw(2 * h, scale=0.5), "c": np.zeros(1, np.float32),
        })

    def vectors(self, rows, flat, n, drop=None) -> np.ndarray:
        w = self.weights
        own = w["Ew"][rows] if drop is None else w["Ew"][rows] * drop[:, None]
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        chars = np.add.reduceat(w["Ec"][flat], starts, axis=0) / np.sqrt(n)[:, None].astype(np.float32)
        return np.concatenate([own, chars], axis=1)

    def project(self, words: list[str]) -> np.ndarray:
        """The input of all gates: direction, word, gate."""
        rows = np.array([word_row(x, self.shape) for x in words], np.int64)
        x = self.vectors(rows, *gram_rows(words, self.shape))
        return self.sides(x @ self.weights["W"] + self.weights["b"])

    def sides(self, gates: np.ndarray) -> np.ndarray:
        """(word, gates of both directions) as (direction, word, gates)."""
        return np.ascontiguousarray(gates.reshape(len(gates), 2, -1).transpose(1, 0, 2), dtype=np.float32)

    def run(self, gates: np.ndarray, index: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Scores (before the sigmoid) of windows. index: word row per window and place; lengths: at least 1 each."""
        w, h = self.weights, self.shape.hidden
        n, steps = index.shape
        place = np.arange(steps)
        back = np.where(place < lengths[:, None], lengths[:, None] - 1 - place, place)
        flipped = np.take_along_axis(index, back, axis=1)
        states, saved = [], []
        for side, (order, u) in enumerate(((index, w["Uf"]), (flipped, w["Ub"]))):
            part, order = gates[side], np.ascontiguousarray(order.T)
            hid = np.zeros((n, h), np.float32)
            out = np.empty((steps, n, h), np.float32)
            trace = []
            for t in range(steps):
                x = part.take(order[t], axis=0)
                rec = hid @ u
                gate = x[:, :2 * h] + rec[:, :2 * h]
                np.tanh(0.5 * gate, out=gate)
                gate *= 0.5
                gate += 0.5
                new = np.tanh(x[:, 2 * h:] + gate[:, :h] * rec[:, 2 * h:])
                z = gate[:, h:]
                nxt = new + z * (hid - new)
                if keep:
                    trace.append((hid, gate, new, rec[:, 2 * h:]))
                hid = out[t] = nxt
            states.append(out)
            saved.append(trace)
        fwd, bwd = states
        live = (place < lengths[:, None]).T
        cols = np.arange(n)
        bwd = bwd[back.T, cols[None, :]]
        both = np.concatenate([fwd, bwd], axis=2)
        att = both @ w["q"]
        att = np.where(live, att, -np.inf)
        att -= att.max(axis=0)
        share = np.exp(att)
        share /= share.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, both)
        score = pooled @ w["o"] + w["c"][0]
        return (score, (flipped, back, saved, both, share, pooled, cols, live)) if keep else score

    def gradients(self, rows, flat, n_grams, drop, index, lengths, target):
        """Loss and gradients of the cross-entropy over windows.

        rows: the embedding row of each distinct word; flat and n_grams: its n-grams; drop: 0 hides its own embedding.
        """
        w, s, h = self.weights, self.shape, self.shape.hidden
        x = self.vectors(rows, flat, n_grams, drop)
        gates = self.sides(x @ w["W"] + w["b"])
        score, (flipped, back, saved, both, share, pooled, cols, live) = self.run(gates, index, lengths, keep=True)
        p = sigmoid(score)
        loss = float(-np.mean(target * np.log(p + 1e-7) + (1 - target) * np.log(1 - p + 1e-7)))
        ds = ((p - target) / len(target)).astype(np.float32)
        g = {"o": pooled.T @ ds, "c": ds.sum(keepdims=True)}
        dpool = ds[:, None] * w["o"]
        dshare = np.einsum("nh,tnh->tn", dpool, both)
        datt = share * (dshare - (share * dshare).sum(axis=0))
        dboth = share[:, :, None] * dpool[None] + datt[:, :, None] * w["q"]
        g["q"] = np.einsum("tn,tnh->h", datt, both)
        dfwd, dback_real = dboth[:, :, :h], dboth[:, :, h:]
        dbwd = np.zeros_like(dback_real)
        dbwd[back.T, cols[None, :]] = dback_real
        dsides = np.zeros_like(gates)
        for side, (order, u, name, dout) in enumerate(((index, w["Uf"], "Uf", dfwd), (flipped, w["Ub"], "Ub", dbwd))):
            du = np.zeros_like(u)
            carry = np.zeros((index.shape[0], h), np.float32)
            pieces = np.empty((index.shape[1], index.shape[0], 3 * h), np.float32)
            for t in range(index.shape[1] - 1, -1, -1):
                hid, gate, new, rec_new = saved[side][t]
                r, z = gate[:, :h], gate[:, h:]
                dh = carry + dout[t]
                dnew = dh * (1 - z) * (1 - new * new)
                dz = dh * (hid - new) * z * (1 - z)
                dr = dnew * rec_new * r * (1 - r)
                drec = np.concatenate([dr, dz, dnew * r], axis=1)
                pieces[t] = np.concatenate([dr, dz, dnew], axis=1)
                du += hid.T @ drec
                carry = dh * z + drec @ u.T
            g[name] = du
            np.add.at(dsides[side], order.T.ravel(), pieces.reshape(-1, 3 * h))
        dgates = np.concatenate([dsides[0], dsides[1]], axis=1)
        g["W"], g["b"] = x.T @ dgates, dgates.sum(axis=0)
        dx = dgates @ w["W"].T
        dw, dc = dx[:, :s.word_dim], dx[:, s.word_dim:]
        g["Ew"] = np.zeros_like(w["Ew"])
        np.add.at(g["Ew"], rows, dw if drop is None else dw * drop[:, None])
        g["Ec"] = np.zeros_like(w["Ec"])
        np.add.at(g["Ec"], flat, np.repeat(dc / np.sqrt(n_grams)[:, None].astype(np.float32), n_grams, axis=0))
        return loss, g


def padded(docs: list[np.ndarray], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over word rows: index, lengths, and the document of each window. Row 0 is the pad word."""
    index, lengths, owner = [], [], []
    for k, ids in enumerate(docs):
        for start in window_starts(len(ids), shape):
            piece = ids[start:start + shape.window]
            row = np.zeros(shape.window, np.int32)
            row[:len(piece)] = piece
            index.append(row)
            lengths.append(max(1, len(piece)))
            owner.append(k)
    return (np.array(index, np.int32).reshape(-1, shape.window), np.array(lengths, np.int64), np.array(owner, np.int64))


def train(texts: list[str], labels: list[int], shape: Shape = Shape(), epochs: int = 8, batch: int = 96, rate: float = 0.015,
          drop_words: float = 0.4, seed: int = 7) -> Network:
    """Learn from whole documents of which only the windows' maximum is known to carry the label.

    Each epoch scores all windows. A toxic document then teaches with its highest window, a clean one with its highest and
    one other. In the first epochs the window of a toxic document is any.
    """
    net = Network.fresh(shape, seed)
    if not texts or len(set(labels)) < 2:
        # Without both classes there is nothing to learn: every document gets the share seen, clean if none was.
        for name in ("o", "q"):
            net.weights[name][:] = 0
        net.weights["c"][:] = 4.0 if labels and min(labels) == 1 else -4.0
        return net
    rng = np.random.default_rng(seed)
    vocabulary = {PAD: 0}
    docs = [np.array([vocabulary.setdefault(x, len(vocabulary)) for x in words_of(t, shape)], np.int64) for t in texts]
    names = list(vocabulary)
    own = np.array([word_row(x, shape) for x in names], np.int64)
    flat, n_grams = gram_rows(names, shape)
    at = np.cumsum(n_grams) - n_grams
    index, lengths, owner = padded(docs, shape)
    y = np.array(labels, np.float32)
    first = np.searchsorted(owner, np.arange(len(docs)))
    count = np.bincount(owner, minlength=len(docs))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    tick = 0
    for epoch in range(epochs):
        any_window = first + (rng.random(len(docs)) * count).astype(np.int64)
        if epoch < 2:
            chosen = [any_window]
        else:
            gates = net.project(names)
            score = np.concatenate([net.run(gates, index[i:i + 2048], lengths[i:i + 2048]) for i in range(0, len(index), 2048)])
            order = np.lexsort((score, owner))
            top = order[np.cumsum(count) - 1]
            chosen = [top, any_window[y == 0]]
        picked = rng.permutation(np.concatenate(chosen))
        for i in range(0, len(picked), batch):
            rows = picked[i:i + batch]
            used, back = np.unique(index[rows], return_inverse=True)
            target = y[owner[rows]]
            drop = (rng.random(len(used)) >= drop_words).astype(np.float32)
            n = n_grams[used]
            grams = flat[np.repeat(at[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            _, grads = net.gradients(own[used], grams, n, drop, back.reshape(len(rows), -1), lengths[rows], target)
            tick += 1
            now = rate * min(1.0, 2.0 * (1 - epoch / epochs))
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.weights[k] -= now * (m / (1 - 0.9**tick)) / (np.sqrt(v / (1 - 0.99**tick)) + 1e-6)
    # Embeddings without a word learned from stay as drawn; silence those, so that unknown words are neutral.
    seen = np.zeros(shape.char_rows, bool)
    seen[flat] = True
    net.weights["Ec"][~seen] = 0
    return net


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Scorer:
    """Scores documents with a network, keeping the projected rows of words seen, up to a number of words."""

    def __init__(self, net: Network, remember: int = 200_000):
        self.net, self.remember = net, remember
        self.clear()

    def clear(self) -> None:
        self.known = _Numbers({PAD: 0})
        self.gates = np.zeros((2, self.remember // 8, 3 * self.net.shape.hidden), np.float32)
        self.gates[:, :1] = self.net.project([PAD])

    def rows(self, docs: list[list[str]]) -> list[np.ndarray]:
        if len(self.known) > self.remember:
            self.clear()
        known, before = self.known, len(self.known)
        ids = [np.fromiter(map(known.__getitem__, words), np.int32, len(words)) for words in docs]
        if len(known) > before:
            fresh = list(islice(reversed(known), len(known) - before))[::-1]
            if len(known) > self.gates.shape[1]:
                grown = np.zeros((2, max(len(known), 2 * self.gates.shape[1]), self.gates.shape[2]), np.float32)
                grown[:, :before] = self.gates[:, :before]
                self.gates = grown
            for i in range(0, len(fresh), 20_000):
                part = fresh[i:i + 20_000]
                self.gates[:, before + i:before + i + len(part)] = self.net.project(part)
        return ids

    def windows(self, texts: list[str], block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Probability and document of every window, all windows of a document in order."""
        ids = self.rows([words_of(t, self.net.shape) for t in texts])
        index, lengths, owner = padded(ids, self.net.shape)
        score = np.empty(len(index), np.float64)
        order = np.argsort(lengths, kind="stable")
        for i in range(0, len(order), block):
            rows = order[i:i + block]
            steps = int(lengths[rows[-1]])
            score[rows] = self.net.run(self.gates, index[rows, :steps], lengths[rows])
        return sigmoid(score), owner

    def scores(self, texts: list[str]) -> np.ndarray:
        """The highest window of each document."""
        if not texts:
            return np.zeros(0)
        score, owner = self.windows(texts)
        best = np.zeros(len(texts))
        np.maximum.at(best, owner, score)
        return best
