"""Join of sets by a prefix tree.

Sets are sorted by one global order and stored as paths of a tree whose chains without branches are one node. A set looks for
partners by walking the tree: paths that begin alike share the overlap counted so far, and a branch is left as soon as what
can still come, by the items left on either side, cannot reach the overlap needed. As only connection matters, a branch whose
sets are all joined with the seeker already is not entered.
"""

from __future__ import annotations

import numpy as np


class Groups:
    """Union-find over positions; the smallest position stands for its group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


class _Node:
    __slots__ = ("label", "kids", "member", "lo", "hi", "one")

    def __init__(self, label, member, lo, hi, one):
        self.label, self.member, self.lo, self.hi, self.one = label, member, lo, hi, one
        self.kids: dict[int, _Node] = {}


class Trie:
    """Sets as sorted arrays of ranks below `ranks`; two link if 100 * common >= percent * all."""

    def __init__(self, ranks: int, groups: Groups, percent: int = 85):
        self.root = _Node(np.zeros(0, np.int64), -1, 1 << 60, 0, -1)
        self.mask = np.zeros(ranks + 1, bool)
        self.groups, self.percent = groups, percent

    def insert(self, who: int, items: np.ndarray) -> None:
        n, node, at = len(items), self.root, 0
        path = []
        while True:
            path.append(node)
            if at == n:
                if node.member >= 0:
                    self.groups.join(node.member, who)
                else:
                    node.member = who
                break
            kid = node.kids.get(int(items[at]))
            if kid is None:
                node.kids[int(items[at])] = _Node(items[at:], who, n, n, who)
                break
            label = kid.label
            m = min(len(label), n - at)
            apart = label[:m] != items[at:at + m]
            same = int(apart.argmax()) if apart.any() else m
            if same < len(label):
                upper = _Node(label[:same], -1, kid.lo, kid.hi, kid.one)
                kid.label = label[same:]
                upper.kids[int(kid.label[0])] = kid
                node.kids[int(items[at])] = upper
                kid = upper
            node, at = kid, at + same
        for node in path:
            node.one = who if node.hi == 0 or node.one >= 0 and self.groups.find(node.one) == self.groups.find(who) else -1
            node.lo, node.hi = min(node.lo, n), max(node.hi, n)

    def link(self, who: int, items: np.ndarray) -> None:
        """Join who with the group of every stored set that it links to."""
        p, n, find = self.percent, len(items), self.groups.find
        shortest, longest = -(-p * n // 100), n * 100 // p
        mask, mine = self.mask, find(who)
        mask[items] = True
        todo = [(self.root, 0, 0)]
        while todo:
            node, depth, common = todo.pop()
            if node.hi < shortest or node.lo > longest or node.one >= 0 and find(node.one) == mine:
                continue
            if len(node.label):
                common += int(np.count_nonzero(mask[node.label]))
                depth += len(node.label)
                left = n - int(np.searchsorted(items, node.label[-1], side="right"))
                most = common + min(left, node.hi - depth)
                if (100 + p) * most < p * (n + max(node.lo, shortest)):
                    continue
            if node.member >= 0 and (100 + p) * common >= p * (n + depth):
                self.groups.join(node.member, who)
                mine = find(who)
            todo.extend((kid, depth, common) for kid in node.kids.values())
        mask[items] = False


def ranked(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The sets as sorted ranks in an order that puts frequent items first, so that paths share long beginnings."""
    if not sets:
        return [], 0
    ends = np.cumsum([len(s) for s in sets])
    items, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(items), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(items))
    ranks = rank[inverse]
    return [np.sort(part) for part in np.split(ranks, ends[:-1])], len(items)


def join_within(sets: list[np.ndarray], percent: int = 85, other: list[np.ndarray] | None = None) -> list[int]:
    """The group (smallest position) of every set, linking all sets with each other.

    With other, the sets of the first list are only linked with those of the second, which follow them in the numbering.
    """
    everything = sets + (other or [])
    order, ranks = ranked(everything)
    groups = Groups(len(everything))
    tree = Trie(ranks, groups, percent)
    if other is None:
        for who in sorted(range(len(order)), key=lambda k: (len(order[k]), k)):
            tree.link(who, order[who])
            tree.insert(who, order[who])
    else:
        for who in range(len(sets)):
            tree.insert(who, order[who])
        for who in range(len(sets), len(order)):
            tree.link(who, order[who])
    return [groups.find(k) for k in range(len(order))]
