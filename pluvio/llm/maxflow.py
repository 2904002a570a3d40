"""Minimum cut of small graphs with a source and a sink, by Dinic's algorithm."""

from __future__ import annotations

from collections import deque


def source_side(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut.

    source, sink: capacity of each node's edge from the source and to the sink; edges: undirected, (node, node, capacity).
    Of equal cuts the one with the smallest source side.
    """
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for k in range(n):
        # What can run straight through a node does; only the rest matters.
        through = min(source[k], sink[k])
        if source[k] > through:
            connect(s, k, source[k] - through, 0.0)
        if sink[k] > through:
            connect(k, t, sink[k] - through, 0.0)
    for a, b, c in edges:
        connect(a, b, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        line = deque([s])
        while line:
            a = line.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    line.append(to[e])
        if level[t] < 0:
            return [level[k] >= 0 for k in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            step = -1
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    step = e
                    break
                at[a] += 1
            if step >= 0:
                path.append(step)
                a = to[step]
            elif path:
                at[to[path[-1] ^ 1]] += 1
                a = to[path.pop() ^ 1]
            else:
                break
