"""M-tree over vectors in numpy: pages of objects with covering radii and distances to the parent's object."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

PAGE = 128
EPS = 1e-6


@dataclass
class Page:
    objects: np.ndarray  # rows of the stored points
    to_parent: np.ndarray  # their distances to the routing object of this page
    radius: np.ndarray | None  # covering radius of each child; None in a leaf
    children: list[int] | None


class MTree:
    """Points of a Euclidean space. Bulk-loaded by recursive clustering around objects chosen far from each other."""

    def __init__(self, points: np.ndarray, page: int = PAGE):
        self.points, self.page = points, page
        self.pages: list[Page] = []
        self.computed = 0
        if len(points):
            self.root_object = 0
            self.root, self.root_radius = self._load(np.arange(len(points)), 0)

    def _distances(self, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        gap = self.points[rows] - point
        return np.sqrt((gap * gap).sum(axis=1))

    def _load(self, rows: np.ndarray, parent: int) -> tuple[int, float]:
        """A page over rows under a routing object: its number and the covering radius."""
        to_parent = self._distances(rows, self.points[parent])
        reach = float(to_parent.max())
        if len(rows) <= self.page:
            self.pages.append(Page(rows, to_parent, None, None))
            return len(self.pages) - 1, reach
        fan = int(min(self.page, max(2, -(-len(rows) // self.page))))
        chosen, nearest, home = [], np.full(len(rows), np.inf), np.zeros(len(rows), np.int64)
        at = int(to_parent.argmax())
        for k in range(fan):
            far = self._distances(rows, self.points[rows[at]])
            closer = far < nearest
            home[closer], nearest[closer] = k, far[closer]
            chosen.append(int(rows[at]))
            at = int(nearest.argmax())
            if nearest[at] == 0:
                break
        sizes = np.bincount(home, minlength=len(chosen))
        if sizes.max() == len(rows):  # points of one place: any split will do
            home = np.arange(len(rows)) % fan
            chosen = [int(rows[k]) for k in range(fan)]
        objects, radius, children = [], [], []
        for k, pivot in enumerate(chosen):
            mine = rows[home == k]
            if len(mine):
                child, r = self._load(mine, pivot)
                objects.append(pivot)
                radius.append(r)
                children.append(child)
        objects = np.array(objects)
        self.pages.append(Page(objects, self._distances(objects, self.points[parent]), np.array(radius), children))
        return len(self.pages) - 1, reach

    def search(self, point: np.ndarray, bound: float, leaf) -> None:
        """Best first: visits every point that may lie within the bound. leaf(rows) returns the new bound.

        A point or a child whose stored distance to its parent already shows that it is too far is never computed.
        """
        if not len(self.points):
            return
        d = float(self._distances(np.array([self.root_object]), point)[0])
        heap = [(max(0.0, d - self.root_radius), self.root, d)]
        while heap:
            least, number, d_parent = heapq.heappop(heap)
            if least > bound + EPS:
                return
            page = self.pages[number]
            away = np.abs(d_parent - page.to_parent)
            if page.children is None:
                rows = page.objects[away <= bound + EPS]
                if len(rows):
                    self.computed += len(rows)
                    bound = leaf(rows)
                continue
            some = np.flatnonzero(away - page.radius <= bound + EPS)
            if not len(some):
                continue
            self.computed += len(some)
            far = self._distances(page.objects[some], point)
            for k, f in zip(some.tolist(), far.tolist(), strict=True):
                low = max(0.0, f - float(page.radius[k]))
                if low <= bound + EPS:
                    heapq.heappush(heap, (max(low, least), page.children[k], f))
