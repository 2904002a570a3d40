"""Cells of a tile and the values of the links they list, in numpy: which links are present, and what they add up to."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

ON_CELL = 1e-10  # a link closer than this decides the cell alone
#: Entries of (step, cell, place in the list) worked on at once.
AT_ONCE = 1 << 21


class Tile:
    """cells: row, col, links (cml_id, d; nearest first) and full; sent: time, cml_id, z of known values."""

    def __init__(self, cells: pa.Table, sent: pa.Table, near: int):
        self.near = near
        self.cells = cells.combine_chunks()
        links = self.cells.column("links").combine_chunks()
        size = links.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = links.flatten()
        ids, number = np.unique(flat.field("cml_id").to_numpy(zero_copy_only=False), return_inverse=True)
        # Lists as a matrix: beyond the end of a list stands a link that is never present.
        inside = np.arange(size.max() if len(size) else 0) < size[:, None]
        self.link = np.full(inside.shape, len(ids))
        self.link[inside] = number
        self.distance = np.full(inside.shape, np.inf)
        self.distance[inside] = flat.field("d").to_numpy(zero_copy_only=False)
        steps = sent.column("time").combine_chunks().dictionary_encode()
        self.times = steps.dictionary
        names = sent.column("cml_id").to_numpy()
        at = np.minimum(np.searchsorted(ids, names), max(0, len(ids) - 1))
        mine = ids[at] == names if len(ids) else np.zeros(len(names), bool)
        where = (steps.indices.to_numpy(zero_copy_only=False)[mine], at[mine])
        self.z = np.zeros((len(self.times), len(ids) + 1))
        self.z[where] = sent.column("z").to_numpy()[mine]
        self.known = np.zeros(self.z.shape, bool)
        self.known[where] = True

    def _steps(self):
        """Slices of the steps, and the leading part of the lists that most cells need."""
        n, depth = self.link.shape
        many = max(1, AT_ONCE // max(1, n * depth))
        return range(0, len(self.times), many), many

    def short_cells(self) -> np.ndarray:
        """Cells whose list may lack a link they need at some step: full, and with too few present."""
        full = self.cells.column("full").to_numpy(zero_copy_only=False).astype(bool)
        few = np.zeros(len(full), bool)
        starts, many = self._steps()
        for a in starts:
            few |= (self.known[a:a + many][:, self.link].sum(axis=2, dtype=np.int32) < self.near).any(axis=0)
        return np.flatnonzero(few & full)

    def frames(self, power: float) -> pa.Table:
        """time, row, col, v of every step and cell with a link present."""
        on = self.distance < ON_CELL
        special = np.flatnonzero(on.any(axis=1))
        weight = np.where(on, 0.0, np.power(np.where(on, 1.0, self.distance), -power))
        out_step, out_cell, out_value = [], [], []
        starts, many = self._steps()
        for a in starts:
            present = self.known[a:a + many][:, self.link]
            present &= present.cumsum(axis=2, dtype=np.int32) <= self.near
            share = present * weight
            with np.errstate(invalid="ignore", divide="ignore"):
                value = np.einsum("scd,scd->sc", share, self.z[a:a + many][:, self.link]) / share.sum(axis=2)
            for c in special.tolist():
                steps = np.flatnonzero((present[:, c] & on[c]).any(axis=1))
                value[steps, c] = self.z[a + steps, self.link[c, present[steps, c].argmax(axis=1)]]
            step, cell = np.nonzero(present.any(axis=2))
            out_step.append(step + a)
            out_cell.append(cell)
            out_value.append(value[step, cell])
        step, cell, value = (np.concatenate([np.zeros(0, k), *x]) for x, k in ((out_step, np.int64), (out_cell, np.int64), (out_value, float)))
        place = self.cells.select(["row", "col"]).take(pa.array(cell))
        return pa.table({"time": self.times.take(pa.array(step)), "row": place.column("row"), "col": place.column("col"), "v": value})
