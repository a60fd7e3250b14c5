"""Hierarchical navigable small-world graphs over unit vectors, many searches in step.

Insertions and searches go in batches: each step expands the best unexpanded nodes of every beam of
the batch, so numpy works on whole batches. Arrays are bounded by the shard and the batch.
"""

from __future__ import annotations

import numpy as np

#: Neighbours above the ground level and on it, and the beam of an insertion.
LINKS, GROUND_LINKS, BUILD_BEAM = 16, 32, 64
BATCH = 256
#: Nodes of a beam that are expanded in a step.
STEP = 4


class Graph:
    """A graph over ``vectors`` (rows of length 1); ``draws`` are uniform numbers, one a row, that
    set its level."""

    def __init__(self, vectors: np.ndarray, draws: np.ndarray):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        levels = np.floor(-np.log(np.maximum(draws, 1e-12)) / np.log(LINKS)).astype(int)
        self.levels = np.minimum(levels, 12)
        self.links: list[np.ndarray] = []
        self.entry, self.top, done = 0, -1, 0
        while done < n:
            size = min(max(1, done), BATCH, n - done)
            self._insert(np.arange(done, done + size))
            done += size

    # Search ----------------------------------------------------------------------------------

    def _beam(self, queries: np.ndarray, start: np.ndarray, beam: int, level: int):
        """The best ``beam`` nodes found for each query from its ``start`` nodes (-1: none), with
        their cosines, best first; -1 where there are no more."""
        b, n = len(queries), len(self.vectors)
        links = self.links[level]
        rows = np.arange(b)[:, None]
        stamp = np.full((b, n + 1), -1, np.int32)  # the last place is for no node
        ids = np.full((b, beam), -1, np.int32)
        near = np.full((b, beam), -np.inf, np.float32)
        open_ = np.zeros((b, beam), bool)
        fresh, serial = start.astype(np.int32), 0
        live = np.arange(b)
        while True:
            # Nodes met for the first time, and once in this step.
            at = rows[: len(live)]
            seen = fresh < 0
            place = np.where(seen, n, fresh)
            seen |= stamp[live[:, None], place] >= 0
            place = np.where(seen, n, fresh)
            marks = serial + np.arange(fresh.shape[1], dtype=np.int32)
            stamp[live[:, None], place] = marks
            seen |= stamp[live[:, None], place] != marks
            stamp[:, n] = -1
            serial += fresh.shape[1]
            safe = np.where(seen, 0, fresh)
            found = np.einsum("bkd,bd->bk", self.vectors[safe], queries[live])
            found[seen] = -np.inf
            all_near = np.concatenate([near[live], found], axis=1)
            all_ids = np.concatenate([ids[live], np.where(seen, -1, fresh)], axis=1)
            all_open = np.concatenate([open_[live], ~seen], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            near[live], ids[live] = all_near[at, best], all_ids[at, best]
            opened = all_open[at, best]
            # The best open ones of each beam, if any, are expanded next.
            order = np.argsort(~opened, axis=1, kind="stable")[:, : min(STEP, beam)]
            chosen = np.take_along_axis(opened, order, axis=1)
            np.put_along_axis(opened, order, False, axis=1)
            open_[live] = opened
            nodes = np.where(chosen, np.take_along_axis(ids[live], order, axis=1), -1)
            go = chosen.any(axis=1)
            if not go.any():
                return ids, near
            live, nodes = live[go], nodes[go]
            fresh = np.where(nodes[:, :, None] < 0, -1, links[np.maximum(nodes, 0)])
            fresh = fresh.reshape(len(live), -1)

    def _descend(self, queries: np.ndarray, down_to: int) -> np.ndarray:
        start = np.full((len(queries), 1), self.entry, np.int32)
        for level in range(self.top, down_to, -1):
            start, _ = self._beam(queries, start, 1, level)
        return start

    def search(self, queries: np.ndarray, beam: int):
        """Ids and cosines of the nearest found with a beam of this width, best first."""
        queries = np.ascontiguousarray(queries, np.float32)
        return self._beam(queries, self._descend(queries, 0), min(beam, len(self.vectors)), 0)

    # Insertion -------------------------------------------------------------------------------

    def _chosen(self, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of each row's candidates (best first): those nearer to the row than to
        any chosen before, and then the nearest of the others."""
        vectors = self.vectors[np.maximum(ids, 0)]
        among = np.einsum("bkd,bld->bkl", vectors, vectors)
        valid = ids >= 0
        taken = np.zeros(ids.shape, bool)
        for k in range(ids.shape[1]):
            closest = np.where(taken, among[:, k], -np.inf).max(axis=1)
            taken[:, k] = valid[:, k] & (near[:, k] > closest) & (taken.sum(axis=1) < most)
        rank = np.where(taken, 0, np.where(valid, 1, 2))
        best = np.argsort(rank, axis=1, kind="stable")[:, :most]
        picked = np.where(
            np.take_along_axis(valid, best, axis=1), np.take_along_axis(ids, best, axis=1), -1
        )
        if picked.shape[1] < most:
            picked = np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=-1)
        return picked

    def _insert(self, new: np.ndarray) -> None:
        queries = self.vectors[new]
        levels = self.levels[new]
        highest = int(levels.max())
        old_top = self.top
        for level in range(len(self.links), highest + 1):
            width = GROUND_LINKS if level == 0 else LINKS
            self.links.append(np.full((len(self.vectors), width), -1, np.int32))
        start = np.full((len(new), 1), self.entry if old_top >= 0 else -1, np.int32)
        for level in range(max(old_top, highest), -1, -1):
            here = levels >= level
            if level <= old_top:
                if (~here).any():
                    start[~here, :1] = self._beam(queries[~here], start[~here, :1], 1, level)[0]
                if here.any():
                    ids, near = self._beam(queries[here], start[here, :1], BUILD_BEAM, level)
                    start[here, :1] = ids[:, :1]
                else:
                    continue
            elif here.any():
                ids = np.full((int(here.sum()), 1), -1, np.int32)
                near = np.full(ids.shape, -np.inf, np.float32)
            else:
                continue
            self._connect(new[here], ids, near, level)
        if highest > old_top:
            self.top, self.entry = highest, int(new[levels.argmax()])

    def _connect(self, nodes: np.ndarray, ids: np.ndarray, near: np.ndarray, level: int) -> None:
        links = self.links[level]
        width = links.shape[1]
        # The batch's own nodes are candidates of each other.
        own = self.vectors[nodes] @ self.vectors[nodes].T
        np.fill_diagonal(own, -np.inf)
        beside = np.argsort(-own, axis=1)[:, : min(width, len(nodes) - 1)]
        ids = np.concatenate([ids, nodes[beside].astype(np.int32)], axis=1)
        near = np.concatenate([near, np.take_along_axis(own, beside, axis=1)], axis=1)
        best = np.argsort(-near, axis=1, kind="stable")[:, : BUILD_BEAM]
        ids, near = np.take_along_axis(ids, best, axis=1), np.take_along_axis(near, best, axis=1)
        picked = self._chosen(ids, near, width)
        links[nodes] = picked
        # And back: each picked node weighs the new ones beside those it has.
        source = np.repeat(nodes, width)[picked.ravel() >= 0]
        target = picked.ravel()[picked.ravel() >= 0]
        if not len(target):
            return
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        counts = np.diff(np.append(first, len(target)))
        place = np.arange(len(target)) - np.repeat(first, counts)
        for low in range(0, len(first), BATCH):
            part = slice(low, low + BATCH)
            ends = target[first[part]]
            added = np.full((len(ends), int(counts[part].max())), -1, np.int32)
            mine = np.repeat(np.arange(len(ends)), counts[part])
            span = slice(first[low], first[low] + int(counts[part].sum()))
            added[mine, place[span]] = source[span]
            both = np.concatenate([links[ends], added], axis=1)
            # A node of the batch may have the other one already.
            twice = (added[:, :, None] == links[ends][:, None, :]) & (added[:, :, None] >= 0)
            both[:, width:][twice.any(axis=2)] = -1
            close = np.einsum("bkd,bd->bk", self.vectors[np.maximum(both, 0)], self.vectors[ends])
            close[both < 0] = -np.inf
            best = np.argsort(-close, axis=1, kind="stable")[:, : 2 * GROUND_LINKS]
            links[ends] = self._chosen(
                np.take_along_axis(both, best, axis=1),
                np.take_along_axis(close, best, axis=1),
                width,
            )
