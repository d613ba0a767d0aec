"""A hierarchical navigable small-world graph (Malkov and Yashunin, 2016) in numpy: many queries step together."""

from __future__ import annotations

import numpy as np


class Layer:
    """One layer's graph over the first ``size`` of the points, grown batch by batch."""

    def __init__(self, points: np.ndarray, size: int, degree: int):
        self.points, self.size, self.degree = points, size, degree
        self.links = np.full((size, degree), -1, np.int32)
        self.done = 0

    def search(self, queries: np.ndarray, entries: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` points found for each query, with similarities, best first; -1 where fewer were found.
        Each step expands the ``wide`` best points of every beam that hasn't been expanded whole."""
        n, live = len(queries), np.arange(len(queries))
        ids = np.full((n, beam), -1, np.int32)
        sims = np.full((n, beam), -np.inf, np.float32)
        opened = np.ones((n, beam), bool)
        seen = np.zeros((n, self.done), bool)
        entries = entries[:, :beam]
        seen[live[:, None], np.maximum(entries, 0)] |= entries >= 0
        width = entries.shape[1]
        ids[:, :width] = entries
        sims[:, :width] = np.where(entries >= 0, np.einsum("nwd,nd->nw", self.points[np.maximum(entries, 0)], queries), -np.inf)
        opened[:, :width] = entries < 0
        while len(live):
            score = np.where(opened[live], -np.inf, sims[live])
            pick = np.argpartition(-score, min(wide, beam) - 1, axis=1)[:, :wide]
            ok = np.take_along_axis(score, pick, 1) > -np.inf
            going = ok.any(1)
            live, pick, ok = live[going], pick[going], ok[going]
            if not len(live):
                break
            opened[live[:, None], pick] = True
            near = self.links[np.where(ok, ids[live[:, None], pick], 0)]
            near = np.where(ok[:, :, None] & (near >= 0), near, -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            fresh &= ~seen[live[:, None], np.maximum(near, 0)]
            rows, cols = np.nonzero(fresh)
            found = near[rows, cols]
            seen[live[rows], found] = True
            got = np.full(near.shape, -np.inf, np.float32)
            got[rows, cols] = np.einsum("nd,nd->n", self.points[found], queries[live[rows]])
            all_ids = np.concatenate([ids[live], near], 1)
            all_sims = np.concatenate([sims[live], got], 1)
            all_open = np.concatenate([opened[live], ~fresh], 1)
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live], sims[live], opened[live] = (np.take_along_axis(x, keep, 1) for x in (all_ids, all_sims, all_open))
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        return np.where(sims > -np.inf, ids, -1), sims

    def _spread(self, base: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
        """Of each row's candidates, best first, those nearer to the row's point than to any chosen before; places left
        go to the best of the others, so that dense groups stay tied together and to the rest."""
        vectors = self.points[np.maximum(ids, 0)]
        between = np.einsum("nad,nbd->nab", vectors, vectors)
        chosen = np.zeros(ids.shape, bool)
        count = np.zeros(len(ids), np.int64)
        worst = np.full(ids.shape, -np.inf, np.float32)  # the greatest similarity to one chosen
        for j in range(ids.shape[1]):
            take = (ids[:, j] >= 0) & (worst[:, j] < sims[:, j]) & (count < degree)
            chosen[take, j] = True
            count += take
            worst = np.where(take[:, None], np.maximum(worst, between[:, j]), worst)
        rank = np.where(chosen, 0, 1) * ids.shape[1] + np.arange(ids.shape[1])
        rank = np.where(ids >= 0, rank, 10 * ids.shape[1])
        order = np.argsort(rank, axis=1, kind="stable")[:, :degree]
        return np.where(np.take_along_axis(ids, order, 1) >= 0, np.take_along_axis(ids, order, 1), -1)

    def _link_back(self, sources: np.ndarray, targets: np.ndarray) -> None:
        """Adds links target -> source and prunes rows that grow too long."""
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        starts = np.flatnonzero(np.r_[True, targets[1:] != targets[:-1]])
        owners, counts = targets[starts], np.diff(np.r_[starts, len(targets)])
        for at in range(0, len(owners), 512):
            own, number = owners[at : at + 512], np.minimum(counts[at : at + 512], 4 * self.degree)
            width = int(number.max())
            extra = np.full((len(own), width), -1, np.int32)
            for k in range(width):
                have = number > k
                extra[have, k] = sources[starts[at : at + 512][have] + k]
            ids = np.sort(np.concatenate([self.links[own], extra], 1), axis=1)[:, ::-1]
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.where(ids >= 0, np.einsum("nwd,nd->nw", self.points[np.maximum(ids, 0)], self.points[own]), -np.inf)
            order2 = np.argsort(-sims, axis=1, kind="stable")
            self.links[own] = self._spread(own, np.take_along_axis(ids, order2, 1), np.take_along_axis(sims, order2, 1), self.degree)

    def grow(self, upper: Layer | None, beam: int) -> None:
        while self.done < self.size:
            start = self.done
            stop = min(self.size, start + min(512, max(64, start)))
            new = np.arange(start, stop)
            x = self.points[new]
            own = x @ x.T
            np.fill_diagonal(own, -np.inf)
            k = min(beam, len(new) - 1)
            inner = np.argpartition(-own, max(0, k - 1), axis=1)[:, :k] if k > 0 else np.zeros((len(new), 0), np.int64)
            ids, sims = (inner + start).astype(np.int32), np.take_along_axis(own, inner, 1)
            if start:
                at = entries(upper, x, beam) if upper else np.zeros((len(new), 1), np.int32)
                at = np.where(at < start, at, -1)  # the layer above is whole, this one isn't yet
                at[(at < 0).all(1), 0] = 0
                found, near = self.search(x, at, beam)
                ids, sims = np.concatenate([found, ids], 1), np.concatenate([near, sims], 1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
            chosen = self._spread(new, np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1), self.degree // 2)
            self.links[new, : chosen.shape[1]] = chosen
            self.done = stop
            rows, cols = np.nonzero(chosen >= 0)
            self._link_back(new[rows].astype(np.int32), chosen[rows, cols])


def entries(layer: Layer, queries: np.ndarray, beam: int) -> np.ndarray:
    """Where to enter the layer below: the best few of this one, found from the layer above it."""
    above = getattr(layer, "upper", None)
    start = entries(above, queries, beam) if above else np.zeros((len(queries), 1), np.int32)
    return layer.search(queries, start, 4)[0]


class Graph:
    """Layers over unit vectors, each a ``1 / shrink`` part of the one below; points stand in random order, so a
    layer holds the first of them."""

    def __init__(self, points: np.ndarray, degree: int = 32, beam: int = 64, shrink: int = 16):
        self.points = np.ascontiguousarray(points, np.float32)
        sizes = [len(points)]
        while sizes[-1] > 4 * shrink:
            sizes.append(-(-sizes[-1] // shrink))
        upper = None
        for depth, size in reversed(list(enumerate(sizes))):
            layer = Layer(self.points, size, degree if depth == 0 else degree // 2)
            layer.upper = upper
            layer.grow(upper, beam)
            upper = layer
        self.bottom = upper

    @classmethod
    def restored(cls, points: np.ndarray, links: list[np.ndarray]) -> Graph:
        """From points and the links of each layer, the bottom one first."""
        self = cls.__new__(cls)
        self.points, upper = np.ascontiguousarray(points, np.float32), None
        for own in reversed(links):
            layer = Layer(self.points, *own.shape)
            layer.links, layer.done, layer.upper = own, len(own), upper
            upper = layer
        self.bottom = upper
        return self

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        queries = np.asarray(queries, np.float32)
        upper = self.bottom.upper
        start = entries(upper, queries, beam) if upper else np.zeros((len(queries), 1), np.int32)
        return self.bottom.search(queries, start, min(beam, len(self.points)))
