"""A cover tree over norm-augmented vectors, searched by inner product.

One more component brings all vectors to the same length, so that a greater inner product with a query is a smaller distance to it.
On every level each vector lies within the level's radius of a centre, centres are further apart than that, and a node's first child has
the node's own centre. A node stores how far its vectors really lie from its centre. With the distance of a query to the centre that
bounds, from above and below, the inner products of all its vectors.
"""
from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np

#: The radius of a level over that of the level above; vectors below which a node is not split; centres tried at once.
STEP, LEAF, TRIED = 0.6, 24, 64
#: Vectors of small leaves verified at once.
PACK = 512


class Asked(NamedTuple):
    """What is asked: for each unit the ``k`` best vectors of inner product ``low`` to ``high`` with its query."""

    query: np.ndarray   # of each unit, a row of the queries
    low: np.ndarray
    high: np.ndarray
    label: np.ndarray   # of each unit
    own: np.ndarray     # an id that is no answer
    same: bool          # answers have the unit's label, or another one
    k: int


class CoverTree:
    """Over vectors with ids and labels. Inner products are exact for whole numbers whose products stay below 2^53."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int = LEAF) -> None:
        self.ids, self.labels, self.x, self.leaf = ids, labels, np.ascontiguousarray(x, dtype=np.float64), leaf
        squares = np.einsum("ij,ij->i", self.x, self.x)
        self.square = float(squares.max(initial=0.0))
        # the augmented vectors; all of them have the squared length ``square``
        self.points = np.hstack([self.x, np.sqrt(np.maximum(0.0, self.square - squares))[:, None]])
        # what rounding may do to a squared distance
        self.slack = 1e-9 * self.square + 1e-6
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.level: list[float] = []       # the radius that the level allows
        self.children: list[np.ndarray] = []
        self.members: list[np.ndarray | None] = []  # the vectors of a leaf
        if len(ids):
            self._build()

    def _distances(self, rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
        squared = 2 * (self.square - self.points[rows] @ self.points[centres].T)
        return np.sqrt(np.maximum(0.0, squared))

    def _node(self, centre: int, far: float, level: float) -> int:
        self.centre.append(centre)
        self.radius.append(far)
        self.level.append(level)
        self.children.append(np.zeros(0, dtype=np.int64))
        self.members.append(None)
        return len(self.centre) - 1

    def _build(self) -> None:
        every = np.arange(len(self.ids))
        away = self._distances(every, np.array([0]))[:, 0]
        waiting = [(self._node(0, float(away.max()), float(away.max())), every, away)]
        least = np.sqrt(4 * self.slack)
        while waiting:
            node, rows, away = waiting.pop()
            if len(rows) <= self.leaf or self.radius[node] <= least:
                self.members[node] = rows
                continue
            level = min(self.level[node], self.radius[node]) * STEP
            own = []
            for centre, covered, far in self._covered(self.centre[node], rows, away, level):
                child = self._node(centre, float(far.max()), level)
                own.append(child)
                waiting.append((child, covered, far))
            self.children[node] = np.array(own)

    def _covered(self, first: int, rows: np.ndarray, away: np.ndarray, level: float):
        """Centres among ``rows``, further than ``level`` apart, with the rows that each covers and their distances; ``first`` is one."""
        near = away <= level
        near[rows == first] = True
        yield first, rows[near], away[near]
        rows = rows[~near]
        while len(rows):
            tried = rows[:TRIED]
            among = self._distances(tried, tried)
            centres: list[int] = []
            for i in range(len(tried)):
                if not centres or among[i, centres].min() > level:
                    centres.append(i)
            far = self._distances(rows, tried[centres])
            far[centres, np.arange(len(centres))] = 0.0
            nearest = far.argmin(axis=1)
            distance = far[np.arange(len(rows)), nearest]
            near = distance <= level
            for j, i in enumerate(centres):
                of = near & (nearest == j)
                yield int(tried[i]), rows[of], distance[of]
            rows = rows[~near]

    def search(self, queries: np.ndarray, asked: Asked) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each unit the places of its answers and their inner products, best first, ties by smaller id.

        Units descend side by side. The node with the greatest product that any unit may still find in it is opened first; a unit leaves
        out nodes that lie above or below its bounds, and those that cannot beat the ``k`` answers it has.
        """
        n = len(asked.query)
        best = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in range(n)]
        if not n or not len(self.ids):
            return best
        self.opened = 0
        centre, radius = np.array(self.centre), np.array(self.radius)
        low, squares = asked.low.astype(np.float64).copy(), np.einsum("ij,ij->i", queries, queries)
        whole = (squares + self.square)[:, None]
        slack = (1e-9 * whole + 1e-6)

        def bounds(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of each query and node: the greatest and the least inner product that its vectors may have."""
            squared = np.maximum(0.0, whole - 2 * (queries @ self.x[centre[nodes]].T))
            apart = np.sqrt(squared)
            near = np.maximum(0.0, apart - radius[nodes] - 1e-9 * apart)
            far = apart + radius[nodes] * (1 + 1e-9)
            return (whole - near * near) / 2 + slack, (whole - far * far) / 2 - slack

        def verify(rows: np.ndarray, units: np.ndarray) -> None:
            """Exact products of these vectors for the units that may need them."""
            own, place = np.unique(asked.query[units], return_inverse=True)
            product = queries[own] @ self.x[rows].T
            for u, p in zip(units.tolist(), place.tolist()):
                hit = np.flatnonzero((product[p] >= low[u]) & (product[p] <= asked.high[u]))
                if not len(hit):
                    continue
                hit = hit[((self.labels[rows[hit]] == asked.label[u]) == asked.same) & (self.ids[rows[hit]] != asked.own[u])]
                if not len(hit):
                    continue
                found = np.concatenate([best[u][0], rows[hit]])
                scores = np.concatenate([best[u][1], product[p][hit]])
                if len(found) > 4 * asked.k:
                    least = np.partition(scores, len(scores) - asked.k)[len(scores) - asked.k]
                    found, scores = found[scores >= least], scores[scores >= least]
                order = np.lexsort((self.ids[found], -scores))[:asked.k]
                best[u] = found[order], scores[order]
                if len(order) == asked.k:
                    # equals may still win by their id
                    low[u] = max(low[u], best[u][1][-1])

        root = np.zeros(1, dtype=np.int64)
        upper, lower = bounds(root)
        number = 0
        # (minus the greatest product, number, nodes, upper and lower bounds by unit): one node to open, or many small leaves to verify
        waiting = [(-np.inf, number, root, upper[asked.query], lower[asked.query])]
        while waiting:
            _, _, nodes, upper, lower = heapq.heappop(waiting)
            alive = (upper >= low[:, None]) & (lower <= asked.high[:, None])
            units = np.flatnonzero(alive.any(axis=1))
            if not len(units):
                continue
            if self.members[nodes[0]] is not None:
                some = nodes[alive.any(axis=0)]
                self.opened += len(some)
                verify(np.concatenate([self.members[i] for i in some]), units)
                continue
            children = self.children[nodes[0]]
            self.opened += 1
            upper, lower = bounds(children)
            upper, lower = upper[asked.query], lower[asked.query]
            # units that left this node out leave its children out
            gone = np.ones(n, dtype=bool)
            gone[units] = False
            upper[gone] = -np.inf
            alive = (upper >= low[:, None]) & (lower <= asked.high[:, None])
            most = np.where(alive, np.minimum(upper, asked.high[:, None]), -np.inf).max(axis=0)
            leaves = np.array([self.members[i] is not None for i in children])
            order = np.argsort(-most, kind="stable")
            order = order[most[order] > -np.inf]
            small = order[leaves[order]]
            vectors = np.cumsum([len(self.members[i]) for i in children[small]], dtype=np.int64)
            packs = np.split(small, np.flatnonzero(np.diff(vectors // PACK)) + 1)
            groups = [order[i:i + 1] for i in np.flatnonzero(~leaves[order])] + packs
            for own in groups:
                if len(own):
                    number += 1
                    heapq.heappush(waiting, (-most[own[0]], number, children[own], upper[:, own], lower[:, own]))
        return best
