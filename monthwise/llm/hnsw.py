"""Hierarchical navigable small-world graphs over unit vectors, in numpy.

Searches run many queries in step: each step expands the best open nodes of every
query, so the work is a few large array operations.  Layers are built from the top;
a layer takes its nodes in batches, which search what is there and compare with
each other, and neighbours are chosen for spread (a candidate is dropped when a
chosen neighbour is closer to it than the node itself).
"""

from __future__ import annotations

import numpy as np

M = 16                          # neighbours in the upper layers; twice as many in the lowest
BEAM_BUILD = 48
BATCH = 256
EXPAND = 2                      # nodes that a query expands in one step


def _sims(x: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.matmul(x[ids], q[:, :, None])[:, :, 0]


def search(x, graph, q, entry, ef):
    """(ids, sims) of the ef best nodes found for each query, best first; -1 pads."""
    n, width = len(q), graph.shape[1]
    seen = np.zeros((n, len(graph)), dtype=bool)
    rows = np.arange(n)[:, None]
    ids = entry
    sims = np.where(ids >= 0, _sims(x, q, ids), -np.inf)
    seen[np.broadcast_to(rows, ids.shape)[ids >= 0], ids[ids >= 0]] = True
    if ids.shape[1] < ef:
        pad = ef - ids.shape[1]
        ids = np.concatenate([ids, np.full((n, pad), -1)], axis=1)
        sims = np.concatenate([sims, np.full((n, pad), -np.inf)], axis=1)
    opened = ids < 0
    live = np.arange(n)
    k = min(EXPAND, ef)
    while len(live):
        score = np.where(opened[live], -np.inf, sims[live])
        pick = np.argpartition(-score, k - 1, axis=1)[:, :k]
        good = np.take_along_axis(score, pick, 1) > -np.inf
        live, pick, good = live[good.any(axis=1)], pick[good.any(axis=1)], good[good.any(axis=1)]
        if not len(live):
            break
        r = live[:, None]
        opened[r, pick] |= good
        near = graph[np.where(good, ids[r, pick], 0)]
        near[~good] = -1
        near = near.reshape(len(live), k * width)
        # a node that two expanded nodes share is taken once
        if k > 1:
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        fresh = (near >= 0) & ~seen[r, near]
        seen[np.broadcast_to(r, near.shape)[fresh], near[fresh]] = True
        s = np.where(fresh, _sims(x, q[live], near), -np.inf).astype(np.float32)
        all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        all_sims = np.concatenate([sims[live], s], axis=1)
        all_open = np.concatenate([opened[live], ~fresh], axis=1)
        top = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
        ids[live] = np.take_along_axis(all_ids, top, 1)
        sims[live] = np.take_along_axis(all_sims, top, 1)
        opened[live] = np.take_along_axis(all_open, top, 1)
    order = np.argsort(-sims, axis=1)
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def spread(x, ids, sims, m):
    """Up to m of each row's candidates (best first), none closer to a chosen one than to the node."""
    n, c = ids.shape
    v = x[np.maximum(ids, 0)]
    among = np.matmul(v, v.transpose(0, 2, 1))
    worst = np.full((n, c), -np.inf, dtype=np.float32)       # nearest chosen one
    chosen = np.zeros((n, c), dtype=bool)
    count = np.zeros(n, dtype=np.int64)
    for j in range(c):
        take = (ids[:, j] >= 0) & (sims[:, j] > worst[:, j]) & (count < m)
        chosen[:, j] = take
        count += take
        worst = np.where(take[:, None], np.maximum(worst, among[:, j]), worst)
    # room left goes to the closest of the others, so that dense groups stay connected
    rest = (ids >= 0) & ~chosen & (sims > -np.inf)
    chosen |= rest & (np.cumsum(rest, axis=1) <= (m - count)[:, None])
    order = np.argsort(~chosen, axis=1, kind="stable")[:, :m]
    out = np.where(np.take_along_axis(chosen, order, 1), np.take_along_axis(ids, order, 1), -1)
    return out if out.shape[1] == m else np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)


def _best(ids, sims, width):
    """Each row's best distinct candidates, sorted."""
    order = np.argsort(ids, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    same = np.zeros(ids.shape, dtype=bool)
    same[:, 1:] = ids[:, 1:] == ids[:, :-1]
    sims = np.where(same | (ids < 0), -np.inf, sims)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    sims = np.take_along_axis(sims, order, 1)
    return np.where(sims > -np.inf, np.take_along_axis(ids, order, 1), -1), sims


class Hnsw:
    """``x``: unit vectors, float32.  Nodes are the rows; layer l holds the first
    ``sizes[l]`` of them (callers give the rows in random order)."""

    def __init__(self, x: np.ndarray, graphs: list[np.ndarray] | None = None):
        self.x = x
        n, sizes = len(x), []
        while n > 0:
            sizes.append(n)
            if n <= 2 * M:
                break
            n //= M
        self.sizes = sizes
        if graphs is None:
            graphs = []
            for layer in range(len(sizes) - 1, -1, -1):
                graphs.insert(0, self._layer(layer, graphs))
        self.graphs = graphs

    def _entry(self, q, layer, graphs, ef=8):
        """Entry nodes into ``layer``, by descent through the layers above."""
        at = np.zeros((len(q), 1), dtype=np.int64)
        for g in reversed(graphs):
            at = search(self.x, g, q, at, ef)[0]
        return at

    def _layer(self, layer, above):
        x, n, m = self.x, self.sizes[layer], M if layer else 2 * M
        graph = np.full((n, m), -1, dtype=np.int64)
        done = 0
        while done < n:
            new = np.arange(done, min(n, done + (BATCH if done else 4 * M)))
            q = x[new]
            within = q @ q.T
            np.fill_diagonal(within, -np.inf)
            k = min(len(new) - 1, m)
            side = np.argsort(-within, axis=1)[:, :k]
            ids, sims = new[side] if k else np.zeros((len(new), 0), np.int64), np.take_along_axis(within, side, 1)
            if done:
                entry = self._entry(q, layer, above)
                entry[entry >= done] = -1
                entry[:, 0] = np.where((entry < 0).all(axis=1), 0, entry[:, 0])
                found, s = search(x, graph[:done], q, entry, BEAM_BUILD)
                ids, sims = np.concatenate([ids, found], axis=1), np.concatenate([sims, s], axis=1)
            if ids.shape[1]:
                ids, sims = _best(ids, sims, BEAM_BUILD)
                graph[new] = spread(x, ids, sims, m)
                self._back(graph, new)
            done = int(new[-1]) + 1
        return self._join(graph)

    @staticmethod
    def _join(graph):
        """Extra columns that make every node reachable from the first: a node that no
        list leads to gets an entry in the list of a reachable neighbour."""
        n = len(graph)
        reached = np.zeros(n, dtype=bool)
        front = np.array([0])
        while True:
            while len(front):
                reached[front] = True
                front = np.unique(graph[front])
                front = front[front >= 0]
                front = front[~reached[front]]
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return graph
            near = graph[lost]
            ok = (near >= 0) & reached[near]
            at = np.where(ok.any(axis=1), near[np.arange(len(lost)), ok.argmax(axis=1)], -1)
            if (at < 0).all():
                at[0] = 0
            lost, at = lost[at >= 0], at[at >= 0]
            order = np.argsort(at, kind="stable")
            lost, at = lost[order], at[order]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            extra = np.full((n, 1), -1, dtype=graph.dtype)       # one column in a round
            extra[at[rank == 0], 0] = lost[rank == 0]
            graph = np.concatenate([graph, extra], axis=1)
            front = lost[rank == 0]

    def _back(self, graph, new):
        """The new nodes as neighbours of their neighbours, those pruned for spread."""
        m = graph.shape[1]
        to = graph[new]
        src = np.repeat(new, m)[to.reshape(-1) >= 0]
        to = to.reshape(-1)[to.reshape(-1) >= 0]
        sim = (self.x[src] * self.x[to]).sum(axis=1)
        order = np.lexsort((-sim, to))
        src, to, sim = src[order], to[order], sim[order]
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, np.int64)
        rank = np.arange(len(to)) - np.repeat(first, np.diff(np.append(first, len(to))))
        keep = rank < m
        src, to, rank, sim = src[keep], to[keep], rank[keep], sim[keep]
        nodes, row = np.unique(to, return_inverse=True)
        if not len(nodes):
            return
        extra = np.full((len(nodes), m), -1, dtype=np.int64)
        extra[row, rank] = src
        ids = np.concatenate([graph[nodes], extra], axis=1)
        free = (ids >= 0).sum(axis=1) <= m              # room for all: nothing to prune
        if free.any():
            order = np.argsort(ids[free] < 0, axis=1, kind="stable")[:, :m]
            graph[nodes[free]] = np.take_along_axis(ids[free], order, 1)
            nodes, ids = nodes[~free], ids[~free]
            if not len(nodes):
                return
        sims = np.where(ids >= 0, _sims(self.x, self.x[nodes], ids), -np.inf)
        ids, sims = _best(ids, sims, m + m // 2)
        graph[nodes] = spread(self.x, ids, sims, m)

    def near(self, q: np.ndarray, threshold: float, ef: int):
        """(query, node) pairs with similarity of at least ``threshold``.  A beam full of
        such nodes is followed on, so their number has no cap."""
        out_q, out_n = [], []
        for lo in range(0, len(q), BATCH):
            some = q[lo:lo + BATCH]
            at = self._entry(some, 0, self.graphs[1:], max(ef, 8))
            ids, sims = search(self.x, self.graphs[0], some, at, max(ef, 8))
            hit = (sims >= threshold) & (ids >= 0)
            full = hit.all(axis=1)
            hit[full] = False
            r, c = np.nonzero(hit)
            out_q.append(r + lo)
            out_n.append(ids[r, c])
            for i in np.flatnonzero(full):
                got = self._region(some[i], ids[i], threshold)
                out_q.append(np.full(len(got), i + lo))
                out_n.append(got)
        return np.concatenate(out_q) if out_q else np.zeros(0, int), np.concatenate(out_n) if out_n else np.zeros(0, int)

    def _region(self, q, start, threshold):
        """All nodes joined to ``start`` over nodes within the threshold."""
        seen = np.zeros(len(self.x), dtype=bool)
        seen[start] = True
        found = [start]
        while len(start):
            near = np.unique(self.graphs[0][start])
            near = near[near >= 0]
            near = near[~seen[near]]
            seen[near] = True
            start = near[self.x[near] @ q >= threshold]
            found.append(start)
        return np.concatenate(found)

    def pack(self) -> bytes:
        import io
        out = io.BytesIO()
        np.savez(out, x=self.x, **{f"g{i}": g.astype(np.int32) for i, g in enumerate(self.graphs)})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Hnsw:
        import io
        with np.load(io.BytesIO(data)) as z:
            return cls(z["x"], [z[f"g{i}"].astype(np.int64) for i in range(len(z.files) - 1)])
