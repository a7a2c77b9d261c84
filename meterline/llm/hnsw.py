"""A hierarchical navigable small-world graph over the unit vectors of one shard, in numpy.

Searches and insertions run for a block of vectors in step, so that each step is a few array operations.
"""

from __future__ import annotations

import numpy as np

from meterline.llm.common import mixed

#: Links per node and layer, candidates while building, nodes expanded per step, vectors inserted or queried at once.
LINKS, WIDE, EXPAND, BLOCK = 24, 48, 4, 256
#: Rounds in which nodes out of reach are linked again at most.
REPAIRS = 8


def levels(ids: np.ndarray) -> np.ndarray:
    """Geometric levels that follow from the ids."""
    u = (mixed(ids.astype(np.uint64)) >> np.uint64(11)).astype(float) / 2**53
    return np.minimum((-np.log(u + 2.0**-54) / np.log(16)).astype(int), 6)


def search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int, also: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best nodes found for each query (ids, -1: none) and their cosines, best first."""
    b, n = len(queries), len(x)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # the place of "no node"
    rows = np.arange(b)
    ids = np.full((b, width), -1)
    sims = np.full((b, width), -np.inf, np.float32)
    done = np.ones((b, width), bool)
    ids[:, 0] = entry
    sims[:, 0] = np.einsum("bd,bd->b", x[entry], queries)
    done[:, 0] = False
    seen[rows, entry] = True
    if also is not None and width > 1:
        ids[:, 1], done[:, 1] = also, also == entry
        sims[:, 1] = np.where(also == entry, -np.inf, np.einsum("bd,bd->b", x[also], queries))
        ids[:, 1][also == entry] = -1
        seen[rows, also] = True
    active = rows
    step = min(EXPAND, width)
    while len(active):
        open_ = np.where(done[active], -np.inf, sims[active])
        pick = np.argpartition(-open_, step - 1, axis=1)[:, :step] if step < width else np.tile(np.arange(width), (len(active), 1))
        live = np.isfinite(np.take_along_axis(open_, pick, 1))
        node = np.where(live, ids[active[:, None], pick], -1)
        done[active[:, None], pick] = True
        near = np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(active), -1)
        near = np.where(near < 0, n, near)
        new = ~seen[active[:, None], near]
        near = np.where(new, near, n)
        near.sort(axis=1)  # a node that two expanded ones share counts once
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        seen[active[:, None], near] = True
        who, col = np.nonzero(near < n)
        found = np.full(near.shape, -np.inf, np.float32)
        found[who, col] = np.einsum("nd,nd->n", x[near[who, col]], queries[active[who]])
        all_ids = np.concatenate([ids[active], np.where(near < n, near, -1)], 1)
        all_sims = np.concatenate([sims[active], found], 1)
        all_done = np.concatenate([done[active], near >= n], 1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[active] = np.take_along_axis(all_ids, top, 1)
        sims[active] = np.take_along_axis(all_sims, top, 1)
        done[active] = np.take_along_axis(all_done, top, 1)
        active = active[(~done[active]).any(axis=1)]
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def choose(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of candidates (best first) those nearer to the node than to one chosen before; then the nearest of the rest."""
    b, k = ids.shape
    between = np.einsum("bid,bjd->bij", x[ids], x[ids])
    taken = np.zeros((b, k), bool)
    count = np.zeros(b, int)
    for j in range(k):
        good = np.isfinite(sims[:, j]) & (count < most)
        good &= ~(taken & (between[:, j, :] >= sims[:, j, None])).any(axis=1)
        taken[:, j] = good
        count += good
    rank = np.where(taken, 0, 1) * k + np.arange(k)
    rank = np.where(np.isfinite(sims), rank, 3 * k)
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    out[~np.isfinite(np.take_along_axis(sims, order, 1))] = -1
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((b, most - out.shape[1]), -1)], 1)
    return out


class Graph:
    """``layers[l]`` holds, per node, up to ``LINKS`` neighbours among the nodes of level l and more (-1: none)."""

    def __init__(self, x: np.ndarray, level: np.ndarray, layers: list[np.ndarray] | None = None) -> None:
        self.x, self.level = x.astype(np.float32), level
        self.layers: list[np.ndarray] = layers if layers is not None else []
        if layers is None:
            self._build()

    def _build(self) -> None:
        n = len(self.x)
        top = int(self.level.max(initial=0))
        self.layers = [np.full((n, LINKS), -1) for _ in range(top + 1)]
        for layer in range(top, -1, -1):
            above = np.flatnonzero(self.level > layer)
            here = np.flatnonzero(self.level == layer)
            if not len(above):
                above, here = here[:1], here[1:]
                size = len(here)
            else:
                size = len(above)
            for part in np.array_split(above, max(1, -(-len(above) // BLOCK))):
                self._insert(layer, part, first=True)
            at = 0
            while at < len(here):
                part = here[at : at + min(BLOCK, max(16, size + at))]
                self._insert(layer, part)
                at += len(part)
            self._reach_all(layer)

    def _reach_all(self, layer: int) -> None:
        """Nodes that no path from the entry leads to any more get a link from their nearest node that one does.

        A link that makes room may cut off others, so there are a few rounds; what is left is found by searches that
        start at the node itself, and the audit of the callers sees the rest.
        """
        links, member = self.layers[layer], self.level >= layer
        for _ in range(REPAIRS):
            seen = np.zeros(len(links) + 1, bool)
            front = np.flatnonzero(self.level >= len(self.layers) - 1) if layer == len(self.layers) - 1 else np.flatnonzero(self.level > layer)
            front = front[:1] if layer == len(self.layers) - 1 else front
            seen[front] = True
            seen[-1] = True
            while len(front):
                near = np.unique(links[front])
                front = near[~seen[near]]
                seen[front] = True
            lost = np.flatnonzero(member & ~seen[:-1])
            if not len(lost):
                return
            lost, known = lost[:BLOCK], np.flatnonzero(member & seen[:-1])
            nearest = known[(self.x[lost] @ self.x[known].T).argmax(axis=1)]
            into, who = np.unique(nearest, return_index=True)
            room = (links[into] < 0).argmax(axis=1)
            links[into, np.where((links[into] < 0).any(axis=1), room, LINKS - 1)] = lost[who]

    def _entries(self, queries: np.ndarray, layer: int) -> np.ndarray:
        top = len(self.layers) - 1
        tops = np.flatnonzero(self.level >= top)
        entry = tops[(queries @ self.x[tops].T).argmax(axis=1)]
        for upper in range(top, layer, -1):
            entry = search(self.x, self.layers[upper], queries, entry, 8)[0][:, 0]
        return entry

    def _insert(self, layer: int, part: np.ndarray, first: bool = False) -> None:
        links, q = self.layers[layer], self.x[part]
        near = q @ q.T
        np.fill_diagonal(near, -np.inf)
        k = min(WIDE, len(part))
        pick = np.argsort(-near, axis=1)[:, :k]
        ids, sims = part[pick], np.take_along_axis(near, pick, 1)
        if first:
            earlier = np.flatnonzero((links >= 0).any(axis=1))
            if len(earlier):  # nodes of the layers above, few, are compared with one another directly
                more = q @ self.x[earlier].T
                pick = np.argsort(-more, axis=1)[:, :WIDE]
                ids = np.concatenate([ids, earlier[pick]], 1)
                sims = np.concatenate([sims, np.take_along_axis(more, pick, 1)], 1)
        else:
            found, cosines = search(self.x, links, q, self._entries(q, layer), WIDE)
            ids, sims = np.concatenate([ids, found], 1), np.concatenate([sims, cosines], 1)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :WIDE]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        links[part] = choose(self.x, ids, sims, LINKS)
        self._link_back(links, part)

    def _link_back(self, links: np.ndarray, part: np.ndarray) -> None:
        source = np.repeat(part, LINKS)
        target = links[part].ravel()
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        sim = np.einsum("nd,nd->n", self.x[source], self.x[target])
        order = np.lexsort((-sim, target))
        source, target = source[order], target[order]
        nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(begin, count)
        keep = place < LINKS
        added = np.full((len(nodes), LINKS), -1)
        added[np.repeat(np.arange(len(nodes)), count)[keep], place[keep]] = source[keep]
        for s in range(0, len(nodes), BLOCK):
            node = nodes[s : s + BLOCK]
            ids = np.concatenate([links[node], added[s : s + BLOCK]], 1)
            ids.sort(axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.where(ids >= 0, np.einsum("bkd,bd->bk", self.x[ids], self.x[node]), -np.inf)
            order = np.argsort(-sims, axis=1, kind="stable")
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            used = int(np.isfinite(sims).sum(axis=1).max())
            if used <= LINKS:
                links[node] = np.where(np.isfinite(sims), ids, -1)[:, :LINKS]
            else:
                links[node] = choose(self.x, ids[:, :used], sims[:, :used], LINKS)

    def within(self, queries: np.ndarray, least: float, width: int, own: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) of cosine ``least`` or more that beams of this width find.

        ``own``: the queries are the nodes themselves; each search then starts at its node, too.
        """
        width = min(width, len(self.x))
        hits = [(np.zeros(0, int), np.zeros(0, int))]
        for s in range(0, len(queries), BLOCK):
            q = queries[s : s + BLOCK].astype(np.float32)
            entry = self._entries(q, 0)
            ids, sims = search(self.x, self.layers[0], q, entry, width, np.arange(s, s + len(q)) if own else None)
            who, col = np.nonzero(sims >= least)
            hits.append((who + s, ids[who, col]))
        return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
