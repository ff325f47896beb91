"""A hierarchical navigable small-world graph over unit vectors, in flat neighbour arrays.

Level 0 holds every node, each further level a random share of the one below.  Nodes are kept in
descending order of their top level, so level l is the first ``sizes[l]`` nodes and its links are
one array of ``sizes[l]`` rows, -1 where a node has fewer.  Nodes are inserted and searched in
batches: one step of a batch looks at the links of the nearest open node of each of its searches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Links a node on the upper levels; twice as many on level 0.
DEGREE = 16
#: Width of the search beam while building, and while searching.
BUILD_BEAM, SEARCH_BEAM = 64, 256
BATCH = 512
SEED = 20240301


@dataclass(frozen=True)
class Graph:
    """The nodes' place in the input, their unit vectors, and the links of every level."""

    order: np.ndarray
    vectors: np.ndarray
    links: list[np.ndarray]


def _nearest(vectors, links, queries, entries, beam):
    """(similarities, nodes) of the ``beam`` nearest nodes found from the entries, best first.

    Places that no node was found for hold -inf and -1.
    """
    count, size = len(queries), len(links)
    rows = np.arange(count)[:, None]
    seen = np.zeros((count, size + 1), bool)  # the last column takes the missing links
    seen[:, size] = True
    seen[rows, entries] = True
    nodes = np.full((count, beam), -1, np.int32)
    near = np.full((count, beam), -np.inf, np.float32)
    width = min(beam, entries.shape[1])
    first = np.einsum("qkd,qd->qk", vectors[entries], queries)
    first[entries < 0] = -np.inf
    best = np.argsort(-first, axis=1, kind="stable")[:, :width]
    nodes[:, :width] = np.take_along_axis(entries, best, 1)
    near[:, :width] = np.take_along_axis(first, best, 1)
    nodes[near == -np.inf] = -1
    closed = nodes < 0
    active = np.flatnonzero(~closed.all(axis=1))
    while len(active):
        step = closed[active].argmin(axis=1)  # the best open one: beams are sorted
        closed[active, step] = True
        found = links[nodes[active, step]]
        fresh = ~seen[active[:, None], found]
        seen[active[:, None], found] = True
        at, column = np.nonzero(fresh)
        sims = np.full(found.shape, -np.inf, np.float32)
        sims[at, column] = np.einsum("kd,kd->k", vectors[found[at, column]], queries[active[at]])
        sims[sims <= near[active, -1:]] = -np.inf
        grown = np.flatnonzero((sims > -np.inf).any(axis=1))
        if len(grown):
            mine = active[grown]
            all_near = np.concatenate([near[mine], sims[grown]], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            near[mine] = np.take_along_axis(all_near, best, 1)
            nodes[mine] = np.take_along_axis(np.concatenate([nodes[mine], found[grown]], axis=1), best, 1)
            open_ones = np.zeros(found[grown].shape, bool)
            closed[mine] = np.take_along_axis(np.concatenate([closed[mine], open_ones], axis=1), best, 1)
            closed[mine] |= near[mine] == -np.inf
        active = active[~closed[active].all(axis=1)]
    nodes[near == -np.inf] = -1
    return near, nodes


def _diverse(vectors, near, nodes, keep):
    """Of candidates sorted by similarity, up to ``keep`` a row that no kept one is nearer to.

    What room is left goes to the nearest of the others.
    """
    count, width = nodes.shape
    chosen = np.zeros((count, width), bool)
    for low in range(0, count, 256):
        part = slice(low, low + 256)
        points = vectors[nodes[part]]
        between = points @ points.transpose(0, 2, 1)
        taken, there = chosen[part], nodes[part] >= 0
        closest = np.full(taken.shape, -np.inf, np.float32)  # to any kept candidate
        for k in range(width):
            free = there[:, k] & (closest[:, k] < near[part, k]) & (taken.sum(axis=1) < keep)
            taken[:, k] = free
            closest = np.where(free[:, None], np.maximum(closest, between[:, k]), closest)
    rank = np.where(chosen, 0, np.where(nodes >= 0, 1, 2))
    best = np.argsort(rank, axis=1, kind="stable")[:, :keep]
    found = np.take_along_axis(nodes, best, 1)
    return found


def _link_back(vectors, links, nodes, found):
    """Add each node to the links of those it chose; where a list overflows, choose anew."""
    rows, columns = np.nonzero(found >= 0)
    to, new = found[rows, columns], nodes[rows]
    order = np.argsort(to, kind="stable")
    to, new = to[order], new[order]
    head = np.flatnonzero(np.diff(to, prepend=-1))
    counts = np.diff(np.append(head, len(to)))
    keep = links.shape[1]
    for low in range(0, len(head), 2048):
        mine, many = to[head[low:low + 2048]], counts[low:low + 2048]
        width = int(many.max())
        place = head[low:low + 2048, None] + np.arange(width)
        extra = np.where(np.arange(width) < many[:, None], new[np.minimum(place, len(new) - 1)], -1)
        extra[(extra[:, :, None] == links[mine][:, None, :]).any(axis=2)] = -1  # chose each other
        pool = np.concatenate([links[mine], extra], axis=1)
        used = (pool >= 0).sum(axis=1)
        full = used > keep
        fits = np.argsort(pool[~full] < 0, axis=1, kind="stable")[:, :keep]
        links[mine[~full]] = np.take_along_axis(pool[~full], fits, 1)
        if full.any():
            pool = pool[full]
            near = np.einsum("nkd,nd->nk", vectors[pool], vectors[mine[full]])
            near[pool < 0] = -np.inf
            best = np.argsort(-near, axis=1, kind="stable")
            best = best[:, :int(used[full].max())]
            links[mine[full]] = _diverse(
                vectors, np.take_along_axis(near, best, 1), np.take_along_axis(pool, best, 1), keep
            )


def _descend(graph_links, vectors, queries, top, level):
    """Entry points on a level: the nearest nodes found on the levels above it."""
    entries = np.zeros((len(queries), 1), np.int32)
    for above in range(top, level, -1):
        _, nodes = _nearest(vectors, graph_links[above], queries, entries, 4)
        entries = nodes
    return entries


def build(vectors: np.ndarray) -> Graph:
    """The graph of unit vectors (float32, one a row)."""
    count = len(vectors)
    random = np.random.default_rng(SEED)
    level = (-np.log(1 - random.random(count)) / np.log(DEGREE)).astype(int)
    order = np.argsort(-level, kind="stable")
    vectors, level = np.ascontiguousarray(vectors[order]), level[order]
    top = int(level[0]) if count else 0
    sizes = [int((level >= k).sum()) for k in range(top + 1)]
    links = [np.full((n, DEGREE * (1 if k else 2)), -1, np.int32) for k, n in enumerate(sizes)]
    begin = 0
    while begin < count:
        end = min(count, begin + min(BATCH, max(1, begin // 4)))
        # A batch lies within one top level, so that all of it is inserted on the same levels.
        end = int(min(end, sizes[level[begin]]))
        batch = np.arange(begin, end, dtype=np.int32)
        queries = vectors[begin:end]
        among = queries @ queries.T
        np.fill_diagonal(among, -np.inf)
        entries = _descend(links, vectors, queries, top, level[begin])
        for k in range(int(level[begin]), -1, -1):
            keep = DEGREE
            if begin:
                near, nodes = _nearest(vectors, links[k], queries, entries, BUILD_BEAM)
                entries = nodes[:, :4]
            else:
                near, nodes = np.zeros((len(batch), 0), np.float32), np.zeros((len(batch), 0), np.int32)
            own = np.argsort(-among, axis=1, kind="stable")[:, :BUILD_BEAM // 2]
            near = np.concatenate([near, np.take_along_axis(among, own, 1)], axis=1)
            nodes = np.concatenate([nodes, batch[own]], axis=1)
            nodes[near == -np.inf] = -1
            best = np.argsort(-near, axis=1, kind="stable")[:, :BUILD_BEAM]
            near, nodes = np.take_along_axis(near, best, 1), np.take_along_axis(nodes, best, 1)
            chosen = _diverse(vectors, near, nodes, keep)
            links[k][begin:end, :chosen.shape[1]] = chosen
            _link_back(vectors, links[k], batch, chosen)
        begin = end
    return Graph(order, vectors, links)


def search(graph: Graph, queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
    """Places in the input of the ``beam`` nearest found, best first, -1 where there are fewer."""
    if not len(graph.vectors):
        return np.full((len(queries), beam), -1)
    top = len(graph.links) - 1
    found = []
    for low in range(0, len(queries), BATCH):
        part = queries[low:low + BATCH]
        entries = _descend(graph.links, graph.vectors, part, top, 0)
        _, nodes = _nearest(graph.vectors, graph.links[0], part, entries, beam)
        found.append(np.where(nodes >= 0, graph.order[nodes], -1))
    return np.concatenate(found) if found else np.zeros((0, beam), int)
