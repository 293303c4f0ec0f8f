"""A hierarchical navigable small-world graph of unit vectors, as flat arrays of neighbours.

Nodes are numbered by falling level, so a layer holds a prefix of them. Many nodes are inserted, and many
queries answered, in step: each step expands a few nodes of every search at once in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from citylode.llm.scan import mix

DEGREE = 16  # links of a node; twice as many in the lowest layer
BUILD_BEAM = 64
BATCH = 512
EXPAND = 4  # nodes of a search expanded in one step
UPPER_BEAM = 8
SEEN = 1 << 24  # cells of the table of visited nodes
NONE = -1


def node_levels(numbers: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """A level for each node, drawn by its number: the same on every run; each is ``degree`` times rarer than the last."""
    drawn = ((mix(numbers.astype(np.uint64) + np.uint64(0x5851F42D)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return (-np.log(drawn) / np.log(degree)).astype(np.int64)


def unit_sphere(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of any length, divided by the longest and given a coordinate that makes them unit vectors.

    The order of inner products with a query stays, and it is the order of distances.
    """
    scaled = vectors.astype(np.float64) / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.square(scaled).sum(axis=1)))
    return np.concatenate([scaled, rest[:, None]], axis=1).astype(np.float32)


def beam_search(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int, expand: int = EXPAND,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nodes of one layer nearest to each query, as found from its entries: (nodes, products), best first."""
    step = max(1, SEEN // max(1, len(links)))
    parts = [
        searched(vectors, links, queries[i:i + step], entries[i:i + step], beam, expand) for i in range(0, len(queries), step)]
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def searched(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int, expand: int,
) -> tuple[np.ndarray, np.ndarray]:
    n = len(queries)
    seen = np.zeros((n, len(links)), np.int16)  # 1 + the place of a node in the step that met it
    nodes = np.full((n, beam), NONE, np.int32)
    near = np.full((n, beam), -np.inf, np.float32)
    open_ = np.zeros((n, beam), bool)
    active, offered = np.arange(n), entries
    while len(active):
        # Offered nodes that are new, each once.
        r, c = np.nonzero(offered >= 0)
        node = offered[r, c]
        fresh = seen[active[r], node] == 0
        r, c, node = r[fresh], c[fresh], node[fresh]
        seen[active[r], node] = c + 1
        once = seen[active[r], node] == c + 1
        r, c, node = r[once], c[once], node[once]
        score = np.full(offered.shape, -np.inf, np.float32)
        score[r, c] = np.einsum("ij,ij->i", queries[active[r]], vectors[node])
        all_nodes = np.concatenate([nodes[active], offered], axis=1)
        all_near = np.concatenate([near[active], score], axis=1)
        all_open = np.concatenate([open_[active], score > -np.inf], axis=1)
        keep = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        nodes[active] = kept = np.take_along_axis(all_nodes, keep, 1)
        near[active] = best = np.take_along_axis(all_near, keep, 1)
        waiting = np.take_along_axis(all_open, keep, 1)
        # Expand the best of those not yet expanded.
        hope = np.where(waiting, best, -np.inf)
        wide = min(expand, beam)
        pick = np.argpartition(-hope, wide - 1, axis=1)[:, :wide] if wide < beam else np.tile(np.arange(beam), (len(active), 1))
        chosen = np.where(np.take_along_axis(hope, pick, 1) > -np.inf, np.take_along_axis(kept, pick, 1), NONE)
        np.put_along_axis(waiting, pick, False, axis=1)
        open_[active] = waiting
        going = (chosen >= 0).any(axis=1)
        active, chosen = active[going], chosen[going]
        offered = np.where(chosen[:, :, None] >= 0, links[chosen], NONE).reshape(
            len(active), chosen.shape[1] * links.shape[1])
    order = np.argsort(-near, axis=1, kind="stable")
    near = np.take_along_axis(near, order, 1)
    return np.where(near > -np.inf, np.take_along_axis(nodes, order, 1), NONE), near


def diverse(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, degree: int, fill: bool) -> np.ndarray:
    """Of each row's candidates, best first, up to ``degree`` that are nearer to the row than to one taken before.

    With ``fill``, free places go to the best of the others.
    """
    n, width = nodes.shape
    out = np.full((n, degree), NONE, np.int32)
    if not n:
        return out
    there = nodes >= 0
    at = vectors[np.where(there, nodes, 0)]
    between = at @ at.transpose(0, 2, 1)
    closest = np.full((n, width), -np.inf, np.float32)
    taken, count = np.zeros((n, width), bool), np.zeros(n, np.int64)
    for c in range(width):
        good = np.flatnonzero(there[:, c] & (near[:, c] > closest[:, c]) & (count < degree))
        taken[good, c] = True
        count[good] += 1
        closest[good] = np.maximum(closest[good], between[good, c])
    rank = np.argsort(np.where(taken, 0, np.where(there, 1, 2)) * width + np.arange(width), axis=1)[:, :degree]
    allowed = np.take_along_axis(taken | there if fill else taken, rank, 1)
    out[:, :rank.shape[1]] = np.where(allowed, np.take_along_axis(nodes, rank, 1), NONE)
    return out


def top_sorted(nodes: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-near, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1)


@dataclass
class SmallWorld:
    """``links[layer][node]``: the neighbours of a node in a layer, -1 for none; layer 0 holds all nodes."""
    vectors: np.ndarray
    links: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def build(cls, vectors: np.ndarray, levels: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> SmallWorld:
        """The graph of unit vectors ordered by falling level: upper layers first, nodes in growing batches."""
        graph = cls(vectors)
        for layer in range(int(levels.max(initial=0)), -1, -1):
            graph.links.insert(0, np.full(
                (int((levels >= layer).sum()), 2 * degree if layer == 0 else degree), NONE, np.int32))
            size, done = len(graph.links[0]), 0
            while done < size:
                batch = np.arange(done, min(size, done + min(BATCH, max(64, done))))
                graph.insert(batch, degree, beam)
                done += len(batch)
        return graph

    def entries(self, queries: np.ndarray, above: int) -> np.ndarray:
        """Where a search may enter the layer below layer ``above``: from the top downward."""
        found = np.zeros((len(queries), 1), np.int32)
        for layer in range(len(self.links) - 1, above - 1, -1):
            found, _ = beam_search(self.vectors, self.links[layer], queries, found, UPPER_BEAM)
        return found

    def insert(self, batch: np.ndarray, degree: int, beam: int) -> None:
        """Link new nodes of the lowest layer so far with their neighbours, both ways."""
        links, mine = self.links[0], self.vectors[batch]
        among = mine @ mine.T
        np.fill_diagonal(among, -np.inf)
        nodes = np.broadcast_to(batch.astype(np.int32), among.shape)
        nodes, near = top_sorted(nodes, among, min(beam, len(batch) - 1))
        if batch[0]:
            entries = self.entries(mine, 1)
            entries = np.where(entries < batch[0], entries, 0)
            found, product = beam_search(self.vectors, links[:batch[0]], mine, entries, beam)
            nodes, near = top_sorted(np.concatenate([found, nodes], axis=1), np.concatenate([product, near], axis=1), beam)
        for i in range(0, len(batch), 256):
            chosen = diverse(self.vectors, nodes[i:i + 256], near[i:i + 256], degree, fill=True)
            links[batch[i:i + 256], :degree] = chosen
        source, place = np.nonzero(links[batch] >= 0)
        self.link_back(links[batch][source, place], batch[source])

    def link_back(self, owners: np.ndarray, new: np.ndarray) -> None:
        """Add nodes to the lists of their neighbours; lists that grow too long keep diverse ones."""
        links = self.links[0]
        width = links.shape[1]
        listed = (links[owners] == new[:, None]).any(axis=1)
        owners, new = owners[~listed], new[~listed]
        near = np.einsum("ij,ij->i", self.vectors[owners], self.vectors[new])
        order = np.lexsort([-near, owners])
        owners, new = owners[order], new[order]
        names, start, count = np.unique(owners, return_index=True, return_counts=True)
        for i in range(0, len(names), 512):
            name, most = names[i:i + 512], min(width, int(count[i:i + 512].max()))
            place = np.arange(most)
            more = np.where(place < count[i:i + 512, None], new[np.minimum(start[i:i + 512, None] + place, len(new) - 1)], NONE)
            both = np.concatenate([links[name], more.astype(np.int32)], axis=1)
            product = np.where(both >= 0, np.einsum("ij,ikj->ik", self.vectors[name], self.vectors[np.maximum(both, 0)]), -np.inf)
            both, product = top_sorted(both, product, both.shape[1])
            full = (both >= 0).sum(axis=1) > width
            short = both[:, :width]
            kept = np.full((len(name), width), NONE, np.int32)
            kept[:, :short.shape[1]] = short
            kept[full] = diverse(self.vectors, both[full], product[full], width, fill=False)
            links[name] = kept

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Nodes near to each query, best first, -1 where fewer are found."""
        return beam_search(self.vectors, self.links[0], queries, self.entries(queries, 1), beam)[0]
