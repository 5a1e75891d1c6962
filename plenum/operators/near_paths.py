"""Betweenness inside one task: the shortest paths from some sources in a part of a network that has a bounded size.

A part is a set of whole components. Where edges have few different lengths, vertices are reached in the order of their
distance, by edges of one length at a time, followed from the vertices at the distance before or back from those not yet
reached; what is met then lies on shortest paths. Otherwise distances come from the edges of the vertices that have come nearer, followed from
their near end or back from the vertices that still can come nearer, whichever are fewer; paths and dependencies from the
edges on shortest paths, found likewise, in the order of distance (Brandes 2001).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd

from plenum.operators.packed import Packed, owners

FAR = np.int64(1) << 62
SUMS = "id bigint, raw double"
# Lengths that a vertex's edges are counted by.
BOUNDS = 32
# So few different lengths are followed one at a time.
FEW_LENGTHS = 12
# Edges worked on at a time, so that what is made of them stays in a processor's cache.
SPAN_EDGES = 1 << 17
# Edges that a task holds while it looks for components.
STAR_ROWS = 2_000_000


def roots(n: int, s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Smallest vertex of each vertex's component, for edges between ``s`` and ``t``."""
    label = np.arange(n)
    while True:
        one, two = label[s], label[t]
        low, new = np.minimum(one, two), label.copy()
        np.minimum.at(new, one, low)
        np.minimum.at(new, two, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


class Component:
    """Directed edges ``src, tgt, w`` of one component in the order of ``tgt`` and ``w``, both directions of each edge.

    The edges into a vertex lead out of it too, so ``src`` is read as either end.
    """

    def __init__(self, n: int, src: np.ndarray, tgt: np.ndarray, w: np.ndarray):
        self.n, self.src, self.tgt, self.w = n, src, tgt, w
        self.start = np.searchsorted(tgt, np.arange(n))
        self.degree = np.diff(np.append(self.start, len(tgt)))
        self.nearest = w[self.start]
        self.bounds, most = np.unique(w), max(1, min(BOUNDS, 2 * len(w) // n))
        self.exact = len(self.bounds) <= most
        if not self.exact:
            self.bounds = np.unique(np.quantile(w, np.linspace(1 / most, 1, most), method="higher"))
        place = tgt * np.int64(len(self.bounds)) + np.searchsorted(self.bounds, w)
        held = np.bincount(place, minlength=n * len(self.bounds)).reshape(n, -1)
        # by vertex: edges of no bound, of the first bound of length, of the first two, ...
        self.upto = np.zeros((n, len(self.bounds) + 1), np.int32)
        np.cumsum(held, axis=1, out=self.upto[:, 1:])

    def short(self, some: np.ndarray, most: np.ndarray) -> np.ndarray:
        """For vertices ``some``, how many of their first edges hold all of length ``most`` or less."""
        bound = np.searchsorted(self.bounds, most, "right")
        return self.upto[some, bound if self.exact else np.minimum(bound + 1, len(self.bounds))]

    def edges_at(self, some: np.ndarray, degree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first ``degree`` edges at the vertices ``some``, and for each the vertex."""
        ends = np.cumsum(degree, dtype=np.int64)
        return np.repeat(self.start[some] - ends + degree, degree) + np.arange(ends[-1] if len(ends) else 0), np.repeat(some, degree)

    def useful(self, d: np.ndarray, front: np.ndarray, less: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Edges ``from, to, length`` among which are all from ``front`` with ``d[from] + length + less <= d[to]``.

        Those of its nearest vertices are followed from there, the others back from the vertices that the next
        distance and their shortest edge allow, as many each way as makes the fewest edges. None if most edges are needed.
        """
        room = d.max() - less - d[front]
        front, room = front[fits := self.nearest[front] <= room], room[fits]
        degree, back = self.short(front, room), front[:0]
        many = int(degree.sum())
        if 8 * many > self.n:
            rising = np.argsort(d[front], kind="stable")
            front, degree = front[rising], degree[rising]
            begin = d - self.nearest - less  # the largest distance from which an edge can be useful
            order = np.argsort(begin)
            behind = np.append(np.cumsum(self.degree[order][::-1])[::-1], 0)
            pulled = behind[np.searchsorted(begin[order], d[front])]
            both = np.append(pulled, 0) + np.append(0, np.cumsum(degree))
            cut = int(np.argmin(both))
            many = int(both[cut])
            if cut < len(front):
                least = d[front[cut]]
                back = np.flatnonzero(begin >= least)
                front, degree = front[:cut], degree[:cut]
        if 3 * many >= len(self.src):
            return None
        out, begin = self.edges_at(front, degree)
        if not len(back):
            return begin, self.src[out], self.w[out]
        into, end = self.edges_at(back, self.short(back, d[back] - less - least))
        # an edge is followed one way only
        seen = np.zeros(self.n, bool)
        seen[front] = True
        fresh = ~seen[self.src[into]]
        into, end = into[fresh], end[fresh]
        return np.concatenate([begin, self.src[into]]), np.concatenate([self.src[out], end]), np.concatenate([self.w[out], self.w[into]])

    def distances(self, at: int) -> np.ndarray:
        d = np.full(self.n, FAR)
        d[at] = 0
        front = np.array([at])
        while len(front):
            some = self.useful(d, front, 1)
            if some is None:
                new = np.minimum(np.minimum.reduceat(d[self.src] + self.w, self.start), d)
                front, d = np.flatnonzero(new < d), new
            else:
                begin, to, length = some
                new = d[begin] + length
                nearer = new < d[to]
                to = to[nearer]
                np.minimum.at(d, to, new[nearer])
                came = np.zeros(self.n, bool)
                came[to] = True
                front = np.flatnonzero(came)
        return d

    def dependencies(self, at: int) -> np.ndarray:
        """What the paths from ``at`` add to each vertex between their ends."""
        d = self.distances(at)
        begin, to, length = self.useful(d, np.arange(self.n), 0) or (self.src, self.tgt, self.w)
        tight = np.flatnonzero(d[begin] + length == d[to])
        a, b = begin[tight], to[tight]
        steps = np.unique(d)
        # the smallest kind of number sorts fastest
        level = np.searchsorted(steps, d).astype(np.min_scalar_type(len(steps)))[b]
        order = np.argsort(level, kind="stable")
        a, b, level = a[order], b[order], level[order]
        cuts = [0, *(np.flatnonzero(level[1:] != level[:-1]) + 1).tolist(), len(a)]
        spans = [slice(x, y) for x, y in zip(cuts, cuts[1:])]
        paths, received = np.zeros(self.n), np.zeros(self.n)
        paths[at] = 1
        for span in spans:
            np.add.at(paths, b[span], paths[a[span]])
        share = paths[a] / paths[b]
        for span in reversed(spans):
            np.add.at(received, a[span], share[span] * (1 + received[b[span]]))
        received[at] = 0
        return received


class Layers:
    """Directed edges of one component by vertex and then length: both directions of each edge, of ``lengths`` in order.

    Those of vertex i and length k lie from ``starts[i * len(lengths) + k]`` to the next start, and lead to ``ends``.
    """

    def __init__(self, n: int, lengths: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.n, self.lengths, self.starts, self.ends = n, lengths.tolist(), starts, ends
        self.degree = np.diff(starts).reshape(n, -1)
        self.all = self.degree.sum(axis=0)
        # long rows are copied as a whole
        self.rows = np.split(ends, starts[1:-1]) if len(ends) >= BOUNDS * len(starts) else None
        self.sums, self.some = np.zeros(n), np.zeros(n)  # zero between uses

    def spans(self, some: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The vertices ``some`` that have edges of length k, how many, and the ends of these, a bounded number at a time."""
        degree = self.degree[some, k]
        if not degree.all():
            held = degree > 0
            some, degree = some[held], degree[held]
        last = np.cumsum(degree)
        many = int(last[-1]) if len(last) else 0
        cuts = [0, *(np.searchsorted(last, np.arange(SPAN_EDGES, many, SPAN_EDGES)) + 1).tolist(), len(some)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                one, held, place = some[a:b], degree[a:b], some[a:b] * len(self.lengths) + k
                if self.rows is not None:
                    near = np.concatenate([self.rows[i] for i in place.tolist()], dtype=np.int64)
                else:
                    upto = np.cumsum(held)
                    near = self.ends[np.repeat(self.starts[place] - upto + held, held) + np.arange(upto[-1])].astype(np.int64)
                yield one, held, near

    def reach(self, at: int) -> tuple[np.ndarray, dict[int, np.ndarray], list]:
        """Number of shortest paths to each vertex from ``at``, the vertices by distance, and for each distance in turn
        the distances before, lengths and ways by which it was met.
        """
        n, sums, some = self.n, self.sums, self.some
        left, paths = np.ones(n, bool), np.zeros(n)
        left[at], paths[at] = False, 1
        fronts, steps, many, open_edges = {0: np.array([at])}, [], n - 1, self.all - self.degree[at]
        waiting = [(w, 0, k) for k, w in enumerate(self.lengths)]
        heapify(waiting)
        while many:
            x, met, came, whole = waiting[0][0], [], [], False
            while waiting and waiting[0][0] == x:
                _, y, k = heappop(waiting)
                front = fronts[y]
                pushed = int(self.degree[front, k].sum())
                if not pushed or not open_edges[k]:
                    continue
                back = int(open_edges[k]) + n // 8 < pushed
                met.append((y, k, back))
                if back:
                    some[front], whole = paths[front], True
                    for one, held, near in self.spans(np.flatnonzero(left), k):
                        sums[one] += np.add.reduceat(some[near], np.cumsum(held) - held)
                    some[front] = 0
                    continue
                for one, held, near in self.spans(front, k):
                    sent = np.repeat(paths[one], held)
                    if 4 * len(near) > n:
                        sums += np.bincount(near, sent, n)
                        whole = True
                    else:
                        fresh = left[near]
                        came.append(near[fresh])
                        np.add.at(sums, came[-1], sent[fresh])
            if whole:
                sums *= left
                new = np.flatnonzero(sums)
                paths[new] = sums[new]
                sums[:] = 0
            else:
                new = np.unique(np.concatenate(came)) if came else np.array([], np.int64)
                paths[new] = sums[new]
                sums[new] = 0
            if len(new):
                left[new] = False
                many -= len(new)
                open_edges = open_edges - self.degree[new].sum(axis=0)
                fronts[x] = new
                steps.append((x, met))
                for k, w in enumerate(self.lengths):
                    heappush(waiting, (x + w, x, k))
        return paths, fronts, steps

    def dependencies(self, at: int) -> np.ndarray:
        """What the paths from ``at`` add to each vertex between their ends."""
        n, sums, some = self.n, self.sums, self.some
        paths, fronts, steps = self.reach(at)
        received = np.zeros(n)
        for x, met in reversed(steps):
            new = fronts[x]
            some[new] = (1 + received[new]) / paths[new]
            for y, k, back in met:
                front = fronts[y]
                if not back:
                    for one, held, near in self.spans(front, k):
                        received[one] += paths[one] * np.add.reduceat(some[near], np.cumsum(held) - held)
                    continue
                for one, held, near in self.spans(new, k):
                    sent = np.repeat(some[one], held)
                    if 4 * len(near) > n:
                        sums += np.bincount(near, sent, n)
                    else:
                        np.add.at(sums, near, sent)
                received[front] += paths[front] * sums[front]
                sums[:] = 0
            some[new] = 0
        received[at] = 0
        return received


def _component(n: int, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> Layers | Component:
    """One component from the edges of each vertex in the order of length; ``lengths[codes]`` are theirs."""
    used = np.flatnonzero(np.bincount(codes, minlength=len(lengths))) if len(lengths) <= FEW_LENGTHS else np.unique(codes)
    if not in_layers(len(used), n, len(ends)):
        return Component(n, ends, owners(starts, 0, len(ends)), lengths[codes])
    place = np.zeros(len(lengths), np.int64)
    place[used] = np.arange(len(used))
    held = np.zeros(n * len(used), np.int64)
    for a in range(0, len(ends), STAR_ROWS):
        b = min(len(ends), a + STAR_ROWS)
        held += np.bincount(owners(starts, a, b) * len(used) + place[codes[a:b]], minlength=len(held))
    return Layers(n, lengths[used], np.append(0, np.cumsum(held)), ends)


def in_layers(lengths, n, edges):
    """Whether a component is walked by length: its lengths are few, and few beside its edges; numbers or columns."""
    return (lengths <= FEW_LENGTHS) & ((4 * lengths * n <= edges) | (edges <= STAR_ROWS))


def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges ``u, v`` between the same vertices as those of ``batches`` that link the same, at most one per vertex.

    At most some ``STAR_ROWS`` are held; if these are of as many vertices, they go out and others are begun.
    """
    held, size = [], 0
    for batch in batches:
        held.append(batch.to_numpy(np.int64))
        size += len(batch)
        if size >= STAR_ROWS:
            held = [_star(np.concatenate(held))]
            size = len(held[0])
            if 2 * size >= STAR_ROWS:
                yield pd.DataFrame(held.pop(), columns=["u", "v"])
                size = 0
    if held:
        yield pd.DataFrame(_star(np.concatenate(held)), columns=["u", "v"])


def _star(ends: np.ndarray) -> np.ndarray:
    """Each vertex but the smallest of its component next to that one; a vertex alone next to itself."""
    ids, place = np.unique(ends, return_inverse=True)
    place = place.reshape(ends.shape)
    root = roots(len(ids), place[:, 0], place[:, 1])
    outer = (root != np.arange(len(ids))) | (np.bincount(root, minlength=len(ids)) == 1)
    return np.column_stack([ids[root], ids])[outer]


def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``id, component`` of all ends of the edges ``u, v``."""
    held = [batch.to_numpy(np.int64) for batch in batches]
    if held:
        ids, place = np.unique(np.concatenate(held), return_inverse=True)
        place = place.reshape(-1, 2)
        yield pd.DataFrame({"id": ids, "component": ids[roots(len(ids), place[:, 0], place[:, 1])]})


def summed_dependencies(rows: Iterable[bytes], sources: Iterable[bytes], single: bool) -> pd.DataFrame:
    """``id, raw`` of ``sources``, numbers of 64 bits as bytes, from the packed edges of whole components, or of a ``single`` one."""
    chosen = np.unique(np.frombuffer(b"".join(sources), np.int64))
    if not len(chosen):
        return pd.DataFrame({"id": np.array([], np.int64), "raw": np.array([], float)})
    net = Packed(rows)
    n, by_root, place, root = len(net.ids), None, None, np.zeros(len(net.ids), np.int64)
    if not single:
        u, v = (np.concatenate(x) for x in zip(*((u, v) for u, v, _ in net.edges())))
        root = roots(n, u, v)
        by_root = np.argsort(root, kind="stable")
        place = np.empty(n, np.int64)
        place[by_root] = np.arange(n)
        root = root[by_root]
    starts, ends, codes = net.both_ways(place)
    ends = ends.astype(np.int32) if n < 1 << 31 else ends
    at = np.searchsorted(net.ids, chosen)
    raw, here, lo, hi, part = np.zeros(n), -1, 0, 0, None
    for at in np.sort(at if place is None else place[at]).tolist():
        if root[at] != here:
            here = root[at]
            lo, hi = np.searchsorted(root, [here, here + 1]).tolist()
            a, b = starts[[lo, hi]].tolist()
            # a smaller component's edges are few: a single one's aren't copied
            near = ends[a:b] - lo if lo else ends[a:b]
            part = _component(hi - lo, starts[lo:hi + 1] - a, near, codes[a:b], net.weights) if hi - lo > 2 else None
        if part is not None:
            raw[lo:hi] += part.dependencies(at - lo)
    some = np.flatnonzero(raw)
    return pd.DataFrame({"id": net.ids[some if by_root is None else by_root[some]], "raw": raw[some]})
