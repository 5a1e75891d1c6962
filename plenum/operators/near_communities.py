"""Communities inside one task, of whole components whose weights and their products fit 64 bits."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd

from plenum.operators.packed import Packed, owners

# Communities that every vertex's weights are kept towards, and edges worked on at a time.
FEW_LABELS, SPAN_EDGES = 64, 1 << 22
# The fewest and the most vertices that are looked at together.
LEAST, MOST = 8, 4096


def descend(starts, ends, weights, strength, home, scale: int, cost: int) -> bool:
    """Move vertices one after the other until none gains; ``home`` changes with each move. Whether any has moved.

    The edges of vertex i, without self-loops, lie from ``starts[i]`` to ``starts[i + 1]``. A vertex goes where it gains most,
    of equal gains to the smallest label, if it gains by going at all.
    """
    towards, total = np.zeros(len(home), np.int64), np.zeros(len(home), np.int64)
    np.add.at(total, home, strength)
    places, strengths = starts.tolist(), strength.tolist()
    positive = not len(weights) or weights.min() > 0
    some = [i for i in range(len(home)) if places[i] < places[i + 1]]
    ever, moving = False, True
    while moving:
        moving = False
        for i in some:
            a, b = places[i], places[i + 1]
            label = home[ends[a:b]]
            np.add.at(towards, label, weights[a:b].astype(np.int64))
            here, k = home[i], strengths[i]
            total[here] -= k
            stay = scale * towards[here] - cost * k * total[here]
            gain = scale * towards[label] - cost * k * total[label]
            if not positive:  # no edge leads there if the weights come to nothing
                gain[towards[label] == 0] = stay
            best = gain.max()
            towards[label] = 0
            if best > stay:
                here = home[i] = label[gain == best].min()
                moving = ever = True
            total[here] += k
        labels = np.unique(home) if moving else home
        if moving and len(labels) <= FEW_LABELS and 2 * len(labels) * len(home) <= max(len(ends), SPAN_EDGES):
            _descend_few(starts, ends, weights, strength, home, labels, total, scale, cost)
            return True
    return ever


def _descend_few(starts, ends, weights, strength, home, labels, total, scale: int, cost: int) -> None:
    """The same moves where there are few ``labels``: each vertex's weights towards them are kept, and changed by the
    edges of those that move, so that those that stay are looked at many at a time.
    """
    n, many = len(home), len(labels)
    label, total, price = np.searchsorted(labels, home), total[labels], cost * strength
    towards = np.zeros((n, many), np.int64)
    flat = towards.reshape(-1)
    for a in range(0, len(ends), SPAN_EDGES):
        b = min(len(ends), a + SPAN_EDGES)
        np.add.at(flat, owners(starts, a, b) * many + label[ends[a:b]], weights[a:b].astype(np.int64))
    moving, step, none, rows = True, LEAST, np.iinfo(np.int64).min, np.arange(MOST)
    while moving:
        moving, i = False, 0
        while i < n:
            j = min(n, i + step)
            sums, here, k = towards[i:j], label[i:j], strength[i:j]
            gain = scale * sums - price[i:j, None] * total
            stay = gain[rows[:j - i], here] + price[i:j] * k
            gain[sums == 0] = none
            gain[rows[:j - i], here] = stay
            gains = gain.max(axis=1) > stay
            first = int(gains.argmax())
            if not gains[first]:
                i, step = j, min(MOST, 2 * step)
                continue
            if 4 * first < step:
                step = max(LEAST, step // 2)
            i += first
            old, new = int(label[i]), int(gain[first].argmax())
            a, b = starts[i], starts[i + 1]
            place, w = ends[a:b].astype(np.int64) * many, weights[a:b].astype(np.int64)
            np.add.at(flat, place + old, -w)
            np.add.at(flat, place + new, w)
            total[old] -= strength[i]
            total[new] += strength[i]
            label[i], moving = new, True
            i += 1
    home[:] = labels[label]


def contracted(starts, ends, weights, strength, home):
    """Network of communities: their labels, and edges between them and strengths as :func:`descend` takes them."""
    labels, place = np.unique(home, return_inverse=True)
    n = len(labels)
    sums = np.bincount(place, minlength=n) * 0
    np.add.at(sums, place, strength)
    keys, added = np.array([], np.int64), np.array([], np.int64)
    for a in range(0, len(ends), SPAN_EDGES):
        b = min(len(ends), a + SPAN_EDGES)
        one, two = place[owners(starts, a, b)], place[ends[a:b]]
        across = one != two
        found, back = np.unique(np.concatenate([keys, (one * n + two)[across]]), return_inverse=True)
        grown = np.zeros(len(found), np.int64)
        np.add.at(grown, back, np.concatenate([added, weights[a:b][across]]))
        keys, added = found, grown
    upper = np.searchsorted(keys, np.arange(n + 1) * n)
    return labels, (upper, keys % n if n else keys, added, sums)


def settle_packed(rows: Iterable[bytes], scale: int, cost: int) -> pd.DataFrame:
    """``id, label`` of whole components, from their packed edges, after which no vertex gains by moving and no
    community by joining another.

    A move of a vertex of strength k to a community of weight w towards it and strength t gains ``scale * w - cost * k * t``.
    """
    net = Packed(rows)
    strength = np.zeros(len(net.ids), np.int64)
    for u, v, code in net.edges():
        for one in (u, v):  # a self-loop counts twice
            np.add.at(strength, one, net.weights[code])
    starts, ends, codes = net.both_ways()
    ends = ends.astype(np.int32) if len(net.ids) < 1 << 31 else ends
    ends_of_weights = [np.min_scalar_type(int(x)) for x in (net.weights[0], net.weights[-1])]
    weights = net.weights.astype(np.result_type(*ends_of_weights))[codes]
    del codes
    home, rising = np.arange(len(net.ids)), True
    while rising:
        descend(starts, ends, weights, strength, home, scale, cost)
        rising = False
        labels, upper = contracted(starts, ends, weights, strength, home)
        while descend(*upper, found := np.arange(len(labels)), scale, cost):
            rising, home = True, labels[found][np.searchsorted(labels, home)]
            # labels of the communities joined are those of some of them
            names, upper = contracted(*upper, found)
            labels = labels[names]
    return pd.DataFrame({"id": net.ids, "label": net.ids[home]})
