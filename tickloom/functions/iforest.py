"""Isolation trees in numpy (Liu, Ting, Zhou 2008): the small per-group helper.

A tree is kept in heap order: node i has children 2i+1 and 2i+2. ``feature`` is -1 at a
leaf, ``value`` is the leaf's path length in billionths.

Nothing is drawn from a generator that has a state. Each choice is a function of what it is
for (``draw``): of forest, tree and slice for a sampled row, of tree, node and feature for a
split. So trees do not depend on the order of work, any engine with 64-bit integers grows
the same ones, and path lengths, being whole numbers, add up to the same score.
"""

from __future__ import annotations

import hashlib

import numpy as np

EULER = 0.5772156649015329
#: Draws are remainders of this prime (their squares fit 63 bits); path lengths and scores
#: are counted in this part, cut-offs in that of the second.
PRIME, BILLION, CUT = 2**31 - 1, 10**9, 10**12
#: Draws of nodes are numbered from here on, those of sampled rows below.
NODES = 10**6


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    c = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, c, np.where(n == 2, 1.0, 0.0))


def whole(x: np.ndarray, part: int = BILLION) -> np.ndarray:
    """Doubles as whole numbers of a part, halves up."""
    return np.floor(np.asarray(x) * part + 0.5).astype(np.int64)


def mixed(state, x):
    """One step of the hash: 31 bits from 31 bits and a whole number below 10^14."""
    t = (state + x * 16807) % PRIME
    return (t * t % PRIME * 48271 + 1) % PRIME


def draw(state, x):
    """A number below ``PRIME`` for ``x``."""
    return mixed(mixed(state, x), 0)


def seed_of(ticker: str, seed: int, version: int) -> int:
    """The state that all draws of a version start from."""
    name = int(hashlib.md5(ticker.encode()).hexdigest()[:8], 16) % PRIME
    return mixed(mixed(name, seed), version)


def depth_of(psi: int) -> int:
    return max(1, int(np.ceil(np.log2(max(psi, 2)))))


def sampled(n: int, psi: int, tree_state: np.ndarray) -> np.ndarray:
    """``psi`` different rows of ``n`` for each tree: one from each of ``psi`` equal slices."""
    k = np.arange(psi, dtype=np.int64)
    low, high = k * n // psi, (k + 1) * n // psi
    return low + draw(tree_state[:, None], k) % (high - low)


def grow(x: np.ndarray, trees: int, sample: int, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grow all trees level by level; arrays of shape (trees, nodes)."""
    psi = min(sample, len(x))
    depth = depth_of(psi)
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, dtype=np.int32)
    threshold = np.zeros((trees, nodes))
    value = np.zeros((trees, nodes), dtype=np.int64)

    states = mixed(np.int64(state), np.arange(trees, dtype=np.int64))
    rows = x[sampled(len(x), psi, states).ravel()]
    slot = np.repeat(np.arange(trees), psi) * nodes  # tree * nodes + node of each row
    for level in range(depth + 1):
        if not len(rows):
            break
        order = np.argsort(slot, kind="stable")
        rows, slot = rows[order], slot[order]
        ids, start, count = np.unique(slot, return_index=True, return_counts=True)
        t, node = ids // nodes, ids % nodes
        low = np.minimum.reduceat(rows, start, axis=0)
        high = np.maximum.reduceat(rows, start, axis=0)
        varies = high > low
        at_node = mixed(states[t], NODES + node)
        drawn = draw(at_node[:, None], np.arange(1, x.shape[1] + 1, dtype=np.int64))
        f = np.where(varies, drawn, -1).argmax(axis=1)
        split = varies.any(axis=1) & (count > 1) & (level < depth)
        at = np.arange(len(ids))
        least, most = low[at, f], high[at, f]
        cut = least + draw(at_node, 0) / float(PRIME) * (most - least)
        cut = np.where(cut < most, cut, least)  # both sides get rows
        feature[t[split], node[split]] = f[split]
        threshold[t[split], node[split]] = cut[split]
        value[t[~split], node[~split]] = level * BILLION + whole(average_path(count[~split]))
        group = np.repeat(at, count)
        keep = split[group]
        group, rows, slot = group[keep], rows[keep], slot[keep]
        right = rows[np.arange(len(rows)), f[group]] > cut[group]
        tree, node = slot // nodes, slot % nodes
        slot = tree * nodes + 2 * node + 1 + right
    return feature, threshold, value


def score(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, psi: int) -> np.ndarray:
    """-2^(-mean path / expected path) in billionths: near -10^9 is isolated, near -4 * 10^8 is usual."""
    trees, nodes = feature.shape
    depth = int(np.log2(nodes + 1)) - 1
    value = value.copy()
    for level in range(depth):  # leaves hand their value down the left edge, so that all rows take as many steps
        i = np.arange(2**level - 1, 2 ** (level + 1) - 1)
        value[:, 2 * i + 1] = np.where(feature[:, i] < 0, value[:, i], value[:, 2 * i + 1])
    cells, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    total = np.zeros(len(x), dtype=np.int64)
    for f, t, v in zip(feature, threshold, value, strict=True):
        cut = np.where(f < 0, np.inf, t)
        column = np.maximum(f, 0)
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (cells.take(first + column.take(node)) > cut.take(node))
        total += v.take(node)
    usual = max(int(whole(average_path(np.array(psi)))), 1)
    return whole(-np.power(2.0, -(total / float(trees * usual))))


def cut_off(scores: np.ndarray, contamination: float) -> int:
    """The score below which a share of the training rows lies, in the part ``CUT``: the
    ranks around that share, weighed by thousandths."""
    place = (len(scores) - 1) * round(contamination * 1000)
    low, rest = place // 1000, place % 1000
    ranked = np.partition(scores, [low, min(low + 1, len(scores) - 1)])
    a, b = int(ranked[low]), int(ranked[min(low + 1, len(scores) - 1)])
    return a * (1000 - rest) + b * rest
