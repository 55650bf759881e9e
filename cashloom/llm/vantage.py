"""Vantage-point trees over 64-bit fingerprints, and the exact search for close pairs in their leaves.

A node of the tree has a vantage point and a radius; its inner branch holds the fingerprints within
the radius, its outer branch the rest. Radii are small, so that an inner branch is about one leaf:
distances between unrelated fingerprints lie so close together that a median split would send nearly
every fingerprint down both branches, while a small ball has a thin shell.

Every fingerprint has one home leaf. Two close ones that part at a node lie on either side of its
radius, the outer one within ``reach`` of it; the outer one is then also sent down the inner branch,
as a visitor, and a visitor takes every branch that the triangle bound doesn't rule out. So any two
fingerprints within ``reach`` meet in the home leaf of one of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Leaves aim at no fewer sampled fingerprints than this.
LEAST_SAMPLED = 8
#: Distances computed at once.
BLOCK_CELLS = 1 << 21


@dataclass
class Tree:
    """Arrays over nodes: vantage point, radius, inner and outer child; a child -k - 1 is leaf k."""

    points: list[int] = field(default_factory=list)
    radii: list[int] = field(default_factory=list)
    inner: list[int] = field(default_factory=list)
    outer: list[int] = field(default_factory=list)
    leaves: int = 0

    def leaf(self) -> int:
        self.leaves += 1
        return -self.leaves


def grow(sample: np.ndarray, leaf_size: int, seed: int = 42) -> Tree:
    """A tree whose leaves hold about ``leaf_size`` of the sampled fingerprints each."""
    tree, rng = Tree(), np.random.default_rng(seed)
    leaf_size = max(leaf_size, LEAST_SAMPLED)
    todo = [(np.unique(sample.astype(np.uint64)), None, None)]
    while todo:
        here, parent, side = todo.pop()
        if len(here) <= 2 * leaf_size:
            node = tree.leaf()
        else:
            point = here[rng.integers(len(here))]
            distance = np.bitwise_count(here ^ point)
            radius = int(np.partition(distance, leaf_size)[leaf_size])
            if radius >= int(distance.max()):  # all others at one distance: no ball to cut off
                node = tree.leaf()
            else:
                node = len(tree.points)
                tree.points.append(int(point))
                tree.radii.append(radius)
                tree.inner.append(0)
                tree.outer.append(0)
                todo.append((here[distance > radius], node, tree.outer))
                todo.append((here[distance <= radius], node, tree.inner))
        if parent is not None:
            side[parent] = node
    return tree


def route(tree: Tree, prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and leaf of every visit of ``prints``, home leaves included."""
    if not tree.points:
        return np.arange(len(prints)), np.zeros(len(prints), dtype=np.int64)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    everything = np.arange(len(prints))
    todo = [(0, everything, np.zeros(0, dtype=np.int64))]
    while todo:
        node, home, guests = todo.pop()
        if not len(home) + len(guests):
            continue
        if node < 0:
            both = np.concatenate([home, guests])
            out.append((both, np.full(len(both), -node - 1, dtype=np.int64)))
            continue
        point, radius = np.uint64(tree.points[node]), tree.radii[node]
        near = np.bitwise_count(prints[home] ^ point).astype(np.int16)
        far = np.bitwise_count(prints[guests] ^ point).astype(np.int16)
        shell = home[(near > radius) & (near <= radius + reach)]
        todo.append((tree.outer[node], home[near > radius], guests[far > radius - reach]))
        todo.append((tree.inner[node], home[near <= radius], np.concatenate([shell, guests[far <= radius + reach]])))
    if not out:
        return everything[:0], everything[:0]
    return np.concatenate([i for i, _ in out]), np.concatenate([leaf for _, leaf in out])


def close_groups(prints: np.ndarray, reach: int) -> np.ndarray:
    """For each of the different ``prints`` the smallest one (as an index) that close pairs lead to.

    All pairs are compared in blocks; groups are joined once a member, however many pairs they have.
    """
    label = np.arange(len(prints))
    step = max(1, BLOCK_CELLS // max(1, len(prints)))
    for start in range(0, len(prints), step):
        block = prints[start : start + step]
        close = np.bitwise_count(block[:, None] ^ prints[None, start:]) <= reach
        for row in np.flatnonzero(close.sum(axis=1) > 1):
            found = np.flatnonzero(close[row]) + start
            while len(other := found[label[found] != label[start + row]]):
                low, high = sorted((label[start + row], label[other[0]]))
                label[label == high] = low
    return label
