"""Learned space partitions (numpy): balanced graph partitioning and a routing classifier.

All functions work on a bounded sample on the driver; the model they give is a
few small matrices that every task uses.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def neighbour_graph(x: np.ndarray, k: int, block: int = 256) -> np.ndarray:
    """Ids of the ``k`` rows with the largest inner product for each row (itself excluded)."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), block):
        s = x[a : a + block] @ x.T
        s[np.arange(len(s)), a + np.arange(len(s))] = -np.inf
        out[a : a + block] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def neighbours_of(q: np.ndarray, x: np.ndarray, k: int, block: int = 256) -> np.ndarray:
    """Rows of ``x`` with the ``k`` largest inner products for each row of ``q``."""
    k = min(k, len(x))
    found = [np.argpartition(-(q[a : a + block] @ x.T), k - 1, axis=1)[:, :k] for a in range(0, len(q), block)]
    return np.concatenate(found) if found else np.empty((0, k), np.int64)


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 11, rounds: int = 30, slack: float = 1.1) -> np.ndarray:
    """A partition number for each node: even sizes up to ``slack``, few graph edges cut.

    Starts from recursive median splits along random differences and then moves
    nodes to the partition that most of their neighbours (in either direction) are in, those with the
    largest gain first, while the target has room.
    """
    rng = np.random.default_rng(seed)
    n = len(x)
    part = np.zeros(n, np.int64)
    stack, free = [(np.arange(n), parts)], 0
    while stack:
        rows, p = stack.pop()
        if p == 1 or len(rows) < 2:
            part[rows] = free
            free += 1
            continue
        a, b = x[rng.choice(rows, 2, replace=False)]
        order = rows[np.argsort(x[rows] @ (a - b), kind="stable")]
        cut = len(order) * (p // 2) // p
        stack += [(order[:cut], p // 2), (order[cut:], p - p // 2)]
    parts = free
    room = int(np.ceil(slack * n / parts))
    u = np.repeat(np.arange(n), graph.shape[1])
    v = graph.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.float32)
        np.add.at(votes, (u, part[v]), 1)
        votes += rng.random((n, 1), np.float32) * 1e-3
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain):
            if gain[i] <= 0:
                break
            if size[best[i]] < room and rng.random() < 0.7:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < n // 500:
            break
    return part


@dataclass(frozen=True)
class Router:
    """One hidden layer; ``probabilities`` of each partition for each vector."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
        h = np.maximum(x.astype(np.float32) @ self.w1 + self.b1, 0)
        z = h @ self.w2 + self.b2
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train_router(x: np.ndarray, graph: np.ndarray, part: np.ndarray, hidden: int = 128, epochs: int = 25, seed: int = 5) -> Router:
    """Learns the share of each partition among a vector and its neighbours (Adam, soft targets)."""
    rng = np.random.default_rng(seed)
    parts = int(part.max()) + 1
    target = np.zeros((len(x), parts), np.float32)
    np.add.at(target, (np.arange(len(x)), part), 0.5 * graph.shape[1])
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1)
    target /= target.sum(1, keepdims=True)
    x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)).astype(np.float32)
    w = [
        (rng.normal(size=(x.shape[1], hidden)) * np.sqrt(2)).astype(np.float32),
        np.zeros(hidden, np.float32),
        (rng.normal(size=(hidden, parts)) * np.sqrt(2 / hidden)).astype(np.float32),
        np.zeros(parts, np.float32),
    ]
    m, s, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for epoch in range(epochs):
        rate = 0.005 * (1 - epoch / epochs)
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            a = x[rows]
            h = np.maximum(a @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            z = np.exp(z - z.max(1, keepdims=True))
            d = (z / z.sum(1, keepdims=True) - target[rows]) / len(rows)
            dh = (d @ w[2].T) * (h > 0)
            t += 1
            for k, g in enumerate((a.T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return Router(*w)
