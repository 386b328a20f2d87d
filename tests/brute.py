"""Plain quadratic statements of the semantics, for small inputs."""

from __future__ import annotations

import numpy as np


def density_labels(x: np.ndarray, min_cluster_size: int) -> np.ndarray:
    """Excess-of-mass clusters of the mutual-reachability hierarchy, edges ordered by (w, i, j)."""
    n = len(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    k = min(n - 1, min_cluster_size)
    core = np.sort(d, axis=1)[:, k]
    m = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    edges = sorted((m[i, j], i, j) for i in range(n) for j in range(i + 1, n))
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    node_of, children, size, height = {i: i for i in range(n)}, {}, {i: 1 for i in range(n)}, {}
    following = n
    for w, i, j in edges:
        a, b = find(i), find(j)
        if a == b:
            continue
        children[following] = (node_of[a], node_of[b])
        size[following] = size[node_of[a]] + size[node_of[b]]
        height[following] = w
        root[a] = b
        node_of[b] = following
        following += 1

    def leaves(node):
        stack, out = [node], []
        while stack:
            c = stack.pop()
            if c < n:
                out.append(c)
            else:
                stack += children[c]
        return out

    birth, parent, stability, fallen, kids = {0: 0.0}, {0: None}, {}, {0: []}, {0: []}
    stack, names = [(following - 1, 0)], 1
    while stack:
        node, cluster = stack.pop()
        lam = 1 / height[node] if node >= n and height[node] > 0 else np.inf
        big = [c for c in children.get(node, ()) if size[c] >= min_cluster_size]
        for c in children.get(node, ()):
            if c not in big:
                fallen[cluster] += [(p, lam) for p in leaves(c)]
        if len(big) == 1:
            stack.append((big[0], cluster))
        elif len(big) == 2:
            for c in big:
                birth[names], parent[names], fallen[names], kids[names] = lam, cluster, [], []
                kids[cluster].append((names, lam, size[c]))
                stack.append((c, names))
                names += 1
    for c in birth:
        stability[c] = sum(lam - birth[c] for _, lam in fallen[c]) + sum(
            (lam - birth[c]) * s for _, lam, s in kids[c]
        )
    chosen, value = {}, dict(stability)
    for c in sorted(birth, reverse=True):
        below = sum(value[k] for k, _, _ in kids[c])
        chosen[c] = c != 0 and (not kids[c] or stability[c] >= below)
        value[c] = max(stability[c], below) if kids[c] else stability[c]
    labels = np.full(n, -1)
    for c in birth:
        top, at = None, c
        while at is not None:
            if chosen[at]:
                top = at
            at = parent[at]
        for p, _ in fallen[c]:
            labels[p] = -1 if top is None else top
    return labels


def same_partition(a, b) -> bool:
    """Equal up to the names of the clusters; -1 must match exactly."""
    pairs = set(zip(a, b))
    clean = {(x, y) for x, y in pairs if x != -1 and y != -1}
    noise_matches = all((x == -1) == (y == -1) for x, y in pairs)
    return noise_matches and len({x for x, _ in clean}) == len(clean) == len({y for _, y in clean})
