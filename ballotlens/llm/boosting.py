"""Gradient-boosted trees for feature tables (numpy, logistic loss).

Trees grow from sums over the rows: of the gradients and hessians by node,
feature and bin. Several models grow side by side, each with its own count of
every row, so one pass over the rows serves them all. The rows lie in blocks,
here (``Near``) or all over a cluster (``Spread``). Sums are of integers (gradients
times ``UNIT``), so the trees do not depend on how the rows are dealt."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import RDD, StorageLevel

TREES, DEPTH, RATE, BINS, RIDGE = 60, 3, 0.2, 32, 1.0
UNIT = float(1 << 24)           # sums stay exact in doubles up to 2^29 rows a block


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def bin_codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value: code <= k means value <= edges[k]."""
    return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)


def block_of(codes: np.ndarray, y: np.ndarray, counts: np.ndarray, base: np.ndarray) -> dict:
    """Rows of bins and labels; counts (rows, models): how often a model has the row."""
    return {"codes": codes, "y": y, "counts": counts, "total": np.tile(np.asarray(base, float), (len(y), 1))}


class Near:
    """One block of rows in this process."""

    def __init__(self, block: dict):
        self.block = block

    def sums(self, of: Callable[[dict], np.ndarray]) -> np.ndarray:
        return of(self.block)

    def change(self, to: Callable[[dict], dict]) -> None:
        self.block = to(self.block)


class Spread:
    """Blocks of rows all over a cluster."""

    def __init__(self, blocks: RDD):
        self.blocks, self.before = blocks.persist(StorageLevel.MEMORY_AND_DISK), None

    def sums(self, of: Callable[[dict], np.ndarray]) -> np.ndarray:
        found = self.blocks.map(of).treeReduce(np.add)
        if self.before is not None:             # the blocks made of these are kept by now
            self.before.unpersist()
            self.before = None
        return found

    def change(self, to: Callable[[dict], dict]) -> None:
        self.before, self.blocks = self.blocks, self.blocks.map(to).persist(StorageLevel.MEMORY_AND_DISK)

    def done(self) -> None:
        for blocks in (self.before, self.blocks):
            if blocks is not None:
                blocks.unpersist()


def _nodes(codes: np.ndarray, tree: dict) -> np.ndarray:
    """The node that each row has reached in a tree of {node: (feature, bin, leaf)}."""
    at = np.zeros(len(codes), np.int64)
    for node in sorted(n for n, (f, _, _) in tree.items() if f >= 0):
        f, k, _ = tree[node]
        rows = np.flatnonzero(at == node)
        at[rows] = 2 * node + 1 + (codes[rows, f] > k)
    return at


def histograms(trees: list[dict], opened: list[list[int]]) -> Callable[[dict], np.ndarray]:
    """For each open node of each model one after the other: (gradients,
    hessians, rows) by feature and bin."""
    def run(block: dict) -> np.ndarray:
        codes, n = block["codes"], len(block["y"])
        features = codes.shape[1]
        out = np.zeros((sum(map(len, opened)), 3, features, BINS), np.int64)
        place = np.arange(features) * BINS + codes
        first = 0
        for m, nodes in enumerate(opened):
            if not nodes or not n:
                first += len(nodes)
                continue
            at, p, count = _nodes(codes, trees[m]), _sigmoid(block["total"][:, m]), block["counts"][:, m]
            own = np.full(max(int(at.max()), *nodes) + 1, -1)
            own[nodes] = np.arange(len(nodes))
            rows = np.flatnonzero((own[at] >= 0) & (count > 0))
            slot = (own[at[rows]][:, None] * features * BINS + place[rows]).ravel()
            values = (np.rint((block["y"] - p) * UNIT), np.rint(p * (1 - p) * UNIT), np.ones(n))
            for v, value in enumerate(values):
                got = np.bincount(slot, np.repeat(value[rows] * count[rows], features), len(nodes) * features * BINS)
                out[first:first + len(nodes), v] = got.reshape(len(nodes), features, BINS).astype(np.int64)
            first += len(nodes)
        return out
    return run


def _grown(trees: list[dict]) -> Callable[[dict], dict]:
    """Adds the leaves that rows fall into."""
    def run(block: dict) -> dict:
        steps = []
        for tree in trees:
            leaf = np.zeros(max(tree) + 1)
            leaf[list(tree)] = [v for _, _, v in tree.values()]
            steps.append(leaf[_nodes(block["codes"], tree)])
        return {**block, "total": block["total"] + np.stack(steps, axis=1)}
    return run


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """Best (gain, feature, bin): rows with code <= bin go left."""
    g, h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    sum_g, sum_h = g[:, -1:], h[:, -1:]
    gain = g ** 2 / (h + RIDGE) + (sum_g - g) ** 2 / (sum_h - h + RIDGE) - sum_g ** 2 / (sum_h + RIDGE)
    gain[:, -1] = 0
    f, k = divmod(int(gain.argmax()), BINS)
    return (float(gain[f, k]), f, k) if gain[f, k] > 1e-6 else (0.0, -1, 0)


def base_of(share: float) -> float:
    share = min(max(share, 1e-3), 1 - 1e-3)
    return float(np.log(share / (1 - share)))


def grow(rows: Near | Spread, edges: list[np.ndarray], base: list[float]) -> list[dict]:
    """Models of P(y = 1 | x), one for each column of the rows' counts: a pass for
    each level of each tree."""
    made: list[list[np.ndarray]] = [[] for _ in base]
    for _ in range(TREES):
        trees, opened = [{0: (-1, 0, 0.0)} for _ in base], [[0] for _ in base]
        for depth in range(DEPTH):
            if not any(opened):
                break
            found = iter(rows.sums(histograms(trees, opened)))
            after: list[list[int]] = [[] for _ in base]
            for m, nodes in enumerate(opened):
                for node in nodes:
                    g, h, n = next(found)
                    g, h, n = g / UNIT, h / UNIT, int(n[0].sum())
                    leaf = lambda a, b: float(RATE * a / (b + RIDGE))
                    trees[m][node] = (-1, 0, leaf(g[0].sum(), h[0].sum()))
                    _, f, k = _split(g, h) if n > 10 else (0.0, -1, 0)
                    if f < 0:
                        continue
                    left = g[f, :k + 1].sum(), h[f, :k + 1].sum()
                    right = g[f, k + 1:].sum(), h[f, k + 1:].sum()
                    trees[m].update({node: (f, k, 0.0), 2 * node + 1: (-1, 0, leaf(*left)), 2 * node + 2: (-1, 0, leaf(*right))})
                    after[m] += [2 * node + 1, 2 * node + 2]
            opened = after
        rows.change(_grown(trees))
        for m, tree in enumerate(trees):
            bound = lambda f, k: float(edges[f][k]) if f >= 0 and k < len(edges[f]) else np.inf if f >= 0 else 0.0
            empty = (-1, 0, 0.0)
            made[m].append(np.array([(f, bound(f, k), leaf) for f, k, leaf in (tree.get(i, empty) for i in range(max(tree) + 1))]))
    return [{"base": b, "trees": t} for b, t in zip(base, made)]


def quantile_edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """A model of P(y = 1 | x)."""
    edges, base = quantile_edges(x), base_of(float(y.mean()))
    return grow(Near(block_of(bin_codes(x, edges), y, np.ones((len(y), 1), np.int64), np.array([base]))), edges, [base])[0]


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model["base"])
    for tree in model["trees"]:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            f = tree[node, 0].astype(np.int64)
            inner = f >= 0
            right = x[np.arange(len(x)), np.maximum(f, 0)] > tree[node, 1]
            node = np.where(inner, 2 * node + 1 + right, node)
        total += tree[node, 2]
    return _sigmoid(total)
