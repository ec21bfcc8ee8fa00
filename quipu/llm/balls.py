"""Ball trees over blocks of rows, and best-first search in them for many queries at once."""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Places of a result that nothing fills yet.
NO_SCORE, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Bounds are computed in doubles; each is raised by this share of the largest term it may hold, and by a little more.
ROUNDING = 1e-9
EXACT = 2.0**53


@dataclass
class Tree:
    """Nodes in the order they were split: rows ``start`` to ``end`` of ``order``, left child (-1 for a leaf; the right one follows it),
    smallest id, centre and radius."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    least: np.ndarray
    centre: np.ndarray
    radius: np.ndarray


def build(n: int, ids: np.ndarray, leaf: int, ball: Callable, side: Callable) -> Tree:
    """A tree over rows 0 to n - 1. ball(rows) gives centre and distances from it; side(rows, distances) a number by which rows are
    halved. Rows of one place stay one leaf, whatever their number; the rows of a leaf are in the order of their ids."""
    order, nodes, left, centres, radii, least = np.argsort(ids, kind="stable"), [(0, n)], [], [], [], []
    at = 0
    while at < len(nodes):
        start, end = nodes[at]
        rows = order[start:end]
        centre, away = ball(rows)
        centres.append(centre)
        radii.append(away.max(initial=0.0))
        least.append(ids[rows].min())
        left.append(-1)
        if end - start > leaf and radii[-1] > 0:
            by, half = side(rows, away), (end - start) // 2
            upper = np.zeros(len(rows), bool)
            upper[np.argpartition(by, half)[half:]] = True
            order[start:end] = np.concatenate([rows[~upper], rows[upper]])
            left[at] = len(nodes)
            nodes += [(start, start + half), (start + half, end)]
        at += 1
    spans = np.asarray(nodes, np.int64)
    return Tree(order, spans[:, 0], spans[:, 1], np.asarray(left, np.int64), np.asarray(least, np.int64), np.stack(centres), np.asarray(radii))


def upper_bounds(inner: np.ndarray, norms: np.ndarray, centre_norms: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Whole numbers that no integer inner product of a query (row) with a member of a node (column) exceeds."""
    reach = norms[:, None] * radius[None, :]
    slack = ROUNDING * norms[:, None] * (centre_norms + radius)[None, :] + 1e-6
    return np.floor(inner + reach + slack)


class Best:
    """The k best (score, id) of each query so far: higher scores first, then smaller ids. Never below ``floor``, if given."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.full((queries, k), NO_SCORE, np.int64)
        self.ids = np.full((queries, k), NO_ID, np.int64)
        self.floor = np.full(queries, NO_SCORE, np.int64) if floor is None else floor

    def open_to(self, who: np.ndarray, bound: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Whether rows below ``bound`` with ids from ``least`` on could still be among the best."""
        last, last_id = self.scores[who, -1], self.ids[who, -1]
        return ((bound > last) | ((bound == last) & (least < last_id))) & (bound >= self.floor[who])

    def add(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (a row for each of ``who``, a column for each of ids, which ascend); NO_SCORE takes no part."""
        k = self.scores.shape[1]
        some = scores.max(axis=1) >= np.maximum(self.scores[who, -1], self.floor[who])
        who, scores = who[some], scores[some]
        if not len(who):
            return
        first = np.argsort(~scores, axis=1, kind="stable")[:, :k] if scores.shape[1] > k else np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
        new = np.take_along_axis(scores, first, 1)
        all_scores = np.concatenate([self.scores[who], new], axis=1)
        all_ids = np.concatenate([self.ids[who], np.where(new == NO_SCORE, NO_ID, ids[first])], axis=1)
        kept = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
        self.scores[who] = np.take_along_axis(all_scores, kept, 1)
        self.ids[who] = np.take_along_axis(all_ids, kept, 1)


def search(tree: Tree, bounds: np.ndarray, best: Best, score_leaf: Callable) -> int:
    """Adds the rows of a tree to ``best``. Each query opens its nodes in the order of their bounds and ends where no open node can
    better its k-th result; queries at one leaf are scored together. Returns the number of rows that were scored."""
    scored, open_nodes = 0, np.full(bounds.shape, -np.inf)
    open_nodes[:, 0] = bounds[:, 0]
    alive = np.arange(len(bounds))
    while len(alive):
        node = open_nodes[alive].argmax(axis=1)
        bound = open_nodes[alive, node]
        go = np.isfinite(bound) & best.open_to(alive, bound, tree.least[node])
        alive, node = alive[go], node[go]
        open_nodes[alive, node] = -np.inf
        by = np.argsort(node, kind="stable")
        cuts = np.flatnonzero(np.diff(node[by])) + 1
        for group in np.split(by, cuts) if len(by) else []:
            who, at = alive[group], node[group[0]]
            if (child := tree.left[at]) >= 0:
                open_nodes[who, child] = bounds[who, child]
                open_nodes[who, child + 1] = bounds[who, child + 1]
            else:
                rows = tree.order[tree.start[at] : tree.end[at]]
                best.add(who, *score_leaf(who, rows))
                scored += len(who) * len(rows)
    return scored
