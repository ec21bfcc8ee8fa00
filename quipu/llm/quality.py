"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown on binned statistics of a bounded sample of labelled rows and flattened into arrays, which numpy walks for a whole
batch of documents at once, one step per level.
"""

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.columns import kept_apart
from quipu.llm.common import map_batches
from quipu.llm.toxicity import labelled_sample

TRAIN_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
MIN_ROWS = 10
PENALTY = 1.0
ACCEPT = 0.7

FEATURES = [
    "log_words", "word_length", "distinct", "distinct_3", "top_word", "same_next", "upper", "digits", "symbols", "stops", "commas", "shouts",
    "other", "blanks", "beyond_ascii", "entropy", "log_lines", "line_words", "equal_lines", "bare_words",
]
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def statistics(text: str) -> list[float]:
    """FEATURES of a whole text; all 0 for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    signs = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, known = len(raw), Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = signs[65:91].sum() + signs[97:123].sum() + signs[128:].sum()
    shares = signs[signs > 0] / size
    plain = signs[33:127].sum() - signs[48:58].sum() - signs[65:91].sum() - signs[97:123].sum()
    return [
        np.log1p(n), sum(map(len, words)) / n, len(known) / n, len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, n - 2),
        max(known.values()) / n, sum(map(bytes.__eq__, words, words[1:])) / n, signs[65:91].sum() / max(1, letters), signs[48:58].sum() / size,
        signs[_SYMBOLS].sum() / n, signs[46] / n, signs[44] / n, signs[33] / n, plain / size, (signs[32] + signs[9:14].sum()) / size,
        signs[128:].sum() / size, float(-(shares * np.log(shares)).sum()), np.log1p(len(lines)), n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), sum(len(w) for w in known if len(w) == 1) / len(known),
    ]


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees in one set of arrays; a leaf points at itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            z += self.value[at]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees for labels 0 and 1. One class only, or no rows, gives its constant score (0.5 without rows)."""
    n, width = x.shape
    share = min(max((y.sum() + 0.5) / (n + 1), 1e-3), 1 - 1e-3)
    nodes: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "value")}
    roots, base = [], float(np.log(share / (1 - share)))

    def node() -> int:
        k = len(nodes["value"])
        for name, v in zip(nodes, (0, 0.0, k, k, 0.0), strict=True):
            nodes[name].append(v)
        return k

    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
        bins = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)])
        z = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-z))
            slope, bend = y - p, p * (1 - p)
            root = node()
            roots.append(root)
            level = [(root, np.arange(n))]
            for step in range(depth + 1):
                below = []
                for k, rows in level:
                    g, h = slope[rows].sum(), bend[rows].sum()
                    best = (1e-6, -1, -1)
                    if step < depth and len(rows) >= 2 * MIN_ROWS:
                        for f in range(width):
                            if not len(cuts[f]):
                                continue
                            b = bins[rows, f]
                            gl, hl, nl = (np.cumsum(np.bincount(b, v, len(cuts[f]) + 1))[:-1] for v in (slope[rows], bend[rows], None))
                            gain = gl**2 / (hl + PENALTY) + (g - gl) ** 2 / (h - hl + PENALTY) - g**2 / (h + PENALTY)
                            gain[(nl < MIN_ROWS) | (len(rows) - nl < MIN_ROWS)] = -1
                            j = int(np.argmax(gain))
                            if gain[j] > best[0]:
                                best = (float(gain[j]), f, j)
                    if best[1] < 0:
                        nodes["value"][k] = rate * g / (h + PENALTY)
                        z[rows] += nodes["value"][k]
                        continue
                    _, f, j = best
                    nodes["feature"][k], nodes["cut"][k] = f, float(cuts[f][j])
                    goes = bins[rows, f] <= j
                    for side, part in (("left", rows[goes]), ("right", rows[~goes])):
                        child = node()
                        nodes[side][k] = child
                        below.append((child, part))
                level = below
    kinds = {"feature": np.int64, "left": np.int64, "right": np.int64, "cut": float, "value": float}
    arrays = {k: np.asarray(v, kinds[k]) for k, v in nodes.items()}
    return Trees(**arrays, roots=np.asarray(roots, np.int64), base=base if n else 0.0, depth=depth)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _table(texts: list[str | None]) -> np.ndarray:
    return np.asarray([statistics(t or "") for t in texts], float).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees from labelled rows that aren't held out, at most about ``rows``; their statistics reach the driver, their texts don't."""
    sample = labelled_sample(docs, labels, "quality", ~held_out(F.col("doc_id")), rows)

    sample = sample.withColumn("label", F.col("label").cast("int"))
    found = map_batches(sample, ["text"], ["doc_id", "label"], "x array<double>", lambda texts: {"x": list(_table(texts))}).collect()
    found.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), str(r["doc_id"])))
    x = np.asarray([r["x"] for r in found], float).reshape(-1, len(FEATURES))
    return grow(x, np.asarray([r["label"] for r in found], float))


def score_quality(docs: DataFrame, model: Trees) -> DataFrame:
    """docs without their text, with quality (0 to 1). Null and empty texts score as texts whose statistics are all 0; repeated rows get
    equal scores; an empty table gives an empty result. Other columns stay; one named quality comes back as quality_before."""

    def scored(rows: DataFrame) -> DataFrame:
        kept = [c for c in rows.columns if c != "text"]
        return map_batches(rows, ["text"], kept, "quality double", lambda texts: {"quality": model.score(_table(texts))})

    return kept_apart(docs, ["text"], scored)
