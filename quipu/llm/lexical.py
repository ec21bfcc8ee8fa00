"""Ranked lexical search: exact inner products of sparse vectors, pruned by ball trees.

A document's vector holds an integer impact for each of the items' terms in it, an item's the terms' weights; the score is their inner
product. Documents are cut into shards as they are read. Each shard gets a ball tree; an item opens its nodes in the order of their
upper bounds, centre . q + |q| radius, and ends where none can better its k-th score. Squared radii and bounds are raised by more than
rounding may take from them, and leaves are scored in whole numbers, so no document is lost.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm import balls, shard_search
from quipu.llm.common import cut_batch, map_batches, stored, with_package

TOP = 10
#: Rows and entries of a shard, and entries of a block of items, at most.
SHARD_ROWS = 2048
SHARD_ENTRIES = 400_000
BLOCK_ENTRIES = 16_384
BLOCK_ITEMS = 256
LEAF_ROWS = 64
#: The items' terms are looked up in tasks up to so many bytes of them; beyond, documents' terms are joined with them.
LOOKUP_BYTES = 16 << 20
#: Squares are raised by this share of their largest term.
SQUARE_ROUNDING = 1e-9
# A term's impact is GAIN * tf div (1000 * tf + 8 * m), m = BASE + (SLOPE * n * N) div L.
GAIN, BASE, SLOPE = 1_000_000_000, 10, 90

_PARTS = ["ids", "lengths", "numbers", "impacts", "order", "starts", "ends", "lefts", "least", "radii"]
_SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all other code points from U+0080 on, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number), item_id and its distinct terms; equal rows are one item."""

    def find(texts: list[str | None]) -> dict:
        return {"terms": [sorted(set(terms(t))) for t in texts]}

    rows = items.select("item_id", "text").distinct()
    found = stored(map_batches(rows, ["text"], ["item_id"], "terms array<binary>", find), "lexical-items")
    return stored(found.withColumn("item", F.monotonically_increasing_id()), "lexical-numbered")


def document_terms(docs: DataFrame, vocabulary: DataFrame, lookup_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """doc_id, n (all terms of the text, with repeats), and the numbers and counts of the terms that are in vocabulary (term, number)."""
    size = vocabulary.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    if size <= lookup_bytes:
        held = vocabulary.toArrow().to_pydict()
        known = docs.sparkSession.sparkContext.broadcast(dict(zip(held["term"], held["number"], strict=True)))

        def find(texts: list[str | None]) -> dict:
            sizes, where, counts, number = [], [], [], known.value
            for text in texts:
                words = terms(text)
                found = Counter(words)
                held = [(number[w], k) for w, k in found.items() if w in number]
                sizes.append(len(words))
                where.append([t for t, _ in held])
                counts.append([k for _, k in held])
            return {"n": sizes, "terms": where, "counts": counts}

        return map_batches(docs.select("doc_id", "text"), ["text"], ["doc_id"], "n long, terms array<long>, counts array<long>", find)

    def every(texts: list[str | None]) -> dict:
        out: dict[str, list] = {"rows": [], "n": [], "term": [], "count": []}
        for k, text in enumerate(texts):
            words = terms(text)
            for word, count in [(None, 0), *Counter(words).items()]:
                for name, value in zip(out, (k, len(words), word, count), strict=True):
                    out[name].append(value)
        return out

    numbered = stored(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "lexical-documents")
    rows = map_batches(numbered, ["text"], ["doc_id", "row"], "n long, term binary, count long", every)
    rows = rows.join(vocabulary, "term", "left").filter("number IS NOT NULL OR term IS NULL")
    held = F.collect_list(F.when(F.col("number").isNotNull(), F.struct("number", "count")))
    rows = rows.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), held.alias("held"))
    return rows.select("doc_id", "n", F.col("held.number").alias("terms"), F.col("held.count").alias("counts"))


def item_blocks(items: DataFrame, vocabulary: DataFrame, documents: DataFrame, total: int) -> DataFrame:
    """Items with the weights of their terms, packed into blocks: ids, and starts, terms and weights as bytes of longs."""
    df = documents.select(F.explode("terms").alias("number")).groupBy("number").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * total + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = vocabulary.join(df, "number").select("term", "number", weight.alias("weight"))
    rows = items.select("item", "item_id", F.explode("terms").alias("term")).join(weights, "term")
    rows = rows.groupBy("item").agg(F.first("item_id").alias("item_id"), F.sort_array(F.collect_list(F.struct("number", "weight"))).alias("held"))
    rows = stored(rows.select("item", "item_id", "held.number", "held.weight"), "lexical-weights")
    size = rows.agg(F.sum(F.size("number"))).first()[0] or 0

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = [], 0
        for batch in batches:
            for item in zip(*[batch.column(c).to_pylist() for c in ("item_id", "number", "weight")], strict=True):
                held.append(item)
                entries += len(item[1])
                if entries >= BLOCK_ENTRIES or len(held) >= BLOCK_ITEMS:
                    yield packed(held)
                    held, entries = [], 0
        if held:
            yield packed(held)

    def packed(held: list) -> pa.RecordBatch:
        starts = np.cumsum([0, *[len(t) for _, t, _ in held]])
        longs = [np.concatenate([np.asarray(x[k], np.int64) for x in held]).tobytes() for k in (1, 2)]
        values = [([i for i, _, _ in held], pa.list_(pa.int64())), *[(x, pa.binary()) for x in (starts.tobytes(), *longs)], (2 * len(longs[0]), pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], ["ids", "starts", "terms", "weights", "size"])

    made = with_package(rows.repartition(max(1, size // BLOCK_ENTRIES))).mapInArrow(step, "ids array<long>, starts binary, terms binary, weights binary, size long")
    return stored(made.select(F.monotonically_increasing_id().alias("block"), "*"), "lexical-blocks")


class Shard:
    """Sparse rows over the shard's own columns, with a ball tree over them."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, numbers: np.ndarray, impacts: np.ndarray, nodes: tuple | None = None):
        self.ids, self.lengths = ids, lengths
        self.offsets = np.cumsum(lengths) - lengths
        self.columns, self.at = np.unique(numbers, return_inverse=True)
        self.impacts = impacts
        self.squares = np.add.reduceat(np.append(impacts.astype(np.float64) ** 2, 0.0), np.minimum(self.offsets, len(impacts))) * (lengths > 0)
        if nodes:
            *kept, radius = nodes
            centres = [self._centre(kept[0][a:b]) for a, b in zip(kept[1], kept[2], strict=True)]
            self.tree = balls.Tree(*kept, np.stack(centres), radius)
        else:
            self.tree = balls.build(len(ids), ids, LEAF_ROWS, self._ball, self._side)

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and for each the place of its row among ``rows``."""
        lengths = self.lengths[rows]
        of = np.repeat(np.arange(len(rows)), lengths)
        return np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(self.offsets[rows], lengths), of

    def _dots(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        where, of = self.entries(rows)
        return np.bincount(of, self.impacts[where] * vector[self.at[where]], len(rows))

    def _distances(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        square = (vector * vector).sum()
        largest = self.squares[rows] + square
        return np.sqrt(np.maximum(largest - 2 * self._dots(rows, vector), 0) + SQUARE_ROUNDING * largest)

    def _centre(self, rows: np.ndarray) -> np.ndarray:
        where, _ = self.entries(rows)
        return np.bincount(self.at[where], self.impacts[where], len(self.columns)) / len(rows)

    def _ball(self, rows: np.ndarray) -> tuple:
        centre = self._centre(rows)
        return centre, self._distances(rows, centre)

    def _side(self, rows: np.ndarray, away: np.ndarray) -> np.ndarray:
        one = self._centre(rows[[away.argmax()]])
        other = self._centre(rows[[self._distances(rows, one).argmax()]])
        return self._dots(rows, other - one)

    def search(self, starts: np.ndarray, numbers: np.ndarray, weights: np.ndarray, best: balls.Best) -> int:
        """Adds the shard's rows to ``best`` for a block of items."""
        items, n = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), len(starts) - 1
        place = np.minimum(np.searchsorted(self.columns, numbers), max(0, len(self.columns) - 1))
        here = self.columns[place] == numbers if len(self.columns) else np.zeros(len(numbers), bool)
        if not here.any():
            return 0
        used, column = np.unique(place[here], return_inverse=True)
        asked = np.zeros((n, len(used)), np.int64)
        asked[items[here], column] = weights[here]
        q = asked.astype(np.float64)
        norms = np.sqrt((q * q).sum(axis=1)) * (1 + balls.ROUNDING)
        centres = self.tree.centre[:, used]
        bounds = balls.upper_bounds(q @ centres.T, norms, np.sqrt((centres * centres).sum(axis=1)), self.tree.radius)
        exact = q.sum(axis=1).max() * self.impacts.max(initial=0) < balls.EXACT
        local = np.full(len(self.columns), -1)
        local[used] = np.arange(len(used))

        def score(who: np.ndarray, rows: np.ndarray) -> tuple:
            where, of = self.entries(rows)
            at = local[self.at[where]]
            kept = at >= 0
            some, column = np.unique(at[kept], return_inverse=True)
            block = np.zeros((len(rows), len(some)), np.float64 if exact else np.int64)
            block[of[kept], column] = self.impacts[where[kept]]
            source = q if exact else asked
            found = (source[np.ix_(who, some)] @ block.T).astype(np.int64)
            found[found <= 0] = balls.NO_SCORE
            return found, self.ids[rows]

        return balls.search(self.tree, bounds, best, score)


def index(rows: DataFrame, documents: int, length: int) -> DataFrame:
    """The shards of document_terms() with their trees, one row each. documents and length: how many hold a term, and all terms."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = [], 0
        for batch in (part for whole in batches for part in cut_batch(whole)):
            for row in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n", "terms", "counts")], strict=True):
                held.append(row)
                entries += len(row[2])
                if len(held) >= SHARD_ROWS or entries >= SHARD_ENTRIES:
                    yield packed(held)
                    held, entries = [], 0
        if held:
            yield packed(held)

    def packed(held: list) -> pa.RecordBatch:
        lengths = np.asarray([len(r[2]) for r in held], np.int64)
        numbers, counts = (np.concatenate([np.asarray(r[k], np.int64) for r in held]) for k in (2, 3))
        m = np.asarray([BASE + SLOPE * r[1] * documents // length for r in held], np.int64)
        impacts = GAIN * counts // (1000 * counts + 8 * np.repeat(m, lengths))
        shard = Shard(np.asarray([r[0] for r in held], np.int64), lengths, numbers, impacts)
        tree = shard.tree
        parts = [shard.ids, lengths, numbers, impacts, tree.order, tree.start, tree.end, tree.left, tree.least, tree.radius]
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts], _PARTS)

    made = with_package(rows.filter("doc_id IS NOT NULL AND size(terms) > 0")).mapInArrow(step, ", ".join(f"{c} binary" for c in _PARTS))
    return made.select(F.monotonically_increasing_id().alias("shard"), "*")


def _loaded(row: dict) -> Shard:
    longs = {c: np.frombuffer(row[c], np.int64) for c in _PARTS}
    nodes = [longs[c] for c in ("order", "starts", "ends", "lefts", "least")]
    return Shard(*[longs[c] for c in ("ids", "lengths", "numbers", "impacts")], (*nodes, np.frombuffer(row["radii"], np.float64)))


def _asked(shard: Shard, block: dict, best: balls.Best) -> int:
    return shard.search(*[np.frombuffer(block[c], np.int64) for c in ("starts", "terms", "weights")], best)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, lookup_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents (doc_id, text) of the highest score above 0 for every item (item_id, text).

    Ties go to the smaller doc_id. A null text has no terms. Rows without doc_id count in the statistics and are not ranked; repeated
    rows are documents of their own. Equal items ask once, also those without an id; an item without a known term gets no row. Empty
    tables give an empty result; other columns are left out.
    """
    asked = item_terms(items)
    vocabulary = asked.select(F.explode("terms").alias("term")).distinct()
    vocabulary = stored(stored(vocabulary, "lexical-words").withColumn("number", F.monotonically_increasing_id()), "lexical-vocabulary")
    rows = stored(document_terms(docs, vocabulary, lookup_bytes), "lexical-terms")
    documents, length = rows.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = stored(index(rows, documents, max(1, length)), "lexical-index")
    found = shard_search.top_k(shards, item_blocks(asked, vocabulary, rows, documents), k, _loaded, _asked)
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("found").alias("doc_id"), "score")
