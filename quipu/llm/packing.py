"""Packing token sequences by length patterns.

Documents become pieces of at most ``SIZE`` tokens. Patterns of two and three lengths that fill a sequence exactly are enumerated, and
non-negative least squares fits their repeat counts to the histogram of piece lengths. Counts are rounded down to what the histogram
holds; what is left is packed by best fit on the histogram, again as patterns with repeat counts. So the plan has a fixed size
however many pieces there are, and every piece finds its sequence from its rank among the pieces of its length.
"""

import array
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.columns import kept_apart
from quipu.llm.common import KEPT, map_batches, stored

SIZE = 2048
TOKENIZER = "word_bpe_49k.json"
PARTNERS = 12
ROUNDS = 200
SLICES = 4096
CACHE = 300_000

# Texts of these characters are split here, in the tokenizer's own way, and its model sees every distinct word once.
_PLAIN = re.compile("[\x20-\x7e\n\t\rÀ-ÿ]*")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes, equal to the tokenizer's own encode()."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.signs = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def _part(self, part: str) -> bytes:
        signs = part if part.isascii() else "".join([self.signs[b] for b in part.encode()])
        return array.array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()

    def _word(self, word: str) -> bytes:
        ids = b""
        for part in _PARTS.findall(word):
            known = self.parts.get(part)
            if known is None:
                known = self.parts[part] = self._part(part)
            ids += known
        self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.words) > CACHE:
            self.words.clear()
        if len(self.parts) > CACHE:
            self.parts.clear()
        known = self.words.get
        return b"".join([w if (w := known(x)) is not None else self._word(x) for x in text.lower().split()])


_ENCODERS: dict[str, Encoder] = KEPT.setdefault("encoders", {})


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = 0) -> DataFrame:
    """docs without their text, one row per piece: piece, start, length, ids_crc32. A null text is empty: the end id alone. Other columns
    stay; one named like a result comes back as <name>_before."""
    made = ["piece", "start", "length", "ids_crc32"]
    stop = np.asarray([end], "<u4").tobytes()

    def cut(texts: list[str | None]) -> dict:
        encode = _encoder(tokenizer).encode
        rows, out = [], []
        for i, text in enumerate(texts):
            ids = encode(text or "") + stop
            for k in range(0, len(ids), 4 * size):
                part = ids[k : k + 4 * size]
                rows.append(i)
                out.append((k // (4 * size), k // 4, len(part) // 4, zlib.crc32(part)))
        return {"rows": rows} | dict(zip(made, zip(*out, strict=True) if out else [[]] * 4, strict=True))

    def cut_rows(rows: DataFrame) -> DataFrame:
        kept = [c for c in rows.columns if c != "text"]
        return map_batches(rows, ["text"], kept, "piece int, start long, length long, ids_crc32 long", cut, keeps="encoders")

    return kept_apart(docs, ["text"], cut_rows)


def few_document_patterns(counts: np.ndarray, partners: int = PARTNERS) -> np.ndarray:
    """(patterns, 3) lengths that fill a sequence exactly: pairs, and triples whose second length is one of the most frequent ones
    of a spread over all lengths. 0: no third document."""
    size = len(counts) - 1
    present = np.flatnonzero(counts)
    present = present[(present > 0) & (present < size)]
    found = {(int(a), int(size - a), 0) for a in present if a >= size - a and counts[size - a]}
    for group in np.array_split(present, partners) if len(present) else []:
        if len(group):
            best = int(group[np.argmax(counts[group])])
            for a in present:
                c = size - int(a) - best
                if c > 0 and counts[c]:
                    found.add(tuple(sorted((int(a), best, c), reverse=True)))
    return np.asarray(sorted(found), np.int64).reshape(-1, 3)


def fit_counts(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative repeat counts whose lengths come near the histogram in least squares: multiplicative steps, which keep them
    non-negative and need the sparse pattern matrix only."""
    x = np.ones(len(patterns))
    used = (patterns > 0).astype(float)
    take = lambda v: (v[patterns] * used).sum(axis=1)
    target = counts.astype(float)
    aim = take(target)
    for _ in range(rounds if len(patterns) else 0):
        made = np.bincount(patterns.ravel(), (x[:, None] * used).ravel(), len(counts))
        x *= aim / np.maximum(take(made), 1e-12)
    return x


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, longest first) and repeat counts that use up a histogram of lengths 0..size. Length 0 isn't packed."""
    size, left = len(counts) - 1, counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        out.append(((size,), int(left[size])))
        left[size] = 0
    patterns = few_document_patterns(left)
    fitted = np.floor(fit_counts(patterns, left)).astype(np.int64)
    for row in np.argsort(-fitted, kind="stable"):
        lengths = tuple(int(v) for v in patterns[row] if v)
        times = min([int(fitted[row]), *[int(left[v] // lengths.count(v)) for v in set(lengths)]])
        if times > 0:
            out.append((lengths, times))
            for v in lengths:
                left[v] -= times
    left[0] = 0
    while (present := np.flatnonzero(left)).size:
        room, lengths, used = size, [], np.zeros(len(left), np.int64)
        while True:
            fits = present[(present <= room) & (left[present] > used[present])]
            if not fits.size:
                break
            lengths.append(int(fits[-1]))
            used[fits[-1]] += 1
            room -= lengths[-1]
        held = np.flatnonzero(used)
        times = int((left[held] // used[held]).min())
        out.append((tuple(lengths), times))
        left[held] -= times * used[held]
    return out


def place_table(patterns: list[tuple[tuple[int, ...], int]], size: int) -> dict[str, np.ndarray]:
    """Runs of ranks: among the pieces of a length, ranks from ``first`` on belong to one pattern. A piece of rank r there is number
    (r - first) % each in sequence base + (r - first) // each, at offset + that number times its length."""
    runs, taken, base = [], np.zeros(size + 1, np.int64), 0
    for lengths, times in patterns:
        offset = 0
        for v in sorted(set(lengths), reverse=True):
            each = lengths.count(v)
            runs.append((v, taken[v], base, each, offset))
            taken[v] += each * times
            offset += each * v
        base += times
    runs.sort()
    names = ["length", "first", "base", "each", "offset"]
    return {n: np.asarray([r[i] for r in runs], np.int64) for i, n in enumerate(names)}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset: places there are gapless from 0, nothing beyond size.

    Ranks among equal lengths come from sums per (length, slice of a hash) and a sort within each, so a frequent length is split
    over many tasks. Repeated rows are pieces of their own; an empty table gives an empty result. Other columns stay; one named like a
    result comes back as <name>_before.
    """
    return kept_apart(pieces, ["doc_id", "piece", "length", "ids_crc32"], lambda rows: _packed(rows, size))


def _packed(pieces: DataFrame, size: int) -> DataFrame:
    rows = pieces.withColumn("__slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES)).cast("int"))
    rows = stored(rows, "packing-pieces")
    cells = stored(rows.groupBy("length", "__slice").agg(F.count("*").alias("n")), "packing-histogram")
    counts = np.zeros(size + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    table = place_table(plan(counts), size)
    before = Window.partitionBy("length").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    order = Window.partitionBy("length", "__slice").orderBy("doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("__rank", F.row_number().over(order)).join(cells, ["length", "__slice"])
    rows = rows.withColumn("__rank", F.col("__before") + F.col("__rank") - 1).drop("__before", "__slice")

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        # One sorted key for (length, rank): ranks of a length are below 2 ** 50.
        keys = table["length"] * (1 << 50) + table["first"]
        run = np.searchsorted(keys, n * (1 << 50) + r, "right") - 1
        past, each = r - table["first"][run], table["each"][run]
        return pd.DataFrame({"sequence_id": table["base"][run] + past // each, "offset": table["offset"][run] + past % each * n})

    found = rows.withColumn("__place", place("length", "__rank")).drop("__rank")
    return found.withColumns({"sequence_id": F.col("__place.sequence_id"), "offset": F.col("__place.offset")}).drop("__place")
