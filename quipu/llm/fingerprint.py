"""Document fingerprints by randomised edit embedding.

One random walk, shared by all documents, turns a text of n characters into a string of about 2 n: at step j it writes the current
character and moves on or stays, by a random bit of (j, character), up to the text's end. Texts a few edits apart fall back into step, so their strings differ in
few places: edit distance becomes Hamming distance. A fingerprint samples places of that string. Every slot of it samples by its own
random order of all places, the first of those that the string has, so that texts of different lengths share most of their samples.
Bands of slots give candidates, and a comparison of the whole fingerprints verifies them.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import bound, cut_batch, map_batches, no_rows, stored, whole_text, with_package
from quipu.scratch import run_folder

SLOTS = 128
STRETCH = 3
BANDS = 32
ALIKE = 0.8
#: Documents that all are compared with in a query: ids divisible by it. Queries that a task holds, and pairs compared, at a time.
ASK_EVERY = 50
QUERIES = 65_536
PAIRS = 65_536
#: Steps walked at a time, and characters of texts walked together.
BLOCK = 512
BATCH_CHARS = 2_000_000
_PERIOD = 8192
_SEED = 20_240_229


def limits(sizes: np.ndarray) -> np.ndarray:
    """Most steps of a walk: about two for a character, with room that chance practically never uses up."""
    return np.where(sizes > 0, STRETCH * sizes + 64, 0)


def _moves() -> np.ndarray:
    """Random bits of (step, character class); class 0 is the end of a text, where the walk stays."""
    bits = np.random.default_rng(_SEED).integers(0, 2, (_PERIOD, 256)).astype(np.int64)
    bits[:, 0] = 0
    return bits


class Sampler:
    """The places that slots sample, for any string length: the records of each slot's random order, found as far as needed."""

    def __init__(self, slots: int = SLOTS):
        self.rngs = [np.random.default_rng((_SEED, s)) for s in range(slots)]
        self.records = [[0] for _ in range(slots)]
        self.values = [float(r.random()) for r in self.rngs]
        self.reach = 1

    def _extend(self, length: int) -> None:
        """Records up to length: the next place with a smaller value comes after a geometric gap."""
        for rng, records, s in zip(self.rngs, self.records, range(len(self.rngs)), strict=True):
            while records[-1] < length:
                v = max(self.values[s], 1e-300)
                gap = np.floor(np.log1p(-rng.random()) / np.log1p(-min(v, 1 - 1e-16))) + 1
                records.append(int(min(records[-1] + gap, 2**62)))
                self.values[s] = v * rng.random()
        self.reach = length

    def places(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, slot, place), by place: all that may be a slot's sample in texts of these sizes. A walk takes ``size`` steps at
        least, so that is the last record below size and those from there to the most steps."""
        most = limits(sizes)
        if len(most) and most.max() > self.reach:
            self._extend(int(most.max()))
        parts = []
        for s, records in enumerate(self.records):
            r = np.asarray(records, np.int64)
            low = np.maximum(np.searchsorted(r, sizes, "left") - 1, 0)
            count = np.where(sizes > 0, np.searchsorted(r, most, "left") - low, 0)
            rows = np.repeat(np.arange(len(sizes)), count)
            at = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            parts.append((rows, np.full(len(rows), s), r[at]))
        rows, slots, when = (np.concatenate([p[k] for p in parts]) for k in range(3))
        turn = np.argsort(when, kind="stable")
        return rows[turn], slots[turn], when[turn]


_STATE: dict = {}


def _state() -> dict:
    if not _STATE:
        _STATE.update(moves=_moves(), sampler=Sampler())
    return _STATE


def _classes(text: str) -> np.ndarray:
    """Character classes 1..255."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return (points % np.uint32(255) + np.uint32(1)).astype(np.uint8)


def embed(texts: list[str]) -> np.ndarray:
    """(texts, SLOTS) fingerprints in bytes: a hash of each sampled place and the character written there; 0 for empty texts.

    All texts walk together, the longest first, so that those that have ended drop off the end.
    """
    moves, sampler = _state()["moves"], _state()["sampler"]
    order = np.argsort([-len(t) for t in texts], kind="stable")
    classes = [_classes(texts[k]) for k in order]
    sizes = np.asarray([len(c) for c in classes], np.int64)
    flat = np.concatenate([np.append(c, np.uint8(0)) for c in classes]) if classes else np.zeros(1, np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    at = ends - sizes
    rows, slots, when = sampler.places(sizes)
    out = np.zeros((len(texts), SLOTS), np.uint8)
    longest = int(limits(sizes[:1])[0]) if len(sizes) else 0
    done, active = 0, len(sizes)
    for start in range(0, longest, BLOCK):
        walking = np.flatnonzero(at[:active] < ends[:active])
        active = int(walking[-1]) + 1 if len(walking) else 0
        if not active:
            break
        steps = min(BLOCK, longest - start)
        written, pos = np.empty((steps, active), np.uint8), at[:active]
        for k in range(steps):
            c = written[k]
            np.take(flat, pos, out=c)
            pos += moves[(start + k) % _PERIOD].take(c)
        stop = int(np.searchsorted(when, start + steps, "left"))
        here = rows[done:stop] < active
        r, s, w = rows[done:stop][here], slots[done:stop][here], when[done:stop][here]
        sign = written[w - start, r]
        # Later records replace earlier ones, up to the end of the walk, where 0 is written.
        r, s, w, sign = (x[sign > 0] for x in (r, s, w, sign))
        mixed = (w.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + sign.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        out[order[r], s] = (mixed >> np.uint64(33)) % np.uint64(255) + np.uint64(1)
        done = stop
    return out


def embed_all(texts: list[str]) -> np.ndarray:
    """embed() in groups of about BATCH_CHARS characters; a longer text is a group of its own."""
    parts, group, held = [], [], 0
    for t in texts:
        if group and held + len(t) > BATCH_CHARS:
            parts.append(embed(group))
            group, held = [], 0
        group.append(t)
        held += len(t)
    parts.append(embed(group))
    return np.concatenate(parts)


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots, less what chance gives; 1 for two empty texts."""
    same = (a == b).mean(axis=-1)
    return np.clip((same - 1 / 255) / (1 - 1 / 255), 0.0, 1.0)


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with fingerprint (lowercase hex of SLOTS bytes) in place of their text. Equal texts have equal fingerprints; a null or
    empty one has zeros only."""
    kept = [c for c in docs.columns if c not in ("text", "fingerprint")]
    walk = lambda texts: {"fingerprint": [f.tobytes().hex() for f in embed_all([t or "" for t in texts])]}
    return map_batches(docs, ["text"], kept, "fingerprint string", walk)


def _band_keys(prints: np.ndarray, bands: int) -> np.ndarray:
    """(bands, texts): a number for every band of slots; equal bands have equal numbers."""
    cut = prints.reshape(len(prints), bands, SLOTS // bands)
    keys = np.zeros(cut.shape[:2], np.uint64)
    for k in range(cut.shape[2]):
        keys = keys * np.uint64(0x100000001B3) + cut[:, :, k]
    return np.ascontiguousarray(keys.T)


class Asked:
    """A block of fingerprints that others are compared with, their bands in order."""

    def __init__(self, prints: np.ndarray, bands: int):
        self.prints, self.bands = prints, bands
        keys = _band_keys(prints, bands)
        self.turn = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.turn, 1)

    def agreeing(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places in prints, places here, likeness) of all pairs that agree in a whole band, each once, about PAIRS at a time."""
        for k, own in enumerate(_band_keys(prints, self.bands)):
            low = np.searchsorted(self.keys[k], own, "left")
            count = np.searchsorted(self.keys[k], own, "right") - low
            some = np.flatnonzero(count)
            ends = np.cumsum(count[some])
            for start in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
                at = np.arange(start, min(start + PAIRS, int(ends[-1])))
                which = np.searchsorted(ends, at, "right")
                rows = some[which]
                asked = self.turn[k, low[rows] + at - (ends[which] - count[rows])]
                a, b = prints[rows], self.prints[asked]
                whole = (a == b).reshape(len(at), self.bands, -1).all(axis=2)
                # A pair counts in the first band that it agrees in.
                new = whole[:, k] & ~whole[:, :k].any(axis=1)
                yield rows[new], asked[new], alike(a[new], b[new])


def _bytes_of(prints: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(prints)), np.uint8).reshape(len(prints), SLOTS)


def _searched(rows: DataFrame, queries: DataFrame, used: list[str], made: str, find: Callable[..., dict], bands: int, block: int) -> DataFrame:
    """The DDL ``made`` of find(Asked, the block's queries, used columns of rows), for all rows and all queries.

    A block of queries (stored, with a fingerprint) at a time goes to the tasks, so that no bucket of a band meets in one task and no
    pair is shuffled.
    """
    spark = rows.sparkSession
    folder = run_folder(spark, "fingerprint-found")
    no_rows(spark, made).write.mode("append").parquet(folder)
    blocks = -(-queries.count() // block)
    for b in range(blocks):
        held = queries.filter(F.pmod(F.xxhash64("fingerprint"), F.lit(blocks)) == b).collect()
        if not held:
            continue
        prints, own = _bytes_of([r["fingerprint"] for r in held]), [r.asDict() for r in held]

        def compute(*columns: list, prints=prints, own=own, ready=[]) -> dict:  # noqa: B006
            if not ready:
                ready.append(Asked(prints, bands))
            return find(ready[0], own, *columns)

        map_batches(rows, used, [], made, compute).write.mode("append").parquet(folder)
    return spark.read.schema(made).parquet(folder)


def partners(prints: DataFrame, queries: DataFrame, alike_from: float = ALIKE, bands: int = BANDS, block: int = QUERIES) -> DataFrame:
    """fingerprint and partners, the number of other fingerprints among the queries' that share a band with it and are alike.

    prints and queries have a column fingerprint, in hex; prints is stored. Fingerprints without partners have no row.
    """

    def find(asked: Asked, own: list[dict], texts: list[str]) -> dict:
        different = list(dict.fromkeys(texts))
        n = np.zeros(len(different), np.int64)
        for rows, _, near in asked.agreeing(_bytes_of(different)) if different else ():
            n += np.bincount(rows[(near >= alike_from) & (near < 1)], minlength=len(n))
        found = np.flatnonzero(n)
        return {"fingerprint": [different[k] for k in found], "block": [own[0]["fingerprint"]] * len(found), "n": n[found]}

    asked = stored(queries.select("fingerprint").distinct(), "fingerprint-queries")
    found = _searched(prints, asked, ["fingerprint"], "fingerprint string, block string, n long", find, bands, block)
    # Several batches may hold a fingerprint; a block gives it the same number in each.
    return found.groupBy("fingerprint", "block").agg(F.max("n").alias("n")).groupBy("fingerprint").agg(F.sum("n").alias("partners"))


def near_pairs(docs: DataFrame, alike_from: float = ALIKE, bands: int = BANDS, asked: Column | None = None, block: int = QUERIES) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs of representatives (a < b, likeness) that agree in a whole band and are alike, and every doc_id's
    representative, the smallest id of its fingerprint.

    Copies are never paired with each other. All members of a band are compared with the queries among them: the fingerprints of
    documents for which ``asked`` holds; None: of all. Likeness is a sample's: the pairs are a search result, not a complete join.
    """
    prints = stored(fingerprints(docs.select("doc_id", "text")), "fingerprints")
    which = F.lit(True) if asked is None else F.coalesce(asked, F.lit(False))
    heads = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"), F.max(which).alias("asked"))
    heads = stored(heads, "fingerprint-heads")
    members = prints.join(heads.drop("asked"), "fingerprint").select("doc_id", "rep")

    def find(block: Asked, own: list[dict], texts: list[str], reps: list[int], also: list[bool]) -> dict:
        a, b, likeness = [], [], []
        for rows, places, near in block.agreeing(_bytes_of(texts)) if texts else ():
            for k, j, x in zip(rows.tolist(), places.tolist(), near.tolist(), strict=True):
                one, other = reps[k], own[j]["rep"]
                # Two queries meet twice.
                if x >= alike_from and one != other and not (also[k] and one < other):
                    a.append(min(one, other))
                    b.append(max(one, other))
                    likeness.append(x)
        return {"a": a, "b": b, "likeness": likeness}

    known = heads.filter("rep IS NOT NULL")
    queries = known.filter("asked").select("fingerprint", "rep")
    return _searched(known, queries, ["fingerprint", "rep", "asked"], "a long, b long, likeness double", find, bands, block), members


def _range_of(value: Column, cuts: list) -> Column:
    """How many of the descending cuts are above the value, by binary search; all of them for a null."""
    if not cuts:
        return F.lit(0)
    array = F.array(*[F.lit(c) for c in cuts])

    def search(low: Column, step: int) -> Column:
        if not step:
            return low
        return bound(F.when(F.get(array, low + step - 1) > value, low + step).otherwise(low), lambda x: search(x, step // 2))

    return F.when(value.isNull(), len(cuts)).otherwise(search(F.lit(0), 1 << (len(cuts).bit_length() - 1)))


def with_successor(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text and following, the text of the next document by descending doc_id; the last one's is the first's.

    Ids are dealt to ranges, sorted within each, and the head of the next lower range is sent along, so nothing but the ranges'
    bounds is gathered. Rows of one id follow each other in the order of their texts; rows without id come last.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", whole_text().alias("text"))
    count = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2)
    cuts = rows.select(F.percentile_approx("doc_id", [k / count for k in range(1, count)], 100 * count)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    at = rows.withColumn("__bucket", _range_of(F.col("doc_id"), cuts))
    heads = {r["__bucket"]: r["id"] for r in at.groupBy("__bucket").agg(F.max("doc_id").alias("id")).collect()}
    # The head of a range closes the range before it; the first range's head closes the last.
    filled = sorted(heads)
    before = {b: filled[k - 1] for k, b in enumerate(filled)}
    of = lambda values, kind: F.get(F.array(*[F.lit(values.get(k)).cast(kind) for k in range(len(cuts) + 1)]), F.col("__bucket"))
    sent = F.when(F.col("doc_id").eqNullSafe(of(heads, "long")), F.array(of(before, "int"))).otherwise(F.array().cast("array<int>"))
    own = F.struct(F.col("__bucket").alias("range"), F.lit(0).alias("closing"))
    copies = F.concat(F.array(own), F.transform(sent, lambda b: F.struct(b.alias("range"), F.lit(1).alias("closing"))))
    dealt = at.select("doc_id", "text", F.inline(copies))
    dealt = dealt.repartition(max(count, 1), "range").sortWithinPartitions("range", "closing", F.col("doc_id").desc_nulls_last(), "text")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in (part for whole in batches for part in cut_batch(whole)):
            out = []
            for doc_id, text, part, closing in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "range", "closing")], strict=True):
                if last is not None and last[2] == part:
                    out.append({"doc_id": last[0], "text": last[1], "following": text})
                # Of the rows sent along, the first closes the range.
                last = None if closing else (doc_id, text, part)
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("following", pa.string())])
    return with_package(dealt).mapInArrow(follow, "doc_id long, text string, following string")


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the following text."""
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]
