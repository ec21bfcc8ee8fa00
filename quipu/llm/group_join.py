"""Near copies by shingle sets: a similarity join with a token-group matrix.

Documents are sets of 5-word shingles. Equal sets are one class. Classes that share a rare shingle with an anchor and prove similar
to it form groups, the others are alone or, where many share their shingles, form loose groups by family; the matrix holds, for every shingle that matters, the groups whose union has it. A
query opens only the groups whose overlap bound allows a similar member; members are compared on the whole sets, a part of a group at a
time inside a task. "Shingles that matter" are the first n - ceil(0.8 n) + 1 of a set in one order for all documents: two sets with
similarity 0.8 have one of them in common. The order puts shingles that many documents share last, so that common passages hardly ever
matter.

The bound: if two sets share c shingles up to one that stands at places i and j of their orders, they share at most c plus what
either has after it, min(|x| - 1 - i, |y| - 1 - j). A similarity of 0.8 needs an overlap of 0.8 / 1.8 (|x| + |y|).
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.common import KEPT, SMALL_ROWS, discard, lean, map_batches, small_side, stored, text_batches, whole_text, with_package
from quipu.llm.components import components

WORDS = 5
PERCENT = 80
#: Share and number of documents looked at, at most, for the order of shingles, and in how many of them a common one is. Any order
#: gives the same links; this one keeps passages that many documents share at its end.
SHARE_SEEN = 1 / 8
SAMPLE = 400_000
COMMON = 2
#: Common shingles that are kept, the most frequent ones, at most.
COMMON_MOST = 2_000_000
#: Pairs that are verified together, about.
SHARE = 500
#: Members of its family that a class is first compared with, at most.
TRIES = 6
#: A loose class whose shingles so many classes have, at most, is a group of its own.
FEW = 64
#: Classes that ask and classes that are asked in one part of a group, about.
ASKING, ASKED = 256, 2048
_CACHE = 200_000
_FACTORS = np.asarray([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_HASHES: dict[bytes, int] = KEPT.setdefault("hashes", {})


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's 5-word shingles, A-Z in lower case; of all its words where there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_HASHES) > _CACHE:
        _HASHES.clear()
    for w in words:
        if w not in _HASHES:
            _HASHES[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        total += h[k : len(h) - size + 1 + k] * _FACTORS[k]
    return np.unique(_mixed(total))


def _ordered(s: np.ndarray, common: int) -> np.ndarray:
    """Shingles as longs in the common order: rare ones by hash, then common ones."""
    return ((s >> np.uint64(2)) | np.uint64(common << 62)).view(np.int64)


def _least(n: int) -> int:
    """Overlap that a partner of a set of n needs at least."""
    return -(-PERCENT * n // 100)


def _sets(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, class_key and the shingles that matter: rare ones and common ones apart."""

    def find(texts: list[str | None]) -> dict:
        sizes, keys, rare, often = [], [], [], []
        for text in texts:
            s = shingles(text or "")
            sizes.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()))
            need = len(s) - _least(len(s)) + 1 if len(s) else 0
            place = np.minimum(np.searchsorted(common, s), max(len(common) - 1, 0))
            is_common = common[place] == s if len(common) else np.zeros(len(s), bool)
            own = s[~is_common][:need]
            more = s[is_common][: need - len(own)]
            rare.append(_ordered(own, 0))
            often.append(_ordered(more, 1))
        return {"n_shingles": sizes, "class_key": keys, "rare": rare, "often": often}

    return map_batches(docs, ["text"], ["doc_id"], "n_shingles long, class_key binary, rare array<long>, often array<long>", find)


def common_shingles(docs: DataFrame, sample: int = SAMPLE, share: float = SHARE_SEEN) -> np.ndarray:
    """Shingles that COMMON or more different sets of a bounded sample have; of the lower half by hash, where those that matter are."""
    share = min(share, sample / max(1, docs.count()))
    few = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))

    def find(texts: list[str | None]) -> dict:
        sets = [shingles(t or "") for t in texts]
        return {"shingles": [s[: np.searchsorted(s, np.uint64(1 << 63))].view(np.int64) for s in sets]}

    sets = map_batches(few.select("text").distinct(), ["text"], [], "shingles array<long>", find).distinct()
    counts = sets.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON)
    counts = stored(counts, "near-common")
    least, left = COMMON, COMMON_MOST
    for n, shingles_of_n in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        left -= shingles_of_n
        if left < 0:
            least = n + 1
            break
    counts = counts.filter(F.col("n") >= least)
    return np.sort(counts.select("s").toPandas()["s"].to_numpy(np.int64).view(np.uint64))


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes of the text and the text packed, so that a shuffle moves less of it."""

    def pack(texts: list[str | None]) -> dict:
        codec = pa.Codec("zstd", 1)
        raw = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
        return {"n_bytes": [len(t) for t in raw], "packed": [codec.compress(t, asbytes=True) for t in raw]}

    return map_batches(docs, ["text"], ["doc_id"], "n_bytes int, packed binary", pack)


def _unpacked(n_bytes: int, packed: bytes) -> str:
    return pa.Codec("zstd").decompress(packed, n_bytes, asbytes=True).decode("utf-8", "surrogatepass")


def _texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """doc_id, n_bytes and packed, once for every needed id. Where the needed ids are too many to be broadcast, texts are packed first."""
    if needed.count() <= SMALL_ROWS:
        found = _packed(docs.join(F.broadcast(needed), "doc_id", "left_semi"))
    else:
        found = _packed(docs).join(needed, "doc_id", "left_semi")
    return found.groupBy("doc_id").agg(F.first(F.struct("n_bytes", "packed")).alias("text")).select("doc_id", "text.n_bytes", "text.packed")


def verified(pairs: DataFrame, texts: DataFrame, families: DataFrame) -> DataFrame:
    """pairs (a, b) whose sets are similar. texts: doc_id, n_bytes, packed of every id in pairs; families: rep, family.

    A class is a in few pairs; it may be b in many. Pairs are dealt by their two families, so that a text goes to few places; a large
    pair of families is cut into parts of about SHARE pairs by a, each with the texts that it names.
    """
    of = lambda c: families.select(F.col("rep").alias(c), F.col("family").alias(f"f{c}"))
    keyed = pairs.join(of("a"), "a").join(of("b"), "b")
    keyed = stored(keyed.select("a", "b", F.least("fa", "fb").alias("lo"), F.greatest("fa", "fb").alias("hi")), "near-keyed")
    parts = keyed.groupBy("lo", "hi").agg(F.ceil(F.count("*") / SHARE).alias("parts")).filter("parts > 1")
    parts = stored(parts, "near-parts")
    part = F.coalesce(F.pmod(F.xxhash64("a"), F.col("parts")), F.lit(0))
    dealt = keyed.join(small_side(parts), ["lo", "hi"], "left").select("a", "b", "lo", "hi", part.alias("part"))
    keyed, spent = stored(dealt, "near-dealt"), (keyed, parts)
    discard(*spent)
    names = stored(keyed.select("lo", "hi", "part", F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "near-named")
    named = small_side(names).join(texts, "doc_id")
    none = [F.lit(None).cast("int").alias("n_bytes"), F.lit(None).cast("binary").alias("packed")]
    rows = named.select("lo", "hi", "part", F.lit(0).alias("role"), F.col("doc_id").alias("a"), F.col("doc_id").alias("b"), "n_bytes", "packed")
    rows = rows.unionByName(keyed.select("lo", "hi", "part", F.lit(1).alias("role"), "a", "b", *none))

    columns = rows.columns

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets, of = {}, None
        for batch in batches:
            out = []
            for *key, role, a, b, size, packed in zip(*[batch[c] for c in columns], strict=True):
                if key != of:
                    sets, of = {}, key
                if role == 0:
                    sets[a] = shingles(_unpacked(int(size), packed))
                    continue
                x, y = sets[a], sets[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= PERCENT * (len(x) + len(y) - both):
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    rows = with_package(rows).repartition("lo", "hi", "part").sortWithinPartitions("lo", "hi", "part", "role")
    links = stored(rows.mapInPandas(lean(test), "a long, b long"), "near-links")
    discard(keyed, names)
    return links


def _ranks() -> list[Column]:
    """Orders of classes; the first of a shingle's classes in each of them is an anchor."""
    return [F.col("rep"), *[F.xxhash64("rep", F.lit(k)) for k in range(1, TRIES)]]


def _shared(rows: DataFrame) -> DataFrame:
    """rows (shingle, rep) of shingles that two or more (holders) have, with their anchors. Where many classes share most of their
    shingles, these name the same few of them."""
    first = [F.min_by("rep", rank) for rank in _ranks()]
    found = rows.groupBy("shingle").agg(F.count("*").alias("holders"), F.array(*first).alias("anchors")).filter("holders > 1")
    return rows.join(found, "shingle")


def _shared_rare(rows: DataFrame) -> DataFrame:
    """The same of rare shingles, which most often one class alone has: the rows are dealt and sorted once, and what a task holds doesn't
    grow with the number of its shingles. Anchors are looked for among the rows that stay."""
    alike = Window.partitionBy("shingle")
    found = rows.withColumn("holders", F.count("*").over(alike)).filter("holders > 1")
    return found.withColumn("anchors", F.array(*[F.min_by("rep", rank).over(alike) for rank in _ranks()]))


def _first_pairs(matter: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b): every class and the anchor of each order that it shares most shingles with, a tenth of those that matter at least."""
    named = matter.select("rep", F.posexplode("anchors").alias("rank", "anchor")).filter("rep <> anchor")
    met = named.groupBy("rep", "rank", "anchor").agg(F.count("*").alias("n"))
    best = met.groupBy("rep", "rank").agg(F.max(F.struct("n", -F.col("anchor"))).alias("best"))
    best = best.join(sizes, "rep").filter(F.col("best.n") * 10 * 100 >= F.col("n_shingles") * (100 - PERCENT))
    return best.select(F.col("rep").alias("a"), (-F.col("best.col2")).alias("b")).distinct()


def near_copies(docs: DataFrame, sample: int = SAMPLE, share: float = SHARE_SEEN) -> DataFrame:
    """One row per row of docs (doc_id long, text): doc_id, n_shingles, component_id, the smallest doc_id that links lead to.

    Documents without words or text have an empty set, link with nothing and are their own component. Equal texts, repeated rows
    among them, are linked. A row without an id takes its class's component; alone it has none. An empty table gives an empty
    result. No link is left out, and no group of copies is expanded into pairs.
    """
    with text_batches(docs.sparkSession):
        return _near_copies(docs.select("doc_id", "text"), sample, share)


def _near_copies(docs: DataFrame, sample: int, share: float) -> DataFrame:
    sets = stored(_sets(docs, common_shingles(docs, sample, share)), "near-sets")
    rows = stored(sets.select("doc_id", "n_shingles", "class_key"), "near-rows")
    classes = rows.filter("n_shingles > 0").groupBy("class_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    repeats = stored(classes.filter("copies > 1").select("class_key", "rep"), "near-classes")
    whole = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(small_side(repeats), "class_key", "left")
    whole = whole.filter("rep IS NULL OR rep = doc_id").select(F.col("doc_id").alias("rep"), "n_shingles", "rare", "often")

    names = ["shingle", "rep", "pos", "holders", "anchors"]
    rare = whole.select("rep", F.posexplode("rare").alias("pos", "shingle"))
    often = whole.select("rep", F.size("rare").alias("first"), F.posexplode("often").alias("pos", "shingle"))
    often = often.select("rep", (F.col("first") + F.col("pos")).alias("pos"), "shingle").distinct()
    matter = stored(_shared_rare(rare).select(*names).unionByName(_shared(often).select(*names)), "near-shared")
    needed = stored(matter.select(F.col("rep").alias("doc_id")).distinct(), "near-needed")
    sizes = whole.select("rep", "n_shingles").join(needed.withColumnRenamed("doc_id", "rep"), "rep", "left_semi")
    sizes = stored(sizes.distinct(), "near-sizes")
    discard(sets)
    families = matter.groupBy("rep").agg(F.min(F.get("anchors", F.lit(0))).alias("family"), F.max("holders").alias("holders"))
    families = stored(families, "near-families")
    texts = stored(_texts(docs, needed), "near-texts")

    # Groups: classes that prove similar to an anchor; the others alone or by family. Any grouping will do: what it leaves out is found
    # below.
    pairs = stored(_first_pairs(matter, sizes), "near-pairs")
    links = [verified(pairs, texts, families)]
    labels = components(links[0])
    groups = stored(_groups(sizes, labels, families), "near-groups")
    asks = _asks(matter, groups)
    discard(pairs, matter, labels, families, sizes, needed)
    links.append(_compared(asks, groups, texts))
    discard(asks, groups, texts)
    labels = components(_union(links))
    discard(*links)
    return _labelled(rows, repeats, labels)


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _groups(sizes: DataFrame, labels: DataFrame, families: DataFrame) -> DataFrame:
    """rep, n (its size), team, loose and weight (by which groups are ordered: classes, then number). Linked classes are a group. A class
    without a link is a loose one alone, so that it is asked by no more classes than its own size and overlap allow; where more than FEW
    have one of its shingles, it is in a loose group with others of its family, and rows don't grow with the square of the holders."""
    found = sizes.join(labels, F.col("rep") == F.col("node"), "left").join(families, "rep")
    loose = F.when(F.col("holders") <= FEW, F.col("rep")).otherwise(F.col("family"))
    team = F.struct(F.col("label").isNull().alias("loose"), F.coalesce("label", loose).alias("number"))
    teams = stored(found.select("rep", F.col("n_shingles").alias("n"), team.alias("team")), "near-teams")
    weights = stored(teams.groupBy("team").agg(F.count("*").alias("classes")).filter("classes > 1"), "near-weights")
    weight = F.struct(F.coalesce("classes", F.lit(1)).alias("classes"), "team")
    return teams.join(small_side(weights), "team", "left").select("rep", "n", "team", weight.alias("weight"))


def _overlap(n: Column, m: Column) -> Column:
    """Overlap that sets of n and m need."""
    return F.ceil(PERCENT * (n + m) / F.lit(100 + PERCENT))


def _may_link(n: Column, pos: Column, lo: Column, hi: Column, rest: Column) -> Column:
    """Whether a set of n may be similar to one of lo to hi, if a shingle at pos of its order, with at most ``rest`` after it in the
    other's, is their first common one. What this drops of a pair's common shingles comes after what it keeps."""
    asked = _overlap(n, F.greatest(lo, F.ceil(PERCENT * n / F.lit(100))))
    return (100 * hi >= PERCENT * n) & (PERCENT * lo <= 100 * n) & (n - pos >= asked) & (rest + 1 >= asked)


def _asks(matter: DataFrame, groups: DataFrame) -> DataFrame:
    """Stored (a, team): classes and the groups that they must open. Of two groups the classes of the smaller one ask, and the classes
    of a loose group ask each other."""
    rows = matter.select("shingle", "rep", "pos").join(groups, "rep")
    mixed = rows.groupBy("shingle").agg(F.min("team").alias("lo"), F.max("team").alias("hi"), F.count("*").alias("n"))
    mixed = mixed.filter("lo <> hi OR (lo.loose AND n > 1)").select("shingle")
    rows = stored(rows.join(mixed, "shingle", "left_semi"), "near-grouped")
    matrix = rows.groupBy("shingle", "team").agg(
        F.min("rep").alias("head"), F.max("rep").alias("tail"), F.min("n").alias("lo"), F.max("n").alias("hi"),
        F.max(F.col("n") - 1 - F.col("pos")).alias("rest"), F.first("weight").alias("weight"),
    )
    queries = rows.select("shingle", F.col("rep").alias("a"), "n", "pos", F.col("team").alias("own"), F.col("weight").alias("own_weight"))
    near = _may_link(F.col("n"), F.col("pos"), F.col("lo"), F.col("hi"), F.col("rest"))
    alone = F.col("head") == F.col("tail")
    turn = (F.col("own_weight") < F.col("weight")) | ((F.col("own") == F.col("team")) & F.col("team.loose") & ~(alone & (F.col("a") == F.col("head"))))
    met = queries.join(matrix, "shingle").filter(turn & near)
    end = F.max(F.struct("shingle", F.least(F.col("n") - 1 - F.col("pos"), F.col("rest")).alias("left"), "lo")).alias("end")
    bound = met.groupBy("a", "n", "team").agg(F.count("*").alias("c"), F.min("head").alias("head"), F.max("tail").alias("tail"), end)
    enough = F.col("c") + F.col("end.left") >= _overlap(F.col("n"), F.col("end.lo"))
    found = stored(bound.filter(~alone | enough).select("a", "team"), "near-asks")
    discard(rows)
    return found


def _compared(asks: DataFrame, groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Stored links of asking classes and members of the groups they open. The askers and the members of a group are cut into parts, and
    a task compares a part of either with the other inside: no row is made for a pair that doesn't link. In a group of one part a
    member that asks comes once."""
    asking = asks.select("team", F.col("a").alias("doc_id"), F.lit(True).alias("asks"))
    opened = small_side(stored(asks.select("team").distinct(), "near-opened"))
    members = groups.join(opened, "team", "left_semi").select("team", F.col("rep").alias("doc_id"), F.lit(False).alias("asks"))
    both = asking.unionByName(members).groupBy("team", "doc_id").agg(F.max("asks").alias("asks"), F.min("asks").alias("__only"))
    both = stored(both.select("team", "doc_id", "asks", (~F.col("__only")).alias("member")), "near-both")
    count = lambda c, each: F.greatest(F.ceil(F.count_if(c) / each), F.lit(1)).cast("int").alias(c)
    parts = both.groupBy("team").agg(count("asks", ASKING), count("member", ASKED)).filter("asks > 1 OR member > 1")
    parts = stored(parts.select("team", F.col("asks").alias("askers"), F.col("member").alias("members")), "near-parts")
    rows = small_side(stored(both.join(small_side(parts), "team", "left"), "near-cut")).join(texts, "doc_id")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda i, j, role: F.struct(i.alias("i"), j.alias("j"), F.lit(role).alias("role"))
    no = F.array().cast("array<struct<i:int,j:int,role:int>>")
    here = lambda role: F.array(cell(F.lit(0), F.lit(0), role))
    alone = F.when(F.col("asks") & F.col("member"), here(_BOTH)).when(F.col("asks"), here(_ASKS)).otherwise(here(_ASKED))
    spread = F.concat(
        F.when(F.col("asks"), F.transform(every("members"), lambda j: cell(own("askers"), j, _ASKS))).otherwise(no),
        F.when(F.col("member"), F.transform(every("askers"), lambda i: cell(i, own("members"), _ASKED))).otherwise(no),
    )
    rows = rows.select("team", "doc_id", "n_bytes", "packed", F.inline(F.when(F.col("askers").isNull(), alone).otherwise(spread)))

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, of = Block(), None
        for batch in batches:
            out = []
            for *key, role, doc, size, packed in zip(*[batch[c] for c in names], strict=True):
                if key != of:
                    out += block.among()
                    block, of = Block(), key
                found = shingles(_unpacked(size, packed))
                if role == _ASKED:
                    out += [(doc, other) for other in block.linked(found) if other != doc]
                else:
                    block.add(doc, found, role == _BOTH)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(block.among(), columns=["a", "b"], dtype="int64")

    keys = ["loose", "number", "i", "j"]
    names = [*keys, "role", "doc_id", "n_bytes", "packed"]
    rows = with_package(rows).select("team.*", *[c for c in names if c not in ("loose", "number")])
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "role")
    links = stored(rows.mapInPandas(lean(test), "a long, b long").distinct(), "near-links")
    discard(both, parts)
    return links


#: Roles of a row: a class that asks, one that asks and is asked, and one that is asked. Askers come first.
_BOTH, _ASKS, _ASKED = 0, 1, 2


class Block:
    """Sets that others are compared with, all at once."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.asked: list[tuple[int, np.ndarray]] = []
        self.sizes = None

    def add(self, i: int, s: np.ndarray, asked: bool = False) -> None:
        self.ids.append(i)
        self.sets.append(s)
        if asked:
            self.asked.append((i, s))

    def _close(self) -> None:
        self.sizes = np.asarray([len(x) for x in self.sets], np.int64)
        joined, owner = np.concatenate([*self.sets, np.empty(0, np.uint64)]), np.repeat(np.arange(len(self.sets)), self.sizes)
        order = np.argsort(joined, kind="stable")
        self.owner, self.sets = owner[order], []
        self.shingles, self.starts = np.unique(joined[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(joined))

    def linked(self, s: np.ndarray) -> list[int]:
        """Ids of the sets similar to s."""
        if self.sizes is None:
            self._close()
        fits = (100 * self.sizes >= PERCENT * len(s)) & (PERCENT * self.sizes <= 100 * len(s))
        if not fits.any() or not len(s):
            return []
        place = np.searchsorted(self.shingles, s)
        place = place[place < len(self.shingles)]
        place = place[self.shingles[place] == s[: len(place)]]
        lengths = self.ends[place] - self.starts[place]
        where = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(self.starts[place], lengths)
        both = np.bincount(self.owner[where], minlength=len(self.ids))
        return [self.ids[k] for k in np.flatnonzero((both > 0) & (100 * both >= PERCENT * (self.sizes + len(s) - both)))]

    def among(self) -> list[tuple[int, int]]:
        """Links of the sets that are asked as well."""
        return [(i, j) for i, s in self.asked for j in self.linked(s) if i != j]


def _labelled(rows: DataFrame, repeats: DataFrame, labels: DataFrame) -> DataFrame:
    rows = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("class_key")).alias("class_key"))
    # Labels of repeated classes first, so that copies of one text don't meet at one key of the labels.
    repeats = repeats.join(labels.withColumnsRenamed({"node": "rep"}), "rep", "left").select("class_key", F.coalesce("label", "rep").alias("shared"))
    found = rows.join(small_side(stored(repeats, "near-labels")), "class_key", "left").join(labels, F.col("doc_id") == F.col("node"), "left")
    return found.select("doc_id", "n_shingles", F.coalesce("shared", "label", "doc_id").alias("component_id"))
