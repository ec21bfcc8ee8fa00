"""The trie of conversation prefixes, from sorted conversations and their longest common prefixes (LCPs).

Conversations are sorted by their turns' digests, so that every node of the trie is an interval: the conversations that start with its
prefix. A block of neighbours gets the LCPs of adjacent rows and a sparse table of their range minima; each candidate prefix finds the
left and right end of its interval by its own binary search in the table, all candidates of a block at once and without a stack. What
a node sums up over its subtree follows from running sums over its interval:

    leaves   rows that share less with the next row than they are long
    saved    bytes of the turns up to each row's LCP with the row before it, less those above the node

Intervals that reach a block's first or last row are open. There are no more of them in a block than these two rows have prefixes; they
are merged by a digest of the prefix, and the LCP between two blocks is the depth of the deepest one that has rows in both.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import small_side, stored, with_package

#: Conversations c to c + FAMILY - 1 share the first turns of conversation c.
FAMILY = 5
HEAD_TURNS = 9
#: Turns in a block, about.
BLOCK_TURNS = 250_000
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_OPEN = "block long, node binary, parent binary, ends string, first boolean, last boolean, longer boolean, tail boolean, shared long, above long"
NAMES = [c.split()[0] for c in _NODE.split(", ")]


def _digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for (role, text)."""
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (array of digest and UTF-8 bytes of each text): the first h turns of the family's first conversation, h being the
    CRC-32 of the id's decimal digits modulo 9, then the conversation's own turns after its first h."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    turn = F.struct("turn", role.alias("role"), _digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", family.alias("family"), turn.alias("t")).repartition("family")
    own = rows.groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    own = own.select("family", "conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("own"))
    heads = own.filter("conv_id = family").select("family", F.slice("own", 1, HEAD_TURNS - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % HEAD_TURNS).cast("int")
    none = F.array().cast(own.schema["own"].dataType)
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), taken), F.slice("own", taken + 1, F.size("own")))
    return own.join(heads, "family", "left").select("conv_id", turns.alias("turns"))


def range_minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level j has the minima of 2**j values from each place on."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def range_minimum(table: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum from start to end, both included."""
    level = np.frexp((end - start + 1).astype(np.float64))[1] - 1
    out = np.empty(len(start), np.int64)
    for j in np.unique(level):
        at = level == j
        out[at] = np.minimum(table[j][start[at]], table[j][end[at] - (1 << int(j)) + 1])
    return out


def extents(table: list[np.ndarray], place: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of the interval around each place whose rows share ``depth`` turns; value i of the table's first level is the
    LCP of rows i - 1 and i. Two binary searches, each on its own, over ever smaller powers of two."""
    n, left, right = len(table[0]), place.copy(), place.copy()
    for j in range(len(table) - 1, -1, -1):
        step, minima = 1 << j, table[j]
        may = right + step < n
        may[may] = minima[right[may] + 1] >= depth[may]
        right[may] += step
        may = left - step >= 0
        may[may] = minima[left[may] - step + 1] >= depth[may]
        left[may] -= step
    return left, right


def adjacent_lcps(lengths: np.ndarray, offsets: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Common turns of each row with the row before it; -1 for the first."""
    common = np.minimum(lengths[1:], lengths[:-1])
    row = np.repeat(np.arange(1, len(lengths)), common)
    place = np.arange(len(row)) - np.repeat(np.cumsum(common) - common, common)
    differ = np.flatnonzero((digests[offsets[row] + place] != digests[offsets[row - 1] + place]).any(axis=1))
    out = np.concatenate([[-1], common]).astype(np.int64)
    rows, first = np.unique(row[differ], return_index=True)
    out[rows] = place[differ[first]]
    return out


def _path(digests: np.ndarray, start: int, length: int) -> list[bytes]:
    """Digest of every prefix of a row, the empty one first."""
    running, out = hashlib.blake2b(digest_size=16), []
    for k in range(length):
        out.append(running.digest())
        running.update(digests[start + k].tobytes())
    return [*out, running.digest()]


def block_nodes(block: int, ids: np.ndarray, lengths: np.ndarray, digests: np.ndarray, sizes: np.ndarray) -> dict:
    """The nodes of a block of sorted conversations, those that may go on in other blocks (node is set) as parts without what their
    first row shares with the block before and without the last row's leaf."""
    n, offsets = len(ids), np.cumsum(lengths) - lengths
    lcp = adjacent_lcps(lengths, offsets, digests)
    table, id_table = range_minima(lcp), range_minima(ids)
    bytes_to = np.concatenate([[0], np.cumsum(sizes)])
    prefix_bytes = lambda row, depth: bytes_to[offsets[row] + np.maximum(depth, 0)] - bytes_to[offsets[row]]

    new = lengths - lcp
    row = np.repeat(np.arange(n), new)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(new) - new, new) + np.repeat(lcp, new) + 1
    left, right = extents(table, row, depth)
    # The parent of a row's first new node starts at an earlier row.
    up_left, up_right = extents(table, row, np.maximum(depth - 1, 0))

    branch = np.flatnonzero((lengths > lcp) & (np.arange(n) > 0))
    branches = np.sort(lcp[branch] * n + branch)
    n_children = np.searchsorted(branches, depth * n + right, "right") - np.searchsorted(branches, depth * n + left, "right")
    n_children += (lengths[left] > depth) & (left > 0)
    leaves = np.concatenate([[0], np.cumsum(np.append(lcp[1:] < lengths[:-1], False))])
    kept = np.cumsum(np.where(np.arange(n) > 0, prefix_bytes(np.arange(n), lcp), 0))
    above = prefix_bytes(left, depth - 1)
    saved = kept[right] - kept[left] - (right - left) * above

    same = np.append(False, (lcp[1:] == lengths[1:]) & (lengths[1:] == lengths[:-1]))
    runs = np.flatnonzero(~same)
    run_end = np.repeat(np.append(runs[1:], n), np.diff(np.append(runs, n)))
    ended = lengths[left] == depth
    texts = [",".join(map(str, ids[a : run_end[a]].tolist())) if e else None for a, e in zip(left.tolist(), ended.tolist(), strict=True)]

    first, last = left == 0, right == n - 1
    is_open, up_first, up_open = first | last, up_left == 0, (up_left == 0) | (up_right == n - 1)
    paths = _path(digests, offsets[0], lengths[0]), _path(digests, offsets[-1], lengths[-1])
    named = lambda where, at_first, depths: [paths[0 if f else 1][d] if w else None for w, f, d in zip(where.tolist(), at_first.tolist(), depths.tolist(), strict=True)]
    root = depth == 0
    return {
        "conv_id": range_minimum(id_table, left, right),
        "depth": depth,
        "parent_conv_id": np.ma.array(range_minimum(id_table, up_left, up_right), mask=root | up_open),
        "n_convs": right - left + 1,
        "n_children": n_children,
        "n_leaves": leaves[right + 1] - leaves[left],
        "saved_tokens": saved,
        "ends_sha256": [None if o else _NO_ENDS if t is None else hashlib.sha256(t.encode()).hexdigest() for o, t in zip(is_open.tolist(), texts, strict=True)],
        "block": np.full(len(row), block),
        "node": named(is_open, first, depth),
        "parent": named(up_open & ~root, up_first, depth - 1),
        "ends": [t if o else None for o, t in zip(is_open.tolist(), texts, strict=True)],
        "first": first,
        "last": last,
        "longer": first & (lengths[0] > depth),
        "tail": last & (depth == lengths[-1]),
        "shared": np.where(first, prefix_bytes(0, np.minimum(depth, lengths[0])), 0),
        "above": above,
    }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, turns, number = [], 0, TaskContext.get().partitionId() << 24
    for batch in batches:
        held.append(batch)
        turns += len(batch.column("digests").flatten())
        if turns >= 2 * BLOCK_TURNS:
            yield from _block(number, held)
            held, turns, number = [], 0, number + 1
    if held:
        yield from _block(number, held)


def _block(number: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_batches(held).combine_chunks()
    if not whole.num_rows:
        return
    column = lambda c: whole.column(c).combine_chunks()
    lengths = column("digests").value_lengths().to_numpy().astype(np.int64)
    digests = np.frombuffer(b"".join(column("digests").flatten().to_pylist()), np.uint64).reshape(-1, 2)
    made = block_nodes(number, column("conv_id").to_numpy(), lengths, digests, column("sizes").flatten().to_numpy().astype(np.int64))
    names = [*NAMES, *[c.split()[0] for c in _OPEN.split(", ")]]
    types = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    kinds = [types[c.split()[1]] for c in f"{_NODE}, {_OPEN}".split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(made[c], t) for c, t in zip(names, kinds, strict=True)], names)


def _hashed_ends(chunks: DataFrame) -> DataFrame:
    """(node, ends_sha256): the hash of a node's ids over its blocks. The ids of one node are read one after another, a block's at a
    time, as the hash demands."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], ["node", "ends_sha256"])
        for batch in batches:
            for key, text in zip(batch.column("node").to_pylist(), batch.column("ends"), strict=True):
                if key != node:
                    if running:
                        yield row()
                    node, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(text.as_py().encode())
        if running:
            yield row()

    dealt = with_package(chunks).repartition("node").sortWithinPartitions("node", "block").select("node", "ends")
    return dealt.mapInArrow(step, "node binary, ends_sha256 string")


def _merged(parts: DataFrame) -> DataFrame:
    """Open nodes from their parts: the columns of a node, with the keys node and parent."""
    spans = parts.groupBy("node").agg(F.min("block").alias("from"), F.max("block").alias("to"))
    parts = stored(parts.join(spans, "node"), "trie-parts")
    goes_on = F.col("block") > F.col("from")
    borders = parts.filter(goes_on).groupBy("block").agg(F.max("depth").alias("lcp"), F.max_by("shared", "depth").alias("kept"))
    leaf = parts.filter("tail").select("block", (F.col("to") == F.col("block")).alias("leaf"))
    rows = parts.join(borders, "block", "left").join(leaf, "block")
    starts = F.col("longer") & (~goes_on | (F.col("lcp") == F.col("depth")))
    rows = rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.sum("n_convs").alias("n_convs"),
        F.sum(F.col("n_children") + starts.cast("long")).alias("n_children"),
        F.sum(F.col("n_leaves") + (F.col("last") & F.col("leaf")).cast("long")).alias("n_leaves"),
        F.sum(F.col("saved_tokens") + F.when(goes_on, F.col("kept") - F.col("above")).otherwise(0)).alias("saved_tokens"),
    )
    ends = _hashed_ends(parts.filter("ends IS NOT NULL").select("node", "block", "ends"))
    return rows.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of sequences (conv_id, turns: array of digest and size): conv_id (the smallest member), depth,
    parent_conv_id (the parent's smallest member; null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A sequence without turns is a member of the root alone; an empty table has no root. Other columns are left out. Sequences of any
    number and any number of equal ones are dealt over blocks; the turns of one sequence (24 bytes each) are in one.
    """
    rows = stored(sequences.select("conv_id", F.transform("turns", lambda t: t["digest"]).alias("digests"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "trie-rows")
    turns = rows.agg(F.sum(F.size("digests") + 1)).first()[0] or 0
    blocks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // BLOCK_TURNS))
    dealt = rows.repartitionByRange(blocks, "digests", "conv_id").sortWithinPartitions("digests", "conv_id")
    nodes = stored(with_package(dealt).mapInArrow(_blocks, f"{_NODE}, {_OPEN}"), "trie-nodes")
    merged = stored(_merged(nodes.filter("node IS NOT NULL").select(*[c for c in nodes.columns if c != "ends_sha256"])), "trie-merged")
    parents = small_side(merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("found")))
    found = F.coalesce("parent_conv_id", "found").alias("parent_conv_id")
    whole = nodes.filter("node IS NULL").select(*NAMES, "parent").unionByName(merged.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*NAMES, "parent"))
    return whole.join(parents, "parent", "left").select(*[found if c == "parent_conv_id" else c for c in NAMES])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text).

    Turns are ordered by turn, null first; equal turns by role, then by a digest of the text, repeated rows being turns of their own.
    Null roles and texts are empty; rows without conv_id take no part. A negative id's remainder has its sign. Other columns are left
    out.
    """
    return prefix_trie(rebuilt(conversations))
