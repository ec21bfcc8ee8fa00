"""Balances kept in the state store: a micro-batch costs what it brings, not what the ledger holds.

Change records are decoded, deduplicated by event id, turned into postings and folded per key by a stateful operator. A key's state is its
balance and last writer (``order="arrival"``: batches apply in arrival order), or its steps in chunks with one pair of numbers each
(``order="replay"``: the result is that of a full replay in order, whenever a record arrives). Changed balances are logged per batch.
"""

import pickle
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from quipu.config import LedgerConfig
from quipu.operators import chunks
from quipu.operators.rules import additive_kinds, postings, unsupported_movements
from quipu.schema import KEY, LEDGER, MOVEMENT, ORDER, TOO_OLD, UNSUPPORTED
from quipu.sources.changes import decode_all
from quipu.workers import with_package

#: Steps in a chunk, at most; a fuller one is halved.
CHUNK_STEPS = 4096
#: Steps of a task that are packed by key together, and steps in one packed row, at most.
PACK_ROWS, PACK_STEPS = 100_000, 16_384
#: The state store that stateful processors need.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Counting a store's rows would look up every id before it is put.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
#: Stores that end with their task. Without it those of a stream that has stopped keep their memory and files until a cleaning by the minute.
_UNLOAD = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}
_STEP = [*KEY, *ORDER, "bloque", "origen", "delta", "por_regla", "limitado"]
_EFFECT = ["delta", "limitado", "por_regla", "bloque", "origen"]
_CENTS, _EXACT = "long", "decimal(38,6)"


def admitted(changes: DataFrame, modify: str = "readd", cents: bool = False, horizon: str | None = None, arrived: Column | None = None) -> DataFrame:
    """Decoded records with their arrival, llegada (now, by default). With a horizon, an interval like '90 days', a record whose
    created_at is further behind its arrival is refused: its id may have been forgotten, so it can't be told from a repeat. A record's
    first arrival follows its creation, so every repeat inside the horizon still finds the id."""
    marked = changes.withColumn("_llegada", F.current_timestamp() if arrived is None else arrived.cast("timestamp"))
    rows = decode_all(marked, modify, cents, kept=["_llegada"]).withColumnRenamed("_llegada", "llegada")
    if horizon is None:
        return rows
    late = F.col("created_at") < F.col("llegada") - F.expr(f"INTERVAL {horizon}")
    why = F.when(F.col("motivo").isNull() & late, TOO_OLD).otherwise(F.col("motivo"))
    return rows.withColumn("motivo", why)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def partial_sums(steps: DataFrame, kinds: list) -> DataFrame:
    """The same steps with those of additive key types summed per key in every batch of a task, so that a hot key is a few rows."""
    nullable = _nullable(steps.schema)
    schema = to_arrow_schema(nullable)
    return with_package(steps).mapInArrow(lambda batches: _summed(batches, kinds, schema), nullable)


def _summed(batches: Iterator[pa.RecordBatch], kinds: list, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        plain = pc.is_in(rows["tipo"], pa.array(kinds, pa.string()))
        yield from rows.filter(pc.invert(plain)).cast(schema).to_batches()
        mine = rows.filter(plain)
        if not mine.num_rows:
            continue
        size = pc.sum(pc.abs(pc.cast(mine["delta"], pa.float64(), safe=False))).as_py()
        if pa.types.is_integer(mine["delta"].type) and size > 9e18:
            raise OverflowError("sums of cents exceed 64 bits")
        by = [*KEY, "bloque", "origen"]
        summed = mine.group_by(by, use_threads=False).aggregate([("delta", "sum")]).rename_columns({"delta_sum": "delta"})
        n = summed.num_rows
        none = {c: pa.nulls(n, schema.field(c).type) for c in ORDER}
        no = pa.array(np.zeros(n, bool))
        full = {**{c: summed[c] for c in [*by, "delta"]}, **none, "por_regla": no, "limitado": no}
        yield from pa.table({c: full[c] for c in schema.names}).cast(schema).to_batches()


def packed_steps(steps: DataFrame, kinds: list) -> DataFrame:
    """(key, pasos): the steps of ``partial_sums``, those of one key in a stretch of a task as one row, so that what meets the state is
    rows of many steps."""
    schema = to_arrow_schema(_nullable(steps.schema))
    packed = T.StructType([*[T.StructField(c, steps.schema[c].dataType) for c in KEY], T.StructField("pasos", T.BinaryType())])
    out = to_arrow_schema(packed)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in _summed(batches, kinds, schema):
            held.append(batch)
            n += batch.num_rows
            if n >= PACK_ROWS:
                yield _packed(pa.Table.from_batches(held, schema), out)
                held, n = [], 0
        if n:
            yield _packed(pa.Table.from_batches(held, schema), out)

    return with_package(steps).mapInArrow(step, packed)


def _packed(steps: pa.Table, schema: pa.Schema) -> pa.RecordBatch:
    places = steps.select(KEY).append_column("_n", pa.array(np.arange(steps.num_rows)))
    found = places.group_by(KEY, use_threads=False).aggregate([("_n", "list")]).combine_chunks()
    lists = found["_n_list"].combine_chunks()
    rows = steps.take(lists.flatten())
    columns = [_sorting(rows), *[_shared(rows[c].to_pylist()) for c in _EFFECT]]
    ends = np.cumsum(lists.value_lengths().to_numpy())
    keys, packs = [], []
    for k, (start, end) in enumerate(zip([0, *ends], ends)):  # noqa: B905
        for at in range(start, end, PACK_STEPS):
            keys.append(k)
            packs.append(_dumped(Steps(*[c[at : min(at + PACK_STEPS, end)] for c in columns]).sorted().columns))
    made = found.select(KEY).take(pa.array(keys, pa.int64())).append_column("pasos", pa.array(packs, pa.binary()))
    return made.cast(schema).combine_chunks().to_batches()[0]


def _shared(values: list) -> list:
    """The same values, equal ones as one object, which pickles once."""
    one: dict = {}
    return [one.setdefault(v, v) for v in values]


def _dumped(columns: tuple) -> bytes:
    """Columns of steps as bytes: compressed here, since orders are long texts alike that the store's native memory would hold whole."""
    return zlib.compress(pickle.dumps(columns), 1)


def _loaded(data: bytes) -> tuple:
    # A checkpoint of before has plain pickles, which begin with the byte 0x80.
    return pickle.loads(data if data[:1] == b"\x80" else zlib.decompress(data))


def _sorting(steps: pa.Table) -> list:
    """Texts that sort like the replay order, nulls first."""

    def text(values: pa.ChunkedArray) -> pa.ChunkedArray:
        if pa.types.is_timestamp(values.type):
            values = pc.strftime(values.cast(pa.timestamp("us", "UTC")), "%Y-%m-%d %H:%M:%S")
        elif pa.types.is_integer(values.type):
            values = pc.utf8_lpad(pc.cast(pc.add(pc.cast(values, pa.int64()), 1 << 62), pa.string()), 20, "0")
        shown = pc.binary_join_element_wise("\x02", pc.cast(values, pa.string()), "")
        return pc.fill_null(shown, "")

    return pc.binary_join_element_wise(*[text(steps[c]) for c in ORDER], "\x01").to_pylist()


class Steps:
    """Steps of one key in replay order: columns as lists."""

    def __init__(self, order: list, deltas: list, limited: list, by_rule: list, blocks: list, origins: list):
        self.columns = order, deltas, limited, by_rule, blocks, origins

    @classmethod
    def of(cls, rows: Iterator[Row]) -> "Steps":
        packs = [_loaded(bytes(r["pasos"])) for r in rows]
        return cls(*[list(chain.from_iterable(parts)) for parts in zip(*packs, strict=True)]).sorted()

    def sorted(self) -> "Steps":
        order = self.columns[0]
        if all(a <= b for a, b in pairwise(order)):
            return self
        return self.take(sorted(range(len(order)), key=order.__getitem__))

    def take(self, places) -> "Steps":
        if isinstance(places, range):
            return Steps(*[column[places.start : places.stop] for column in self.columns])
        return Steps(*[[column[k] for k in places] for column in self.columns])

    def plus(self, other: "Steps") -> "Steps":
        return Steps(*[a + b for a, b in zip(self.columns, other.columns, strict=True)]).sorted()

    def __len__(self) -> int:
        return len(self.columns[0])

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        return chunks.as_array(self.columns[1]), np.asarray(self.columns[2], bool)


class KeyBalance(StatefulProcessor):
    """The balance of one key (dominio, corte, tipo, concepto, origen_clave) from its steps."""

    def __init__(self, number: str, replay: bool, chunk_steps: int):
        self.number, self.replay, self.chunk_steps = number, replay, chunk_steps

    def init(self, handle) -> None:
        self.now = handle.getValueState("saldo", f"valor {self.number}, bloque string, origen string")
        if self.replay:
            pair = f"sumas array<{self.number}>, minimos array<{self.number}>"
            self.index = handle.getValueState("indice", f"desde array<string>, trozos array<long>, limitados array<boolean>, {pair}")
            self.steps = handle.getMapState("trozos", "trozo long", "pasos binary")
            self.base = handle.getValueState("base", f"valor {self.number}, bloque string, origen string")

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initial: Row, timer_values) -> None:
        state = (self._number(initial["valor"]), initial["bloque"], initial["origen"])
        self.now.update(state)
        if self.replay:
            self.base.update(state)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        state = (self._replayed if self.replay else self._arrived)(Steps.of(rows))
        if state is not None:
            self.now.update(state)
            yield Row(**dict(zip(LEDGER, (*key, state[1], state[2], state[0]), strict=True)))

    def _number(self, value):
        return int(value) if self.number == _CENTS else value

    def _written(self, steps: Steps, start, before: tuple | None) -> tuple | None:
        """(balance, bloque, origen) after steps; ``before`` where none of them writes."""
        deltas, limited = steps.numbers()
        place = chunks.last_write(deltas, limited, np.asarray(steps.columns[3], bool), start)
        if place is None:
            return before
        total, lowest = chunks.summary(deltas, limited)
        return self._number(chunks.after(start, total, lowest)), steps.columns[4][place], steps.columns[5][place]

    def _arrived(self, steps: Steps) -> tuple | None:
        before = self.now.get()
        return self._written(steps, before[0] if before else self._number(0), before)

    def _load(self, number: int) -> Steps:
        return Steps(*_loaded(bytes(self.steps.getValue((number,))[0])))

    def _replayed(self, steps: Steps) -> tuple | None:
        index = [list(x) for x in self.index.get() or ([], [], [], [], [])]
        starts, numbers = index[0], index[1]
        # Steps and chunks are both in order, so a chunk takes a stretch of the steps.
        cuts = [0, *[bisect_left(steps.columns[0], start) for start in starts[1:]], len(steps)]
        place = {at: range(a, b) for at, (a, b) in enumerate(pairwise(cuts)) if a < b}
        # From the last chunk on, so that halving one leaves the places of those before it.
        for at in sorted(place, reverse=True):
            mine = steps.take(place[at])
            if numbers:
                mine = self._load(numbers[at]).plus(mine)
            pieces = -(-len(mine) // self.chunk_steps)
            pieces = pieces if pieces == 1 else 2 * pieces
            parts = [mine.take(range(len(mine) * k // pieces, len(mine) * (k + 1) // pieces)) for k in range(pieces)]
            names = [numbers[at] if k == 0 and numbers else max(numbers, default=-1) + 1 + k for k in range(pieces)]
            found = []
            for name, part in zip(names, parts, strict=True):
                self.steps.updateValue((name,), (_dumped(part.columns),))
                pair = chunks.summary(*part.numbers())
                found.append((part.columns[0][0], name, all(part.columns[2]), *map(self._stored, pair)))
            for column, values in zip(index, zip(*found, strict=True), strict=True):
                column[at : at + 1] = values
        self.index.update(tuple(index))
        return self._composed(index)

    def _stored(self, value):
        return None if value is None else self._number(value)

    def _composed(self, index: list) -> tuple | None:
        """The balance by the chunks' pairs, and the last writer, from the last chunk that may have written."""
        before = self.base.get()
        balance = [before[0] if before else self._number(0)]
        for total, lowest in zip(index[3], index[4], strict=True):
            balance.append(chunks.after(balance[-1], total, lowest))
        for at in range(len(index[1]) - 1, -1, -1):
            if index[2][at] and balance[at] == 0:
                continue  # limited steps from zero change nothing
            written = self._written(self._load(index[1][at]), balance[at], None)
            if written is not None:
                return self._number(balance[-1]), written[1], written[2]
        return before


def balance_changes(
    changes: DataFrame, config: LedgerConfig, modify: str = "readd", cents: bool = False, order: str = "arrival", horizon: str | None = None,
    arrived: Column | None = None, initial: DataFrame | None = None, first_normal_rule_only: bool = False, chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """A stream of changed balances from a stream of change records: each batch has the touched keys' new rows.

    Event ids count once; they are kept for the horizon after their arrival, without one for ever. ``initial`` (a ledger) is where the
    balances of a new stream start.
    """
    if order not in ("arrival", "replay"):
        raise ValueError("order is 'arrival' or 'replay'")
    rows = admitted(changes, modify, cents, horizon, arrived).filter("motivo IS NULL")
    if horizon is None:
        rows = rows.dropDuplicates(["event_id"])
    else:
        rows = rows.withWatermark("llegada", horizon).dropDuplicatesWithinWatermark(["event_id"])
    steps = postings(rows.select(*MOVEMENT, "seq"), config, first_normal_rule_only=first_normal_rule_only).select(*_STEP)
    number = _CENTS if cents else _EXACT
    fields = [f if f.name in KEY else T.StructField(f.name, T.StringType()) for f in steps.schema.fields if f.name in LEDGER]
    schema = T.StructType([*sorted(fields, key=lambda f: LEDGER.index(f.name)), *T.StructType.fromDDL(f"valor {number}").fields])
    start = None if initial is None else initial.select(*LEDGER[:-1], F.col("valor").cast(number).alias("valor")).groupBy(*KEY)
    packs = packed_steps(steps, additive_kinds(config))
    return packs.groupBy(*KEY).transformWithState(KeyBalance(number, order == "replay", chunk_steps), schema, "Append", "none", start)


def balance_stream(
    changes: DataFrame, config: LedgerConfig, path: str, checkpoint: str, trigger: dict | None = None, unload: bool = False, **options
) -> StreamingQuery:
    """Change records -> path/lote=N, the balances that batch N changed. A repeated batch overwrites its own folder.

    The number of state partitions is the session's spark.sql.shuffle.partitions at the first start. With ``unload`` a partition's store is
    closed as its task ends, so that an executor holds the stores of its running tasks alone: for a stream that ends after a batch,
    since a next batch would fetch them again.
    """
    spark = changes.sparkSession

    def log(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/lote={batch}")

    writer = balance_changes(changes, config, **options).writeStream.outputMode("append").foreachBatch(log)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    settings = _STORE | (_UNLOAD if unload else {})
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)  # the stream takes the session's settings as it starts
    try:
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_balances(spark: SparkSession, path: str) -> DataFrame:
    """The ledger as of the last batch: every key's newest row."""
    newest = F.max_by(F.struct("bloque", "origen", "valor"), "lote").alias("_fila")
    return spark.read.parquet(path).groupBy(*KEY).agg(newest).select(*KEY, "_fila.bloque", "_fila.origen", "_fila.valor")


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The ledger out of the state store itself, for checks and for moving to a new stream."""
    operator = _balance_operator(spark, checkpoint)
    rows = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", "saldo").load(checkpoint)
    return rows.select(*[F.col(f"key.{c}") for c in KEY], "value.bloque", "value.origen", "value.valor")


def _balance_operator(spark: SparkSession, checkpoint: str) -> int:
    found = spark.read.format("state-metadata").load(checkpoint).filter("operatorName LIKE 'transformWithState%'")
    return found.select("operatorId").first()[0]


def refused_stream(
    changes: DataFrame, config: LedgerConfig, path: str, checkpoint: str, modify: str = "readd", cents: bool = False, horizon: str | None = None,
    arrived: Column | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """What balance_stream leaves out: event_id, motivo and the record of everything that can't be posted or came too late. The file
    sink keeps every record once."""
    rows = admitted(changes, modify, cents, horizon, arrived)
    entry = F.coalesce("registro", F.to_json(F.struct(*MOVEMENT)))
    refused = rows.filter("motivo IS NOT NULL").select("event_id", "motivo", entry.alias("registro"))
    odd = unsupported_movements(rows.filter("motivo IS NULL"), config)
    refused = refused.unionByName(odd.select("event_id", F.lit(UNSUPPORTED).alias("motivo"), entry.alias("registro")))
    writer = refused.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
