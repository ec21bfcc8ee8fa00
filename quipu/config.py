"""The four configuration documents and their relational form.

The documents are a few kilobytes each and are read once per run, so they are
held as plain Python values; operators either turn them into column
expressions or into small dimension tables.
"""

import json
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu import defaults

# A dimension is broadcast only while it has at most this many rows.
BROADCAST_ROWS = 100_000

_CATALOGUE_SCHEMA = pa.schema(
    [("dominio", pa.string()), ("bloque", pa.string()), ("tipo", pa.string()), ("nombre", pa.string()), ("pos", pa.int32())]
)


def small_table(spark: SparkSession, rows: list, schema: pa.Schema) -> DataFrame:
    """A driver-built dimension, hinted for broadcast only within the size bound."""
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    table = spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema))
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


@dataclass(frozen=True)
class LedgerConfig:
    catalogue: dict = field(default_factory=lambda: defaults.CATALOGUE)
    rules: list = field(default_factory=lambda: defaults.RULES)
    projections: dict = field(default_factory=lambda: defaults.FIXED_PROJECTIONS)
    persistent: dict = field(default_factory=lambda: defaults.PERSISTENT_CONCEPTS)

    @property
    def domains(self) -> list:
        return list(self.catalogue)

    def has_block(self, domain: str, block: str) -> bool:
        return block in self.catalogue.get(domain, {})

    def domains_with(self, block: str, kind: str | None = None) -> list:
        return [d for d, blocks in self.catalogue.items() if block in blocks and (kind is None or kind in blocks[block])]

    def catalogue_rows(self) -> list:
        """(dominio, bloque, tipo, nombre, pos); pos counts through the block in listed order."""
        rows = []
        for domain, blocks in self.catalogue.items():
            for block, kinds in blocks.items():
                names = [(kind, name) for kind, listed in kinds.items() if isinstance(listed, list) for name in listed]
                rows += [(domain, block, kind, name, i + 1) for i, (kind, name) in enumerate(names)]
        return rows

    def catalogue_dim(self, spark: SparkSession) -> DataFrame:
        return small_table(spark, self.catalogue_rows(), _CATALOGUE_SCHEMA)

    def listed_names(self, blocks: list, kind: str | None = None) -> list:
        """Distinct (dominio, nombre) listed in the first of ``blocks`` that each domain has, optionally of one type."""
        first = {d: next((b for b in blocks if self.has_block(d, b)), None) for d in self.domains}
        names = {
            (domain, name): None
            for domain, block, type_, name, _ in self.catalogue_rows()
            if block == first[domain] and (kind is None or type_ == kind)
        }
        return list(names)

    def names_dim(self, spark: SparkSession, blocks: list, kind: str | None = None) -> DataFrame:
        return small_table(spark, self.listed_names(blocks, kind), pa.schema([("dominio", pa.string()), ("nombre", pa.string())]))

    def accounts_dim(self, spark: SparkSession, kinds: list | None = None) -> DataFrame:
        """Distinct (dominio, nombre, tipo) of the cash block, optionally of some types."""
        rows = {
            (domain, name, type_): None
            for domain, block, type_, name, _ in self.catalogue_rows()
            if block == "CAJA_ACTUAL" and (kinds is None or type_ in kinds)
        }
        schema = pa.schema([("dominio", pa.string()), ("nombre", pa.string()), ("tipo", pa.string())])
        return small_table(spark, list(rows), schema)

    def account_type_dim(self, spark: SparkSession, block: str = "CAJA_ACTUAL") -> DataFrame:
        """(dominio, nombre, tipo_nombre) with the first listed type of every name in a block."""
        first = {}
        for domain, blk, kind, name, _ in self.catalogue_rows():
            if blk == block:
                first.setdefault((domain, name), kind)
        schema = pa.schema([("dominio", pa.string()), ("nombre", pa.string()), ("tipo_nombre", pa.string())])
        return small_table(spark, [(d, n, k) for (d, n), k in first.items()], schema)

    def projection_rows(self) -> list:
        """(dominio, concepto, valor) with the amounts as they are written; whole ones are integers."""
        return [
            (domain.strip().upper(), concept.strip().upper(), _exact(value))
            for domain, concepts in self.projections.items()
            for concept, value in concepts.items()
        ]

    @property
    def projection_type(self) -> str:
        """Type of projected amounts: whole units, or exact fractions where one is configured."""
        return "bigint" if all(isinstance(v, int) for *_, v in self.projection_rows()) else "decimal(30,6)"

    def projection_dim(self, spark: SparkSession) -> DataFrame:
        kind = pa.int64() if self.projection_type == "bigint" else pa.decimal128(30, 6)
        return small_table(spark, self.projection_rows(), pa.schema([("dominio", pa.string()), ("concepto", pa.string()), ("valor", kind)]))

    def persistent_dim(self, spark: SparkSession) -> DataFrame:
        rows = [(domain, concept) for domain, concepts in self.persistent.items() for concept in dict.fromkeys(concepts)]
        return small_table(spark, rows, pa.schema([("dominio", pa.string()), ("concepto", pa.string())]))


def _exact(value) -> int | Decimal:
    number = Decimal(str(value))
    if number != round(number, 6):
        raise ValueError(f"configured amount {value} has more than 6 digits after the point")
    return int(number) if number == int(number) else number


def default_config() -> LedgerConfig:
    return LedgerConfig()


def _document(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def load_config(
    spark: SparkSession,
    catalogue: str,
    rules: str,
    projections: str | None = None,
    persistent: str | None = None,
) -> LedgerConfig:
    """Read the JSON documents from any path Spark can read.

    A missing list of persistent concepts means that nothing is carried over.
    """
    return LedgerConfig(
        catalogue=_document(spark, catalogue),
        rules=_document(spark, rules).get("reglas", []),
        projections=_document(spark, projections) if projections else {},
        persistent=_document(spark, persistent) if persistent else {},
    )
