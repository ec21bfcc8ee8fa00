"""The month's and the day's jobs as one run in their order, which goes on where it was stopped.

A step leaves a marker when it is done; a run skips steps that have one. A step that was stopped before its marker is run again, and
each of them then leaves what one run would have left: the close finds its month closed, projections are appended under the run's name,
the ledger knows the events, files are replaced, and the index finds nothing changed.
"""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.config import LedgerConfig
from quipu.functions.text import AMOUNT
from quipu.operators import index_store
from quipu.operators.documents import documents
from quipu.operators.ingest import PROJECTION, append_once, read_appended
from quipu.operators.inserts import as_movements
from quipu.operators.projections import new_projections
from quipu.operators.report import report
from quipu.operators.search import embed_by_hashing
from quipu.plans.jobs import monthly_close
from quipu.sources.files import read_documents, write_documents, write_report_csv
from quipu.sources.folders import exists, mark_once
from quipu.sources.snapshots import last_batch, read_ledger
from quipu.streaming.jobs import apply_batch

_PROJECTED = "trx_id string, concepto string, valor decimal(30,6), created_at timestamp, origen_registro string, tabla string, dominio string, corte string"


@dataclass(frozen=True)
class Run:
    """One run: where everything is kept (root), the run date, and the ledger's units in a currency unit."""

    spark: SparkSession
    config: LedgerConfig
    root: str
    as_of: dt.date
    scale: int = 1
    embed: Callable[[DataFrame], DataFrame] = embed_by_hashing

    @property
    def month(self) -> str:
        return f"{self.as_of:%Y-%m}"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    def projected(self) -> DataFrame:
        return read_appended(self.spark, f"{self.root}/proyecciones", _PROJECTED)


def close(run: Run) -> None:
    monthly_close(run.spark, run.config, run.ledger, run.as_of)


def project(run: Run) -> None:
    """The months ahead, appended under the month's name; a repeated append changes nothing."""
    stamp = dt.datetime.combine(run.as_of.replace(day=1), dt.time())
    rows = new_projections(run.projected(), run.config, as_of=run.as_of, stamp=stamp)
    rows = rows.withColumn("valor", F.col("valor").cast(AMOUNT))
    append_once(rows.select(*[c.split()[0] for c in _PROJECTED.split(", ")]), f"{run.root}/proyecciones", f"mes-{run.month}")


def post(run: Run) -> None:
    """Projected rows into the ledger: events it has seen don't count again."""
    rows = as_movements(run.projected(), PROJECTION, run.scale)
    apply_batch(rows, last_batch(run.spark, run.ledger) + 1, run.config, run.root)


def _report(run: Run) -> DataFrame:
    return report(read_ledger(run.spark, run.ledger), run.as_of)


def write_report(run: Run) -> None:
    write_report_csv(_report(run), f"{run.root}/reports")


def write_texts(run: Run) -> None:
    write_documents(documents(_report(run), run.as_of, run.scale), f"{run.root}/rag")


def index(run: Run) -> None:
    index_store.refresh(read_documents(run.spark, f"{run.root}/rag"), f"{run.root}/index", run.embed)


#: In their order, with the part of the calendar that they belong to.
STEPS: list[tuple[str, str, Callable[[Run], None]]] = [
    ("cierre", "mes", close),
    ("proyecciones", "mes", project),
    ("asientos", "mes", post),
    ("reporte", "dia", write_report),
    ("documentos", "dia", write_texts),
    ("indice", "dia", index),
]


def run_calendar(run: Run, steps: list[tuple[str, str, Callable[[Run], None]]] | None = None) -> list[str]:
    """Runs what is left of the run date's steps, in order, and returns their names. A ledger must exist."""
    if read_ledger(run.spark, run.ledger) is None:
        raise ValueError(f"no ledger in {run.ledger}")
    done = []
    for name, part, step in steps or STEPS:
        marker = f"{run.root}/corridas/{run.month if part == 'mes' else run.as_of.isoformat()}/{name}.hecho"
        if not exists(run.spark, marker):
            step(run)
            mark_once(run.spark, marker)
            done.append(name)
    return done
