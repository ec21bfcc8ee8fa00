"""Scheduled batch jobs over stored ledgers."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quipu.config import LedgerConfig
from quipu.functions.months import close_months
from quipu.operators import index_store
from quipu.operators.close import close_month
from quipu.operators.documents import documents
from quipu.operators.envelope import file_location
from quipu.operators.ledger import consolidate, delete_months
from quipu.operators.projections import new_projections
from quipu.operators.report import report
from quipu.operators.search import embed_by_hashing
from quipu.schema import DOCUMENT
from quipu.sources.files import write_documents, write_report_csv
from quipu.sources.snapshots import VersionConflict, latest, read_ledger, write_ledger
from quipu.streaming.jobs import COMMIT_ATTEMPTS, PRUNED_MONTHS

#: Files that one run loads into the index.
FILES_A_RUN = 10_000


def rebuild_ledger(movements: DataFrame, config: LedgerConfig, path: str) -> int:
    """Replay all movements into a new ledger version."""
    return write_ledger(consolidate(movements, config), path)


def monthly_close(spark: SparkSession, config: LedgerConfig, path: str, as_of=None, **options) -> int | None:
    """Close the month before the run date as one atomic new version. Only that month and the one it opens are read and written."""
    months = list(spark.range(1).select(*[c.alias(n) for c, n in zip(close_months(as_of), "ab", strict=True)]).first())
    return _rewritten(spark, path, lambda: months, lambda rows: close_month(rows, config, as_of, **options))


def drop_months(spark: SparkSession, path: str, gone: DataFrame) -> int | None:
    """Delete the listed (dominio, corte) pairs as one atomic new version. Only their months are read and written."""
    months = lambda: [r["corte"] for r in gone.select("corte").distinct().limit(PRUNED_MONTHS + 1).collect() if r["corte"] is not None]
    return _rewritten(spark, path, months, lambda rows: delete_months(rows, gone))


def _rewritten(spark: SparkSession, path: str, months: Callable[[], list[str]], change: Callable[[DataFrame], DataFrame]) -> int | None:
    """New content for some months of the newest ledger; again from the start if another writer commits meanwhile."""
    touched = months()
    touched = touched if len(touched) <= PRUNED_MONTHS else None
    for attempt in range(COMMIT_ATTEMPTS):
        base = latest(spark, path)
        if not base:
            return None
        try:
            return write_ledger(change(read_ledger(spark, path, base, touched)), path, parent=base, months=touched)
        except VersionConflict:
            if attempt + 1 == COMMIT_ATTEMPTS:
                raise


def monthly_projections(existing: DataFrame, config: LedgerConfig, path: str, corte: str | None = None, as_of=None) -> None:
    """Append the projections that are not there yet. Run after the close."""
    rows = new_projections(existing, config, corte, as_of)
    rows.write.mode("append").partitionBy("tabla", "corte").parquet(path)


def daily_report(spark: SparkSession, path: str, output: str, as_of=None, scale: int = 1) -> None:
    """CSV and document files from the newest ledger.

    The report is persisted because both files read it; it has one row per
    balance at most.
    """
    ledger = read_ledger(spark, path)
    if ledger is None:
        return
    rows = report(ledger, as_of).persist()
    try:
        write_report_csv(rows, f"{output}/reports")
        write_documents(documents(rows, as_of, scale), f"{output}/rag")
    finally:
        rows.unpersist()


def refresh_index(documents_rows: DataFrame, path: str, embed=embed_by_hashing) -> bool:
    """The stored index as of all documents: only what changed is embedded and written."""
    return index_store.refresh(documents_rows, path, embed)


def index_new_files(notifications: DataFrame, base: str, path: str, embed=embed_by_hashing) -> list[str]:
    """Documents of the files that notifications (raw) tell of, below base/bucket, into the stored index. Returns the files' keys;
    notifications without a file are left out. At most FILES_A_RUN files at a time, more are an error."""
    found = file_location(notifications).filter("location_error IS NULL").select("bucket", "file_key").distinct()
    files = sorted(f"{r['bucket']}/{r['file_key']}" for r in found.limit(FILES_A_RUN + 1).collect())
    if len(files) > FILES_A_RUN:
        raise ValueError(f"more than {FILES_A_RUN} files in one run")
    if files:
        rows = notifications.sparkSession.read.schema(DOCUMENT).json([f"{base}/{f}" for f in files])
        index_store.refresh(rows.dropDuplicates(["id"]), path, embed, whole=False)
    return files
