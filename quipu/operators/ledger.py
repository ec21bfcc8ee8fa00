"""The consolidated ledger: one balance row per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.config import LedgerConfig
from quipu.functions.text import in_list, ledger_key
from quipu.operators.balances import HOT_KEY_STEPS, running_balance
from quipu.operators.rules import additive_kinds, postings
from quipu.schema import KEY, LEDGER, ORDER

_STEP = KEY + ORDER + ["bloque", "origen", "delta", "por_regla", "limitado"]


def stored_steps(ledger: DataFrame, like: DataFrame) -> DataFrame:
    """A stored ledger as the first step of each of its keys (null order columns sort first)."""
    types = dict(like.dtypes)
    order = [f"CAST(NULL AS {types[c]}) AS {c}" for c in ORDER]
    return ledger.selectExpr(*KEY, *order, "bloque", "origen", "valor AS delta", "false AS por_regla", "false AS limitado")


def additive_balances(steps: DataFrame) -> DataFrame:
    """Plain sums per key; partial sums before the shuffle keep hot keys harmless.

    For these types block and origin follow from the key, so grouping by them
    does not split a key and there is no last writer to look for.
    """
    return steps.groupBy(*KEY, "bloque", "origen").agg(F.sum("delta").alias("valor")).select(*LEDGER)


def ordered_balances(steps: DataFrame, hot_key_steps: int | None = HOT_KEY_STEPS) -> DataFrame:
    """Balances that depend on the replay order, with the block and origin of the last effective write."""
    effects = running_balance(steps, hot_key_steps)
    # A rule posting without effect writes nothing; a default posting always writes.
    writes = effects.filter(~F.col("por_regla") | (F.col("efectivo") != 0))
    # Grouping by the few (bloque, origen) pairs of a key first keeps the row-level aggregation on plain numbers.
    written = writes.groupBy(*KEY, "bloque", "origen").agg(F.sum("efectivo").alias("valor"), F.max("posicion").alias("_ultima"))
    return (
        written.groupBy(*KEY)
        .agg(F.sum("valor").alias("valor"), F.max_by(F.struct("bloque", "origen"), "_ultima").alias("_ultimo"))
        .select(*KEY, "_ultimo.bloque", "_ultimo.origen", "valor")
    )


def consolidate(
    movements: DataFrame,
    config: LedgerConfig,
    ledger: DataFrame | None = None,
    first_normal_rule_only: bool = False,
    hot_key_steps: int | None = HOT_KEY_STEPS,
) -> DataFrame:
    """Fold movements into a new or a stored ledger."""
    additive = additive_kinds(config)
    plain = postings(movements, config, only=additive, first_normal_rule_only=first_normal_rule_only)
    ordered = postings(movements, config, without=additive, first_normal_rule_only=first_normal_rule_only)
    plain, ordered = plain.select(*_STEP), ordered.select(*_STEP)
    if ledger is not None:
        is_additive = in_list(F.col("tipo"), additive)
        plain = plain.unionByName(stored_steps(ledger.filter(is_additive), plain))
        ordered = ordered.unionByName(stored_steps(ledger.filter(~is_additive), ordered))
    if hot_key_steps is not None and _few(movements, config, hot_key_steps):
        hot_key_steps = None
    return additive_balances(plain).unionByName(ordered_balances(ordered, hot_key_steps))


def _few(movements: DataFrame, config: LedgerConfig, steps: int) -> bool:
    """Whether all movements together cannot put that many steps on one key (a row count, no key is built)."""
    per_movement = 1 + sum(len(r["acciones"]) for r in config.rules)
    return movements.count() * per_movement < steps


def add_amounts(ledger: DataFrame, deltas: DataFrame) -> DataFrame:
    """Keyed additive upsert: sums onto existing balances, creates absent ones.

    ``deltas`` has the ledger's columns plus ``seq``, the write order; the last
    write sets block and origin.
    """
    stored = ledger.withColumn("seq", F.lit(None).cast(deltas.schema["seq"].dataType))
    return (
        stored.unionByName(deltas)
        .groupBy(*KEY)
        .agg(F.sum("valor").alias("valor"), F.max_by(F.struct("bloque", "origen"), F.struct("seq")).alias("_ultimo"))
        .select(*KEY, "_ultimo.bloque", "_ultimo.origen", "valor")
    )


def replace_rows(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Keyed replace: a new row takes the place of a stored one with the same key."""
    stored, new = ledger.withColumn("_nuevo", F.lit(0)), rows.withColumn("_nuevo", F.lit(1))
    return (
        stored.unionByName(new)
        .groupBy(*KEY)
        .agg(F.max_by(F.struct("bloque", "origen", "valor"), "_nuevo").alias("_fila"))
        .select(*KEY, "_fila.bloque", "_fila.origen", "_fila.valor")
    )


def key_scan(ledger: DataFrame, domain: str, corte: str, prefix: str = "") -> DataFrame:
    """Rows of one domain and month whose key text starts with a prefix."""
    rows = ledger.filter((F.col("dominio") == domain) & (F.col("corte") == corte))
    if prefix.endswith("#") and prefix.count("#") == 1:
        return rows.filter(F.col("tipo") == prefix[:-1])
    return rows.filter(ledger_key(F.col("tipo"), F.col("concepto"), F.col("origen_clave")).startswith(prefix))


def delete_months(ledger: DataFrame, months: DataFrame) -> DataFrame:
    """The ledger without the listed (dominio, corte) pairs."""
    return ledger.join(months, ["dominio", "corte"], "left_anti")


def with_key_text(ledger: DataFrame) -> DataFrame:
    """Adds the two key texts Dominio-Corte and Tipo-Concepto."""
    return ledger.withColumn("Dominio-Corte", F.concat_ws("#", "dominio", "corte")).withColumn(
        "Tipo-Concepto", ledger_key(F.col("tipo"), F.col("concepto"), F.col("origen_clave"))
    )
