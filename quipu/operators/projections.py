"""Recurring projections: the next months' budget rows, generated once per domain and month."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.config import BROADCAST_ROWS, LedgerConfig
from quipu.defaults import AUTOMATIC_PROJECTION, PROJECTION_TABLES
from quipu.functions.months import as_date, month_start, months_from

MONTHS_AHEAD = 3


def projection_months(base, n: int = MONTHS_AHEAD):
    """Array column of the n months after the base (a yyyy-MM column, or a date)."""
    first = F.add_months(F.trunc(base, "MM"), 1)
    return months_from(first, n)


def _base(corte: str | None, as_of):
    return month_start(F.lit(corte)) if corte else as_date(as_of)


def check_domains(config: LedgerConfig) -> None:
    unknown = [d for d in config.projections if d.strip().upper() not in config.catalogue]
    if unknown:
        raise ValueError(f"Dominio inválido: {', '.join(unknown)}")


def expand_over(bases: DataFrame, config: LedgerConfig) -> DataFrame:
    """(base, dominio, concepto, valor, corte) for every row of ``bases`` (a date column ``base``).

    Months and projections are literal lists, so rows are generated in place
    instead of being joined.
    """
    check_domains(config)
    kind = config.projection_type
    rows = [
        F.struct(F.lit(domain).alias("dominio"), F.lit(concept).alias("concepto"), F.lit(value).cast(kind).alias("valor"))
        for domain, concept, value in config.projection_rows()
        if config.has_block(domain, "PROYECCION")
    ]
    if not rows:
        return bases.select("base", F.lit("").alias("dominio"), F.lit("").alias("concepto"), F.lit(0).cast(kind).alias("valor"), F.lit("").alias("corte")).limit(0)
    months = bases.select("base", F.explode(projection_months(F.col("base"))).alias("corte"))
    return months.select("base", "corte", F.inline(F.array(*rows)))


def expand(spark, config: LedgerConfig, corte: str | None = None, as_of=None) -> DataFrame:
    """Every configured projection of a domain that has projections, for each month ahead of one base."""
    return expand_over(spark.range(1).select(_base(corte, as_of).alias("base")), config).drop("base")


def projected_months(existing: DataFrame) -> DataFrame:
    """(dominio, corte) pairs that already hold an automatic row."""
    return existing.filter(F.col("origen_registro") == AUTOMATIC_PROJECTION).select("dominio", "corte").distinct()


def pending(rows: DataFrame, existing: DataFrame, at_most: int | None = None) -> DataFrame:
    """Rows of the (dominio, corte) pairs not projected before.

    Only the asked-for months of the existing table matter. ``at_most`` is a
    proven bound on the number of rows; within the broadcast bound they filter
    (and prune) the existing table without shuffling it.
    """
    return rows.join(_done(rows, existing, at_most), ["dominio", "corte"], "left_anti")


def _done(rows: DataFrame, existing: DataFrame, at_most: int | None) -> DataFrame:
    wanted = rows.select("dominio", "corte").distinct()
    if at_most is not None and at_most <= BROADCAST_ROWS:
        months = {r["corte"] for r in wanted.select("corte").distinct().collect()}
        existing = existing.filter(F.col("corte").isin(list(months)))
        wanted = F.broadcast(wanted)
    return projected_months(existing.join(wanted, ["dominio", "corte"], "left_semi"))


def _run_size(config: LedgerConfig) -> int:
    return MONTHS_AHEAD * sum(len(concepts) for concepts in config.projections.values())


def known_concepts(rows: DataFrame, config: LedgerConfig) -> DataFrame:
    """Rows whose concept is listed among the domain's projections."""
    listed = config.names_dim(rows.sparkSession, ["PROYECCION"])
    return rows.join(listed.select("dominio", F.col("nombre").alias("concepto")), ["dominio", "concepto"], "left_semi")


def new_projections(existing: DataFrame, config: LedgerConfig, corte: str | None = None, as_of=None, stamp=None) -> DataFrame:
    """The projection rows a run inserts; a second run inserts nothing."""
    rows = expand(existing.sparkSession, config, corte, as_of)
    rows = known_concepts(pending(rows, existing, _run_size(config)), config)
    table = F.create_map(*[F.lit(x) for pair in PROJECTION_TABLES.items() for x in pair])
    return rows.select(
        F.sha2(F.concat_ws("|", F.lit(AUTOMATIC_PROJECTION), "dominio", "corte", "concepto"), 256).alias("trx_id"),
        "dominio",
        "concepto",
        "valor",
        "corte",
        (F.current_timestamp() if stamp is None else F.lit(stamp)).alias("created_at"),
        F.lit(AUTOMATIC_PROJECTION).alias("origen_registro"),
        F.try_element_at(table, F.col("dominio")).alias("tabla"),
    )


def run_summary(existing: DataFrame, config: LedgerConfig, corte: str | None = None, as_of=None) -> DataFrame:
    """Per month: the rows inserted and the domains skipped because they were projected before."""
    spark = existing.sparkSession
    rows = expand(spark, config, corte, as_of)
    done = _done(rows, existing, _run_size(config)).withColumn("_hecho", F.lit(True))
    valid = config.names_dim(spark, ["PROYECCION"]).select(
        "dominio", F.col("nombre").alias("concepto"), F.lit(True).alias("_valido")
    )
    marked = rows.join(done, ["dominio", "corte"], "left").join(valid, ["dominio", "concepto"], "left")
    inserted = F.when(F.col("_hecho").isNull() & F.col("_valido"), F.struct("dominio", "concepto", "valor"))
    summary = marked.groupBy("corte").agg(
        F.sort_array(F.collect_list(inserted)).alias("insertados"),
        F.sort_array(F.collect_set(F.when(F.col("_hecho"), F.col("dominio")))).alias("omitidos_por_duplicado"),
    )
    # Every month of the run is listed, also one without any row.
    months = spark.range(1).select(F.explode(projection_months(_base(corte, as_of))).alias("corte"))
    return months.join(summary, "corte", "left").select(
        "corte",
        *[F.coalesce(c, F.array().cast(summary.schema[c].dataType)).alias(c) for c in ("insertados", "omitidos_por_duplicado")],
    )
