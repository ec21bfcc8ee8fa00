"""Compensation rules: movement -> signed postings on balance keys.

A rule set is configuration of bounded size. Every rule condition becomes one
boolean SQL expression, so a movement yields the positions of the rules it
matches (or of the default entry when no normal rule matches) in one
projection. Those positions are exploded and joined with a broadcast table of
actions that says how each one posts. All of it is narrow: movements are read
once and never shuffled to find their postings, and the generated code stays
small however many actions there are.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.config import LedgerConfig, small_table
from quipu.functions.text import sql_list, sql_text
from quipu.schema import KEYED_BY_ORIGIN

SUPPORTED_OPERATIONS = ("DECREMENTAR", "INCREMENTAR", "ADD", "REPLICAR")
COMPLEMENTARY = "COMPLEMENTARIA"


def _listed(column: str, names) -> str:
    """Membership that is false for a null value and for an empty list."""
    return f"coalesce({column} IN {sql_list(names)}, false)" if names else "false"


def rule_condition(rule: dict) -> str:
    """SQL condition under which a rule applies; keys that are absent from the rule do not restrict."""
    checks = [_listed("tipo", rule["tipos_origen"]), f"bloque <=> {sql_text(rule['bloque_origen'])}"]
    for key, column, wanted in (
        ("excluir_conceptos", "concepto", False),
        ("incluir_conceptos", "concepto", True),
        ("excluir_dominio", "dominio", False),
        ("incluir_dominio", "dominio", True),
    ):
        if key in rule:
            checks.append(("" if wanted else "NOT ") + _listed(column, rule[key]))
    if "incluir_origen" in rule:
        watched = rule["incluir_origen"]
        checks.append(f"({_listed('origen', watched)} OR {_listed('cuenta_destino', watched)})")
    # Any other sign condition does not restrict.
    checks += {"POSITIVO": ["valor > 0"], "NEGATIVO": ["valor < 0"]}.get(rule["condicion_valor"], [])
    if rule.get("requiere_origen"):
        checks.append("coalesce(origen, '') <> ''")
    return " AND ".join(checks)


def _is_complementary(rule: dict) -> bool:
    return rule.get("tipo") == COMPLEMENTARY


def _any(names: list) -> str:
    return "(" + " OR ".join(names) + ")" if names else "false"


def _flagged(movements: DataFrame, config: LedgerConfig, first_normal_rule_only: bool) -> tuple:
    """Movements with one boolean column per active rule, and the (position, rule, column) list."""
    active = [(pos, rule, f"_regla_{pos}") for pos, rule in enumerate(config.rules) if rule.get("activo")]
    flags = [f"coalesce({rule_condition(rule)}, false) AS {name}" for _, rule, name in active]
    flagged = movements.selectExpr("*", *flags)
    if first_normal_rule_only:
        normal = [name for _, rule, name in active if not _is_complementary(rule)]
        firsts = {name: F.expr(f"{name} AND NOT {_any(normal[:i])}") for i, name in enumerate(normal)}
        flagged = flagged.withColumns(firsts) if firsts else flagged
    return flagged, active


def _fired(hits: list) -> str:
    """Explodes the values of the (condition, value) pairs that hold; others come out as null."""
    return "explode(array(" + ", ".join(f"CASE WHEN {condition} THEN {value} END" for condition, value in hits) + "))"


def rule_matches(movements: DataFrame, config: LedgerConfig) -> DataFrame:
    """One row per (movement, matching rule)."""
    flagged, active = _flagged(movements, config, False)
    names = [(pos, rule["id"], _is_complementary(rule)) for pos, rule, _ in active]
    schema = pa.schema([("regla_pos", pa.int32()), ("regla_id", pa.string()), ("complementaria", pa.bool_())])
    hits = _fired([(name, pos) for pos, _, name in active] or [("false", 0)])
    matched = flagged.selectExpr("trx_id", f"{hits} AS regla_pos")
    return matched.join(small_table(movements.sparkSession, names, schema), "regla_pos")


def unsupported_movements(movements: DataFrame, config: LedgerConfig) -> DataFrame:
    """Movements held back because a rule they match names an unknown operation."""
    flagged, active = _flagged(movements, config, False)
    return flagged.filter(_any(_with_unknown_operation(active))).select(*movements.columns)


def _with_unknown_operation(active: list) -> list:
    return [
        name for _, rule, name in active if any(a["operacion"] not in SUPPORTED_OPERATIONS for a in rule["acciones"])
    ]


_ACTIONS = pa.schema(
    [
        ("regla_pos", pa.int32()), ("accion_pos", pa.int32()), ("regla_id", pa.string()), ("por_regla", pa.bool_()),
        ("complementaria", pa.bool_()), ("operacion", pa.string()), ("ruta", pa.string()),
        ("vigiladas", pa.list_(pa.string())), ("a_tipo", pa.string()), ("a_bloque", pa.string()),
        ("a_dominio", pa.string()), ("a_concepto", pa.string()),
    ]
)


def _actions(spark: SparkSession, config: LedgerConfig, active: list, wanted) -> DataFrame:
    """One row per action that posts on a wanted key type, plus the default entry."""
    rows = [
        (
            pos, step, rule["id"], True, _is_complementary(rule), a["operacion"], a.get("origen_destino"),
            list(rule.get("incluir_origen", [])), a["tipo_destino"], a["bloque_destino"],
            a.get("dominio_destino") or None, a.get("concepto_destino") or None,
        )
        for pos, rule, _ in active
        for step, a in enumerate(rule["acciones"])
        if wanted(a["tipo_destino"]) and a["operacion"] in SUPPORTED_OPERATIONS
    ]
    rows.append((len(config.rules), 0, None, False, False, "REPLICAR", None, [], None, None, None, None))
    return small_table(spark, rows, _ACTIONS)


def _flips(config: LedgerConfig) -> bool:
    """Whether an active rule increments a destination account, which may turn out to be a card."""
    return any(
        a["operacion"] == "INCREMENTAR" and a.get("origen_destino") == "USAR_CUENTA_DESTINO"
        for r in config.rules
        if r.get("activo")
        for a in r["acciones"]
    )


def postings(
    movements: DataFrame,
    config: LedgerConfig,
    only: list | None = None,
    without: list | None = None,
    first_normal_rule_only: bool = False,
) -> DataFrame:
    """All postings of the movements, in replay order columns, before limiting.

    ``only`` and ``without`` select postings by key type; the others are not even
    generated. ``first_normal_rule_only`` stops at the first normal rule that
    matches (by default all matching rules apply, so a negative transfer can post
    twice). Movements that match a rule with an unknown operation are left out;
    ``unsupported_movements`` lists them.
    """

    def wanted(kind: str) -> bool:
        return (only is None or kind in only) and (without is None or kind not in without)

    spark = movements.sparkSession
    if "seq" not in movements.columns:
        movements = movements.withColumn("seq", F.lit(None).cast("string"))
    card_target = "false"
    if _flips(config):
        types = config.account_type_dim(spark).selectExpr("dominio", "nombre AS cuenta_destino", "tipo_nombre AS _tipo_destino")
        movements = movements.join(types, ["dominio", "cuenta_destino"], "left")
        card_target = "_tipo_destino <=> 'TARJETA'"

    flagged, active = _flagged(movements, config, first_normal_rule_only)
    unknown = _with_unknown_operation(active)
    if unknown:
        flagged = flagged.filter(f"NOT {_any(unknown)}")
    unmatched = "NOT " + _any([name for _, rule, name in active if not _is_complementary(rule)])
    if only is not None:
        unmatched += " AND " + _listed("tipo", only)
    if without is not None:
        unmatched += " AND NOT " + _listed("tipo", without)
    hits = [
        (f"{name} AND valor <> 0", pos)
        for pos, rule, name in active
        if any(wanted(a["tipo_destino"]) for a in rule["acciones"])
    ]
    hits.append((unmatched, len(config.rules)))

    fired = flagged.selectExpr(
        "trx_id", "created_at", "seq", "corte", "dominio", "tipo", "bloque", "concepto", "nullif(origen, '') AS origen",
        "nullif(cuenta_destino, '') AS cuenta_destino", "valor", f"{card_target} AS _a_tarjeta", f"{_fired(hits)} AS regla_pos",
    ).filter("regla_pos IS NOT NULL")
    to_target, to_affected = "ruta <=> 'USAR_CUENTA_DESTINO'", "ruta <=> 'USAR_CUENTA_AFECTADA'"
    keyed = sql_list(KEYED_BY_ORIGIN)
    # Paying into a card lowers what is owed on it.
    falls = f"operacion = 'DECREMENTAR' OR (operacion = 'INCREMENTAR' AND {to_target} AND _a_tarjeta)"
    return (
        fired.join(_actions(spark, config, active, wanted), "regla_pos")
        .selectExpr(
            "trx_id", "created_at", "seq", "corte", "regla_pos", "accion_pos", "regla_id", "por_regla", "complementaria",
            "coalesce(a_dominio, dominio) AS dominio",
            "coalesce(a_tipo, tipo) AS tipo",
            "coalesce(a_concepto, concepto) AS concepto",
            "coalesce(a_bloque, bloque) AS bloque",
            f"""CASE WHEN {to_target} THEN cuenta_destino
                     WHEN {to_affected} AND array_contains(vigiladas, origen) THEN origen
                     WHEN {to_affected} AND array_contains(vigiladas, cuenta_destino) THEN cuenta_destino
                     WHEN {to_affected} THEN NULL
                     WHEN por_regla OR tipo IN {keyed} THEN origen END AS origen""",
            f"CASE WHEN operacion = 'REPLICAR' THEN valor WHEN {falls} THEN -abs(valor) ELSE abs(valor) END AS delta",
            f"{to_target} OR {to_affected} AS _enrutada",
        )
        # A routed action without an account to post to is skipped.
        .filter("NOT _enrutada OR origen IS NOT NULL")
        .selectExpr(
            "* EXCEPT (_enrutada)",
            f"CASE WHEN tipo IN {keyed} THEN origen END AS origen_clave",
            "por_regla AND bloque = 'PROYECCION' AND delta < 0 AS limitado",
        )
    )


def limited_kinds(config: LedgerConfig) -> list:
    """Key types that an active rule can decrement against a projection."""
    return sorted(
        {
            a["tipo_destino"]
            for r in config.rules
            if r.get("activo")
            for a in r["acciones"]
            if a["bloque_destino"] == "PROYECCION"
        }
    )


def additive_kinds(config: LedgerConfig) -> list:
    """Key types whose balance is a plain sum and whose block and origin follow from the key.

    They need no ordering, so their postings can be summed before any shuffle.
    """
    blocks = {}
    for rule in config.rules:
        if rule.get("activo"):
            for action in rule["acciones"]:
                blocks.setdefault(action["tipo_destino"], set()).add(action["bloque_destino"])
    limited = limited_kinds(config)
    return [k for k in KEYED_BY_ORIGIN if k not in limited and blocks.get(k, set()) <= {"CAJA_ACTUAL"}]
