"""Text, key and amount expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quipu.schema import KEYED_BY_ORIGIN

# Amounts are kept exactly, or refused: 24 digits before the point and 6 after it.
AMOUNT, _FINER = "decimal(30,6)", "decimal(38,12)"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_BLANKS = " \t\n\r\x0b\x0c"


def clean(text: Column) -> Column:
    """Strip blanks on both sides and upper-case."""
    return F.upper(F.trim(text, F.lit(_BLANKS)))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANKS))


def exact_amount(text: Column) -> Column:
    """Exact amount; null where the text is no number, or one that AMOUNT can't hold whole."""
    shown = trimmed(text)
    value = shown.try_cast(AMOUNT)
    cut = shown.rlike(r"^[^eE]*\.\d{6}\d*[1-9]\d*$")
    return F.when((value == shown.try_cast(_FINER)) & ~cut, value)


def is_number(text: Column) -> Column:
    return F.coalesce(trimmed(text).rlike(NUMBER), F.lit(False))


def plain_number(value: Column) -> Column:
    """A number as text, without zeros at the end of its fraction."""
    return F.regexp_replace(value.cast("string"), r"\.0+$|(\.\d*?[1-9])0+$", "$1")


def keyed_origin(tipo: Column, origen: Column) -> Column:
    """The origin where it is part of the balance key, else null."""
    return F.when(tipo.isin(KEYED_BY_ORIGIN), blank_to_null(origen))


def ledger_key(tipo: Column, concepto: Column, origen: Column) -> Column:
    """Key text tipo#concepto[#origen]; null parts are left out."""
    return F.concat_ws("#", tipo, concepto, keyed_origin(tipo, origen))


def in_list(value: Column, names) -> Column:
    """Membership that is false for a null value and for an empty list."""
    return F.coalesce(value.isin(list(names)), F.lit(False)) if names else F.lit(False)


def sql_text(value: str) -> str:
    """A configuration text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(values) -> str:
    return "(" + ", ".join(sql_text(v) for v in values) + ")"


def millions(value: Column, digits: int = 3, scale: int = 1) -> Column:
    """Amount in millions. ``scale`` is the number of amount units per currency unit (100 for cents)."""
    return F.round(value.cast("decimal(28,2)") / F.lit(1_000_000 * scale).cast("decimal(12,0)"), digits)


def millions_text(value: Column, digits: int = 2, scale: int = 1) -> Column:
    """Display text such as -$1.25M."""
    m = millions(value, digits, scale)
    return F.concat(F.when(value < 0, "-").otherwise(""), F.lit("$"), F.abs(m).cast(f"decimal(28,{digits})").cast("string"), F.lit("M"))
