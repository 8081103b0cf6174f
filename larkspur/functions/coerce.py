"""Attribute coercion.

An attribute arrives as a VARIANT (number, text, boolean, object, array or
JSON null). Each declared column type has one conversion rule; a value that
is present but cannot be converted is a *failure* and sends its row to the
quarantine instead of the table. Missing attributes and JSON null give a
null column value and are not failures.

Rules (they mirror the Java conversions the reference applies):

* STRING  - the text of the value; integers by their digits, other numbers as
            Java doubles, nested values as JSON text. Never fails.
* INT/LONG - numbers are truncated toward zero (out of range fails); text must
            be ``[+-]?digits`` with no blanks; booleans and nested fail.
* FLOAT/DOUBLE - numbers convert; text is parsed like ``Float.parseFloat``
            (surrounding blanks, ``f``/``d`` suffix, ``NaN``, ``Infinity``).
* BOOLEAN - a boolean is itself; anything else is ``lower(text) = 'true'``.
            Never fails.
* DATE    - text ``yyyy-MM-dd`` that is a real date.
* TIMESTAMP - text ``yyyy-MM-ddTHH:mm[:ss[.f{1,9}]]`` without zone.

The rules are written as SQL expression text over column names: a table
with many columns is then built with one call per column instead of
thousands of small Column calls, and the optimizer sees plain CASE trees.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.contract import SPARK_TYPES

# --- fixed values: textual formats the Java parsers accept ------------------
INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = (
    r"^[\x00-\x20]*[+-]?(NaN|Infinity|(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)[fFdD]?)[\x00-\x20]*$"
)
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?$"
# ---------------------------------------------------------------------------

# The kind of a value is the first two letters of its VARIANT type
# (schema_of_variant); a missing value and JSON null are VOID. All kinds not
# named here are numbers: BIGINT (integers), DECIMAL and DOUBLE.
VOID, STRING, BOOLEAN = "VO", "ST", "BO"
NUMERIC_TYPES = ("INT", "LONG", "FLOAT", "DOUBLE")
NOT_NUMBERS = "('VO', 'ST', 'BO', 'OB', 'AR')"


def _raw(pattern: str) -> str:
    assert "'" not in pattern
    return f"r'{pattern}'"


def kind_sql(a: str) -> str:
    """SQL: kind of the VARIANT expression ``a``."""
    return f"coalesce(left(schema_of_variant({a}), 2), '{VOID}')"


def text_sql(a: str) -> str:
    """SQL: text form of the VARIANT expression ``a`` (JSON text when nested)."""
    return f"try_variant_get({a}, '$', 'string')"


def string_sql(a: str, k: str, t: str) -> str:
    """SQL: the STRING value. A number with a fraction or exponent is the text
    of a double, as Java writes it (``10.0``, ``1.0E-5``); an integer keeps its
    digits, also beyond 64 bits, where a VARIANT holds it as a decimal."""
    double = f"try_variant_get({a}, '$', 'double')"
    return (f"CASE WHEN {k} = 'DE' AND abs({double}) < 9.223372036854775807E18 THEN CAST({double} AS string) "
            f"WHEN {k} <> '{VOID}' THEN {t} END")


def value_sql(a: str, data_type: str, k: str | None = None, t: str | None = None) -> str:
    """SQL: the coerced value of VARIANT ``a`` for a catalog type.

    ``k`` / ``t`` name columns holding ``kind_sql(a)`` / ``text_sql(a)``
    when they were computed in an earlier projection.
    """
    dt = (data_type or "STRING").upper()
    if dt not in SPARK_TYPES:
        dt = "STRING"
    k = k or f"({kind_sql(a)})"
    t = t or f"({text_sql(a)})"
    st = SPARK_TYPES[dt]
    if dt in ("INT", "LONG"):
        body = (f"CASE WHEN {k} NOT IN {NOT_NUMBERS} THEN try_variant_get({a}, '$', '{st}') "
                f"WHEN {k} = '{STRING}' AND {t} RLIKE {_raw(INT_TEXT)} THEN try_cast({t} AS {st}) END")
    elif dt in ("FLOAT", "DOUBLE"):
        body = (f"CASE WHEN {k} NOT IN {NOT_NUMBERS} THEN try_variant_get({a}, '$', '{st}') "
                f"WHEN {k} = '{STRING}' AND {t} RLIKE {_raw(FLOAT_TEXT)} "
                f"THEN try_cast(regexp_replace(trim({t}), {_raw('[fFdD]$')}, '') AS {st}) END")
    elif dt == "BOOLEAN":
        body = (f"CASE WHEN {k} = '{BOOLEAN}' THEN try_variant_get({a}, '$', 'boolean') "
                f"WHEN {k} <> '{VOID}' THEN lower({t}) = 'true' END")
    elif dt == "DATE":
        body = f"CASE WHEN {t} RLIKE {_raw(DATE_TEXT)} THEN try_cast({t} AS date) END"
    elif dt == "TIMESTAMP":
        body = f"CASE WHEN {t} RLIKE {_raw(TIMESTAMP_TEXT)} THEN try_cast({t} AS timestamp_ntz) END"
    else:
        return string_sql(a, k, t)
    return f"CAST({body} AS {st})"


def failed_sql(k: str, value: str) -> str:
    """SQL: a value was present (kind ``k``) but did not convert."""
    return f"({k} <> '{VOID}' AND ({value}) IS NULL)"


# --- Column conveniences ----------------------------------------------------

def attribute(attributes: Column | str, name: str) -> Column:
    """``attributes[name]`` as a VARIANT (null when the key is missing)."""
    col = F.col(attributes) if isinstance(attributes, str) else attributes
    if set(name) & set("'\"\\"):  # a path cannot quote these
        return F.try_variant_get(col, "$", "map<string,variant>").getItem(name)
    return F.try_variant_get(col, f"$['{name}']", "variant")


def coerce(raw: str, data_type: str) -> tuple[Column, Column]:
    """``(value, failed)`` for the VARIANT column (SQL text) ``raw``."""
    value = value_sql(raw, data_type)
    return F.expr(value), F.expr(failed_sql(f"({kind_sql(raw)})", value))
