"""Row predicates and scalar expressions used by the built-in metrics.

Every helper returns Spark SQL *text* over a back-quoted identifier, so a metric
definition stays hashable (equal definitions are computed once) and printable
(it can be shown in the metrics table and re-parsed with ``F.expr``).

All of them are ANSI-safe: Spark 4 runs with ``spark.sql.ansi.enabled=true``
and a plain ``CAST('abc' AS BIGINT)`` or ``'abc' = 0`` raises, which would
abort a whole fused aggregate.  Text is therefore parsed with ``try_cast``;
text that is not a number is neither zero nor non-positive.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The text shape treated as an integral number (optional sign,
# digits, optionally a dot followed only by zeros, surrounding blanks allowed).
INTEGRAL_TEXT_PATTERN = r"^\s*[+-]?[0-9]+(\.0*)?\s*$"
LEADING_INTEGER_PATTERN = r"([+-]?[0-9]+)"

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType,
)


def quote(name: str) -> str:
    """Back-quote a column name so any character (space, dot, hyphen) is safe."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """Render a Python string as a Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def as_number(ident: str, dtype: T.DataType | None) -> str:
    """Numeric view of a column: itself if numeric, else ``try_cast`` to double."""
    if dtype is not None and isinstance(dtype, NUMERIC_TYPES):
        return ident
    return f"try_cast({ident} AS DOUBLE)"


def is_zero(ident: str, dtype: T.DataType | None = None) -> str:
    return f"{as_number(ident, dtype)} = 0"


def is_non_positive(ident: str, dtype: T.DataType | None = None) -> str:
    # "smaller than 0" includes zero in the checked semantics.
    return f"{as_number(ident, dtype)} <= 0"


def is_null(ident: str) -> str:
    return f"{ident} IS NULL"


def is_empty(ident: str) -> str:
    return f"CAST({ident} AS STRING) = ''"


def is_integral_text(ident: str) -> str:
    """Text that reads as a whole number which fits in a signed 64-bit integer."""
    text = f"CAST({ident} AS STRING)"
    return (
        f"({text} RLIKE {sql_string(INTEGRAL_TEXT_PATTERN)} AND "
        f"try_cast(regexp_extract({text}, {sql_string(LEADING_INTEGER_PATTERN)}, 1) AS BIGINT) IS NOT NULL)"
    )


def as_of_sql(as_of) -> str:
    """SQL for the reference date of freshness metrics (``None`` = today)."""
    if as_of is None:
        return "current_date()"
    return f"DATE {sql_string(str(as_of))}"


def days_from(ident: str, as_of=None) -> str:
    """Signed days from the as-of date to the column's date (future > 0)."""
    return f"datediff(try_cast({ident} AS DATE), {as_of_sql(as_of)})"
