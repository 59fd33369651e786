"""Time helpers: RFC 3339 text, zero times, millisecond differences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The text of an unset time on the wire, and the accepted form.
ZERO_TIME = "0001-01-01T00:00:00Z"
ZERO_TIME_PATTERN = "^0001-01-01T00:00:00([.]0+)?Z$"
RFC3339_PATTERN = (
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?"
    "(Z|[+-][0-9]{2}:[0-9]{2})$"
)


def is_rfc3339_sql(text: str, time: str) -> str:
    """True for no time, or a well-formed one; ``time`` is NULL if it does not exist."""
    return (
        f"({text} is null or ({time} is not null and {text} rlike '{RFC3339_PATTERN}'"
        f" and not endswith({text}, '\n')))"
    )


def unless_zero_sql(text: str, time: str) -> str:
    """The instant, or NULL for the zero time."""
    return (
        f"case when startswith({text}, '0001-01-01') and {text} rlike '{ZERO_TIME_PATTERN}'"
        f" then null else {time} end"
    )


def to_rfc3339(ts: Column) -> Column:
    """UTC text without trailing zeros in the fraction; an unset time is the zero time."""
    text = F.translate(ts.cast("string"), " ", "T")
    return F.coalesce(F.concat(text, F.lit("Z")), F.lit(ZERO_TIME))


def millis_between(later: Column, earlier: Column) -> Column:
    """Whole milliseconds from ``earlier`` to ``later``, truncated toward zero."""
    return F.call_function(
        "div", F.unix_micros(later) - F.unix_micros(earlier), F.lit(1000)
    )
