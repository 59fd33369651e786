"""Small text predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_blank(value: Column) -> Column:
    """A missing field and an empty one mean the same."""
    return value.isNull() | (value == "")


def empty_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))
