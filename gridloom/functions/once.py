"""Columns whose expressions later filters must not repeat."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def add_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add computed columns that are evaluated a single time per row.

    A filter on a plain computed column is pushed below its projection with the
    whole expression in it, so a parsed message would be parsed again for every
    condition.  Columns that come out of a generator stay where they are.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
