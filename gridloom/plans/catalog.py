"""All registered queries and their comparison SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.plans import (
    energy,
    history,
    messages,
    oracle_energy,
    oracle_history,
    oracle_messages,
    oracle_streams,
    streams,
)
from gridloom.plans.meter import Meter, comparable

Query = Callable[[SparkSession, str], DataFrame]


def _over_tables(plan: Callable[[Meter], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(plan(Meter(spark, sf_dir)))

    query.__name__, query.__doc__ = plan.__name__, plan.__doc__
    return query


def queries() -> dict[str, Query]:
    plans = [*messages.QUERIES, *energy.QUERIES, *history.QUERIES, *streams.QUERIES]
    return {plan.__name__: _over_tables(plan) for plan in plans}


def oracle_sql() -> dict[str, str]:
    return {**oracle_messages.ORACLE, **oracle_energy.ORACLE, **oracle_history.ORACLE, **oracle_streams.ORACLE}
