"""Conditions as data: a table of rules, compiled to one column and evaluated once."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType, TimestampType

from gridloom.operators.ordering import spread_write

# The comparisons that a rule may use.
COMPARES = {
    "=": lambda x, y: x == y,
    "<>": lambda x, y: x != y,
    "<": lambda x, y: x < y,
    "<=": lambda x, y: x <= y,
    ">": lambda x, y: x > y,
    ">=": lambda x, y: x >= y,
    "in": lambda x, y: x.isin(y),
    "starts with": lambda x, y: x.startswith(y),
}
MOST_RULES = 63


class Rule(NamedTuple):
    """Rows of ``report_group`` want items for which ``field compare value`` holds.

    Rules of one name hold together.
    """

    name: str
    report_group: str
    field: str
    compare: str
    value: str


class BadRule(ValueError):
    """A rule that names no field or comparison, or whose value does not fit."""


def load(table: DataFrame) -> list[Rule]:
    """The rules of a table; the number of rules that one pass can hold is checked."""
    rows = table.select(*Rule._fields).limit(10 * MOST_RULES + 1).collect()
    return [Rule(*map(str, r)) for r in sorted(rows)]


def compile_rule(rule: Rule, schema: StructType) -> Column:
    if rule.field not in schema.names:
        raise BadRule(f"{rule.name}: there is no field {rule.field!r}")
    if rule.compare not in COMPARES:
        raise BadRule(f"{rule.name}: {rule.compare!r} is none of {sorted(COMPARES)}")
    kind = schema[rule.field].dataType
    texts = [v.strip() for v in rule.value.split("|")] if rule.compare == "in" else [rule.value]
    try:
        if isinstance(kind, NumericType):
            if rule.compare == "starts with":
                raise ValueError("a number starts with nothing")
            values = [float(v) for v in texts]
        elif isinstance(kind, BooleanType):
            values = [{"true": True, "false": False}[v.lower()] for v in texts]
        elif isinstance(kind, (StringType, TimestampType)):
            values = texts
        else:
            raise ValueError(f"fields of type {kind.simpleString()} are not compared")
    except (ValueError, KeyError) as wrong:
        raise BadRule(f"{rule.name}: {rule.value!r} does not fit {rule.field}: {wrong}") from wrong
    field = F.col(f"`{rule.field}`")
    if isinstance(kind, TimestampType):
        constants = [F.lit(v).cast("timestamp") for v in values]
        return field.isin(*constants) if rule.compare == "in" else COMPARES[rule.compare](field, constants[0])
    return COMPARES[rule.compare](field, values if rule.compare == "in" else values[0])


def conditions(items: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, dict[int, tuple[str, str]]]:
    """Add ``conditions``, a bit per rule name and group; and what each bit stands for."""
    named: dict[tuple[str, str], Column] = {}
    for rule in rules:
        key = (rule.name, rule.report_group)
        holds = compile_rule(rule, items.schema)
        named[key] = named[key] & holds if key in named else holds
    if len(named) > MOST_RULES:
        raise BadRule(f"{len(named)} conditions: one column holds {MOST_RULES}")
    bits = F.lit(0).cast("long")
    for n, holds in enumerate(named.values()):
        bits = bits.bitwiseOR(F.when(F.coalesce(holds, F.lit(False)), F.lit(1 << n)).otherwise(0).cast("long"))
    return items.withColumn("conditions", bits), dict(enumerate(named))


def conditional_reports(items: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Each item once per group that wants it, with the names of the rules that held."""
    marked, meanings = conditions(items, rules)
    groups: dict[str, list[int]] = {}
    for bit, (_, group) in meanings.items():
        groups.setdefault(group, []).append(bit)
    wanted = []
    for group, bits in sorted(groups.items()):
        mask = sum(1 << b for b in bits)
        held = F.filter(
            F.array(*[F.when(F.col("conditions").bitwiseAND(F.lit(1 << b)) != 0, F.lit(meanings[b][0])) for b in bits]),
            lambda x: x.isNotNull(),
        )
        wanted.append(
            F.when(
                F.col("conditions").bitwiseAND(F.lit(mask)) != 0,
                F.struct(F.lit(group).alias("report_group"), F.array_join(F.array_sort(held), ",").alias("rules")),
            )
        )
    each = F.filter(F.array(*wanted), lambda x: x.isNotNull())
    return marked.where("conditions <> 0").select("*", F.inline(each)).drop("conditions")


def write_groups(reports: DataFrame, path: str) -> None:
    """One folder per group; a hot group is split over tasks."""
    spread_write(reports, ["report_group"]).write.mode("overwrite").partitionBy("report_group").parquet(path)
