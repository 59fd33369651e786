"""Whole-message JSON parsing.

``from_json`` alone is too lenient for a message contract: it takes a number
where a string is due, ignores text after the object and keeps the good half of
a bad message.  Here one bad field fails the whole message.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructType, TimestampType

from gridloom.functions.once import add_once
from gridloom.functions.times import is_rfc3339_sql, unless_zero_sql

_CHECK = "gridloom:whole"
#: Drawn anew in each process, so no message can have been written to hold it.
_MARK = secrets.randbits(62)
_OPTIONS = (
    "map('columnNameOfCorruptRecord', '_corrupt',"
    " 'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
)


def parse_whole(df: DataFrame, text: str, schema: StructType, into: str) -> DataFrame:
    """Add ``into``: the parsed object, or NULL where the text is not acceptable.

    The text becomes the middle one of three array items; the others carry a mark
    that no text knows.  Both are read back only if the text was exactly one JSON
    value: text that closes the array and opens another one under the same key
    loses the first item, and text after the object adds items.  All this is
    noticed in the same, single parse.  Strings and times are read as variants,
    which keep the kind of the value.
    """
    fields = ", ".join(f"`{f.name}` {_wire_type(f.dataType)}" for f in schema.fields)
    mark = f'{{"{_CHECK}":{_MARK}}}'
    wrapped = (
        f"from_json('{{\"items\":[{mark},' || `{text}` || ',{mark}]}}',"
        f" 'items array<struct<{fields}, `{_CHECK}` bigint>>, _corrupt string', {_OPTIONS})"
    )
    df = df.withColumn("_json", F.expr(wrapped)).withColumns(
        {
            "_one": F.expr(
                f"_json._corrupt is null and size(_json.items) = 3"
                f" and _json.items[0].`{_CHECK}` <=> {_MARK}L"
                f" and _json.items[2].`{_CHECK}` <=> {_MARK}L"
            ),
            "_item": F.expr("_json.items[1]"),
        }
    )
    checks, leaves, times, values = ["_one"], {}, {}, []
    for f in schema.fields:
        inner = f.dataType.fields if isinstance(f.dataType, StructType) else None
        parts = []
        for g in inner or [f]:
            path = f"_item.`{f.name}`" + (f".`{g.name}`" if inner else "")
            value = path
            if isinstance(g.dataType, (StringType, TimestampType)):
                checks.append(
                    f"coalesce(schema_of_variant({path}) in ('STRING', 'VOID'), true)"
                )
                value = f"_leaf{len(leaves)}"
                leaves[value] = F.expr(f"try_cast({path} as string)")
            if isinstance(g.dataType, TimestampType):
                time = f"_time{len(times)}"
                times[time] = F.expr(f"try_cast({value} as timestamp)")
                checks.append(is_rfc3339_sql(value, time))
                value = unless_zero_sql(value, time)
            parts.append(f"'{g.name}', {value}")
        body = f"named_struct({', '.join(parts)})"
        values.append(f"'{f.name}', {body}" if inner else parts[0])
    whole = f"case when {' and '.join(checks)} then named_struct({', '.join(values)}) end"
    parsed = add_once(df.withColumns(leaves).withColumns(times), {into: F.expr(whole)})
    return parsed.drop("_json", "_one", "_item", *leaves, *times)


def _wire_type(kind) -> str:
    if isinstance(kind, StructType):
        return "struct<" + ", ".join(f"`{g.name}`: {_wire_type(g.dataType)}" for g in kind.fields) + ">"
    if isinstance(kind, (StringType, TimestampType)):
        return "variant"
    return kind.simpleString()
