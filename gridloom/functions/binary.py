"""Hex text and big-endian float32 fields as plain expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_hex(text: Column) -> Column:
    """Whole bytes of hex digits in either case; the empty text counts."""
    return text.rlike(r"^[0-9A-Fa-f]*\z") & (F.length(text) % 2 == 0)


def be_bits(text: str, first_byte: int) -> Column:
    """Four bytes of checked hex text as an unsigned whole number."""
    return F.expr(f"cast(conv(substr({text}, {2 * first_byte + 1}, 8), 16, 10) as bigint)")


def float32_of_bits(bits: str) -> Column:
    """The float32 with these bits, NaN, infinities and subnormals included."""
    sign = f"if({bits} >= 2147483648, -1.0D, 1.0D)"
    exponent = f"(shiftright({bits}, 23) & 255)"
    fraction = f"({bits} & 8388607)"
    return F.expr(
        f"cast(case when {exponent} = 255 and {fraction} <> 0 then double('NaN')"
        f" when {exponent} = 255 then {sign} * double('Infinity')"
        f" when {exponent} = 0 then {sign} * {fraction} * pow(2.0D, -149D)"
        f" else {sign} * ({fraction} + 8388608) * pow(2.0D, {exponent} - 150) end as float)"
    )


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
