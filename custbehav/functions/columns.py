"""Column expressions shared by the operators. All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# All characters Python's str.strip removes; Spark's plain trim removes spaces only.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Amounts are added as decimals with twelve places: up to ten quadrillion each, in steps of a trillionth.
AMOUNT = "decimal(28,12)"


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(WHITESPACE))


def category_level(code: Column, level: int) -> Column:
    """The dotted part at ``level`` (1-3); a part that is absent is "unknown", an empty one stays."""
    return F.coalesce(F.get(F.split(code, r"\."), F.lit(level - 1)), F.lit("unknown"))


def day_name(weekday: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), weekday + 1)


def is_number(column: Column) -> Column:
    """True for anything but null and NaN (Spark holds NaN greater than every number)."""
    return column.isNotNull() & ~F.isnan(column)


def amount_sums(value: Column, name: str) -> list[Column]:
    """Aggregates that add amounts exactly; ``amount_total`` of the same name turns them into a double.

    Every amount takes the same path, whatever its size and the number of rows, and the sum does not depend on
    their order. An amount of ten quadrillion or more fails (ANSI mode), one below half a trillionth adds 0.
    """
    return [F.sum(value.cast(AMOUNT)).alias(f"{name}_sum")]


def amount_total(name: str, regroup: bool = False) -> Column:
    """Total of ``amount_sums``; ``regroup`` adds the sums of several groups first. No amounts give 0."""
    total = F.col(f"{name}_sum")
    return F.coalesce((F.sum(total) if regroup else total).cast("double"), F.lit(0e0))


def round_half_up(value: Column, digits: int) -> Column:
    scale = 10.0 ** digits
    return F.floor(value * F.lit(scale) + F.lit(0.5e0)).cast("double") / F.lit(scale)


def count_when(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Share as double; null when there is nothing to divide by."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def format_percent(share: Column) -> Column:
    """``share`` as "x.x%", rounded to the nearest tenth on its binary value and to even on a tie."""
    percent = share * F.lit(100e0)
    low = F.floor(percent * F.lit(10e0)).cast("double")
    # Twenty times the percentage against the odd number at the midpoint, in steps without rounding error.
    to_midpoint = low * F.lit(2e0) + F.lit(1e0) - percent * F.lit(16e0)
    beyond, tie = percent * F.lit(4e0) > to_midpoint, percent * F.lit(4e0) == to_midpoint
    up = beyond | (tie & (low % F.lit(2e0) == F.lit(1e0)))
    return F.format_string("%.1f%%", (low + up.cast("double")) / F.lit(10e0))
