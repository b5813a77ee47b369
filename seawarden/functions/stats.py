"""Aggregates that do not depend on the order of rows."""

from __future__ import annotations

#: Values of this size or more are left to a plain mean of doubles.
LIMIT = 2.0**31
#: Parts of one in which fractions are added up: far below what any reading resolves.
PARTS = 1_000_000_000.0


def scaled(value: str, digits: int) -> str:
    """A decimal quantity as a whole number of its last digit."""
    return f"cast(round({value} * {float(10**digits)}D) AS bigint)"


def whole(value: str) -> str:
    """The whole part of a value below the limit; 0 for others, null for null."""
    return _below_limit(value, f"cast(floor({value}) AS bigint)")


def fraction(value: str) -> str:
    """The fraction of a value below the limit, in whole parts of one; 0 for others, null for null."""
    return _below_limit(value, f"cast(round(({value} - floor({value})) * {PARTS}D) AS bigint)")


def _below_limit(value: str, part: str) -> str:
    return f"CASE WHEN abs({value}) < {LIMIT}D THEN {part} WHEN {value} IS NOT NULL THEN 0L END"


def mean_of_parts(value: str, wholes: str, fractions: str, size: str, over: str = "") -> str:
    """``exact_mean`` from columns that already hold the two parts and the absolute value."""
    total = f"(sum({wholes}) {over} + sum({fractions}) {over} / {PARTS}D)"
    return f"if(max({size}) {over} < {LIMIT}D, {total} / count({value}) {over}, avg({value}) {over})"


def exact_mean(value: str, over: str = "") -> str:
    """Mean of doubles that is the same for every order of rows; ``over`` makes it a window expression.

    Wholes and fractions (to nine digits) are added up as whole numbers, so no rounding depends on the
    order, and the buffers are fixed-width for hash aggregation. A plain mean of doubles differs in its last
    bits, and would flip a score at a threshold. If any value reaches the limit, or is NaN or infinite, the
    plain mean is taken: no cast can fail.
    """
    return mean_of_parts(value, whole(value), fraction(value), f"abs({value})", over)


def exact_avg(value: str, digits: int) -> str:
    """Mean of scores that were rounded to ``digits`` decimals before."""
    return f"sum({scaled(value, digits)}) / {float(10**digits)}D / count({value})"


def exact_sum(value: str, digits: int = 0) -> str:
    """Order-independent sum of amounts that were rounded to ``digits`` decimals before, as double."""
    return f"sum({scaled(value, digits)}) / {float(10**digits)}D"
