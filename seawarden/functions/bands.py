"""Banded and weighted scores as single expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from seawarden.functions.text import quote


def rounded(expression: str, digits: int | None) -> str:
    return expression if digits is None else f"round({expression}, {digits})"


def bands(rules: Iterable[tuple[str, str]], default: str, digits: int | None = None) -> str:
    """First matching rule's value, else ``default``; a null predicate does not match."""
    arms = " ".join(f"WHEN {predicate} THEN {value}" for predicate, value in rules)
    return rounded(f"CASE {arms} ELSE {default} END", digits)


def labels(score: str, bounds: Iterable[tuple[float, str]], default: str) -> str:
    """Label by inclusive lower bound, bounds in descending order."""
    return bands([(f"{score} >= {low}", quote(label)) for low, label in bounds], quote(default))


def weighted(weights: Mapping[str, float], digits: int | None = None) -> str:
    """Weighted sum of columns in double."""
    return rounded("(" + " + ".join(f"{name} * {weight}D" for name, weight in weights.items()) + ")", digits)


def code_label(code: str, names: Mapping[int, str], default: str) -> str:
    """Label of a code, ``default`` for an unknown or null code."""
    return bands([(f"{code} = {value}", quote(label)) for value, label in names.items()], quote(default))


def label_rank(label: str, order: Iterable[str]) -> str:
    """Position in a given order, unknown labels last; for sorting by a custom rank."""
    order = list(order)
    return bands([(f"{label} = {quote(name)}", str(i)) for i, name in enumerate(order)], str(len(order)))
