"""Prompt messages from a table of variables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seawarden import fixed_values as fixed
from seawarden.functions.text import quote, template, template_fields
from seawarden.operators import add


def render(df: DataFrame, messages: Sequence[tuple[str, str]] = tuple(fixed.OUTLINE_PROMPT)) -> DataFrame:
    """Adds ``messages`` (role, content) per row, and ``error`` naming the variables that are null.

    A row with a missing variable has an error and no messages.
    """
    variables = list(dict.fromkeys(name for _, text in messages for name in template_fields(text)))
    absent = ", ".join(f"if({name} IS NULL, {quote(name)}, NULL)" for name in variables) or "NULL"
    filled = ", ".join(
        f"named_struct('role', {quote(role)}, 'content', {template(text)})" for role, text in messages
    )
    complete = " AND ".join(f"{name} IS NOT NULL" for name in variables) or "true"
    return add(
        df,
        error=f"if({complete}, NULL, concat('missing variable: ', concat_ws(', ', {absent})))",
        messages=f"if({complete}, array({filled}), NULL)",
    )
