"""Text literals, lists kept as text, and text built from templates."""

from __future__ import annotations

from string import Formatter


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split_list(text: str) -> str:
    """Items of a comma-separated list, trimmed."""
    return f"transform(split({text}, ','), item -> trim(item))"


def template_fields(template: str) -> list[str]:
    """Variable names of a template, each once."""
    names = [name for _, name, _, _ in Formatter().parse(template) if name]
    return list(dict.fromkeys(names))


def template(text: str) -> str:
    """``"at {port}, {speed:%.1f} kn"`` as one concat over columns; null if any variable is null.

    The template is cut into pieces once, so a value that itself holds braces is kept as it is.
    ``{{`` and ``}}`` stand for single braces. A format after the colon is a ``format_string``.
    """
    pieces = []
    for literal, name, spec, _ in Formatter().parse(text):
        if literal:
            pieces.append(quote(literal))
        if name and spec:
            # format_string prints a null as "null"; keep it a null instead
            pieces.append(f"if({name} IS NULL, NULL, format_string({quote(spec)}, {name}))")
        elif name:
            pieces.append(f"cast({name} AS string)")
    return f"concat({', '.join(pieces)})" if pieces else "''"
