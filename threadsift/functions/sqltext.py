"""Small pieces of SQL text.

Long rules are written as lists of ``expression AS name`` for ``selectExpr``.
Later entries may use earlier names (lateral aliases), so Spark computes every
part once, and the plan is built in one call instead of hundreds.
"""

from __future__ import annotations

from .text import WHITESPACE


def quote(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + escaped.replace("\n", "\\n").replace("\r", "\\r") + "'"


def listed(values: list[str]) -> str:
    return ", ".join(map(quote, values))


def stripped(expression: str) -> str:
    return f"btrim({expression}, {quote(WHITESPACE)})"
