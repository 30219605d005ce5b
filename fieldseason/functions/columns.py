"""Columns from expression texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(**texts: str) -> list[Column]:
    return [F.expr(text).alias(name) for name, text in texts.items()]


def quoted(value: str | None) -> str:
    """A string literal, or a null of string type."""
    if value is None:
        return "cast(null as string)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
