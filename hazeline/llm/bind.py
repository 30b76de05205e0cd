"""Small helpers for long native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = "\t\n\x0b\x0c\r"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Runs of anything but blank, tab, line feed, vertical tab, form feed, carriage return."""
    return F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")


def count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
