"""All matches of a pattern with their places, from built-in functions.

`split` and `regexp_extract_all` walk a text the same way (leftmost, without overlap), so the
pieces between matches and the matches themselves take turns and give every match its place
in code points. Patterns must not match the empty string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.llm.bind import bind


def _between(text: Column, pattern: str) -> Column:
    return F.split(text, pattern, -1)


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


# Sums run in blocks, and over blocks of blocks: a step copies a block's list at most.
BLOCK = 64


def heads(sizes: Column, levels: int = 2) -> Column:
    """Sum of the sizes before each place of a non-empty array; linear in its length."""
    zero, none = F.lit(0), F.array().cast("array<int>")

    def listed(at: Column, first: Column, last: Column) -> Column:
        state = F.struct(at.alias("at"), none.alias("out"))
        return F.aggregate(
            F.sequence(first, last),
            state,
            lambda acc, i: F.struct(
                (acc["at"] + F.get(sizes, i)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
            ),
            lambda acc: acc["out"],
        )

    if levels == 0:
        return listed(zero, zero, F.size(sizes) - 1)

    def bounds(block: Column) -> tuple[Column, Column]:
        return block * BLOCK, F.least((block + 1) * BLOCK, F.size(sizes)) - 1

    blocks = F.sequence(zero, F.floor((F.size(sizes) - 1) / BLOCK).cast("int"))
    sums = F.transform(
        blocks, lambda b: F.aggregate(F.sequence(*bounds(b)), zero, lambda total, i: total + F.get(sizes, i))
    )
    return bind(
        bind(sums, lambda x: heads(x, levels - 1)),
        lambda starts: F.flatten(F.transform(blocks, lambda b: listed(F.get(starts, b), *bounds(b)))),
    )


def pieces(text: Column, pattern: str) -> Column:
    """struct<gaps, found>: what lies between the matches, and the matches."""
    return F.struct(_between(text, pattern).alias("gaps"), _found(text, pattern).alias("found"))


def spans_of(x: Column) -> Column:
    """array<struct<text, start, end>> of the matches among `pieces`; there must be one."""
    sizes = F.transform(x["found"], lambda match, i: F.length(F.get(x["gaps"], i)) + F.length(match))
    return bind(
        bind(sizes, lambda x: heads(x)),
        lambda at: F.transform(
            x["found"],
            lambda match, i: bind(
                F.get(at, i) + F.length(F.get(x["gaps"], i)),
                lambda start: F.struct(
                    match.alias("text"), start.alias("start"), (start + F.length(match)).alias("end")
                ),
            ),
        ),
    )


def rejoined(x: Column, new: Callable[[Column], Column]) -> Column:
    """The text of `pieces` with each match put through `new`."""
    return F.array_join(
        F.transform(
            x["gaps"], lambda gap, i: F.concat(gap, F.coalesce(new(F.get(x["found"], i)), F.lit("")))
        ),
        "",
    )


def located(text: Column, pattern: str) -> Column:
    """array<struct<text, start, end>> of the matches, empty where there are none."""
    empty = F.array().cast("array<struct<text:string,start:int,end:int>>")
    return F.when(text.rlike(pattern), bind(pieces(text, pattern), spans_of)).otherwise(empty)


def replaced(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """The text with each match put through `new`."""
    return F.when(
        text.rlike(pattern), bind(pieces(text, pattern), lambda x: rejoined(x, new))
    ).otherwise(text)
