"""Spans of a text (code points, end exclusive) as expressions whose cost grows with the text, however many there are.

`substring` walks a text from its start, and an array that grows by one is copied at every step. So
a text is cut once into pieces of `_PIECE` code points, from which a part is put together, and running
states are kept in blocks, and those in larger ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let

_PIECE_BITS, _BLOCKS = 8, (1 << 14, 1 << 7)


def pieces(text: Column) -> Column:
    """`text` in pieces, for `part`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << _PIECE_BITS}}}"), F.lit(0))


def part(text_pieces: Column, start: Column, end: Column) -> Column:
    """The code points of [start, end) of a text that is given by its pieces."""
    first = F.shiftright(start, _PIECE_BITS)
    some = F.slice(text_pieces, (first + 1).cast("int"), (F.shiftright(end - 1, _PIECE_BITS) + 1 - first).cast("int"))
    inside = F.substring(F.array_join(some, ""), (start - F.shiftleft(first, _PIECE_BITS) + 1).cast("int"), (end - start).cast("int"))
    return F.when(end > start, inside).otherwise("")


def scanned(items: Column, state: str, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The state after each item, from `zero` by `step(state, item)`; `state` is its type.

    An array of states so far is never the value of a `let`, which would copy it at every step.
    """
    last = lambda acc: F.element_at(acc, -1)

    def run(begin: Column, some: Column, sizes: tuple[int, ...]) -> Column:
        if not sizes:
            more = lambda acc, x: F.concat(acc, F.array(step(last(acc), x).cast(state)))
            return F.aggregate(some, F.array(begin).cast(f"array<{state}>"), more, lambda acc: F.slice(acc, F.lit(2), F.size(acc)))
        of = lambda i: F.slice(some, i * sizes[0] + 1, F.lit(sizes[0]))
        next_block = lambda acc, i: F.concat(acc, F.array(let(of(i), lambda x: run(last(last(acc)), x, sizes[1:]))))
        n = F.floor((F.size(some) - 1) / sizes[0]).cast("int")
        return F.aggregate(F.sequence(F.lit(0), n), F.array(F.array(begin)).cast(f"array<array<{state}>>"), next_block, lambda acc: F.flatten(F.slice(acc, F.lit(2), F.size(acc))))

    return let(items, lambda x: F.when(F.size(x) > 0, run(zero, x, _BLOCKS)).otherwise(F.array().cast(f"array<{state}>")))


def find_all(text: Column, pattern: str) -> Column:
    """start, end, value of all matches from left to right. The pattern has no group to return."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("bigint"))
    zero = F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"), F.lit("").alias("value"))

    def step(before: Column, x: Column) -> Column:
        start = before["end"] + x["gap"]
        return F.struct(start.alias("start"), (start + F.length(x["value"])).alias("end"), x["value"].alias("value"))

    def spans(values: Column) -> Column:
        paired = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
        return scanned(paired, "struct<start:bigint,end:bigint,value:string>", zero, step)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def replaced(text: Column, text_pieces: Column, spans: Column, by: Callable[[Column, Column], Column]) -> Column:
    """`text` with its spans (ordered by start, may overlap) replaced: `by(span, reached)` stands for the
    span and what is before it back to `reached`, the end of all spans before."""
    state = "struct<reached:bigint,end:bigint>"
    zero = F.struct(F.lit(0).cast("bigint").alias("reached"), F.lit(0).cast("bigint").alias("end"))
    far = lambda s: scanned(s, state, zero, lambda acc, x: F.struct(acc["end"].alias("reached"), F.greatest(acc["end"], x["end"]).alias("end")))
    joined = lambda s: let(far(s), lambda f: F.concat(F.array_join(F.zip_with(s, f, lambda x, y: by(x, y["reached"])), ""), part(text_pieces, F.element_at(f, -1)["end"], F.length(text).cast("bigint"))))
    return let(spans, lambda s: F.when(F.size(s) > 0, joined(s)).otherwise(text))
