"""Array expressions whose cost grows with the array, not with its square.

A fold that adds to an array copies it at every step, and a ``substring`` counts characters from the start of the
text. So arrays are cut into blocks of ``BLOCK`` elements, blocks of blocks and so on, and a step copies or
counts within one block only. So many ``LEVELS`` of blocks hold 262 144 elements; larger arrays have larger outermost
blocks and give the same results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK, LEVELS = 64, 2


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body or its lambdas name it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(array: Column, width: int) -> Column:
    count = F.ceil(F.size(array) / width).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda k: F.slice(array, k * width + 1, F.lit(width)))


def running(array: Column, step: Callable[[Column, Column], Column], zero: Column, levels: int = LEVELS) -> Column:
    """Of each element the ``step`` of all elements up to it, from ``zero``; ``step`` is associative."""
    def fold(block: Column) -> Column:
        none = F.filter(F.array(zero), lambda x: F.lit(False))
        return F.aggregate(block, none, lambda acc, x: F.concat(
            acc, F.array(step(F.coalesce(F.try_element_at(acc, F.lit(-1)), zero), x))))

    if not levels:
        return fold(array)

    def joined(folded: Column) -> Column:
        lasts = F.transform(folded, lambda b: F.element_at(b, -1))
        return let(running(lasts, step, zero, levels - 1), lambda before: F.flatten(F.transform(
            folded, lambda b, k: F.when(k == 0, b).otherwise(
                F.transform(b, lambda x: step(F.get(before, k - 1), x))))))

    return let(array, lambda a: let(F.transform(_blocks(a, BLOCK), fold), joined))


def running_sums(array: Column) -> Column:
    """Of each element the sum of all elements up to it, as long."""
    longs = F.transform(array, lambda x: x.cast("long"))
    return running(longs, lambda a, b: a + b, F.lit(0).cast("long"))


def pieces(text: Column, points: Column, levels: int = LEVELS) -> Column:
    """The pieces of a text that begin at the points, which ascend from 0 on and are code points; the last
    one ends with the text. Without points there are no pieces."""
    def cut(text: Column, points: Column, levels: int) -> Column:
        if not levels:
            return F.transform(points, lambda p, k: F.substring(
                text, (p + 1).cast("int"),
                F.coalesce(F.get(points, k + 1) - p, F.length(text)).cast("int")))

        def block(b: Column, k: Column, blocks: Column) -> Column:
            base = F.element_at(b, 1)
            after = F.element_at(F.get(blocks, k + 1), 1)
            own = F.substring(text, (base + 1).cast("int"), F.coalesce(after - base, F.length(text)).cast("int"))
            return let(own, lambda t: let(F.transform(b, lambda p: p - base), lambda q: cut(t, q, levels - 1)))

        return let(_blocks(points, BLOCK**levels), lambda blocks: F.flatten(
            F.transform(blocks, lambda b, k: block(b, k, blocks))))

    return let(text, lambda t: let(points, lambda p: cut(t, p, levels)))
