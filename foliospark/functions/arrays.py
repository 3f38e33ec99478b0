"""Building blocks over array columns used by the in-row operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    An expression used inside a lambda is evaluated once per element; a lambda
    variable is not, so the value is bound by a one-element ``transform``.
    """
    return F.transform(F.array(value), body)[0]


def _append_scan(values: Column, zero: Column, step) -> Column:
    """Exclusive scan of a short array."""
    start = F.struct(zero.alias("last"), F.slice(F.array(zero), 1, 0).alias("seen"))
    return F.aggregate(
        values,
        start,
        lambda acc, x: F.struct(
            step(acc["last"], x).alias("last"), F.array_append(acc["seen"], acc["last"]).alias("seen")
        ),
        lambda acc: acc["seen"],
    )


def _scan(values: Column, zero: int, step) -> Column:
    """Exclusive scan: element i combines ``zero`` and all elements before i.

    Appending to an array copies it, so the scan runs in blocks of about
    sqrt(n) elements: cost n * sqrt(n) in place of n * n.
    """
    first = F.lit(zero).cast("int")

    def blockwise(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))
        return let(width, lambda w: let(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(v) - 1) / w).cast("int")),
                lambda b: F.slice(v, b * w + 1, w),
            ),
            lambda blocks: let(
                _append_scan(
                    F.transform(blocks, lambda block: F.aggregate(block, first, step)), first, step
                ),
                lambda heads: F.flatten(F.zip_with(
                    blocks, heads, lambda block, head: _append_scan(block, head, step)
                )),
            ),
        ))

    return let(values, lambda v: F.when(F.size(v) > 0, blockwise(v)).otherwise(v))


def sums_before(values: Column) -> Column:
    """For an array of ints, the sum of the elements before each position."""
    return _scan(values, 0, lambda a, b: a + b)


def max_before(values: Column) -> Column:
    """For an array of ints, the greatest element before each position (-1 for none)."""
    return _scan(values, -1, lambda a, b: F.greatest(a, b))


def fold_text(rows: Column, start: Column, step: Callable[[Column, Column], Column], end: Callable[[Column], Column]) -> Column:
    """Text that ``step`` appends to the state's ``out`` row by row, and what ``end`` makes of the last state.

    The rows are folded in runs of about the root of their number, each with an ``out`` of its own, so that what is
    written is not copied for every row.
    """
    def run(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, acc["state"].withField("out", F.lit("")), step)
        return let(done, lambda d: F.struct(d.alias("state"), F.array_append(acc["outs"], d["out"]).alias("outs")))

    def whole(rs: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(rs))).cast("int"), F.lit(1))
        return let(width, lambda w: F.aggregate(
            F.transform(F.sequence(F.lit(0), F.floor((F.size(rs) - 1) / w).cast("int")), lambda b: F.slice(rs, b * w + 1, w)),
            F.struct(start.alias("state"), F.array().cast("array<string>").alias("outs")), run,
            lambda acc: F.concat(F.array_join(acc["outs"], ""), end(acc["state"]))))

    return let(rows, whole)
