"""Column helpers over arrays that stay linear on long arrays and never leave the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def positions(array: Column) -> Column:
    """0-based positions of an array; empty for an empty array."""
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(
        F.array().cast("array<int>")
    )


def blocks(array: Column) -> Column:
    """A non-empty array cut into arrays of at most 64 elements."""
    starts = F.sequence(F.lit(1), F.size(array), F.lit(_BLOCK))
    return F.transform(starts, lambda s: F.slice(array, s, F.lit(_BLOCK)))


def _scan(numbers: Column) -> Column:
    """Running totals by appending: quadratic, so only for short arrays."""
    return F.aggregate(
        numbers,
        F.array().cast("array<int>"),
        lambda done, x: F.concat(done, F.array(x + F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)))),
    )


def running_totals(numbers: Column) -> Column:
    """Inclusive running totals of an int array.

    The array is cut into blocks of 64. Each block is scanned on its own and lifted by the total of the
    blocks before it, so an array of n numbers costs about 64 n + (n / 64)^2 steps instead of n^2.
    """
    def lift(parts: Column) -> Column:
        totals = F.transform(parts, lambda b: F.get(b, F.size(b) - 1))
        return let(
            _scan(totals),
            lambda upto: F.flatten(
                F.transform(
                    parts,
                    lambda b, i: F.transform(b, lambda x: x + F.coalesce(F.get(upto, i - 1), F.lit(0))),
                )
            ),
        )

    def scanned(xs: Column) -> Column:
        return F.transform(blocks(xs), _scan)

    return let(
        numbers,
        lambda xs: F.when(F.size(xs) > 0, let(scanned(xs), lift)).otherwise(F.array().cast("array<int>")),
    )


def scanned(array: Column, start: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """The states of a fold: ``start`` is changed by ``step(state, element)``, and each result, of SQL type ``kind``, kept.

    States are gathered in blocks of 64, because appending to one long array would copy it each time.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(state: Column, x: Column) -> Column:
        return let(
            step(state["last"], x),
            lambda new: F.struct(new.alias("last"), F.concat(state["kept"], F.array(new)).alias("kept")),
        )

    def block(state: Column, xs: Column) -> Column:
        return let(
            F.aggregate(xs, F.struct(state["last"].alias("last"), none.alias("kept")), one),
            lambda done: F.struct(
                done["last"].alias("last"), F.concat(state["kept"], F.array(done["kept"])).alias("kept")
            ),
        )

    def run(xs: Column) -> Column:
        state = F.struct(start.cast(kind).alias("last"), F.array().cast(f"array<array<{kind}>>").alias("kept"))
        return F.aggregate(blocks(xs), state, block, lambda s: F.flatten(s["kept"]))

    return let(array, lambda xs: F.when(F.size(xs) > 0, run(xs)).otherwise(none))
