"""Small linear algebra on arrays: normal equations of a group, solved in its row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Share of a column's own size below which what the columns before it leave unexplained counts as nothing.
PIVOT_FLOOR = 1e-12


def gram_matrix(names: Sequence[str], product: str) -> Column:
    """The symmetric matrix of an aggregate over all pairs of columns, such as ``sum({a} * {b})``; each pair is computed once.

    Written as one SQL text: a matrix of 28 columns has 784 cells.
    """
    cell = lambda i, j: product.format(a=names[min(i, j)], b=names[max(i, j)])
    places = range(len(names))
    return F.expr("array(" + ", ".join("array(" + ", ".join(cell(i, j) for j in places) + ")" for i in places) + ")")


def cross_products(name: str, names: Sequence[str], product: str) -> Column:
    """The aggregate of one column with each of the others."""
    return F.expr("array(" + ", ".join(product.format(a=name, b=other) for other in names) + ")")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def quadratic(matrix: Column, vector: Column) -> Column:
    """vector' * matrix * vector."""
    return dot(F.transform(matrix, lambda row: dot(row, vector)), vector)


def add_to_diagonal(matrix: Column, value: Column, start: int = 0) -> Column:
    """``matrix`` with ``value`` added to its diagonal from place ``start`` on."""
    return F.transform(matrix, lambda row, i: F.transform(row, lambda x, j: F.when((i == j) & (i >= start), x + value).otherwise(x)))


def solve(matrix: Column, target: Column) -> Column:
    """The solution of symmetric normal equations, as an array.

    Each step clears one column in all other rows. Such equations need no exchange of rows; a column that the ones before it explain has nothing
    left on the diagonal and gets the solution 0.
    """
    # Carried along unchanged: the sizes that pivots are held against.
    start = F.struct(
        F.zip_with(matrix, target, lambda row, y: F.concat(row, F.array(y))).alias("rows"),
        F.transform(matrix, lambda row, i: F.get(row, i) * PIVOT_FLOOR).alias("floors"),
    )

    def clear(state: Column, k: Column) -> Column:
        rows, own = state["rows"], F.get(state["rows"], k)
        pivot = F.get(own, k)
        usable = pivot > F.get(state["floors"], k)

        def cleared(row: Column, i: Column) -> Column:
            return (
                F.when(~usable & (i == k), F.transform(row, lambda x: F.lit(0.0)))
                .when(~usable, row)
                .when(i == k, F.transform(row, lambda x: x / pivot))
                .otherwise(F.zip_with(row, own, lambda x, p: x - F.get(row, k) / pivot * p))
            )

        return F.struct(F.transform(rows, cleared).alias("rows"), state["floors"].alias("floors"))

    done = F.aggregate(F.sequence(F.lit(0), F.size(matrix) - 1), start, clear)
    return F.transform(done["rows"], lambda row: F.element_at(row, -1))


def recursion(weights: Column, recent: Column, steps: int) -> Column:
    """``steps`` values that each weigh the ones before them, and behind them ``recent``; the newest first."""
    order = F.size(weights)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), recent, lambda known, _: F.concat(F.array(dot(weights, F.slice(known, F.lit(1), order))), known))
