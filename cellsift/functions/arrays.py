"""Statistics over the short arrays that neighbour search attaches to a row.

Such an array never holds more than the number of neighbours, so these stay
row-local: no regrouping of the exploded neighbours is needed. All take column
names; an array must not contain null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(path: str) -> Column:
    """The array without nulls; empty for a null array."""
    return F.expr(f"coalesce(filter({path}, x -> x IS NOT NULL), filter(slice({path}, 1, 0), x -> true))")


def mean(values: str) -> Column:
    """Mean, the value itself if all are equal; null of an empty array."""
    return F.expr(
        f"CASE WHEN array_min({values}) = array_max({values}) THEN array_min({values}) "
        f"ELSE try_divide(aggregate({values}, 0D, (s, x) -> s + x), size({values})) END"
    )


def population_std(values: str, centre: str) -> Column:
    """Deviation around a mean that was computed as a column of its own."""
    return F.expr(
        f"CASE WHEN array_min({values}) = array_max({values}) THEN 0D ELSE sqrt(try_divide("
        f"aggregate({values}, 0D, (s, x) -> s + (x - {centre}) * (x - {centre})), size({values}))) END"
    )


def median(values: str) -> Column:
    low, high = (f"element_at(array_sort({values}), cast((size({values}) + {i}) DIV 2 AS int))" for i in (1, 2))
    return F.expr(f"CASE WHEN size({values}) > 0 THEN ({low} + {high}) / 2 END")


def mode(values: str) -> Column:
    """Most frequent value, the smallest of several."""
    return F.expr(
        f"array_min(transform(array_distinct({values}), x -> named_struct("
        f"'neg_count', -size(filter({values}, y -> y = x)), 'value', x))).value"
    )


def share(values: str, wanted: str) -> Column:
    return F.expr(f"try_divide(size(filter({values}, x -> x = {wanted})), size({values}))")
