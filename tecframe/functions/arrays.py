"""Array expressions; none of them moves rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tecframe import fixed
from tecframe.functions._col import ColumnLike, col, let


def pick_nearest(axis: ColumnLike, values: ColumnLike, target: float) -> Column:
    """Value at the first axis element closest to ``target``."""
    gaps = F.transform(col(axis), lambda w: F.abs(w - target))
    at = let(gaps, lambda g: F.array_position(g, F.array_min(g)).cast("int"))
    return F.get(col(values), F.nullif(at, F.lit(0)) - 1)


def axis(lo: float, hi: float, step: float) -> Column:
    """lo, lo + step, ... up to hi: integers first, then scaled."""
    count = int((hi - lo) / step + 0.5)
    return F.transform(F.sequence(F.lit(0), F.lit(count)), lambda i: F.lit(lo) + i * step)


def array_median(values: ColumnLike) -> Column:
    """Median of the non-null elements; NULL when there are none."""

    def middle(v: Column) -> Column:
        n = F.size(v)
        lower = F.get(v, F.floor((n - 1) / 2).cast("int"))
        upper = F.get(v, F.floor(n / 2).cast("int"))
        return F.when(n > 0, (lower + upper) / 2.0)

    return let(F.sort_array(F.array_compact(col(values))), middle)


def steps(values: ColumnLike) -> Column:
    """Absolute non-zero differences of neighbours, in array order."""
    v = col(values)
    n = F.size(v)
    ahead = F.slice(v, 2, F.greatest(n - 1, F.lit(0)))
    behind = F.slice(v, 1, F.greatest(n - 1, F.lit(0)))
    diffs = F.zip_with(ahead, behind, lambda a, b: F.abs(a - b))
    return F.filter(diffs, lambda d: d.isNotNull() & ~F.isnan(d) & (d != 0.0))


def native_step(lat: ColumnLike, lon: ColumnLike) -> Column:
    """Smaller of the two median axis steps; 0.5 when neither axis has one."""
    return F.coalesce(
        F.least(array_median(steps(lat)), array_median(steps(lon))),
        F.lit(fixed.DEFAULT_STEP_DEG),
    )


def axis_edges(centre: ColumnLike) -> Column:
    """Cell edges of a one-dimensional axis by midpoints."""
    c = col(centre)
    n = F.size(c)
    inner = F.zip_with(F.slice(c, 2, F.greatest(n - 1, F.lit(0))),
                       F.slice(c, 1, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: (a + b) * 0.5)
    first, second = F.get(c, F.lit(0)), F.get(c, F.lit(1))
    last, before = F.get(c, n - 1), F.get(c, n - 2)
    many = F.concat(
        F.array(first - (second - first) * 0.5), inner, F.array(last + (last - before) * 0.5)
    )
    one = F.array(first - 0.25, first + 0.25)
    return F.when(n == 1, one).when(n > 1, many).otherwise(F.array().cast("array<double>"))


def pick_pair(available: ColumnLike, first: tuple[str, ...], second: tuple[str, ...]) -> Column:
    """Struct (first, second) of the preferred codes, NULL when a side is missing."""
    have = col(available)

    def best(codes: tuple[str, ...]) -> Column:
        wanted = F.array(*[F.lit(c) for c in codes])
        return F.get(F.filter(wanted, lambda c: F.array_contains(have, c)), F.lit(0))

    a, b = best(first), best(second)
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("first"), b.alias("second")))
