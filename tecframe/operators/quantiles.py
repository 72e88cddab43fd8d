"""Exact grouped quantiles that stay exact when one group holds most of the rows.

Equal values of a group collapse to one row with a count, combined map-side.
Rows are then ranked in bins of magnitude: a running count inside each
(group, bin), plus the counts of the group's lower bins. No aggregation buffer
and no sort holds a whole group, and every group takes the same way. Several
metrics share the pass. NaN counts as NULL; infinities have bins of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# bins of one octave: values of a bin differ by one part in some six thousand at most
_PER_OCTAVE = 4096
_INFINITE = 1 << 40


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    wanted: dict[str, tuple[str, float]],
    *,
    counts: dict[str, str] | None = None,
    extra: Sequence[Column] = (),
    bounded: bool = False,
) -> DataFrame:
    """One row per group: ``wanted`` maps output name to (column, probability).

    ``counts`` maps output name to the column whose values are counted in the
    same pass. ``extra`` holds other aggregates, which Spark combines map-side
    in a pass of their own. NULL and NaN are skipped; a group without values
    gives NULL. ``bounded`` states that the caller's keys bound the group, so
    that Spark's own ``percentile``, which buffers a group's distinct values,
    may compute the same.
    """
    keys, counts = list(keys), counts or {}
    if bounded:
        plain = [F.percentile(_value(c), F.lit(p)).alias(out) for out, (c, p) in wanted.items()]
        return df.groupBy(*keys).agg(*plain, *[F.count(c).alias(out) for out, c in counts.items()], *extra)
    ranked = _ranked(df, keys, wanted, counts)
    if not extra:
        return ranked
    aside = df.groupBy(*keys).agg(*extra)
    others = [c for c in aside.columns if c not in keys]
    right = aside.select(*others, *[F.col(k).alias("_r_" + k) for k in keys])
    return ranked.join(right, [F.col(k).eqNullSafe(F.col("_r_" + k)) for k in keys]).select(*keys, *wanted, *counts, *others)


def grouped_median(
    df: DataFrame, keys: Sequence[str], columns: dict[str, str], **options
) -> DataFrame:
    """``columns`` maps output name to column."""
    return grouped_quantiles(df, keys, {o: (c, 0.5) for o, c in columns.items()}, **options)


def _value(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value + F.lit(0.0))  # one zero


def quantile_by_rank(
    df: DataFrame, keys: Sequence[str], column: str, p: float, out: str
) -> DataFrame:
    """Exact linear-interpolated quantile; groups without values are left out."""
    return grouped_quantiles(df, keys, {out: (column, p)}).filter(F.col(out).isNotNull())


def _bin(value: Column) -> Column:
    """Number of the value's bin, monotone in the value."""
    size = F.abs(value)
    magnitude = F.when(size == float("inf"), F.lit(_INFINITE)).otherwise(
        F.floor(F.log2(size) * float(_PER_OCTAVE)) + 2000 * _PER_OCTAVE
    )
    return F.when(value == 0, F.lit(0)).when(value > 0, magnitude).otherwise(-magnitude).cast("long")


def _ranked(
    df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]], counts: dict[str, str]
) -> DataFrame:
    """All quantiles and counts in one pass: a value becomes a row of (group, number of the metric, value).

    Counted columns are metrics of one value, zero; so is a row without any
    value, for the sake of its group.
    """
    metrics = [(out, _value(c), p) for out, (c, p) in wanted.items()]
    metrics += [(out, F.when(F.col(c).isNotNull(), F.lit(0.0)), 0.0) for out, c in counts.items()]
    metrics.append((None, F.when(F.coalesce(*[v for _, v, _ in metrics]).isNull(), F.lit(0.0)), 0.0))
    cells = F.array(*[F.struct(F.lit(i).alias("_m"), v.alias("_v")) for i, (_, v, _) in enumerate(metrics)])
    rows = df.select(*keys, F.inline(cells)).filter(F.col("_v").isNotNull())
    values = rows.groupBy(*keys, "_m", "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_bin", _bin(F.col("_v")))
    state = values.withColumn("_end", F.sum("_c").over(Window.partitionBy(*keys, "_m", "_bin").orderBy("_v")))
    # the number of bins follows the spread of a group's values, not its rows
    group = Window.partitionBy(*keys, "_m")
    bins = state.groupBy(*keys, "_m", "_bin").agg(F.sum("_c").alias("_s"))
    bins = bins.withColumn("_total", F.sum("_s").over(group)).withColumn("_before", F.sum("_s").over(group.orderBy("_bin")) - F.col("_s"))
    share = F.element_at(F.array(*[F.lit(float(p)) for _, _, p in metrics]), F.col("_m") + 1)
    bins = bins.withColumn("_at", (F.col("_total") - 1) * share)
    bins = bins.withColumns({"_lower": F.floor("_at"), "_upper": F.ceil("_at")})
    holds = lambda r, begin, end: (begin <= r) & (r < end)
    last = F.col("_before") + F.col("_s")
    bins = bins.filter(holds(F.col("_lower"), F.col("_before"), last) | holds(F.col("_upper"), F.col("_before"), last))
    place = [*keys, "_m", "_bin"]
    right = bins.select(*[F.col(k).alias("_t" + k) for k in place], "_before", "_lower", "_upper", "_at", "_total")
    found = state.join(right, [F.col(k).eqNullSafe(F.col("_t" + k)) for k in place])
    end = F.col("_before") + F.col("_end")
    low, high = (holds(F.col(c), end - F.col("_c"), end) for c in ("_lower", "_upper"))
    found = found.filter(low | high).withColumns({"_low": F.when(low, F.col("_v")), "_high": F.when(high, F.col("_v"))})
    of = lambda i, c: F.max(F.when(F.col("_m") == i, F.col(c)))
    parts = ("_low", "_high", "_lower", "_upper", "_at")
    sums = [of(i, c).alias(f"{c}{i}") for i in range(len(wanted)) for c in parts]
    sums += [F.coalesce(of(len(wanted) + j, "_total"), F.lit(0)).alias(f"_n{j}") for j in range(len(counts))]
    out = found.groupBy(*keys).agg(*sums)
    columns = []
    for i, name in enumerate(wanted):
        a, b, lower, upper, at = (F.col(f"{c}{i}") for c in parts)
        columns.append(F.when(a == b, a).otherwise((upper - at) * a + (at - lower) * b).alias(name))
    return out.select(*keys, *columns, *[F.col(f"_n{j}").alias(name) for j, name in enumerate(counts)])
