"""Swath geometry. A swath line is one row (entry_id, y) with its pixels as arrays along x."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tecframe.functions._col import ColumnLike, col, let
from tecframe.operators.quantiles import grouped_median


def swath_lines(pixels: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ("entry_id", "y"), x: str = "x") -> DataFrame:
    """Pixel rows to lines; a line is as long as the swath is wide."""
    items = F.sort_array(F.collect_list(F.struct(x, *columns)))
    out = pixels.groupBy(*keys).agg(items.alias("_px"))
    return out.select(*keys, *[F.col(f"_px.{c}").alias(c) for c in columns])


def to_points(lines: DataFrame, columns: Sequence[str], *, keep: Sequence[str] = ("entry_id", "y"), x: str = "x") -> DataFrame:
    """Lines to pixel rows."""
    packed = F.arrays_zip(*[F.col(c) for c in columns])
    return lines.select(*keep, F.posexplode(packed).alias(x, "_p")).select(
        *keep, F.col(x).cast("long").alias(x), *[F.col(f"_p.{c}").alias(c) for c in columns]
    )


def explode_cube(cubes: DataFrame, metric: str, *, keep: Sequence[str] = ("producer", "time")) -> DataFrame:
    """(lat[], lon[], values[][]) slices to rows; slices without the metric are left out."""
    rows = cubes.filter(F.col("metric") == metric).select(
        *keep, F.col("lon").alias("_lon"), F.posexplode("values").alias("_i", "_line"), F.col("lat").alias("_lat")
    )
    return rows.select(
        *keep, F.get("_lat", F.col("_i")).alias("lat"),
        F.explode(F.arrays_zip(F.col("_lon").alias("lon"), F.col("_line").alias("value"))).alias("_c"),
    ).select(*keep, "lat", F.col("_c.lon").alias("lon"), F.col("_c.value").alias("value"))


def _hypot(ax: Column, ay: Column) -> Column:
    return F.sqrt(ax * ax + ay * ay)


def median_spacing(lines: DataFrame, *, by: str = "entry_id", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Median distance of neighbours along and across the lines, positive ones only."""
    w = Window.partitionBy(by).orderBy("y")
    both = F.arrays_zip(F.col(lon).alias("x"), F.col(lat).alias("y"))
    prepared = lines.select(by, "y", both.alias("_c")).withColumn("_p", F.lag("_c").over(w)).withColumn(
        "_py", F.lag("y").over(w)
    )
    n = F.size("_c")
    gap = lambda a, b: _hypot(a["x"] - b["x"], a["y"] - b["y"])
    along = F.zip_with(
        F.slice("_c", 2, F.greatest(n - 1, F.lit(0))), F.slice("_c", 1, F.greatest(n - 1, F.lit(0))), gap
    )
    across = F.when(
        F.col("_py") == F.col("y") - 1, F.zip_with("_c", "_p", gap)
    ).otherwise(F.array().cast("array<double>"))
    gaps = prepared.select(by, F.explode(F.concat(along, across)).alias("_gap")).filter(
        (F.col("_gap") > 0) & (F.col("_gap") < float("inf"))
    )
    # bounded: two gaps per pixel of one swath
    med = grouped_median(gaps, [by], {"spacing": "_gap"}, bounded=True)
    return lines.select(by).distinct().join(med, by, "left").withColumn(
        "spacing", F.coalesce("spacing", F.lit(float("inf")))
    )


def _between(upper: ColumnLike, lower: ColumnLike) -> Column:
    """Edge line between two lines of centres."""
    a, b = col(upper), col(lower)
    n = F.size(a)
    inner = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda k: (F.get(a, k - 1) + F.get(b, k - 1) + F.get(a, k) + F.get(b, k)) * 0.25,
    )
    full = lambda e: F.concat(
        F.array(F.get(a, F.lit(0)) * 2.0 - F.get(e, F.lit(0))), e, F.array(F.get(a, n - 1) * 2.0 - F.get(e, n - 2))
    )
    return F.when(n > 1, let(inner, full))


def _border(centre: ColumnLike, edge: ColumnLike) -> Column:
    """Outer edge line: mirror of the inner edge at the centres."""
    c, e = col(centre), col(edge)
    n = F.size(c)
    return F.when(
        n > 1,
        F.transform(
            F.sequence(F.lit(0), n),
            lambda k: F.when(k == 0, F.get(c, F.lit(0)) * 2.0 - F.get(e, F.lit(1)))
            .when(k == n, F.get(c, n - 1) * 2.0 - F.get(e, n - 1))
            .otherwise(F.get(c, k - 1) * 2.0 - F.get(e, k)),
        ),
    )


def cell_edges(lines: DataFrame, columns: Sequence[str] = ("lat", "lon"), *, by: str = "entry_id") -> DataFrame:
    """Adds ``<c>_upper`` and ``<c>_lower`` edge lines to every swath line."""
    w = Window.partitionBy(by).orderBy("y")
    out = lines
    for c in columns:
        out = out.withColumns({f"_{c}_p": F.lag(c).over(w), f"_{c}_n": F.lead(c).over(w)})
    for c in columns:
        # null * number stays null, so an edge next to an invalid centre is null
        out = out.withColumns({f"_{c}_u": _between(f"_{c}_p", c), f"_{c}_l": _between(c, f"_{c}_n")})
        out = out.withColumns(
            {
                f"{c}_upper": F.when(F.col(f"_{c}_p").isNotNull(), F.col(f"_{c}_u")).otherwise(_border(c, f"_{c}_l")),
                f"{c}_lower": F.when(F.col(f"_{c}_n").isNotNull(), F.col(f"_{c}_l")).otherwise(_border(c, f"_{c}_u")),
            }
        ).drop(f"_{c}_p", f"_{c}_n", f"_{c}_u", f"_{c}_l")
    return out


def cell_mask(lines: DataFrame, gap_factor: float, *, by: str = "entry_id", value: str = "value") -> DataFrame:
    """One row per cell with ``masked``: invalid, missing a corner, or wider than the gap limit."""
    limit = median_spacing(lines, by=by).select(
        by, F.when((F.col("spacing") > 0) & (F.col("spacing") < float("inf")), F.col("spacing") * gap_factor).alias("_t")
    )
    edges = cell_edges(lines, by=by).join(limit, by)
    packed = F.arrays_zip(
        F.col("lat").alias("cy"), F.col("lon").alias("cx"), F.col(value).alias("v"),
        F.col("lat_upper").alias("uy"), F.col("lon_upper").alias("ux"),
        F.col("lat_lower").alias("ly"), F.col("lon_lower").alias("lx"),
        F.slice("lat_upper", 2, F.size("lat")).alias("uy2"), F.slice("lon_upper", 2, F.size("lat")).alias("ux2"),
        F.slice("lat_lower", 2, F.size("lat")).alias("ly2"), F.slice("lon_lower", 2, F.size("lat")).alias("lx2"),
    )
    cells = edges.select(by, "y", "_t", F.size("lat").alias("_n"), F.posexplode(packed).alias("x", "c")).filter(
        F.col("x") < F.col("_n")
    )
    g = lambda name: F.col(f"c.{name}")
    corners = ["uy", "ux", "ly", "lx", "uy2", "ux2", "ly2", "lx2"]
    missing = g("cy").isNull() | g("cx").isNull() | g("v").isNull()
    for name in corners:
        missing = missing | g(name).isNull()
    t = F.col("_t")
    side = lambda ax, ay, bx, by_: _hypot(g(ax) - g(bx), g(ay) - g(by_))
    wide = (
        (side("ux2", "uy2", "ux", "uy") > t)
        | (side("lx2", "ly2", "lx", "ly") > t)
        | (side("lx", "ly", "ux", "uy") > t)
        | (side("lx2", "ly2", "ux2", "uy2") > t)
        | (side("lx2", "ly2", "ux", "uy") > t * 1.5)
        | (side("lx", "ly", "ux2", "uy2") > t * 1.5)
    )
    return cells.select(
        by, "y", F.col("x").cast("long").alias("x"),
        (missing | F.coalesce(wide, F.lit(False))).alias("masked"),
    )
