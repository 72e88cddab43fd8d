"""Rules that a table has to keep, checked when it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def refuse(df: DataFrame, problems: DataFrame) -> DataFrame:
    """The rows of ``df``; reading them fails with the text of the first of ``problems`` (problem), if there is one.

    Nothing runs while the query is planned.
    """
    stop = F.raise_error(F.col("problem")).cast("boolean")
    none = problems.filter(F.when(F.col("problem").isNotNull(), stop).otherwise(F.lit(False)))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.union(none.select(*blank))


def refuse_empty(df: DataFrame, text: str) -> DataFrame:
    """Fails when it is read and has no rows."""
    count = df.agg(F.count(F.lit(1)).alias("n"))
    return refuse(df, count.select(F.when(F.col("n") == 0, F.lit(text)).alias("problem")))
