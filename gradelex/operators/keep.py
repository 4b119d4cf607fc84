"""Keep-first and latest-row operators that no hot key can skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest `order` of each key, null keys being equal. `order` must be unique and not null.

    The smallest order is found with a map-side combine; rows then meet it on the order itself, which is unique, so
    a key that holds a third of all rows spreads over the cluster like any other."""
    first = df.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_semi")


def repeats(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The other rows: all but the first of each key."""
    first = df.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_anti")


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by the order columns; equal rows count once."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_x"))
    return best.select(*keys, *[F.col("_x")[c].alias(c) for c in (*order, *rest)]).select(*df.columns)


def _before(df: DataFrame, keys: list[str], what: Column) -> DataFrame:
    """For each key and bucket _b what the smaller buckets of the key add up to, as _o. A window over one row per bucket."""
    sizes = df.groupBy(*keys, "_b").agg(what.alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_o", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")


def numbered(df: DataFrame, keys: list[str], order: list, bucket: Column, name: str) -> DataFrame:
    """df with `name`, the 1-based place of each row in its key by the order columns; rows equal in them have arbitrary different
    places. Keys and bucket must not be null, and the bucket must not fall as the order rises.

    Places are counted per (key, bucket) and shifted by the number of rows in smaller buckets, so a key that holds a third of all
    rows is numbered by as many tasks as it has buckets."""
    p = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    return p.join(_before(p, keys, F.count(F.lit(1))), [*keys, "_b"]).withColumn(name, F.row_number().over(w) + F.col("_o")).drop("_b", "_o")


def running_sum(df: DataFrame, keys: list[str], order: list, bucket: Column, value: str, name: str) -> DataFrame:
    """df with `name`, the sum of the value over the rows of the key up to this one, found like numbered()."""
    p = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return p.join(_before(p, keys, F.sum(value)), [*keys, "_b"]).withColumn(name, F.sum(value).over(w) + F.col("_o")).drop("_b", "_o")


def ranked(df: DataFrame, keys: list[str], text: str, name: str, prefix: int = 2) -> DataFrame:
    """df numbered by a text column; the buckets are the texts' first letters."""
    return numbered(df, keys, [text], F.substring(F.coalesce(text, F.lit("")), 1, prefix), name)
