"""Joining rows back to facts about their group when one group may hold a third of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: at most so many groups are called hot, so the broadcast list of hot groups has a fixed bound
MAX_HOT = 2000


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, by: str, total: int, least: int = 50_000, sizes: DataFrame | None = None) -> DataFrame:
    """Inner join of rows with groups (facts about each key `on`, whose column `size` counts the rows of that key).

    A group of over max(least, total / MAX_HOT) rows is hot: at most MAX_HOT groups can be. Its facts are
    repeated once per salt and its rows are spread over the salts by the hash of column `by`.
    sizes: where groups is dear to compute, a frame of `on` and `size` to find hot groups in.
    Key columns must not be null. Columns of rows come first, then those of groups without the keys.
    """
    limit = max(least, -(-total // MAX_HOT))
    salts = F.ceil(F.col(size) / F.lit(limit)).cast("int")
    if total <= limit:
        return rows.join(groups.hint("merge"), on)
    hot = F.broadcast((groups if sizes is None else sizes).where(F.col(size) > limit).select(*on, salts.alias("_salts")).distinct())
    spread = rows.join(hot, on, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    copies = groups.withColumn("_salt", F.explode(F.when(F.col(size) > limit, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))))
    return spread.join(copies.hint("merge"), [*on, "_salt"]).drop("_salt")


def hot_keys(sizes: DataFrame, by: list[str], total: int, least: int) -> list[tuple]:
    """Keys of sizes (by…, na, nb: rows of the key in two frames) of which either frame has over max(least, total / MAX_HOT) rows, with the
    number of stretches their rows ask for. At most 2 * MAX_HOT keys for each name they are grouped under."""
    limit = max(least, -(-total // MAX_HOT))
    if total <= limit:
        return []
    pieces = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / F.lit(limit))).cast("int")
    sums = sizes.groupBy(*by).agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    return [tuple(r) for r in sums.where((F.col("na") > limit) | (F.col("nb") > limit)).select(*by, pieces("na"), pieces("nb")).collect()]


def split_join(a: DataFrame, b: DataFrame, on: list[tuple[str, str]], hot: list[tuple[int, int, int]], by: tuple[str, str], also: Column | None = None) -> DataFrame:
    """Inner join of two frames that may both have many rows of one key. `on` pairs the key columns of a and b.

    hot (hot_keys): xxhash64 of the key columns and into how many stretches the key's rows of a and of b are spread, by the hash of the
    columns `by`. Every stretch of a meets every stretch of b in a task of its own, so no task compares more rows than two stretches have.
    also: a further condition, tested inside the join. Only the bounded list of hot keys is broadcast.
    """
    keys = [F.col(x) == F.col(y) for x, y in on]
    if hot:
        spread = F.broadcast(a.sparkSession.createDataFrame(hot, "_key bigint, _sa int, _sb int").dropDuplicates(["_key"]))
        one, lot = F.lit(1), lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")

        def cut_up(df: DataFrame, cols: list[str], own: str, other: str, by_col: str, mine: str, theirs: str) -> DataFrame:
            known = df.withColumn("_key", F.xxhash64(*cols)).join(spread, "_key", "left")
            n, m = F.coalesce(own, one), F.coalesce(other, one)
            return known.withColumn(mine, lot(by_col, n)).withColumn(theirs, F.explode(F.sequence(F.lit(0), m - 1))).drop("_key", "_sa", "_sb")

        a = cut_up(a, [x for x, _ in on], "_sa", "_sb", by[0], "_xa", "_ya")
        b = cut_up(b, [y for _, y in on], "_sb", "_sa", by[1], "_yb", "_xb")
        keys += [F.col("_xa") == F.col("_xb"), F.col("_ya") == F.col("_yb")]
    out = a.join(b.hint("merge"), reduce(lambda x, y: x & y, keys if also is None else [*keys, also]))
    return out.drop("_xa", "_xb", "_ya", "_yb") if hot else out
