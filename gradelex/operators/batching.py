"""Order-preserving batches: greedy packing under a cost cap, fixed batches, exclusion prefixes, halving."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradelex.operators.keep import numbered, running_sum
from gradelex.session import cut


def _next_starts(costs: np.ndarray, own: int, cap: int, most: int) -> np.ndarray:
    """For a batch that starts at each of the first `own` rows, where the next one starts, among all rows that costs has."""
    upto = np.concatenate([[0], np.cumsum(costs)])
    reach = np.searchsorted(upto, upto[:own] + cap, side="right") - 1
    return np.minimum(reach, np.minimum(np.arange(own) + most, len(costs)))


def greedy_batches(rows: DataFrame, group: list[str], order: str, cost: str, cap: int, most: int, stretch: int = 50_000) -> DataFrame:
    """rows with batch, numbered from 0 in each group: rows in order fill a batch until its cost would pass cap or it has `most`
    rows. A row that alone costs more than the cap is an error. Groups and costs must not be null.

    Where a batch starts depends on all before it, yet a group is cut into stretches that tasks handle side by side: as a batch has at most `most`
    rows, the first batch that starts in a stretch starts at one of its first most + 1 places. For each of these a stretch tells where the
    first batch of the next one starts and how many it has. Those short tables are followed from stretch to stretch, one row each, and
    then every stretch numbers its rows."""
    stretch, names, depth = max(stretch, most), list(rows.columns), len(group)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    keys = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in group)
    guarded = F.when(F.col(cost) > cap, F.raise_error(F.concat(F.lit("a row costs "), F.col(cost).cast("string"), F.lit(f", more than {cap}")))).otherwise(F.col(cost))
    placed = numbered(rows.withColumn(cost, guarded), group, [order], _part(order), "_i")
    placed = cut(placed.withColumns({"_i": F.col("_i") - 1, "_s": F.floor((F.col("_i") - 1) / stretch)}))

    def tell(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        own = int((~pdf["_more"]).sum())
        jump = _next_starts(pdf[cost].to_numpy(np.int64), own, cap, most)
        at, n = np.arange(most + 1), np.zeros(most + 1, np.int64)
        while (on := np.flatnonzero(at < own)).size:
            at[on] = jump[at[on]]
            n[on] += 1
        return pd.DataFrame([[*key, (at - own).tolist(), n.tolist()]])

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        at, n, out = 0, 0, []
        for row in pdf.sort_values("_s").itertuples(index=False):
            values = list(row)
            out.append([*values[: depth + 1], at, n])
            at, n = int(values[-2][at]), n + int(values[-1][at])
        return pd.DataFrame(out)

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        jump = _next_starts(pdf[cost].to_numpy(np.int64), len(pdf), cap, most)
        at, starts = int(pdf["_at"].iloc[0]), np.zeros(len(pdf), np.int64)
        while at < len(pdf):
            starts[at] = 1
            at = int(jump[at])
        batch = int(pdf["_n"].iloc[0]) - 1 + np.cumsum(starts)
        return pdf[names].assign(batch=batch)

    # a stretch sees the first rows of the next one too, into which its last batch may run
    own = placed.select(*group, "_i", "_s", cost, F.lit(False).alias("_more"))
    ahead = placed.where((F.col("_s") > 0) & (F.col("_i") - F.col("_s") * stretch < most)).select(*group, "_i", (F.col("_s") - 1).alias("_s"), cost, F.lit(True).alias("_more"))
    told = own.unionByName(ahead).groupBy(*group, "_s").applyInPandas(tell, f"{keys}, _s bigint, _next array<bigint>, _count array<bigint>")
    entries = told.groupBy(*group).applyInPandas(follow, f"{keys}, _s bigint, _at bigint, _n bigint")
    return placed.join(entries, [*group, "_s"]).groupBy(*group, "_s").applyInPandas(number, fields + ", batch bigint")


def _part(order: str) -> Column:
    """Stretches of the order column, a number, to count in."""
    return F.floor(F.col(order) / 4096)


def fixed_batches(rows: DataFrame, group: list[str], order: str, size: int) -> DataFrame:
    """rows with batch, numbered from 0: each `size` rows of a group in order."""
    return numbered(rows, group, [order], _part(order), "batch").withColumn("batch", F.floor((F.col("batch") - 1) / size).cast("bigint"))


def exclusion_prefix(rows: DataFrame, group: list[str], order: str, cost: str, cap: int) -> DataFrame:
    """The longest beginning of each group whose summed cost stays within cap; costs are not negative."""
    return running_sum(rows, group, [order], _part(order), cost, "running").where(F.col("running") <= cap)


def halved(rows: DataFrame, batch: list[str], order: str, cost: str, cap: int) -> DataFrame:
    """rows with part, numbered from 0 in each batch: a batch over the cap is halved again and again until each part fits. Of an odd number of
    rows the second half has one more. A single row over the cap is an error.

    A batch is moved once and then cut by windows over its own rows, in as many rounds as the largest batch can need, whose size is counted first."""
    most = rows.groupBy(*batch).count().agg(F.max("count")).first()[0] or 1
    own = rows.repartition(*batch).withColumn("part", F.lit("").cast("string"))
    for _ in range((most - 1).bit_length()):
        w = Window.partitionBy(*batch, "part")
        n, total, place = F.count(F.lit(1)).over(w), F.sum(cost).over(w), F.row_number().over(w.orderBy(order))
        own = own.withColumn("part", F.concat("part", F.when((total <= cap) | (n < 2), "").when(place > F.floor(n / 2), "1").otherwise("0")))
    checked = F.when(F.col(cost) > cap, F.raise_error(F.concat(F.lit(f"a row costs more than {cap}: "), F.col(order).cast("string")))).otherwise(F.col("part"))
    return own.withColumn("part", (F.dense_rank().over(Window.partitionBy(*batch).orderBy(checked)) - 1).cast("bigint"))
