"""What changed between full snapshots: one window per key over snapshot indexes and lagged hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradelex.functions.text import key64


def snapshot_changes(rows: DataFrame, key: str, snapshot: str, delivered: str, values: list[str]) -> DataFrame:
    """(snapshot, key, change) for keys added, removed or changed against the snapshot before.

    Within a snapshot the latest delivered row of a key counts; rows delivered at the same moment are told apart
    by their values' hash, so the choice does not depend on the order of rows, and a null moment is the earliest.
    Snapshots that have rows are indexed by their numbers' order, which may have gaps; a key is compared with the index before, and
    the first snapshot has no changes. The numbers are one short array, one value per snapshot delivered.
    Values compare exactly, null only equals null. A null key is a key of its own; rows of a null snapshot are ignored.

    One hash aggregate with a map-side combine leaves at most a row per key and snapshot, however often a
    key was delivered; the window then holds as many rows per key as there are snapshots.
    """
    cols = [F.col(c) for c in values]
    state = F.struct(F.col(delivered).isNotNull().alias("d"), F.col(delivered).alias("t"), key64(*cols, seed=1).alias("a"), key64(*cols, seed=2).alias("b"))
    slim = rows.where(F.col(snapshot).isNotNull()).select(F.col(snapshot).cast("int").alias("s"), F.col(key).alias("k"), state.alias("x"))
    kept = slim.groupBy("k", "s").agg(F.max("x").alias("x")).select("k", "s", F.struct("x.a", "x.b").alias("h"))
    every = kept.agg(F.sort_array(F.collect_set("s")).alias("every"))  # one row
    w = Window.partitionBy("k").orderBy("s")
    seen = kept.select("k", "s", "h", F.lag("s").over(w).alias("ps"), F.lag("h").over(w).alias("ph"), F.lead("s").over(w).alias("ns")).crossJoin(F.broadcast(every))
    seen = seen.withColumn("i", F.array_position("every", F.col("s")).cast("int"))
    before, after = F.try_element_at("every", F.nullif(F.col("i") - 1, F.lit(0))), F.try_element_at("every", F.col("i") + 1)
    here = F.when(before.isNotNull() & ~F.col("ps").eqNullSafe(before), "added").when((F.col("ps") == before) & (F.col("ph") != F.col("h")), "changed")
    gone = F.when(after.isNotNull() & ~F.col("ns").eqNullSafe(after), "removed")
    found = F.array(F.struct(F.col("s").alias("s"), here.alias("change")), F.struct(after.alias("s"), gone.alias("change")))
    out = seen.select("k", F.explode(F.filter(found, lambda x: x["change"].isNotNull())).alias("x"))
    return out.select(F.col("x.s").alias(snapshot), F.col("k").alias(key), F.col("x.change").alias("change"))
