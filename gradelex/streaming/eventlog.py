"""Append-only event logs as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of the Parquet event files in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events and summed value of each kind and window of event time; rows later than `late` are dropped from open windows only."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def latest_sink(stream: DataFrame, target: str, keys: list[str], order: str, checkpoint: str):
    """Keeps the latest event of each key in the table at target, batch by batch, as folders v<batch>. A batch that is run again gives the same
    table, as it reads the version before it, which is the only other one kept."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c not in (*keys, order)]
        version = f"{target}/v{epoch}"
        before = f"{target}/v{epoch - 1}"
        old = spark.read.schema(batch.schema).parquet(before) if epoch else batch.limit(0)
        best = old.unionByName(batch).groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_x"))
        best.select(*keys, *[F.col("_x")[c].alias(c) for c in (order, *rest)]).select(*batch.columns).write.mode("overwrite").parquet(version)
        if epoch > 1:
            past = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/v{epoch - 2}")
            past.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(past, True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
