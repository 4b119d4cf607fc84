"""Histograms, readiness and blocking reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradelex.functions.responses import usage


def histogram(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def usage_totals(attempts: DataFrame, by: str, body: str) -> DataFrame:
    """Token counts of each key, summed over its attempts."""
    u = attempts.select(by, usage(F.col(body)).alias("u"))
    return u.groupBy(by).agg(*[F.sum(f"u.{k}").alias(k) for k in ("prompt", "candidate", "total")])


def readiness(rows: DataFrame, issues: DataFrame, required: DataFrame, ignored: tuple[str, ...] = (), shown: int = 20) -> DataFrame:
    """(lang, level, n_rows, required, n_issues, ready): a list is ready when it has the required rows and no issue that
    blocks. issues: lang, level, code. At most `shown` issues are counted."""
    n = rows.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("n_rows"))
    bad = issues.where(~F.col("code").isin(*ignored)).groupBy("lang", "level").agg(F.count(F.lit(1)).alias("k"))
    j = n.join(required, "level").join(bad, ["lang", "level"], "left")
    k = F.least(F.coalesce("k", F.lit(0)), F.lit(shown)).cast("bigint")
    return j.select("lang", "level", "n_rows", "required", k.alias("n_issues"), ((F.col("n_rows") >= F.col("required")) & (k == 0)).alias("ready"))


def blocking_issues(issues: DataFrame, ignored: tuple[str, ...] = (), shown: int = 20) -> DataFrame:
    """(lang, level, ord, code, place): the first `shown` issues of each list that keep it from being ready, by ord and code. The window's limit is
    applied before the shuffle."""
    w = Window.partitionBy("lang", "level").orderBy("ord", "code")
    own = issues.where(~F.col("code").isin(*ignored)).withColumn("place", F.row_number().over(w))
    return own.where(F.col("place") <= shown).select("lang", "level", "ord", "code", "place")


def blocked_tasks(tasks: DataFrame, before: str, after: str) -> DataFrame:
    """task_key of tasks of phase `after` whose sibling of phase `before` (same lang and level) exists and has not succeeded."""
    sib = tasks.where(F.col("phase") == before).select("lang", "level", F.col("status").alias("s"))
    return tasks.where(F.col("phase") == after).join(sib, ["lang", "level"]).where("s <> 'succeeded'").select("task_key")


def first_of(parts: dict[str, DataFrame], order: list[str], n: int) -> DataFrame:
    """(criterion, order columns): the first n rows of each part, a top-n of its own each."""
    return reduce(DataFrame.unionByName, [df.select(*order).orderBy(*order).limit(n).select(F.lit(name).alias("criterion"), *order) for name, df in parts.items()])


def tasks_by_status(tasks: DataFrame, status: str) -> DataFrame:
    """Tasks of one status with place, the latest updated first. The rows of a status are ranged over tasks by the sort itself."""
    own = tasks.where(F.col("status") == status)
    return own.orderBy(F.desc("updated_at"), "task_key")


def succeeded_tasks(tasks: DataFrame, phase: str, langs: list[str] | None = None) -> DataFrame:
    """(lang, level, output) of the succeeded tasks of a phase, of the chosen languages if any, in the order of language and level. Both
    conditions reach the scan. Without an output the task's is <lang>/<level>.proposed.csv."""
    own = tasks.where((F.col("phase") == phase) & (F.col("status") == "succeeded"))
    own = own.where(F.col("lang").isin(*langs)) if langs is not None else own
    named = F.coalesce(F.nullif(F.col("output"), F.lit("")), F.concat("lang", F.lit("/"), "level", F.lit(".proposed.csv")))
    return own.select("lang", "level", named.alias("output")).orderBy("lang", "level")


def log_line(events: DataFrame) -> DataFrame:
    """(ord, line): each event (ord, at, level, name, fields map) as one line of text: moment, level, name, then its fields as key=value, sorted."""
    pairs = F.transform(F.array_sort(F.map_entries("fields")), lambda x: F.concat_ws("=", x["key"], F.coalesce(x["value"], F.lit(""))))
    return events.select("ord", F.concat_ws(" ", F.date_format("at", "yyyy-MM-dd HH:mm:ss"), F.rpad(F.upper("level"), 5, " "), "name", F.array_join(pairs, " ")).alias("line"))
