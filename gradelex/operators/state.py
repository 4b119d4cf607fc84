"""Keyed state as snapshots and append-only logs: inserts, upserts, replays, counts, progress."""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradelex.functions.responses import same_json
from gradelex.functions.rules import duration
from gradelex.session import cut


def insert_if_absent(state: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """state and the new rows whose key it lacks; of new rows with one key the smallest by the other columns."""
    rest = [c for c in state.columns if c not in keys]
    one = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_x")).select(*keys, *[F.col("_x")[c].alias(c) for c in rest])
    return state.unionByName(one.join(state.select(*keys), keys, "left_anti").select(*state.columns))


def point(state: DataFrame, **key: str) -> DataFrame:
    """Rows of one key; the equalities reach the scan."""
    for c, v in key.items():
        state = state.where(F.col(c) == v)
    return state


def delete_keys(state: DataFrame, keys: DataFrame) -> DataFrame:
    return state.join(keys.distinct(), keys.columns, "left_anti")


def replace_partition(state: DataFrame, new: DataFrame, part: list[str], key: list[str]) -> DataFrame:
    """state with the partitions (values of `part`) that occur in new replaced by new's rows, one per key."""
    touched = new.select(*part).distinct()
    kept = state.join(touched, part, "left_anti")
    rest = [c for c in state.columns if c not in (*part, *key)]
    one = new.groupBy(*part, *key).agg(F.min(F.struct(*rest)).alias("_x")).select(*part, *key, *[F.col("_x")[c].alias(c) for c in rest])
    return kept.unionByName(one.select(*state.columns))


def upsert_changed(state: DataFrame, new: DataFrame, key: str, config: str, reset: dict[str, object]) -> DataFrame:
    """Full outer merge of state and new (key, config): unknown keys enter and keys with another config start again, both with the
    reset values; all else stays."""
    n = new.groupBy(key).agg(F.max(config).alias("_c"))
    j = state.join(n, key, "full")
    fresh = F.col("_c").isNotNull() & ~F.col("_c").eqNullSafe(F.col(config))
    cols = {c: F.when(fresh, F.lit(v).cast(state.schema[c].dataType)).otherwise(F.col(c)) for c, v in reset.items()}
    return j.withColumns({**cols, config: F.when(fresh, F.col("_c")).otherwise(F.col(config))}).select(*state.columns)


def latest(log: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Replay of an append-only log: the values of the last event of each key; a map-side combined maximum."""
    x = log.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("_x"))
    return x.select(*keys, *[F.col("_x")[c].alias(c) for c in values])


def task_states(events: DataFrame) -> DataFrame:
    """(task_key, status, attempts) from events (task_key, ord, kind start/succeed/fail): the last kind decides, starts are attempts."""
    x = events.groupBy("task_key").agg(F.max(F.struct("ord", "kind")).alias("x"), F.sum(F.when(F.col("kind") == "start", 1).otherwise(0)).cast("bigint").alias("attempts"))
    name = F.when(F.col("x.kind") == "start", "running").when(F.col("x.kind") == "succeed", "succeeded").when(F.col("x.kind") == "fail", "failed").otherwise("pending")
    return x.select("task_key", name.alias("status"), "attempts")


def tail(log: DataFrame, n: int) -> DataFrame:
    """The last n rows by ord: a top-n, not a sort of the log."""
    return log.orderBy(F.desc("ord")).limit(n)


def ledger_status(ledger: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    return ledger.agg(F.count(F.lit(1)).alias("n"), zero("prompt_tokens"), zero("candidate_tokens"), zero("total_tokens"))


def status_counts(tasks: DataFrame, statuses: tuple[str, ...] = ("pending", "running", "succeeded", "failed")) -> DataFrame:
    """Tasks of each status, 0 where there are none."""
    names = tasks.sparkSession.createDataFrame([(s,) for s in statuses], "status string")
    n = tasks.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(names).join(n, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def eta(log: DataFrame, window: int = 8) -> DataFrame:
    """log (run, ord, seconds) with mean, the mean of the last `window` positive durations up to each row of its run."""
    w = Window.partitionBy("run").orderBy("ord").rowsBetween(-(window - 1), 0)
    return log.where("seconds > 0").withColumn("mean", F.avg("seconds").over(w))


def progress(log: DataFrame, totals: DataFrame, concurrency: int, window: int = 8) -> DataFrame:
    """Per run: done, total, pct, remaining, waves still to run, elapsed, and the time left as a number (null without
    samples, 0 when nothing remains) and as text. totals: run, total. The last durations of a run come from a top-`window`."""
    done = log.groupBy("run").agg(F.count(F.lit(1)).alias("done"), F.sum("seconds").alias("elapsed"))
    w = Window.partitionBy("run").orderBy(F.desc("ord"))
    mean = log.where("seconds > 0").withColumn("k", F.row_number().over(w)).where(F.col("k") <= window).groupBy("run").agg(F.avg("seconds").alias("mean"))
    j = totals.join(done, "run", "left").join(mean, "run", "left").fillna(0, ["done"])
    left = F.greatest(F.col("total") - F.col("done"), F.lit(0))
    waves = F.ceil(left / F.lit(concurrency))
    eta_s = F.when(left == 0, F.lit(0.0)).otherwise(F.col("mean") * waves)
    return j.select("run", "done", "total", F.try_divide(F.col("done") * 100.0, F.col("total")).alias("pct"), left.alias("remaining"), waves.cast("bigint").alias("waves"), "elapsed", eta_s.alias("eta_s"), duration(eta_s).alias("eta"))


def checkpointed(requests: DataFrame, ledger: DataFrame, call: Callable, schema: str, valid: Callable[[Column], Column] | None = None, repair: Callable[[Column, Column], Column] | None = None, attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(all answers, the new ones to append to the ledger). requests: key, prompt; ledger: key, answer; call maps batches of
    pending requests to (key, answer) rows with schema, in mapInPandas. Requests with one key are asked once; a null answer is a
    failure and is not kept, so it stays pending.

    valid tells from an answer whether it can be used. What the ledger holds is judged again: answers that are stale under it count as missing. A new answer
    that is not valid is asked for again, in at most `attempts` attempts, with the prompt that repair makes of the prompt and the bad answer.
    Each attempt is written once, so that no request is sent twice."""
    good = lambda c: F.coalesce(valid(c), F.lit(False)) if valid else c.isNotNull()
    asked = requests.groupBy("key").agg(F.min("prompt").alias("prompt"))
    held = ledger.select("key", "answer").where(good(F.col("answer")))
    pending = asked.join(held.select("key"), "key", "left_anti")
    if valid is None:
        new = pending.mapInPandas(call, schema).where("answer is not null").select("key", "answer")
    else:
        got = []
        for left in range(attempts, 0, -1):
            tried = cut(pending.mapInPandas(call, schema).select("key", "answer"))
            got.append(tried.where(good(F.col("answer"))))
            if left > 1:
                again = tried.where(F.col("answer").isNotNull() & ~good(F.col("answer")))
                pending = pending.join(again, "key").select("key", (repair(F.col("prompt"), F.col("answer")) if repair else F.col("prompt")).alias("prompt"))
        new = reduce(DataFrame.unionByName, got)
    return held.join(asked.select("key"), "key", "left_semi").unionByName(new), new


def adjudicated(one: DataFrame, two: DataFrame, judge: Callable, schema: str) -> DataFrame:
    """(key, answer): what two reviewers (key, answer) agree on as JSON values, and the judge's answer where they differ; judge maps batches of (key,
    answer, other)."""
    j = one.join(two.select("key", F.col("answer").alias("other")), "key", "left").withColumn("same", same_json(F.col("answer"), F.col("other")))
    return j.where("same").select("key", "answer").unionByName(j.where("not same").drop("same").mapInPandas(judge, schema).select("key", "answer"))


def runnable(tasks: DataFrame, phases: list[str], retry_failed: bool = False) -> DataFrame:
    """tasks (task_key, phase, lang, level, status) that a run would take now, with step, the place of their phase: pending ones, and failed ones if they
    are to be tried again, of the first phase in order that the list (lang, level) has not finished. Succeeded ones are never run again."""
    steps = F.array(*[F.lit(p) for p in phases])
    t = tasks.withColumn("step", F.array_position(steps, F.col("phase")).cast("int")).where("step > 0")
    wanted = F.col("status").isin("pending", *(["failed"] if retry_failed else []))
    first = t.where("status <> 'succeeded'").groupBy("lang", "level").agg(F.min("step").alias("first"))
    return t.where(wanted).join(first, ["lang", "level"]).where("step = first").drop("first")
