"""Change classes, sample sizes, stratified allocation, and spreading of targets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradelex.functions.text import casefold, strip_ws
from gradelex.operators.keep import numbered

STRATA = ("edited", "pos_or_key_changed", "new_or_renamed", "unchanged")


def classify_changes(proposed: DataFrame, committed: DataFrame) -> DataFrame:
    """proposed rows with change: unchanged or edited where the committed list (list_key) has the lemma and tag, as both glosses are the same or
    not; pos_or_key_changed where it has the lemma only; else new_or_renamed. A list without committed rows counts as unchanged. The first
    committed row of each key counts. Keys are trimmed and case folded, so another case of the lemma or tag is no change."""
    key = lambda df: df.withColumns({"kl": casefold(strip_ws(F.col("lemma"))), "kp": casefold(strip_ws(F.col("pos"))), "g1": strip_ws(F.col("english")), "g2": strip_ws(F.col("chinese"))})
    c = key(committed).select("list_key", "kl", "kp", "ord", "g1", "g2")
    full = c.groupBy("list_key", "kl", "kp").agg(F.min(F.struct("ord", "g1", "g2")).alias("f"))
    lemma = full.groupBy("list_key", "kl").agg(F.lit(True).alias("l"))
    lists = full.groupBy("list_key").agg(F.lit(True).alias("any"))
    j = key(proposed).join(full, ["list_key", "kl", "kp"], "left").join(lemma, ["list_key", "kl"], "left").join(lists, "list_key", "left")
    same = (F.col("g1") == F.col("f.g1")) & (F.col("g2") == F.col("f.g2"))
    change = F.when(F.col("any").isNull() | same, "unchanged").when(F.col("f").isNotNull(), "edited").when(F.col("l"), "pos_or_key_changed").otherwise("new_or_renamed")
    return j.withColumn("change", change).drop("kl", "kp", "g1", "g2", "f", "l", "any")


def sample_size(n: Column, margin: float = 0.20, z: float = 1.96, p: float = 0.5) -> Column:
    """Rows to sample of a population of n, with finite-population correction, between 1 and n; 0 for none."""
    n0 = z * z * p * (1 - p) / margin**2
    size = F.ceil(F.lit(n0) / (1 + (F.lit(n0) - 1) / n)).cast("bigint")
    return F.when(n <= 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.least(n, size))).cast("bigint")


def allocate(sizes: Column, total: Column) -> Column:
    """Shares of a sample of `total` among strata, an array beside the array of their sizes. In order, each stratum that has rows takes its
    proportional share, rounded half to even, at least one row, and leaves one for each later stratum that has rows; the last takes the rest.
    What is left then goes to the first strata with rows to spare."""
    zero = F.lit(0).cast("bigint")
    n = F.aggregate(sizes, zero, lambda a, x: a + x)
    total = F.least(total, n)
    # of each stratum its size and how many later ones have rows
    later = F.transform(sizes, lambda x, i: F.struct(x.alias("s"), F.size(F.filter(sizes, lambda y, j: (j > i) & (y > 0))).cast("bigint").alias("later")))

    def share(left: Column, x: Column) -> Column:
        part = F.greatest(F.lit(1).cast("bigint"), F.bround(total * x["s"] / n).cast("bigint"))
        own = F.when(x["later"] == 0, F.least(x["s"], left)).otherwise(F.greatest(zero, F.least(x["s"], part, left - x["later"])))
        return F.when((x["s"] > 0) & (left > 0), own).otherwise(zero)

    def step(amount: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
        return lambda acc, x: F.struct((acc["left"] - amount(acc["left"], x)).alias("left"), F.concat(acc["take"], F.array(amount(acc["left"], x))).alias("take"))

    start = lambda left: F.struct(left.alias("left"), F.expr("cast(array() as array<bigint>)").alias("take"))
    first = F.aggregate(later, start(total), step(share))
    over = F.zip_with(sizes, first["take"], lambda s, t: F.struct((s - t).alias("s")))
    more = F.aggregate(over, start(first["left"]), step(lambda left, x: F.least(x["s"], left)))["take"]
    return F.zip_with(first["take"], more, lambda a, b: a + b)


def sample_quotas(changed: DataFrame, by: list[str]) -> DataFrame:
    """(by…, change, quota): rows to sample of each stratum of each group, from its counts alone."""
    counts = changed.groupBy(*by).pivot("change", list(STRATA)).count().fillna(0, list(STRATA))
    sized = counts.select(*by, F.array(*STRATA).alias("sizes")).withColumn("total", sample_size(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)))
    shares = F.zip_with(F.array(*[F.lit(s) for s in STRATA]), allocate(F.col("sizes"), F.col("total")), lambda s, q: F.struct(s.alias("change"), q.alias("quota")))
    return sized.select(*by, F.inline(shares)).where("quota > 0")


def stratified_sample(changed: DataFrame, by: list[str], seed: int = 7) -> DataFrame:
    """A sample of each group `by` of rows with change (and ord): sample_size rows, allocated over the strata, those with the smallest
    seeded hash. Groups and strata are counted first; the largest quota then bounds a windowed top-n, whose limit Spark pushes below the shuffle."""
    quota = sample_quotas(changed, by)
    most = quota.agg(F.coalesce(F.max("quota"), F.lit(0))).first()[0]
    w = Window.partitionBy(*by, "change").orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col("ord"))), "ord")
    ranked = changed.withColumn("sample_index", F.row_number().over(w)).where(F.col("sample_index") <= most)
    return ranked.join(quota, [*by, "change"]).where("sample_index <= quota").drop("quota")


def defect_rates(verdicts: DataFrame, by: list[str]) -> DataFrame:
    """n, kept, fixed, dropped and the defect rate of each group of verdicts."""
    n = lambda v: F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)).cast("bigint")
    out = verdicts.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), n("keep").alias("kept"), n("fix").alias("fixed"), n("drop").alias("dropped"))
    return out.withColumn("defect_rate", (F.col("fixed") + F.col("dropped")) / F.col("n"))


def spread_targets(rows: DataFrame, buckets: int, content: tuple[str, ...] = ("NOUN", "VERB", "ADJ", "ADV")) -> DataFrame:
    """rows of each list with bucket, 1 to `buckets`: content words first, then by line; bucket sizes differ by at most one, the
    larger ones first. A row's bucket follows from its place and the size of its list, so no list is sorted by one task."""
    later = (~F.col("pos").isin(*content)).cast("bigint")
    part = later * 2**40 + F.coalesce(F.floor(F.col("line") / 500), F.lit(-1))
    n = rows.groupBy("list_id").agg(F.count(F.lit(1)).alias("_n"))
    p = numbered(rows.withColumn("_later", later), ["list_id"], ["_later", "line", "ord"], part, "_place").join(n, "list_id")
    size, larger = F.floor(F.col("_n") / buckets), F.col("_n") % buckets
    edge = larger * (size + 1)
    nth = F.when(F.col("_place") <= edge, F.floor((F.col("_place") - 1) / (size + 1))).otherwise(larger + F.floor((F.col("_place") - 1 - edge) / F.greatest(size, F.lit(1))))
    return p.withColumn("bucket", (nth + 1).cast("int")).drop("_later", "_place", "_n")


def task_grid(phases: list[str], langs: list[str], levels: list[str], spark) -> DataFrame:
    """Every task phase:lang:level once; the three lists must not repeat values."""
    for name, values in (("phases", phases), ("langs", langs), ("levels", levels)):
        if len(set(values)) != len(values):
            raise ValueError(f"{name} repeat a value")
    one = spark.range(1)
    grid = one.select(F.explode(F.array(*map(F.lit, phases))).alias("phase")).select("phase", F.explode(F.array(*map(F.lit, langs))).alias("lang")).select("phase", "lang", F.explode(F.array(*map(F.lit, levels))).alias("level"))
    return grid.withColumn("task_key", F.concat_ws(":", "phase", "lang", "level"))
