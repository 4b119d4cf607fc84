"""List hygiene: row issues, duplicates within and across levels, counts against targets, shared translations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.functions.rules import SPECIAL, TARGETS, digits_allowed
from gradelex.functions.text import LEVELS, level_index, strip_ws
from gradelex.operators.keep import repeats
from gradelex.operators.spread import join_groups

# rows: lang, level, ord (unique), line, lemma, english, chinese, pos


def _targets(spark) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(TARGETS.items()), "level string, target bigint"))  # five rows


def quality_key(rows: DataFrame) -> DataFrame:
    pos = strip_ws(F.coalesce(F.nullif(F.col("pos"), F.lit("")), F.lit("X")))
    return rows.withColumns({"key_lemma": F.lower(strip_ws(F.col("lemma"))), "key_pos": pos})


def _codes() -> Column:
    """The codes of a row's defects; an empty lemma hides the row's other defects."""
    w, t1, t2 = (strip_ws(F.col(c)) for c in ("lemma", "english", "chinese"))
    when = lambda cond, code: F.when(cond, F.lit(code))
    return F.when(w == "", F.array(F.lit("empty_lemma"))).otherwise(
        F.array_compact(F.array(
            when(w != F.col("lemma"), "lemma_edge_space"), when(w.contains(" "), "multi_word"), when(w.rlike("[0-9]") & ~digits_allowed(w), "digits"), when(w.rlike(SPECIAL), "special_chars"),
            when(t1 == "", "missing_t1"), when((t1 != "") & (t1 != F.col("english")), "t1_edge_space"), when(t2 == "", "missing_t2"), when((t2 != "") & (t2 != F.col("chinese")), "t2_edge_space"),
        ))
    )


def row_issues(rows: DataFrame) -> DataFrame:
    """(lang, level, ord, code, is_warning) for each defect of each row."""
    out = rows.select("lang", "level", "ord", F.explode(_codes()).alias("code"))
    return out.withColumn("is_warning", F.col("code") == "missing_t2")


def level_duplicates(rows: DataFrame) -> DataFrame:
    """Second and later rows of a (lemma, tag) within a level."""
    keyed = quality_key(rows).where("key_lemma <> ''")
    return repeats(keyed, ["lang", "level", "key_lemma", "key_pos"], "ord").select("lang", "level", "ord", "lemma", "key_pos")


def cross_level_duplicates(rows: DataFrame) -> DataFrame:
    """Rows whose (lemma, tag) already stands in a lower level; each row counts. The lowest level of a key comes from a
    map-side combined minimum over at most five levels, so the join has one row per key, salted where a key has very many rows."""
    keyed = quality_key(rows).where("key_lemma <> ''").withColumn("li", level_index(F.col("level")))
    per_level = keyed.groupBy("lang", "key_lemma", "key_pos", "li").agg(F.count(F.lit(1)).alias("n"))
    first = per_level.groupBy("lang", "key_lemma", "key_pos").agg(F.min("li").alias("first_li"), F.count(F.lit(1)).alias("levels"), F.sum("n").alias("_n")).where("levels > 1").drop("levels")
    met = join_groups(keyed, first, ["lang", "key_lemma", "key_pos"], "_n", "ord", rows.count())
    return met.where("li > first_li").select("lang", "level", "ord", "lemma", "key_pos", F.element_at(F.array(*[F.lit(x) for x in LEVELS]), F.col("first_li")).alias("first_level"))


def level_counts(rows: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Rows of each list level against its target. tolerance 0 demands the exact number."""
    n = rows.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("n_rows")).join(_targets(rows.sparkSession), "level")
    delta = F.col("n_rows") - F.col("target")
    return n.select("lang", "level", "n_rows", "target", delta.alias("delta"), F.when(F.abs(delta) <= F.col("target") * tolerance, "OK").otherwise("OFF").alias("status"))


def shared_translations(rows: DataFrame, names: Column | None = None) -> DataFrame:
    """Translations, lower case, that several lemmas of a level share, with the number of those lemmas."""
    t = F.array_distinct(F.array(F.lower(strip_ws(F.col("english"))), F.lower(strip_ws(F.col("chinese")))))
    pairs = rows.select("lang", "level", strip_ws(F.col("lemma")).alias("lemma"), F.explode(F.filter(t, lambda x: x != "")).alias("translation")).where("lemma <> ''")
    return pairs.groupBy("lang", "level", "translation").agg(F.count_distinct("lemma").alias("n_lemmas")).where("n_lemmas > 1")


def issue_totals(rows: DataFrame) -> DataFrame:
    """Issues of each language from all checks, and its exit code: 1 if there is any. One pass: rows and their defects are counted per key and
    level, from which duplicates within and across levels follow without naming the rows."""
    defects = F.size(F.filter(_codes(), lambda c: c != "missing_t2"))
    keyed = quality_key(rows).withColumns({"li": level_index(F.col("level")), "d": defects})
    per_level = keyed.groupBy("lang", "key_lemma", "key_pos", "level", "li").agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("d"))
    levels = F.collect_list(F.struct("li", "n"))  # at most one entry per level
    keys = per_level.groupBy("lang", "key_lemma", "key_pos").agg(F.sum("d").alias("d"), F.sum(F.col("n") - 1).alias("again"), F.min("li").alias("first"), levels.alias("levels"))
    higher = F.aggregate(F.filter("levels", lambda x: x["li"] > F.col("first")), F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    issues = F.col("d") + F.when(F.col("key_lemma") != "", F.col("again") + higher).otherwise(0)
    total = keys.groupBy("lang").agg(F.sum(issues).cast("bigint").alias("issues"))
    return total.select("lang", "issues", F.when(F.col("issues") > 0, 1).otherwise(0).alias("exit_code"))
