"""Completing lists to their target: candidates for missing concepts, then new words, pass by pass and for all lists at once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradelex.functions.rules import FORBIDDEN_UPOS
from gradelex.functions.text import nfc, word_key
from gradelex.operators.gates import candidate_problems
from gradelex.session import cut

LIST, KEY = ["lang", "level"], ["lang", "level", "key", "pos"]
FIELDS = ["lang", "level", "place", "lemma", "english", "chinese", "pos", "action"]
Gate = Callable[[DataFrame], DataFrame]


def acceptable(answers: DataFrame, issues: Gate) -> DataFrame:
    """Answers to concepts (FIELDS) that may enter a list: not dropped, of a tag that lists hold, a composed lemma without blanks, with a pivot gloss
    and no gate issue. issues adds the array `issues`."""
    w = F.col("lemma")
    fine = (F.col("action") != "drop") & ~F.col("pos").isin(*FORBIDDEN_UPOS) & w.isNotNull() & (w != "") & ~w.rlike(r"(?U)\s") & (F.coalesce("chinese", F.lit("")) != "")
    return issues(answers.where(fine).withColumn("_nfc", nfc("lemma")).where("_nfc = lemma").drop("_nfc")).where(F.size("issues") == 0).drop("issues")


def room(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(lang, level, room): rows each list lacks to its target (level, target); negative where it has too many."""
    return rows.groupBy(*LIST).agg(F.count(F.lit(1)).alias("n")).join(targets, "level").select(*LIST, (F.col("target") - F.col("n")).alias("room"))


def take(candidates: DataFrame, used: DataFrame, space: DataFrame) -> DataFrame:
    """The candidates (FIELDS) a list has room for, in the order of place: those whose key (lang, level, key, pos) is not used, the first of
    each key. A list takes no more than its room, and the window's limit is applied before the shuffle."""
    most = space.agg(F.coalesce(F.max("room"), F.lit(0))).first()[0]
    first = _first(candidates.withColumn("key", word_key("lemma")).join(used.select(*KEY), KEY, "left_anti"))
    nth = F.row_number().over(Window.partitionBy(*LIST).orderBy("place", "lemma"))
    ranked = first.withColumn("_k", nth).where(F.col("_k") <= most)
    return ranked.join(space, LIST).where(F.col("_k") <= F.col("room")).drop("_k", "room")


def _first(rows: DataFrame) -> DataFrame:
    rest = [c for c in FIELDS if c not in KEY]
    best = rows.groupBy(*KEY).agg(F.min(F.struct(*rest)).alias("x"))
    return best.select(*KEY, *[F.col("x")[c].alias(c) for c in rest])


def completed(
    rows: DataFrame, concepts: DataFrame, taken: DataFrame, targets: DataFrame, answer: Gate, issues: Gate,
    skipped: DataFrame | None = None, novel: Callable[[DataFrame], DataFrame] | None = None, rounds: int = 3,
) -> DataFrame:
    """rows (FIELDS, place in list order) of every list under its target, and what completes it, with source: kept, concept, retry or novel.

    Kept are the rows not dropped, the first of each key that is not taken (lang, level, key, pos) by another level. concepts (lang, level, place, english,
    chinese, pos) that no kept row represents, nor are skipped (lang, key, pos), come first; English ones are their own answers, all others go through
    answer, which adds lemma, chinese and action. If they bring a list nothing, new words are asked for next, else the represented concepts are
    tried again, then new words: novel answers slots (lang, level, slot, round) in at most `rounds` rounds. Lists at or over their target come out as they are kept.
    Each pass takes one table written before it, so no answer is asked for twice."""
    kept = _first(rows.where("action <> 'drop'").withColumn("key", word_key("lemma")).join(taken.select(*KEY), KEY, "left_anti")).withColumn("source", F.lit("kept"))
    final = cut(kept)
    shown = final.select("lang", "level", word_key("english").alias("key"), "pos")
    if skipped is not None:
        shown = shown.unionByName(concepts.select(*LIST).distinct().join(skipped, "lang").select("lang", "level", "key", "pos"))
    known = concepts.withColumn("key", word_key("english")).join(shown.distinct().withColumn("hit", F.lit(True)), KEY, "left").drop("key")

    def ask(c: DataFrame) -> DataFrame:
        own = c.where("lang = 'en' and chinese is not null").withColumns({"lemma": F.col("english"), "action": F.lit("keep")})
        return acceptable(own.select(*FIELDS).unionByName(answer(c.where("lang <> 'en'")).select(*FIELDS)), issues)

    def add(candidates: DataFrame, source: str, lists: DataFrame | None = None) -> int:
        nonlocal final
        space = room(final, targets).where("room > 0")
        if lists is not None:
            space = space.join(lists, LIST, "left_semi")
        used = final.select(*KEY).unionByName(taken.select(*KEY))
        new = cut(take(candidates, used, space).withColumn("source", F.lit(source)).select(*final.columns))
        final = final.unionByName(new)
        return new.count()

    add(ask(known.where("hit is null").drop("hit")), "concept")
    with_concepts = final.where("source = 'concept'").select(*LIST).distinct()
    add(ask(known.where("hit").drop("hit")), "retry", with_concepts)
    for i in range(rounds if novel else 0):
        slots = room(final, targets).where("room > 0").select(*LIST, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("room"))).alias("slot"), F.lit(i).alias("round"))
        found = candidate_problems(novel(slots).select(*FIELDS).withColumn("initial", F.lit(None).cast("string"))).where("problem is null").drop("problem", "initial")
        if not add(issues(found).where(F.size("issues") == 0).drop("issues"), "novel"):
            break
    return final.drop("key")


def unclean(rows: DataFrame, issues: Gate, protected: DataFrame | None = None) -> DataFrame:
    """(lang, level, place, code) of gate issues that a completed list still has, but for rows whose key (lang, key, pos) is protected. Empty for
    a clean list."""
    found = issues(rows).where(F.size("issues") > 0)
    if protected is not None:
        found = found.withColumn("key", word_key("lemma")).join(protected.select("lang", "key", "pos"), ["lang", "key", "pos"], "left_anti")
    return found.select(*LIST, "place", F.explode("issues").alias("code"))


def repaired(rows: DataFrame, issues: Gate, repair: Gate, passes: int = 2) -> tuple[DataFrame, DataFrame]:
    """(rows that pass the gates, rows that still do not) after at most `passes` rounds in which repair, a function of the failing rows with their
    issues, gives other values to any columns but place. Rows that pass at once are not touched; a repaired row is judged again. Each round is written
    once, so that no row is repaired twice in it."""
    gated = cut(issues(rows))
    good, bad = [gated.where(F.size("issues") == 0).drop("issues")], gated.where(F.size("issues") > 0)
    for _ in range(passes):
        again = cut(issues(repair(bad).drop("issues")))
        good.append(again.where(F.size("issues") == 0).drop("issues"))
        bad = again.where(F.size("issues") > 0)
    return reduce(DataFrame.unionByName, [g.select(*rows.columns) for g in good]), bad.select(*rows.columns, "issues")
