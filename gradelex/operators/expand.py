"""Expanding lists by the concepts they lack: generation, review and levels as one flow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradelex.operators.review import apply_verdicts, concept_level, missing_concepts


def expansion(rows: DataFrame, generate: Callable[[DataFrame], DataFrame], judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(lang, lemma, english, pos, level) of new rows: for each concept a language lacks, the word that generate gives it, as judge leaves it.

    generate takes (id, lang, gloss, pos) and gives (id, lemma), of several words of a concept the smallest counting; judge takes (id, lang, gloss, pos,
    lemma) and gives verdicts (id, ord, verdict, new_lemma). A concept without a word or a verdict stays open. The level is the lowest that any language has the concept on."""
    lack = missing_concepts(rows).withColumn("id", F.concat_ws("\u001f", "lang", "gloss", "pos"))
    words = generate(lack.select("id", "lang", "gloss", "pos")).groupBy("id").agg(F.min("lemma").alias("lemma"))
    made = lack.join(words.where("lemma is not null and lemma <> ''"), "id")
    kept = apply_verdicts(made, judge(made))
    levels = concept_level(kept.select("gloss", "pos").distinct(), rows)
    return kept.join(levels, ["gloss", "pos"]).select("lang", "lemma", F.col("gloss").alias("english"), "pos", "level")


def in_batches(items: DataFrame, batch: str, place: str, call: Callable, schema: str) -> DataFrame:
    """What call, a function of the rows of one batch as a pandas frame, makes of all batches, which run side by side; rows keep their batch and place,
    by which they can be put in order again whatever task was done first. schema is that of call's rows and has both columns."""
    return items.groupBy(batch).applyInPandas(lambda pdf: call(pdf.sort_values(place)), schema)
