"""Concept alignment and delivery rows, as equi-joins instead of an equivalence-class search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradelex.functions.rules import ascii_gloss, concept_key, norm_gloss, norm_pivot
from gradelex.functions.text import LEVELS, level_index
from gradelex.operators.keep import ranked
from gradelex.operators.spread import join_groups
from gradelex.session import cut

# records: lang, level, ord (unique), lemma, english, chinese, pos


def _named(records: DataFrame) -> DataFrame:
    """records with cid. Only rows that lack a gloss and have a pivot look for an anchor; all others know their concept by themselves."""
    k = records.withColumns({"ek": norm_gloss(F.col("english")), "ck": norm_pivot(F.col("chinese"))})
    seeks = (F.col("ek") == "") & (F.col("ck") != "")
    concept = lambda name: F.concat_ws("\u001f", F.lit("e"), name, F.col("pos"))
    alone = F.concat(F.lit("s:"), F.col("ord").cast("string"))
    anchor = k.where("ek <> '' and ck <> ''").groupBy("ck", "pos").agg(F.min(F.struct("ord", "ek")).alias("a")).select("ck", "pos", F.col("a.ek").alias("anchor"))
    own = k.where(~seeks).withColumn("cid", F.when(F.col("ek") != "", concept(F.col("ek"))).otherwise(alone))
    led = k.where(seeks).join(anchor, ["ck", "pos"], "left").withColumn("cid", F.when(F.col("anchor").isNotNull(), concept(F.col("anchor"))).otherwise(alone))
    return own.select(*records.columns, "cid").unionByName(led.select(*records.columns, "cid"))


def align_concepts(records: DataFrame) -> DataFrame:
    """records with cid, a key of their concept, and concept_ord, the smallest ord of it.

    Rows with a gloss belong together when the normalised gloss and tag agree. A row without one joins the concept of the first
    glossed row with its pivot gloss and tag; without such a row it stands alone, and no join moves it. A concept of very many rows
    is spread by salts."""
    named = _named(records)
    single = F.col("cid").startswith("s:")
    firsts = named.where(~single).groupBy("cid").agg(F.min("ord").alias("concept_ord"), F.count(F.lit(1)).alias("_n"))
    many = join_groups(named.where(~single), firsts, ["cid"], "_n", "ord", records.count()).drop("_n")
    return many.select(*records.columns, "cid", "concept_ord").unionByName(named.where(single).withColumn("concept_ord", F.col("ord")))


def _best_gloss(per: DataFrame) -> DataFrame:
    """(cid, gloss, concept_ord) from (cid, english, n, o): how often a gloss stands in a concept and where first."""
    good = (F.col("english") != "") & ascii_gloss(F.col("english"))
    best = F.max(F.when(good, F.struct(F.col("english").contains(" ").alias("multi"), F.col("n"), (-F.col("o")).alias("o"), F.col("english"))))
    return per.groupBy("cid").agg(best.alias("b"), F.min("o").alias("concept_ord")).select("cid", F.coalesce("b.english", F.lit("")).alias("gloss"), "concept_ord")


def canonical_glosses(aligned: DataFrame) -> DataFrame:
    """(cid, gloss): of the ASCII glosses those of several words if there are any, of these the most frequent, then the first seen;
    blank where a concept has none."""
    return _best_gloss(aligned.groupBy("cid", "english").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("o"))).select("cid", "gloss")


def delivery_rows(records: DataFrame) -> DataFrame:
    """One row per (lang, lemma, normalised gloss): the lowest level, then the first emitted; ranked by lemma within (lang, gloss, pos).

    Rows are counted once per (concept, language, lemma, tag, gloss); that table, which has no more columns than these and is written
    once, gives both the canonical glosses and the lemmas of each concept. A concept of very many lemmas is spread by salts."""
    counted = _named(records).groupBy("cid", "lang", "lemma", "pos", "english").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("o"), F.min(level_index(F.col("level"))).alias("li"))
    cells = cut(counted)
    concepts = _best_gloss(cells.groupBy("cid", "english").agg(F.sum("n").alias("n"), F.min("o").alias("o")))
    lemmas = cells.groupBy("cid", "lang", "lemma", "pos").agg(F.min("li").alias("li"), F.min("o").alias("lemma_ord"))
    size = cells.groupBy("cid").agg(F.count(F.lit(1)).alias("_n"))
    per = join_groups(lemmas, concepts.join(size, "cid"), ["cid"], "_n", "lemma", cells.count())
    rows = per.select("lang", "lemma", F.struct("li", "concept_ord", "lemma_ord", "pos", "gloss").alias("o"), norm_gloss(F.col("gloss")).alias("gn"))
    kept = rows.groupBy("lang", "lemma", "gn").agg(F.min("o").alias("o")).select("lang", "lemma", "o.pos", "o.gloss", "o.li")
    cefr = F.element_at(F.array(*[F.lit(x) for x in LEVELS]), F.col("li")).alias("cefr")
    return ranked(kept, ["lang", "gloss", "pos"], "lemma", "rank").select("lang", "lemma", "pos", F.col("gloss").alias("english_gloss"), F.col("pos").alias("english_pos"), cefr, F.col("rank").cast("bigint").alias("rank"), concept_key(F.col("gloss"), F.col("pos")).alias("concept_key"))


def delivery_counts(delivery: DataFrame) -> DataFrame:
    return delivery.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
