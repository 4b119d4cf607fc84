"""Editing of lists as pure transformations: find, look up, add, remove, move, update."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradelex.functions.text import casefold, level_index, strip_ws
from gradelex.operators.keep import keep_first

# rows: lang, level, ord (unique), line, lemma, english, chinese, pos; a term names a row when its lemma equals it, whatever the case


def _named(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """rows that a term (lang, lemma) names, with the term's other columns; terms count once per (lang, lemma)."""
    keyed = terms.withColumn("tl", F.lower(strip_ws(F.col("lemma")))).drop("lemma").dropDuplicates(["lang", "tl"])
    return rows.withColumn("tl", F.lower(F.col("lemma"))).join(keyed, ["lang", "tl"]).drop("tl")


def find(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, lemma, level) of every level that has a term (lang, lemma)."""
    return _named(rows, terms).select("lang", F.lower("lemma").alias("lemma"), "level").distinct()


def lookup(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows of any language whose lemma, gloss or pivot gloss equals a term (column term), ignoring case; each row once per term."""
    own = F.array_distinct(F.array(F.lower("lemma"), F.lower("english"), F.lower("chinese")))
    keys = terms.select(F.lower("term").alias("key")).distinct()
    return rows.select("lang", "level", "ord", F.explode(own).alias("key")).join(keys, "key").select(F.col("key").alias("term"), "lang", "level", "ord")


def argument_problems(new: DataFrame, rows: DataFrame) -> DataFrame:
    """(ord, problem) of rows to add that may not be: empty, contains space, or duplicate of a lemma of the language."""
    w = F.col("lemma")
    shape = F.when(F.trim(F.coalesce(w, F.lit(""))) == "", "empty").when(w.contains(" "), "contains space")
    known = rows.select("lang", F.lower("lemma").alias("kl")).distinct()
    ok = new.where(shape.isNull()).withColumn("kl", F.lower("lemma"))
    return new.where(shape.isNotNull()).select("ord", shape.alias("problem")).unionByName(ok.join(known, ["lang", "kl"], "left_semi").select("ord", F.lit("duplicate").alias("problem")))


def add(rows: DataFrame, new: DataFrame) -> DataFrame:
    """rows and the new ones without a problem, the first of each lemma."""
    bad = argument_problems(new, rows).select("ord").distinct()
    fine = keep_first(new.join(bad, "ord", "left_anti").withColumn("kl", F.lower("lemma")), ["lang", "kl"], "ord").drop("kl")
    return rows.unionByName(fine.select(*rows.columns))


def remove(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """rows without those that a term names, on all levels."""
    return rows.join(_named(rows, terms).select("ord"), "ord", "left_anti")


def _first(named: DataFrame) -> DataFrame:
    """The first named row of each lemma: lowest level, then smallest ord."""
    k = named.withColumn("kl", F.lower("lemma"))
    return k.groupBy("lang", "kl").agg(F.min(F.struct(level_index(F.col("level")).alias("li"), "ord")).alias("f")).select(F.col("f.ord").alias("ord"))


def move(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """terms (lang, lemma, to_level): the first row of the lemma goes to the level and all its other rows leave, unless the first
    is on that level already; then nothing changes."""
    named = _named(rows, terms)
    head = named.join(_first(named), "ord", "left_semi").where("level <> to_level")
    gone = named.withColumn("kl", F.lower("lemma")).join(head.select("lang", F.lower("lemma").alias("kl")), ["lang", "kl"], "left_semi").select("ord")
    return rows.join(gone, "ord", "left_anti").unionByName(head.withColumn("level", F.col("to_level")).select(*rows.columns))


def update(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """terms (lang, lemma, new_lemma, new_english, new_chinese; null keeps): changes the first row of the lemma only."""
    named = _named(rows, terms)
    head = named.join(_first(named), "ord", "left_semi").select("ord", "new_lemma", "new_english", "new_chinese")
    out = rows.join(head, "ord", "left")
    return out.withColumns({c: F.coalesce(f"new_{c}", c) for c in ("lemma", "english", "chinese")}).select(*rows.columns)




def language_codes(rows: DataFrame, column: str, profile: DataFrame, strict: bool = False) -> DataFrame:
    """rows with code, that of the language a column names by its code, directory, display name or own name, whatever the case. Where it names none, code
    is null, or strict, an error. profile has one row per language."""
    names = F.array_distinct(F.array(*[casefold(strip_ws(F.col(c))) for c in ("code", "directory", "display_name", "endonym")]))
    known = profile.select("code", F.explode(names).alias("_name")).dropDuplicates(["_name"])
    out = rows.withColumn("_name", casefold(strip_ws(F.col(column)))).join(known, "_name", "left").drop("_name")
    if strict:
        return out.withColumn("code", F.coalesce("code", F.raise_error(F.concat(F.lit("no such language: "), F.coalesce(F.col(column), F.lit("null"))))))
    return out
