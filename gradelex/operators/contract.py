"""Contract gate: pair coverage, duplicates, ranks, shrunken glosses, script and substance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.functions.rules import ARABIC, COVERAGE, FUNCTION_PREFIXES, HAN, JUNK_LEMMAS, ascii_gloss, norm_gloss, word_count
from gradelex.functions.text import strip_ws

# rows: lang, lemma, pos, english (gloss), and rank where an operator needs it


def _index(rows: DataFrame, *more: Column) -> DataFrame:
    """(lang, g, pos, n, k…): rows and distinct lemmas of each language's gloss and tag."""
    keyed = rows.withColumn("g", norm_gloss(F.col("english")))
    return keyed.groupBy("lang", "g", "pos").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("lemma").alias("k"), *more)


def _coverage(index: DataFrame) -> DataFrame:
    """One row with arrays c (source, target, uniq, ambiguous, total, gaps): an entry per pair of languages that share a concept, and one per language
    with a null target. A concept is an array of at most one entry per language, so neither is the index joined with itself nor are rows gathered."""
    zero = F.lit(0).cast("bigint")
    cell = lambda s, t, uniq, amb, total, gaps: F.struct(s.alias("source"), t.alias("target"), uniq.alias("uniq"), amb.alias("ambiguous"), total.alias("total"), gaps.alias("gaps"))
    gaps = F.col("firsts") if "firsts" in index.columns else F.lit(1)
    concepts = index.withColumn("gap", F.when(gaps == 1, zero).otherwise(F.lit(1).cast("bigint"))).groupBy("g", "pos").agg(F.collect_list(F.struct("lang", "n", "k", "gap")).alias("a"))
    pair = lambda s: F.transform(F.filter("a", lambda t: t["lang"] != s["lang"]), lambda t: cell(s["lang"], t["lang"], F.when(t["k"] == 1, s["n"]).otherwise(zero), F.when(t["k"] > 1, s["n"]).otherwise(zero), zero, zero))
    own = F.transform("a", lambda s: cell(s["lang"], F.lit(None).cast("string"), zero, zero, s["n"], s["gap"]))
    pairs = F.when(F.col("g") != "", F.flatten(F.transform("a", pair))).otherwise(F.filter(own, lambda x: F.lit(False)))
    sums = concepts.select(F.inline(F.concat(own, pairs))).groupBy("source", "target").agg(*[F.sum(c).alias(c) for c in ("uniq", "ambiguous", "total", "gaps")])
    return sums.agg(F.collect_list(F.struct(*sums.columns)).alias("c"))


def _grid(coverage: DataFrame) -> Column:
    """The pairs of different languages with what they cover, 0 where they share nothing."""
    langs = F.filter("c", lambda x: x["target"].isNull())
    hit = lambda s, t, name: F.coalesce(F.try_element_at(F.transform(F.filter("c", lambda x: (x["source"] == s["source"]) & (x["target"] == t["source"])), lambda x: x[name]), F.lit(1)), F.lit(0).cast("bigint"))
    row = lambda s, t: F.struct(s["source"].alias("source"), t["source"].alias("target"), hit(s, t, "uniq").alias("uniq"), hit(s, t, "ambiguous").alias("ambiguous"), s["total"].alias("total"))
    return F.flatten(F.transform(langs, lambda s: F.transform(F.filter(langs, lambda t: t["source"] != s["source"]), lambda t: row(s, t))))


def pair_coverage(rows: DataFrame) -> DataFrame:
    """For every ordered pair of languages: rows of the source whose (gloss, pos) has one, several or no distinct lemmas in the
    target, and the share with one. A blank gloss has none. All pairs come from one pass over the rows."""
    cover = _coverage(_index(rows))
    out = cover.select(F.inline(_grid(cover)))
    return out.select("source", "target", "uniq", "ambiguous", (F.col("total") - F.col("uniq") - F.col("ambiguous")).alias("none"), F.try_divide(F.col("uniq"), F.col("total")).alias("ratio"))


def coverage_gate(rows: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    return pair_coverage(rows).withColumn("status", F.when(F.coalesce("ratio", F.lit(0.0)) >= threshold, "OK").otherwise("LOW"))


def duplicate_keys(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "lemma", norm_gloss(F.col("english")).alias("gloss_norm")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def rank_gaps(rows: DataFrame) -> DataFrame:
    """(lang, gloss, pos) without exactly one row of rank 1."""
    firsts = F.sum(F.when(F.col("rank") == 1, 1).otherwise(0)).alias("firsts")
    return rows.groupBy("lang", norm_gloss(F.col("english")).alias("gloss_norm"), "pos").agg(firsts).where("firsts <> 1")


def shrunken_glosses(delivery: DataFrame, source: DataFrame) -> DataFrame:
    """Delivery rows with a one-word gloss where the source has a longer one for the lemma and not that word itself.

    Both tests are joins on sets of keys, so no list of a lemma's glosses is ever gathered."""
    longer = source.where(word_count(F.col("english")) > 1).select("lang", "lemma").distinct()
    own = source.select("lang", "lemma", "english").distinct()
    single = delivery.where(word_count(F.col("english")) == 1)
    return single.join(longer, ["lang", "lemma"], "left_semi").join(own, ["lang", "lemma", "english"], "left_anti").select("lang", "lemma", "english")


def non_ascii_glosses(rows: DataFrame) -> DataFrame:
    return rows.where(~ascii_gloss(F.coalesce("english", F.lit("")))).select("lang", "lemma", "english")


def _script_code(r: DataFrame, cognates: DataFrame | None) -> DataFrame:
    """r (lang, lemma, english, …) with code, the first broken rule of script and substance or null."""
    r = r.withColumns({"w": strip_ws(F.col("lemma"))}).withColumns({"wl": F.lower("w"), "wn": norm_gloss(F.col("w")), "gn": norm_gloss(F.col("english"))})
    copies = (F.col("wn") == F.col("gn")) | (F.col("wl") == F.lower("english"))
    if cognates is not None:
        words = cognates.select("lang", F.lower("word").alias("word"), F.lit(True).alias("ok")).distinct()
        r = r.join(words.select(F.col("lang"), F.col("word").alias("wl"), F.col("ok").alias("ok1")), ["lang", "wl"], "left").join(words.select(F.col("lang"), F.col("word").alias("wn"), F.col("ok").alias("ok2")), ["lang", "wn"], "left")
        copies = copies & F.col("ok1").isNull() & F.col("ok2").isNull()
    letters, other = F.col("w").rlike(r"\p{L}"), ~F.col("lang").isin("en", "ar", "zh")
    prefixed = reduce(lambda a, b: a | b, [F.col("wl").startswith(p) for p in FUNCTION_PREFIXES])
    code = (
        F.when(F.col("w") == "", "empty_lemma")
        .when(F.col("w").isin(*JUNK_LEMMAS), "junk_lemma")
        .when((F.col("lang") == "ar") & letters & ~F.col("w").rlike(ARABIC), "non_arabic_script")
        .when((F.col("lang") == "zh") & letters & ~F.col("w").rlike(HAN), "non_chinese_script")
        .when(other & copies, "ungrounded_gloss_copy")
        .when(other & prefixed, "english_function_prefix_copy")
    )
    return r.withColumn("code", code)


def script_and_substance(rows: DataFrame, cognates: DataFrame | None = None) -> DataFrame:
    """First broken rule of each row: empty_lemma, junk_lemma, non_arabic_script, non_chinese_script, ungrounded_gloss_copy
    or english_function_prefix_copy. cognates (lang, word): copies that are real words of the language."""
    return _script_code(rows.select("lang", "lemma", "english"), cognates).where("code is not null").select("lang", "lemma", "english", "code")


def contract_report(rows: DataFrame, source: DataFrame, cognates: DataFrame | None = None, threshold: float = COVERAGE) -> DataFrame:
    """Number of violations of each criterion, 0 where there are none.

    Two aggregations over the delivery and one over the source give all six. Rows of both are counted per (lang, lemma, gloss), on which
    the glosses' and scripts' criteria depend; counts per lemma then tell duplicates and shrunken glosses. Concepts tell ranks and coverage."""
    side = lambda df, own: df.select("lang", "lemma", "english", F.lit(own).alias("d"), F.lit(1 - own).alias("s"))
    glosses = side(rows, 1).unionByName(side(source, 0)).groupBy("lang", "lemma", "english").agg(F.sum("d").alias("d"), F.max("s").alias("s"))
    words = word_count(F.col("english"))
    told = _script_code(glosses, cognates).select(
        "lang", "lemma", "gn", "d", F.when((words == 1) & (F.col("s") == 0), F.col("d")).otherwise(0).alias("shrunk"), ((words > 1) & (F.col("s") == 1)).alias("longer"),
        F.when(ascii_gloss(F.coalesce("english", F.lit(""))), 0).otherwise(F.col("d")).alias("ascii"), F.when(F.col("code").isNull(), 0).otherwise(F.col("d")).alias("script"),
    )
    keys = told.groupBy("lang", "lemma", "gn").agg(*[F.sum(c).alias(c) for c in ("d", "shrunk", "ascii", "script")], F.bool_or("longer").alias("longer"))
    lemmas = keys.groupBy("lang", "lemma").agg(F.sum((F.col("d") > 1).cast("bigint")).alias("dups"), F.bool_or("longer").alias("longer"), *[F.sum(c).alias(c) for c in ("shrunk", "ascii", "script")])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    line = lambda name, n: F.struct(F.lit(name).alias("criterion"), n.alias("violations"))
    one = lemmas.agg(total(F.when(F.col("longer"), F.col("shrunk"))).alias("a"), total("dups").alias("b"), total("ascii").alias("e"), total("script").alias("f"))
    one = one.select(F.inline(F.array(line("1_shrunken", F.col("a")), line("2_duplicates", F.col("b")), line("5_ascii", F.col("e")), line("6_script", F.col("f")))))
    cover = _coverage(_index(rows, F.sum(F.when(F.col("rank") == 1, 1).otherwise(0)).alias("firsts")))
    low = F.filter(_grid(cover), lambda x: F.coalesce(F.try_divide(x["uniq"], x["total"]), F.lit(0.0)) < threshold)
    two = cover.select(F.inline(F.array(line("3_rank_gaps", F.aggregate("c", F.lit(0).cast("bigint"), lambda n, x: n + x["gaps"])), line("4_coverage", F.size(low).cast("bigint")))))
    return one.unionByName(two)


def baseline_report(rows: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """(criterion, subject, value, base) of lists that have not been delivered: duplicate keys (2), covered rows of each pair of languages among
    its rows (4), and glosses that are blank or not ASCII (5). Criteria 1 and 3 need a delivery."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("criterion"), F.lit("all").alias("subject"), "value", F.lit(0).cast("bigint").alias("base"))
    pairs = pair_coverage(rows).select(F.lit("4_coverage").alias("criterion"), F.concat_ws("->", "source", "target").alias("subject"), F.col("uniq").alias("value"), (F.col("uniq") + F.col("ambiguous") + F.col("none")).alias("base"))
    return n(duplicate_keys(rows), "2_duplicates").unionByName(pairs).unionByName(n(non_ascii_glosses(rows), "5_ascii"))
