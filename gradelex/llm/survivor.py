"""Best representative of each duplicate group: skyline of completeness, recency and trust."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.functions.text import LEVELS, strip_ws

#: words that say there is no value, or none yet: fixed values, compared after case and marks are taken away
STAND_INS = (
    "null", "nil", "none", "na", "nan", "n a", "not available", "not applicable", "missing", "unknown", "undefined", "unspecified",
    "no value", "no gloss", "no translation", "not given", "not known", "not set", "not yet", "to do", "todo", "tbd", "tba", "tbc", "to be determined", "to be done", "to be added",
    "to be confirmed", "to be announced", "to be translated", "pending", "placeholder", "wip", "fixme", "xxx",
)


def usable(gloss: Column) -> Column:
    """The gloss without outer white space, or null where it says nothing."""
    words = F.trim(F.regexp_replace(F.lower(gloss), r"[^\p{L}\p{N}\p{M}]+", " "))
    return F.when(gloss.isNotNull() & (words != "") & ~words.isin(*STAND_INS), strip_ws(gloss))


def _dominates(a: Column, b: Column) -> Column:
    """Whether candidate a is nowhere worse than b and somewhere better. Completeness is the set of fields that are filled, so more complete
    means to have all fields of the other and one more; recency is the moment, of equal moments the smaller id."""
    recent = lambda x: F.struct(x["at"], x["neg"])
    no_worse = (a["mask"].bitwiseAND(b["mask"]) == b["mask"]) & (a["trust"] >= b["trust"]) & (recent(a) >= recent(b))
    better = (a["mask"] != b["mask"]) | (a["trust"] > b["trust"]) | (recent(a) > recent(b))
    return no_worse & better


def survivors(copies: DataFrame, origin_trust: DataFrame, fields: tuple[str, ...] = ("english_lemma", "chinese_lemma")) -> DataFrame:
    """One row for each (lang, lemma, upos) with two or more copies.

    Columns: the key, first_id (smallest copy_id), n_copies, kept_level (lowest valid level, trimmed and upper-cased;
    null if none is valid), kept_<field> for each field, skyline (number of undominated candidates), layers (number
    of dominance layers) and conflict (yes if usable values of the first field differ beyond letter case). Null keys
    equal each other; an unknown or null origin is least trusted; a null updated_at is the earliest; ties go to the
    smallest copy_id. A field without any usable value is null. Further columns are ignored.

    Candidates: copies are reduced before any shuffle to the best one of each cell of (which fields are usable,
    trust). Within a cell copies differ in recency only, so the latest dominates the rest, and a group has at most
    2^fields cells for each level of trust, however many copies it has.
    Layers: candidates sorted by the policy (trust, recency, smallest id) follow all that dominate them, so one fold over at
    most that many candidates gives each its layer, one more than the highest among its dominators; layer 1 is the skyline.
    Survivor: the first candidate of the skyline by the policy; a field it lacks comes from the next of the skyline that has it,
    then from the second layer, and so on. As a candidate is only dominated by those that have all its fields, no
    better holder of a field hides in a later layer.
    """
    trust = origin_trust.groupBy("origin").agg(F.max("trust").alias("trust"))
    key = ["lang", "lemma", "upos"]
    level = F.upper(strip_ws(F.col("level")))
    at = F.coalesce(F.col("updated_at").cast("timestamp_ntz"), F.expr("timestamp_ntz'0001-01-01 00:00:00'"))
    own = copies.select(*key, "copy_id", "level", "origin", "updated_at", *fields)
    slim = own.join(trust, "origin", "left").select(*key, "copy_id", F.coalesce("trust", F.lit(-(2**31))).alias("trust"), at.alias("at"), F.when(level.isin(*LEVELS), level).alias("lv"), *[usable(F.col(f)).alias(f"u_{f}") for f in fields])
    mask = reduce(lambda a, b: a + b, [F.when(F.col(f"u_{f}").isNotNull(), 1 << i).otherwise(0) for i, f in enumerate(fields)])
    best = F.max(F.struct("at", (-F.col("copy_id")).alias("neg"), *[f"u_{f}" for f in fields])).alias("x")
    per_cell = (
        slim.withColumn("mask", mask).withColumn("folded", F.lower(f"u_{fields[0]}")).groupBy(*key, "mask", "trust")
        .agg(best, F.count(F.lit(1)).alias("n"), F.min("copy_id").alias("first_id"), F.min("lv").alias("lv"), F.min("folded").alias("lo"), F.max("folded").alias("hi"))
    )
    cand = F.struct("trust", F.col("x.at").alias("at"), F.col("x.neg").alias("neg"), F.bit_count("mask").alias("filled"), "mask", *[F.col(f"x.u_{f}").alias(f) for f in fields])
    groups = (
        per_cell.groupBy(*key)
        .agg(F.sum("n").alias("n_copies"), F.min("first_id").alias("first_id"), F.min("lv").alias("kept_level"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(cand), asc=False).alias("c"))
        .where("n_copies > 1")
    )
    names = ", ".join(f"`{f}`:string" for f in fields)
    id_type = copies.schema["copy_id"].dataType.simpleString()
    none = F.expr(f"cast(array() as array<struct<trust:int,at:timestamp_ntz,neg:{id_type},mask:int,layer:int,{names}>>)")

    def step(seen: Column, x: Column) -> Column:
        above = F.transform(F.filter(seen, lambda y: _dominates(y, x)), lambda y: y["layer"])
        layer = (F.coalesce(F.array_max(above), F.lit(0)) + 1).alias("layer")
        return F.concat(seen, F.array(F.struct(*[x[c].alias(c) for c in ("trust", "at", "neg", "mask")], layer, *[x[f].alias(f) for f in fields])))

    groups = groups.withColumn("ranked", F.aggregate("c", none, step)).drop("c")
    layers = F.transform("ranked", lambda y: y["layer"])

    def kept(field: str) -> Column:
        """The field of the first candidate that has it, by layer and then by the policy, which is the order of the array."""
        places = F.transform("ranked", lambda y, i: F.when(y[field].isNotNull(), F.struct(y["layer"].alias("layer"), i.alias("i"), y[field].alias("v"))))
        return F.array_min(F.array_compact(places))["v"].alias(f"kept_{field}")

    return groups.select(*key, "first_id", "n_copies", "kept_level", *[kept(f) for f in fields], F.size(F.filter(layers, lambda n: n == 1)).alias("skyline"), F.coalesce(F.array_max(layers), F.lit(0)).alias("layers"), F.when(F.col("lo") != F.col("hi"), "yes").otherwise("no").alias("conflict"))
