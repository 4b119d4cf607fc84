"""Rows that fail to parse: cells exploded to (row, column, value), checked against a rule table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.functions.text import LEVELS, UPOS, key64

#: kind of file, column, rule: fixed values of the delivery formats
RULES = (
    ("tsv", 0, "lemma"), ("tsv", 1, "upos"), ("tsv", 2, "text"), ("tsv", 3, "upos"), ("tsv", 4, "level"), ("tsv", 5, "rank"),
    ("expansion", 0, "lemma"), ("expansion", 1, "text"), ("expansion", 3, "upos"), ("expansion", 4, "level_or_blank"),
    ("csv", 0, "lemma"), ("csv", 1, "text"), ("csv", 3, "upos"),
)
WIDTH = {"tsv": 7, "expansion": 5, "csv": 4}
REASONS = ("quoting", "column_count", "value")
_ESC, _CELL = "\u001a", "\u001f"
_UNSEEN = r"[\p{Z}\p{C}͏ᅟᅠ឴឵᠋-᠏⠀ㅤ︀-️ﾠ]"


def _kind(file_name: Column) -> Column:
    base = F.element_at(F.split(F.coalesce(file_name, F.lit("")), "/"), -1)
    return F.when(base.endswith(".tsv"), "tsv").when(base == "expansion.csv", "expansion").otherwise("csv")


def _pieces(sep: str) -> Column:
    """The line, between two separators, split at its quotes. The two characters used below for marks are escaped."""
    text = F.replace(F.replace("line", F.lit(_ESC), F.lit(_ESC + "s")), F.lit(_CELL), F.lit(_ESC + "u"))
    return F.split(F.concat(F.lit(sep), text, F.lit(sep)), '"', -1)


def _well_quoted(sep: str) -> Column:
    """Pieces at odd places lie inside quotes. One outside must begin and end at a separator, or be empty, which is a doubled quote.
    Lambdas refer to nothing but their piece and its place: whatever else they named would be computed for each piece."""
    outside = F.transform(_pieces(sep), lambda p, i: (i % 2 == 1) | (p == "") | (p.startswith(sep) & p.endswith(sep)))
    return (F.size(outside) % 2 == 1) & F.forall(outside, lambda x: x)


def _cells(sep: str) -> Column:
    plain = F.transform(_pieces(sep), lambda p, i: F.when(i % 2 == 1, p).when(p == "", '"').otherwise(F.replace(p, F.lit(sep), F.lit(_CELL))))
    inner = F.regexp_replace(F.array_join(plain, ""), rf"\A{_CELL}|{_CELL}\z", "")
    return F.transform(F.split(inner, _CELL, -1), lambda c: F.replace(F.replace(c, F.lit(_ESC + "u"), F.lit(_CELL)), F.lit(_ESC + "s"), F.lit(_ESC)))


def _parse(lines: DataFrame) -> DataFrame:
    """Adds kind, quoted_well and cells."""
    tsv = F.col("kind") == "tsv"
    either = lambda f: F.when(tsv, f("\t")).otherwise(f(","))
    return lines.withColumn("kind", _kind(F.col("file_name"))).withColumn("quoted_well", either(_well_quoted)).withColumn("cells", either(_cells))


def _breaks(rule: Column, v: Column) -> Column:
    spaced = F.trim(v)
    control = v.rlike(r"[\p{Cc}�]")
    return (
        F.when(rule == "lemma", control | (F.regexp_replace(v, _UNSEEN, "") == ""))
        .when(rule == "text", control)
        .when(rule == "upos", ~spaced.isin(*UPOS))
        .when(rule == "level", ~spaced.isin(*LEVELS))
        .when(rule == "level_or_blank", ~((spaced == "") | spaced.isin(*LEVELS)))
        .when(rule == "rank", ~(F.regexp_replace(v, r"(?U)\s", "").eqNullSafe("") | v.rlike(r"\A[0-9]*[1-9][0-9]*\z")))
        .otherwise(False)
    )


def split_lines(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, failing rows) of raw_id, file_name, line_no, raw_text.

    Valid rows: the input's raw_id, file_name, line_no, and kind, cells, lemma (c0), gloss (c1; in TSV files the
    third cell), pos, level. Failing rows: raw_id, file_name, line_no, raw_text, reason and details, an array of
    (column, rule) for `value`. Headers (line_no 1) and empty lines are in neither. A null raw_text counts
    as an empty line, a null line_no as an ordinary line, a null file name as a plain CSV file.
    Identical rows have the same fate and are each kept; further columns are ignored.

    Failing lines come from one pass: cells are exploded, joined to the rules, and only failing cells, with their line, are aggregated, so the
    shuffle carries failures and not the table. Sound lines leave the failing ones by an anti-join on a 128-bit key of
    the whole line, which no single file or line number can skew.
    """
    spark = raw.sparkSession
    whole = ["raw_id", "file_name", "line_no", "raw_text"]
    lines = raw.select(*whole, F.regexp_replace("raw_text", r"\r\z", "").alias("line"))
    lines = lines.where(F.col("line").isNotNull() & (F.col("line") != "") & ~F.col("line_no").eqNullSafe(1))
    parsed = _parse(lines)
    need = F.element_at(F.create_map(*[F.lit(x) for kv in WIDTH.items() for x in kv]), F.col("kind"))
    parsed = parsed.withColumn("shape", F.when(~F.col("quoted_well"), "quoting").when(F.size("cells") != need, "column_count"))
    rules = F.broadcast(spark.createDataFrame(RULES, "kind string, c int, rule string"))  # 13 rows, fixed
    # a line of another shape is one cell that no rule is for
    cells = parsed.select(*whole, "kind", "shape", F.posexplode(F.when(F.col("shape").isNull(), F.col("cells")).otherwise(F.array(F.lit(None).cast("string")))).alias("c", "v"))
    bad = cells.join(rules, ["kind", "c"], "left").where(F.col("shape").isNotNull() | _breaks(F.col("rule"), F.col("v")))
    # equal lines have equal failures: a set keeps the details one per cell, and their number tells how many lines there are
    details = F.sort_array(F.collect_set(F.when(F.col("shape").isNull(), F.struct("c", "rule"))))
    # they are counted per task that read them, so equal lines without end are written out by many
    errors = bad.withColumn("_task", F.spark_partition_id()).groupBy(*whole, "shape", "_task").agg(details.alias("details"), F.count(F.lit(1)).alias("n"))
    times = F.when(F.col("shape").isNull(), F.col("n") / F.size("details")).otherwise(F.col("n")).cast("int")
    failing = errors.select(*whole, F.coalesce("shape", F.lit("value")).alias("reason"), F.when(F.col("shape").isNull(), F.col("details")).alias("details"), F.explode(F.array_repeat(F.lit(True), times)).alias("_")).drop("_")
    keyed = lambda df: df.withColumns({f"k{i}": key64(*[F.col(c) for c in whole], seed=i) for i in (1, 2)})
    lost = keyed(bad.where("shape is null").select(*whole)).select("k1", "k2").distinct()
    cell = lambda i: F.col("cells")[i]
    tsv = F.col("kind") == "tsv"
    valid = keyed(parsed.where("shape is null")).join(lost, ["k1", "k2"], "left_anti").select(
        "raw_id", "file_name", "line_no", "kind", "cells", cell(0).alias("lemma"), F.when(tsv, cell(2)).otherwise(cell(1)).alias("gloss"),
        F.trim(F.when(tsv, cell(1)).otherwise(cell(3))).alias("pos"), F.when(tsv | (F.col("kind") == "expansion"), F.nullif(F.trim(F.try_element_at("cells", F.lit(5))), F.lit(""))).alias("level"),
    )
    return valid, failing
