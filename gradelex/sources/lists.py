"""Readers of list files, deliveries, decisions and logs. Schemas are positional and explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradelex.functions.rules import DELIVERY_PLACEHOLDERS, clean_gloss, clean_lemma, placeholder, unquote
from gradelex.functions.text import LEVELS, level_index, strip_ws
from gradelex.operators.keep import numbered

# fixed values of the files: directories and codes of the languages, headers, fields of a decision
CODES = {"english": "en", "german": "de", "french": "fr", "spanish": "es", "dutch": "nl", "swedish": "sv", "arabic": "ar", "chinese": "zh"}
LIST_TAIL = "_Lemma,English_Lemma,Chinese_Lemma,POS"
DELIVERY = ["lemma", "pos", "english_gloss", "english_pos", "cefr", "rank", "concept_key"]
DECISION = "line int, expected struct<lemma:string,english_lemma:string,chinese_lemma:string,upos:string>, action string, replacement struct<lemma:string,english_lemma:string,chinese_lemma:string,upos:string>, reason string, reviewer string"
#: a list's number stands above its lines in ord
FILE = 2**40


def _code(directory: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv]), directory)


def _fail(*parts: Column | str) -> Column:
    return F.raise_error(F.concat_ws(" ", *[F.lit(x) if isinstance(x, str) else x for x in parts]))


def read_lines(spark: SparkSession, path: str | list[str], blank: bool = True, header: bool = False) -> DataFrame:
    """(path, line, value): the physical lines of text files, numbered from 1 within each file; without blank ones, if not wanted, neither shown nor
    counted. Lines are counted per block of a file and shifted, so a large file is numbered by as many tasks as read it. header: also the first
    line of the row's file."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_m"), F.regexp_replace("value", r"\r\z", "").alias("value"))
    raw = raw if blank else raw.where(strip_ws(F.col("value")) != "")
    out = numbered(raw, ["path"], ["_m"], F.col("_at"), "line").select("path", F.col("line").cast("int").alias("line"), "value")
    if not header:
        return out
    first = raw.where("_at = 0").groupBy("path").agg(F.min_by("value", "_m").alias("header"))  # one row per file
    return out.join(first, "path")


def _cells(lines: DataFrame, columns: list[str], sep: str = ",", quote: bool = True, header: Column | None = None) -> DataFrame:
    """lines below the header with their cells by position, missing ones blank, and _bad, the line if it has another number of cells. A file that
    does not begin with the wanted header is an error."""
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "emptyValue": "", "nullValue": "\u0000", **({"escape": '"'} if quote else {"quote": ""})}
    schema = ", ".join(f"{c} string" for c in [*columns, "_bad"])
    x = lines.where(F.col("line") > 1).withColumn("x", F.from_csv("value", F.lit(schema), options))
    first = F.coalesce(f"x.{columns[0]}", F.lit(""))
    if header is not None:
        first = F.when(F.regexp_replace("header", "^\ufeff", "") != header, _fail("unexpected header in", F.col("path"), ":", F.col("header"))).otherwise(first)
    return x.select("path", "line", "value", first.alias(columns[0]), *[F.coalesce(f"x.{c}", F.lit("")).alias(c) for c in columns[1:]], "x._bad")


def _stem(part: int) -> Column:
    return F.regexp_extract("path", r"/([^/]+)/([^/]+)\.[a-z]+\z", part)


def _place(lang: Column, level: Column) -> Column:
    """The list's number: languages in the order of CODES, then levels."""
    langs = F.array(*[F.lit(c) for c in CODES.values()])
    return (F.array_position(langs, lang) * 8 + F.coalesce(level_index(level), F.lit(0))) * F.lit(FILE)


def _list_header(directory: Column) -> Column:
    return F.concat(F.initcap(directory), F.lit(LIST_TAIL))


def read_levels(spark: SparkSession, root: str, strict: bool = False, langs: list[str] | None = None, levels: list[str] | None = None) -> DataFrame:
    """Level lists root/<language>/<level>.csv: id (lang:level:row), lang, level, list_id, ord, line, lemma, english, chinese, pos. Language and level come
    from the path, so a choice of them prunes files; ord is the list's number and the line and does not depend on how files are split. strict: another header,
    a row with another number of cells is an error; else missing cells are blank, further ones dropped and blank lemmas left out."""
    names = [d for d, c in CODES.items() if not langs or c in langs]
    lines = read_lines(spark, f"{root}/{{{','.join(names)}}}/{{{','.join(levels or LEVELS)}}}.csv", header=strict)
    df = _cells(lines, ["lemma", "english", "chinese", "pos"], header=_list_header(_stem(1)) if strict else None).withColumns({"lang": _code(_stem(1)), "level": _stem(2)})
    df = df.withColumns({"ord": _place(F.col("lang"), F.col("level")) + F.col("line"), "list_id": F.concat_ws("-", "lang", "level"), "id": F.concat_ws(":", "lang", "level", (F.col("line") - 1).cast("string"))})
    if strict:
        df = df.withColumn("lemma", F.when(F.col("_bad").isNotNull(), _fail("wrong number of cells in", F.col("path"), ":", F.col("line").cast("string"))).otherwise(F.col("lemma")))
    else:
        df = df.where(strip_ws(F.col("lemma")) != "")
    return df.select("id", "lang", "level", "list_id", "ord", "line", "lemma", "english", "chinese", "pos")


def bad_headers(spark: SparkSession, root: str) -> DataFrame:
    """(path, header) of list files whose first line is not <Language>_Lemma,English_Lemma,Chinese_Lemma,POS."""
    first = read_lines(spark, f"{root}/*/*.csv").where("line = 1").select("path", F.col("value").alias("header"))
    return first.where(~F.col("header").rlike(r"\A[A-Z][a-z]+_Lemma,English_Lemma,Chinese_Lemma,POS\z"))


def read_for_quality(spark: SparkSession, root: str) -> DataFrame:
    """Level lists for the quality checks: another header is an error, blank physical lines are neither read nor counted, so a row's line is its
    place among the lines that are not, the header being 1. Columns as read_levels."""
    lines = read_lines(spark, f"{root}/{{{','.join(CODES)}}}/{{{','.join(LEVELS)}}}.csv", blank=False, header=True)
    df = _cells(lines, ["lemma", "english", "chinese", "pos"], header=_list_header(_stem(1))).withColumns({"lang": _code(_stem(1)), "level": _stem(2)})
    return df.select("lang", "level", (_place(F.col("lang"), F.col("level")) + F.col("line")).alias("ord"), "line", "lemma", "english", "chinese", "pos")


def cleaned_records(rows: DataFrame) -> DataFrame:
    """Rows with cleaned lemma and gloss, without blank lemmas and those that stand for one in deliveries."""
    c = rows.withColumns({"lemma": clean_lemma(unquote(F.col("lemma"))), "english": clean_gloss(unquote(F.col("english")))})
    return c.where((F.col("lemma") != "") & ~placeholder(F.col("lemma"), DELIVERY_PLACEHOLDERS))


def read_expansion(spark: SparkSession, root: str) -> DataFrame:
    """root/<language>/expansion.csv with a level column, B1 where it is blank; all-blank rows are left out. Columns as read_levels; ord stands
    behind that of all level lists."""
    df = _cells(read_lines(spark, f"{root}/*/expansion.csv"), ["lemma", "english", "chinese", "pos", "cefr"]).withColumn("lang", _code(_stem(1)))
    df = df.where(F.concat("lemma", "english", "chinese", "pos", "cefr") != "").withColumn("level", F.coalesce(F.nullif(F.trim("cefr"), F.lit("")), F.lit("B1")))
    row = F.concat_ws(":", "lang", F.lit("expansion"), (F.col("line") - 1).cast("string"))
    return df.select(row.alias("id"), "lang", "level", F.concat_ws("-", "lang", F.lit("expansion")).alias("list_id"), (F.lit(1024 * FILE) + _place(F.col("lang"), F.lit(None)) + F.col("line")).alias("ord"), "line", "lemma", "english", "chinese", "pos")


def read_everything(spark: SparkSession, root: str) -> DataFrame:
    """Level lists and expansions together, cleaned, as the delivery and its gate take them."""
    return cleaned_records(read_levels(spark, root).unionByName(read_expansion(spark, root)))


def blank_gloss_rows(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Rows without a gloss, with their physical line; the first `most` by ord if asked for."""
    own = rows.where(strip_ws(F.col("english")) == "")
    return own if most is None else own.orderBy("ord").limit(most)


def read_delivery(spark: SparkSession, path: str) -> DataFrame:
    """Delivery files <lang>.tsv, <language>.tsv or lang=<lang>/part files: lang, lemma, pos, english_gloss, english_pos, cefr, rank,
    concept_key. Another header, a file of no known language or a row of fewer than four cells is an error; blank lemmas are left out; a rank that
    is no number is null."""
    df = _cells(read_lines(spark, path, header=True), DELIVERY, sep="\t", quote=False, header=F.lit("\t".join(DELIVERY)))
    part = F.regexp_extract("path", r"/lang=([^/]+)/", 1)
    stem = F.when(part != "", part).otherwise(F.regexp_extract("path", r"/([a-z]+)(-\d+)?\.tsv\z", 1))
    lang = F.coalesce(_code(stem), F.when(stem.isin(*CODES.values()), stem))
    short = F.size(F.split("value", "\t")) < 4
    lemma = F.when(short & (F.col("value") != ""), _fail("short row in", F.col("path"), ":", F.col("line").cast("string"))).when(lang.isNull(), _fail("no such language:", F.col("path"))).otherwise(F.col("lemma"))
    return df.withColumns({"lang": lang, "lemma": lemma}).where(strip_ws(F.col("lemma")) != "").select("lang", *DELIVERY[:5], F.col("rank").try_cast("int").alias("rank"), "concept_key")


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Decision lines (JSON), with path and line_no of the file; a blank or invalid line is an error that names both. Files are in the order of their
    names, lines in their own."""
    j = read_lines(spark, path).withColumn("x", F.from_json("value", DECISION, {"mode": "PERMISSIVE"}))
    bad = (F.trim("value") == "") | F.col("x.line").isNull() | F.col("x.expected").isNull() | ~F.coalesce(F.col("x.action").isin("keep", "fix", "drop"), F.lit(False))
    line = F.when(bad, _fail("bad decision in", F.concat_ws(":", "path", "line"))).otherwise(F.col("x.line"))
    return j.select("path", F.col("line").alias("line_no"), line.alias("line"), "x.expected", "x.action", "x.replacement", "x.reason", "x.reviewer")


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    columns = ["lang", "level", "lemma", "english", "chinese", "pos", "action", "reason"]
    return _cells(read_lines(spark, path), columns).select(F.col("line").alias("ord"), *columns)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with path and ord, the line in the file; lines that do not parse are left out."""
    lines = read_lines(spark, path)
    parsed = lines.select("path", F.col("line").alias("ord"), F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("x"), "value")
    return parsed.where(F.col("x").isNotNull() & F.try_parse_json("value").isNotNull()).select("path", "ord", "x.*")
