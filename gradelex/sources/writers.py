"""Writers. Data is written by tasks into a folder beside the target, which then takes its place; what stood there is set aside first
and deleted last, so that a crash at any moment leaves the old or the new data on disk."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DELIVERY = ["lemma", "pos", "english_gloss", "english_pos", "cefr", "rank", "concept_key"]
CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "emptyValue": ""}


class _Files:
    """The file system of a path, through the session's own Hadoop configuration."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, at: str) -> bool:
        return self.fs.exists(self.path(at))

    def move(self, a: str, b: str) -> None:
        self.fs.mkdirs(self.path(b).getParent())
        if not self.fs.rename(self.path(a), self.path(b)):
            raise OSError(f"{a} could not be moved to {b}")

    def delete(self, at: str) -> None:
        self.fs.delete(self.path(at), True)

    def names(self, at: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(at)))

    def parts(self, at: str) -> list[str]:
        return [n for n in self.names(at) if n.startswith("part-")]


def _beside(target: str) -> str:
    return f"{target.rstrip('/')}.new-{uuid.uuid4().hex[:8]}"


def _swap(files: _Files, made: str, target: str) -> None:
    aside = f"{target.rstrip('/')}.old-{uuid.uuid4().hex[:8]}"
    held = files.exists(target)
    if held:
        files.move(target, aside)
    try:
        files.move(made, target)
    except Exception:
        if held and not files.exists(target):
            files.move(aside, target)
        raise
    if held:
        files.delete(aside)


def _place(spark: SparkSession, made: str, target: str, suffix: str) -> None:
    """The folder made takes the target's place; where the target is named like a file, its one part does."""
    files = _Files(spark, made)
    if not target.endswith(suffix):
        return _swap(files, made, target)
    (part,) = files.parts(made)
    _swap(files, f"{made}/{part}", target)
    files.delete(made)


def _name_parts(files: _Files, made: str, by: str, suffix: str) -> None:
    """The parts in made's folders by=<value> become <value>.suffix, or <value>-00001.suffix and so on where there are several."""
    for folder in files.names(made):
        if folder.startswith(f"{by}="):
            parts, value = files.parts(f"{made}/{folder}"), folder.split("=", 1)[1]
            for i, part in enumerate(parts):
                files.move(f"{made}/{folder}/{part}", f"{made}/{value}{'' if len(parts) == 1 else f'-{i:05d}'}{suffix}")
            files.delete(f"{made}/{folder}")


def write_delivery(delivery: DataFrame, target: str) -> None:
    """Tab-separated files <lang>.tsv, sorted by (lemma, rank), cells unquoted. Rows are ranged over tasks, so a large language is written by
    several, each one file <lang>-<n>.tsv in order."""
    spark, made = delivery.sparkSession, _beside(target)
    out = delivery.repartitionByRange("lang", "lemma", "rank").sortWithinPartitions("lang", "lemma", "rank")
    out.select("lang", *DELIVERY).write.partitionBy("lang").options(**CSV | {"sep": "\t", "quote": "", "escapeQuotes": False}).csv(made)
    files = _Files(spark, made)
    _name_parts(files, made, "lang", ".tsv")
    _swap(files, made, target)


def write_list(rows: DataFrame, target: str, order: list[Column | str], columns: list[str], crlf: bool = False, header: list[str] | None = None) -> None:
    """One list as one CSV file: target itself if it ends in .csv, else the only file in the folder target. A list is a bounded file, so one task
    sorts and writes it. header: names above the columns, which may repeat. crlf ends lines with CR LF."""
    made = _beside(target)
    names = [f"_o{i}" for i in range(len(order))]
    body = rows.select(F.lit(1).alias("_h"), *[(F.col(o) if isinstance(o, str) else o).alias(n) for o, n in zip(order, names, strict=True)], F.to_csv(F.struct(*columns), {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV.items() if k != "header"} | {"nullValue": ""}).alias("value"))
    head = rows.sparkSession.createDataFrame([(",".join(header or columns),)], "value string").select(F.lit(0).alias("_h"), *[F.lit(None).cast(body.schema[n].dataType).alias(n) for n in names], "value")
    w = head.unionByName(body).coalesce(1).sortWithinPartitions("_h", *names).select("value").write
    (w.option("lineSep", "\r\n") if crlf else w).text(made)
    if not target.endswith(".csv"):
        files = _Files(rows.sparkSession, made)
        (part,) = files.parts(made)
        files.move(f"{made}/{part}", f"{made}/part-00000.csv")
    _place(rows.sparkSession, made, target, ".csv")


def write_level(rows: DataFrame, target: str, language: str | None = None) -> None:
    """A level list by lemma, whatever its case; language (English, German, …) gives it the header that strict readers ask for."""
    write_list(rows, target, [F.lower("lemma"), "ord"], ["lemma", "english", "chinese", "pos"], header=[f"{language}_Lemma", "English_Lemma", "Chinese_Lemma", "POS"] if language else None)


def write_in_order(rows: DataFrame, target: str) -> None:
    write_list(rows, target, ["ord"], ["lemma", "english", "chinese", "pos"], crlf=True)


def write_proposal(rows: DataFrame, target: str) -> None:
    """Reviewed rows in order; a dropped row among them is an error."""
    guarded = rows.withColumn("lemma", F.when(F.col("action") == "drop", F.raise_error(F.lit("a dropped row cannot be written"))).otherwise(F.col("lemma")))
    write_list(guarded, target, ["ord"], ["lemma", "english", "chinese", "pos"])


def checked_source(root: str, lang: str, level: str, source: str, levels: tuple[str, ...] = ("A1", "A2", "B1", "B2", "C1")) -> str:
    """source, if it is the proposal <level>.proposed.csv or <level>.gap.proposed.csv of the language's folder under root; else an error."""
    if level not in levels:
        raise ValueError(f"no such level: {level}")
    allowed = [f"{root.rstrip('/')}/{lang}/{level}{kind}.proposed.csv" for kind in ("", ".gap")]
    if source not in allowed:
        raise ValueError(f"{source} is none of {', '.join(allowed)}")
    return source


def write_expansion(rows: DataFrame, target: str) -> None:
    write_list(rows, target, ["english", "pos", "ord"], ["lemma", "english", "chinese", "pos", "level"])


def write_inventory(rows: DataFrame, target: str) -> None:
    write_list(rows, target, ["level", "lemma"], ["lang", "level", "lemma", "english", "chinese", "pos", "action", "reason"])


def append_log(events: DataFrame, target: str) -> None:
    events.write.mode("append").json(target)


def append_events(items: DataFrame, kind: str, target: str) -> None:
    """Appends an event of a kind (generated, approved or rejected) for each item, with the moment it was written."""
    if kind not in ("generated", "approved", "rejected"):
        raise ValueError(f"no such event: {kind}")
    append_log(items.withColumns({"kind": F.lit(kind), "at": F.current_timestamp()}), target)


def sample_summary(sample: DataFrame) -> DataFrame:
    """(level, text): a Markdown table row for each level of an audit sample, with its rows and their changes."""
    n = sample.groupBy("level").agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.col("change") == c).cast("bigint")).alias(c) for c in ("edited", "pos_or_key_changed", "new_or_renamed", "unchanged")])
    return n.select("level", F.concat(F.lit("| "), F.concat_ws(" | ", "level", *[F.col(c).cast("string") for c in n.columns[1:]]), F.lit(" |")).alias("text"))


def write_sample(sample: DataFrame, target: str) -> None:
    """An audit pack: <level>.csv for each level in the order of sample_index, ALL.csv with all of them, and README.md with the numbers of each."""
    spark, made = sample.sparkSession, _beside(target)
    sample.repartition("level").sortWithinPartitions("level", "sample_index").write.partitionBy("level").options(**CSV).csv(made)
    files = _Files(spark, made)
    _name_parts(files, made, "level", ".csv")
    write_list(sample, f"{made}/ALL.csv", ["level", "sample_index"], sample.columns)
    head = spark.createDataFrame([("", "# Audit sample"), (" ", ""), ("  ", "| level | rows | edited | pos or key changed | new or renamed | unchanged |"), ("   ", "|---|---|---|---|---|---|")], "level string, text string")
    head.unionByName(sample_summary(sample)).coalesce(1).sortWithinPartitions("level").select("text").write.text(f"{made}/notes")
    _place(spark, f"{made}/notes", f"{made}/README.md", ".md")
    _swap(files, made, target)


def conllu(sentences: DataFrame) -> DataFrame:
    """(sent_id, text): the sentences in CoNLL-U form; fields that tokens lack are _."""
    line = lambda t: F.concat_ws("\t", t["id"].cast("string"), t["form"], t["lemma"], t["upos"], *[F.lit("_")] * 6)
    body = F.array_join(F.transform("tokens", line), "\n")
    return sentences.select("sent_id", F.concat(F.lit("# sent_id = "), "sent_id", F.lit("\n# text = "), "text", F.lit("\n"), body, F.lit("\n")).alias("text"))


def write_conllu(sentences: DataFrame, target: str) -> None:
    made = _beside(target)
    out = conllu(sentences)
    (out.coalesce(1).sortWithinPartitions("sent_id") if target.endswith(".conllu") else out).select("text").write.text(made)
    _place(sentences.sparkSession, made, target, ".conllu")


def write_conllu_level(sentences: DataFrame, root: str, lang: str, level: str) -> None:
    """The sentences of a level as root/<lang>/<level in small letters>.conllu, in the order of their ids."""
    write_conllu(sentences, f"{root.rstrip('/')}/{lang}/{level.lower()}.conllu")
