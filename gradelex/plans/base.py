"""What the queries read, in both languages: the entry relation and small derived relations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradelex.functions.text import LEVELS, UPOS
from gradelex.session import table

ENTRY = "entry AS (SELECT lang, level, list_id, entry_id AS ord, csv_line AS line, coalesce(lemma, '') AS lemma, coalesce(english_lemma, '') AS english, coalesce(chinese_lemma, '') AS chinese, coalesce(pos, '') AS pos FROM level_entry)"
LEVEL_LIST = ", ".join(f"'{x}'" for x in LEVELS)
UPOS_LIST = ", ".join(f"'{x}'" for x in UPOS)


def entries(spark: SparkSession, d: str) -> DataFrame:
    text = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    return table(spark, d, "level_entry").select("lang", "level", "list_id", F.col("entry_id").alias("ord"), F.col("csv_line").alias("line"), text("lemma", "lemma"), text("english_lemma", "english"), text("chinese_lemma", "chinese"), text("pos", "pos"))


def with_entry(body: str, *more: str) -> str:
    return f"WITH {', '.join([ENTRY, *more])} {body}"


def norm(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '^to ', ''), ' ')"


def fold(c: str) -> str:
    """word_key in SQL: trimmed, composed, case folded."""
    return f"lower(replace(nfc_normalize(trim({c})), 'ß', 'ss'))"


def level_no(c: str) -> str:
    return f"list_position([{LEVEL_LIST}], {c})"


class Registry:
    """Queries and their SQL under one name each."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable:
        def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return keep
