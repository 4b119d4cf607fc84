"""Queries of the core's data-cleaning operators and their equivalents in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradelex.functions.text import LEVELS, UPOS
from gradelex.operators.orphans import decision_orphans, orphan_report
from gradelex.operators.rawlines import split_lines
from gradelex.operators.snapshots import snapshot_changes
from gradelex.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return decision_orphans(table(spark, d, "review_decision"), table(spark, d, "level_entry"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p2_found(spark, d), table(spark, d, "review_decision"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return split_lines(table(spark, d, "raw_line"))[1].select("raw_id", "reason")


def p3_loaded(spark: SparkSession, d: str) -> DataFrame:
    return split_lines(table(spark, d, "raw_line"))[0].select("raw_id", "file_name", "line_no", "lemma", "gloss", "pos", "level")


def p3_summary(spark: SparkSession, d: str) -> DataFrame:
    failing = split_lines(table(spark, d, "raw_line"))[1]
    rule = F.explode_outer("details")
    return failing.select("reason", rule.alias("x")).groupBy("reason", F.col("x.c").alias("col_no"), F.col("x.rule").alias("rule")).agg(F.count(F.lit(1)).alias("n_cells"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "german_snapshot"), "entry_key", "snapshot_no", "delivered_at", ["german_lemma", "english_lemma", "pos"])


QUERIES = {f.__name__: f for f in (p2_found, p2_report, p3_found, p3_loaded, p3_summary, p5_found)}

_FOLD = "replace(lower(nfc_normalize(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'))), 'ß', 'ss')"
_P2 = f"""
WITH r AS (SELECT *, {_FOLD.format("expected.lemma")} AS l, {_FOLD.format("expected.upos")} AS u FROM review_decision WHERE list_id IS NOT NULL AND line IS NOT NULL),
e AS (SELECT list_id, csv_line, added_at, removed_at, {_FOLD.format("lemma")} AS l, {_FOLD.format("pos")} AS u FROM level_entry),
o AS (SELECT round, strftime(decided_at, '%Y-%m') AS period, decision_id FROM r WHERE NOT EXISTS (
  SELECT 1 FROM e WHERE e.list_id = r.list_id AND e.csv_line = r.line AND e.l = r.l AND e.u = r.u AND e.added_at <= r.decided_at AND (e.removed_at IS NULL OR r.decided_at < e.removed_at)))
"""
_TAGS = ", ".join(f"'{x}'" for x in UPOS)
_LEVELS = ", ".join(f"'{x}'" for x in LEVELS)
_P3 = f"""
WITH a AS (SELECT raw_id, file_name, line_no, regexp_replace(raw_text, '\\r\\z', '') AS t,
    CASE WHEN file_name LIKE '%.tsv' THEN 'tsv' WHEN regexp_matches(file_name, '(^|/)expansion\\.csv$') THEN 'expansion' ELSE 'csv' END AS kind FROM raw_line),
b AS (SELECT *, CASE WHEN kind = 'tsv' THEN chr(9) ELSE ',' END AS sep FROM a WHERE line_no <> 1 AND t <> ''),
c AS (SELECT *, CASE WHEN kind = 'tsv' THEN regexp_full_match(t, '(?s)("([^"]|"")*"|[^"\\t]*)(\\t("([^"]|"")*"|[^"\\t]*))*') ELSE regexp_full_match(t, '(?s)("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*') END AS ok FROM b),
d AS (SELECT *, CASE WHEN NOT ok THEN [] ELSE list_transform(regexp_extract_all(sep || t, CASE WHEN kind = 'tsv' THEN '(?s)\\t("([^"]|"")*"|[^"\\t]*)' ELSE '(?s),("([^"]|"")*"|[^",]*)' END, 1),
    lambda x: CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END) END AS x FROM c),
e AS (SELECT *, CASE kind WHEN 'tsv' THEN 7 WHEN 'expansion' THEN 5 ELSE 4 END AS need FROM d),
f AS (SELECT *, x[1] AS lemma, CASE WHEN kind = 'tsv' THEN x[3] ELSE x[2] END AS gloss, trim(CASE WHEN kind = 'tsv' THEN x[2] ELSE x[4] END, ' ') AS pos, CASE WHEN kind <> 'csv' THEN trim(x[5], ' ') END AS cefr FROM e),
g AS (SELECT *, CASE WHEN NOT ok THEN 'quoting' WHEN len(x) <> need THEN 'column_count'
    WHEN regexp_replace(lemma, '[\\p{{Z}}\\p{{C}}]', '', 'g') = '' OR regexp_matches(lemma || gloss, '[\\p{{Cc}}\\x{{FFFD}}]') OR pos NOT IN ({_TAGS})
      OR (kind = 'tsv' AND (trim(x[4], ' ') NOT IN ({_TAGS}) OR cefr NOT IN ({_LEVELS}) OR NOT (trim(x[6]) = '' OR regexp_full_match(x[6], '[0-9]*[1-9][0-9]*'))))
      OR (kind = 'expansion' AND cefr NOT IN ('', {_LEVELS})) THEN 'value' END AS reason FROM f)
"""
_P5 = """
WITH r AS (SELECT snapshot_no, entry_key, german_lemma, english_lemma, pos FROM german_snapshot
  QUALIFY row_number() OVER (PARTITION BY snapshot_no, entry_key ORDER BY delivered_at DESC) = 1),
n AS (SELECT snapshot_no, lag(snapshot_no) OVER (ORDER BY snapshot_no) AS last FROM (SELECT DISTINCT snapshot_no FROM r)),
k AS (SELECT n.snapshot_no, last, entry_key FROM n JOIN r ON r.snapshot_no IN (n.snapshot_no, last) WHERE last IS NOT NULL GROUP BY ALL)
SELECT k.snapshot_no, k.entry_key, CASE WHEN b.snapshot_no IS NULL THEN 'added' WHEN a.snapshot_no IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM k LEFT JOIN r a ON a.snapshot_no = k.snapshot_no AND a.entry_key IS NOT DISTINCT FROM k.entry_key LEFT JOIN r b ON b.snapshot_no = k.last AND b.entry_key IS NOT DISTINCT FROM k.entry_key
WHERE a.snapshot_no IS NULL OR b.snapshot_no IS NULL OR a.german_lemma IS DISTINCT FROM b.german_lemma OR a.english_lemma IS DISTINCT FROM b.english_lemma OR a.pos IS DISTINCT FROM b.pos
"""
SQL = {
    "p2_found": _P2 + "SELECT * FROM o",
    "p2_report": _P2 + "SELECT 'level_entry' AS parent_table, a.round, a.period, n_refs, coalesce(n_orphans, 0) AS n_orphans FROM (SELECT round, strftime(decided_at, '%Y-%m') AS period, count(*) AS n_refs FROM r GROUP BY ALL) a LEFT JOIN (SELECT round, period, count(*) AS n_orphans FROM o GROUP BY ALL) b ON a.round IS NOT DISTINCT FROM b.round AND a.period IS NOT DISTINCT FROM b.period",
    "p3_found": _P3 + "SELECT raw_id, reason FROM g WHERE reason IS NOT NULL",
    "p3_loaded": _P3 + "SELECT raw_id, file_name, line_no, lemma, gloss, pos, nullif(cefr, '') AS level FROM g WHERE reason IS NULL",
    "p3_summary": _P3 + """SELECT reason, col_no, rule, count(*) AS n_cells FROM (
  SELECT reason, u.c AS col_no, u.rule FROM g, unnest(list_filter([
    CASE WHEN regexp_replace(lemma, '[\\p{Z}\\p{C}]', '', 'g') = '' OR regexp_matches(lemma, '[\\p{Cc}\\x{FFFD}]') THEN {'c': 0, 'rule': 'lemma'} END,
    CASE WHEN regexp_matches(gloss, '[\\p{Cc}\\x{FFFD}]') THEN {'c': CASE WHEN kind = 'tsv' THEN 2 ELSE 1 END, 'rule': 'text'} END,
    CASE WHEN pos NOT IN (@TAGS) THEN {'c': CASE WHEN kind = 'tsv' THEN 1 ELSE 3 END, 'rule': 'upos'} END,
    CASE WHEN kind = 'tsv' AND trim(x[4], ' ') NOT IN (@TAGS) THEN {'c': 3, 'rule': 'upos'} END,
    CASE WHEN kind = 'tsv' AND cefr NOT IN (@LEVELS) THEN {'c': 4, 'rule': 'level'} END,
    CASE WHEN kind = 'tsv' AND NOT (trim(x[6]) = '' OR regexp_full_match(x[6], '[0-9]*[1-9][0-9]*')) THEN {'c': 5, 'rule': 'rank'} END,
    CASE WHEN kind = 'expansion' AND cefr NOT IN ('', @LEVELS) THEN {'c': 4, 'rule': 'level_or_blank'} END], lambda y: y IS NOT NULL)) AS t(u) WHERE reason = 'value'
  UNION ALL SELECT reason, NULL, NULL FROM g WHERE reason IN ('quoting', 'column_count')) GROUP BY ALL""".replace("@TAGS", _TAGS).replace("@LEVELS", _LEVELS),
    "p5_found": _P5,
}
