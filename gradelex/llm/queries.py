"""Queries of this subpackage and, where SQL can express them, their equivalents in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradelex.llm import bpe, copies, fill, langid, looks, matching, survivor
from gradelex.session import table


def _lists(spark: SparkSession, d: str) -> tuple[DataFrame, str, DataFrame, str]:
    return table(spark, d, "swedish_list"), "sv_id", table(spark, d, "french_list"), "fr_id"


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return matching.match_records(*_lists(spark, d)).select("sv_id", "fr_id")


def p1_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of classes by their first records, with the number of records in each."""
    return matching.match_classes(*_lists(spark, d))[0].select(F.col("first1").alias("sv_id"), F.col("first2").alias("fr_id"), "n1", "n2", "rule", "confidence")


def _copies(spark: SparkSession, d: str) -> DataFrame:
    return copies.hidden_copies(table(spark, d, "nl_es_pair"), "pair_id", ["dutch_lemma", "spanish_lemma", "pos"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _copies(spark, d).where("pair_id <> first_id").select("first_id", "pair_id")


def p4_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return copies.collapsed(_copies(spark, d))


P6 = ["arabic_lemma", "german_lemma", "french_lemma", "chinese_lemma"]


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return looks.look_alikes(table(spark, d, "concept_wide"), "row_id", P6, ["pos"]).where("row_id <> first_id").select("first_id", "row_id")


def p6_text(spark: SparkSession, d: str) -> DataFrame:
    return looks.normalise_looks(table(spark, d, "concept_wide").select("row_id", *P6, "pos"), P6)


def _survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "dedupe_copy"), table(spark, d, "origin_trust"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _survivors(spark, d).select("first_id", "kept_level", F.col("kept_english_lemma").alias("kept_english"), "conflict")


def p7_records(spark: SparkSession, d: str) -> DataFrame:
    return _survivors(spark, d)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_texts(table(spark, d, "documents"), "doc_id", "text")


def p8_offsets(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_texts(table(spark, d, "documents"), "doc_id", "text", offsets=True)


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    return fill.pack_documents(table(spark, d, "documents"), table(spark, d, "pack_budget"))


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    return fill.fill_report(p9_containers(spark, d), table(spark, d, "pack_budget"))


def _languages(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return langid.detect_languages(docs, *langid.train(docs, table(spark, d, "language_profile")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.mislabelled(_languages(spark, d))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    return _languages(spark, d).select("doc_id", "lang", "confidence", "ambiguous", F.explode_outer("segments").alias("s")).select("doc_id", "lang", "confidence", "ambiguous", F.col("s.start").alias("seg_start"), F.col("s.end").alias("seg_end"), F.col("s.lang").alias("seg_lang"), F.col("s.confidence").alias("seg_confidence"))


QUERIES = {f.__name__: f for f in (p1_found, p1_pairs, p4_found, p4_collapsed, p6_found, p6_text, p7_found, p7_records, p8_ids, p8_offsets, p9_containers, p9_fill, p10_found, p10_segments)}

_P4 = """
WITH v AS (
  SELECT pair_id, list_sort([regexp_replace(lower(nfc_normalize(coalesce(x, ''))), '[^\\p{L}\\p{N}\\p{M}]', '', 'g') FOR x IN [dutch_lemma, spanish_lemma, pos]]) AS k FROM nl_es_pair),
g AS (SELECT pair_id, min(pair_id) OVER (PARTITION BY k) AS first_id, count(*) OVER (PARTITION BY k) AS n_copies FROM v)
"""
_USABLE = """CASE WHEN trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', ' ', 'g')) NOT IN ('', {1}) THEN trim({0}) END"""
_P7 = f"""
WITH s AS (
  SELECT d.*, coalesce(trust, -2147483648) AS t, {_USABLE.format("english_lemma", ", ".join(f"'{x}'" for x in survivor.STAND_INS))} AS g, CASE WHEN upper(trim(level)) IN ('A1', 'A2', 'B1', 'B2', 'C1') THEN upper(trim(level)) END AS lv
  FROM dedupe_copy d LEFT JOIN origin_trust o ON d.origin = o.origin),
b AS (
  SELECT lang, lemma, upos, count(*) AS n, min(copy_id) AS first_id, min(lv) AS kept_level, count(DISTINCT lower(g)) AS k,
    first(g ORDER BY g IS NULL, t DESC, updated_at DESC NULLS LAST, copy_id) AS kept_english
  FROM s GROUP BY ALL)
SELECT first_id, kept_level, kept_english, CASE WHEN k > 1 THEN 'yes' ELSE 'no' END AS conflict FROM b WHERE n > 1
"""
# layers: the longest chain of candidates of which each dominates the next
_P7_ALL = _P7.split("SELECT first_id, kept_level")[0].replace("WITH s AS", "WITH RECURSIVE s0 AS", 1).replace("FROM s GROUP BY ALL", "FROM s0 GROUP BY ALL") + f""",
s AS (SELECT *, {_USABLE.format("chinese_lemma", ", ".join(f"'{x}'" for x in survivor.STAND_INS))} AS z, coalesce(updated_at, TIMESTAMP '0001-01-01') AS moment FROM s0),
m AS (SELECT lang, lemma, upos, t, g IS NOT NULL AS hg, z IS NOT NULL AS hz, max({{'moment': moment, 'id': -copy_id}}) AS r FROM s GROUP BY ALL),
d AS (SELECT a AS a, b AS b FROM m a JOIN m b ON a.lang IS NOT DISTINCT FROM b.lang AND a.lemma IS NOT DISTINCT FROM b.lemma AND a.upos IS NOT DISTINCT FROM b.upos AND a <> b AND a.t >= b.t AND a.hg >= b.hg AND a.hz >= b.hz AND a.r >= b.r),
chain(x, n) AS (SELECT m, 1 FROM m UNION SELECT d.b, n + 1 FROM chain JOIN d ON d.a = chain.x),
layer AS (SELECT x, max(n) AS n FROM chain GROUP BY x),
k AS (SELECT x.lang AS lang, x.lemma AS lemma, x.upos AS upos, count(*) FILTER (n = 1) AS skyline, max(n) AS layers FROM layer GROUP BY ALL),
c AS (SELECT lang, lemma, upos, first(z ORDER BY z IS NULL, t DESC, updated_at DESC NULLS LAST, copy_id) AS kept_chinese_lemma FROM s GROUP BY ALL)
SELECT b.lang, b.lemma, b.upos, first_id, b.n AS n_copies, kept_level, kept_english AS kept_english_lemma, kept_chinese_lemma, CAST(skyline AS INT) AS skyline, CAST(layers AS INT) AS layers, CASE WHEN b.k > 1 THEN 'yes' ELSE 'no' END AS conflict
FROM b JOIN c ON b.lang IS NOT DISTINCT FROM c.lang AND b.lemma IS NOT DISTINCT FROM c.lemma AND b.upos IS NOT DISTINCT FROM c.upos
JOIN k ON b.lang IS NOT DISTINCT FROM k.lang AND b.lemma IS NOT DISTINCT FROM k.lemma AND b.upos IS NOT DISTINCT FROM k.upos WHERE b.n > 1
"""
SQL = {
    "p4_found": _P4 + "SELECT first_id, pair_id FROM g WHERE pair_id <> first_id",
    "p4_collapsed": _P4 + "SELECT first_id, max(n_copies) AS n_copies FROM g GROUP BY first_id",
    "p7_found": _P7,
    "p7_records": _P7_ALL,
}
