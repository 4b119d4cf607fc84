"""Queries of the contract, alignment and quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradelex.functions import rules
from gradelex.functions.text import strip_ws
from gradelex.operators import align, contract, quality, reports
from gradelex.plans.base import LEVEL_LIST, Registry, entries, level_no, norm, with_entry
from gradelex.session import table

R = Registry()
QUERIES, SQL = R.queries, R.sql

_JUNK = ", ".join(f"'{x}'" for x in rules.JUNK_LEMMAS)
_PREFIX = " OR ".join(f"starts_with(lower(trim(lemma)), '{p}')" for p in rules.FUNCTION_PREFIXES)
# short words of the independent Swedish and French lists stand for cognates, a parameter of the script check
_COGNATES = "SELECT 'sv', lower(trim(swedish_lemma)) FROM swedish_list WHERE length(trim(swedish_lemma)) < 5 UNION SELECT 'fr', lower(trim(french_lemma)) FROM french_list WHERE length(trim(french_lemma)) < 5"


def _cognates(spark, d):
    short = lambda name, lang, c: table(spark, d, name).where(F.length(F.trim(c)) < 5).select(F.lit(lang).alias("lang"), F.lower(F.trim(c)).alias("word"))
    return short("swedish_list", "sv", "swedish_lemma").unionByName(short("french_list", "fr", "french_lemma")).distinct()


@R.add("norm_gloss", with_entry(f"SELECT ord, {norm('english')} AS gloss_norm, CAST(len(list_filter(string_split_regex(english, '\\s+'), lambda w: w <> '')) AS BIGINT) AS words, regexp_matches(english, '^[A-Za-z ''.-]+$') AS is_ascii FROM entry"))
def norm_gloss(spark, d):
    e = F.col("english")
    return entries(spark, d).select("ord", rules.norm_gloss(e).alias("gloss_norm"), rules.word_count(e).alias("words"), rules.ascii_gloss(e).alias("is_ascii"))


@R.add("norm_pivot", with_entry("SELECT ord, trim(replace(chinese, ' ', '')) AS pivot, coalesce(nullif(" + norm("english") + ", ''), 'blank') || '-' || coalesce(nullif(pos, ''), 'X') AS concept_key FROM entry"))
def norm_pivot(spark, d):
    return entries(spark, d).select("ord", rules.norm_pivot(F.col("chinese")).alias("pivot"), rules.concept_key(F.col("english"), F.col("pos")).alias("concept_key"))


# White_Space of Unicode, which RE2's \\s does not cover, and the separator controls
_SPACE = "[\\t-\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
_STRIP = lambda c: f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


@R.add("clean_text", f"SELECT raw_id, CASE WHEN starts_with(t, '\"') AND ends_with(t, '\"') THEN replace(substring(t, 2, greatest(length(t) - 2, 0)), '\"\"', '\"') ELSE t END AS unquoted, {_STRIP("translate(replace(raw_text, chr(34), ''), chr(9) || chr(13), '  ')")} AS clean FROM (SELECT *, {_STRIP('raw_text')} AS t FROM raw_line)")
def clean_text(spark, d):
    r = F.col("raw_text")
    return table(spark, d, "raw_line").select("raw_id", rules.unquote(r).alias("unquoted"), rules.clean_lemma(r).alias("clean"))


@R.add("clean_gloss", with_entry("SELECT ord, trim(regexp_replace(regexp_replace(strip_accents(english), '[()/]', ' ', 'g'), '\\s+', ' ', 'g')) AS gloss FROM entry"))
def clean_gloss(spark, d):
    return entries(spark, d).select("ord", rules.clean_gloss(F.col("english")).alias("gloss"))


_COVER = (
    f"k AS (SELECT lang, pos, lemma, {norm('english')} AS g FROM entry), i AS (SELECT lang, g, pos, count(*) AS n, count(DISTINCT lemma) AS k FROM k WHERE g <> '' GROUP BY ALL), t AS (SELECT lang, count(*) AS total FROM k GROUP BY ALL)",
    "h AS (SELECT s.lang AS source, t.lang AS target, sum(CASE WHEN t.k = 1 THEN s.n ELSE 0 END) AS uniq, sum(CASE WHEN t.k > 1 THEN s.n ELSE 0 END) AS ambiguous FROM i s JOIN i t ON s.g = t.g AND s.pos = t.pos AND s.lang <> t.lang GROUP BY ALL)",
    "c AS (SELECT a.lang AS source, b.lang AS target, CAST(coalesce(uniq, 0) AS BIGINT) AS uniq, CAST(coalesce(ambiguous, 0) AS BIGINT) AS ambiguous, CAST(a.total - coalesce(uniq, 0) - coalesce(ambiguous, 0) AS BIGINT) AS none, coalesce(uniq, 0)::DOUBLE / a.total AS ratio FROM t a JOIN t b ON a.lang <> b.lang LEFT JOIN h ON h.source = a.lang AND h.target = b.lang)",
)


@R.add("pair_coverage", with_entry("SELECT * FROM c", *_COVER))
def pair_coverage(spark, d):
    return contract.pair_coverage(entries(spark, d))


@R.add("coverage_gate", with_entry("SELECT *, CASE WHEN ratio >= 0.6 THEN 'OK' ELSE 'LOW' END AS status FROM c", *_COVER))
def coverage_gate(spark, d):
    return contract.coverage_gate(entries(spark, d))


_DUP = f"SELECT lang, lemma, {norm('english')} AS gloss_norm, count(*) AS n FROM entry GROUP BY ALL HAVING count(*) > 1"


@R.add("dup_keys", with_entry(_DUP))
def dup_keys(spark, d):
    return contract.duplicate_keys(entries(spark, d))


# the line within ten stands for a rank, so that groups with several firsts and with none exist
_RANKED = "ranked AS (SELECT *, line % 10 AS rank FROM entry)"
_GAPS = f"SELECT lang, {norm('english')} AS gloss_norm, pos, CAST(sum(CASE WHEN rank = 1 THEN 1 ELSE 0 END) AS BIGINT) AS firsts FROM ranked GROUP BY ALL HAVING sum(CASE WHEN rank = 1 THEN 1 ELSE 0 END) <> 1"


def _ranked(df):
    return df.withColumn("rank", F.col("line") % 10)


@R.add("rank_gaps", with_entry(_GAPS, _RANKED))
def rank_gaps(spark, d):
    return contract.rank_gaps(_ranked(entries(spark, d)))


# a delivery whose glosses lose all but their first word
_SHORT = "del AS (SELECT lang, lemma, pos, split_part(trim(english), ' ', 1) AS english FROM entry)"
_SHRUNK = "SELECT del.lang, del.lemma, del.english FROM del WHERE len(list_filter(string_split(english, ' '), lambda w: w <> '')) = 1 AND EXISTS (SELECT 1 FROM entry s WHERE s.lang = del.lang AND s.lemma = del.lemma AND len(list_filter(string_split(s.english, ' '), lambda w: w <> '')) > 1) AND NOT EXISTS (SELECT 1 FROM entry s WHERE s.lang = del.lang AND s.lemma = del.lemma AND s.english = del.english)"


def _short(spark, d):
    return entries(spark, d).withColumn("english", F.split_part(F.trim("english"), F.lit(" "), F.lit(1)))


@R.add("shrunken_gloss", with_entry(_SHRUNK, _SHORT))
def shrunken_gloss(spark, d):
    return contract.shrunken_glosses(_short(spark, d), entries(spark, d))


@R.add("gloss_ascii", with_entry("SELECT lang, lemma, english FROM entry WHERE NOT regexp_matches(english, '^[A-Za-z ''.-]+$')"))
def gloss_ascii(spark, d):
    return contract.non_ascii_glosses(entries(spark, d))


_SCRIPT = f"""SELECT lang, lemma, english, code FROM (SELECT *, CASE WHEN trim(lemma) = '' THEN 'empty_lemma' WHEN trim(lemma) IN ({_JUNK}) THEN 'junk_lemma'
  WHEN lang = 'ar' THEN CASE WHEN regexp_matches(lemma, '\\p{{L}}') AND NOT regexp_matches(lemma, '[\\x{{0600}}-\\x{{06FF}}\\x{{0750}}-\\x{{077F}}\\x{{08A0}}-\\x{{08FF}}]') THEN 'non_arabic_script' END
  WHEN lang = 'zh' THEN CASE WHEN regexp_matches(lemma, '\\p{{L}}') AND NOT regexp_matches(lemma, '[\\x{{4E00}}-\\x{{9FFF}}\\x{{3400}}-\\x{{4DBF}}]') THEN 'non_chinese_script' END
  WHEN lang = 'en' THEN NULL
  WHEN ({norm('trim(lemma)')} = {norm('english')} OR lower(trim(lemma)) = lower(english)) AND (lang, lower(trim(lemma))) NOT IN (SELECT (a, b) FROM ({_COGNATES}) t(a, b)) AND (lang, {norm('trim(lemma)')}) NOT IN (SELECT (a, b) FROM ({_COGNATES}) t(a, b)) THEN 'ungrounded_gloss_copy'
  WHEN {_PREFIX} THEN 'english_function_prefix_copy' END AS code FROM entry) WHERE code IS NOT NULL"""


@R.add("script_substance", with_entry(_SCRIPT))
def script_substance(spark, d):
    return contract.script_and_substance(entries(spark, d), _cognates(spark, d))


_COUNT = lambda name, body: f"SELECT '{name}' AS criterion, count(*) AS violations FROM ({body})"


@R.add(
    "contract_report",
    with_entry(
        " UNION ALL ".join(
            [
                _COUNT("1_shrunken", _SHRUNK), _COUNT("2_duplicates", _DUP.replace("FROM entry", "FROM short")), _COUNT("3_rank_gaps", _GAPS), _COUNT("4_coverage", "SELECT * FROM c WHERE ratio < 0.6"),
                _COUNT("5_ascii", "SELECT 1 FROM short WHERE NOT regexp_matches(english, '^[A-Za-z ''.-]+$')"), _COUNT("6_script", _SCRIPT.replace("FROM entry", "FROM short")),
            ]
        ),
        "short AS (SELECT * REPLACE (split_part(trim(english), ' ', 1) AS english) FROM entry)", _RANKED.replace("FROM entry", "FROM short"), *(x.replace("FROM entry", "FROM short") for x in _COVER), _SHORT,
    ),
)
def contract_report(spark, d):
    """Source: the entries; delivery: the same with one-word glosses."""
    return contract.contract_report(_ranked(_short(spark, d)), entries(spark, d), _cognates(spark, d))


_ASCII_BAD = "SELECT lang, lemma, english FROM entry WHERE NOT regexp_matches(english, '^[A-Za-z ''.-]+$')"


@R.add("baseline_report", with_entry(f"SELECT '2_duplicates' AS criterion, 'all' AS subject, count(*) AS value, 0::BIGINT AS base FROM ({_DUP}) UNION ALL SELECT '4_coverage', source || '->' || target, uniq, uniq + ambiguous + none FROM c UNION ALL SELECT '5_ascii', 'all', count(*), 0 FROM ({_ASCII_BAD})", *_COVER))
def baseline_report(spark, d):
    return contract.baseline_report(entries(spark, d))


@R.add("first_violations", with_entry(f"(SELECT '1_shrunken' AS criterion, lang, lemma, english FROM ({_SHRUNK}) ORDER BY lang, lemma, english LIMIT 20) UNION ALL (SELECT '5_ascii', * FROM ({_ASCII_BAD}) ORDER BY lang, lemma, english LIMIT 20)", _SHORT))
def first_violations(spark, d):
    """The first twenty of a criterion, as a report shows them."""
    parts = {"1_shrunken": contract.shrunken_glosses(_short(spark, d), entries(spark, d)), "5_ascii": contract.non_ascii_glosses(entries(spark, d))}
    return reports.first_of(parts, ["lang", "lemma", "english"], 20)


_ALIGN = (
    f"k AS (SELECT *, {norm('english')} AS ek, trim(replace(chinese, ' ', '')) AS ck FROM entry), an AS (SELECT ck, pos, arg_min(ek, ord) AS anchor FROM k WHERE ek <> '' AND ck <> '' GROUP BY ALL)",
    "al AS (SELECT k.*, CASE WHEN ek <> '' THEN 'e' || chr(31) || ek || chr(31) || k.pos WHEN anchor IS NOT NULL THEN 'e' || chr(31) || anchor || chr(31) || k.pos ELSE 's:' || ord END AS cid FROM k LEFT JOIN an ON k.ck = an.ck AND k.pos = an.pos AND k.ek = '')",
    "ac AS (SELECT *, min(ord) OVER (PARTITION BY cid) AS concept_ord FROM al)",
)
_CANON = (
    "gc AS (SELECT cid, english, count(*) AS n, min(ord) AS o, regexp_matches(english, '^[A-Za-z ''.-]+$') AS good, contains(english, ' ') AS multi FROM ac GROUP BY ALL)",
    "cg AS (SELECT cid, coalesce(first(english ORDER BY multi DESC, n DESC, o) FILTER (good), '') AS gloss FROM gc GROUP BY ALL)",
)


@R.add("concept_align", with_entry("SELECT ord, cid, concept_ord FROM ac", *_ALIGN))
def concept_align(spark, d):
    return align.align_concepts(entries(spark, d)).select("ord", "cid", "concept_ord")


@R.add("canonical_gloss", with_entry("SELECT * FROM cg", *_ALIGN, *_CANON))
def canonical_gloss(spark, d):
    return align.canonical_glosses(align.align_concepts(entries(spark, d)))


_DELIVERY = (
    *_ALIGN,
    *_CANON,
    f"pl AS (SELECT cid, concept_ord, lang, lemma, pos, min({level_no('level')}) AS li, min(ord) AS lo FROM ac GROUP BY ALL)",
    f"dd AS (SELECT pl.*, gloss, [{LEVEL_LIST}][li] AS cefr FROM pl JOIN cg USING (cid) QUALIFY row_number() OVER (PARTITION BY lang, lemma, {norm('gloss')} ORDER BY li, concept_ord, lo) = 1)",
    f"dr AS (SELECT lang, lemma, pos, gloss AS english_gloss, pos AS english_pos, cefr, row_number() OVER (PARTITION BY lang, gloss, pos ORDER BY lemma) AS rank, coalesce(nullif({norm('gloss')}, ''), 'blank') || '-' || coalesce(nullif(pos, ''), 'X') AS concept_key FROM dd)",
)


@R.add("delivery_rows", with_entry("SELECT * FROM dr", *_DELIVERY))
def delivery_rows(spark, d):
    return align.delivery_rows(entries(spark, d))


@R.add("delivery_counts", with_entry("SELECT lang, count(*) AS n_rows FROM dr GROUP BY ALL", *_DELIVERY))
def delivery_counts(spark, d):
    return align.delivery_counts(align.delivery_rows(entries(spark, d)))


_ISSUES = """iss AS (SELECT lang, level, ord, unnest(CASE WHEN trim(lemma) = '' THEN ['empty_lemma'] ELSE list_filter([
  CASE WHEN trim(lemma) <> lemma THEN 'lemma_edge_space' END, CASE WHEN contains(trim(lemma), ' ') THEN 'multi_word' END,
  CASE WHEN regexp_matches(lemma, '[0-9]') AND NOT regexp_full_match(trim(lemma), '(?i)([0-9]|[0-9]+e|[0-9]+de|[0-9]+ste|[0-9]+g|co2|3d|.*打印)') THEN 'digits' END,
  CASE WHEN regexp_matches(lemma, '[?!@#$%^&*()_=+\\[\\]{};:"\\\\|<>~`]') THEN 'special_chars' END,
  CASE WHEN trim(english) = '' THEN 'missing_t1' WHEN trim(english) <> english THEN 't1_edge_space' END,
  CASE WHEN trim(chinese) = '' THEN 'missing_t2' WHEN trim(chinese) <> chinese THEN 't2_edge_space' END], lambda x: x IS NOT NULL) END) AS code FROM entry)"""


@R.add("row_issues", with_entry("SELECT *, code = 'missing_t2' AS is_warning FROM iss", _ISSUES))
def row_issues(spark, d):
    return quality.row_issues(entries(spark, d))


_QK = f"q AS (SELECT *, lower(trim(lemma)) AS kl, trim(coalesce(nullif(pos, ''), 'X')) AS key_pos, {level_no('level')} AS li FROM entry WHERE trim(lemma) <> '')"
_INTRA = "SELECT lang, level, ord, lemma, key_pos FROM q QUALIFY row_number() OVER (PARTITION BY lang, level, kl, key_pos ORDER BY ord) > 1"
_CROSS = f"SELECT lang, level, ord, lemma, key_pos, [{LEVEL_LIST}][m] AS first_level FROM (SELECT *, min(li) OVER (PARTITION BY lang, kl, key_pos) AS m FROM q) WHERE li > m"


@R.add("intra_dup", with_entry(_INTRA, _QK))
def intra_dup(spark, d):
    return quality.level_duplicates(entries(spark, d))


@R.add("cross_dup", with_entry(_CROSS, _QK))
def cross_dup(spark, d):
    return quality.cross_level_duplicates(entries(spark, d))


_TARGETS = "t(level, target) AS (VALUES ('A1', 600::BIGINT), ('A2', 600), ('B1', 1000), ('B2', 2000), ('C1', 4000))"
_LC = "SELECT lang, level, n_rows, target, n_rows - target AS delta, CASE WHEN abs(n_rows - target) <= target * {} THEN 'OK' ELSE 'OFF' END AS status FROM (SELECT lang, level, count(*) AS n_rows FROM entry GROUP BY ALL) JOIN t USING (level)"


@R.add("level_counts", with_entry(_LC.format(0.05), _TARGETS))
def level_counts(spark, d):
    return quality.level_counts(entries(spark, d))


@R.add("exact_target", with_entry(_LC.format(0), _TARGETS))
def exact_target(spark, d):
    return quality.level_counts(entries(spark, d), 0.0)


@R.add("shared_translations", with_entry("SELECT lang, level, x AS translation, count(DISTINCT lemma) AS n_lemmas FROM (SELECT lang, level, trim(lemma) AS lemma, unnest(list_distinct([lower(trim(english)), lower(trim(chinese))])) AS x FROM entry) WHERE x <> '' AND lemma <> '' GROUP BY ALL HAVING count(DISTINCT lemma) > 1"))
def shared_translations(spark, d):
    return quality.shared_translations(entries(spark, d))


@R.add("issue_totals", with_entry(f"SELECT lang, CAST(sum(n) AS BIGINT) AS issues, CASE WHEN sum(n) > 0 THEN 1 ELSE 0 END AS exit_code FROM (SELECT lang, count(*) AS n FROM iss WHERE code <> 'missing_t2' GROUP BY ALL UNION ALL SELECT lang, count(*) FROM ({_INTRA}) GROUP BY ALL UNION ALL SELECT lang, count(*) FROM ({_CROSS}) GROUP BY ALL UNION ALL SELECT DISTINCT lang, 0 FROM entry) GROUP BY ALL", _ISSUES, _QK))
def issue_totals(spark, d):
    return quality.issue_totals(entries(spark, d))


@R.add("pos_rules", with_entry("SELECT ord, CASE WHEN pos IN ('VERB', 'AUX') THEN 'V' WHEN pos IN ('NOUN', 'PROPN') THEN 'N' ELSE pos END AS coarse, CASE WHEN starts_with(lower(trim(english)), 'to ') THEN 'VERB' WHEN regexp_matches(lower(trim(english)), '-(ed|ing|ous|ish)$') THEN 'ADJ' ELSE '' END AS by_gloss, regexp_matches(lemma, '^(Word_|svord_|word_)') AS placeholder, lang <> 'zh' AND regexp_matches(chinese, '[A-Za-z]') AND NOT regexp_matches(chinese, '[\\x{4e00}-\\x{9fff}]') AS latin FROM entry"))
def pos_rules(spark, d):
    return entries(spark, d).select("ord", rules.coarse_pos(F.col("pos")).alias("coarse"), rules.gloss_pos(F.col("english")).alias("by_gloss"), rules.placeholder(F.col("lemma")).alias("placeholder"), rules.latin_pivot(F.col("lang"), F.col("chinese")).alias("latin"))


@R.add("blank_gloss_rows", with_entry("SELECT lang, level, list_id, line, ord, lemma, pos FROM entry WHERE trim(english) = ''"))
def blank_gloss_rows(spark, d):
    e = entries(spark, d)
    return e.where(strip_ws(F.col("english")) == "").select("lang", "level", "list_id", "line", "ord", "lemma", "pos")
