"""Queries of the de-duplication, editing and gate operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradelex.functions.text import strip_ws
from gradelex.operators import dedupe, gates, manage
from gradelex.plans.base import LEVEL_LIST, UPOS_LIST, Registry, entries, level_no, with_entry
from gradelex.session import table

R = Registry()
QUERIES, SQL = R.queries, R.sql

_K = "k AS (SELECT *, lower(trim(lemma)) AS kl, trim(pos) AS kp FROM entry)"
_EX = "ex AS (SELECT lang, level, list_id, ord, line, lemma, english, chinese, pos FROM k QUALIFY row_number() OVER (PARTITION BY lang, level, kl, kp ORDER BY ord) = 1)"
_PL = "SELECT a.* FROM {0} a WHERE lang = 'en' AND lower(trim(lemma)) LIKE '%s' AND lower(trim(lemma)) NOT LIKE '%ss' AND length(trim(lemma)) > 3 AND EXISTS (SELECT 1 FROM {0} b WHERE b.lang = 'en' AND b.level = a.level AND lower(trim(b.lemma)) || 's' = lower(trim(a.lemma)))"


# the lemmas of all lists, and the last words of the French list's glosses, some of which are plural or mistyped
_WORDS = "gw AS (SELECT lang, level, ord, lemma, pos FROM entry UNION ALL SELECT 'en', coalesce(level, ''), fr_id, coalesce(regexp_extract(lower(english_lemma), '([a-z]+)$', 1), ''), coalesce(pos, '') FROM french_list)"


def _words(spark, d):
    glosses = table(spark, d, "french_list").select(F.lit("en").alias("lang"), F.coalesce("level", F.lit("")).alias("level"), F.col("fr_id").alias("ord"), F.coalesce(F.regexp_extract(F.lower("english_lemma"), "([a-z]+)$", 1), F.lit("")).alias("lemma"), F.coalesce("pos", F.lit("")).alias("pos"))
    return entries(spark, d).select("lang", "level", "ord", "lemma", "pos").unionByName(glosses)


@R.add("exact_dedupe", with_entry("SELECT * FROM ex", _K, _EX))
def exact_dedupe(spark, d):
    return dedupe.exact_dedupe(entries(spark, d))


@R.add("plural_removal", with_entry(_PL.format("gw"), _WORDS))
def plural_removal(spark, d):
    return dedupe.plural_duplicates(_words(spark, d))


@R.add("fast_cleanup", with_entry(f"SELECT lang, before - after AS exact_removed, coalesce(p, 0) AS plural_removed FROM (SELECT lang, count(*) AS before FROM entry GROUP BY ALL) JOIN (SELECT lang, count(*) AS after FROM ex GROUP BY ALL) USING (lang) LEFT JOIN (SELECT lang, count(*) AS p FROM ({_PL.format('ex')}) GROUP BY ALL) USING (lang)", _K, _EX))
def fast_cleanup(spark, d):
    return dedupe.fast_cleanup(entries(spark, d))


@R.add(
    "inflection_audit",
    with_entry(
        "SELECT lang, kl AS lemma, kind, base FROM (SELECT lang, kl, kind, left(kl, length(kl) - CASE kind WHEN 'plural' THEN 1 WHEN 'gerund' THEN 3 ELSE 2 END) AS base FROM (SELECT *, CASE WHEN kl LIKE '%s' AND kl NOT LIKE '%ss' THEN 'plural' WHEN kl LIKE '%ing' THEN 'gerund' WHEN kl LIKE '%ed' AND length(kl) > 3 THEN 'past' END AS kind FROM w) WHERE kind IS NOT NULL) c WHERE EXISTS (SELECT 1 FROM w WHERE w.lang = c.lang AND w.kl = c.base)",
        _WORDS, "w AS (SELECT DISTINCT lang, lemma AS kl FROM gw)",
    ),
)
def inflection_audit(spark, d):
    return dedupe.inflection_candidates(_words(spark, d))


# a stand-in for a morphological tagger: the base is the lemma without a final s, the tag the row's own
_TAG = "tg AS (SELECT *, regexp_replace(lower(lemma), 's$', '') AS base, pos AS upos, CASE WHEN pos IN ('VERB', 'AUX') THEN 'V' WHEN pos IN ('NOUN', 'PROPN') THEN 'N' ELSE pos END AS coarse FROM gw)"


def _tagged(spark, d):
    return _words(spark, d).withColumns({"base": F.regexp_replace(F.lower("lemma"), "s$", ""), "upos": F.col("pos")})


@R.add("inflection_cluster", with_entry("SELECT lang, ord, lemma, coarse FROM (SELECT *, count(*) OVER w AS n, sum(CASE WHEN base = lower(lemma) THEN 1 ELSE 0 END) OVER w AS s FROM tg WINDOW w AS (PARTITION BY lang, coarse, base)) WHERE n > 1 AND s = 1 AND base <> lower(lemma)", _WORDS, _TAG))
def inflection_cluster(spark, d):
    return dedupe.inflected_clusters(_tagged(spark, d))


# at most one letter put in, left out or changed
_NEAR = "(a.base = c.l OR (len(a.base) = len(c.l) AND len(list_filter(range(1, len(a.base) + 1), lambda i: left(a.base, i - 1) = left(c.l, i - 1) AND substr(a.base, i + 1) = substr(c.l, i + 1))) > 0) OR (len(a.base) = len(c.l) + 1 AND len(list_filter(range(1, len(a.base) + 1), lambda i: left(a.base, i - 1) || substr(a.base, i + 1) = c.l)) > 0) OR (len(a.base) + 1 = len(c.l) AND len(list_filter(range(1, len(c.l) + 1), lambda i: left(c.l, i - 1) || substr(c.l, i + 1) = a.base)) > 0))"
_FUZZY = f"fz AS (SELECT DISTINCT a.lang, a.ord, a.lemma, a.coarse FROM (SELECT *, lower(lemma) AS l, count(*) OVER (PARTITION BY lang, coarse, base) AS n FROM tg WHERE lemma <> '') a JOIN (SELECT DISTINCT lang, coarse, lower(lemma) AS l FROM tg WHERE lemma <> '' AND base = lower(lemma)) c ON a.lang = c.lang AND a.coarse = c.coarse AND {_NEAR} WHERE a.n = 1 AND a.base <> a.l)"


@R.add("fuzzy_singleton", with_entry("SELECT * FROM fz", _WORDS, _TAG, _FUZZY))
def fuzzy_singleton(spark, d):
    return dedupe.fuzzy_singletons(_tagged(spark, d))


_CLUSTER = "cu AS (SELECT lang, ord FROM (SELECT *, count(*) OVER w AS n, sum(CASE WHEN base = lower(lemma) THEN 1 ELSE 0 END) OVER w AS s FROM tg WINDOW w AS (PARTITION BY lang, coarse, base)) WHERE n > 1 AND s = 1 AND base <> lower(lemma))"


@R.add("without_inflected", with_entry("SELECT lang, ord, lemma FROM gw WHERE lang NOT IN ('en', 'de', 'es', 'fr', 'sv', 'nl') OR (ord NOT IN (SELECT ord FROM cu) AND ord NOT IN (SELECT ord FROM fz))", _WORDS, _TAG, _CLUSTER, _FUZZY))
def without_inflected(spark, d):
    tag = lambda df: df.withColumns({"base": F.regexp_replace(F.lower("lemma"), "s$", ""), "upos": F.col("pos")})
    return dedupe.without_inflected(_words(spark, d), tag).select("lang", "ord", "lemma")


_T = "CASE level WHEN 'A1' THEN 600 WHEN 'A2' THEN 600 WHEN 'B1' THEN 1000 WHEN 'B2' THEN 2000 WHEN 'C1' THEN 4000 END"
_P = f"p AS (SELECT *, lower(trim(lemma)) AS kl, row_number() OVER (PARTITION BY list_id ORDER BY line, ord) - 1 >= {_T} AS over FROM entry)"
_RO = "ro AS (SELECT list_id, ord, lemma, pos FROM p WHERE over AND (list_id, kl) IN (SELECT (list_id, kl) FROM p WHERE NOT over))"
# a stand-in for a tagger, which knows German words by their first letter and ending and is unsure of all others
_TAGGER = "CASE WHEN lang = 'de' AND regexp_matches(lemma, '^[A-Z]') THEN 'NOUN' WHEN lang = 'de' AND regexp_matches(lemma, '[a-z]en$') THEN 'VERB' ELSE 'X' END"
_FIX = f"fix AS (SELECT * FROM (SELECT ord, CASE WHEN t <> 'X' THEN t WHEN starts_with(lower(trim(english)), 'to ') THEN 'VERB' WHEN regexp_matches(lower(trim(english)), '-(ed|ing|ous|ish)$') THEN 'ADJ' ELSE '' END AS new_pos, trim(pos) AS old_pos, lemma, CASE WHEN t <> 'X' THEN 'tagger' ELSE 'gloss' END AS reason FROM (SELECT *, {_TAGGER} AS t FROM entry)) WHERE new_pos <> '' AND old_pos <> '' AND new_pos <> old_pos AND trim(lemma) <> '')"


def _fixes(spark, d):
    german = F.col("lang") == "de"
    tag = F.when(german & F.col("lemma").rlike("^[A-Z]"), "NOUN").when(german & F.col("lemma").rlike(r"[a-z]en\z"), "VERB").otherwise("X")
    return dedupe.staged_pos_changes(entries(spark, d).withColumn("upos", tag))


@R.add("overflow_zone", with_entry("SELECT list_id, ord, lemma FROM p WHERE over", _P))
def overflow_zone(spark, d):
    return dedupe.overflow(entries(spark, d)).select("list_id", "ord", "lemma")


@R.add("redundant_overflow", with_entry("SELECT * FROM ro", _P, _RO))
def redundant_overflow(spark, d):
    return dedupe.redundant_overflow(entries(spark, d))


@R.add("pos_changes", with_entry("SELECT ord, lemma, old_pos, new_pos, reason FROM fix", _FIX))
def pos_changes(spark, d):
    return _fixes(spark, d)


@R.add("dedup_after_fix", with_entry(f"SELECT list_id, ord, lemma, np AS pos FROM (SELECT e.*, lower(trim(e.lemma)) AS kl, coalesce(fix.new_pos, trim(pos)) AS np FROM entry e LEFT JOIN fix USING (ord) WHERE list_id IN (SELECT list_id FROM entry GROUP BY list_id, level HAVING count(*) > {_T}) AND ord NOT IN (SELECT ord FROM ro)) QUALIFY row_number() OVER (PARTITION BY list_id, kl, np ORDER BY ord) > 1", _P, _RO, _FIX))
def dedup_after_fix(spark, d):
    e = entries(spark, d)
    return dedupe.duplicates_after_fix(e, _fixes(spark, d).select("ord", "new_pos"), dedupe.redundant_overflow(e).select("ord"))


_MOVES = "mv AS (SELECT ord, 'B1' AS new_level FROM p WHERE over AND level = 'A2')"


def _moves(spark, d):
    return dedupe.overflow(entries(spark, d)).where("level = 'A2'").select("ord", F.lit("B1").alias("new_level"))


@R.add("apply_changes", with_entry("SELECT e.ord, e.lang, coalesce(new_level, e.level) AS level, e.lemma, coalesce(new_pos, e.pos) AS pos FROM entry e LEFT JOIN fix USING (ord) LEFT JOIN mv USING (ord) WHERE new_level IS NOT NULL OR e.ord NOT IN (SELECT ord FROM p WHERE over AND (list_id, kl) IN (SELECT (list_id, lower(lemma)) FROM ro))", _P, _RO, _FIX, _MOVES))
def apply_changes(spark, d):
    e = entries(spark, d)
    return dedupe.apply_changes(e, _fixes(spark, d).select("ord", "new_pos"), _moves(spark, d), dedupe.redundant_overflow(e)).select("ord", "lang", "level", "lemma", "pos")


@R.add("projected_counts", with_entry("SELECT *, now - trimmed - moved_out + moved_in AS after FROM (SELECT lang, level, CAST(sum(a) AS BIGINT) AS now, CAST(sum(b) AS BIGINT) AS trimmed, CAST(sum(c) AS BIGINT) AS moved_out, CAST(sum(x) AS BIGINT) AS moved_in FROM (SELECT lang, level, 1 AS a, 0 AS b, 0 AS c, 0 AS x FROM entry UNION ALL SELECT lang, level, 0, 1, 0, 0 FROM entry JOIN ro USING (ord) UNION ALL SELECT lang, level, 0, 0, 1, 0 FROM entry JOIN mv USING (ord) UNION ALL SELECT lang, new_level, 0, 0, 0, 1 FROM entry JOIN mv USING (ord)) GROUP BY ALL)", _P, _RO, _MOVES))
def projected_counts(spark, d):
    e = entries(spark, d)
    return dedupe.projected_counts(e, _moves(spark, d), dedupe.redundant_overflow(e).select("ord"))


@R.add("room_check", with_entry("SELECT lang, new_level, coalesce(now, 0) AS now, coming, 1000 - coalesce(now, 0) AS room, coming > 1000 - coalesce(now, 0) AS blocked FROM (SELECT lang, new_level, count(*) AS coming FROM entry JOIN mv USING (ord) GROUP BY ALL) a LEFT JOIN (SELECT lang, level AS new_level, count(*) AS now FROM entry GROUP BY ALL) b USING (lang, new_level)", _P, _MOVES))
def room_check(spark, d):
    return dedupe.room_check(entries(spark, d), _moves(spark, d))


@R.add("cross_level_consolidate", with_entry(f"SELECT lang, kl AS lemma, kp AS pos, [{LEVEL_LIST}][lo] AS kept_level, kept_english, n - 1 AS removed, CASE WHEN g > 1 THEN 'yes' ELSE 'no' END AS conflict FROM (SELECT lang, kl, kp, min({level_no('level')}) AS lo, max({level_no('level')}) AS hi, first(english ORDER BY {level_no('level')}, ord) AS kept_english, count(*) AS n, count(DISTINCT lower(english)) AS g FROM k GROUP BY ALL) WHERE lo < hi", _K))
def cross_level_consolidate(spark, d):
    return dedupe.consolidate_levels(entries(spark, d))


@R.add("rank_bands", "SELECT p_partkey, CASE WHEN p_partkey < 1 THEN NULL WHEN p_partkey <= 600 THEN 'A1' WHEN p_partkey <= 1200 THEN 'A2' WHEN p_partkey <= 2200 THEN 'B1' WHEN p_partkey <= 4200 THEN 'B2' WHEN p_partkey <= 8200 THEN 'C1' END AS level FROM part")
def rank_bands(spark, d):
    return table(spark, d, "part").select("p_partkey", dedupe.level_of_rank(F.col("p_partkey")).alias("level"))


@R.add("change_report", with_entry("SELECT lang, ord, rn, greatest(n - 60, 0) AS more FROM (SELECT lang, ord, row_number() OVER (PARTITION BY lang ORDER BY ord) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM fix JOIN entry USING (ord)) WHERE rn <= 60", _FIX))
def change_report(spark, d):
    return dedupe.change_report(_fixes(spark, d).select("ord").join(entries(spark, d).select("ord", "lang"), "ord"))


# terms of the editing verbs: the lemmas of the independent Swedish and French lists
_SV = "sv AS (SELECT *, CASE WHEN length(tl) > 5 THEN tl || '*' END AS new_lemma FROM (SELECT 'sv' AS lang, lower(trim(swedish_lemma)) AS tl, min(english_lemma) AS new_english, max(chinese_lemma) AS new_chinese FROM swedish_list WHERE swedish_lemma IS NOT NULL GROUP BY ALL))"
_FR = "fr AS (SELECT DISTINCT 'fr' AS lang, lower(trim(french_lemma)) AS tl FROM french_list WHERE french_lemma IS NOT NULL)"


def _terms(spark, d, lang="sv"):
    name, col = {"sv": ("swedish_list", "swedish_lemma"), "fr": ("french_list", "french_lemma")}[lang]
    t = table(spark, d, name).where(F.col(col).isNotNull()).groupBy(F.lower(F.trim(col)).alias("lemma")).agg(F.min("english_lemma").alias("new_english"), F.max("chinese_lemma").alias("new_chinese"))
    return t.select(F.lit(lang).alias("lang"), "lemma", "new_english", "new_chinese", F.when(F.length("lemma") > 5, F.concat("lemma", F.lit("*"))).alias("new_lemma"))


@R.add("find", with_entry("SELECT DISTINCT e.lang, lower(lemma) AS lemma, level FROM entry e JOIN sv ON e.lang = sv.lang AND lower(e.lemma) = sv.tl", _SV))
def find(spark, d):
    return manage.find(entries(spark, d), _terms(spark, d).select("lang", "lemma"))


@R.add("lookup", with_entry("SELECT DISTINCT tl AS term, e.lang, level, ord FROM entry e JOIN sv ON tl IN (lower(lemma), lower(english), lower(chinese))", _SV))
def lookup(spark, d):
    return manage.lookup(entries(spark, d), _terms(spark, d).select(F.col("lemma").alias("term")))


@R.add("remove", with_entry("SELECT e.* FROM entry e WHERE NOT EXISTS (SELECT 1 FROM fr WHERE fr.lang = e.lang AND tl = lower(e.lemma))", _FR))
def remove(spark, d):
    return manage.remove(entries(spark, d), _terms(spark, d, "fr").select("lang", "lemma"))


_NAMED = f"nm AS (SELECT e.*, sv.new_english, sv.new_lemma, sv.new_chinese, {level_no('e.level')} AS li, row_number() OVER (PARTITION BY e.lang, lower(lemma) ORDER BY {level_no('e.level')}, ord) AS rn FROM entry e JOIN sv ON e.lang = sv.lang AND lower(e.lemma) = sv.tl)"


@R.add("move", with_entry("SELECT ord, CASE WHEN ord IN (SELECT ord FROM nm WHERE rn = 1 AND level <> 'C1') THEN 'C1' ELSE level END AS level, lang, lemma FROM entry WHERE ord NOT IN (SELECT ord FROM nm WHERE rn > 1 AND lower(lemma) IN (SELECT lower(lemma) FROM nm WHERE rn = 1 AND level <> 'C1'))", _SV, _NAMED))
def move(spark, d):
    return manage.move(entries(spark, d), _terms(spark, d).select("lang", "lemma", F.lit("C1").alias("to_level"))).select("ord", "level", "lang", "lemma")


@R.add("update", with_entry("SELECT e.ord, e.lang, e.level, coalesce(nm.new_lemma, e.lemma) AS lemma, coalesce(nm.new_english, e.english) AS english, coalesce(nm.new_chinese, e.chinese) AS chinese FROM entry e LEFT JOIN nm ON e.ord = nm.ord AND rn = 1", _SV, _NAMED))
def update(spark, d):
    return manage.update(entries(spark, d), _terms(spark, d)).select("ord", "lang", "level", "lemma", "english", "chinese")


_NEW = "nw AS (SELECT 'fr' AS lang, level, fr_id AS ord, french_lemma AS lemma FROM french_list), ap AS (SELECT ord, CASE WHEN trim(coalesce(lemma, '')) = '' THEN 'empty' WHEN contains(lemma, ' ') THEN 'contains space' WHEN (lang, lower(lemma)) IN (SELECT (lang, lower(lemma)) FROM entry) THEN 'duplicate' END AS problem FROM nw)"


def _new(spark, d):
    return table(spark, d, "french_list").select(F.lit("fr").alias("lang"), "level", F.lit("new").alias("list_id"), F.col("fr_id").alias("ord"), F.lit(None).cast("int").alias("line"), F.col("french_lemma").alias("lemma"), F.coalesce("english_lemma", F.lit("")).alias("english"), F.coalesce("chinese_lemma", F.lit("")).alias("chinese"), F.coalesce("pos", F.lit("")).alias("pos"))


@R.add("argument_problems", with_entry("SELECT ord, problem FROM ap WHERE problem IS NOT NULL", _NEW))
def argument_problems(spark, d):
    return manage.argument_problems(_new(spark, d), entries(spark, d))


@R.add("add", with_entry("SELECT ord, lang, lemma FROM entry UNION ALL SELECT min(ord), lang, first(lemma ORDER BY ord) FROM nw JOIN ap USING (ord) WHERE problem IS NULL GROUP BY lang, lower(lemma)", _NEW))
def add(spark, d):
    return manage.add(entries(spark, d), _new(spark, d)).select("ord", "lang", "lemma")


# rows under review: the entries, with a decision on their line where there is one
_FOLD = "lower(replace({0}, 'ß', 'ss'))"
_ACT = "act AS (SELECT e.*, coalesce(d.action, 'keep') AS action FROM entry e LEFT JOIN (SELECT list_id, line, max(action) AS action FROM review_decision WHERE list_id IS NOT NULL AND line IS NOT NULL GROUP BY ALL) d USING (list_id, line))"
_L, _E = _FOLD.format("lemma"), _FOLD.format("english")
_NFC_L, _NFC_E = _FOLD.format("nfc_normalize(lemma)"), _FOLD.format("nfc_normalize(english)")
_GATES = f"""gt AS (SELECT *, list_filter([CASE WHEN action = 'drop' THEN 'cefr.drop' END, CASE WHEN pos IN ('PROPN', 'PUNCT', 'SYM', 'X') THEN 'cefr.forbidden_upos' END, CASE WHEN regexp_matches(lemma, '[\\s\\p{{Z}}]') THEN 'cefr.lemma_whitespace' END,
  CASE WHEN nfc_normalize(lemma) <> lemma THEN 'cefr.lemma_not_nfc' END, CASE WHEN lang = 'de' AND pos = 'NOUN' AND NOT regexp_matches(lemma, '^\\p{{Lu}}') THEN 'german.noun_requires_uppercase' END,
  CASE WHEN lang = 'de' AND pos NOT IN ('NOUN', 'PROPN') AND regexp_matches(lemma, '^[A-Z]') THEN 'german.non_noun_capitalized' END, CASE WHEN lang = 'en' AND {_NFC_L} <> {_NFC_E} THEN 'english.citation_mismatch' END,
  CASE WHEN lang <> 'en' AND {_L} = {_E} THEN 'cefr.english_echo' END, CASE WHEN lang = 'de' AND pos = 'VERB' AND NOT lower(lemma) LIKE '%n' THEN 'german.verb_requires_infinitive' END,
  CASE WHEN lang = 'ar' AND NOT regexp_matches(lemma, '[\\x{{0600}}-\\x{{06FF}}\\x{{0750}}-\\x{{077F}}\\x{{08A0}}-\\x{{08FF}}]') THEN 'arabic.script_required' END,
  CASE WHEN lang = 'zh' AND NOT regexp_matches(lemma, '[\\x{{3400}}-\\x{{4DBF}}\\x{{4E00}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}]') THEN 'chinese.script_required' END], lambda x: x IS NOT NULL) AS issues FROM act)"""


def _acted(spark, d):
    dec = table(spark, d, "review_decision").where("list_id is not null and line is not null").groupBy("list_id", "line").agg(F.max("action").alias("action"))
    return entries(spark, d).join(dec, ["list_id", "line"], "left").withColumn("action", F.coalesce("action", F.lit("keep")))


@R.add("gate_issues", with_entry("SELECT ord, x AS code FROM gt, unnest(issues) AS u(x)", _ACT, _GATES))
def gate_issues(spark, d):
    return gates.gate_issues(_acted(spark, d)).select("ord", F.explode("issues").alias("code"))


@R.add("capitalise_nouns", with_entry("SELECT ord, CASE WHEN pos = 'NOUN' AND issues = ['german.noun_requires_uppercase'] THEN upper(left(lemma, 1)) || substring(lemma, 2) ELSE lemma END AS lemma FROM gt", _ACT, _GATES))
def capitalise_nouns(spark, d):
    return gates.capitalise_nouns(gates.gate_issues(_acted(spark, d))).select("ord", "lemma")


_DIFF = "lang = 'en' AND trim(lemma) <> '' AND trim(english) <> '' AND lower(trim(lemma)) <> lower(trim(english))"


@R.add("citation_form", with_entry(f"SELECT ord, CASE WHEN {_DIFF} THEN trim(english) ELSE lemma END AS lemma, CASE WHEN {_DIFF} AND action = 'keep' THEN 'fix' ELSE action END AS action FROM act", _ACT))
def citation_form(spark, d):
    return gates.citation_form(_acted(spark, d)).select("ord", "lemma", "action")


# English rows after taking the citation form of their gloss
_NE = f"ne AS (SELECT *, CASE WHEN rewritten THEN e ELSE l END AS form FROM (SELECT *, trim(nfc_normalize(lemma)) AS l, trim(nfc_normalize(english)) AS e, trim(english) <> '' AND {_FOLD.format('trim(nfc_normalize(lemma))')} <> {_FOLD.format('trim(nfc_normalize(english))')} AS rewritten FROM entry WHERE lang = 'en')), nk AS (SELECT * FROM ne QUALIFY row_number() OVER (PARTITION BY {_FOLD.format('form')}, pos ORDER BY ord) = 1)"


@R.add("normalise_english", with_entry("SELECT ord, level, form AS lemma, e AS english, pos FROM nk", _NE))
def normalise_english(spark, d):
    return gates.normalise_english(entries(spark, d))[0].select("ord", "level", "lemma", "english", "pos")


@R.add("normalise_counts", with_entry("SELECT count(*) AS rows_in, CAST(sum(CASE WHEN rewritten THEN 1 ELSE 0 END) AS BIGINT) AS rewritten, count(*) - (SELECT count(*) FROM nk) AS dropped_dupes, (SELECT count(*) FROM nk) AS rows_out FROM ne", _NE))
def normalise_counts(spark, d):
    return gates.normalise_english(entries(spark, d))[1]


#: a rule table over words of the test vocabulary, with a rule of each kind; real ones are given by the caller
RULES = (
    gates.Rule("drop", "by tag", ("نقل", "وصف"), ("whole",), tags=("VERB",)),
    gates.Rule("drop", "by other tag", ("حجر",), ("bare",), not_tags=("NOUN", "")),
    gates.Rule("ok", "allowed", ("باب", "بئر", "جبل")),
    gates.Rule("drop", "closed set", ("ثلج", "كتاب", "ساعة")),
    gates.Rule("drop", "clitic", ("تح", "رسي"), ("tail",)),
    gates.Rule("drop", "loan", shape=r"\A[؀-ۿ]{3,}ار\z", gloss_has=("train",)),
    gates.Rule("policy", "gloss", gloss_has=("market", "wind"), gloss_lacks=("window",)),
    gates.Rule("drop", "sense", ("صورة",), ("bare",), gloss=("picture", "image")),
)
_DIALECT = """dl AS (SELECT *, CASE WHEN lemma IN ('نقل', 'وصف') AND tag = 'VERB' THEN {'action': 'drop', 'reason': 'by tag'} WHEN lemma = 'حجر' AND tag NOT IN ('NOUN', '') THEN {'action': 'drop', 'reason': 'by other tag'}
  WHEN s IN ('باب', 'بئر', 'جبل') OR lemma IN ('باب', 'بئر', 'جبل') THEN NULL WHEN s IN ('ثلج', 'كتاب', 'ساعة') OR lemma IN ('ثلج', 'كتاب', 'ساعة') THEN {'action': 'drop', 'reason': 'closed set'}
  WHEN length(lemma) > 2 AND left(lemma, 1) IN ('ب', 'ف', 'ك') AND substring(lemma, 2) IN ('تح', 'رسي') THEN {'action': 'drop', 'reason': 'clitic'}
  WHEN regexp_full_match(lemma, '[\\x{0600}-\\x{06FF}]{3,}ار') AND contains(gloss, 'train') THEN {'action': 'drop', 'reason': 'loan'} WHEN (contains(gloss, 'market') OR contains(gloss, 'wind')) AND NOT contains(gloss, 'window') THEN {'action': 'policy', 'reason': 'gloss'}
  WHEN lemma = 'صورة' AND gloss IN ('picture', 'image') THEN {'action': 'drop', 'reason': 'sense'} END AS v
  FROM (SELECT *, upper(trim(pos)) AS tag, lower(trim(english)) AS gloss, CASE WHEN starts_with(lemma, 'ال') AND length(lemma) > 3 THEN substring(lemma, 3) ELSE lemma END AS s FROM (SELECT * REPLACE (nfc_normalize(lemma) AS lemma) FROM entry WHERE lang = 'ar')))"""
_INV = "iv AS (SELECT level, ord, lemma, pos, v.action AS action, v.reason AS reason FROM dl WHERE v IS NOT NULL QUALIFY row_number() OVER (PARTITION BY level, lemma, pos, v.action ORDER BY ord) = 1)"


@R.add("dialect_inventory", with_entry("SELECT * FROM iv", _DIALECT, _INV))
def dialect_inventory(spark, d):
    return gates.dialect_inventory(entries(spark, d), RULES).select("level", "ord", "lemma", "pos", "action", "reason")


@R.add("closed_lexicon", "SELECT * FROM (VALUES ('نقل', 'VERB', 'drop', 'by tag'), ('وصف', 'VERB', 'drop', 'by tag'), ('ثلج', '', 'drop', 'closed set'), ('كتاب', '', 'drop', 'closed set'), ('ساعة', '', 'drop', 'closed set')) t(lemma, pos, action, reason)")
def closed_lexicon(spark, d):
    return spark.createDataFrame(gates.lexicon_rows(RULES), "lemma string, pos string, action string, reason string")


@R.add("apply_inventory", with_entry("SELECT ord, e.lemma, CASE WHEN a = 'policy' AND NOT ends_with(english, ' (colloquial)') THEN english || ' (colloquial)' ELSE english END AS english FROM entry e LEFT JOIN (SELECT level, lemma, pos, min(action) AS a FROM iv GROUP BY ALL) i ON e.lang = 'ar' AND i.level = e.level AND i.lemma = e.lemma AND i.pos = e.pos WHERE a IS NULL OR a <> 'drop'", _DIALECT, _INV))
def apply_inventory(spark, d):
    e = entries(spark, d)
    return gates.apply_inventory(e, gates.dialect_inventory(e, RULES)).select("ord", "lemma", "english")


#: known bad forms of the test vocabulary
FORMS = [("de", "Haus", None, None, "drop", "known"), ("es", "mesa", "NOUN", "table", "fix", "sense"), ("fr", "chanson", "VERB", None, "drop", "tag"), ("ar", "تفاحة", None, "apple", "drop", "known")]


@R.add("sample_score", with_entry("SELECT e.ord, CASE WHEN e.lemma = '' OR e.english = '' OR e.chinese = '' THEN 'fix' WHEN e.lang <> 'zh' AND regexp_matches(e.chinese, '[A-Za-z]') AND NOT regexp_matches(e.chinese, '[\\x{4e00}-\\x{9fff}]') THEN 'fix' WHEN nfc_normalize(e.lemma) <> e.lemma OR nfc_normalize(e.english) <> e.english OR nfc_normalize(e.chinese) <> e.chinese THEN 'fix' WHEN e.lemma IN ('°', 'º', 'd''r') THEN 'drop' WHEN e.lang = 'de' AND e.lemma = 'Haus' THEN 'drop' WHEN e.lang = 'es' AND e.lemma = 'mesa' AND e.pos = 'NOUN' AND contains(lower(e.english), 'table') THEN 'fix' WHEN e.lang = 'fr' AND e.lemma = 'chanson' AND e.pos = 'VERB' THEN 'drop' WHEN e.lang = 'ar' AND e.lemma = 'تفاحة' AND contains(lower(e.english), 'apple') THEN 'drop' WHEN e.lang = 'ar' AND (e.level, e.lemma, e.pos) IN (SELECT (level, lemma, pos) FROM iv WHERE action = 'drop') THEN 'drop' WHEN v.action = 'drop' THEN 'drop' ELSE 'keep' END AS verdict FROM entry e LEFT JOIN dl USING (ord)", _DIALECT, _INV))
def sample_score(spark, d):
    e = entries(spark, d)
    forms = spark.createDataFrame(FORMS, "lang string, lemma string, pos string, english_has string, verdict string, note string")
    return gates.sample_score(e, RULES, forms, gates.dialect_inventory(e, RULES)).select("ord", "verdict")


@R.add("candidate_problems", with_entry(f"SELECT ord, CASE WHEN action = 'drop' THEN 'drop' WHEN pos NOT IN ({UPOS_LIST}) OR pos IN ('PROPN', 'PUNCT', 'SYM', 'X') THEN 'tag' WHEN regexp_matches(lemma, '[\\s\\p{{Z}}]') THEN 'space' WHEN regexp_matches(lemma, '\\p{{Nd}}') THEN 'digit' WHEN regexp_matches(lemma, '[?!@#$%^&*()_=+\\[\\]{{}};:\"\\\\|<>~`]') THEN 'special' WHEN NOT starts_with({_FOLD.format('lemma')}, CASE WHEN lang = 'de' THEN 'h' ELSE '' END) THEN 'initial' WHEN nfc_normalize(lemma) <> lemma OR nfc_normalize(english) <> english OR nfc_normalize(chinese) <> chinese THEN 'nfc' END AS problem FROM act", _ACT))
def candidate_problems(spark, d):
    return gates.candidate_problems(_acted(spark, d).withColumn("initial", F.when(F.col("lang") == "de", "H"))).select("ord", "problem")


@R.add("schema_problems", with_entry(f"SELECT ord, field, problem FROM (SELECT ord, 'lemma' AS field, CASE WHEN trim(lemma) = '' THEN 'empty' WHEN regexp_matches(lemma, '[\\n\\r\\t]') THEN 'control' END AS problem FROM entry UNION ALL SELECT ord, 'english', CASE WHEN trim(english) = '' THEN 'empty' WHEN regexp_matches(english, '[\\n\\r\\t]') THEN 'control' END FROM entry UNION ALL SELECT ord, 'pos', CASE WHEN pos NOT IN ({UPOS_LIST}) THEN 'unknown tag' END FROM entry) WHERE problem IS NOT NULL"))
def schema_problems(spark, d):
    return gates.schema_problems(entries(spark, d), ["lemma", "english"])


# decisions of which some have another action than they were made with, so that every problem occurs
_DAMAGED = "dg AS (SELECT *, CASE decision_id % 7 WHEN 0 THEN 'fix' WHEN 1 THEN 'drop' WHEN 2 THEN 'hold' ELSE action END AS act FROM review_decision)"


@R.add("decision_problems", f"WITH {_DAMAGED} SELECT decision_id, problem FROM (SELECT decision_id, CASE WHEN act NOT IN ('keep', 'fix', 'drop') THEN 'action' WHEN act = 'fix' AND replacement IS NULL THEN 'fix without replacement' WHEN act = 'drop' AND replacement IS NOT NULL THEN 'drop with replacement' WHEN line < 2 THEN 'line' END AS problem FROM dg) WHERE problem IS NOT NULL")
def decision_problems(spark, d):
    n = F.col("decision_id") % 7
    return gates.decision_problems(table(spark, d, "review_decision").withColumn("action", F.when(n == 0, "fix").when(n == 1, "drop").when(n == 2, "hold").otherwise(F.col("action"))))


# each entry as a sentence of its words and a full stop, some with faults
_SENT = """sn AS (SELECT ord, lang, pos, lemma || CASE WHEN ord % 11 = 0 THEN '!' ELSE '.' END AS text, [ord::VARCHAR] AS target_ids, string_split(trim(lemma), ' ')[1] AS t, list_filter(string_split(lemma, ' '), lambda w: w <> '') AS ws FROM entry WHERE regexp_matches(lemma, '^[^\\x{00A0}\\x{3000}\\t]+$')),
st AS (SELECT *, list_transform(ws, lambda w, i: {'id': CASE WHEN ord % 13 = 0 THEN i + 1 ELSE i END, 'form': w, 'lemma': CASE WHEN ord % 5 = 0 THEN lower(w) ELSE w END, 'upos': CASE WHEN ord % 17 = 0 THEN 'X' ELSE pos END}) || [{'id': CASE WHEN ord % 13 = 0 THEN len(ws) + 2 ELSE len(ws) + 1 END, 'form': '.', 'lemma': CASE WHEN ord % 19 = 0 THEN ',' ELSE '.' END, 'upos': 'PUNCT'}] AS tok FROM sn),
sp AS (SELECT ord, list_filter([CASE WHEN ord % 13 = 0 THEN 'token_ids' END, CASE WHEN nfc_normalize(text) <> text OR nfc_normalize(t) <> t THEN 'nfc' END, CASE WHEN len(list_filter(tok, lambda x: x.upos = 'X')) > 0 THEN 'tag_x' END, CASE WHEN len(list_filter(tok, lambda x: x.upos = 'PUNCT' AND x.lemma <> x.form)) > 0 THEN 'punct_lemma' END,
  CASE WHEN lang = 'zh' AND len(list_filter(tok, lambda x: x.upos <> 'PUNCT' AND x.lemma <> x.form)) > 0 THEN 'zh_lemma' END, CASE WHEN lang = 'ar' AND len(list_filter(tok, lambda x: x.upos <> 'PUNCT' AND NOT regexp_matches(x.lemma, '[\\x{0600}-\\x{06FF}\\x{0750}-\\x{077F}\\x{08A0}-\\x{08FF}]'))) > 0 THEN 'ar_script' END,
  CASE WHEN array_to_string(list_transform(tok, lambda x: x.form), '') <> replace(text, ' ', '') THEN 'text' END, CASE WHEN ord % 23 = 0 THEN 'target_ids' END,
  CASE WHEN len(list_filter(tok, lambda x: @F(x.lemma) = @F(t) AND x.upos = pos)) = 0 THEN 'missing_target' END,
  CASE WHEN lang = 'de' AND len(list_filter(tok, lambda x: x.upos = 'NOUN' AND NOT regexp_matches(x.lemma, '^\\p{Lu}'))) > 0 THEN 'de_noun' END, CASE WHEN lang = 'de' AND len(list_filter(tok, lambda x: x.upos = 'VERB' AND NOT lower(x.lemma) LIKE '%n')) > 0 THEN 'de_verb' END], lambda x: x IS NOT NULL) AS problems FROM st)"""
for _w in ("x.lemma", "t"):
    _SENT = _SENT.replace(f"@F({_w})", _FOLD.format(_w))


@R.add("sentence_problems", with_entry("SELECT ord, x AS problem FROM sp, unnest(problems) AS u(x)", _SENT))
def sentence_problems(spark, d):
    e = entries(spark, d).where(r"lemma rlike '^[^\u00A0\u3000\t]+$'")
    ord_, off = F.col("ord"), lambda n: F.col("ord") % n == 0
    words = F.filter(F.split("lemma", " "), lambda w: w != "")
    e = e.withColumns({"ws": words, "t": F.split(F.trim("lemma"), " ")[0], "shift": F.when(off(13), 1).otherwise(0)})
    one = lambda w, i: F.struct((i + 1 + F.col("shift")).cast("int").alias("id"), w.alias("form"), F.when(off(5), F.lower(w)).otherwise(w).alias("lemma"), F.when(off(17), "X").otherwise(F.col("pos")).alias("upos"))
    stop = F.struct((F.size("ws") + 1 + F.col("shift")).cast("int").alias("id"), F.lit(".").alias("form"), F.when(off(19), ",").otherwise(".").alias("lemma"), F.lit("PUNCT").alias("upos"))
    target = F.array(F.struct(ord_.cast("string").alias("id"), F.col("t").alias("lemma"), "pos"))
    s = e.select("ord", "lang", ord_.cast("string").alias("sent_id"), F.concat("lemma", F.when(off(11), "!").otherwise(".")).alias("text"), F.array(F.when(off(23), "?").otherwise(ord_.cast("string"))).alias("target_ids"), target.alias("targets"), F.concat(F.transform("ws", one), F.array(stop)).alias("tokens"))
    return gates.sentence_problems(s).select("ord", F.explode("problems").alias("problem"))


@R.add("batch_problems", with_entry("SELECT DISTINCT list_id AS batch, 'order' AS problem FROM entry WHERE line % 97 = 0 UNION ALL SELECT DISTINCT list_id, 'repeated_text' FROM (SELECT list_id, lemma FROM entry GROUP BY ALL HAVING count(*) > 1)"))
def batch_problems(spark, d):
    """Lists as batches of their lemmas; of each hundred lines one has another id than it was given."""
    e = entries(spark, d).select(F.col("list_id").alias("batch"), F.struct("line", "ord").alias("place"), F.col("ord").alias("sent_id"), F.col("lemma").alias("text"), "line")
    got = e.withColumn("sent_id", F.when(F.col("line") % 97 == 0, -F.col("sent_id") - 1).otherwise(F.col("sent_id")))
    return gates.batch_problems(got.drop("line"), e.select("batch", "place", "sent_id"))


@R.add("trimmed_lemmas", with_entry("SELECT ord, trim(lemma) AS lemma FROM entry"))
def trimmed_lemmas(spark, d):
    return entries(spark, d).select("ord", strip_ws(F.col("lemma")).alias("lemma"))


@R.add("unique_ids", "SELECT l_orderkey, count(DISTINCT l_partkey) = count(*) AS unique_ids FROM lineitem GROUP BY ALL")
def unique_ids(spark, d):
    orders = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").alias("id"))).alias("items"))  # an order has at most seven lines
    return gates.repeated_ids(orders, "items", "id").select("l_orderkey", "unique_ids")


@R.add("first_candidates", with_entry("SELECT lang, kl AS lemma, kind, base FROM (SELECT lang, kl, kind, left(kl, length(kl) - CASE kind WHEN 'plural' THEN 1 WHEN 'gerund' THEN 3 ELSE 2 END) AS base FROM (SELECT *, CASE WHEN kl LIKE '%s' AND kl NOT LIKE '%ss' THEN 'plural' WHEN kl LIKE '%ing' THEN 'gerund' WHEN kl LIKE '%ed' AND length(kl) > 3 THEN 'past' END AS kind FROM w) WHERE kind IS NOT NULL) c WHERE EXISTS (SELECT 1 FROM w WHERE w.lang = c.lang AND w.kl = c.base) ORDER BY lemma, lang, kind LIMIT 20", _WORDS, "w AS (SELECT DISTINCT lang, lower(trim(lemma)) AS kl FROM gw)"))
def first_candidates(spark, d):
    return dedupe.inflection_candidates(_words(spark, d)).orderBy("lemma", "lang", "kind").limit(20)


@R.add("first_rows", with_entry("SELECT ord, lang, lemma FROM entry ORDER BY ord LIMIT 100"))
def first_rows(spark, d):
    """The limit of a trial run: the first rows by ord."""
    return entries(spark, d).select("ord", "lang", "lemma").orderBy("ord").limit(100)


@R.add("levelled_words", "SELECT rank, word, CASE WHEN rank <= 600 THEN 'A1' WHEN rank <= 1200 THEN 'A2' WHEN rank <= 2200 THEN 'B1' WHEN rank <= 4200 THEN 'B2' ELSE 'C1' END AS level FROM (SELECT sv_id % 9000 AS rank, swedish_lemma AS word FROM swedish_list WHERE swedish_lemma IS NOT NULL) WHERE rank BETWEEN 1 AND 8200 AND trim(word) <> '' QUALIFY row_number() OVER (PARTITION BY lower(trim(word)) ORDER BY rank, word) = 1")
def levelled_words(spark, d):
    words = table(spark, d, "swedish_list").where("swedish_lemma is not null").select((F.col("sv_id") % 9000).alias("rank"), F.col("swedish_lemma").alias("word"))
    return dedupe.levelled_words(words)
