"""Queries of the review, state, sampling, batching, source and streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradelex.functions import rules
from gradelex.functions.text import nfc, word_key
from gradelex.operators import align, batching, expand, gates, manage, refill, reports, review, sampling, state
from gradelex.operators.keep import keep_latest
from gradelex.plans.base import LEVEL_LIST, Registry, entries, fold, level_no, norm, with_entry
from gradelex.plans.contract import _DELIVERY
from gradelex.plans.lists import _GATES
from gradelex.session import scratch, table
from gradelex.sources import lists as readers
from gradelex.sources import writers
from gradelex.streaming import eventlog

R = Registry()
QUERIES, SQL = R.queries, R.sql

_APPLIED = """dc AS (SELECT * FROM review_decision WHERE list_id IS NOT NULL AND line IS NOT NULL QUALIFY row_number() OVER (PARTITION BY list_id, line ORDER BY decided_at DESC NULLS LAST, decision_id DESC) = 1),
ap AS (SELECT e.*, d.replacement, CASE WHEN d.list_id IS NULL THEN 'untouched' WHEN e.lemma <> coalesce(d.expected.lemma, '') OR e.english <> coalesce(d.expected.english_lemma, '') OR e.chinese <> coalesce(d.expected.chinese_lemma, '') OR e.pos <> coalesce(d.expected.upos, '') THEN 'mismatch'
  WHEN action = 'drop' THEN 'dropped' WHEN action = 'fix' AND replacement IS NOT NULL THEN 'fixed' ELSE 'kept' END AS outcome FROM entry e LEFT JOIN dc d USING (list_id, line))"""


def _applied(spark, d):
    return review.apply_decisions(entries(spark, d), table(spark, d, "review_decision"))


@R.add("apply_decisions", with_entry("SELECT ord, outcome, CASE WHEN outcome = 'fixed' THEN coalesce(replacement.lemma, '') ELSE lemma END AS lemma, CASE WHEN outcome = 'fixed' THEN coalesce(replacement.upos, '') ELSE pos END AS pos FROM ap", _APPLIED))
def apply_decisions(spark, d):
    return _applied(spark, d).select("ord", "outcome", "lemma", "pos")


@R.add("review_counts", with_entry("SELECT lang, count(*) AS n_input, count(*) FILTER (outcome = 'fixed') AS n_fix, count(*) FILTER (outcome = 'dropped') AS n_drop, count(*) FILTER (outcome = 'mismatch') AS n_mismatch, count(*) FILTER (outcome <> 'dropped') AS n_output FROM ap GROUP BY ALL", _APPLIED))
def review_counts(spark, d):
    return review.review_counts(_applied(spark, d))


# two rounds of review as two reviewers of the same lines
_ONE = "trim(regexp_replace(nfc_normalize(coalesce(expected.{0}, '')), '\\s+', ' ', 'g'))"
_FORM = f"{{'a': {_ONE.format('lemma')}, 'b': lower(replace({_ONE.format('english_lemma')}, 'ß', 'ss')), 'c': {_ONE.format('chinese_lemma')}, 'd': coalesce(expected.upos, ''), 'e': action}}"
_SIDE = f"SELECT list_id || ':' || line AS id, list_id AS batch, first(r ORDER BY decision_id) AS v FROM (SELECT *, {_FORM} AS r FROM review_decision WHERE list_id IS NOT NULL AND line IS NOT NULL AND round @ IN ('round1', 'round2', 'round3', 'round4', 'round5')) GROUP BY ALL"
_TWO = f"one AS ({_SIDE.replace('@', '')}), two AS ({_SIDE.replace('@', 'NOT')})"


def _reviewer(spark, d, first: bool) -> DataFrame:
    rounds = F.col("round").isin(*[f"round{i}" for i in range(1, 6)])
    r = table(spark, d, "review_decision").where(F.col("list_id").isNotNull() & F.col("line").isNotNull() & (rounds if first else ~rounds))
    x = F.min(F.struct("decision_id", "expected", "action"))
    t = lambda c: F.coalesce(f"x.expected.{c}", F.lit(""))
    g = r.groupBy(F.concat_ws(":", "list_id", "line").alias("id"), F.col("list_id").alias("batch")).agg(x.alias("x"))
    return g.select("id", "batch", t("lemma").alias("lemma"), t("english_lemma").alias("english"), t("chinese_lemma").alias("chinese"), t("upos").alias("pos"), F.col("x.action").alias("action"))


@R.add("compare_reviews", f"WITH {_TWO} SELECT one.batch, count(*) AS n, count(*) FILTER (one.v IS NOT DISTINCT FROM two.v) AS agreed, bool_and(one.v IS NOT DISTINCT FROM two.v) AS all_agree FROM one LEFT JOIN two USING (id) GROUP BY ALL")
def compare_reviews(spark, d):
    return review.compare_reviews(_reviewer(spark, d, True), _reviewer(spark, d, False))


_RD = "a AS (SELECT list_id || ':' || csv_line AS id, count(*) AS na FROM level_entry GROUP BY ALL), b AS (SELECT list_id || ':' || line AS id, count(*) AS nb FROM review_decision WHERE list_id IS NOT NULL AND line IS NOT NULL GROUP BY ALL)"


@R.add("align_reviews", f"WITH {_RD} SELECT coalesce(a.id, b.id) AS id, CASE WHEN nb IS NULL THEN 'missing' WHEN na IS NULL THEN 'unknown' WHEN nb > 1 THEN 'repeated' ELSE 'ok' END AS status FROM a FULL JOIN b ON a.id = b.id")
def align_reviews(spark, d):
    a = table(spark, d, "level_entry").select(F.concat_ws(":", "list_id", "csv_line").alias("id"))
    b = table(spark, d, "review_decision").where("list_id is not null and line is not null").select(F.concat_ws(":", "list_id", "line").alias("id"))
    return review.align_reviews(a, b)


@R.add("batch_identity", "WITH a AS (SELECT l_orderkey AS batch, l_linenumber AS place, l_partkey AS id FROM lineitem), b AS (SELECT l_orderkey AS batch, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber) AS place, l_partkey AS id FROM lineitem) SELECT coalesce(a.batch, b.batch) AS batch, bool_and(a.id IS NOT DISTINCT FROM b.id) AS in_order FROM a FULL JOIN b ON a.batch = b.batch AND a.place = b.place GROUP BY ALL")
def batch_identity(spark, d):
    from pyspark.sql import Window

    a = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("place"), F.col("l_partkey").alias("id"))
    b = a.withColumn("place", F.row_number().over(Window.partitionBy("batch").orderBy("id", "place")))
    return review.batch_identity(a, b)


_CK = f"ck AS (SELECT DISTINCT lang, level, {fold('lemma')} AS key, pos FROM entry WHERE trim(lemma) <> '')"


@R.add("collision_keys", with_entry("SELECT * FROM ck WHERE (lang, key, pos) IN (SELECT (lang, key, pos) FROM ck GROUP BY lang, key, pos HAVING count(*) > 1)", _CK))
def collision_keys(spark, d):
    return review.collision_keys(entries(spark, d))


_REV = "rv AS (SELECT decision_id AS ord, left(list_id, 2) AS lang, coalesce(expected.lemma, '') AS lemma, coalesce(expected.upos, '') AS pos, action FROM review_decision WHERE list_id IS NOT NULL)"


@R.add("review_dedupe", with_entry(f"SELECT ord, lang, lemma, pos FROM rv WHERE action <> 'drop' AND (lang, {fold('lemma')}, pos) NOT IN (SELECT (lang, key, pos) FROM ck WHERE level = 'A1') QUALIFY row_number() OVER (PARTITION BY lang, {fold('lemma')}, pos ORDER BY ord) = 1", _CK, _REV))
def review_dedupe(spark, d):
    r = table(spark, d, "review_decision").where("list_id is not null").select(F.col("decision_id").alias("ord"), F.left("list_id", F.lit(2)).alias("lang"), F.coalesce("expected.lemma", F.lit("")).alias("lemma"), F.coalesce("expected.upos", F.lit("")).alias("pos"), "action")
    taken = entries(spark, d).where("level = 'A1'").select("lang", word_key("lemma").alias("key"), "pos").where("key <> ''").distinct()
    return review.review_dedupe(r, taken).select("ord", "lang", "lemma", "pos")


_PARTS = lambda *c: " || chr(31) || ".join(f"nfc_normalize(coalesce({x}, ''))" for x in c)
_FP = f"fp AS (SELECT ord, lang, level, {_PARTS('lang', 'level', 'lemma', 'english', 'chinese', 'pos')} AS fingerprint FROM entry), ok AS (SELECT DISTINCT {_PARTS('left(list_id, 2)', 'substr(list_id, 4, 2)', 'expected.lemma', 'expected.english_lemma', 'expected.chinese_lemma', 'expected.upos')} AS fingerprint FROM review_decision WHERE list_id IS NOT NULL AND action = 'keep')"


def _frozen(spark, d):
    parts = lambda *c: rules.fingerprint(*[nfc(x) for x in c])
    e = entries(spark, d).withColumn("fingerprint", parts("lang", "level", "lemma", "english", "chinese", "pos"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    kept = table(spark, d, "review_decision").where("list_id is not null and action = 'keep'")
    ok = kept.select(parts(F.left("list_id", F.lit(2)), F.substring("list_id", 4, 2), *[blank(f"expected.{c}") for c in ("lemma", "english_lemma", "chinese_lemma", "upos")]).alias("fingerprint"))
    return review.frozen_split(e, ok)


@R.add("frozen_split", with_entry("SELECT ord, fingerprint IN (SELECT fingerprint FROM ok) AS frozen FROM fp", _FP))
def frozen_split(spark, d):
    return _frozen(spark, d).select("ord", "frozen")


@R.add("validated_counts", with_entry("SELECT lang, level, count(*) AS n FROM fp WHERE fingerprint IN (SELECT fingerprint FROM ok) GROUP BY ALL", _FP))
def validated_counts(spark, d):
    return reports.histogram(_frozen(spark, d).where("frozen"), "lang", "level")


_UNI = f"u AS (SELECT {norm('english')} AS g, pos, first(english ORDER BY length(english) DESC, ord) AS gloss FROM entry WHERE {norm('english')} <> '' GROUP BY ALL)"


@R.add("concept_universe", with_entry("SELECT * FROM u", _UNI))
def concept_universe(spark, d):
    return review.concept_universe(entries(spark, d))


@R.add("missing_concepts", with_entry(f"SELECT l.lang, gloss, u.pos FROM u, (SELECT DISTINCT lang FROM entry) l WHERE NOT EXISTS (SELECT 1 FROM entry e WHERE e.lang = l.lang AND {norm('e.english')} = u.g AND e.pos = u.pos)", _UNI))
def missing_concepts(spark, d):
    return review.missing_concepts(entries(spark, d)).orderBy("lang", "gloss", "pos")


# words of the independent lists stand for generated ones; a review keeps those of one word, trims and lowers those of two, and drops the rest
_EXPAND = (
    f"mc AS (SELECT l.lang, gloss, u.pos, u.g FROM u, (SELECT DISTINCT lang FROM entry) l WHERE NOT EXISTS (SELECT 1 FROM entry e WHERE e.lang = l.lang AND {norm('e.english')} = u.g AND e.pos = u.pos))",
    f"gw AS (SELECT lang, g, min(lemma) AS lemma FROM (SELECT 'sv' AS lang, {norm('english_lemma')} AS g, swedish_lemma AS lemma FROM swedish_list UNION ALL SELECT 'fr', {norm('english_lemma')}, french_lemma FROM french_list) WHERE lemma <> '' GROUP BY ALL)",
    f"lv AS (SELECT {norm('english')} AS g, pos, min({level_no('level')}) AS li FROM entry GROUP BY ALL)",
)


@R.add("expansion_flow", with_entry(f"SELECT mc.lang, CASE WHEN contains(lemma, ' ') THEN lower(trim(lemma)) ELSE lemma END AS lemma, gloss AS english, mc.pos, coalesce([{LEVEL_LIST}][li], 'B1') AS level FROM mc JOIN gw ON gw.lang = mc.lang AND gw.g = {norm('gloss')} LEFT JOIN lv ON lv.g = {norm('gloss')} AND lv.pos = mc.pos WHERE length(lemma) - length(replace(lemma, ' ', '')) < 2 AND trim(lemma) <> ''", _UNI, *_EXPAND))
def expansion_flow(spark, d):
    own = [table(spark, d, name).select(F.lit(lang).alias("lang"), rules.norm_gloss(F.col("english_lemma")).alias("g"), F.col(col).alias("lemma")) for name, lang, col in (("swedish_list", "sv", "swedish_lemma"), ("french_list", "fr", "french_lemma"))]
    words = own[0].unionByName(own[1]).where("lemma <> ''").groupBy("lang", "g").agg(F.min("lemma").alias("lemma"))
    generate = lambda c: c.withColumn("g", rules.norm_gloss(F.col("gloss"))).join(words, ["lang", "g"]).select("id", "lemma")
    blanks = F.length("lemma") - F.length(F.replace("lemma", F.lit(" "), F.lit("")))
    judge = lambda c: c.select("id", F.lit(1).alias("ord"), F.when(blanks == 0, "keep").when(blanks == 1, "fix").otherwise("drop").alias("verdict"), F.lower("lemma").alias("new_lemma"))
    return expand.expansion(entries(spark, d), generate, judge)


_FRC = "fc AS (SELECT DISTINCT english_lemma AS gloss, coalesce(pos, '') AS pos FROM french_list WHERE english_lemma IS NOT NULL)"


def _concepts(spark, d):
    return table(spark, d, "french_list").where("english_lemma is not null").select(F.col("english_lemma").alias("gloss"), F.coalesce("pos", F.lit("")).alias("pos")).distinct()


@R.add("concept_level", with_entry(f"SELECT gloss, fc.pos, coalesce([{LEVEL_LIST}][li], 'B1') AS level FROM fc LEFT JOIN (SELECT {norm('english')} AS g, pos, min({level_no('level')}) AS li FROM entry GROUP BY ALL) x ON x.g = {norm('gloss')} AND x.pos = fc.pos", _FRC))
def concept_level(spark, d):
    return review.concept_level(_concepts(spark, d), entries(spark, d))


_REJ = f"rj AS (SELECT DISTINCT {fold('expected.lemma')} AS key, expected.upos AS pos, 'lemma' AS kind FROM review_decision WHERE expected.lemma IS NOT NULL UNION SELECT DISTINCT {fold('expected.english_lemma')}, expected.upos, 'english' FROM review_decision WHERE expected.english_lemma IS NOT NULL)"


@R.add("represented_split", with_entry(f"SELECT gloss, pos, ({fold('gloss')}, pos) IN (SELECT ({fold('english')}, pos) FROM entry UNION ALL SELECT (key, pos) FROM rj WHERE kind = 'english' AND pos IS NOT NULL) AS represented FROM fc", _FRC, _REJ))
def represented_split(spark, d):
    """Concepts that a list has, or that a decision was taken on before."""
    skipped = review.rejected_keys(table(spark, d, "review_decision")).where("kind = 'english'").select("key", "pos")
    return review.represented_split(_concepts(spark, d), entries(spark, d), skipped)


@R.add("rejected_keys", f"WITH {_REJ} SELECT * FROM rj")
def rejected_keys(spark, d):
    return review.rejected_keys(table(spark, d, "review_decision"))


@R.add("repeated_keys", with_entry(f"SELECT lang, key, pos, n, hit IS NOT NULL AS collides FROM (SELECT lang, {fold('lemma')} AS key, pos, count(*) AS n FROM entry WHERE level = 'B1' GROUP BY ALL) LEFT JOIN (SELECT DISTINCT lang, {fold('lemma')} AS key, pos, 1 AS hit FROM entry WHERE level <> 'B1') USING (lang, key, pos) WHERE n > 1 OR hit = 1"))
def repeated_keys(spark, d):
    e = entries(spark, d)
    return review.repeated_keys(e.where("level = 'B1'"), e.where("level <> 'B1'").select("lang", word_key("lemma").alias("key"), "pos"))


@R.add("gap_merge", with_entry("SELECT list_id, ord, line FROM entry WHERE level <> 'A1' UNION ALL SELECT g.list_id, g.ord, CAST(line + greatest(0, coalesce(last, 1) + 1 - low) AS INT) FROM (SELECT *, min(line) OVER (PARTITION BY list_id) AS low FROM (SELECT 'fr-' || level || '-00000044' AS list_id, fr_id AS ord, CAST(fr_id % 1000 AS INT) AS line FROM french_list WHERE level IS NOT NULL)) g LEFT JOIN (SELECT list_id, max(line) AS last FROM entry WHERE level <> 'A1' GROUP BY ALL) USING (list_id)"))
def gap_merge(spark, d):
    more = table(spark, d, "french_list").where("level is not null").select(F.concat(F.lit("fr-"), "level", F.lit("-00000044")).alias("list_id"), F.col("fr_id").alias("ord"), (F.col("fr_id") % 1000).cast("int").alias("line"))
    return review.appended(entries(spark, d).where("level <> 'A1'").select("list_id", "ord", "line"), more)


@R.add("same_ids", "SELECT batch, bool_and(n = 2) AS equal FROM (SELECT batch, id, count(DISTINCT k) AS n FROM (SELECT list_id AS batch, csv_line AS id, 1 AS k FROM level_entry UNION ALL SELECT list_id, line, 2 FROM review_decision WHERE list_id IS NOT NULL AND line IS NOT NULL) GROUP BY ALL) GROUP BY ALL")
def same_ids(spark, d):
    a = table(spark, d, "level_entry").select(F.col("list_id").alias("batch"), F.col("csv_line").alias("id"))
    return review.same_ids(a, table(spark, d, "review_decision").where("list_id is not null and line is not null").select(F.col("list_id").alias("batch"), F.col("line").alias("id")))


@R.add("kept_rows", with_entry("SELECT ord, lemma, chinese, 'keep' AS action FROM entry WHERE chinese <> ''"))
def kept_rows(spark, d):
    return review.kept_rows(entries(spark, d).where("chinese <> ''")).select("ord", "lemma", "chinese", "action")


@R.add("level_union", with_entry(f"SELECT lang, {norm('english')} AS gloss_norm, pos, count(*) AS n FROM (SELECT lang, english, pos FROM entry UNION ALL SELECT 'fr', coalesce(english_lemma, ''), coalesce(pos, '') FROM french_list UNION ALL SELECT 'sv', coalesce(english_lemma, ''), coalesce(pos, '') FROM swedish_list) GROUP BY ALL"))
def level_union(spark, d):
    """Level lists and expansions as one relation, by concept."""
    more = [table(spark, d, name).select(F.lit(lang).alias("lang"), F.coalesce("english_lemma", F.lit("")).alias("english"), F.coalesce("pos", F.lit("")).alias("pos")) for name, lang in (("french_list", "fr"), ("swedish_list", "sv"))]
    every = entries(spark, d).select("lang", "english", "pos").unionByName(more[0]).unionByName(more[1])
    return every.groupBy("lang", rules.norm_gloss(F.col("english")).alias("gloss_norm"), "pos").agg(F.count(F.lit(1)).alias("n"))


# a whole review: decisions applied, gates and uniqueness checked; only lists without problems come out
_RUN = (
    f"rl AS (SELECT ord, lang, level, list_id, CASE WHEN outcome = 'fixed' THEN 'fix' ELSE 'keep' END AS action, outcome, CASE WHEN outcome = 'fixed' THEN coalesce(replacement.lemma, '') ELSE lemma END AS lemma, CASE WHEN outcome = 'fixed' THEN coalesce(replacement.english_lemma, '') ELSE english END AS english, CASE WHEN outcome = 'fixed' THEN coalesce(replacement.upos, '') ELSE pos END AS pos FROM ap WHERE outcome <> 'dropped' AND level = 'C1')",
    f"rk AS (SELECT lang, {fold('lemma')} AS key, pos, CASE WHEN max(hit) = 1 THEN 'collision' ELSE 'repeated' END AS problem FROM rl LEFT JOIN (SELECT DISTINCT lang AS tl, {fold('lemma')} AS tk, pos AS tp, 1 AS hit FROM entry WHERE level = 'A1') ON tl = lang AND tk = {fold('lemma')} AND tp = pos GROUP BY ALL HAVING count(*) > 1 OR max(hit) = 1)",
    f"rp AS (SELECT list_id, ord, 'mismatch' AS problem FROM rl WHERE outcome = 'mismatch' UNION ALL SELECT list_id, ord, x FROM (SELECT * FROM gt), unnest(issues) AS u(x) UNION ALL SELECT list_id, ord, problem FROM rl JOIN rk ON rl.lang = rk.lang AND rk.key = {fold('rl.lemma')} AND rl.pos = rk.pos)",
)


def _run(spark, d):
    e = entries(spark, d)
    taken = e.where("level = 'A1'").select("lang", word_key("lemma").alias("key"), "pos")
    return review.reviewed(e.where("level = 'C1'"), table(spark, d, "review_decision"), taken, gates.gate_issues)


_GT = _GATES.replace("FROM act)", "FROM rl)")


@R.add("review_problems", with_entry("SELECT * FROM rp", _APPLIED, _RUN[0], _GT, *_RUN[1:]))
def review_problems(spark, d):
    return _run(spark, d)[1]


@R.add("review_result", with_entry("SELECT list_id, ord, lemma, pos, action FROM rl WHERE list_id NOT IN (SELECT list_id FROM rp)", _APPLIED, _RUN[0], _GT, *_RUN[1:]))
def review_result(spark, d):
    return _run(spark, d)[0].select("list_id", "ord", "lemma", "pos", "action")


_VD = "vd AS (SELECT list_id || ':' || line AS id, arg_max(action, decision_id) AS verdict, arg_max({'x': replacement.lemma}, decision_id).x AS new_lemma FROM review_decision WHERE list_id IS NOT NULL AND line IS NOT NULL GROUP BY ALL)"


@R.add("verdict_apply", with_entry("SELECT ord, CASE WHEN verdict = 'fix' THEN trim(new_lemma) ELSE lemma END AS lemma FROM entry JOIN vd ON vd.id = list_id || ':' || entry.line WHERE verdict = 'keep' OR (verdict = 'fix' AND trim(coalesce(new_lemma, '')) <> '')", _VD))
def verdict_apply(spark, d):
    v = table(spark, d, "review_decision").where("list_id is not null and line is not null").select(F.concat_ws(":", "list_id", "line").alias("id"), F.col("decision_id").alias("ord"), F.col("action").alias("verdict"), F.col("replacement.lemma").alias("new_lemma"))
    return review.apply_verdicts(entries(spark, d).withColumn("id", F.concat_ws(":", "list_id", "line")), v).select("ord", "lemma")


@R.add("fill_blanks", with_entry("SELECT ord, CASE WHEN trim(english) = '' AND gloss IS NOT NULL THEN gloss ELSE english END AS english FROM entry LEFT JOIN (SELECT list_id, line, min(expected.english_lemma) AS gloss FROM review_decision WHERE list_id IS NOT NULL AND line IS NOT NULL GROUP BY ALL) USING (list_id, line)"))
def fill_blanks(spark, d):
    fills = table(spark, d, "review_decision").where("list_id is not null and line is not null").select("list_id", "line", F.col("expected.english_lemma").alias("gloss"))
    return review.fill_blanks(entries(spark, d), fills).select("ord", "english")


@R.add("translate_blanks", with_entry("SELECT ord, CASE WHEN (trim(english) = '' OR lower(english) = lower(e.lemma)) AND gloss IS NOT NULL THEN gloss ELSE english END AS english FROM entry e LEFT JOIN (SELECT lang, lemma, min(english_lemma) AS gloss FROM dedupe_copy WHERE trim(english_lemma) <> '' GROUP BY ALL) g ON g.lang = e.lang AND g.lemma = e.lemma"))
def translate_blanks(spark, d):
    words = table(spark, d, "dedupe_copy").where("trim(english_lemma) <> ''").select("lang", "lemma", F.col("english_lemma").alias("gloss"))
    return review.translate_blanks(entries(spark, d), words).select("ord", "english")


@R.add("recent_rejections", "WITH l AS (SELECT lower(expected.lemma) AS key, max(decision_id) AS o FROM review_decision WHERE action = 'drop' AND expected.lemma IS NOT NULL GROUP BY ALL), t AS (SELECT row_number() OVER (ORDER BY o DESC, key) AS place, key FROM l QUALIFY place <= 100) SELECT place, key FROM t UNION ALL SELECT 0, key FROM (SELECT DISTINCT lower(swedish_lemma) AS key FROM swedish_list WHERE swedish_lemma IS NOT NULL) WHERE key NOT IN (SELECT key FROM t)")
def recent_rejections(spark, d):
    log = table(spark, d, "review_decision").where("action = 'drop' and expected.lemma is not null").select(F.lower("expected.lemma").alias("key"), F.col("decision_id").alias("ord"))
    own = table(spark, d, "swedish_list").where("swedish_lemma is not null").select(F.lower("swedish_lemma").alias("key"))
    return review.recent_rejections(log, own, 100)


@R.add("pivot_concepts", with_entry("SELECT DISTINCT english AS gloss, chinese, pos FROM entry WHERE lang = 'en' AND level = 'A1' AND trim(chinese) <> ''"))
def pivot_concepts(spark, d):
    return review.pivot_concepts(entries(spark, d), "A1")


# state tables: the events table as a ledger and task log


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


@R.add("insert_if_absent", "WITH s AS (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_acctbal > 0), n AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer) SELECT * FROM s UNION ALL SELECT * FROM n WHERE k NOT IN (SELECT k FROM s)")
def insert_if_absent(spark, d):
    c = table(spark, d, "customer")
    s = c.where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    return state.insert_if_absent(s, c.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v")), ["k"])


@R.add("replace_partition", with_entry("SELECT lang, level, ord AS k, lemma AS v FROM entry WHERE (lang, level) NOT IN (SELECT DISTINCT ('fr', level) FROM french_list WHERE level IS NOT NULL) UNION ALL SELECT 'fr', level, fr_id, french_lemma FROM french_list WHERE level IS NOT NULL"))
def replace_partition(spark, d):
    s = entries(spark, d).select("lang", "level", F.col("ord").alias("k"), F.col("lemma").alias("v"))
    n = table(spark, d, "french_list").where("level is not null").select(F.lit("fr").alias("lang"), "level", F.col("fr_id").alias("k"), F.col("french_lemma").alias("v"))
    return state.replace_partition(s, n, ["lang", "level"], ["k"])


@R.add("upsert_changed", "WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey < 5000 THEN o_orderstatus ELSE 'x' END AS config, 'succeeded' AS status, 3 AS attempts FROM orders WHERE o_totalprice > 100000), n AS (SELECT o_orderkey AS k, o_orderstatus AS c FROM orders) SELECT coalesce(s.k, n.k) AS k, CASE WHEN c IS DISTINCT FROM config AND c IS NOT NULL THEN c ELSE config END AS config, CASE WHEN c IS DISTINCT FROM config AND c IS NOT NULL THEN 'pending' ELSE status END AS status, CASE WHEN c IS DISTINCT FROM config AND c IS NOT NULL THEN 0 ELSE attempts END AS attempts FROM s FULL JOIN n ON s.k = n.k")
def upsert_changed(spark, d):
    o = table(spark, d, "orders")
    s = o.where("o_totalprice > 100000").select(F.col("o_orderkey").alias("k"), F.expr("if(o_orderkey < 5000, o_orderstatus, 'x')").alias("config"), F.lit("succeeded").alias("status"), F.lit(3).alias("attempts"))
    return state.upsert_changed(s, o.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("config")), "k", "config", {"status": "pending", "attempts": 0})


@R.add("latest_event", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_event(spark, d):
    return state.latest(_events(spark, d), ["user_id", "event_type"], ["ts", "event_id"], ["value"]).join(state.latest(_events(spark, d), ["user_id", "event_type"], ["ts"], ["event_id"]), ["user_id", "event_type"]).select("user_id", "event_type", "event_id", "value")


@R.add("keep_latest", "SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def keep_latest_rows(spark, d):
    return keep_latest(_events(spark, d).select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"])


_KIND = "CASE event_type WHEN 'purchase' THEN 'succeed' WHEN 'error' THEN 'fail' ELSE 'start' END"


@R.add("task_states", f"SELECT user_id AS task_key, CASE last(k ORDER BY event_id) WHEN 'start' THEN 'running' WHEN 'succeed' THEN 'succeeded' ELSE 'failed' END AS status, count(*) FILTER (k = 'start') AS attempts FROM (SELECT *, {_KIND} AS k FROM events) GROUP BY user_id")
def task_states(spark, d):
    e = _events(spark, d).select(F.col("user_id").alias("task_key"), F.col("event_id").alias("ord"), F.expr("case event_type when 'purchase' then 'succeed' when 'error' then 'fail' else 'start' end").alias("kind"))
    return state.task_states(e)


@R.add("tail_events", "SELECT event_id, user_id, event_type FROM events ORDER BY event_id DESC LIMIT 20")
def tail_events(spark, d):
    """The last events of a log of JSON lines in several files."""
    at = scratch(spark, "log")
    writers.append_log(_events(spark, d).select("event_id", "user_id", "event_type"), at)
    log = readers.read_log(spark, at, "event_id bigint, user_id bigint, event_type string")
    return state.tail(log.withColumn("ord", F.col("event_id")), 20).select("event_id", "user_id", "event_type")


@R.add("delete_keys", "SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def delete_keys(spark, d):
    s = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    return state.delete_keys(s, table(spark, d, "orders").select(F.col("o_custkey").alias("k")))


@R.add("point", "SELECT entry_id, lemma FROM level_entry WHERE lang = 'de' AND level = 'A1'")
def point(spark, d):
    return state.point(table(spark, d, "level_entry"), lang="de", level="A1").select("entry_id", "lemma")


@R.add("ledger_status", "SELECT count(*) AS n, CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS prompt_tokens, CAST(coalesce(sum(l_suppkey), 0) AS BIGINT) AS candidate_tokens, CAST(coalesce(sum(l_partkey), 0) AS BIGINT) AS total_tokens FROM lineitem")
def ledger_status(spark, d):
    return state.ledger_status(table(spark, d, "lineitem").select(F.col("l_linenumber").alias("prompt_tokens"), F.col("l_suppkey").alias("candidate_tokens"), F.col("l_partkey").alias("total_tokens")))


@R.add("status_counts", "SELECT status, count(o_orderkey) AS n FROM (VALUES ('O'), ('F'), ('P'), ('none')) t(status) LEFT JOIN orders ON o_orderstatus = status GROUP BY status")
def status_counts(spark, d):
    return state.status_counts(table(spark, d, "orders").select(F.col("o_orderstatus").alias("status")), ("O", "F", "P", "none"))


@R.add("eta", "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), 6) AS mean FROM events WHERE value > 0")
def eta(spark, d):
    log = _events(spark, d).select(F.col("user_id").alias("run"), F.col("event_id").alias("ord"), F.col("value").alias("seconds"))
    return state.eta(log).select(F.col("ord").alias("event_id"), F.round("mean", 6).alias("mean"))


@R.add("progress", "WITH g AS (SELECT user_id AS run, count(*) AS done FROM events GROUP BY ALL), m AS (SELECT user_id AS run, avg(value) AS mean FROM (SELECT * FROM events WHERE value > 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 8) GROUP BY ALL) SELECT c_custkey AS run, coalesce(done, 0) AS done, 200 AS total, coalesce(done, 0) * 100.0::DOUBLE / 200 AS pct, greatest(200 - coalesce(done, 0), 0) AS remaining, CAST(ceil(greatest(200 - coalesce(done, 0), 0) / 4) AS BIGINT) AS waves, round(CASE WHEN greatest(200 - coalesce(done, 0), 0) = 0 THEN 0 ELSE mean * ceil(greatest(200 - coalesce(done, 0), 0) / 4) END, 6) AS eta_s FROM customer LEFT JOIN g ON g.run = c_custkey LEFT JOIN m ON m.run = c_custkey")
def progress(spark, d):
    log = _events(spark, d).select(F.col("user_id").alias("run"), F.col("event_id").alias("ord"), F.col("value").alias("seconds"))
    totals = table(spark, d, "customer").select(F.col("c_custkey").alias("run"), F.lit(200).cast("bigint").alias("total"))
    return state.progress(log, totals, 4).select("run", "done", "total", "pct", "remaining", "waves", F.round("eta_s", 6).alias("eta_s"))


# sampling and batching

_LOW = lambda c: f"lower(replace(trim({c}), 'ß', 'ss'))"
_CH = f"cm AS (SELECT lang AS lk, {_LOW('lemma')} AS kl, {_LOW('pos')} AS kp, first({{'a': trim(english), 'b': trim(chinese)}} ORDER BY ord) AS f FROM entry WHERE level = 'A1' GROUP BY ALL), cl AS (SELECT DISTINCT lk, kl FROM cm), ca AS (SELECT DISTINCT lk FROM cm), ch AS (SELECT p.*, CASE WHEN ca.lk IS NULL OR (cm.f.a = trim(p.english) AND cm.f.b = trim(p.chinese)) THEN 'unchanged' WHEN cm.f IS NOT NULL THEN 'edited' WHEN cl.kl IS NOT NULL THEN 'pos_or_key_changed' ELSE 'new_or_renamed' END AS change FROM (SELECT * FROM entry WHERE level <> 'A1') p LEFT JOIN ca ON ca.lk = p.lang LEFT JOIN cm ON cm.lk = p.lang AND cm.kl = {_LOW('p.lemma')} AND cm.kp = {_LOW('p.pos')} LEFT JOIN cl ON cl.lk = p.lang AND cl.kl = {_LOW('p.lemma')})"


def _changes(spark, d):
    e = entries(spark, d).withColumn("list_key", F.col("lang"))
    return sampling.classify_changes(e.where("level <> 'A1'"), e.where("level = 'A1'"))


@R.add("change_classify", with_entry("SELECT ord, change FROM ch", _CH))
def change_classify(spark, d):
    return _changes(spark, d).select("ord", "change")


@R.add("change_mix", with_entry("SELECT lang, level, change, count(*) AS n FROM ch GROUP BY ALL", _CH))
def change_mix(spark, d):
    return _changes(spark, d).groupBy("lang", "level", "change").agg(F.count(F.lit(1)).alias("n"))


@R.add("fpc_size", with_entry("SELECT list_id, n, CASE WHEN n <= 0 THEN 0 ELSE greatest(1, least(n, CAST(ceil(24.009999999999994 / (1 + 23.009999999999994 / n)) AS BIGINT))) END AS size FROM (SELECT list_id, count(*) AS n FROM entry GROUP BY ALL)"))
def fpc_size(spark, d):
    return entries(spark, d).groupBy("list_id").agg(F.count(F.lit(1)).alias("n")).withColumn("size", sampling.sample_size(F.col("n")))


def _shares() -> str:
    """The quotas of four strata in SQL: proportional shares in order, one row left for each later stratum, the rest to the last, then the spare."""
    steps = [f"q0 AS (SELECT *, CASE WHEN n <= 0 THEN 0 ELSE greatest(1, least(n, CAST(ceil(24.009999999999994 / (1 + 23.009999999999994 / n)) AS BIGINT))) END AS r1 FROM (SELECT lang, level, count(*) AS n, {', '.join(f"count(*) FILTER (change = '{x}') AS s{i}" for i, x in enumerate(sampling.STRATA, 1))} FROM ch GROUP BY ALL))"]
    for i in range(1, 5):
        later = " + ".join(["0", *(f"(s{j} > 0)::INT" for j in range(i + 1, 5))])
        steps.append(f"q{i} AS (SELECT *, r{i} - t{i} AS r{i + 1} FROM (SELECT *, CASE WHEN s{i} = 0 OR r{i} <= 0 THEN 0 WHEN {later} = 0 THEN least(s{i}, r{i}) ELSE greatest(0, least(s{i}, greatest(1, CAST(round_even(r1 * s{i} / n, 0) AS BIGINT)), r{i} - ({later}))) END AS t{i} FROM q{i - 1}))")
    for i in range(1, 5):
        steps.append(f"q{i + 4} AS (SELECT *, t{i} + least(s{i} - t{i}, r{i + 4}) AS u{i}, r{i + 4} - least(s{i} - t{i}, r{i + 4}) AS r{i + 5} FROM q{i + 3})")
    rows = " UNION ALL ".join(f"SELECT lang, level, '{x}' AS change, CAST(u{i} AS BIGINT) AS quota FROM q8 WHERE u{i} > 0" for i, x in enumerate(sampling.STRATA, 1))
    return ", ".join([*steps, f"qu AS ({rows})"])


@R.add("sample_quotas", with_entry("SELECT * FROM qu", _CH, _shares()))
def sample_quotas(spark, d):
    return sampling.sample_quotas(_changes(spark, d), ["lang", "level"])


@R.add("stratified_sample", with_entry("SELECT lang, level, sample_index, change, ord FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, level, change ORDER BY md5('7:' || ord), ord) AS INT) AS sample_index FROM ch) JOIN qu USING (lang, level, change) WHERE sample_index <= quota", _CH, _shares()))
def stratified_sample(spark, d):
    return sampling.stratified_sample(_changes(spark, d), ["lang", "level"]).select("lang", "level", "sample_index", "change", "ord")


@R.add("defect_rates", "SELECT reviewer, count(*) AS n, count(*) FILTER (action = 'keep') AS kept, count(*) FILTER (action = 'fix') AS fixed, count(*) FILTER (action = 'drop') AS dropped, count(*) FILTER (action IN ('fix', 'drop'))::DOUBLE / count(*) AS defect_rate FROM review_decision GROUP BY ALL")
def defect_rates(spark, d):
    return sampling.defect_rates(table(spark, d, "review_decision").withColumn("verdict", F.col("action")), ["reviewer"])


@R.add("ntile_targets", with_entry("SELECT ord, ntile(10) OVER (PARTITION BY list_id ORDER BY CASE WHEN pos IN ('NOUN', 'VERB', 'ADJ', 'ADV') THEN 0 ELSE 1 END, line, ord) AS bucket FROM entry"))
def ntile_targets(spark, d):
    return sampling.spread_targets(entries(spark, d), 10).select("ord", "bucket")


@R.add("task_grid", f"SELECT phase || ':' || code || ':' || level AS task_key FROM (VALUES ('cefr'), ('handcraft')) p(phase), language_profile, (SELECT unnest([{LEVEL_LIST}]) AS level)")
def task_grid(spark, d):
    codes = [r[0] for r in table(spark, d, "language_profile").select("code").limit(101).collect()]
    if len(codes) > 100:
        raise ValueError("more than 100 languages")
    return sampling.task_grid(["cefr", "handcraft"], sorted(codes), ["A1", "A2", "B1", "B2", "C1"], spark).select("task_key")


def _costed(spark, d):
    return entries(spark, d).withColumn("cost", rules.token_estimate(F.concat("lemma", "english")))


_COST = "co AS (SELECT *, greatest(1, CAST(ceil(strlen(lemma || english) / 4) AS BIGINT)) AS cost FROM entry)"


@R.add("token_estimate", with_entry("SELECT ord, cost FROM co", _COST))
def token_estimate(spark, d):
    return _costed(spark, d).select("ord", "cost")


@R.add("greedy_pack", with_entry("SELECT list_id, ord, cost, CAST(batch AS BIGINT) AS batch FROM g", _COST, "r AS (SELECT list_id, ord, cost, row_number() OVER (PARTITION BY list_id ORDER BY ord) AS i FROM co)", "g AS (SELECT list_id, i, ord, cost, cost AS total, 1 AS n, 0 AS batch FROM r WHERE i = 1 UNION ALL SELECT r.list_id, r.i, r.ord, r.cost, CASE WHEN total + r.cost > 100 OR n >= 36 THEN r.cost ELSE total + r.cost END, CASE WHEN total + r.cost > 100 OR n >= 36 THEN 1 ELSE n + 1 END, CASE WHEN total + r.cost > 100 OR n >= 36 THEN batch + 1 ELSE batch END FROM g JOIN r ON r.list_id = g.list_id AND r.i = g.i + 1)").replace("WITH ", "WITH RECURSIVE ", 1))
def greedy_pack(spark, d):
    return batching.greedy_batches(_costed(spark, d).select("list_id", "ord", "cost"), ["list_id"], "ord", "cost", 100, 36)


@R.add("fixed_batches", with_entry("SELECT ord, CAST(floor((row_number() OVER (PARTITION BY list_id ORDER BY ord) - 1) / 60) AS BIGINT) AS batch FROM entry"))
def fixed_batches(spark, d):
    return batching.fixed_batches(entries(spark, d), ["list_id"], "ord", 60).select("ord", "batch")


@R.add("exclusion_prefix", with_entry("SELECT ord FROM (SELECT ord, sum(cost) OVER (PARTITION BY list_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS r FROM co) WHERE r <= 100", _COST))
def exclusion_prefix(spark, d):
    return batching.exclusion_prefix(_costed(spark, d), ["list_id"], "ord", "cost", 100).select("ord")


_HALVED = (
    "fb AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY list_id ORDER BY ord) - 1) / 60) AS BIGINT) AS batch FROM co)",
    "pl AS (SELECT list_id, batch, ord, cost, row_number() OVER w AS i, sum(cost) OVER (w ROWS UNBOUNDED PRECEDING) AS run FROM fb WINDOW w AS (PARTITION BY list_id, batch ORDER BY ord))",
    "h AS (SELECT list_id, batch, 1::BIGINT AS lo, count(*) AS hi FROM pl GROUP BY list_id, batch UNION ALL SELECT h.list_id, h.batch, unnest([lo, lo + (hi - lo + 1) // 2]), unnest([lo + (hi - lo + 1) // 2 - 1, hi]) FROM h JOIN pl a ON a.list_id = h.list_id AND a.batch = h.batch AND a.i = lo JOIN pl b ON b.list_id = h.list_id AND b.batch = h.batch AND b.i = hi WHERE hi > lo AND b.run - a.run + a.cost > 120)",
    "pt AS (SELECT h.list_id, h.batch, lo, hi, row_number() OVER (PARTITION BY h.list_id, h.batch ORDER BY lo) - 1 AS part FROM h JOIN pl a ON a.list_id = h.list_id AND a.batch = h.batch AND a.i = lo JOIN pl b ON b.list_id = h.list_id AND b.batch = h.batch AND b.i = hi WHERE hi = lo OR b.run - a.run + a.cost <= 120)",
)


@R.add("halved_batches", with_entry("SELECT ord, pl.batch, CAST(part AS BIGINT) AS part FROM pl JOIN pt ON pl.list_id = pt.list_id AND pl.batch = pt.batch AND i BETWEEN lo AND hi", _COST, *_HALVED).replace("WITH ", "WITH RECURSIVE ", 1))
def halved_batches(spark, d):
    b = batching.fixed_batches(_costed(spark, d), ["list_id"], "ord", 60)
    return batching.halved(b, ["list_id", "batch"], "ord", "cost", 120).select("ord", "batch", "part")


# scalar functions


@R.add("durations", "SELECT event_id, CASE WHEN value IS NULL OR value < 0 THEN '?' WHEN value >= 3600 THEN CAST(floor(value / 3600) AS BIGINT) || 'h' || lpad(CAST(CAST(floor(floor(value) % 3600 / 60) AS BIGINT) AS VARCHAR), 2, '0') || 'm' WHEN value >= 60 THEN CAST(floor(floor(value) % 3600 / 60) AS BIGINT) || 'm' || lpad(CAST(CAST(floor(value) % 60 AS BIGINT) AS VARCHAR), 2, '0') || 's' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || 's' END AS shown FROM (SELECT event_id, value * 60 AS value FROM events)")
def durations(spark, d):
    return _events(spark, d).select("event_id", rules.duration(F.col("value") * 60).alias("shown"))


@R.add("prompt_hash", with_entry("SELECT ord, sha256(lemma || chr(31) || english) AS h, CASE WHEN length(english) > 12 THEN left(english, 12) || '…' ELSE english END AS clipped FROM entry"))
def prompt_hash(spark, d):
    return entries(spark, d).select("ord", F.sha2(rules.fingerprint(F.col("lemma"), F.col("english")), 256).alias("h"), rules.clip(F.col("english"), 12).alias("clipped"))


@R.add("json_fields", "SELECT event_id, props ->> '$.k' AS k, length(props) AS n FROM events")
def json_fields(spark, d):
    return _events(spark, d).select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").cast("bigint").alias("n"))


@R.add("language_lookup", "SELECT doc_id, code FROM documents LEFT JOIN (SELECT DISTINCT code, lower(unnest([code, directory, display_name, endonym])) AS name FROM language_profile) ON lower(trim(lang)) = name")
def language_lookup(spark, d):
    return manage.language_codes(table(spark, d, "documents").select("doc_id", "lang"), "lang", table(spark, d, "language_profile")).select("doc_id", "code")


# files: what is written must read back as it was


@R.add("roundtrip_delivery", with_entry("SELECT lang, lemma, english_gloss, cefr, rank, concept_key FROM dr WHERE trim(lemma) <> ''", *_DELIVERY))
def roundtrip_delivery(spark, d):
    at = scratch(spark, "delivery")
    writers.write_delivery(align.delivery_rows(entries(spark, d)), at)
    return readers.read_delivery(spark, f"{at}/*.tsv").select("lang", "lemma", "english_gloss", "cefr", F.col("rank").cast("bigint").alias("rank"), "concept_key")


@R.add("roundtrip_levels", with_entry("SELECT 'de' AS lang, 'B2' AS level, CAST(row_number() OVER (ORDER BY lower(lemma), ord) + 1 AS INT) AS line, lemma, english, chinese, pos FROM entry WHERE lang = 'de' AND level = 'B2' AND list_id = (SELECT min(list_id) FROM entry WHERE lang = 'de' AND level = 'B2')"))
def roundtrip_levels(spark, d):
    """A list written as a file with its header and read back strictly."""
    at = scratch(spark, "levels")
    e = entries(spark, d).where("lang = 'de' and level = 'B2'")
    first = e.agg(F.min("list_id").alias("list_id"))
    writers.write_level(e.join(first, "list_id", "left_semi"), f"{at}/german/B2.csv", "German")
    return readers.read_levels(spark, at, strict=True, langs=["de"], levels=["B2"]).select("lang", "level", "line", "lemma", "english", "chinese", "pos")


@R.add("roundtrip_inventory", with_entry("SELECT lang, level, lemma, pos, 'drop' AS action FROM entry WHERE lang = 'ar' AND pos = 'VERB'"))
def roundtrip_inventory(spark, d):
    at = scratch(spark, "inventory")
    e = entries(spark, d).where("lang = 'ar' and pos = 'VERB'").withColumns({"action": F.lit("drop"), "reason": F.lit("a, \"b\"")})
    writers.write_inventory(e, f"{at}/ar.csv")
    return readers.read_inventory(spark, f"{at}/ar.csv").where("reason = 'a, \"b\"'").select("lang", "level", "lemma", "pos", "action")


@R.add("roundtrip_log", "SELECT event_id, event_type FROM events")
def roundtrip_log(spark, d):
    at = scratch(spark, "log")
    writers.append_log(_events(spark, d).select("event_id", "event_type"), at)
    return readers.read_log(spark, at, "event_id bigint, event_type string").select("event_id", "event_type")


@R.add("roundtrip_decisions", "SELECT expected.lemma AS lemma, line, action FROM review_decision WHERE line IS NOT NULL AND action IS NOT NULL AND expected IS NOT NULL")
def roundtrip_decisions(spark, d):
    at = scratch(spark, "decisions")
    r = table(spark, d, "review_decision").where("line is not null and action is not null and expected is not null")
    writers.append_log(r.select("line", "expected", "action", "replacement", "reason", "reviewer"), at)
    return readers.read_decisions(spark, at).select("expected.lemma", "line", "action")


@R.add("event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    """The streaming aggregate, run over the table as one stream of files until it is used up; each batch writes the windows so far."""
    src = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    at, out, state_at = (scratch(spark, x) for x in ("events", "windows", "stream"))
    src.write.parquet(at)
    stream = eventlog.read_events(spark, at, src.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    counted = eventlog.windowed_counts(stream, "ts", "event_type").select(F.col("window.start").alias("start"), "event_type", "n", "total")
    write = lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{out}/v{epoch:09d}")
    counted.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", state_at).trigger(availableNow=True).start().awaitTermination()
    last = spark.read.option("recursiveFileLookup", True).schema(counted.schema).parquet(out).withColumn("_v", F.input_file_name())
    newest = last.agg(F.max(F.regexp_extract("_v", r"/(v\d{9})/", 1))).first()[0]
    return spark.read.schema(counted.schema).parquet(f"{out}/{newest}").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


# completing lists: the words that other lists have for a gloss stand for a model's answers

_REFILL = (
    f"rr AS (SELECT lang, level, ord AS place, lemma, english, chinese, pos, {fold('lemma')} AS key FROM entry WHERE level = 'B1')",
    f"tk AS (SELECT DISTINCT lang, {fold('lemma')} AS key, pos FROM entry WHERE level = 'A1')",
    "kp AS (SELECT * FROM rr WHERE (lang, key, pos) NOT IN (SELECT (lang, key, pos) FROM tk) QUALIFY row_number() OVER (PARTITION BY lang, key, pos ORDER BY place, lemma, english, chinese) = 1)",
    f"cc AS (SELECT english AS gloss, chinese AS zh, pos, min(ord) AS place FROM entry WHERE lang = 'en' AND level = 'B2' AND trim(replace(chinese, ' ', '')) <> '' GROUP BY ALL)",
    f"an AS (SELECT l.lang, 'B1' AS level, place, CASE WHEN l.lang = 'en' THEN gloss ELSE a.lemma END AS lemma, gloss AS english, CASE WHEN l.lang = 'en' THEN zh ELSE a.chinese END AS chinese, cc.pos, 'keep' AS action, (l.lang, {fold('gloss')}, cc.pos) IN (SELECT (lang, {fold('english')}, pos) FROM kp) AS hit FROM cc, (SELECT DISTINCT lang FROM rr) l LEFT JOIN (SELECT lang, english AS e, min(lemma) AS lemma, min(chinese) AS chinese FROM entry WHERE level = 'C1' GROUP BY ALL) a ON a.lang = l.lang AND a.e = gloss WHERE l.lang = 'en' OR a.lemma IS NOT NULL)",
    "gd AS (SELECT * FROM gt WHERE len(issues) = 0)",
    f"ok AS (SELECT *, {fold('lemma')} AS key FROM gd WHERE pos NOT IN ('PROPN', 'PUNCT', 'SYM', 'X') AND lemma <> '' AND NOT regexp_matches(lemma, '[\\s\\p{{Z}}]') AND chinese <> '' AND nfc_normalize(lemma) = lemma)",
    "rm AS (SELECT lang, 150 - count(*) AS room FROM kp GROUP BY ALL)",
    "p1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY place, lemma) AS k FROM (SELECT * FROM ok WHERE NOT hit AND (lang, key, pos) NOT IN (SELECT (lang, key, pos) FROM kp UNION ALL SELECT (lang, key, pos) FROM tk) QUALIFY row_number() OVER (PARTITION BY lang, key, pos ORDER BY place, lemma, english, chinese) = 1)) JOIN rm USING (lang) WHERE k <= room)",
    "p2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY place, lemma) AS k2 FROM (SELECT * FROM ok WHERE hit AND lang IN (SELECT lang FROM p1) AND (lang, key, pos) NOT IN (SELECT (lang, key, pos) FROM kp UNION ALL SELECT (lang, key, pos) FROM tk UNION ALL SELECT (lang, key, pos) FROM p1) QUALIFY row_number() OVER (PARTITION BY lang, key, pos ORDER BY place, lemma, english, chinese) = 1)) JOIN (SELECT lang, room - (SELECT count(*) FROM p1 WHERE p1.lang = rm.lang) AS room2 FROM rm) USING (lang) WHERE k2 <= room2)",
)


@R.add("completed_lists", with_entry("SELECT lang, place, lemma, pos, 'kept' AS source FROM kp UNION ALL SELECT lang, place, lemma, pos, 'concept' FROM p1 UNION ALL SELECT lang, place, lemma, pos, 'retry' FROM p2", *_REFILL[:5], _GATES.replace("FROM act)", "FROM an)"), *_REFILL[5:]))
def completed_lists(spark, d):
    """B1 lists completed to 150 rows by the concepts of the English B2 list; a language's C1 list answers with its word for a gloss."""
    e = entries(spark, d)
    own = e.where("level = 'B1'")
    rows = own.select("lang", "level", F.col("ord").alias("place"), "lemma", "english", "chinese", "pos", F.lit("keep").alias("action"))
    taken = e.where("level = 'A1'").select("lang", F.lit("B1").alias("level"), word_key("lemma").alias("key"), "pos").distinct()
    pivots = e.where((F.col("lang") == "en") & (F.col("level") == "B2") & (rules.norm_pivot(F.col("chinese")) != "")).groupBy("english", "chinese", "pos").agg(F.min("ord").alias("place"))
    concepts = F.broadcast(own.select("lang", "level").distinct()).join(pivots)  # at most one row per language
    words = e.where("level = 'C1'").groupBy("lang", "english").agg(F.min("lemma").alias("lemma"), F.min("chinese").alias("_z"))
    answer = lambda c: c.join(words, ["lang", "english"]).withColumns({"chinese": F.col("_z"), "action": F.lit("keep")})
    targets = spark.createDataFrame([("B1", 150)], "level string, target int")
    return refill.completed(rows, concepts, taken, targets, answer, gates.gate_issues).select("lang", "place", "lemma", "pos", "source")


@R.add("refill_rest", with_entry("SELECT ord, lemma FROM entry WHERE level = 'B1' AND ord NOT IN (SELECT place FROM kp)", *_REFILL[:3]))
def refill_rest(spark, d):
    """Rows of the B1 lists that the first step of completing them does not keep."""
    e = entries(spark, d)
    rows = e.where("level = 'B1'").select("lang", "level", "ord", "lemma", "english", "chinese", "pos", F.lit("keep").alias("action"))
    taken = e.where("level = 'A1'").select("lang", word_key("lemma").alias("key"), "pos").distinct()
    first = rows.withColumn("key", word_key("lemma")).join(taken, ["lang", "key", "pos"], "left_anti").groupBy("lang", "key", "pos").agg(F.min("ord").alias("ord"))
    return review.beyond(rows, first).select("ord", "lemma")
