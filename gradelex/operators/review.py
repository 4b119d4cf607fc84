"""Review workflow: applying decisions, aligning and comparing reviews, completing concepts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradelex.functions.rules import norm_gloss, norm_pivot
from gradelex.functions.text import LEVELS, casefold, level_index, nfc, strip_ws, word_key
from gradelex.operators.keep import keep_first

FIELDS = ("lemma", "english", "chinese", "pos")


def apply_decisions(rows: DataFrame, decisions: DataFrame, strict: bool = False) -> DataFrame:
    """rows (list_id, line, lemma, english, chinese, pos, ord) after decisions, with outcome: untouched, kept, fixed, dropped, or
    mismatch where the expected values are not the row's.

    decisions: list_id, line, decided_at, decision_id, action, expected and replacement structs of lemma, english_lemma,
    chinese_lemma, upos. The latest decision of a line counts. Dropped rows are still listed, with that outcome. strict: a mismatch is an error."""
    slim = decisions.where("list_id is not null and line is not null").select("list_id", "line", F.struct("decided_at", "decision_id", "action", "expected", "replacement").alias("x"))
    last = slim.groupBy("list_id", "line").agg(F.max("x").alias("x"))
    j = rows.join(last, ["list_id", "line"], "left")
    pairs = (("lemma", "lemma"), ("english", "english_lemma"), ("chinese", "chinese_lemma"), ("pos", "upos"))
    same = F.lit(True)
    for own, other in pairs:
        same = same & (F.coalesce(F.col(own), F.lit("")) == F.coalesce(F.col(f"x.expected.{other}"), F.lit("")))
    outcome = F.when(F.col("x").isNull(), "untouched").when(~same, "mismatch").when(F.col("x.action") == "drop", "dropped").when((F.col("x.action") == "fix") & F.col("x.replacement").isNotNull(), "fixed").otherwise("kept")
    if strict:
        lost = F.raise_error(F.concat(F.lit("a decision does not fit "), F.concat_ws(":", "list_id", "line")))
        outcome = F.when(F.col("x").isNotNull() & ~same, lost).otherwise(outcome)
    j = j.withColumn("outcome", outcome)
    return j.withColumns({own: F.when(F.col("outcome") == "fixed", F.coalesce(F.col(f"x.replacement.{other}"), F.lit(""))).otherwise(F.col(own)) for own, other in pairs}).drop("x")


def review_counts(applied: DataFrame) -> DataFrame:
    n = lambda o: F.sum(F.when(F.col("outcome") == o, 1).otherwise(0)).cast("bigint")
    return applied.groupBy("lang").agg(F.count(F.lit(1)).alias("n_input"), n("fixed").alias("n_fix"), n("dropped").alias("n_drop"), n("mismatch").alias("n_mismatch"), F.sum(F.when(F.col("outcome") != "dropped", 1).otherwise(0)).cast("bigint").alias("n_output"))


def align_reviews(expected: DataFrame, reviewed: DataFrame) -> DataFrame:
    """(id, status) for each id of either side: ok, missing, unknown, or repeated."""
    a = expected.groupBy("id").agg(F.count(F.lit(1)).alias("na"))
    b = reviewed.groupBy("id").agg(F.count(F.lit(1)).alias("nb"))
    return a.join(b, "id", "full").select("id", F.when(F.col("nb").isNull(), "missing").when(F.col("na").isNull(), "unknown").when(F.col("nb") > 1, "repeated").otherwise("ok").alias("status"))


def in_order(expected: DataFrame, reviewed_rows: DataFrame) -> DataFrame:
    """reviewed_rows (id, …) in the order of expected (id, place): each with its place. An id that is missing, unknown or repeated is an error."""
    n = reviewed_rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    state = expected.select("id", "place").join(n, "id", "full")
    bad = F.when(F.col("place").isNull(), "unknown").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "repeated")
    checked = state.withColumn("place", F.when(bad.isNotNull(), F.raise_error(F.concat_ws(" ", bad, F.lit("id"), F.col("id").cast("string")))).otherwise(F.col("place")))
    return checked.drop("_n").join(reviewed_rows, "id", "left")


def compare_reviews(one: DataFrame, two: DataFrame) -> DataFrame:
    """(batch, n, agreed, all_agree): how far two reviews of (batch, id, lemma, english, chinese, pos, action) agree once texts are composed, white
    space runs are one blank and the gloss is case folded; one null-safe comparison per id, one boolean aggregate per batch."""
    form = lambda c: strip_ws(F.regexp_replace(nfc(c), r"(?U)\s+", " "))
    shape = lambda df: df.select("batch", "id", F.struct(form("lemma").alias("a"), casefold(form("english")).alias("b"), form("chinese").alias("c"), F.col("pos").alias("d"), F.col("action").alias("e")).alias("v"))
    j = shape(one).join(shape(two).select("id", F.col("v").alias("w")), "id", "left").withColumn("same", F.col("v").eqNullSafe(F.col("w")))
    return j.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("same").cast("bigint")).alias("agreed"), F.bool_and("same").alias("all_agree"))


def batch_identity(expected: DataFrame, returned: DataFrame) -> DataFrame:
    """(batch, in_order): whether a batch returned the ids it was given, in their order. Both: batch, place, id. Compared place by
    place, so no batch is gathered."""
    j = expected.alias("a").join(returned.alias("b"), ["batch", "place"], "full")
    return j.groupBy("batch").agg(F.bool_and(F.col("a.id").eqNullSafe(F.col("b.id"))).alias("in_order"))


def collision_keys(rows: DataFrame) -> DataFrame:
    """(lang, level, key, pos) of rows whose key (composed and case-folded lemma, and tag) also stands on another level of the language."""
    k = rows.select("lang", "level", word_key("lemma").alias("key"), "pos").where("key <> ''").distinct()
    many = k.groupBy("lang", "key", "pos").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("lang", "key", "pos")
    return k.join(many, ["lang", "key", "pos"], "left_semi")


def review_dedupe(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows not dropped, whose key (word_key of the lemma, tag) is not taken (lang, key, pos), the first of each key."""
    k = rows.where("action <> 'drop'").withColumn("key", word_key("lemma"))
    return keep_first(k.join(taken, ["lang", "key", "pos"], "left_anti"), ["lang", "key", "pos"], "ord")


def repeated_keys(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """(lang, key, pos, n, collides) of final rows that a review may not leave: a key that stands n times, or is taken (lang, key, pos) on another
    level. Empty for a review that may be written."""
    n = rows.select("lang", word_key("lemma").alias("key"), "pos").groupBy("lang", "key", "pos").agg(F.count(F.lit(1)).alias("n"))
    j = n.join(taken.select("lang", "key", "pos").distinct().withColumn("hit", F.lit(True)), ["lang", "key", "pos"], "left")
    return j.where("n > 1 or hit").select("lang", "key", "pos", "n", F.coalesce("hit", F.lit(False)).alias("collides"))


def kept_rows(rows: DataFrame) -> DataFrame:
    """rows as reviews that keep them; a row without a pivot gloss is an error."""
    checked = F.when(F.coalesce("chinese", F.lit("")) == "", F.raise_error(F.concat(F.lit("no pivot gloss in row "), F.col("ord").cast("string")))).otherwise(F.col("chinese"))
    return rows.withColumns({"chinese": checked, "action": F.lit("keep")})


def appended(committed: DataFrame, more: DataFrame) -> DataFrame:
    """committed rows of a list and further ones after them: the lines of the latter go on from the list's last. Both: list_id, line, ord."""
    last = committed.groupBy("list_id").agg(F.max("line").alias("_last"))
    first = more.groupBy("list_id").agg(F.min("line").alias("_first"))
    shift = first.join(last, "list_id", "left").select("list_id", F.greatest(F.coalesce("_last", F.lit(1)) + 1 - F.col("_first"), F.lit(0)).alias("_by"))
    moved = more.join(shift, "list_id").withColumn("line", (F.col("line") + F.col("_by")).cast("int")).drop("_by")
    return committed.unionByName(moved.select(*committed.columns))


def beyond(rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """rows that are not among the accepted ones (ord): what a refill added, or what of it still waits."""
    return rows.join(accepted.select("ord"), "ord", "left_anti")


def same_ids(one: DataFrame, two: DataFrame) -> DataFrame:
    """(batch, equal): whether both sides (batch, id) have the same set of ids."""
    side = lambda df, k: df.groupBy("batch", "id").agg(F.lit(k).alias("k"))
    n = side(one, 1).unionByName(side(two, 1)).groupBy("batch", "id").agg(F.sum("k").alias("n"))
    return n.groupBy("batch").agg(F.bool_and(F.col("n") == 2).alias("equal"))


def reviewed(rows: DataFrame, decisions: DataFrame, taken: DataFrame, issues: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """A whole review: (rows to write, problems). Decisions are applied, dropped rows leave, and the rest goes through the gates.

    problems (list_id, ord, problem): a decision that does not fit its row, a gate code, a key that stands twice in its list's language or is taken
    (lang, key, pos). Nothing of a list with problems may be written, so such lists are not among the rows. issues gives rows an array `issues`."""
    done = apply_decisions(rows, decisions)
    live = issues(done.where("outcome <> 'dropped'").withColumn("action", F.when(F.col("outcome") == "fixed", "fix").otherwise("keep"))).withColumn("key", word_key("lemma"))
    bad = repeated_keys(live, taken).select("lang", "key", "pos", F.when(F.col("collides"), "collision").otherwise("repeated").alias("problem"))
    found = live.where("outcome = 'mismatch'").select("list_id", "ord", F.lit("mismatch").alias("problem"))
    found = found.unionByName(live.select("list_id", "ord", F.explode("issues").alias("problem"))).unionByName(live.join(bad, ["lang", "key", "pos"]).select("list_id", "ord", "problem"))
    return live.drop("issues", "key", "outcome").join(found.select("list_id").distinct(), "list_id", "left_anti"), found


def frozen_split(rows: DataFrame, validated: DataFrame) -> DataFrame:
    """rows with frozen: whether their fingerprint was validated before."""
    return rows.join(validated.select("fingerprint").distinct().withColumn("hit", F.lit(True)), "fingerprint", "left").withColumn("frozen", F.coalesce("hit", F.lit(False))).drop("hit")


def represented_split(concepts: DataFrame, rows: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """concepts (gloss, pos) with represented: whether a row of the language has the concept's gloss and tag, by word_key, or they are
    skipped (key, pos)."""
    have = rows.select(word_key("english").alias("k"), "pos")
    if skipped is not None:
        have = have.unionByName(skipped.select(F.col("key").alias("k"), "pos"))
    have = have.distinct().withColumn("hit", F.lit(True))
    return concepts.withColumn("k", word_key("gloss")).join(have, ["k", "pos"], "left").select("gloss", "pos", F.coalesce("hit", F.lit(False)).alias("represented"))


def rejected_keys(decisions: DataFrame) -> DataFrame:
    """Distinct (key, pos, kind) of what decisions were about: the word_key of the expected lemma, or gloss, with the expected tag. Any decision
    counts, as a line that was decided on is not to be proposed again."""
    part = lambda c, kind: decisions.select(word_key(c).alias("key"), F.col("expected.upos").alias("pos"), F.lit(kind).alias("kind")).where("key is not null")
    return part("expected.lemma", "lemma").unionByName(part("expected.english_lemma", "english")).distinct()


def concept_universe(rows: DataFrame) -> DataFrame:
    """(g, pos, gloss): concepts of all languages; the longest gloss names one, then the first seen."""
    k = rows.select(norm_gloss(F.col("english")).alias("g"), "pos", "english", "ord").where("g <> ''")
    return k.groupBy("g", "pos").agg(F.max(F.struct(F.length("english").alias("len"), (-F.col("ord")).alias("o"), "english")).alias("x")).select("g", "pos", F.col("x.english").alias("gloss"))


def missing_concepts(rows: DataFrame) -> DataFrame:
    """(lang, gloss, pos) of concepts that other languages have and this one does not.

    The languages of each concept are an array of at most as many values as there are languages; the missing ones are the difference
    from the list of all, so neither a product of concepts and languages is joined nor a concept's rows are gathered."""
    k = rows.select(norm_gloss(F.col("english")).alias("g"), "pos", "lang").where("g <> ''")
    have = k.groupBy("g", "pos").agg(F.collect_set("lang").alias("have"))
    every = rows.agg(F.collect_set("lang").alias("every"))  # one row
    lack = have.crossJoin(F.broadcast(every)).select("g", "pos", F.explode(F.array_except("every", "have")).alias("lang"))
    return lack.join(concept_universe(rows), ["g", "pos"]).select("lang", "gloss", "pos")


def concept_level(concepts: DataFrame, rows: DataFrame, default: str = "B1") -> DataFrame:
    """concepts (gloss, pos) with the lowest level of a row of the same normalised gloss and tag."""
    low = rows.select(norm_gloss(F.col("english")).alias("g"), "pos", level_index(F.col("level")).alias("li")).groupBy("g", "pos").agg(F.min("li").alias("li"))
    j = concepts.withColumn("g", norm_gloss(F.col("gloss"))).join(low, ["g", "pos"], "left")
    return j.select("gloss", "pos", F.when(F.col("li").isNull(), default).otherwise(F.element_at(F.array(*[F.lit(x) for x in LEVELS]), F.col("li"))).alias("level"))


def apply_verdicts(items: DataFrame, verdicts: DataFrame) -> DataFrame:
    """items (id, lemma, …) with what their last verdict (id, ord, verdict, new_lemma) makes of them: keep leaves them, fix gives the new lemma,
    trimmed. Without a verdict, with drop or with a fix to nothing they leave."""
    one = verdicts.groupBy("id").agg(F.max(F.struct("ord", "verdict", "new_lemma")).alias("v"))
    j = items.join(one, "id").withColumn("_new", F.when(F.col("v.verdict") == "fix", strip_ws(F.coalesce("v.new_lemma", F.lit("")))))
    return j.where("v.verdict = 'keep' or _new <> ''").withColumn("lemma", F.coalesce("_new", "lemma")).drop("v", "_new")


def blank_glosses(rows: DataFrame) -> DataFrame:
    return rows.where(strip_ws(F.col("english")) == "").select("lang", "level", "list_id", "line", "ord", "lemma", "pos")


def fill_blanks(rows: DataFrame, fills: DataFrame) -> DataFrame:
    """rows whose gloss is still blank take the one of fills (list_id, line, gloss); the smallest where there are several."""
    one = fills.groupBy("list_id", "line").agg(F.min("gloss").alias("gloss"))
    return rows.join(one, ["list_id", "line"], "left").withColumn("english", F.when((strip_ws(F.col("english")) == "") & F.col("gloss").isNotNull(), F.col("gloss")).otherwise(F.col("english"))).drop("gloss")


def translate_blanks(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Glosses that are blank or repeat the lemma come from dictionary (lang, lemma, gloss) where it has the lemma."""
    one = dictionary.groupBy("lang", "lemma").agg(F.min("gloss").alias("gloss"))
    open_ = (strip_ws(F.col("english")) == "") | (F.lower("english") == F.lower("lemma"))
    return rows.join(one, ["lang", "lemma"], "left").withColumn("english", F.when(open_ & F.col("gloss").isNotNull(), F.col("gloss")).otherwise(F.col("english"))).drop("gloss")


def recent_rejections(log: DataFrame, accepted: DataFrame, most: int) -> DataFrame:
    """The `most` keys rejected last, latest first, then accepted keys not among them, at place 0: place, key. log: key, ord."""
    last = log.groupBy("key").agg(F.max("ord").alias("ord"))
    top = last.orderBy(F.desc("ord"), "key").limit(most)
    shown = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("ord"), "key"))).select("place", "key")  # at most `most` rows
    return shown.unionByName(accepted.select("key").distinct().join(shown.select("key"), "key", "left_anti").select(F.lit(0).alias("place"), "key"))


def pivot_concepts(rows: DataFrame, level: str) -> DataFrame:
    """(gloss, chinese, pos) of the English rows of a level, the concepts other languages are completed with."""
    return rows.where((F.col("lang") == "en") & (F.col("level") == level) & (norm_pivot(F.col("chinese")) != "")).select(F.col("english").alias("gloss"), "chinese", "pos").distinct()
