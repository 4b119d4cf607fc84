"""De-duplication: exact, plural, inflected, overflow, and consolidation across levels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradelex.functions.rules import TARGETS, coarse_pos, gloss_pos
from gradelex.functions.text import LEVELS, level_index, strip_ws
from gradelex.operators.keep import keep_first, numbered, repeats

# rows: lang, level, ord (unique), line, lemma, english, chinese, pos
BANDS = ((1, 600, "A1"), (601, 1200, "A2"), (1201, 2200, "B1"), (2201, 4200, "B2"), (4201, 8200, "C1"))
INFLECTED = ("en", "de", "es", "fr", "sv", "nl")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"kl": F.lower(strip_ws(F.col("lemma"))), "kp": strip_ws(F.col("pos"))})


def exact_dedupe(rows: DataFrame) -> DataFrame:
    """First row of each (lemma, tag) per level."""
    return keep_first(_keyed(rows), ["lang", "level", "kl", "kp"], "ord").drop("kl", "kp")


def plural_duplicates(rows: DataFrame, lang: str = "en") -> DataFrame:
    """Rows of the language whose lemma is a lemma of the same level and a final s; words in -ss and stems under three letters stay."""
    k = _keyed(rows.where(F.col("lang") == lang))
    base = k.select("level", F.col("kl").alias("base")).distinct()
    cand = k.where(F.col("kl").endswith("s") & ~F.col("kl").endswith("ss") & (F.length("kl") > 3)).withColumn("base", F.expr("left(kl, length(kl) - 1)"))
    return cand.join(base, ["level", "base"], "left_semi").drop("base", "kl", "kp")


def fast_cleanup(rows: DataFrame) -> DataFrame:
    """Rows removed per language by the exact and then the plural rule."""
    kept = exact_dedupe(rows)
    gone = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("before")).join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("after")), "lang")
    plural = plural_duplicates(kept).groupBy("lang").agg(F.count(F.lit(1)).alias("p"))
    return gone.join(plural, "lang", "left").select("lang", (F.col("before") - F.col("after")).alias("exact_removed"), F.coalesce("p", F.lit(0)).cast("bigint").alias("plural_removed"))


def inflection_candidates(rows: DataFrame) -> DataFrame:
    """(lang, lemma, kind, base): lemmas that another lemma of the language and a plural, gerund or past ending make."""
    words = _keyed(rows).select("lang", "kl").distinct()
    w = F.col("kl")
    cut = lambda n: F.substring(w, F.lit(1), F.greatest(F.length(w) - n, F.lit(0)))
    kind = F.when(w.endswith("s") & ~w.endswith("ss"), "plural").when(w.endswith("ing"), "gerund").when(w.endswith("ed") & (F.length(w) > 3), "past")
    cand = words.withColumn("kind", kind).where("kind is not null")
    cand = cand.withColumn("base", F.when(F.col("kind") == "plural", cut(1)).when(F.col("kind") == "gerund", cut(3)).otherwise(cut(2)))
    return cand.join(words.select("lang", F.col("kl").alias("base")), ["lang", "base"], "left_semi").select("lang", F.col("kl").alias("lemma"), "kind", "base")


def inflected_clusters(tagged: DataFrame) -> DataFrame:
    """Inflected duplicates among rows with base and upos from a tagger.

    Rows with one coarse tag and base form a cluster. Where exactly one row of several is its own base, the others are
    inflected; with none or more it is ambiguous. The counts of a cluster come from a map-side combined aggregate."""
    k = tagged.withColumns({"coarse": coarse_pos(F.col("upos")), "b": F.lower("base")})
    k = k.withColumn("is_self", F.col("b") == F.lower("lemma"))
    stats = k.groupBy("lang", "coarse", "b").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("is_self").cast("int")).alias("selves"))
    clear = stats.where("size > 1 and selves = 1").select("lang", "coarse", "b")
    return k.where("not is_self").join(clear, ["lang", "coarse", "b"], "left_semi").select("lang", "ord", "lemma", "coarse")


def fuzzy_singletons(tagged: DataFrame) -> DataFrame:
    """Single inflected rows whose base is at most one edit from the lemma of a row that is its own base, with the same coarse tag.

    Words within one edit share the word itself or what is left when one letter is taken away, so the comparison is an exact
    join on those forms instead of every row against every citation form."""
    k = tagged.withColumns({"coarse": coarse_pos(F.col("upos")), "b": F.lower("base"), "l": F.lower("lemma")}).where("lemma <> ''")
    sizes = k.groupBy("lang", "coarse", "b").agg(F.count(F.lit(1)).alias("size")).where("size = 1").select("lang", "coarse", "b")
    alone = k.where("b <> l").join(sizes, ["lang", "coarse", "b"], "left_semi").select("lang", "coarse", "ord", "lemma", "b")
    citations = k.where("b = l").select("lang", "coarse", "l").distinct()
    forms = "array_distinct(concat(array({0}), transform(sequence(1, length({0})), i -> concat(substring({0}, 1, i - 1), substring({0}, i + 1)))))"
    a = alone.withColumn("form", F.explode(F.expr(forms.format("b"))))
    c = citations.withColumn("form", F.explode(F.expr(forms.format("l"))))
    near = a.join(c, ["lang", "coarse", "form"]).where(F.levenshtein("b", "l", 1) >= 0)
    return near.select("lang", "ord", "lemma", "coarse").distinct()


def without_inflected(rows: DataFrame, tag: Callable[[DataFrame], DataFrame], fuzzy: bool = True) -> DataFrame:
    """rows without inflected duplicates, in the languages of INFLECTED: those of clear clusters and, fuzzy, single ones close to a citation
    form. tag is a tagger: it gives rows the columns base and upos. Other languages stay as they are."""
    tagged = tag(rows.where(F.col("lang").isin(*INFLECTED)))
    gone = inflected_clusters(tagged).select("ord")
    if fuzzy:
        gone = gone.unionByName(fuzzy_singletons(tagged).select("ord"))
    return rows.join(gone.distinct(), "ord", "left_anti").select(*rows.columns)


def positions(rows: DataFrame) -> DataFrame:
    """rows with place, the 0-based position in their list by line."""
    part = F.coalesce(F.floor(F.col("line") / 500), F.lit(-1))
    return numbered(rows, ["list_id"], ["line", "ord"], part, "place").withColumn("place", F.col("place") - 1)


def _target(level):
    return F.element_at(F.create_map(*[F.lit(x) for kv in TARGETS.items() for x in kv]), level)


def overflow(rows: DataFrame) -> DataFrame:
    """Rows beyond the target of their list's level."""
    return positions(rows).where(F.col("place") >= _target(F.col("level")))


def redundant_overflow(rows: DataFrame) -> DataFrame:
    """Overflow rows whose lemma stands within the target zone of the same list."""
    p = positions(rows).withColumns({"kl": F.lower(strip_ws(F.col("lemma"))), "over": F.col("place") >= _target(F.col("level"))})
    zone = p.where("not over").select("list_id", "kl").distinct()
    return p.where("over").join(zone, ["list_id", "kl"], "left_semi").select("list_id", "ord", "lemma", "pos")


def duplicates_after_fix(rows: DataFrame, pos_fixes: DataFrame, trims: DataFrame) -> DataFrame:
    """Second and later rows of a (lemma, tag) once tags are fixed, in lists over their target, without rows already trimmed.
    pos_fixes: ord, new_pos; trims: ord."""
    big = rows.groupBy("list_id", "level").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > _target(F.col("level"))).select("list_id")
    live = rows.join(big, "list_id", "left_semi").join(trims, "ord", "left_anti").join(pos_fixes, "ord", "left")
    keyed = live.withColumns({"kl": F.lower(strip_ws(F.col("lemma"))), "np": F.coalesce("new_pos", strip_ws(F.col("pos")))})
    return repeats(keyed, ["list_id", "kl", "np"], "ord").select("list_id", "ord", "lemma", F.col("np").alias("pos"))


def staged_pos_changes(tagged: DataFrame) -> DataFrame:
    """(ord, lemma, old_pos, new_pos, reason) where the tagger, or for an unsure one the gloss, gives another tag. tagged: rows
    with upos from a tagger, X or blank where it is unsure."""
    sure = F.col("upos").isNotNull() & ~F.col("upos").isin("", "X")
    new = F.when(sure, F.col("upos")).otherwise(gloss_pos(F.col("english")))
    old = strip_ws(F.col("pos"))
    out = tagged.withColumns({"old_pos": old, "new_pos": new, "reason": F.when(sure, "tagger").otherwise("gloss")})
    return out.where((strip_ws(F.col("lemma")) != "") & (F.col("old_pos") != "") & (F.col("new_pos") != "") & (F.col("old_pos") != F.col("new_pos"))).select("ord", "lemma", "old_pos", "new_pos", "reason")


def apply_changes(rows: DataFrame, pos_fixes: DataFrame, moves: DataFrame, trims: DataFrame) -> DataFrame:
    """rows after tag fixes (ord, new_pos), then moves (ord, new_level), then trims (list_id, lemma), which take every overflow row
    with the lemma whatever its tag. A moved row leaves its list."""
    over = overflow(rows).select("ord")
    fixed = rows.join(pos_fixes, "ord", "left").withColumn("pos", F.coalesce("new_pos", "pos")).drop("new_pos")
    moved = fixed.join(moves, "ord", "left").withColumn("level", F.coalesce("new_level", "level"))
    hit = rows.join(over, "ord", "left_semi").withColumn("kl", F.lower(strip_ws(F.col("lemma")))).join(trims.select("list_id", F.lower("lemma").alias("kl")).distinct(), ["list_id", "kl"], "left_semi").select("ord")
    stays = moved.where("new_level is not null").unionByName(moved.where("new_level is null").join(hit, "ord", "left_anti"))
    return stays.drop("new_level")


def projected_counts(rows: DataFrame, moves: DataFrame, trims: DataFrame) -> DataFrame:
    """Rows of each (lang, level) now, trimmed, moved out and in, and afterwards. moves: ord, new_level; trims: ord."""
    now = rows.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("now"))
    cut = rows.join(trims, "ord", "left_semi").groupBy("lang", "level").agg(F.count(F.lit(1)).alias("trimmed"))
    moving = rows.join(moves, "ord").select("lang", "level", "new_level")
    out = moving.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("moved_out"))
    into = moving.groupBy("lang", F.col("new_level").alias("level")).agg(F.count(F.lit(1)).alias("moved_in"))
    all_ = now.join(cut, ["lang", "level"], "full").join(out, ["lang", "level"], "full").join(into, ["lang", "level"], "full").fillna(0)
    return all_.withColumn("after", F.expr("now - trimmed - moved_out + moved_in"))


def room_check(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """For each (lang, new_level) that rows would move to: rows there, rows to come, room under the target, and whether it is blocked."""
    now = rows.groupBy("lang", F.col("level").alias("new_level")).agg(F.count(F.lit(1)).alias("now"))
    come = rows.join(moves, "ord").groupBy("lang", "new_level").agg(F.count(F.lit(1)).alias("coming"))
    room = _target(F.col("new_level")).cast("bigint") - F.col("now")
    return come.join(now, ["lang", "new_level"], "left").fillna(0, ["now"]).select("lang", "new_level", "now", "coming", room.alias("room"), (F.col("coming") > room).alias("blocked"))


def consolidate_levels(rows: DataFrame) -> DataFrame:
    """(lang, lemma, pos) in several levels: the kept lowest level, its first gloss, and whether glosses conflict."""
    k = _keyed(rows).withColumn("li", level_index(F.col("level"))).where("li is not null")
    g = k.groupBy("lang", "kl", "kp").agg(F.min("li").alias("lo"), F.max("li").alias("hi"), F.min(F.struct("li", "ord", "english")).alias("x"), F.min(F.lower("english")).alias("g1"), F.max(F.lower("english")).alias("g2"), F.count(F.lit(1)).alias("n"))
    return g.where("lo < hi").select("lang", F.col("kl").alias("lemma"), F.col("kp").alias("pos"), F.element_at(F.array(*[F.lit(x) for x in LEVELS]), F.col("lo")).alias("kept_level"), F.col("x.english").alias("kept_english"), (F.col("n") - 1).alias("removed"), F.when(F.col("g1") != F.col("g2"), "yes").otherwise("no").alias("conflict"))


def level_of_rank(rank):
    """Level of a frequency rank, null beyond the last band."""
    out = F.when(F.lit(False), "")
    for lo, hi, level in BANDS:
        out = out.when(rank.between(lo, hi), level)
    return out


def levelled_words(words: DataFrame) -> DataFrame:
    """(rank, word, level) from a frequency source (rank, word): the first rank of each word, whatever its case, within the bands of the levels."""
    first = words.where((F.col("rank") >= BANDS[0][0]) & (F.col("rank") <= BANDS[-1][1]) & (strip_ws(F.col("word")) != ""))
    best = first.groupBy(F.lower(strip_ws(F.col("word"))).alias("_k")).agg(F.min(F.struct("rank", "word")).alias("x"))
    return best.select("x.rank", "x.word", level_of_rank(F.col("x.rank")).alias("level"))


def change_report(changes: DataFrame, top: int = 60) -> DataFrame:
    """The first `top` changes of each language by ord, and how many more there are."""
    from pyspark.sql import Window

    w = Window.partitionBy("lang").orderBy("ord")
    shown = changes.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= top)
    n = changes.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return shown.join(F.broadcast(n), "lang").select("lang", "ord", "rn", F.greatest(F.col("n") - top, F.lit(0)).alias("more"))
