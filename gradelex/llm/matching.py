"""Matching entities across sources without keys: a deterministic cascade of exact joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.functions.text import key64
from gradelex.operators.spread import hot_keys, split_join
from gradelex.session import cut

#: words that carry no sense in a gloss: fixed values
FILLERS = ("to", "a", "an", "the")
#: tags of other tag sets by their first letters: fixed values
NOUN_TAGS, VERB_TAGS = ("noun", "n", "propn"), ("verb", "v", "aux")
RULES = ("gloss+pivot+pos", "gloss+pivot", "pivot", "gloss", "gloss~pivot tail", "gloss typo")
#: a token is another spelling of a commoner one if it takes its place in this many concepts and this share of its cases
ALIAS_SUPPORT, ALIAS_SHARE = 3, 0.3
#: a word may be a typo if it stands in one gloss only, or if the other word is this many times as frequent
RARE = 4
#: glosses of up to so many letters are compared without each one of their letters, longer ones by halves
SHORT = 64
#: classes of one pivot or gloss, and members or pairs of one class, that are joined in one stretch
CLASSES, MEMBERS = 2_000, 50_000


def _tokens(english: Column) -> Column:
    """Words of a gloss: annotations, articles and "to" dropped, "ring, long" read as "long ring", a final plural s dropped."""
    e = F.regexp_replace(F.lower(english), r"\((?!to\))[^)]*(\)|$)", " ")
    e = F.regexp_replace(F.trim(F.regexp_replace(e, r"[*;.]+\s*$", " ")), r"^([^,]+),\s*([^,]+)$", "$2 $1")
    e = F.trim(F.regexp_replace(e, r"[^\p{L}\p{N}\p{M}]+", " "))
    return F.filter(F.split(F.regexp_replace(e, r"(\S{2}[^\ss])s\z", "$1"), " "), lambda w: (w != "") & ~w.isin(*FILLERS))


def _pivot(chinese: Column) -> Column:
    """Ideographs of the pivot gloss, without notes in brackets."""
    z = F.regexp_replace(F.regexp_replace(chinese, r"[（(][^）)]*[）)]", ""), r"[^\p{IsHan}]", "")
    return F.nullif(z, F.lit(""))


def _tag(pos: Column) -> Column:
    p = F.lower(F.regexp_replace(pos, r"[^\p{L}]", ""))
    return F.when(p.isin(*NOUN_TAGS), "N").when(p.isin(*VERB_TAGS), "V").when(p != "", p)


def _rows(df: DataFrame, id_col: str, side: int) -> DataFrame:
    slim = df.select(F.col(id_col).alias("id"), _tokens(F.coalesce("english_lemma", F.lit(""))).alias("toks"), _pivot(F.col("chinese_lemma")).alias("z"), _tag(F.col("pos")).alias("p"))
    slim = slim.withColumn("toks", F.when(F.size("toks") > 0, F.col("toks")))
    return slim.withColumn("side", F.lit(side)).withColumn("c", key64(F.lit(side), F.array_join("toks", " "), F.col("z"), F.col("p")))


def _aliases(records: DataFrame) -> DataFrame:
    """(token, named): tokens that take the place of a commoner one while pivot and all other words agree, as synonyms and
    frequent typos do. Each place names its commonest token only, so pairs stay linear in the records."""
    place = records.where("z is not null and toks is not null").select("z", "toks", F.posexplode("toks").alias("i", "token"))
    rest = F.array_join(F.transform("toks", lambda t, k: F.when(k == F.col("i"), "?").otherwise(t)), " ")
    place = place.select(F.xxhash64("z", rest).alias("place"), "token").distinct()
    often = place.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    place = place.join(often, "token")
    best = place.groupBy("place").agg(F.max(F.struct("often", "token")).alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1")
    pairs = place.join(best, "place").groupBy("token", F.col("b.token").alias("named")).agg(F.count(F.lit(1)).alias("support"))
    cases = pairs.groupBy("token").agg(F.sum("support").alias("cases"), F.max(F.struct("support", "named")).alias("m"))
    return cases.where((F.col("m.named") != F.col("token")) & (F.col("m.support") >= ALIAS_SUPPORT) & (F.col("m.support") >= ALIAS_SHARE * F.col("cases"))).select("token", F.col("m.named").alias("named"))


def _renamed(records: DataFrame, aliases: DataFrame) -> DataFrame:
    hits = records.select("c", F.posexplode("toks").alias("i", "token")).join(aliases, "token").groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("i", "named"))).alias("new"))
    joined = records.join(hits, "c", "left")
    toks = F.when(F.col("new").isNull(), F.col("toks")).otherwise(F.transform("toks", lambda t, i: F.coalesce(F.try_element_at("new", i), t)))
    return joined.withColumn("toks", toks).withColumn("e", F.array_join("toks", "")).drop("new")


def _close(a: Column, b: Column) -> Column:
    """One edit, or two letters swapped."""
    d = F.levenshtein(a, b, 2)
    letters = lambda x: F.array_sort(F.split(x, ""))
    return d.isin(0, 1) | ((d == 2) & (letters(a) == letters(b)))


def match_classes(left: DataFrame, left_id: str, right: DataFrame, right_id: str, labels: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(pairs, members) by english_lemma, chinese_lemma and pos. Records that agree in all normalised attributes are one class.

    pairs: c1, c2 (classes of the left and of the right table that mean the same), n1, n2 (their records), first1, first2 (their smallest
    ids), rule and confidence. members: side (0 left, 1 right), id, c of every record that has a gloss or pivot.

    The cascade joins classes exactly:
    1 gloss, pivot and tag; 2 gloss and pivot; 3 pivot, where the glosses are close, differ in one word, or one is missing;
    4 gloss, where a pivot is missing and the gloss has one sense only, or one pivot is the tail of the other;
    5 pivot against pivot without its first character, where the glosses are close or differ in one word after the first;
    6 gloss with one letter deleted, where a pivot is missing, the differing word is attested nowhere else or much more
    rarely than the other's, and only one gloss is that close; glosses of which one has a whole word more are not close.
    After each rule, resolved classes leave by an anti-join: later rules only pair classes of which one is still
    open. Tags must agree unless one is missing. Glosses are compared after frequent synonyms and typos, learnt from
    the records themselves, are replaced.

    Confidence of a rule: (right + 1) / (labelled + 2). labels: (left_id, right_id, same boolean). Without them a pair is labelled by an
    attribute held back from the rule, and only pairs that have it in both records count:
    2, 3, 5 by the tag; 6 by the pivot; 4 by the right record's pivot, where the left list alone decides whether the gloss has one sense.
    1 holds nothing back. Wrong pairs of rule 2's condition show as different tags; of all its wrong pairs the share that two tags agree by chance
    has equal tags, so disagreeing pairs * chance / (1 - chance) is the number of wrong pairs expected among rule 1's.

    A pivot or gloss of very many classes is joined in stretches (spread.split_join), so that none lands in one task.
    Records without gloss and pivot match nothing. Repeated rows each count; further columns are ignored; empty tables give no pairs.
    """
    rows = [_rows(left, left_id, 0), _rows(right, right_id, 1)]
    classes = rows[0].unionByName(rows[1]).where("toks is not null or z is not null").groupBy("c", "side", "z", "p").agg(F.any_value("toks").alias("toks"), F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    classes = cut(classes)
    classes = cut(_renamed(classes, _aliases(classes)))
    total = classes.count()
    cols = ["c", "e", "z", "p", "toks"]

    def side(df: DataFrame, k: int) -> DataFrame:
        return df.where(F.col("side") == k).select(*[F.col(x).alias(f"{x}{k + 1}") for x in cols], *[F.col(x).alias(f"{x}{k + 1}") for x in df.columns if x not in (*cols, "side", "n", "first")])

    tags = F.col("p1").isNull() | F.col("p2").isNull() | (F.col("p1") == F.col("p2"))
    one_null = F.col("z1").isNull() | F.col("z2").isNull()
    distance = F.levenshtein("e1", "e2", 4)
    other_words = F.filter(F.zip_with("toks1", "toks2", lambda a, b: ~F.coalesce(_close(a, b), F.lit(False))), lambda x: x)
    same_count = F.size("toks1") == F.size("toks2")
    near = (same_count & ((distance >= 0) | (F.size(other_words) <= 1))) | distance.between(0, 2)
    first_close = _close(F.col("toks1")[0], F.col("toks2")[0])
    by_tag = F.when(F.col("p1").isNotNull() & F.col("p2").isNotNull(), F.col("p1") == F.col("p2"))
    # a pivot may lack its first part only if the gloss has a word for that part
    tail = (F.col("z1") == F.col("z2")) | ((F.size("toks1") > 1) & (F.col("z1").endswith(F.col("z2")) | F.col("z2").endswith(F.col("z1"))))
    none = F.lit(None).cast("boolean")
    hot = _crowded(classes, total)
    found: list[DataFrame] = []
    state = classes.withColumn("open", F.lit(True))
    still = F.col("open1") | F.col("open2")

    def rule(number: int, candidates: DataFrame, ok: Column, label: Column) -> None:
        """Keeps the candidates that the rule accepts or that tell its precision; accepted classes are open no more: an anti-join takes them from
        the open ones, but leaves them as partners. Both results are written, so that each rule's plan starts at two tables however many came before."""
        nonlocal state
        got = candidates.select("c1", "c2", F.coalesce(ok, F.lit(False)).alias("ok"), label.alias("label"), F.lit(number).alias("rule")).where("ok or label is not null")
        got = cut(got if number < len(RULES) else got.distinct())  # in the last rule either gloss of a pair may be the mistyped one
        found.append(got)
        if number < len(RULES):
            new = got.where("ok").select(F.explode(F.array("c1", "c2")).alias("c")).distinct().withColumn("_new", F.lit(True))
            state = cut(state.join(new.hint("merge"), "c", "left").withColumn("open", F.col("open") & F.col("_new").isNull()).drop("_new"))

    def met(*on: str, also: Column | None = None) -> DataFrame:
        """Classes of the two sides, of which one at least is open."""
        some = state.where(reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in on]))
        keys, crowd = [(f"{x}1", f"{x}2") for x in on], hot.get(on[0], []) if len(on) == 1 else []
        return split_join(side(some, 0), side(some, 1), keys, crowd, ("c1", "c2"), still if also is None else still & also)

    lacking = F.col("e1").isNull() | F.col("e2").isNull()
    rule(1, met("e", "z", "p"), F.lit(True), none)
    rule(2, met("e", "z"), tags, none)
    rule(3, met("z", also=near | lacking), tags, by_tag)
    senses = classes.where("z is not null and e is not null").groupBy("e").agg(F.count_distinct(F.right("z", F.lit(1))).alias("senses"))
    by_gloss = met("e", also=one_null | tail).join(senses.withColumnRenamed("e", "e1").hint("merge"), "e1", "left")
    rule(4, by_gloss, tags & ((one_null & (F.coalesce("senses", F.lit(0)) <= 1)) | tail), none)
    headless = state.where(F.length("z") > 2).withColumn("t", F.expr("substring(z, 2)"))
    whole = state.where("z is not null and e is not null and open")
    alike = same_count & (F.size("toks1") > 1) & (distance.between(0, 2) | (first_close & (F.size(other_words) <= 1)))
    longer, shorter = hot.get("t", []), [(k, m, n) for k, n, m in hot.get("t", [])]
    tails = split_join(side(headless, 0), side(whole, 1), [("t1", "z2")], longer, ("c1", "c2"), alike).drop("t1")
    tails = tails.unionByName(split_join(side(whole, 0), side(headless, 1), [("z1", "t2")], shorter, ("c1", "c2"), alike).drop("t2"))
    rule(5, tails, tags, by_tag)
    _typos(state, total, side, rule, tags, one_null, tail)
    every = reduce(DataFrame.unionByName, found)
    if labels is None:
        judged = _held_back(classes).unionByName(every.where("label is not null").groupBy("rule").agg(F.sum(F.col("label").cast("double")).alias("good"), F.count(F.lit(1)).cast("double").alias("all")))
    else:
        ids = labels.join(rows[0].select(F.col("id").alias(left_id), F.col("c").alias("c1")), left_id).join(rows[1].select(F.col("id").alias(right_id), F.col("c").alias("c2")), right_id)
        judged = ids.join(every.where("ok").select("c1", "c2", "rule").hint("merge"), ["c1", "c2"]).groupBy("rule").agg(F.sum(F.col("same").cast("double")).alias("good"), F.count(F.lit(1)).cast("double").alias("all"))
    judged = judged.select("rule", ((F.col("good") + 1) / (F.col("all") + 2)).alias("confidence"))  # six rules
    pairs = every.where("ok").groupBy("c1", "c2").agg(F.min("rule").alias("rule")).join(F.broadcast(judged), "rule", "left")
    named = pairs.withColumn("confidence", F.coalesce("confidence", F.lit(0.5))).withColumn("rule", F.element_at(F.array(*[F.lit(x) for x in RULES]), F.col("rule")))
    size = lambda k: classes.where(F.col("side") == k - 1).select(F.col("c").alias(f"c{k}"), F.col("n").alias(f"n{k}"), F.col("first").alias(f"first{k}")).hint("merge")
    members = rows[0].unionByName(rows[1]).where("toks is not null or z is not null").select("side", "id", "c")
    return named.join(size(1), "c1").join(size(2), "c2").select("c1", "c2", "n1", "n2", "first1", "first2", "rule", "confidence"), members


def _crowded(classes: DataFrame, total: int) -> dict[str, list[tuple]]:
    """Pivots (z), glosses (e) and pivots without their first part (t, against whole pivots) of very many classes."""
    one = lambda c: F.struct(F.lit(c).alias("name"), F.xxhash64(c).alias("key"), F.when(F.col("side") == 0, 1).otherwise(0).alias("na"), F.when(F.col("side") == 1, 1).otherwise(0).alias("nb"))
    part = lambda c, na, nb: F.struct(F.lit("t").alias("name"), F.xxhash64(c).alias("key"), F.lit(na).alias("na"), F.lit(nb).alias("nb"))
    every = F.array(F.when(F.col("z").isNotNull(), one("z")), F.when(F.col("e").isNotNull(), one("e")), F.when(F.length("z") > 2, part(F.expr("substring(z, 2)"), 1, 0)), F.when(F.col("z").isNotNull(), part(F.col("z"), 0, 1)))
    out: dict[str, list[tuple]] = {}
    for name, *rest in hot_keys(classes.select(F.inline(F.array_compact(every))), ["name", "key"], total, CLASSES):
        out.setdefault(name, []).append(tuple(rest))
    return out


def _held_back(classes: DataFrame) -> DataFrame:
    """(rule, good, all) of rules 1, 2 and 4 by attributes held back, from counts of classes; no pair is made for it."""
    zero, one = (F.sum(F.when(F.col("side") == k, 1.0).otherwise(0.0)) for k in (0, 1))
    tagged = classes.where("p is not null")
    share = tagged.groupBy("p").agg(zero.alias("a"), one.alias("b")).agg((F.sum(F.col("a") * F.col("b")) / (F.sum("a") * F.sum("b"))).alias("chance"))  # one row
    per = tagged.where("e is not null and z is not null").groupBy("e", "z", "p").agg(zero.alias("a"), one.alias("b"))
    both = per.groupBy("e", "z").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum(F.col("a") * F.col("b")).alias("s"))
    pairs = both.agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("s"), F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0.0)).alias("t")).crossJoin(share)  # one row each
    # a chance of 1, where there is one tag only, tells nothing: no pair can disagree then
    wrong = F.least(F.col("s"), (F.col("t") - F.col("s")) * F.coalesce(F.try_divide("chance", 1 - F.col("chance")), F.lit(0.0)))
    by_tag = pairs.select(F.inline(F.array(F.struct(F.lit(1).alias("rule"), (F.col("s") - wrong).alias("good"), F.col("s").alias("all")), F.struct(F.lit(2).alias("rule"), F.col("s").alias("good"), F.col("t").alias("all")))))
    heads = classes.where("e is not null and z is not null").groupBy("e", F.right("z", F.lit(1)).alias("h")).agg(zero.alias("a"), one.alias("b"))
    glosses = heads.groupBy("e").agg(F.sum(F.when(F.col("a") > 0, 1).otherwise(0)).alias("senses"), F.sum(F.when(F.col("a") > 0, F.col("b")).otherwise(0.0)).alias("good"), F.sum("b").alias("all")).where("senses = 1")
    by_pivot = glosses.agg(F.coalesce(F.sum("good"), F.lit(0.0)).alias("good"), F.coalesce(F.sum("all"), F.lit(0.0)).alias("all")).select(F.lit(4).alias("rule"), "good", "all")
    return by_tag.unionByName(by_pivot).where(F.col("all") > 0)


def _typos(classes: DataFrame, total: int, side, rule, tags: Column, one_null: Column, tail: Column) -> None:
    """Rule 6: an exact join on what one edit or one swap leaves of a gloss: the gloss without one letter, or one of its halves.
    All glosses of the two sides are joined, so that each knows every gloss as close; then their classes, of which one must be open."""
    word = classes.where("toks is not null").select("e", F.explode("toks").alias("token")).distinct().groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    glosses = classes.where("e is not null").groupBy("e").agg((F.min("side") < F.max("side")).alias("twin"), F.collect_set(F.struct("side", "toks")).alias("s")).select("e", "twin", F.inline("s"))
    # short glosses: without each one of their letters; long ones: both halves, at the two lengths that a neighbour's halves may have
    less = "transform(sequence(1, length(e)), i -> xxhash64(concat(substring(e, 1, i - 1), substring(e, i + 1))))"
    halves = "flatten(transform(array(length(e) div 2 - 1, length(e) div 2), h -> array(xxhash64('p', left(e, h)), xxhash64('s', right(e, h)))))"
    keys = f"array_distinct(concat(array(xxhash64(e)), if(length(e) <= {SHORT} + 2, {less}, array()), if(length(e) >= {SHORT}, {halves}, array())))"
    spread = lambda k: glosses.where(F.col("side") == k).select(*[F.col(x).alias(f"{x}{k + 1}") for x in ("e", "toks", "twin")], F.xxhash64("e", "toks").alias(f"c{k + 1}"), F.explode(F.expr(keys)).alias(f"key{k + 1}"))
    # only halves can be those of many glosses: few have one form with a letter less
    long = glosses.where(F.length("e") >= SHORT).select("side", F.explode(F.expr(f"array_distinct({halves})")).alias("key"))
    own = lambda k: F.when(F.col("side") == k, 1).otherwise(0)
    crowd = hot_keys(long.select(F.xxhash64("key").alias("key"), own(0).alias("na"), own(1).alias("nb")), ["key"], total, CLASSES)
    near = split_join(spread(0), spread(1), [("key1", "key2")], crowd, ("c1", "c2"), _close(F.col("e1"), F.col("e2")) & (F.col("e1") != F.col("e2"))).drop("key1", "key2", "c1", "c2").distinct()
    # either of the two may be the mistyped one
    near = near.withColumn("own", F.explode(F.array(F.lit(1), F.lit(2))))
    one = lambda x, k: F.when(F.col("own") == k, F.col(f"{x}1")).otherwise(F.col(f"{x}2"))
    near = near.withColumn("gloss", one("e", 1))
    # the first words in which the two differ, counted by place, as a gloss may repeat a word; none in a gloss that the words
    # at either end cover: then the other has a whole word more, and neither is mistyped for the other
    near = near.withColumns({"mine": one("toks", 1), "theirs": one("toks", 2)})
    head, end = (F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False) - 1 for a, b in (("mine", "theirs"), (F.reverse("mine"), F.reverse("theirs"))))
    first = lambda x: F.when(head + end < F.size(x), F.get(x, head.cast("int")))
    near = near.withColumn("odd", first("mine")).withColumn("usual", first("theirs")).where("odd is not null and usual is not null")
    often = lambda token, k: word.select(F.col("token").alias(token), F.col("k").alias(k)).hint("merge")
    near = near.join(often("odd", "ko"), "odd", "left").join(often("usual", "ku"), "usual", "left")
    near = cut(near.where((F.coalesce("ko", F.lit(1)) <= 1) | (F.col("ku") >= RARE * F.col("ko"))).select("e1", "toks1", "e2", "toks2", "own", "gloss", one("twin", 1).alias("twin")))
    alone = near.groupBy("own", "gloss").agg(F.min(one("e", 2)).alias("least"), F.max(one("e", 2)).alias("most")).where("least = most").select("own", "gloss")
    near = near.join(alone.hint("merge"), ["own", "gloss"])
    got = near.join(side(classes, 0).hint("merge"), ["e1", "toks1"]).join(side(classes, 1).hint("merge"), ["e2", "toks2"])
    # a resolved class is mistyped only if its gloss stands in one list
    mistyped = tags & (one("open", 1) | ~F.col("twin"))
    got = got.select("c1", "c2", "z1", "z2", "p1", "p2", "toks1", "toks2", "open1", "open2", "own", "twin")
    rule(6, got, mistyped & one_null & (F.col("open1") | F.col("open2")), F.when(~one_null & mistyped, tail))


def match_records(left: DataFrame, left_id: str, right: DataFrame, right_id: str, labels: DataFrame | None = None) -> DataFrame:
    """Pairs (left_id, right_id, rule, confidence) of records that mean the same: the pairs of match_classes with their members.

    Classes meet while matching; members only at the end, a class of very many records in stretches on either side."""
    pairs, members = match_classes(left, left_id, right, right_id, labels)
    pairs = cut(pairs)
    ids = lambda k, name: members.where(F.col("side") == k - 1).select(F.col("id").alias(name), F.col("c").alias(f"m{k}"))
    total = pairs.agg(F.coalesce(F.sum(F.col("n1") + F.col("n2")), F.lit(0))).first()[0]
    key = lambda c, name, na, nb: pairs.groupBy(F.xxhash64(c).alias("key")).agg(na.cast("bigint").alias("na"), nb.cast("bigint").alias("nb")).withColumn("name", F.lit(name))
    # members of a class meet its pairs; members of the other side then meet what that gave. Both are counted from the pairs
    n = F.count(F.lit(1))
    crowd = hot_keys(key("c1", "one", F.max("n1"), n).unionByName(key("c2", "two", F.sum("n1"), F.max("n2"))), ["name", "key"], total, MEMBERS)
    hot = lambda name: [tuple(r) for x, *r in crowd if x == name]
    one = split_join(ids(1, left_id), pairs, [("m1", "c1")], hot("one"), (left_id, "c2"))
    return split_join(one, ids(2, right_id), [("c2", "m2")], hot("two"), (left_id, right_id)).select(left_id, right_id, "rule", "confidence")
