"""Language gates on reviewed rows, dialect rules, sample scoring and validation of nested batches."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.functions.rules import ARABIC, FORBIDDEN_UPOS, HAN_WIDE, SPECIAL, latin_pivot, strip_arabic_marks, strip_article, text_problem
from gradelex.functions.text import DIGITS, UPOS, casefold, nfc, strip_ws
from gradelex.operators.keep import keep_first


def gate_issues(rows: DataFrame) -> DataFrame:
    """rows with issues, the codes of the gates they fail. rows: lang, lemma, english, pos, action."""
    r = rows.withColumns({"nl": nfc("lemma"), "ne": nfc("english")}).withColumns({"fl": casefold("nl"), "fe": casefold("ne"), "rl": casefold("lemma"), "re": casefold("english")})
    first = F.substring("lemma", 1, 1)
    upper = (F.upper(first) == first) & (F.lower(first) != first)
    lang, pos = F.col("lang"), F.col("pos")
    checks = {
        "cefr.drop": F.col("action") == "drop",
        "cefr.forbidden_upos": pos.isin(*FORBIDDEN_UPOS),
        "cefr.lemma_whitespace": F.col("lemma").rlike(r"(?U)\s"),
        "cefr.lemma_not_nfc": F.col("nl") != F.col("lemma"),
        "german.noun_requires_uppercase": (lang == "de") & (pos == "NOUN") & ~upper,
        "german.non_noun_capitalized": (lang == "de") & ~pos.isin("NOUN", "PROPN") & first.rlike("[A-Z]"),
        "english.citation_mismatch": (lang == "en") & (F.col("fl") != F.col("fe")),
        "cefr.english_echo": (lang != "en") & (F.col("rl") == F.col("re")),
        "german.verb_requires_infinitive": (lang == "de") & (pos == "VERB") & ~F.col("rl").endswith("n"),
        "arabic.script_required": (lang == "ar") & ~F.col("lemma").rlike(ARABIC),
        "chinese.script_required": (lang == "zh") & ~F.col("lemma").rlike(HAN_WIDE),
    }
    issues = F.array_compact(F.array(*[F.when(c, F.lit(code)) for code, c in checks.items()]))
    return r.withColumn("issues", issues).drop("nl", "ne", "fl", "fe", "rl", "re")


def citation_form(rows: DataFrame) -> DataFrame:
    """English rows whose lemma differs from the gloss in more than case take the gloss; a kept row then counts as fixed."""
    nl, ne = strip_ws(nfc("lemma")), strip_ws(nfc("english"))
    r = rows.withColumns({"nl": nl, "ne": ne}).withColumn("differs", (F.col("lang") == "en") & (F.col("nl") != "") & (F.col("ne") != "") & (casefold("nl") != casefold("ne")))
    return r.withColumns({"lemma": F.when(F.col("differs"), F.col("ne")).otherwise(F.col("lemma")), "action": F.when(F.col("differs") & (F.col("action") == "keep"), "fix").otherwise(F.col("action"))}).drop("nl", "ne", "differs")


def normalise_english(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(English rows after citation_form, trimmed, first of each lemma and tag; counters rows_in, rewritten, dropped_dupes, rows_out)."""
    own = rows.where(F.col("lang") == "en")
    fixed = own.withColumns({"before": strip_ws(nfc("lemma")), "english": strip_ws(nfc("english")), "chinese": strip_ws(nfc("chinese"))})
    fixed = fixed.withColumn("rewritten", (F.col("english") != "") & (casefold("before") != casefold("english")))
    fixed = fixed.withColumn("lemma", F.when(F.col("rewritten"), F.col("english")).otherwise(F.col("before"))).withColumn("kl", casefold("lemma"))
    kept = keep_first(fixed, ["kl", "pos"], "ord")
    a = fixed.agg(F.count(F.lit(1)).alias("rows_in"), F.coalesce(F.sum(F.col("rewritten").cast("bigint")), F.lit(0)).alias("rewritten"))
    b = kept.agg(F.count(F.lit(1)).alias("rows_out"))
    counters = a.crossJoin(b).select("rows_in", "rewritten", (F.col("rows_in") - F.col("rows_out")).alias("dropped_dupes"), "rows_out")  # one row each
    return kept.drop("before", "rewritten", "kl"), counters


def capitalise_nouns(gated: DataFrame) -> DataFrame:
    """German nouns whose only issue is their first letter get it in upper case."""
    only = (F.col("pos") == "NOUN") & (F.col("issues") == F.array(F.lit("german.noun_requires_uppercase")))
    return gated.withColumn("lemma", F.when(only, F.concat(F.upper(F.substring("lemma", 1, 1)), F.expr("substring(lemma, 2)"))).otherwise(F.col("lemma")))


@dataclass(frozen=True)
class Rule:
    """A row of a dialect rule table. All conditions that are given must hold; the first rule of a table that holds decides.

    words: the lemma is one of them, in one of forms (whole: as it stands; bare: without vowel marks; stem: bare and without article;
    tail: bare, without a one-letter clitic). shape: a pattern the bare lemma has. tags, not_tags: the tag is, or is not, one of them.
    gloss: the gloss is one of them. gloss_has: it contains one of them; gloss_lacks: it contains none of them."""

    action: str
    reason: str
    words: tuple[str, ...] = ()
    forms: tuple[str, ...] = ("whole", "bare", "stem")
    shape: str = ""
    tags: tuple[str, ...] = ()
    not_tags: tuple[str, ...] = ()
    gloss: tuple[str, ...] = ()
    gloss_has: tuple[str, ...] = ()
    gloss_lacks: tuple[str, ...] = ()


# fixed values of the dialect rules
CLITICS = ("ب", "ف", "ك")
LOAN_WORDS = ("profile", "garage", "police", "apartment", "shower", "rent", "captain", "coat", "car", "phone", "train", "passport")
LOAN_SHAPE = r"\A[؀-ۿ]{3,}(يل|اج|يش|يون)\z"
DIALECT_NOTES = ("colloquial", "dialect", "عامي")
BY_TAG = (
    Rule("drop", "discourse particle", ("يعني",), ("whole",), tags=("PART",)),
    Rule("drop", "dialect conditional", ("كون",), ("whole",), tags=("SCONJ", "CCONJ", "PART")),
    Rule("drop", "dialect conditional", ("كون",), ("whole",), gloss=("if", "if only")),
    Rule("drop", "dialect auxiliary", ("لازم",), ("whole",), tags=("AUX",)),
    Rule("drop", "dialect imperative", ("روح",), not_tags=("NOUN", "")),
)
BY_SENSE = (
    Rule("drop", "dialect sense", ("سحاب",), ("bare",), gloss_has=("zipper",)),
    Rule("drop", "dialect sense", ("عمر",), ("bare",), gloss=("never", "not ever")),
    Rule("drop", "dialect sense", ("معمر",), ("bare",), gloss=("full", "stuffed")),
    Rule("drop", "dialect sense", ("ولا",), ("bare",), gloss=("or",)),
    Rule("drop", "dialect sense", ("ولا",), ("bare",), tags=("CCONJ", "CONJ"), gloss_has=("or",), gloss_lacks=("not",)),
)


def token_set(*lists: Iterable[str], keep: Iterable[str] = ()) -> tuple[str, ...]:
    """The words of all lists but those to keep, in order."""
    return tuple(sorted(set().union(*lists) - set(keep)))


def rule_table(drop: Iterable[str], keep: Iterable[str] = (), stems: Iterable[str] = ()) -> tuple[Rule, ...]:
    """The rules in their order, with a lexicon of words to drop, words to keep and stems that only take a clitic in dialect."""
    own = tuple(drop)
    return (
        *BY_TAG, Rule("ok", "allowed", tuple(keep)), Rule("drop", "closed set", own), Rule("drop", "clitic and dialect stem", (*stems, *own), ("tail",)),
        Rule("drop", "loan", shape=LOAN_SHAPE, gloss_has=LOAN_WORDS), Rule("policy", "gloss names dialect", gloss_has=DIALECT_NOTES), *BY_SENSE,
    )


def lexicon_rows(rules: Iterable[Rule]) -> list[tuple[str, str, str, str]]:
    """(lemma, tag, action, reason) of what the table drops by word alone or by word and tag, the closed lexicon without any list."""
    words = [(w, t, r.action, r.reason) for r in rules if r.action == "drop" and "whole" in r.forms and not (r.not_tags or r.gloss or r.gloss_has) for w in r.words for t in (r.tags or ("",))]
    return sorted(set(words))


def dialect_class(lemma: Column, upos: Column, english: Column, rules: Iterable[Rule]) -> Column:
    """struct(action, reason) for an Arabic lemma (already NFC): that of the first rule that holds, else ok. An empty lemma is ok."""
    bare = strip_arabic_marks(lemma)
    tail = F.when((F.length(lemma) > 2) & F.substring(lemma, 1, 1).isin(*CLITICS), strip_arabic_marks(F.substring(lemma, F.lit(2), F.length(lemma))))
    forms = {"whole": lemma, "bare": bare, "stem": strip_article(bare), "tail": tail}
    tag, gloss = F.upper(F.trim(F.coalesce(upos, F.lit("")))), F.lower(F.trim(F.coalesce(english, F.lit(""))))
    has = lambda notes: reduce(or_, [gloss.contains(x) for x in notes])

    def holds(r: Rule) -> Column:
        parts = []
        if r.words:
            plain = {"".join(c for c in w if not unicodedata.combining(c)) for w in r.words}
            parts.append(reduce(or_, [forms[f].isin(*(r.words if f == "whole" else sorted(plain))) for f in r.forms]))
        parts += [bare.rlike(r.shape)] if r.shape else []
        parts += [tag.isin(*r.tags)] if r.tags else []
        parts += [~tag.isin(*r.not_tags)] if r.not_tags else []
        parts += [gloss.isin(*r.gloss)] if r.gloss else []
        parts += [has(r.gloss_has)] if r.gloss_has else []
        parts += [~has(r.gloss_lacks)] if r.gloss_lacks else []
        return F.coalesce(reduce(and_, parts), F.lit(False))

    verdict = lambda action, reason: F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))
    # a rule without words of its own, as of an empty lexicon, says nothing
    told = [r for r in rules if r.words or r.shape or r.tags or r.gloss or r.gloss_has]
    return reduce(lambda out, r: out.when(holds(r), verdict(r.action, r.reason)), told, F.when(lemma == "", verdict("ok", "empty"))).otherwise(verdict("ok", "unmarked"))


def dialect_inventory(rows: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Arabic rows that a dialect rule drops or marks, the first of each (level, lemma, tag, action)."""
    c = rows.where(F.col("lang") == "ar").withColumn("lemma", nfc("lemma"))
    c = c.withColumn("v", dialect_class(F.col("lemma"), F.col("pos"), F.col("english"), rules)).where("v.action <> 'ok'")
    return keep_first(c.select("*", "v.action", "v.reason").drop("v"), ["level", "lemma", "pos", "action"], "ord")


def apply_inventory(rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """rows without the dropped ones; those of the policy have their glosses marked, once."""
    marks = inventory.groupBy("level", "lemma", "pos").agg(F.min("action").alias("verdict"))  # drop sorts before policy
    r = rows.join(marks.withColumn("lang", F.lit("ar")), ["lang", "level", "lemma", "pos"], "left").where("verdict is null or verdict <> 'drop'")
    mark = lambda c, note: F.when((F.col("verdict") == "policy") & ~F.col(c).endswith(note), F.concat(F.col(c), F.lit(note))).otherwise(F.col(c))
    return r.withColumns({"english": mark("english", " (colloquial)"), "chinese": mark("chinese", "（口语）")}).select(*rows.columns)


def sample_score(rows: DataFrame, rules: Iterable[Rule], fixed_forms: DataFrame | None = None, dropped: DataFrame | None = None) -> DataFrame:
    """rows with verdict and note. fixed_forms (lang, lemma, pos, english_has, verdict, note; null matches anything) are the known bad
    forms, dropped an inventory (level, lemma, pos, action) of Arabic rows; both are parameters. In this order: empty fields, Latin letters in the
    pivot, text that is not composed, symbols, known forms, the inventory, the dialect rules."""
    r = rows.withColumns({"v": dialect_class(nfc("lemma"), F.col("pos"), F.col("english"), rules), "loose": (nfc("lemma") != F.col("lemma")) | (nfc("english") != F.col("english")) | (nfc("chinese") != F.col("chinese"))})
    if fixed_forms is not None:
        f = fixed_forms.select("lang", "lemma", F.col("pos").alias("fpos"), "english_has", F.struct("verdict", "note").alias("f"))
        fits = (F.col("fpos").isNull() | (F.col("pos") == F.col("fpos"))) & (F.col("english_has").isNull() | F.lower("english").contains(F.col("english_has")))
        hit = r.select("ord", "lang", "lemma", "pos", "english").join(f, ["lang", "lemma"]).where(fits).groupBy("ord").agg(F.min("f").alias("f"))
        r = r.join(hit, "ord", "left")
    else:
        r = r.withColumn("f", F.expr("cast(null as struct<verdict:string,note:string>)"))
    if dropped is not None:
        listed = dropped.where("action = 'drop'").select(F.lit("ar").alias("lang"), "level", "lemma", "pos").distinct().withColumn("listed", F.lit(True))
        r = r.join(listed, ["lang", "level", "lemma", "pos"], "left")
    else:
        r = r.withColumn("listed", F.lit(None).cast("boolean"))
    verdict = lambda a, b: F.struct(F.lit(a).alias("verdict"), F.lit(b).alias("note"))
    score = (
        F.when((F.col("lemma") == "") | (F.col("english") == "") | (F.col("chinese") == ""), verdict("fix", "empty field"))
        .when(latin_pivot(F.col("lang"), F.col("chinese")), verdict("fix", "latin pivot"))
        .when(F.col("loose"), verdict("fix", "not composed"))
        .when(F.col("lemma").isin("°", "º", "d'r"), verdict("drop", "junk symbol"))
        .when(F.col("f").isNotNull(), F.col("f"))
        .when(F.col("listed"), verdict("drop", "inventory"))
        .when((F.col("lang") == "ar") & (F.col("v.action") == "drop"), F.struct(F.lit("drop").alias("verdict"), F.concat(F.lit("classifier:"), F.col("v.reason")).alias("note")))
        .when((F.col("lang") == "ar") & (F.col("v.action") == "policy"), verdict("keep", "policy"))
        .otherwise(verdict("keep", "clean"))
    )
    return r.withColumn("s", score).select(*rows.columns, "s.verdict", "s.note")


def candidate_problems(rows: DataFrame) -> DataFrame:
    """rows with problem, why a new candidate cannot be taken, or null: drop, tag, space, digit (of any script), special, initial (where
    column initial asks for one, whatever the case), nfc (lemma, gloss or pivot not composed)."""
    w = F.col("lemma")
    loose = reduce(or_, [nfc(c) != F.col(c) for c in ("lemma", "english", "chinese")])
    problem = (
        F.when(F.col("action") == "drop", "drop").when(~F.col("pos").isin(*UPOS) | F.col("pos").isin(*FORBIDDEN_UPOS), "tag").when(w.rlike(r"(?U)\s"), "space")
        .when(w.rlike(DIGITS), "digit").when(w.rlike(SPECIAL), "special").when(F.col("initial").isNotNull() & ~casefold("lemma").startswith(casefold("initial")), "initial").when(loose, "nfc")
    )
    return rows.withColumn("problem", problem)


def schema_problems(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(ord, field, problem) for text fields that are empty or hold a line break or tab, and for unknown tags."""
    checks = [F.struct(F.lit(f).alias("field"), text_problem(F.col(f)).alias("problem")) for f in fields]
    checks.append(F.struct(F.lit("pos").alias("field"), F.when(~F.col("pos").isin(*UPOS), "unknown tag").alias("problem")))
    return rows.select("ord", F.explode(F.filter(F.array(*checks), lambda x: x["problem"].isNotNull())).alias("x")).select("ord", "x.field", "x.problem")


def sentence_problems(sentences: DataFrame) -> DataFrame:
    """sentences (sent_id, lang, text, target_ids array, targets array<struct<id, lemma, pos>>, tokens array<struct<id int, form, lemma,
    upos>>) with problems: token_ids not 1..n; nfc, some text not composed; tag_x; punct_lemma unlike its form; zh_lemma, of another token
    than punctuation, unlike its form; ar_script, such a lemma without Arabic letters; text, forms do not join to it; target_ids unlike the
    targets'; missing_target, no token with a form has its lemma and tag; de_noun, de_verb, German case and infinitive.

    Texts are composed and case folded as one text each, parts set apart by a control character, since the functions that do so take columns."""
    part = "\u001f"
    tok = F.col("tokens")
    words = lambda field: F.array_join(F.transform(tok, lambda t: F.coalesce(t[field], F.lit(""))), part)
    every = F.concat_ws(part, "sent_id", "text", F.array_join("target_ids", part), words("form"), words("lemma"))
    s = sentences.withColumns({"_all": every, "_lemmas": words("lemma"), "_wanted": F.array_join(F.transform("targets", lambda g: F.coalesce(g["lemma"], F.lit(""))), part)})
    s = s.withColumns({"_loose": nfc("_all") != F.col("_all"), "_low": F.split(casefold("_lemmas"), part, -1), "_want": F.split(casefold("_wanted"), part, -1)})
    any_ = lambda f: F.exists(tok, f)
    is_a = lambda lang: F.col("lang") == lang
    joined = F.array_join(F.transform(tok, lambda t: t["form"]), "")
    here = F.arrays_zip(tok.alias("t"), F.col("_low").alias("low"))
    wanted = F.filter(F.arrays_zip(F.col("targets").alias("g"), F.col("_want").alias("low")), lambda x: x["g"].isNotNull())
    covered = F.forall(wanted, lambda g: F.exists(here, lambda t: (t["low"] == g["low"]) & (t["t"]["upos"] == g["g"]["pos"]) & (F.coalesce(t["t"]["form"], F.lit("")) != "")))
    head = lambda t: F.substring(t["lemma"], 1, 1)
    checks = {
        "token_ids": F.transform(tok, lambda t: t["id"]) != F.transform(tok, lambda t, i: i + 1),
        "nfc": F.col("_loose"),
        "tag_x": any_(lambda t: t["upos"] == "X"),
        "punct_lemma": any_(lambda t: (t["upos"] == "PUNCT") & (t["lemma"] != t["form"])),
        "zh_lemma": is_a("zh") & any_(lambda t: (t["upos"] != "PUNCT") & (t["lemma"] != t["form"])),
        "ar_script": is_a("ar") & any_(lambda t: (t["upos"] != "PUNCT") & ~t["lemma"].rlike(ARABIC)),
        "text": joined != F.regexp_replace("text", r"(?U)[\s\x1C-\x1F]", ""),
        "target_ids": F.col("target_ids") != F.transform("targets", lambda g: g["id"]),
        "missing_target": ~covered,
        "de_noun": is_a("de") & any_(lambda t: (t["upos"] == "NOUN") & ~((F.upper(head(t)) == head(t)) & (F.lower(head(t)) != head(t)))),
        "de_verb": is_a("de") & any_(lambda t: (t["upos"] == "VERB") & ~F.lower(t["lemma"]).endswith("n")),
    }
    return s.withColumn("problems", F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))).select(*sentences.columns, "problems")


def batch_problems(sentences: DataFrame, assigned: DataFrame) -> DataFrame:
    """(batch, problem) for batches of sentences (batch, place, sent_id, text): order, where the ids are not those assigned (batch, place,
    sent_id) at their places; repeated_text, where two sentences have one text. Places are compared one by one and texts counted, so no batch
    is gathered."""
    j = sentences.alias("a").join(assigned.alias("b"), ["batch", "place"], "full").where(~F.col("a.sent_id").eqNullSafe(F.col("b.sent_id")))
    order = j.select("batch").distinct().withColumn("problem", F.lit("order"))
    again = sentences.groupBy("batch", "text").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("batch").distinct()
    return order.unionByName(again.withColumn("problem", F.lit("repeated_text")))


def repeated_ids(batches: DataFrame, array_col: str, id_field: str) -> DataFrame:
    """batches with unique_ids: whether the ids inside the array are all different."""
    ids = F.transform(array_col, lambda x: x[id_field])
    return batches.withColumn("unique_ids", F.size(F.array_distinct(ids)) == F.size(ids))


def decision_problems(decisions: DataFrame) -> DataFrame:
    """(decision_id, problem) of decisions that contradict themselves: unknown action, fix without or drop with a replacement,
    a line before the first row."""
    p = F.when(~F.col("action").isin("keep", "fix", "drop"), "action").when((F.col("action") == "fix") & F.col("replacement").isNull(), "fix without replacement").when((F.col("action") == "drop") & F.col("replacement").isNotNull(), "drop with replacement").when(F.col("line") < 2, "line")
    return decisions.select("decision_id", p.alias("problem")).where("problem is not null")
