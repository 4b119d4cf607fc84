"""Literal rows for the contract, alignment, quality, de-duplication, editing and gate operators."""

import random

from pyspark.sql import functions as F

from gradelex.operators import align, contract, dedupe, gates, manage, quality
from tests.conftest import ENTRY, rows_of


def test_coverage_counts_rows(spark, entry):
    rows = entry(("de", "A1", "Bank", "bank", "", "NOUN"), ("de", "A1", "Haus", "House", "", "NOUN"), ("de", "A1", "x", "", "", "NOUN"), ("es", "A1", "casa", "to house", "", "NOUN"), ("es", "A1", "banco", "bank", "", "NOUN"), ("es", "A1", "orilla", "bank", "", "NOUN"), ("es", "A1", "banco", "bank", "", "NOUN"))
    got = {(r.source, r.target): (r.uniq, r.ambiguous, r.none) for r in contract.pair_coverage(rows).collect()}
    assert got == {("de", "es"): (1, 1, 1), ("es", "de"): (4, 0, 0)}
    assert contract.pair_coverage(rows.limit(0)).count() == 0
    assert {r.status for r in contract.coverage_gate(rows).collect()} == {"OK", "LOW"}


def test_contract_cases(spark, entry):
    src = entry(("de", "A1", "heißen", "to be called", "", "VERB"), ("de", "A1", "neu", "new", "", "ADJ"))
    out = entry(("de", "A1", "heißen", "be", "", "VERB"), ("de", "A1", "heißen", "to be called", "", "VERB"), ("de", "A1", "alt", "old", "", "ADJ"))
    assert rows_of(contract.shrunken_glosses(out, src)) == [("de", "heißen", "be")]
    dup = entry(("de", "A1", "Bank", "bank", "", "N"), ("de", "A1", "Bank", "Bank", "", "N"), ("de", "A1", "Bank", "river bank", "", "N"))
    assert rows_of(contract.duplicate_keys(dup)) == [("de", "Bank", "bank", 2)]
    ranks = spark.createDataFrame([("de", "a", "N", 1), ("de", "a", "N", 2), ("de", "b", "N", 1), ("de", "b", "N", 1), ("de", "c", "N", None)], "lang string, english string, pos string, rank int")
    assert rows_of(contract.rank_gaps(ranks), "gloss_norm") == [("b",), ("c",)]
    script = entry(
        ("ar", "A1", "بيت", "house", "", "N"), ("ar", "A1", "bayt", "house", "", "N"), ("zh", "A1", "fang", "house", "", "N"), ("zh", "A1", "2", "two", "", "N"), ("de", "A1", "House", "house", "", "N"),
        ("de", "A1", "warm", "warm", "", "ADJ"), ("de", "A1", "to go", "go away", "", "V"), ("fr", "A1", " ", "x", "", "N"), ("fr", "A1", "名词", "noun", "", "N"), ("en", "A1", "the cat", "the cat", "", "N"),
    )
    words = spark.createDataFrame([("de", "warm")], "lang string, word string")
    assert rows_of(contract.script_and_substance(script, words), "lemma", "code") == sorted([("bayt", "non_arabic_script"), ("fang", "non_chinese_script"), ("House", "ungrounded_gloss_copy"), ("to go", "english_function_prefix_copy"), (" ", "empty_lemma"), ("名词", "junk_lemma")], key=repr)


def union_find(records):
    parent = {r["ord"]: r["ord"] for r in records}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    norm = lambda g: (g.lower().removeprefix("to ")).strip(" ")
    seen, anchor = {}, {}
    for r in records:
        e, c = norm(r["english"]), r["chinese"].replace(" ", "").strip()
        if e:
            parent[root(r["ord"])] = root(seen.setdefault((e, r["pos"]), r["ord"]))
            if c:
                anchor.setdefault((c, r["pos"]), r["ord"])
    for r in records:
        c = r["chinese"].replace(" ", "").strip()
        if not norm(r["english"]) and c and (c, r["pos"]) in anchor:
            parent[root(r["ord"])] = root(anchor[c, r["pos"]])
    groups = {}
    for r in records:
        groups.setdefault(root(r["ord"]), []).append(r["ord"])
    return {frozenset(g) for g in groups.values()}


def test_alignment_against_union_find(spark):
    r = random.Random(6)
    recs = [{"lang": r.choice(["de", "es"]), "level": "A1", "list_id": "l", "ord": i, "line": i, "lemma": "w", "english": r.choice(["to go", "go", "House", "", ""]), "chinese": r.choice(["去", "房 子", "房子", ""]), "pos": r.choice(["N", "V"])} for i in range(80)]
    got = {}
    for x in align.align_concepts(spark.createDataFrame([tuple(x.values()) for x in recs], ENTRY)).collect():
        got.setdefault(x.cid, []).append(x.ord)
    assert {frozenset(g) for g in got.values()} == union_find(recs)


def test_delivery(spark, entry):
    rows = entry(("de", "A2", "Haus", "house", "房", "NOUN"), ("de", "A1", "Haus", "house", "房", "NOUN"), ("es", "A1", "morada", "house", "", "NOUN"), ("es", "B1", "casa", "", "房", "NOUN"))
    got = rows_of(align.delivery_rows(rows), "lang", "lemma", "cefr", "rank", "concept_key")
    assert got == [("de", "Haus", "A1", 1, "house-NOUN"), ("es", "casa", "B1", 1, "house-NOUN"), ("es", "morada", "A1", 2, "house-NOUN")]
    g = entry(*[("de", "A1", "x", t, "", "V") for t in ("called", "to be called", "to be called")])
    forced = g.withColumns({"cid": F.lit("c")})
    assert rows_of(align.canonical_glosses(forced)) == [("c", "to be called")]
    assert rows_of(align.canonical_glosses(forced.withColumn("english", F.lit("")))) == [("c", "")]


def test_quality(spark, entry):
    rows = entry(("de", "A1", " Hund", "dog", "狗", "NOUN"), ("de", "A1", "hund", " dog", "", "NOUN"), ("de", "A2", "Hund", "", "狗 ", "NOUN"), ("de", "A1", "ein 12#", "x", "x", ""), ("de", "A1", " ", "", "", "X"), ("de", "A1", "Hund", "dog", "狗", "VERB"))
    codes = rows_of(quality.row_issues(rows), "ord", "code")
    assert codes == sorted([(1, "lemma_edge_space"), (2, "t1_edge_space"), (2, "missing_t2"), (3, "missing_t1"), (3, "t2_edge_space"), (4, "multi_word"), (4, "digits"), (4, "special_chars"), (5, "empty_lemma")], key=repr)
    assert rows_of(quality.level_duplicates(rows), "ord") == [(2,)]
    assert rows_of(quality.cross_level_duplicates(rows), "ord", "first_level") == [(3, "A1")]
    assert rows_of(quality.shared_translations(rows), "translation", "n_lemmas") == [("dog", 2), ("狗", 1 + 0)][:1]
    assert rows_of(quality.issue_totals(rows), "lang", "issues", "exit_code") == [("de", 10, 1)]


def test_dedupe(spark, entry):
    rows = entry(("en", "A1", "Cat", "cat", "", "NOUN"), ("en", "A1", "cats", "cat", "", "NOUN"), ("en", "A1", "cat ", "cat", "", "NOUN"), ("en", "A1", "glass", "x", "", "N"), ("en", "A1", "glas", "x", "", "N"), ("en", "A1", "is", "x", "", "V"), ("en", "A1", "i", "x", "", "P"), ("en", "A2", "walking", "", "", "V"), ("en", "A1", "walk", "", "", "V"))
    assert rows_of(dedupe.exact_dedupe(rows), "ord") == [(1,), (2,), (4,), (5,), (6,), (7,), (8,), (9,)]
    assert rows_of(dedupe.plural_duplicates(rows), "ord") == [(2,)]
    assert rows_of(dedupe.inflection_candidates(rows), "lemma", "kind", "base") == sorted([("cats", "plural", "cat"), ("is", "plural", "i"), ("walking", "gerund", "walk")], key=repr)
    tags = {"Cat": "cat", "cats": "cat", "cat ": "cat"}
    tagged = rows.withColumns({"base": F.coalesce(F.create_map(*[F.lit(x) for kv in tags.items() for x in kv])[F.col("lemma")], F.lower("lemma")), "upos": F.col("pos")})
    assert dedupe.inflected_clusters(tagged.where("lemma <> 'cat '")).select("ord").collect()[0].ord == 2


def test_fuzzy_against_brute_force(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abä") for _ in range(r.randrange(1, 5)))
    rows = [(i, "sv", word(), word() if r.random() < 0.5 else None, r.choice(["VERB", "NOUN"])) for i in range(120)]
    rows = [(i, lang, w, b or w, p) for i, lang, w, b, p in rows]
    df = spark.createDataFrame(rows, "ord int, lang string, lemma string, base string, upos string")
    size = {}
    for _, _, _, b, p in rows:
        size[b, p] = size.get((b, p), 0) + 1

    def edits(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            e = [i]
            for j, y in enumerate(b, 1):
                e.append(min(d[j] + 1, e[-1] + 1, d[j - 1] + (x != y)))
            d = e
        return d[-1]

    cites = {(w, p) for _, _, w, b, p in rows if w == b}
    want = sorted(i for i, _, w, b, p in rows if w != b and size[b, p] == 1 and any(q == p and edits(b, c) <= 1 for c, q in cites))
    assert sorted(x.ord for x in dedupe.fuzzy_singletons(df).collect()) == want and want


def test_overflow(spark):
    rows = spark.createDataFrame([("en", "A1", "l", i, i + 2, f"w{i % 590}", "", "", "N") for i in range(610)], ENTRY)
    assert dedupe.overflow(rows).count() == 10
    assert dedupe.redundant_overflow(rows).count() == 10
    fixes, trims = spark.createDataFrame([(3, "V")], "ord bigint, new_pos string"), spark.createDataFrame([(605,)], "ord bigint")
    assert {r.ord for r in dedupe.duplicates_after_fix(rows, fixes, trims).collect()} == set(range(590, 610)) - {593, 605}
    moves = spark.createDataFrame([(609, "A2")], "ord bigint, new_level string")
    got = {r.level: r.after for r in dedupe.projected_counts(rows, moves, trims).collect()}
    assert got == {"A1": 608, "A2": 1}


def test_editing(spark, entry):
    rows = entry(("de", "A1", "Hund", "dog", "狗", "N"), ("de", "B1", "hund", "hound", "犬", "N"), ("de", "A2", "Katze", "cat", "猫", "N"), ("fr", "A1", "hund", "x", "y", "N"))
    term = lambda *r, schema="lang string, lemma string": spark.createDataFrame(list(r), schema)
    assert rows_of(manage.find(rows, term(("de", "HUND"))), "level") == [("A1",), ("B1",)]
    assert rows_of(manage.lookup(rows, spark.createDataFrame([("Dog",), ("犬",)], "term string")), "term", "ord") == sorted([("dog", 1), ("犬", 2)], key=repr)
    assert rows_of(manage.remove(rows, term(("de", "hund"))), "ord") == [(3,), (4,)]
    moved = manage.move(rows, term(("de", "hund", "C1"), ("de", "katze", "A2"), schema="lang string, lemma string, to_level string"))
    assert rows_of(moved, "ord", "level") == [(1, "C1"), (3, "A2"), (4, "A1")]
    up = manage.update(rows, term(("de", "hund", None, "doggy", None), schema="lang string, lemma string, new_lemma string, new_english string, new_chinese string"))
    assert rows_of(up, "ord", "english") == [(1, "doggy"), (2, "hound"), (3, "cat"), (4, "x")]
    new = spark.createDataFrame([("de", "A1", "l", 100 + i, 2, w, "", "", "") for i, w in enumerate(["HUND", "a b", "", "neu", "Neu"])], ENTRY)
    assert rows_of(manage.argument_problems(new, rows)) == [(100, "duplicate"), (101, "contains space"), (102, "empty")]
    assert rows_of(manage.add(rows, new), "ord") == [(1,), (103,), (2,), (3,), (4,)]


def test_gates(spark, entry):
    rows = entry(("de", "A1", "haus", "house", "", "NOUN"), ("de", "A1", "Gehen", "go", "", "VERB"), ("de", "A1", "geht", "go", "", "VERB"), ("en", "A1", "dreams", "dream", "", "NOUN"), ("sv", "A1", "Hand", "hand", "", "PROPN"), ("ar", "A1", "bayt", "house", "", "NOUN"), ("zh", "A1", "fáng", "house", "", "NOUN"), ("fr", "A1", "éte", "x y", "", "NOUN")).withColumn("action", F.lit("keep"))
    got = {r.ord: r.issues for r in gates.gate_issues(rows).collect()}
    assert got == {1: ["german.noun_requires_uppercase"], 2: ["german.non_noun_capitalized"], 3: ["german.verb_requires_infinitive"], 4: ["english.citation_mismatch"], 5: ["cefr.forbidden_upos", "cefr.english_echo"], 6: ["arabic.script_required"], 7: ["chinese.script_required"], 8: ["cefr.lemma_not_nfc"]}
    assert rows_of(gates.capitalise_nouns(gates.gate_issues(rows)).where("ord = 1"), "lemma") == [("Haus",)]
    assert rows_of(gates.citation_form(rows).where("ord = 4"), "lemma", "action") == [("dream", "fix")]
    assert gates.token_set(("b", "a"), ("c", "a"), keep=("c",)) == ("a", "b")
    lex = gates.rule_table(drop=("شوية", "مَسُوس"), keep=("بخير", "روح"), stems=("شوية",))
    cases = [("بشوية", "ADV", "slowly", "drop"), ("بخير", "ADV", "fine", "ok"), ("روح", "VERB", "go", "drop"), ("روح", "NOUN", "soul", "ok"), ("المسوس", "ADJ", "bland", "drop"), ("يعني", "PART", "like", "drop"), ("بروفيل", "NOUN", "profile", "drop"), ("بروفيل", "NOUN", "outline", "ok"), ("ولا", "CCONJ", "or", "drop"), ("ولا", "CCONJ", "and not or", "ok"), ("كلمة", "NOUN", "word (dialect)", "policy"), ("", "X", "", "ok")]
    df = spark.createDataFrame([c[:3] for c in cases], "lemma string, upos string, english string")
    assert [r.v.action for r in df.select(gates.dialect_class(F.col("lemma"), F.col("upos"), F.col("english"), lex).alias("v")).collect()] == [c[3] for c in cases]
    assert {("شوية", "", "drop", "closed set"), ("كون", "CCONJ", "drop", "dialect conditional"), ("لازم", "AUX", "drop", "dialect auxiliary")} <= set(gates.lexicon_rows(lex))
    many = entry(("de", "A1", "Haus", "house", "房", "NOUN"), ("de", "A1", "Haus", "hut", "房", "NOUN"), ("de", "A1", "e\u0301", "x", "字", "NOUN"), ("ar", "A1", "شوية", "a bit", "点", "ADV"), ("ar", "A1", "كلمة", "word", "词", "NOUN"))
    forms = spark.createDataFrame([("de", "Haus", None, "hut", "fix", "sense")], "lang string, lemma string, pos string, english_has string, verdict string, note string")
    listed = spark.createDataFrame([("A1", "كلمة", "NOUN", "drop")], "level string, lemma string, pos string, action string")
    assert [r.note for r in gates.sample_score(many, lex, forms, listed).orderBy("ord").collect()] == ["clean", "sense", "not composed", "classifier:closed set", "inventory"]
    more = entry(("sv", "A1", "a²", "x", "", "NOUN"), ("sv", "A1", "Öl", "x", "", "NOUN"), ("sv", "A1", "ab", "e\u0301", "", "NOUN")).withColumns({"action": F.lit("keep"), "initial": F.when(F.col("ord") == 2, "ö")})
    assert [r.problem for r in gates.candidate_problems(more).orderBy("ord").collect()] == ["digit", None, "nfc"]


def test_sentences(spark):
    schema = "sent_id string, lang string, text string, target_ids array<string>, targets array<struct<id:string,lemma:string,pos:string>>, tokens array<struct<id:int,form:string,lemma:string,upos:string>>"
    good = ("s1", "de", "Der Hund geht.", ["t1"], [("t1", "hund", "NOUN")], [(1, "Der", "der", "DET"), (2, "Hund", "Hund", "NOUN"), (3, "geht", "gehen", "VERB"), (4, ".", ".", "PUNCT")])
    bad = ("s2", "de", "Der hund geht.", ["t2"], [("t1", "katze", "NOUN")], [(1, "Der", "der", "DET"), (3, "hund", "hund", "NOUN"), (4, "geht", "geht", "VERB"), (5, ".", "!", "PUNCT")])
    got = {r.sent_id: set(r.problems) for r in gates.sentence_problems(spark.createDataFrame([good, bad], schema)).collect()}
    assert got == {"s1": set(), "s2": {"token_ids", "punct_lemma", "target_ids", "missing_target", "de_noun", "de_verb"}}
    zh = ("s3", "zh", "狗。", ["t"], [("t", "狗", "NOUN")], [(1, "狗", "狗", "NOUN"), (2, "。", "。", "PUNCT")])
    ar = ("s4", "ar", "bayt ok.", ["t"], [("t", "bayt", "NOUN")], [(1, "bayt", "bayt", "NOUN"), (2, "ok", "ok", "X"), (3, ".", ".", "PUNCT")])
    loose = ("s5", "fr", "e\u0301te\u0301", ["t"], [("t", "ÉTÉ", "NOUN")], [(1, "été", "été", "NOUN")])
    got = {r.sent_id: set(r.problems) for r in gates.sentence_problems(spark.createDataFrame([zh, ar, loose], schema)).collect()}
    assert got == {"s3": set(), "s4": {"ar_script", "tag_x"}, "s5": {"nfc", "text"}}
    b = spark.createDataFrame([("b", 1, "x", "t"), ("b", 2, "y", "t"), ("c", 1, "z", "u")], "batch string, place int, sent_id string, text string")
    assert rows_of(gates.batch_problems(b, b.select("batch", "place", "sent_id"))) == [("b", "repeated_text")]
    assert rows_of(gates.batch_problems(b.where("place = 1"), b.select("batch", "place", "sent_id"))) == [("b", "order")]
    assert [r.unique_ids for r in gates.repeated_ids(spark.createDataFrame([good], schema), "tokens", "id").collect()] == [True]
