import random
from datetime import datetime, timedelta

from gradelex.llm.survivor import STAND_INS, survivors
from tests.conftest import rows_of

SCHEMA = "copy_id bigint, lang string, level string, lemma string, english_lemma string, chinese_lemma string, upos string, origin string, updated_at timestamp_ntz, trust string, n string, x string"
TRUST = {"manual": 5, "model": 2, "scrape": 0}
T0 = datetime(2025, 1, 1)


def usable(g):
    if g is None:
        return None
    words = "".join(c if c.isalnum() else " " for c in g.lower()).split()
    return None if not words or " ".join(words) in STAND_INS else g.strip()


def brute(rows):
    groups, out = {}, []
    for r in rows:
        groups.setdefault((r[1], r[3], r[6]), []).append(r)
    for g in groups.values():
        if len(g) < 2:
            continue
        levels = [x for r in g if (x := (r[2] or "").strip().upper()) in ("A1", "A2", "B1", "B2", "C1")]
        have = [r for r in g if usable(r[4])]
        best = max(have, key=lambda r: (TRUST.get(r[7], -1), r[8] or datetime.min, -r[0]), default=None)
        glosses = {usable(r[4]).lower() for r in have}
        out.append((min(r[0] for r in g), min(levels, default=None), usable(best[4]) if best else None, "yes" if len(glosses) > 1 else "no"))
    return sorted(out, key=repr)


def layers(points):
    """Dominance layers by peeling; a point has the set of its fields, trust and recency."""
    left, n = list(points), 0
    while left:
        dom = lambda a, b: a != b and a[0] >= b[0] and a[1] >= b[1] and a[2] >= b[2]
        front = [p for p in left if not any(dom(q, p) for q in left)]
        left = [p for p in left if p not in front]
        n += 1
    return n


def data(n=1500):
    r = random.Random(8)
    rows = []
    for i in range(n):
        hot = r.random() < 0.33
        gloss = r.choice(["House", "house ", " barn", "n/a", "--", "[missing]", "T.B.D.", None, "", "\xa0", "none"])
        rows.append((i, "en", r.choice(["A1", " b2", "c1", "A0", None, ""]), "hot" if hot else r.choice([*"abcdefghijk", None, ""]), gloss, r.choice([None, "房", "?"]), r.choice(["NOUN", None]), r.choice([*TRUST, "odd", None]), r.choice([None, T0 + timedelta(days=r.randrange(5))]), "t", "n", "x"))
    return rows


def test_against_brute_force(spark):
    rows = data()
    trust = spark.createDataFrame(list(TRUST.items()), "origin string, trust int")
    got = survivors(spark.createDataFrame(rows, SCHEMA).repartition(6), trust)
    assert rows_of(got, "first_id", "kept_level", "kept_english_lemma", "conflict") == brute(rows)


def test_layers(spark):
    rows = data(300)
    trust = spark.createDataFrame(list(TRUST.items()), "origin string, trust int")
    groups = {}
    for r in rows:
        cell = (frozenset(i for i in (4, 5) if usable(r[i])), TRUST.get(r[7], -1))
        g = groups.setdefault((r[1], r[3], r[6]), [0, {}])
        g[0] += 1
        g[1][cell] = max(g[1].get(cell, (datetime.min, -(10**9))), (r[8] or datetime.min, -r[0]))
    want = {}
    for key, (n, cells) in groups.items():
        if n > 1:
            want[key] = layers({(*cell, at) for cell, at in cells.items()})
    assert max(want.values()) > 2
    got = {(x.lang, x.lemma, x.upos): x.layers for x in survivors(spark.createDataFrame(rows, SCHEMA), trust).collect()}
    assert got == want


def test_fields_come_from_the_skyline(spark):
    trust = spark.createDataFrame(list(TRUST.items()), "origin string, trust int")
    row = lambda i, lemma, english, chinese, origin, day: (i, "en", "A1", lemma, english, chinese, "X", origin, T0 + timedelta(days=day), "", "", "")
    # u: 1 is as trusted and late as 2 and has the smaller id, 2 is more complete; w: 3 has no English; v: 7 is dominated by 6 and gives nothing
    rows = [row(1, "u", "house", None, "manual", 1), row(2, "u", "barn", "仓", "manual", 1), row(3, "w", None, "房", "manual", 2), row(4, "w", "house", None, "manual", 1), row(5, "w", "barn", "仓", "scrape", 0)]
    rows += [row(6, "v", "house", "房", "manual", 2), row(7, "v", "barn", None, "scrape", 1), row(8, "v", None, None, "scrape", 0)]
    got = survivors(spark.createDataFrame(rows, SCHEMA), trust)
    assert rows_of(got, "lemma", "kept_english_lemma", "kept_chinese_lemma", "skyline", "layers") == [("u", "house", "仓", 2, 1), ("v", "house", "房", 1, 3), ("w", "house", "房", 3, 1)]
    # the kept gloss hangs on the layers
    assert "aggregate(" in got.select("kept_english_lemma")._jdf.queryExecution().optimizedPlan().toString()


def test_empty_and_repeated(spark):
    trust = spark.createDataFrame([("manual", 5), ("manual", 5)], "origin string, trust int")
    df = spark.createDataFrame([(1, "en", "A1", "w", "g" * 100_000, None, "X", "manual", None, "", "", "")] * 2, SCHEMA)
    row = survivors(df, trust).collect()
    assert len(row) == 1 and row[0].n_copies == 2 and len(row[0].kept_english_lemma) == 100_000
    assert survivors(df.limit(0), trust).count() == 0
