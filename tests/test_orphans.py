import random
from datetime import datetime, timedelta

from gradelex.operators.orphans import decision_orphans, orphan_references, orphan_report
from tests.conftest import rows_of

T0 = datetime(2025, 1, 1)
REF, PARENT = "k1 bigint, k2 bigint, t timestamp_ntz, id bigint, grp string, period string", "k1 bigint, k2 bigint, valid_from timestamp_ntz, valid_to timestamp_ntz, id bigint"


def brute(refs, parents):
    lost = []
    for k1, k2, t, i, g, p in refs:
        ok = None not in (k1, k2, t) and any(a == k1 and b == k2 and f is not None and f <= t and (e is None or t < e) for a, b, f, e, _ in parents)
        if not ok:
            lost.append((i, g, p))
    return sorted(lost, key=repr)


def test_against_brute_force(spark):
    """A third of the references and half of the parents have one key, which spreads over several ranges."""
    r = random.Random(5)
    at = lambda: T0 + timedelta(hours=r.randrange(200))
    key = lambda hot: 7 if r.random() < hot else r.randrange(-20, 20)
    parents = []
    for i in range(600):
        f = at()
        k = key(0.5)
        parents.append((None if r.random() < 0.02 else k, k % 3, None if r.random() < 0.02 else f, None if r.random() < 0.1 else f + timedelta(hours=r.randrange(0, 4)), i))
    parents += parents[:50]
    refs = [(None if r.random() < 0.02 else (k := key(0.33)), (k or 0) % 3, None if r.random() < 0.02 else at(), i, r.choice(["a", None]), "2025-01") for i in range(900)]
    refs += refs[:30]
    for n in (1, 3, 16):
        got = orphan_references(spark.createDataFrame(refs, REF).repartition(5), spark.createDataFrame(parents, PARENT).repartition(3), n)
        assert rows_of(got) == brute(refs, parents)


def test_one_key_over_all_ranges(spark):
    """One long-lived parent far before its references, which lie in other ranges."""
    parents = [(1, 1, T0, None, 0)]
    refs = [(1, 1, T0 + timedelta(minutes=i), i, "g", "p") for i in range(500)] + [(1, 2, T0, 1000, "g", "p"), (1, 1, T0 - timedelta(days=1), 1001, "g", "p")]
    got = orphan_references(spark.createDataFrame(refs, REF), spark.createDataFrame(parents, PARENT), 8)
    assert rows_of(got) == [(1000, "g", "p"), (1001, "g", "p")]


def test_empty_tables(spark):
    none_r, none_p = spark.createDataFrame([], REF), spark.createDataFrame([], PARENT)
    one = spark.createDataFrame([(1, 1, T0, 5, "g", "p")], REF)
    assert rows_of(orphan_references(none_r, none_p)) == []
    assert rows_of(orphan_references(one, none_p)) == [(5, "g", "p")]


WORD = "struct<lemma:string,english_lemma:string,chinese_lemma:string,upos:string>"
DEC = f"decision_id bigint, round string, list_id string, line int, expected {WORD}, decided_at timestamp_ntz, h1 string, id string"
ENT = "entry_id bigint, list_id string, csv_line int, lemma string, pos string, added_at timestamp_ntz, removed_at timestamp_ntz, kind string"


def test_decisions(spark):
    day = timedelta(days=1)
    entries = spark.createDataFrame([(1, "l", 2, "Straße", "NOUN", T0, T0 + 10 * day, "x"), (2, "l", 3, "été", "NOUN", T0, None, "x"), (3, "l", 4, None, "NOUN", T0, None, "x")], ENT)
    exp = lambda lemma, pos="NOUN": (lemma, None, None, pos)
    dec = [
        (1, "r1", "l", 2, exp(" STRASSE "), T0 + day, "x", "x"),
        (2, "r1", "l", 2, exp("Straße"), T0 + 10 * day, "x", "x"),  # removed at this moment
        (3, "r1", "l", 2, exp("Straße"), T0, "x", "x"),  # added at this moment
        (4, "r1", "l", 3, exp("ÉTÉ", " noun"), T0 + 400 * day, "x", "x"),
        (5, "r2", "l", 3, exp("ete"), T0 + day, "x", "x"),
        (6, "r2", None, 3, exp("ete"), T0 + day, "x", "x"),
        (7, "r2", "l", 4, exp(None), T0 + day, "x", "x"),
        (8, None, "l", 2, exp("Straße"), None, "x", "x"),
        (9, "r2", "l", 2, exp("s" * 200_000), T0 + day, "x", "x"),
    ]
    d = spark.createDataFrame(dec, DEC)
    got = decision_orphans(d, entries)
    assert rows_of(got) == sorted([("r1", "2025-01", 2), ("r2", "2025-01", 5), ("r2", "2025-01", 7), (None, None, 8), ("r2", "2025-01", 9)], key=repr)
    assert ("level_entry", "r1", "2025-01", 3, 1) in rows_of(orphan_report(got, d))
