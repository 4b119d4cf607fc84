import random
from datetime import datetime, timedelta

from gradelex.operators.snapshots import snapshot_changes
from tests.conftest import rows_of

SCHEMA = "snapshot_no int, entry_key string, delivered_at timestamp_ntz, a string, b string, s string, k string, x int"


def brute(rows):
    latest = {}
    for n, key, at, a, b, *_ in rows:
        if n is not None and ((n, key) not in latest or (at is not None, at or datetime.min) > (latest[n, key][0] is not None, latest[n, key][0] or datetime.min)):
            latest[n, key] = (at, (a, b))
    numbers = sorted({n for n, _ in latest})
    out = []
    for last, n in zip(numbers, numbers[1:], strict=False):
        for key in {k for m, k in latest if m in (last, n)}:
            now, before = latest.get((n, key)), latest.get((last, key))
            change = "added" if before is None else "removed" if now is None else "changed" if now[1] != before[1] else None
            if change:
                out.append((n, key, change))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    r = random.Random(2)
    rows, at = [], 0
    for n in (1, 2, 3, 4, 6):
        for k in [*"abcdefghij", None, ""]:
            for _ in range(r.choice([0, 1, 1, 2, 30 if k == "a" else 1])):
                at += 1
                rows.append((n, k, datetime(2025, 1, 1) + timedelta(seconds=at * 7 % 1000, microseconds=at), r.choice(["x", "X", None, ""]), r.choice(["y", None]), "", "", 1))
    rows += [(None, "a", None, "x", "y", "", "", 1), (2, "zz", None, "x", "y", "", "", 1)]
    got = snapshot_changes(spark.createDataFrame(rows, SCHEMA).repartition(4), "entry_key", "snapshot_no", "delivered_at", ["a", "b"])
    assert rows_of(got) == brute(rows)


def test_ties_nulls_and_empty(spark):
    t = datetime(2025, 1, 1)
    rows = [(1, "k", t, "u", None, "", "", 1), (2, "k", t, "u", None, "", "", 1), (1, "n", t, "a", None, "", "", 1), (2, "n", t, None, "a", "", "", 1), (2, "n", t, None, "a", "", "", 1)]
    make = lambda x: snapshot_changes(spark.createDataFrame(x, SCHEMA), "entry_key", "snapshot_no", "delivered_at", ["a", "b"])
    assert rows_of(make(rows)) == rows_of(make(rows[::-1])) == [(2, "n", "changed")]
    assert make([]).count() == 0


def test_numbers_with_gaps(spark):
    t = datetime(2025, 1, 1)
    rows = [(n, "k", t, v, None, "", "", 1) for n, v in ((10, "a"), (20, "b"), (30, "b"))] + [(n, "gone", t, "x", None, "", "", 1) for n in (10, 30)]
    got = snapshot_changes(spark.createDataFrame(rows, SCHEMA), "entry_key", "snapshot_no", "delivered_at", ["a", "b"])
    assert rows_of(got) == [(20, "gone", "removed"), (20, "k", "changed"), (30, "gone", "added")]
