from pyspark.sql import functions as F

from gradelex.operators.keep import keep_first, keep_latest, ranked, repeats
from gradelex.operators.spread import join_groups
from tests.conftest import rows_of


def test_hot_groups_keep_every_row(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 600, 1).otherwise(F.col("id") % 50).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"))
    want = rows_of(rows.join(groups, "k").select("id", "k", "n", "lo"))
    for least in (10, 100, 10_000):
        assert rows_of(join_groups(rows, groups, ["k"], "n", "id", 1000, least=least).select("id", "k", "n", "lo")) == want


def test_first_latest_and_rank(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, None, "w"), (5, "b", "v")], "o int, k string, v string")
    assert rows_of(keep_first(df, ["k"], "o"), "o") == [(1,), (3,), (5,)]
    assert rows_of(repeats(df, ["k"], "o"), "o") == [(2,), (4,)]
    assert rows_of(keep_latest(df, ["k"], ["o"]), "o") == [(2,), (4,), (5,)]
    words = spark.createDataFrame([("g", w) for w in ["b", "", "ab", "abc", "a", "ä", "B", "zz"]], "g string, w string")
    assert [w for w, _ in sorted(((r.w, r.p) for r in ranked(words, ["g"], "w", "p").collect()), key=lambda x: x[1])] == sorted(["b", "", "ab", "abc", "a", "ä", "B", "zz"])


def test_numbers_and_sums_of_a_hot_key(spark):
    import random

    from gradelex.operators.batching import exclusion_prefix
    from gradelex.operators.keep import numbered, running_sum
    from gradelex.operators.sampling import spread_targets

    r = random.Random(1)
    rows = [("hot" if r.random() < 0.5 else r.choice("ab"), r.choice([None, *range(3000)]), i, r.randrange(5), r.choice(["NOUN", "ADP"])) for i in range(2000)]
    df = spark.createDataFrame(rows, "list_id string, line int, ord int, cost int, pos string").repartition(5)
    part = F.coalesce(F.floor(F.col("line") / 500), F.lit(-1))
    got = {x.ord: (x.n, x.s) for x in running_sum(numbered(df, ["list_id"], ["line", "ord"], part, "n"), ["list_id"], ["line", "ord"], part, "cost", "s").collect()}
    spread = {x.ord: x.bucket for x in spread_targets(df, 7).collect()}
    for key in ("hot", "a", "b"):
        own = sorted((x for x in rows if x[0] == key), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        total = 0
        for place, x in enumerate(own, 1):
            total += x[3]
            assert got[x[2]] == (place, total)
        by_content = sorted(own, key=lambda x: (x[4] != "NOUN", x[1] is not None, x[1] or 0, x[2]))
        q, more = divmod(len(own), 7)
        want = [b for b in range(1, 8) for _ in range(q + (b <= more))]
        assert [spread[x[2]] for x in by_content] == want
    assert exclusion_prefix(df.withColumn("o", F.col("ord")), ["list_id"], "o", "cost", 50).agg(F.max("running")).collect()[0][0] <= 50
