"""Groups of rows with one fingerprint, verified by their values."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.operators.spread import join_groups
from gradelex.session import cut


def group_rows(rows: DataFrame, values: list[str], alike: Callable[[Column, Column], Column]) -> DataFrame:
    """(id, first_id, n) for each of rows (id, f1, f2, values): the smallest id of its group and the group's size.

    Rows of one fingerprint (f1, f2) are one group if all forms (values as they stand) that occur under it are alike; where they are
    not, as fingerprints collide, each form belongs to the first form it is like. alike compares two structs of the values.
    Distinct forms are collected per fingerprint, of which there are no more than ways to write one group's values, so neither
    the rows of a group nor their values are gathered, and rows meet their group without their values, salted where it is large.
    """
    forms = F.collect_set(F.struct(*values))
    groups = rows.groupBy("f1", "f2").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"), forms.alias("forms"))
    sound = F.forall("forms", lambda x: alike(x, F.col("forms")[0]))
    groups = cut(groups.select("f1", "f2", "first_id", "n", F.when(~sound, F.col("forms")).alias("forms")))
    total, clashes = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("forms")).first()
    good = join_groups(rows.select("id", "f1", "f2"), groups.where("forms is null").select("f1", "f2", "first_id", "n"), ["f1", "f2"], "n", "id", total).select("id", "first_id", "n")
    if not clashes:
        return good
    kinds = groups.where("forms is not null").withColumn("x", F.explode("forms"))
    kinds = kinds.select("f1", "f2", "x", F.array_position(F.transform("forms", lambda y: alike(y, F.col("x"))), True).alias("k"))
    own = rows.select("id", "f1", "f2", F.struct(*values).alias("y")).alias("r").join(kinds.alias("s"), reduce(lambda a, b: a & b, [F.col("r.f1") == F.col("s.f1"), F.col("r.f2") == F.col("s.f2"), F.col("y").eqNullSafe(F.col("x"))]))
    own = own.select("id", "r.f1", "r.f2", "k")
    parts = own.groupBy("f1", "f2", "k").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return good.unionByName(join_groups(own, parts, ["f1", "f2", "k"], "n", "id", total).select("id", "first_id", "n"))
