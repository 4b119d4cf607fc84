"""Duplicates hidden by formatting differences: commutative multiset hashing of normalised fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.functions.text import nfc_fold
from gradelex.llm.groups import group_rows


def _plain(c: Column) -> Column:
    """Letters, digits and marks in one case and one canonical spelling; null counts as empty."""
    return F.coalesce(F.regexp_replace(nfc_fold(c), r"[^\p{L}\p{N}\p{M}]", ""), F.lit(""))


def _sum_hash(names: list[Column | None], values: list[Column], seed: int) -> Column:
    """Sum of the hashes of (field name, value) pairs, a hash of the multiset: it does not depend on the order.
    Each hash is cut to 58 bits, so that the sum of up to 32 fields cannot overflow."""
    total = F.lit(0).cast("bigint")
    for name, value in zip(names, values, strict=True):
        total = total + F.shiftright(F.xxhash64(F.lit(seed), *([] if name is None else [name]), value), 6)
    return total


def _same_multiset(left: list[Column], right: list[Column]) -> Column:
    """Whether two lists hold the same values equally often, by counting instead of sorting."""
    count = lambda value, among: sum((F.when(value == x, 1).otherwise(0) for x in among), F.lit(0))
    ok = F.lit(True)
    for v in left:
        ok = ok & (count(v, left) == count(v, right))
    return ok


def hidden_copies(df: DataFrame, id_col: str, fields: list[str], any_column: bool = True) -> DataFrame:
    """A row (id_col, first_id, n_copies) for each row of df: the smallest id of its group of copies and their number.

    Two rows are copies when their fields hold the same letters and digits once case, white space and
    punctuation are disregarded; any_column: in whichever of the fields each value stands, else field by field.
    Null equals empty, and all-empty rows are copies of one another. Repeated ids are one row of their own each.
    Further columns of df are ignored, whatever their names.

    Rows are reduced to a 116-bit fingerprint and grouped with a map-side combine. The spellings that occur under a fingerprint are then
    verified to hold the same values, by counting and not by sorting; where they do not (a collision) each
    spelling goes with the first one it equals. Rows meet their group with salts for large groups.
    """
    names = [None if any_column else F.lit(f) for f in fields]
    v = [f"v{i}" for i in range(len(fields))]
    slim = df.select(F.col(id_col).alias("id"), *[_plain(F.col(f)).alias(c) for f, c in zip(fields, v, strict=True)])
    prints = slim.withColumn("f1", _sum_hash(names, [F.col(c) for c in v], 1)).withColumn("f2", _sum_hash(names, [F.col(c) for c in v], 2))
    alike = (lambda x, y: _same_multiset([x[c] for c in v], [y[c] for c in v])) if any_column else (lambda x, y: x == y)
    return group_rows(prints, v, alike).select(F.col("id").alias(id_col), "first_id", F.col("n").alias("n_copies"))


def collapsed(copies: DataFrame) -> DataFrame:
    """One row (first_id, n_copies) for each group."""
    return copies.groupBy("first_id").agg(F.max("n_copies").alias("n_copies"))
