"""References to records that do not exist: range-partitioned keys, sorted parent arrays, binary search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradelex.functions.text import key64, nfc_fold
from gradelex.session import cut

NEVER = np.iinfo(np.int64).max
NONE = np.iinfo(np.int64).min
MISS, PENDING, SUMMARY = 0, 1, 2
_OUT = "tag tinyint, part int, h1 bigint, h2 bigint, t bigint, upto bigint, id bigint, grp string, period string"
_PA = pa.schema([("tag", pa.int8()), ("part", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("t", pa.int64()), ("upto", pa.int64()), ("id", pa.int64()), ("grp", pa.string()), ("period", pa.string())])


class _Parents:
    """The parents of one range as arrays sorted by key and time, with the running maximum of their end per key."""

    def __init__(self, parts: list[pa.RecordBatch]) -> None:
        column = lambda n: np.concatenate([np.zeros(0, np.int64), *[b.column(n).cast(pa.int64()).fill_null(NEVER).to_numpy() for b in parts]])
        self.h1, self.h2, self.t, ends = (column(n) for n in ("h1", "h2", "t", "upto"))
        new = np.ones(len(self.h1), bool)
        new[1:] = (self.h1[1:] != self.h1[:-1]) | (self.h2[1:] != self.h2[:-1])
        self.start = np.flatnonzero(new)  # of each key
        self.stop = np.append(self.start[1:], len(self.h1))
        self.reach = pd.Series(ends).groupby(np.cumsum(new) - 1).cummax().to_numpy() if len(ends) else ends

    def head(self) -> tuple[int, int] | None:
        return (int(self.h1[0]), int(self.h2[0])) if len(self.h1) else None

    def best(self, h1: np.ndarray, h2: np.ndarray, t: np.ndarray) -> np.ndarray:
        """How far the parents of each reference's key reach that had begun by its time; NONE without any. The key is found by binary search
        among the keys, the last parent that had begun by one among its parents, for all references at once."""
        out = np.full(len(h1), NONE)
        if not len(self.start):
            return out
        keys1, keys2 = self.h1[self.start], self.h2[self.start]
        at = np.minimum(np.searchsorted(keys1, h1), len(keys1) - 1)
        # keys with the same first half are rare and lie side by side
        while (on := np.flatnonzero((keys1[at] == h1) & (keys2[at] < h2) & (at + 1 < len(keys1)))).size:
            step = keys1[np.minimum(at[on] + 1, len(keys1) - 1)] == h1[on]
            if not step.any():
                break
            at[on[step]] += 1
        hit = np.flatnonzero((keys1[at] == h1) & (keys2[at] == h2))
        lo, hi, when = self.start[at[hit]].copy(), self.stop[at[hit]].copy(), t[hit]
        first = lo.copy()
        while (on := np.flatnonzero(lo < hi)).size:
            mid = (lo[on] + hi[on]) // 2
            begun = self.t[mid] <= when[on]
            lo[on] = np.where(begun, mid + 1, lo[on])
            hi[on] = np.where(begun, hi[on], mid)
        some = lo > first
        out[hit[some]] = self.reach[lo[some] - 1]
        return out


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of keys: first its parents, by key and time, which are kept as sorted arrays; then its references, by key, batch by batch, each of
    which is looked up in them by binary search. Yields misses, the references of the range's first key that an earlier range might still
    satisfy, and a summary: the range's last key with parents and how far they reach."""
    part = TaskContext.get().partitionId()
    held: list[pa.RecordBatch] = []
    parents: _Parents | None = None
    first: tuple[int, int] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        n = int((b.column("kind").to_numpy(zero_copy_only=False) == 0).sum())  # parents come first
        if n:
            held.append(b.slice(0, n))
        if n == b.num_rows:
            continue
        refs = b.slice(n)
        h1, h2 = (refs.column(c).to_numpy() for c in ("h1", "h2"))
        if parents is None:
            parents = _Parents(held)
            first = min((int(h1[0]), int(h2[0])), parents.head() or (int(h1[0]), int(h2[0])))
        moments = refs.column("t").cast(pa.int64())
        t = moments.to_numpy()
        lost = np.flatnonzero(parents.best(h1, h2, t) <= t)
        if len(lost):
            of_first = (h1[lost] == first[0]) & (h2[lost] == first[1])
            rows = refs.take(pa.array(lost))
            nothing = pa.nulls(len(lost), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.where(of_first, PENDING, MISS).astype(np.int8)), pa.array(np.full(len(lost), part, np.int32)), rows.column("h1"), rows.column("h2"), moments.take(pa.array(lost)), nothing, rows.column("id"), rows.column("grp"), rows.column("period")], schema=_PA)
    parents = parents or _Parents(held)
    if len(parents.h1):
        yield pa.RecordBatch.from_pydict({"tag": [SUMMARY], "part": [part], "h1": [int(parents.h1[-1])], "h2": [int(parents.h2[-1])], "t": [None], "upto": [int(parents.reach[-1])], "id": [None], "grp": [None], "period": [None]}, schema=_PA)


def orphan_references(refs: DataFrame, parents: DataFrame, partitions: int | None = None) -> DataFrame:
    """References without a parent that is valid at the time of the reference.

    refs: k1, k2 (bigint key hashes, null where the key can match nothing), t (timestamp), id (bigint), grp, period (strings).
    parents: k1, k2, valid_from, valid_to (timestamps; null valid_to: without end), id (bigint).
    Returns id, grp, period of each orphan.

    A reference with a null key or time is an orphan; a parent with a null key or start satisfies nothing.
    Repeated parents and references are kept as they are. Ranges are cut on (key, time, kind, id), so one
    key of any size spreads over several ranges; what a range needs to know of the ranges before it is one
    row per range (the last key with parents and how far they reach), joined to the few open references. A task holds the parents of its range, a
    share of all as small as there are ranges, in four arrays of numbers; references pass by in batches.
    """
    spark = refs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sure = refs.where("k1 is null or k2 is null or t is null").select("id", "grp", "period")
    probes = refs.where("k1 is not null and k2 is not null and t is not null").select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("t").cast("timestamp_ntz").alias("t"), F.lit(1).cast("tinyint").alias("kind"), F.lit(None).cast("timestamp_ntz").alias("upto"), "id", "grp", "period")
    held = parents.where("k1 is not null and k2 is not null and valid_from is not null").select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("valid_from").cast("timestamp_ntz").alias("t"), F.lit(0).cast("tinyint").alias("kind"), F.col("valid_to").cast("timestamp_ntz").alias("upto"), "id", F.lit(None).cast("string").alias("grp"), F.lit(None).cast("string").alias("period"))
    ranged = held.unionByName(probes).repartitionByRange(n, "h1", "h2", "t", "kind", "id").sortWithinPartitions("kind", "h1", "h2", "t")
    out = cut(ranged.mapInArrow(_probe, _OUT))
    pending, reached = out.where(F.col("tag") == PENDING).alias("p"), out.where(F.col("tag") == SUMMARY).select("part", "h1", "h2", "upto").alias("s")
    # one summary row per range: as many rows as there are partitions
    open_ = pending.join(F.broadcast(reached), F.expr("p.h1 = s.h1 and p.h2 = s.h2 and s.part < p.part and s.upto > p.t"), "left_anti")
    return out.where(F.col("tag") == MISS).select("id", "grp", "period").unionByName(open_.select("id", "grp", "period")).unionByName(sure)


def _key(seed: int, list_id: Column, line: Column, lemma: Column, upos: Column) -> Column:
    known = list_id.isNotNull() & line.isNotNull() & lemma.isNotNull() & upos.isNotNull()
    return F.when(known, key64(list_id, line.cast("bigint"), lemma, upos, seed=seed))


def decision_orphans(decisions: DataFrame, entries: DataFrame) -> DataFrame:
    """round, period, decision_id of decisions whose expected entry did not exist when they were taken.

    Decisions with a null list_id or line refer to nothing and are left out. Lemma and tag compare
    by nfc_fold; a null expected lemma or tag, or a null decided_at, is an orphan.
    """
    refs = decisions.where("list_id is not null and line is not null").select(F.col("decision_id").alias("id"), F.col("round").alias("grp"), F.date_format("decided_at", "yyyy-MM").alias("period"), F.col("decided_at").alias("t"), "list_id", "line", nfc_fold("expected.lemma").alias("lemma"), nfc_fold("expected.upos").alias("upos"))
    held = entries.select(F.col("entry_id").alias("id"), F.col("added_at").alias("valid_from"), F.col("removed_at").alias("valid_to"), "list_id", F.col("csv_line").alias("line"), nfc_fold("lemma").alias("lemma"), nfc_fold("pos").alias("upos"))
    cols = [F.col(c) for c in ("list_id", "line", "lemma", "upos")]
    refs, held = (d.withColumn("k1", _key(1, *cols)).withColumn("k2", _key(2, *cols)).drop("list_id", "line", "lemma", "upos") for d in (refs, held))
    return orphan_references(refs, held).select(F.col("grp").alias("round"), "period", F.col("id").alias("decision_id"))


def orphan_report(orphans: DataFrame, decisions: DataFrame) -> DataFrame:
    """Orphans and their share per referenced table, round and month; rounds and months without orphans have 0."""
    total = decisions.where("list_id is not null and line is not null").groupBy("round", F.date_format("decided_at", "yyyy-MM").alias("period")).agg(F.count(F.lit(1)).alias("n_refs"))
    lost = orphans.groupBy("round", "period").agg(F.count(F.lit(1)).alias("n_lost"))
    joined = total.alias("a").join(lost.alias("b"), F.expr("a.round <=> b.round and a.period <=> b.period"), "left")
    return joined.select(F.lit("level_entry").alias("parent_table"), "a.round", "a.period", "n_refs", F.coalesce("n_lost", F.lit(0)).cast("bigint").alias("n_orphans"))
