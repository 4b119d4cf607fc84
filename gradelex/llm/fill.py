"""Filling fixed-capacity containers: vector best-fit over token, document and attention-cost capacities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradelex.llm.bpe import DEFAULT_DIR, count_tokens, shipped, vocabulary
from gradelex.session import cut

#: items packed together; containers are not shared between blocks
BLOCK = 8192


def best_fit(sizes: np.ndarray, capacity: int, max_docs: int, attention: float, rule: str = "norm") -> np.ndarray:
    """Container number of each item, by vector best-fit decreasing.

    Each container has three capacities: tokens, number of documents, and attention cost (the sum of squared sizes).
    Items go in order of falling size; of the containers that hold an item under every constraint, rule "norm" takes the
    one with the smallest weighted norm of what is left after it, rule "dot" the one whose residual has the largest
    weighted dot product with the item. Weights are the mean demand of the items in each dimension. An item that fits
    nowhere opens a container, also one that alone is over the attention cost. No size may exceed the capacity.
    """
    n = len(sizes)
    limit = np.array([capacity, max_docs, attention], float)
    demand = np.stack([sizes, np.ones(n), sizes.astype(float) ** 2], 1) / limit
    weight = demand.mean(0) / max(demand.mean(), 1e-12) if n else np.ones(3)
    left = np.ones((3, max(16, n)))
    number = np.zeros(max(16, n), np.int64)  # of the container in each open slot
    out = np.empty(n, np.int64)
    slots = opened = 0
    order = np.argsort(-sizes, kind="stable")
    least = demand[order[-1]] if n else None
    slack = 1e-9
    for step, i in enumerate(order.tolist()):
        x = demand[i]
        rest = left[:, :slots]
        fits = (rest[0] >= x[0] - slack) & (rest[1] >= x[1] - slack) & (rest[2] >= x[2] - slack)
        at = np.flatnonzero(fits)
        if len(at):
            r = rest[:, at]
            if rule == "dot":
                best = at[(weight @ (r * x[:, None])).argmax()]
            else:
                best = at[(weight @ (r - x[:, None]) ** 2).argmin()]
        else:
            best = slots
            left[:, best] = 1.0
            number[best] = opened
            opened += 1
            slots += 1
        left[:, best] -= x
        out[i] = number[best]
        if step % 256 == 255:  # containers that cannot hold even the smallest item are closed
            keep = np.flatnonzero((left[:, :slots] >= least[:, None] - slack).all(0))
            left[:, : len(keep)], number[: len(keep)] = left[:, keep], number[keep]
            slots = len(keep)
    return out


#: equal rows that one row of the count table is unfolded into at once
UNFOLD = 100_000


def _spread_out(sizes: DataFrame) -> DataFrame:
    """(id, t, k) for each of sizes (id, t), k telling equal rows apart. They are counted first, and a great many of them are unfolded
    by several tasks."""
    n = sizes.groupBy("id", "t").agg(F.count(F.lit(1)).alias("n"))
    few = n.where(F.col("n") <= UNFOLD).select("id", "t", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("k"))
    parts = n.where(F.col("n") > UNFOLD).select("id", "t", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / UNFOLD))).alias("part")).repartition("id", "t", "part")
    many = parts.select("id", "t", F.explode(F.sequence(F.col("part") * UNFOLD + 1, F.least(F.col("n"), (F.col("part") + 1) * UNFOLD))).alias("k"))
    return few.unionByName(many)


def pack_documents(docs: DataFrame, budgets: DataFrame, id_col: str = "doc_id", text_col: str = "text", directory: str = DEFAULT_DIR, name: str = "byte_bpe_50k", docs_per_container: float = 1 / 16, attention_share: float = 0.9) -> DataFrame:
    """Containers for each capacity in budgets (pack_name, capacity_tokens; at most 100 rows, else an error).

    A row for each item: pack_name, container (string), id_col, piece, first_token, n_tokens. A document is one item;
    one of more tokens than the capacity is split into pieces of the full capacity and one rest, numbered from 0.
    Other capacities of a container: capacity * docs_per_container documents (one at least) and an attention cost, the sum of squared
    sizes, of attention_share * capacity^2; at a share of 1 the latter could never bind, as the squares of sizes that fit sum to less. An item that alone costs more has a container of its own, as no item is split for its cost.
    Null and empty texts have no tokens and need no container: a row with a null container and 0 tokens. Repeated rows and null ids
    are items like any other; further columns are ignored.

    Tokens are counted where the texts are read, and only ids and sizes go on. They are spread over blocks of about BLOCK items by
    the hash of id and size, so containers do not depend on how the input is split into files and tasks, no block is hot, and
    only the last container of a block may be left part empty.
    """
    packs = sorted(tuple(r) for r in budgets.select("pack_name", "capacity_tokens").limit(101).collect())
    if len(packs) > 100:
        raise ValueError("more than 100 capacities")
    path = shipped(docs.sparkSession, vocabulary(directory, name))
    slim = docs.select(F.col(id_col).alias("id"), text_col)
    kind = slim.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count_tokens(b.column(1), path()), pa.int64())], names=["id", "t"])

    def pack(ids: pa.Array, tokens: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
        for pack_name, capacity in packs:
            pieces = np.maximum(1, -(-tokens // capacity))
            item = np.repeat(np.arange(len(tokens)), pieces)
            nth = np.arange(len(item)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            size = np.minimum(tokens[item] - nth * capacity, capacity)
            real = size > 0
            bins = best_fit(size[real], capacity, max(1, int(capacity * docs_per_container)), attention_share * capacity**2)
            label = np.full(len(item), None, object)
            label[real] = [f"{pack_name}-{block}-{b}" for b in bins.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([pack_name] * len(item), pa.string()), pa.array(label, pa.string()), ids.take(pa.array(item)), pa.array(nth.astype(np.int32)), pa.array(nth * capacity, pa.int64()), pa.array(size, pa.int64())], names=["pack_name", "container", id_col, "piece", "first_token", "n_tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks come one after the other, each in the order of its ids and sizes."""
        held: list[pa.RecordBatch] = []
        own: int | None = None
        for b in batches:
            block = b.column(0).to_numpy()
            bounds = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
            for at, to in zip(bounds.tolist(), [*bounds[1:].tolist(), len(block)], strict=True):
                if held and int(block[at]) != own:
                    yield from pack(pa.concat_arrays([x.column(1) for x in held]), np.concatenate([x.column(2).to_numpy() for x in held]), own)
                    held = []
                own = int(block[at])
                held.append(b.slice(at, to - at))
        if held:
            yield from pack(pa.concat_arrays([x.column(1) for x in held]), np.concatenate([x.column(2).to_numpy() for x in held]), own)

    sizes = cut(slim.mapInArrow(count, f"id {kind}, t bigint"))
    blocks = max(1, -(-sizes.count() // BLOCK))
    items = _spread_out(sizes).select(F.pmod(F.xxhash64("id", "t", "k"), F.lit(blocks)).alias("block"), "id", "t")
    return items.repartition("block").sortWithinPartitions("block", "id", "t").mapInArrow(run, f"pack_name string, container string, `{id_col}` {kind}, piece int, first_token bigint, n_tokens bigint")


def fill_report(packed: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each capacity: containers, tokens, share of the capacity used, and the largest number of documents in one."""
    per = packed.where("container is not null").groupBy("pack_name", "container").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("d"))
    total = per.groupBy("pack_name").agg(F.count(F.lit(1)).alias("containers"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"), F.max("d").alias("most_items"))
    return total.join(F.broadcast(budgets), "pack_name").select("pack_name", "capacity_tokens", "containers", "tokens", "fullest", "most_items", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"))
