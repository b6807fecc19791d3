"""Prefix sums along linked lists whose elements are rows, in rounds that each remove part of the elements.

First, tasks contract what is linked within a batch of neighbouring rows: all but the first element of every local
run are taken over by it. Then random mates: an element whose coin shows heads takes over its successor if that one's
coin shows tails, which removes a quarter of the elements whatever their order. What remains, a bounded number of
elements, is summed in one task; the removed elements get their sums back in the opposite order, one join a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.stored import stored

# Elements summed in one task at the end.
ENOUGH = 8192
_LINK = "id long, next long, leaves long, saved long"


def _places(of: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Where each id stands in ``of`` (distinct); -1 if it does not."""
    order = np.argsort(of)
    at = np.minimum(np.searchsorted(of, ids, sorter=order), len(of) - 1)
    return np.where(of[order[at]] == ids, order[at], -1)


def chain_sums(ids: np.ndarray, following: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For elements that may follow one another: the first element of each one's chain, and the sum of the values of
    those before it in the chain. By doubling, so in as many passes as the length of the longest chain has bits."""
    n = len(ids)
    target = _places(ids, following)
    head, sums = np.arange(n), np.zeros_like(values)
    linked = np.flatnonzero(target >= 0)
    head[target[linked]] = linked
    sums[target[linked]] = values[linked]
    while (up := head[head] != head).any():
        sums[up] += sums[head[up]]
        head[up] = head[head[up]]
    return head, sums


def _contract(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of ``kept`` elements, with sums of what they took over, and of ``gone`` ones: who has them, and the sums before."""
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    following = batch.column("next").fill_null(-1).to_numpy(zero_copy_only=False)
    values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaves", "saved")], axis=1)
    head, before = chain_sums(ids, following, values)
    last = np.zeros(len(ids), dtype=np.int64)
    tails = np.flatnonzero(_places(ids, following) < 0)
    last[head[tails]] = tails
    gone = head != np.arange(len(ids))
    link = np.where(gone, ids[head], following[last])
    sums = np.where(gone[:, None], before, before[last] + values[last])
    columns = [pa.array(ids), pa.array(link, mask=link < 0), pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array(gone)]
    return pa.RecordBatch.from_arrays(columns, ["id", "next", "leaves", "saved", "gone"])


def _local_round(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _contract(batch)

    return links.mapInArrow(run, f"{_LINK}, gone boolean")


def _mates_round(links: DataFrame, number: int) -> DataFrame:
    """An element with heads takes over its successor with tails; a gone one has its taker as ``next``."""

    def heads(c: str):
        return F.pmod(F.xxhash64(F.lit(number), F.col(c)), F.lit(2)) == 0

    takes = F.col("next").isNotNull() & heads("id") & ~heads("next")
    marked = links.withColumn("takes", F.coalesce(takes, F.lit(False)))
    takers = marked.where("takes").select(F.col("id").alias("by"), F.col("next").alias("id"), F.col("leaves").alias("by_leaves"), F.col("saved").alias("by_saved"))
    # Every taker stands in the row of the element that it takes over; that row gives both.
    met = marked.join(takers, "id", "left")
    alone = F.struct("id", "next", "leaves", "saved", F.lit(False).alias("gone"))
    taken = F.struct("id", F.col("by").alias("next"), F.col("by_leaves").alias("leaves"), F.col("by_saved").alias("saved"), F.lit(True).alias("gone"))
    merged = F.struct(
        F.col("by").alias("id"), "next", (F.col("leaves") + F.col("by_leaves")).alias("leaves"), (F.col("saved") + F.col("by_saved")).alias("saved"), F.lit(False).alias("gone")
    )
    rows = F.when(F.col("by").isNotNull(), F.array(taken, merged)).when(~F.col("takes"), F.array(alone)).otherwise(F.array())
    return met.select(F.explode(rows).alias("r")).select("r.*")


def _all_sums(links: DataFrame) -> DataFrame:
    """Sums before each of a bounded number of elements, in one task."""

    def run(table: pa.Table) -> pa.Table:
        ids, following = table.column("id").to_numpy(), table.column("next").fill_null(-1).to_numpy()
        values = np.stack([table.column(c).to_numpy() for c in ("leaves", "saved")], axis=1)
        _, before = chain_sums(ids, following, values)
        return pa.table([pa.array(ids), pa.array(before[:, 0]), pa.array(before[:, 1])], names=["id", "leaves", "saved"])

    return links.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(run, "id long, leaves long, saved long")


def prefix_sums(links: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """Columns ``id``, ``leaves``, ``saved``: the sums of both values over all elements before each one in its list.

    ``links``: ``id`` (distinct, not negative), ``next`` (null at a list's end) and both values. Neighbouring rows
    should be neighbours in the list for the first round to remove much; any order gives right sums. Any number of
    lists; an empty table has no rows.
    """
    table = stored(_local_round(links), "tour")
    rounds = [table]
    while (left := table.where("NOT gone").drop("gone")).count() > enough:
        table = stored(_mates_round(left, len(rounds)), "tour")
        rounds.append(table)
    known = _all_sums(left)
    for table in reversed(rounds):
        gone = table.where("gone").select("id", F.col("next").alias("by"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        known = stored(known, "sums")
        base = known.withColumnRenamed("id", "by")
        found = gone.join(base, "by").select("id", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"))
        known = known.unionByName(found)
    return known
