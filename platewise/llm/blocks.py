"""Blocks of documents by ranges of their ids, and a lookup of hashed keys across blocks.

Operators that have to know something about every word window of every document would shuffle a row per window.
Here each block of documents sends its distinct keys, sorted and packed, to key buckets; a bucket answers each block
with one packed value per key. The text itself moves once, to its block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 6 << 20


def id_bounds(df: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> list[int]:
    """Smallest ids of the blocks, ascending; every one is an id of the table (empty for an empty table).

    One number per block comes to the driver. Blocks hold about as many documents each.
    """
    size, least = df.agg(F.sum(F.octet_length(text)), F.min(key)).first()
    if least is None:
        return []
    n = max(1, -(-(size or 0) // block_bytes))
    marks = [i / n for i in range(1, n)]
    if not marks:
        return [least]
    found = df.where(F.col(key).isNotNull()).agg(F.percentile_approx(key, marks, 20 * n)).first()[0]
    return sorted({least, *found})


def block_of(key: Column, bounds: list[int]) -> Column:
    """Number of the block whose range holds an id, in two steps of about the square root of the blocks each."""
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(b) for b in bounds[::step]])
    fine = F.array(*[F.array(*[F.lit(b) for b in bounds[i : i + step]]) for i in range(0, len(bounds), step)])
    high = F.size(F.filter(coarse, lambda b: b <= key)) - 1
    return (high * step + F.size(F.filter(F.get(fine, high), lambda b: b <= key)) - 1).cast("int")


def in_blocks(df: DataFrame, bounds: list[int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows moved to their blocks, column ``block``. Rows without an id are spread over blocks of their own, below 0."""
    if not bounds:
        bounds = [0]
    loose = -1 - F.pmod(F.xxhash64(text), F.lit(len(bounds))).cast("int")
    block = F.when(F.col(key).isNull(), loose).otherwise(block_of(F.col(key), bounds))
    return df.withColumn("block", block).repartition(len(bounds), "block")


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences in byte planes, as many as the widest difference needs."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps[1:].max()).bit_length() + 7) // 8) if len(keys) > 1 else 1
    planes = np.ascontiguousarray(steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + planes.tobytes()


def _unpack_sorted(data: bytes) -> np.ndarray:
    width, first = data[0], np.frombuffer(data, "<u8", 1, 1)
    planes = np.frombuffer(data, np.uint8, -1, 9).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :width] = planes.T
    return np.cumsum(np.concatenate((first, steps.view("<u8").ravel())), dtype=np.uint64)


def _edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets, equal parts of the range of keys, begin and end among sorted keys."""
    marks = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, marks), [len(keys)]))


def _planes(values: np.ndarray) -> bytes:
    """Booleans as bits; other values as byte planes, whose mostly empty ones compress away."""
    if values.dtype == bool:
        return np.packbits(values).tobytes()
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes() if len(values) else b""


def _from_planes(data: bytes, n: int, dtype: np.dtype) -> np.ndarray:
    if dtype == bool:
        return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(dtype).ravel()


def key_lookup(
    blocked: DataFrame,
    buckets: int,
    keys_of: Callable[..., tuple[np.ndarray, np.ndarray | None]],
    answer: Callable[[np.ndarray, np.ndarray | None], tuple[np.ndarray, list[int]]],
    counted: np.dtype | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Columns ``block``, ``bucket``, ``answers`` (for each block, one packed value per distinct key) and ``totals``.

    ``keys_of`` makes a block's distinct sorted 64-bit keys, and a record of type ``counted`` for each if wanted; with
    ``known``, replies of an earlier lookup, it gets those of the block too. ``answer`` gets all keys of a bucket
    ordered by key and then block (and their records), and returns one value for each and a list of totals of the
    bucket, which its first row carries. A bucket holds an equal share of the range of hashes; a frequent key occurs
    once per block in it.
    """

    def alone(table: pa.Table) -> pa.Table:
        return send(table)

    def informed(table: pa.Table, replies: pa.Table) -> pa.Table:
        return send(table, replies)

    def send(table: pa.Table, *replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary())], names=["bucket", "block", "keys", "counts"])
        keys, counts = keys_of(table, *replies)
        edges = _edges(keys, buckets)
        full = np.flatnonzero(np.diff(edges))
        packed = [_pack_sorted(keys[edges[b] : edges[b + 1]]) for b in full]
        sums = [b"" if counts is None else _planes(counts[edges[b] : edges[b + 1]]) for b in full]
        block = table.column("block")[0].as_py()
        return pa.table([pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int32()), pa.array(packed, pa.binary()), pa.array(sums, pa.binary())], names=["bucket", "block", "keys", "counts"])

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts = [_unpack_sorted(k) for k in table.column("keys").to_pylist()]
        sizes = [len(p) for p in parts]
        ids = table.column("block").to_numpy()
        keys = np.concatenate(parts)
        order = np.argsort(keys, kind="stable")
        sums = None
        if counted is not None:
            sums = np.concatenate([_from_planes(c, n, counted) for c, n in zip(table.column("counts").to_pylist(), sizes)])[order]
        values, totals = answer(keys[order], sums)
        back = np.empty_like(values)
        back[order] = values
        packed = [_planes(v) for v in np.split(back, np.cumsum(sizes)[:-1])]
        columns = [pa.array(ids, pa.int32()), pa.array([table.column("bucket")[0].as_py()] * len(ids), pa.int32()), pa.array(packed, pa.binary())]
        return pa.table([*columns, pa.array([totals] + [[]] * (len(ids) - 1), pa.list_(pa.int64()))], names=["block", "bucket", "answers", "totals"])

    schema = "bucket int, block int, keys binary, counts binary"
    groups = blocked.groupBy("block")
    sent = groups.applyInArrow(alone, schema) if known is None else groups.cogroup(known.groupBy("block")).applyInArrow(informed, schema)
    return sent.groupBy("bucket").applyInArrow(meet, "block int, bucket int, answers binary, totals array<long>")


def answers_of(keys: np.ndarray, replies: pa.Table, buckets: int, dtype: np.dtype) -> np.ndarray:
    """A block's answers in the order of its sorted keys."""
    edges = _edges(keys, buckets)
    out = np.zeros(len(keys), dtype=dtype)
    for bucket, packed in zip(replies.column("bucket").to_pylist(), replies.column("answers").to_pylist()):
        a, b = edges[bucket], edges[bucket + 1]
        out[a:b] = _from_planes(packed, b - a, np.dtype(dtype))
    return out
