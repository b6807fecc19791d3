"""Packing token ids into training windows of several lengths, hierarchically and without padding to speak of.

Window lengths are tiers: powers of two. What a document has beyond whole windows of the longest tier is routed to
the shortest tier that holds it. The tiers are packed from the longest to the shortest: every window starts with a
document of its own tier and its gap is filled with whole documents of shorter tiers, the longest that fits first.
Where none fits, the next longer one is cut to measure and its rest is routed anew, so that windows come out full.
At the end of a block at most one window is open; it is cut into windows of ever shorter powers of two.

A block is some millions of tokens of consecutive rows of one partition. Nothing is shuffled, and a task holds one
block. Windows of a tier are dealt out to step groups of equal numbers of tokens, whose attention cost (the sum of
squared lengths of pieces) is balanced by dealing them from the dearest to the cheapest, to and fro.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Pieces a worker remembers, and the longest of them.
_CACHE_ENTRIES, _CACHE_LENGTH = 1_000_000, 60
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SLICE = 1 << 16
# Characters whose new pieces are learned at once.
_GROUP = 1 << 18
# A window's number: the partition, then the window within it.
_WINDOW_BITS = 40


class Windows(NamedTuple):
    """``longest`` and ``shortest`` tier (powers of two), tokens of a step group, tokens of a block."""

    longest: int = 1024
    shortest: int = 128
    step_tokens: int = 16_384
    block_tokens: int = 1 << 22

    def tiers(self) -> list[int]:
        return [1 << k for k in range(self.longest.bit_length() - 1, self.shortest.bit_length() - 2, -1)]


# What a worker has learned of each tokenizer; the next task goes on with it.
_caches: dict[int, dict[str, bytes]] = {}


class TextEncoder:
    """Ids of whole texts as the tokenizer gives them; frequent pieces are looked up.

    A byte-level tokenizer starts a new pre-token where white space follows other characters, and where a letter ends
    before a point or comma. Texts are cut there, before a space or a line feed or behind such a letter, into pieces
    that have ids of their own. A text with other white space is encoded as it is.
    """

    _pieces = staticmethod(re.compile(rf"[ \n]*+(?:[{_LETTER}]++(?=[.,;:!?])|[^ \n]++)|[ \n]++").findall)
    _other_space = staticmethod(re.compile(r"[^\S \n]").search)
    _cut = re.compile(r"(?<=\S)(?=[ \n])")

    def __init__(self, data: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        self.tokenizer = Tokenizer.from_str(data)
        self.cache: dict[str, bytes] = _caches.setdefault(crc32(data.encode()), {})
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # Bytes each id stands for: a byte-level token has one character per byte.
        sizes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            sizes[i] = len(special[i].encode()) if i in special else len(token)
        self.sizes = sizes

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, missing: set[str]) -> None:
        """Pieces that begin with white space and end without are encoded together and told apart by their bytes."""
        joined = [p for p in missing if p[0] in " \n" and not p[-1].isspace()]
        for a in range(0, len(joined), 4096):
            part = joined[a : a + 4096]
            whole = "".join(part)
            ids = self._ids(whole)
            ends = np.cumsum(self.sizes[ids])
            marks = np.cumsum(list(map(len, part if whole.isascii() else map(str.encode, part))))
            stops = np.searchsorted(ends, marks) + 1
            assert ends[-1] == marks[-1] and (ends[stops - 1] == marks).all()
            data, places = ids.tobytes(), [0, *(4 * stops).tolist()]
            self.cache.update(zip(part, map(data.__getitem__, map(slice, places, places[1:]))))
        for p in missing:
            if p not in self.cache:
                self.cache[p] = self._ids(p).tobytes()

    def _slices(self, text: str) -> Iterator[str]:
        """Parts of a long text, cut between pieces."""
        begin = 0
        while len(text) - begin > _SLICE:
            found = self._cut.search(text, begin + _SLICE)
            if not found:
                break
            yield text[begin : found.start()]
            begin = found.start()
        yield text[begin:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; new pieces of all texts are learned at once."""
        cache = self.cache
        parts = [[p if self._other_space(p) else self._pieces(p) for p in self._slices(t)] for t in texts]
        missing = set().union(*(p for own in parts for p in own if isinstance(p, list))).difference(cache)
        if missing:
            self._learn(missing)
        get = cache.__getitem__
        out = [b"".join([b"".join(map(get, p)) if isinstance(p, list) else self._ids(p).tobytes() for p in own]) for own in parts]
        for p in missing:
            if len(p) > _CACHE_LENGTH:
                del cache[p]
        if len(cache) > _CACHE_ENTRIES:
            for p in list(islice(cache, _CACHE_ENTRIES // 2, None)):  # what came first is the most frequent
                del cache[p]
        return out


class _Pool:
    """Pieces that wait for a window, by length; the lengths that occur are bits of an integer."""

    def __init__(self, longest: int):
        self.items: list[list[tuple[int, int, int]]] = [[] for _ in range(longest)]
        self.lengths = 0

    def put(self, doc: int, start: int, length: int) -> None:
        self.items[length].append((doc, start, length))
        self.lengths |= 1 << length

    def take(self, length: int) -> tuple[int, int, int]:
        item = self.items[length].pop()
        if not self.items[length]:
            self.lengths ^= 1 << length
        return item

    def longest_within(self, most: int) -> int:
        """Greatest length that occurs and is no greater; 0 if there is none."""
        return (self.lengths & ((2 << most) - 1)).bit_length() - 1 if self.lengths & ((2 << most) - 1) else 0

    def shortest_above(self, least: int) -> int:
        """Smallest length that occurs and is greater; 0 if there is none."""
        rest = self.lengths >> (least + 1)
        return least + 1 + ((rest & -rest).bit_length() - 1) if rest else 0


def pack_block(lengths: list[int], windows: Windows) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows of one block: their tier and their pieces (document, start, length), which fill them.

    Every token of every document is in exactly one piece. A tier below the shortest occurs only at the block's end.
    """
    longest, out, pool = windows.longest, [], _Pool(windows.longest)
    for doc, n in enumerate(lengths):
        whole = n // longest * longest
        out += [(longest, [(doc, a, longest)]) for a in range(0, whole, longest)]
        if n > whole:
            pool.put(doc, whole, n - whole)
    held: list[tuple[int, int, int]] = []
    for tier in windows.tiers():
        while n := pool.longest_within(min(tier, longest - 1)):
            if n <= tier // 2 and tier > windows.shortest:
                break  # what is left belongs to shorter tiers
            held, gap = [pool.take(n)], tier - n
            while gap:
                if fit := pool.longest_within(gap):
                    held.append(pool.take(fit))
                    gap -= fit
                elif more := pool.shortest_above(gap):
                    doc, start, length = pool.take(more)
                    held.append((doc, start, gap))
                    pool.put(doc, start + gap, length - gap)
                    gap = 0
                else:
                    break
            if gap:
                break  # nothing is left
            out.append((tier, held))
            held = []
    return out + _cut_open(held, windows)


def _cut_open(held: list[tuple[int, int, int]], windows: Windows) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The last pieces of a block in windows whose lengths are the powers of two their sum is made of."""
    rest, out = sum(n for _, _, n in held), []
    pieces = held[::-1]
    while rest:
        size = 1 << (rest.bit_length() - 1)
        rest -= size
        window = []
        while size:
            doc, start, n = pieces.pop()
            use = min(n, size)
            window.append((doc, start, use))
            if use < n:
                pieces.append((doc, start + use, n - use))
            size -= use
        out.append((sum(n for _, _, n in window), window))
    return out


def deal_steps(cost: np.ndarray, per_step: int) -> np.ndarray:
    """Step group of each window of one tier: ``per_step`` windows each (fewer in the last), of about equal cost."""
    n = len(cost)
    full = n // per_step
    order = np.argsort(-cost, kind="stable")
    group = np.full(n, full, dtype=np.int64)  # what does not make a full group: the cheapest
    if full:
        turn = np.arange(full * per_step)
        row, place = np.divmod(turn, full)
        group[order[: full * per_step]] = np.where(row % 2 == 0, place, full - 1 - place)
    return group


_PIECE = [("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"), ("context", "integer"), ("step", "long"), ("ids", "binary")]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    windows: Windows = Windows(),
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: the key, ``start`` (the document's ids before it), ``length``, ``ids_crc32``, ``doc_tokens``
    (ids of the document, its end included), ``sequence_id`` and ``offset`` (its window and place there), ``context``
    (the window's length), ``step`` (its step group) and, if wanted, ``ids`` (little-endian unsigned 32-bit integers).

    ``tokenizer`` is the path of the tokenizer's file, read by the driver. Whole texts are encoded without added
    tokens, then ``end_id`` follows. A null text is an empty one: its one id is the end. A document of any length is
    cut into full windows first. Repeated rows are packed each; the key may be null. Other columns are not read. An
    empty table has no pieces. A partition's rows in their order decide its windows, so a task that runs again
    gives the same ones.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast((file.read(), end_id, windows, with_ids))  # the vocabulary: bounded by its file
    schema = docs.select(F.col(key).alias("key")).schema
    for name, kind in _PIECE[: len(_PIECE) - (not with_ids)]:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, end, sizes, ids_wanted = shared.value
        encoder, writer = TextEncoder(data), _Writer(sizes, ids_wanted)
        tail = end.to_bytes(4, "little")
        for batch in batches:
            keys = batch.column("key")
            if batch.num_rows:
                writer.partition, writer.key_type = batch.column("part")[0].as_py(), keys.type
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names = keys.to_pylist()
            for a, b in _groups(texts):
                for k, ids in zip(names[a:b], encoder.encode(texts[a:b])):
                    yield from writer.add(k, ids + tail)
        yield from writer.flush()

    # The partition's number is a column, so that it stays the same if the result is coalesced.
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``_GROUP`` characters, one text at least."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _GROUP or i == len(texts) - 1:
            yield begin, i + 1
            begin, size = i + 1, 0


class _Writer:
    """Blocks of one task: gathers documents, packs a block when it is full, and gives its pieces as Arrow rows."""

    def __init__(self, windows: Windows, with_ids: bool):
        self.windows, self.with_ids = windows, with_ids
        self.keys, self.ids, self.held, self.sequences, self.steps = [], [], 0, 0, 0
        self.partition, self.key_type = 0, None

    def add(self, key, ids: bytes) -> Iterator[pa.RecordBatch]:
        self.keys.append(key)
        self.ids.append(ids)
        self.held += len(ids) // 4
        if self.held >= self.windows.block_tokens:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.keys:
            return
        packed = pack_block([len(x) // 4 for x in self.ids], self.windows)
        steps = self._step_groups(packed)
        base = self.partition << _WINDOW_BITS
        columns: list[list] = [[] for _ in range(len(_PIECE) + 1)]
        for (context, pieces), step in zip(packed, steps):
            offset = 0
            for doc, start, length in pieces:
                part = self.ids[doc][4 * start : 4 * (start + length)]
                row = (self.keys[doc], start, length, crc32(part), len(self.ids[doc]) // 4, base + self.sequences, offset, context, base + step, part)
                for column, value in zip(columns, row):
                    column.append(value)
                offset += length
            self.sequences += 1
            if len(columns[0]) >= 10_000:
                yield self._rows(columns)
                columns = [[] for _ in columns]
        if columns[0]:
            yield self._rows(columns)
        self.keys, self.ids, self.held = [], [], 0

    def _step_groups(self, packed: list) -> list[int]:
        """Number of each window's step group; windows below the shortest tier share one group."""
        w = self.windows
        tiers = np.array([max(t, w.shortest // 2) for t, _ in packed])
        cost = np.array([sum(n * n for _, _, n in pieces) for _, pieces in packed])
        out = np.zeros(len(packed), dtype=np.int64)
        for tier in np.unique(tiers)[::-1]:
            of_tier = np.flatnonzero(tiers == tier)
            group = deal_steps(cost[of_tier], max(1, w.step_tokens // int(tier)))
            out[of_tier] = self.steps + group
            self.steps += int(group.max()) + 1
        return out.tolist()

    def _rows(self, columns: list[list]) -> pa.RecordBatch:
        types = [self.key_type, *[pa.int64()] * 6, pa.int32(), pa.int64(), pa.binary()]
        names = ["key", *[n for n, _ in _PIECE]]
        n = len(names) - (not self.with_ids)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:n], types[:n])], names[:n])
