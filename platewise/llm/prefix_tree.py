"""The trie of conversation prefixes, and sums over its subtrees by an Euler tour.

A turn's content is hashed with its position; the running exclusive-or of these 128-bit hashes names a prefix, and
taking the last turn's hash off again names its parent, so that nodes and edges come from one grouping without
comparing texts. A conversation's running hashes are made in chunks of turns with carried values.

Nodes are numbered by their smallest member and depth. Each has an enter and an exit arc: after entering come the
children by smallest member, each with its subtree, then the exit. Ranking this linked list gives sums over all arcs
before each arc; the difference between a node's two arcs is the sum over its subtree.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.listrank import ENOUGH, prefix_sums
from platewise.llm.ordered import numbered
from platewise.llm.stored import stored

_CHUNK = 4096  # turns of one conversation that a window scans at once
_IDS = 8192  # ids of one node that travel as one row
WORDS = r"[^\x20\x09-\x0D]+"
_NODE = ["depth", "a", "b"]


def _half(digest: Column, first: int) -> Column:
    """64 bits of a hexadecimal digest as a signed integer."""
    return F.conv(F.substring(digest, first, 16), 16, -10).cast("long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Columns ``conv_id``, ``nth`` (1, 2, ... by turn, null first), ``content`` (digest of role and text), ``words``.

    Ties of one turn are ordered by content. A null role or text is empty; rows without conv_id are left out. Turns
    are placed by one sort over all conversations, so that a conversation of any length is cut over many tasks.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    content = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(content, 1, 32).alias("content"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words")
    )
    placed = numbered(stored(rows, "turns"), [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("content")])
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first") + 1).alias("nth"), "content", "words")


def rebuilt(turns: DataFrame, family: int = 20, spread: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share starts: turns (``conv_id``, ``nth``, ``content``, ``words``) and conversations (``conv_id``, ``n``).

    The first h turns of conversation c are those of c - c % family (all if it has fewer, none if it is absent);
    its own turns after its first h follow. h is the CRC of the decimal c modulo ``spread``.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % family
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread
    convs = sizes.withColumn("h", h).withColumn("base", base)
    had = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = convs.join(had, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))).cast("long"))
    convs = stored(convs.withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "conversations")
    starts = turns.where((F.col("nth") < spread) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    taken = convs.select("conv_id", "base", "taken").join(starts, "base").where("nth <= taken").select("conv_id", "nth", "content", "words")
    kept = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("nth > h")
    kept = kept.select("conv_id", (F.col("nth") - F.col("h") + F.col("taken")).alias("nth"), "content", "words")
    return taken.unionByName(kept), convs.select("conv_id", "n")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per turn: ``conv_id``, ``words``, its prefix (``depth``, ``a``, ``b``) and its parent's ``pa``, ``pb``."""
    digest = F.sha2(F.concat(F.col("nth").cast("string"), F.lit(":"), F.col("content")), 256)
    rows = turns.select("conv_id", "nth", "words", _half(digest, 1).alias("x"), _half(digest, 17).alias("y"))
    rows = rows.withColumn("chunk", F.floor((F.col("nth") - 1) / _CHUNK))
    long = convs.where(F.col("n") > _CHUNK).select("conv_id")
    sums = rows.join(long, "conv_id", "left_semi").groupBy("conv_id", "chunk").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row per chunk
    carried = sums.select("conv_id", "chunk", F.bit_xor("x").over(earlier).alias("cx"), F.bit_xor("y").over(earlier).alias("cy"))
    upto = Window.partitionBy("conv_id", "chunk").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"a": F.bit_xor("x").over(upto), "b": F.bit_xor("y").over(upto)}).join(carried, ["conv_id", "chunk"], "left")
    rows = rows.withColumns({p: F.col(p).bitwiseXOR(F.coalesce(F.col(f"c{q}"), F.lit(0))) for p, q in (("a", "x"), ("b", "y"))})
    return rows.select(
        "conv_id", "words", F.col("nth").alias("depth"), "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb")
    )


def end_lists(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Node (``depth``, ``a``, ``b``) and ``ends_sha256`` of the ids of the conversations that end there, ascending.

    Ids are sorted by range, joined into pieces of text within each range, and the pieces of a node are hashed one
    after another, so that a task holds one piece, however many conversations end at one node.
    """
    last = rows.select("conv_id", *_NODE).join(convs, "conv_id").where("depth = n").select(*_NODE, "conv_id")
    empty = convs.where("n = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv_id")
    ends = stored(last.unionByName(empty), "ends")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = list(zip(*(batch.column(c).to_pylist() for c in _NODE)))
            ids = batch.column("conv_id").to_pylist()
            begin, out = 0, []
            for i in range(1, len(ids) + 1):
                if i == len(ids) or nodes[i] != nodes[begin] or i - begin == _IDS:
                    out.append((*nodes[begin], ids[begin], ",".join(map(str, ids[begin:i]))))
                    begin = i
            if out:
                types = [pa.int64()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [*_NODE, "first", "piece"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *at, piece in zip(*(batch.column(c).to_pylist() for c in [*_NODE, "piece"])):
                if at != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = at, sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            yield _digests(done)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    sort = ends.repartitionByRange(parts, *_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    pieces = sort.mapInArrow(joined, "depth long, a long, b long, first long, piece string")
    return pieces.repartition(parts, *_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(hashed, "depth long, a long, b long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])], [*_NODE, "ends_sha256"])


def tour_arcs(nodes: DataFrame) -> DataFrame:
    """The Euler tour as a linked list: ``id`` (2v enters v, 2v + 1 leaves it), ``next``, ``leaves``, ``saved``.

    ``nodes``: ``v``, ``parent`` (null at the root), ``first`` (first child or null), ``sibling`` (next one or null), ``saved``.
    """
    leaf = F.col("first").isNull()
    enter = F.struct(
        (F.col("v") * 2).alias("id"), F.when(leaf, F.col("v") * 2 + 1).otherwise(F.col("first") * 2).alias("next"), leaf.cast("long").alias("leaves"), F.col("saved").alias("saved")
    )
    leave = F.struct(
        (F.col("v") * 2 + 1).alias("id"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next"), F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")
    )
    return nodes.select(F.explode(F.array(enter, leave)).alias("arc")).select("arc.*")


def prefix_tree(turns: DataFrame, convs: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    ``turns``: ``conv_id``, ``nth`` from 1 without gaps, ``content`` (equal for equal turns), ``words``; ``convs``:
    ``conv_id``, ``n`` (number of turns, also 0), each conversation once. The root (depth 0) has all conversations as
    members. No conversations, no nodes. ``enough`` bounds what the last step of the list ranking sums in one task.
    """
    rows = stored(prefixes(turns, convs), "prefixes")
    grouped = rows.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.first("pa").alias("pa"), F.first("pb").alias("pb"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in _NODE], "conv_id", "n_convs", zero.alias("words"), zero.cast("long").alias("pa"), zero.alias("pb"))
    nodes = numbered(stored(grouped.unionByName(root), "nodes"), [F.col("conv_id"), F.col("depth")], "v")
    # A node's parent lies one turn higher; one that all of many children share is split by the join.
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("v").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    with_parent = stored(nodes.join(up, ["depth", "pa", "pb"], "left"), "parents")
    below = with_parent.where("parent IS NOT NULL").groupBy("parent").agg(F.min("v").alias("first"), F.count("*").alias("n_children")).withColumnRenamed("parent", "v")
    # Siblings are neighbours once all children are sorted by their parents.
    row = numbered(with_parent.where("parent IS NOT NULL").select("parent", "v"), [F.col("parent"), F.col("v")])
    after = row.select((F.col("place") - 1).alias("place"), F.col("parent").alias("p"), F.col("v").alias("sibling"))
    siblings = row.join(after, "place").where("parent = p").select("v", "sibling")
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    full = with_parent.join(below, "v", "left").join(siblings, "v", "left")
    full = stored(full.select("v", "conv_id", *_NODE, "parent", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "first", "sibling", saved), "tree")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arcs = tour_arcs(full).repartitionByRange(parts, "id").sortWithinPartitions("id")
    sums = prefix_sums(arcs, enough)

    def between(c: str) -> Column:
        leaving = F.pmod("id", F.lit(2)) == 1
        return (F.max(F.when(leaving, F.col(c))) - F.max(F.when(~leaving, F.col(c)))).alias(c)

    subtree = sums.groupBy(F.shiftright("id", 1).alias("v")).agg(between("leaves"), between("saved"))
    out = full.drop("saved").join(subtree, "v").join(end_lists(rows, convs), _NODE, "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )
