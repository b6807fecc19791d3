"""Near-duplicate documents: b-bit MinHash signatures, a multi-index Hamming join, exact confirmation.

A document's signature has 128 places of 16 bits, each from one MinHash of its shingle set. Two sets of likeness J
differ in a place with probability 1 - J, so at J = 0.75 they differ in 31 or fewer of the first 64 places, and in 53
or fewer of all, but for about one in 25,000 pairs. The join finds every pair within the first distance: 16 chunks of
four places share at most 31 differences, so one chunk has one or none (pigeonhole), and each chunk is indexed by its
four keys that leave out one place, which enumerates the allowed error. The second distance then thins the candidates.
Copies (equal shingle sets) are one class and are joined once.

Components need no list of all pairs. In each index key the smallest class is linked with the others; the nearest of
these candidates of each class is confirmed first, then those that still connect different components. Keys whose
classes then still lie in several components are torn: classes tied by torn keys form a family, whose signatures are
compared across components in blocks, so that no link is lost. This last step grows with the square of a family of
classes that are alike but not linked; it makes no pairs, and stops comparing what is already connected.
Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.stored import components, stored
from platewise.llm.text import mix, shingle_sets, slices, words_of

PLACES, INDEXED, CHUNK, FIRST_DISTANCE, DISTANCE, SHINGLE = 128, 64, 4, 31, 53, 5
# Classes of one family that a task compares with one another; larger families are dealt out by pairs of parts.
_PART = 3000
_TABLE = ["table", "table_low", "table_high"]
_rng = np.random.default_rng(31)
_XOR = _rng.integers(0, 2**63, PLACES, dtype=np.uint64)
_ODD = _rng.integers(0, 2**62, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEY = _rng.integers(0, 2**62, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(words_of(texts, lower=True), SHINGLE)


def _signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row per nonempty set."""
    heads = first[:-1][np.diff(first) > 0]
    out = np.empty((len(heads), PLACES), dtype="<u2")
    for k in range(PLACES):
        out[:, k] = mix(np.minimum.reduceat((hashes ^ _XOR[k]) * _ODD[k], heads)) & np.uint64(0xFFFF)
    return out


def _index_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature, each chunk and each place left out of it, one key."""
    terms = mix((signatures[:, :INDEXED].astype(np.uint64) + np.uint64(1)) * _KEY[:INDEXED])
    chunks = terms.reshape(len(signatures), -1, CHUNK)
    places = np.arange(INDEXED, dtype=np.uint64)
    return mix((chunks.sum(axis=2, dtype=np.uint64)[:, :, None] - chunks).reshape(len(signatures), -1) + places * _ODD[0])


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns ``doc_id``, ``n_shingles``, ``h1``, ``h2`` (128-bit digest of the set), ``signature``; null if no words."""
    schema = "doc_id long, n_shingles long, h1 long, h2 long, signature binary"
    names = ["doc_id", "n_shingles", "h1", "h2", "signature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for a, b in slices(texts):
                hashes, first = _sets(texts[a:b])
                sizes = np.diff(first)
                full = sizes > 0
                digests = np.zeros((2, b - a), dtype=np.uint64)
                packed = np.full(b - a, None, dtype=object)
                if full.any():
                    heads = first[:-1][full]
                    digests[0, full] = np.add.reduceat(mix(hashes), heads)
                    digests[1, full] = np.add.reduceat(mix(hashes ^ _XOR[0]), heads)
                    packed[full] = [s.tobytes() for s in _signatures(hashes, first)]
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(sizes), *[pa.array(d.view(np.int64)) for d in digests], pa.array(packed.tolist(), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)


def index_rows(classes: DataFrame) -> DataFrame:
    """Columns ``key``, ``node``: each class under its index keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _index_keys(np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(-1, PLACES))
            nodes = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(nodes)], ["key", "node"])

    return classes.select("node", "signature").mapInArrow(run, "key long, node long")


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` whose signatures are within the distance, which is added; sizes that rule a link out go too."""
    side = classes.select("node", "n_shingles", "signature")
    rows = pairs.join(side.toDF("a", "n_a", "s_a"), "a").join(side.toDF("b", "n_b", "s_b"), "b")
    rows = rows.where("100 * least(n_a, n_b) >= 75 * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, PLACES) for c in ("s_a", "s_b"))
            distance = (left != right).sum(axis=1)
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(distance.astype(np.int32))], ["a", "b", "distance"])
            yield out.filter(pa.array(distance <= DISTANCE))

    return rows.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long, distance int")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs linked on their full sets."""
    rows = pairs.select("a", "b").join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                keep.append(_linked(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "a long, b long")


def _shingle_table(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Full sets of the given documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for a, b in slices(texts):
                hashes, first = _sets(texts[a:b])
                sets = [hashes[first[i] : first[i + 1]].astype("<u8").tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), pa.array(sets, pa.binary())], ["node", "shingles"])

    return docs.join(nodes, "node", "left_semi").mapInArrow(run, "node long, shingles binary")


def _join_parts(table: pa.Table) -> pa.Table:
    """Links across components between the classes of a part, or of two parts, of a family.

    Classes are taken by size, so that only a range of them can be linked with each. Signatures are compared first,
    one class against its range; sets only if the signatures are near and the components still apart.
    """
    order = [(n, "ascending") for n in ("family", "low", "high", "n_shingles", "node")]
    table = table.sort_by(order)
    family, low, high, part, node, c, n = (table.column(x).to_numpy() for x in ("family", "low", "high", "part", "node", "c", "n_shingles"))
    marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u2").reshape(-1, PLACES)
    brief = np.ascontiguousarray(marks[:, :INDEXED].astype(np.uint8))
    sets = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
    new = (np.diff(family) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
    edges = np.concatenate(([0], np.flatnonzero(new) + 1, [len(family)]))
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        parent: dict[int, int] = {}

        def root(x: int, parent: dict[int, int] = parent) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        starts = a + np.searchsorted(100 * n[a:b], 75 * n[a:b])
        for i in range(a, b):
            begin = int(starts[i - a])
            fit = c[begin:i] != c[i]
            if low[a] != high[a]:
                fit &= part[begin:i] != part[i]
            j = begin + np.flatnonzero(fit)
            j = j[np.count_nonzero(brief[j] != brief[i], axis=1) <= FIRST_DISTANCE]
            for k in j[np.count_nonzero(marks[j] != marks[i], axis=1) <= DISTANCE].tolist():
                x, y = root(int(c[i])), root(int(c[k]))
                if x != y and _linked(sets[i], sets[k]):
                    parent[max(x, y)] = min(x, y)
                    out.append((min(node[i], node[k]), max(node[i], node[k])))
    found = np.array(out, dtype=np.int64).reshape(-1, 2)
    return pa.table([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= 75 * (len(x) + len(y) - common)


def join_families(rows: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect different components ``c`` of a ``family``; no pairs are made but links.

    ``rows``: ``family``, ``node``, ``c``, ``n_shingles``, ``signature``, ``shingles``, and ``n``, the family's size. A
    large family is dealt out in parts; every two of them meet in a table of their own, so that no task holds more at once.
    """
    return _deal(rows).groupBy(*_TABLE).applyInArrow(_join_parts, "a long, b long")


def _deal(rows: DataFrame) -> DataFrame:
    """Rows with ``part``, ``low``, ``high`` and the columns of ``_TABLE``, which name the table that is compared at once.

    Two parts of a large family are a table of their own; families of one part are put together, about a part's rows.
    """
    parts = F.ceil(F.col("n") / _PART).cast("int")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    tables = max(1, rows.where(parts == 1).count() // _PART)
    shared = F.pmod(F.xxhash64("family"), F.lit(tables))
    alone = parts > 1
    keys = (F.when(alone, F.col("family")).otherwise(shared), F.when(alone, F.col("low")).otherwise(-1), F.when(alone, F.col("high")).otherwise(-1))
    return dealt.withColumns(dict(zip(_TABLE, keys))).drop("n", "other")


def link_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Columns ``node``, ``component`` of the classes that are linked with another. ``docs``: ``node``, ``text``."""
    index = index_rows(classes)
    hubs = index.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    shared = stored(index.join(hubs, "key").select("key", "a", F.col("node").alias("b")), "shared-keys")
    stars = shared.where("a <> b").select("a", "b").distinct()
    members = shared.select(F.col("b").alias("node")).distinct()
    sets = stored(_shingle_table(docs, members), "shingles")
    near = stored(_near(stars, classes), "near")
    nearest = near.groupBy("b").agg(F.min(F.struct("distance", "a")).alias("s")).select(F.col("s.a").alias("a"), "b")
    links = stored(_confirmed(nearest, sets), "links")

    def apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
        left, right = known.toDF("a", "c_a"), known.toDF("b", "c_b")
        rows = pairs.join(left, "a", "left").join(right, "b", "left")
        return rows.where("coalesce(c_a, a) <> coalesce(c_b, b)").select("a", "b")

    known = components(links)
    links = links.unionByName(stored(_confirmed(apart(near.select("a", "b"), known), sets), "links"))
    known = stored(components(links), "components")
    # Keys whose classes are still apart: the pairs that no star had.
    labelled = shared.select("key", F.col("b").alias("node")).join(known, "node", "left").withColumn("c", F.coalesce("component", "node"))
    torn = labelled.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n"), F.min("node").alias("first"))
    ties = labelled.join(torn.where("low <> high AND n > 2").select("key", "first"), "key").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    families = stored(components(ties).select("node", F.col("component").alias("family")), "families")
    sizes = families.groupBy("family").agg(F.count("*").alias("n"))
    rows = families.join(sizes, "family").join(classes.select("node", "n_shingles", "signature"), "node").join(sets, "node")
    rows = rows.join(known, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    links = links.unionByName(stored(join_families(stored(rows, "torn")), "links"))
    return components(links)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key, ``n_shingles``, ``component_id`` (smallest id reachable over links), ``kept`` (it is that id).

    A document's set holds its distinct five-word shingles, A-Z lowered; with fewer words the whole sequence is one
    shingle. Documents whose sets have a likeness of 0.75 or more are linked. A null or blank text has an empty set and
    is linked with nothing. Ids should be distinct; rows that share one are judged by
    their own texts. A row without id is linked with nothing and kept;
    its component is null. One row per row; other columns are not read.
    """
    signed = stored(signatures(docs, key, text), "signatures")
    same = ["n_shingles", "h1", "h2"]
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(full.groupBy(*same).agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")), "classes")
    texts = docs.select(F.col(key).cast("long").alias("node"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = stored(link_classes(texts, classes), "components")
    top = classes.join(found, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    rows = signed.drop("signature").join(top, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = rows.select(F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
