"""Importance resampling towards a target distribution, from hashed n-grams.

Separators collapse to single spaces; one overlapped regular expression then matches every run of n words, its ends
held by look-arounds, and the matched spans are hashed by CRC into buckets. The texts are scanned once: what is kept
of a document is its buckets and their counts. The histograms of corpus and target give each bucket a gain, the
logarithm of the smoothed ratio of their shares; a document weighs the sum of its features' gains. Gumbel noise from
a digest of the id makes the highest scores a sample without replacement, whose chances follow the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.ordered import numbered
from platewise.llm.stored import stored

# A-Z are lowered; digits, a-z and all bytes of other scripts are parts of words, the rest separates them.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class Features(NamedTuple):
    """Which features a text has: runs of ``least`` to ``most`` words, in ``buckets`` hash buckets."""

    least: int = 1
    most: int = 1
    buckets: int = 10_000


def _pattern(n: int) -> regex.Pattern:
    """A run of n words from a word's start to a word's end; possessive, so that a long word is read once."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def text_buckets(text: bytes, spec: Features, patterns: list[regex.Pattern]) -> tuple[int, np.ndarray]:
    """Number of words of a whole text, and the bucket of each of its features."""
    line = b" ".join(text.translate(_FOLD).split())
    found = [np.fromiter((crc32(m[0]) % spec.buckets for m in p.finditer(line, overlapped=True)), dtype=np.uint32) for p in patterns]
    return (line.count(b" ") + 1 if line else 0), np.concatenate(found)


def feature_rows(docs: DataFrame, spec: Features, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key, ``n_words``, ``n_features``, ``buckets`` (binary: distinct buckets, then their counts, 32 bits each).

    One scan of every whole text; a null text has no words. One row per row; other columns are not read.
    """
    schema = docs.select(F.col(key).alias("key")).schema.add("n_words", "long").add("n_features", "long").add("buckets", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [_pattern(n) for n in range(spec.least, spec.most + 1)]
        for batch in batches:
            words, features, packed = [], [], []
            for value in batch.column("text").cast(pa.binary()).to_pylist():
                n, buckets = text_buckets(value or b"", spec, patterns)
                distinct, counts = np.unique(buckets, return_counts=True)
                words.append(n)
                features.append(len(buckets))
                packed.append(np.concatenate((distinct, counts)).astype("<u4").tobytes())
            columns = [batch.column("key"), pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_features", "buckets"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _unpacked(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and counts of several documents, and the document of each."""
    parts = [np.frombuffer(v, "<u4").reshape(2, -1).astype(np.int64) for v in values]
    both = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), dtype=np.int64)
    return both[0], both[1], np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])


def histogram(features: DataFrame, spec: Features) -> np.ndarray:
    """How often each bucket occurs in all rows; tasks send one partial sum, the driver gets one number per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(spec.buckets, dtype=np.int64)
        for batch in batches:
            buckets, counts, _ = _unpacked(batch.column("buckets").to_pylist())
            np.add.at(sums, buckets, counts)
        full = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(sums[full])], ["bucket", "n"])

    parts = features.select("buckets").mapInArrow(run, "bucket long, n long")
    out = np.zeros(spec.buckets, dtype=np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain in thousandths: the logarithm of the ratio of its add-one shares, rounded down."""
    n = len(corpus)
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """The rows with ``weight``, the sum of the gains of their features, in place of the buckets."""
    shared = features.sparkSession.sparkContext.broadcast(gains)  # one number per bucket
    kept = features.drop("buckets")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            buckets, counts, owner = _unpacked(batch.column("buckets").to_pylist())
            sums = np.zeros(batch.num_rows, dtype=np.int64)
            np.add.at(sums, owner, table[buckets] * counts)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sums)], [*names, "weight"])

    return features.mapInArrow(run, kept.schema.add("weight", "long"))


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the digest of ``seed:key``; null for a null key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    spec: Features = Features(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Columns: the key, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every document.

    Of the documents with ``least_words`` words at least, the given percent (rounded down) with the highest scores
    are drawn and ranked from 1, ties to the smaller key; the others have no rank. Whole texts of both tables are
    counted. A null or blank text has no feature and weight 0. A row without key has a weight, but no score, and is
    neither drawn nor counted among those drawn from. Rows that share a key are rows of their own with the same noise.
    Empty tables are no special case. Other columns are not read, so that their names cannot clash.
    """
    features = stored(feature_rows(docs, spec, key, text).withColumnRenamed(key, "key"), "features")
    target_features = feature_rows(target.select(F.lit(0).alias("key"), F.col(text)), spec, "key", text)
    gains = bucket_gains(histogram(features, spec), histogram(target_features, spec))
    scored = weights(features, gains).withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
    scored = scored.withColumn("drawable", (F.col("n_words") >= least_words) & F.col("key").isNotNull())
    order = [F.col("drawable").desc(), F.col("score").desc(), F.col("key").asc()]
    placed = numbered(stored(scored, "scored"), order)
    drawn = placed.where("drawable").count() * percent // 100
    rank = F.when(F.col("drawable") & (F.col("place") < drawn), F.col("place") + 1)
    return placed.select(F.col("key").alias(key), "n_words", "n_features", "weight", "score", rank.cast("long").alias("rank"))
