"""Files as rows: inventories and checksums. The driver sees no file's bytes; a large file is read in parts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from platewise.sources.lake import source_of_path


def file_inventory(df: DataFrame, raw_root: str | None = None) -> DataFrame:
    """Files and bytes per source of a file-backed frame, from file metadata.

    Rows are reduced to one per file inside each task before anything is shuffled.
    """
    files = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    ).distinct()
    return (
        files.groupBy(source_of_path(F.col("path"), raw_root).alias("source"))
        .agg(F.count("*").alias("n_files"), F.sum("bytes").alias("n_bytes"))
    )


# Larger files are not read as one value, which holds 2 GB at most and fills its task.
WHOLE_BYTES = 128 << 20
# Files with these endings would be decompressed if they were read in parts.
_CODECS = r"\.(gz|bz2|deflate|snappy|lz4|zst|zstd)$"
_MARK = b"\xef\xbb\xbf"


def file_checksums(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, name, n_bytes, sha256)`` of every file.

    A file is hashed whole by the task that reads it. One above ``WHOLE_BYTES`` is read in parts by many tasks; then one
    task streams its parts in order and holds some of them. Compressed text is always hashed whole.
    """

    def found(kind: str) -> DataFrameReader:
        return spark.read.format(kind).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)

    listed = found("binaryFile").load(path)
    above, packed = F.col("length") > WHOLE_BYTES, F.col("path").rlike(_CODECS)
    columns = ["path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("n_bytes")]
    whole = listed.where(~above).select(*columns, F.sha2("content", 256).alias("sha256"))
    large = listed.where(above).select(*columns, F.col("_metadata.file_path").alias("_file"), packed.alias("_packed")).collect()  # one row per such file
    if not large:
        return whole
    if any(r["_packed"] for r in large):  # by name, as the source would read the others' bytes too
        named = spark.read.format("binaryFile").load([re.sub(r"([\\\[\]{}*?,])", r"\\\1", r["path"]) for r in large if r["_packed"]])
        whole = whole.unionByName(named.select(*columns, F.sha2("content", 256).alias("sha256")))
    large = spark.createDataFrame([r[:4] for r in large if not r["_packed"]], "path string, name string, n_bytes long, _file string")
    # Lines are bytes up to the next line feed; they are not decoded.
    lines = found("text").option("lineSep", "\n").load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("bytes"),
    )
    pieces = lines.where((F.col("size") > WHOLE_BYTES) & ~F.col("file").rlike(_CODECS)).mapInArrow(_pieces, "file string, start long, size long, place long, bytes binary")
    hashed = pieces.repartition("file").sortWithinPartitions("file", "start", "place").mapInArrow(_hashed, "_file string, sha256 string")
    return whole.unionByName(large.join(hashed, "_file").drop("_file"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of a batch in one value for each part of a file."""
    place = 0
    for batch in batches:
        starts = batch.column("start").to_numpy()
        files = batch.column("file").dictionary_encode().indices.to_numpy()
        ends = [0, *(np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(ends, ends[1:]):
            if a < b:
                row = batch.slice(a, 1)
                values = [*[row.column(c) for c in ("file", "start", "size")], pa.array([place], pa.int64()), pa.array([b"".join(batch.column("bytes").slice(a, b - a).to_pylist())], pa.binary())]
                yield pa.RecordBatch.from_arrays(values, ["file", "start", "size", "place", "bytes"])
                place += 1


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each file from its parts in order.

    Reading adds a line feed after the last line and leaves out a byte-order mark. The size tells which of these is so;
    as that is known only at the end, the digest is taken with and without the mark.
    """
    file = size = None
    digests, last, length = [], b"", 0

    def done() -> pa.RecordBatch:
        extra = length - size
        if extra not in (0, 1, -3, -2):
            raise ValueError(f"{file} changed while it was read")
        digest = digests[extra < 0]
        digest.update(last if extra in (0, -3) else b"")
        return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([digest.hexdigest()])], ["_file", "sha256"])

    for batch in batches:
        for i in range(batch.num_rows):
            name, piece = batch.column("file")[i].as_py(), batch.column("bytes")[i].as_py()
            if name != file:
                if file is not None:
                    yield done()
                file, size, last, length = name, batch.column("size")[i].as_py(), b"", 0
                digests = [hashlib.sha256(), hashlib.sha256(_MARK)]
            for digest in digests:
                digest.update(last)
                digest.update(memoryview(piece)[:-1])
            last, length = piece[-1:], length + len(piece)
    if file is not None:
        yield done()


def dataset_fingerprint(checksums: DataFrame, digest: str = "sha256") -> DataFrame:
    """One digest over a set of hexadecimal digests: the same for any order, different for other content or repeats.

    Digests are added up in parts of 32 bits: partial sums of fixed size, however many files there are.
    """
    parts = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(38,0)") for i in range(8)]
    sums = checksums.agg(*[F.coalesce(F.sum(p), F.lit(0)).cast("string").alias(f"s{i}") for i, p in enumerate(parts)], F.count(digest).alias("n_files"))
    whole = F.concat_ws("|", *[f"s{i}" for i in range(8)], F.col("n_files").cast("string"))
    return sums.select(F.sha2(whole, 256).alias("fingerprint"), "n_files")
