"""Checksums of files that are read in parts."""

import hashlib
import os

import pytest

from platewise.sources import files

ODD = {
    "mark [x] %20.bin": b"\xef\xbb\xbf\r\n\x00\xff\n\nabc\xf0\r" * 400,
    "mark only and line.bin": b"\xef\xbb\xbf" + b"z" * 5000 + b"\n",
    "no line feed.bin": bytes(range(11, 256)) * 40,
    "line feeds.bin": b"\n" * 3000,
    "sub/random.bin": os.urandom(300_000),
    "sub/text.bin.gz": b"\x1f\x8b not compressed" * 200,
    "small.bin": b"abc\n",
}


@pytest.mark.parametrize("part", ["1m", "4k"])
def test_large_files_are_hashed_in_parts(spark, tmp_path, monkeypatch, part):
    for name, data in ODD.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    want = {os.path.basename(n): (len(d), hashlib.sha256(d).hexdigest()) for n, d in ODD.items()}
    monkeypatch.setattr(files, "WHOLE_BYTES", 1000)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.sources.binaryFile.maxLength", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = files.file_checksums(spark, str(tmp_path))
        assert {r["name"]: (r.n_bytes, r.sha256) for r in got.collect()} == want and got.columns == ["path", "name", "n_bytes", "sha256"]
        paths = {r.path.removeprefix("file:") for r in got.collect()}
        assert paths == {str(tmp_path / n) for n in ODD}
        # Longer than a value may be: the limit stands for the 2 GB that a value holds at most.
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "4000")
        assert files.file_checksums(spark, str(tmp_path), "random*").first().sha256 == want["random.bin"][1]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_the_store_is_built_without_a_stored_copy_of_its_source(spark, monkeypatch):
    from platewise.catalog import learning

    seen = []
    monkeypatch.setattr(learning, "build_feature_store", lambda spark, source, path: seen.append(source.inputFiles()))
    learning._store_path.__wrapped__(spark, "/root/testdata/sf0.001")
    assert [f.rsplit("/", 2)[-2:] for f in seen[0]] == [["sf0.001", "lineitem.parquet"]]
