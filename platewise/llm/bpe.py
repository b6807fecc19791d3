"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

The rank file is written out as a sentencepiece BPE model: every token's bytes are mapped to one character each,
a token's score is its negative rank, and normalisation is the identity, so that the best-scored merge is the
merge of lowest rank. Text is split by the pre-token pattern first; each pre-token is encoded on its own.
Nothing is trained.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of the cache of encoded pre-tokens in a Python worker: entries, and length of a pre-token that is kept.
_CACHE_ENTRIES = 120_000
_CACHE_LENGTH = 40
_FIRST_CHARACTER = 0x100
_CHARACTERS = {b: _FIRST_CHARACTER + b for b in range(256)}


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Tokens in the order of their ranks, which have to be 0, 1, 2 and so on; the file holds ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks have gaps")
    return [ranked[i] for i in range(len(ranked))]


def _mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_CHARACTERS)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def serialise_model(tokens: list[bytes]) -> bytes:
    """The sentencepiece model file for ranked tokens; the piece after the last token is the unknown one."""
    unknown_kind, bpe_kind = 2, 2
    out = [_message(1, _message(1, _mapped(t).encode()) + b"\x15" + struct.pack("<f", -rank)) for rank, t in enumerate(tokens)]
    out.append(_message(1, _message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, unknown_kind)))
    trainer = _number(3, bpe_kind) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
    trainer += b"".join(_varint(f << 3) + b"\xff" * 9 + b"\x01" for f in (41, 42, 43))  # no begin, end and pad pieces
    normaliser = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _message(2, trainer) + _message(3, normaliser)


class Encoder:
    """Packed ids of texts, in one Python worker."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.whole = {t: struct.pack("<I", i) for i, t in enumerate(tokens)}
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        parts, cache = self.split(text), self.cache
        missing = [p for p in set(parts) if p not in cache]
        if missing:
            cache.update(self._encode(missing))
        out = b"".join(map(cache.__getitem__, parts))
        if len(cache) > _CACHE_ENTRIES:
            cache.clear()
        else:
            for p in missing:
                if len(p) > _CACHE_LENGTH:
                    del cache[p]
        return out

    def _encode(self, parts: list[str]) -> dict[str, bytes]:
        out, rest = {}, []
        for p in parts:
            known = self.whole.get(p.encode())
            if known is None:
                rest.append(p)
            else:
                out[p] = known
        for p, ids in zip(rest, self.pieces.encode([_mapped(p.encode()) for p in rest], num_threads=1) if rest else []):
            out[p] = struct.pack(f"<{len(ids)}I", *ids)
        return out


def encode(df: DataFrame, tokens: list[bytes], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key, ``ids`` (binary, ids as little-endian unsigned 32-bit integers), ``n_tokens``.

    Whole texts; a null text is an empty one and has no ids. One row per row, repeated rows included; other columns
    are not read, so that their names cannot clash. Special tokens are ordinary text. The key may be null.
    """
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((serialise_model(tokens), tokens, pattern))  # the vocabulary: bounded by its file
    schema = df.select(F.col(key).alias("key")).schema.add("ids", "binary").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            ids = [encoder.encode(t) if t else b"" for t in batch.column("text").to_pylist()]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.binary()), counts], ["key", "ids", "n_tokens"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(df: DataFrame, tokens: list[bytes], key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Columns: the key, ``ids`` and ``n_tokens`` as given, and ``decoded``: the bytes the ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    schema = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"), "n_tokens").schema.add("decoded", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            texts = [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) if x else b"" for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"), "n_tokens")
    return rows.mapInArrow(run, schema).withColumnsRenamed({"key": key, "ids": ids})


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, then decode: the key, ``ids``, ``n_tokens`` and ``decoded``."""
    tokens = read_ranks(df.sparkSession, path)
    return decode(encode(df, tokens, pattern, key, text), tokens, key)


def digests(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sizes and SHA-256 of what ``round_trip`` gives."""
    return tokens.select(
        key, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
