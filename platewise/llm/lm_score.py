"""Cross-entropy difference of a target and a background bigram model over one vocabulary.

The background is all documents, the target those named by their ids; both models count every one of their words. The
vocabulary holds the words that occur at least twice in the background, all others are one unknown word in both
models. Each model is a bigram model drawn to its unigram model by the same Dirichlet weight, and that to the uniform
one over the vocabulary. For every token of a document the loss under the target is set against the loss under the
background. The document's own counts are taken out of both models first.

Counts are looked up across blocks of documents (``key_lookup``): one round for words, one for pairs of words. What is
gathered is the distinct words and pairs of every block, so it grows with the text; no model is held in one place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.blocks import BLOCK_BYTES, answers_of, id_bounds, in_blocks, key_lookup
from platewise.llm.stored import stored
from platewise.llm.text import mix, words_of

LEAST_COUNT, PAIR_WEIGHT, WORD_WEIGHT = 2, 100.0, 0.5
_COUNTS = np.dtype([("b", "<u4"), ("t", "<u4")])
_UNKNOWN, _START, _END = (np.uint64(n) for n in (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D))
_SECOND = np.uint64(0xD1342543DE82EF95)


class _Block:
    """Words of a block's documents, and which of these are target documents."""

    def __init__(self, table: pa.Table):
        marks = table.filter(table.column("text").is_null()).column("doc_id").to_pylist()
        table = table.filter(table.column("text").is_valid())
        self.ids = table.column("doc_id").to_pylist()
        marked = set(marks)
        self.target = np.array([i in marked for i in self.ids], dtype=bool)
        self.words, self.first = words_of(table.column("text").cast(pa.binary()).to_pylist(), lower=True)
        self.owner = np.repeat(np.arange(len(self.ids)), np.diff(self.first))

    def vocabulary(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.words, return_inverse=True)

    def counts(self, which: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size, dtype=_COUNTS)
        out["b"] = np.bincount(which, minlength=size)
        out["t"] = np.bincount(which[self.target[owner]], minlength=size)
        return out

    def events(self, mapped: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each token after its predecessor, the end of each document being a token: word, predecessor, document."""
        lengths = np.diff(self.first) + 1
        ends = np.cumsum(lengths) - 1
        word = np.full(int(lengths.sum()), _END, dtype=np.uint64)
        inner = np.ones(len(word), dtype=bool)
        inner[ends] = False
        word[inner] = mapped
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[ends - lengths + 1] = _START
        return word, before, np.repeat(np.arange(len(lengths)), lengths)


def _pairs(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(word + mix(before) * _SECOND)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over equal neighbours, and which sum belongs to each row."""
    new = np.append(True, keys[1:] != keys[:-1])
    heads = np.flatnonzero(new)
    out = np.zeros(len(heads), dtype=_COUNTS)
    for name in ("b", "t"):
        out[name] = np.add.reduceat(counts[name], heads)
    return out, np.cumsum(new) - 1


def _own(owner: np.ndarray, which: np.ndarray, size: int) -> np.ndarray:
    """For each event, how often it occurs in its own document."""
    _, back, counts = np.unique(owner.astype(np.int64) * size + which, return_inverse=True, return_counts=True)
    return counts[back].astype(float)


def score(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Columns: the key, ``n_tokens`` (words and the end), ``target_loss``, ``background_loss`` (nats per token), ``score``.

    ``score`` is the background loss less the target loss: higher is more like the target. ``target`` has the key
    column; ids that no document has, nulls and repeats change nothing. A null text has no words and is scored on its
    end alone. Rows without key are part of the background. One row per row; other columns are not read. Without any
    target document the target model is uniform.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = target.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id")).distinct().withColumn("text", F.lit(None).cast("string"))
    bounds = id_bounds(rows, "doc_id", "text", block_bytes)
    buckets = max(1, len(bounds))
    blocked = in_blocks(rows.unionByName(marks), bounds)

    def word_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        block = _Block(table)
        kinds, which = block.vocabulary()
        return kinds, block.counts(which, block.owner, len(kinds))

    def word_answer(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[int]]:
        sums, back = _summed(keys, counts)
        rare = sums["b"] < LEAST_COUNT
        total = lambda name, part: int(sums[name][part].sum())
        return sums[back], [int((~rare).sum()), total("b", ~rare), total("t", ~rare), total("b", rare), total("t", rare)]

    words = stored(key_lookup(blocked, buckets, word_keys, word_answer, _COUNTS), "lm-words")
    totals = words.where(F.size("totals") > 0).agg(*[F.coalesce(F.sum(F.get("totals", F.lit(i))), F.lit(0)) for i in range(5)]).first()
    known_kinds, b_known, t_known, b_rare, t_rare = (float(v) for v in totals)
    n_docs = rows.agg(F.count("*")).first()[0]
    n_target = rows.select("doc_id").join(marks.select("doc_id"), "doc_id", "left_semi").count()

    def mapped(block: _Block, replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kinds, which = block.vocabulary()
        counts = answers_of(kinds, replies, buckets, _COUNTS)
        rare = counts["b"] < LEAST_COUNT
        return np.where(rare[which], _UNKNOWN, block.words), which, counts

    def pair_keys(table: pa.Table, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        block = _Block(table)
        word, before, owner = block.events(mapped(block, replies)[0])
        kinds, which = np.unique(_pairs(word, before), return_inverse=True)
        return kinds, block.counts(which, owner, len(kinds))

    def pair_answer(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[int]]:
        sums, back = _summed(keys, counts)
        return sums[back], []

    pairs = key_lookup(blocked, buckets, pair_keys, pair_answer, _COUNTS, words.select("block", "bucket", "answers"))
    sizes = {"b": (b_known + b_rare + n_docs, b_rare, n_docs), "t": (t_known + t_rare + n_target, t_rare, n_target)}
    vocabulary = known_kinds + 2  # the unknown word and the end

    def losses(table: pa.Table, replies: pa.Table) -> pa.Table:
        block = _Block(table)
        if not block.ids:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=names)
        of_round = replies.column("round")
        token, which, counts = mapped(block, replies.filter(pc.equal(of_round, 0)))
        word, before, owner = block.events(token)
        kinds, pair = np.unique(_pairs(word, before), return_inverse=True)
        pair_counts = answers_of(kinds, replies.filter(pc.equal(of_round, 1)), buckets, _COUNTS)
        letters, letter = np.unique(np.concatenate((word, [_START, _UNKNOWN, _END])), return_inverse=True)
        place = {n: int(letter[len(word) + i]) for i, n in enumerate(("start", "unknown", "end"))}
        word_at, before_at = letter[: len(word)], np.searchsorted(letters, before)
        own_pair = _own(owner, pair, len(kinds))
        own_word = _own(owner, word_at, len(letters))
        # How often the predecessor occurs in the own document: a start occurs once.
        size = len(letters)
        held, n_held = np.unique(owner.astype(np.int64) * size + word_at, return_counts=True)
        asked = owner.astype(np.int64) * size + before_at
        at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
        own_before = np.where(before_at == place["start"], 1.0, np.where(held[at] == asked, n_held[at], 0))
        lengths = (np.diff(block.first) + 1).astype(float)
        result = []
        for name in ("t", "b"):
            total, rare, documents = sizes[name]
            single = np.zeros(size)
            known = token != _UNKNOWN
            single[np.searchsorted(letters, token[known])] = counts[name][which[known]]
            single[place["unknown"]], single[place["end"]], single[place["start"]] = rare, documents, documents
            inside = (block.target if name == "t" else np.ones(len(block.ids), dtype=bool)).astype(float)[owner]
            p_word = (single[word_at] - inside * own_word + WORD_WEIGHT) / (total - inside * lengths[owner] + WORD_WEIGHT * vocabulary)
            p = (pair_counts[name][pair] - inside * own_pair + PAIR_WEIGHT * p_word) / (single[before_at] - inside * own_before + PAIR_WEIGHT)
            result.append(np.bincount(owner, -np.log(p), len(block.ids)) / lengths)
        return pa.table([pa.array(block.ids, pa.int64()), pa.array(lengths.astype(np.int64)), *map(pa.array, result)], names=names)

    names = ["doc_id", "n_tokens", "target_loss", "background_loss"]
    heard = words.select("block", "bucket", "answers", F.lit(0).alias("round")).unionByName(pairs.select("block", "bucket", "answers", F.lit(1).alias("round")))
    out = blocked.groupBy("block").cogroup(heard.groupBy("block")).applyInArrow(losses, "doc_id long, n_tokens long, target_loss double, background_loss double")
    return out.select(F.col("doc_id").alias(key), "n_tokens", "target_loss", "background_loss", (F.col("background_loss") - F.col("target_loss")).alias("score"))
