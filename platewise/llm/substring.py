"""Removal of passages that an earlier document has, by automata of repeated phrases.

1. Documents are cut into blocks by ranges of ids. Every block sends the hashes of its distinct windows (runs of
   consecutive words) to hash buckets and hears which of them an earlier block has.
2. With that and its own texts a block knows its recurring windows; runs of them are its confirmed passages.
3. The passages are cut into phrases of one window each that cover them, and compiled into an Aho-Corasick automaton:
   one shard per block, which holds exactly the phrases that occur in the block.
4. All documents of the block are streamed through the automaton, which locates every occurrence. The union of the
   occurrences in documents after the phrase's first one is removed.

The automaton's letters are the words. Windows of different blocks are equal if their 64-bit hashes are; two unequal
ones among n windows agree with a chance of n in 2^64. A shard is never larger than its block, so memory is bounded
and the work grows with the text, however often a passage occurs.
"""

from __future__ import annotations

from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.blocks import BLOCK_BYTES, answers_of, id_bounds, in_blocks, key_lookup
from platewise.llm.text import gram_starts, grams, words_of

# Letters an automaton can tell apart: code points without surrogates and the letter 0 of all other words.
_LETTERS = 0x110000 - 0x800 - 1


class _Windows:
    """Words and windows of a block, documents in order of their ids."""

    def __init__(self, table: pa.Table, window: int):
        table = table.sort_by("doc_id")
        self.ids = table.column("doc_id").fill_null(0).to_numpy()
        self.texts = table.column("text").cast(pa.binary()).to_pylist()
        self.loose = table.column("block")[0].as_py() < 0
        self.words, self.first = words_of(self.texts)
        self.starts, self.owner = gram_starts(self.first, window)
        self.keys = grams(self.words, window)[self.starts] if len(self.starts) else np.zeros(0, dtype=np.uint64)


def _letters(words: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """A text over letters for the words, and letters per word; words outside recurring windows share a letter."""
    kinds, letter = np.unique(words[wanted], return_inverse=True)
    out = np.zeros(len(words), dtype=np.uint32)
    if len(kinds) < _LETTERS:
        code = letter + 1
        out[wanted] = np.where(code >= 0xD800, code + 0x800, code)
        return out, 1
    out = np.zeros((len(words), 2), dtype=np.uint32)
    out[wanted, 0], out[wanted, 1] = letter // 0x8000 + 1, letter % 0x8000 + 1
    return out.ravel(), 2


def _covered(block: _Windows, keys: np.ndarray, which: np.ndarray, first: np.ndarray, earlier: np.ndarray, window: int) -> np.ndarray:
    """For each word of the block, whether an occurrence of a phrase covers it."""
    n_words = len(block.words)
    origin = block.ids[block.owner[first]][which]  # the window's first document in this block
    before = earlier[which]
    repeated = before | (block.ids[block.owner] > origin)
    marks = np.zeros(n_words + 1, dtype=np.int64)
    if not repeated.any():
        return marks[:n_words] > 0
    at = np.flatnonzero(repeated)
    # Passages: repeated windows that follow one another in a document. Phrases: every window-th, and the last.
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(block.starts[at]) != 1) | (np.diff(block.owner[at]) != 0)
    head = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    last = np.append(new[1:], True)
    phrases = at[((np.arange(len(at)) - head) % window == 0) | last]
    phrases = phrases[np.unique(which[phrases], return_index=True)[1]]
    wanted = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(wanted, block.starts[phrases], 1)
    np.add.at(wanted, block.starts[phrases] + window, -1)
    letters, width = _letters(block.words, np.isin(block.words, block.words[np.cumsum(wanted)[:n_words] > 0]))
    text = letters.astype("<u4").tobytes().decode("utf-32-le")
    automaton = ahocorasick.Automaton()
    for p in phrases.tolist():
        a = int(block.starts[p]) * width
        automaton.add_word(text[a : a + window * width], None if before[p] else int(origin[p]))
    automaton.make_automaton()
    for i, doc_id in enumerate(block.ids.tolist()):
        a, b = int(block.first[i]) * width, int(block.first[i + 1]) * width
        for end, origin_id in automaton.iter(text, a, b):
            if (origin_id is None or origin_id < doc_id) and (end + 1) % width == 0:
                stop = (end + 1) // width
                marks[stop - window] += 1
                marks[stop] -= 1
    return np.cumsum(marks)[:n_words] > 0


def remove_repeats(docs: DataFrame, window: int = 13, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns: the key, ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space).

    A word is removed if a window of ``window`` consecutive words covers it whose words also start in a document with
    a smaller id. Windows are judged on the input. Words are runs without ASCII white space, unchanged. A null text
    has no words. Rows with the same id don't remove from one another; a row without id is kept whole and removes
    nothing. One row per row; other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = id_bounds(rows, "doc_id", "text", block_bytes)
    buckets = max(1, len(bounds))
    blocked = in_blocks(rows, bounds)

    def keys_of(table: pa.Table) -> tuple[np.ndarray, None]:
        block = _Windows(table, window)
        return (np.zeros(0, dtype=np.uint64) if block.loose else np.unique(block.keys)), None

    def earlier(keys: np.ndarray, counts: None) -> tuple[np.ndarray, list[int]]:
        out = np.zeros(len(keys), dtype=bool)
        out[1:] = keys[1:] == keys[:-1]
        return out, []

    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())], names=names)
        block = _Windows(table, window)
        gone = np.zeros(len(block.words), dtype=bool)
        if len(block.keys) and not block.loose:
            keys, first, which = np.unique(block.keys, return_index=True, return_inverse=True)
            gone = _covered(block, keys, which, first, answers_of(keys, replies, buckets, bool), window)
        kept = []
        for i, data in enumerate(block.texts):
            here = gone[block.first[i] : block.first[i + 1]]
            words = data.split()
            kept.append(b" ".join(compress(words, (~here).tolist())) if here.any() else b" ".join(words))
        sums = np.concatenate(([0], np.cumsum(gone)))
        columns = [pa.array(block.ids, pa.int64(), mask=np.full(len(block.ids), block.loose)), pa.array(np.diff(block.first)), pa.array(sums[block.first[1:]] - sums[block.first[:-1]]), pa.array(kept, pa.binary())]
        return pa.table(columns, names=names)

    names = ["doc_id", "n_words", "n_removed", "kept_text"]
    replies = key_lookup(blocked, buckets, keys_of, earlier)
    out = blocked.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, kept_text binary")
    return out.select(F.col("doc_id").alias(key), "n_words", "n_removed", F.col("kept_text").cast("string").alias("kept_text"))
