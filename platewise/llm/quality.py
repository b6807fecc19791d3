"""Document quality by a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, and chosen pairs of features have one over pairs of bins. The
tables are learned by cyclic boosting of shallow trees: round after round every feature in turn gets a small tree on
the gradients of the logistic loss, and the tree's leaves are added to its table; then the pairs do. A text is scored
by adding one bin of each table, for all texts of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bound of the training sample: labelled documents, the first by hash of their ids.
TRAIN_DOCUMENTS = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, LEAST_WEIGHT = 32, 8, 8, 120, 60, 0.1, 4.0

FEATURES = [
    "log_words", "word_bytes", "upper_share", "symbol_share", "digit_share", "distinct_share", "repeat_share",
    "top_symbol_share", "words_per_line", "repeated_line_share", "non_ascii_share", "line_start_share", "double_symbol_share",
]
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_SYMBOL = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_PLAIN = np.array([chr(b) in ".,;:'\"-?()" for b in range(256)])


def features_of(data: bytes) -> list[float]:
    """Numbers about a whole text, in the order of ``FEATURES``; zeros for one without words."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    solid = max(1, n and sum(map(len, words)))
    letters = max(1, int(counts[_UPPER].sum() + counts[_LOWER].sum()))
    symbols = counts * _SYMBOL
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbol = _SYMBOL[raw]
    return [
        float(np.log1p(n)),
        solid / n,
        float(counts[_UPPER].sum()) / letters,
        float(symbols.sum()) / solid,
        float(counts[_DIGIT].sum()) / solid,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        float((symbols * ~_PLAIN).max()) / solid,
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        float(counts[128:].sum()) / solid,
        float(counts[10]) / n,
        float((symbol[1:] & symbol[:-1]).sum()) / solid,
    ]


def feature_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key and ``features``."""
    schema = docs.select(F.col(key).alias("key")).schema.add("features", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features_of(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, pa.list_(pa.float64()))], ["key", "features"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


class Model(NamedTuple):
    """Upper edges of each feature's bins, tables of features and of pairs (with coarser edges), and the intercept."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    intercept: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[f], x[:, f])]
        bins = [np.searchsorted(e, x[:, f]) for f, e in enumerate(self.coarse)] if self.pairs else []
        for (f, g), table in zip(self.pairs, self.pair_tables):
            out += table[bins[f], bins[g]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -40, 40)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _best_split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of ordered bins, and the number of bins on the left."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gains = _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(g.sum(), h.sum())
    gains[(left_h < LEAST_WEIGHT * 0.25) | (right_h < LEAST_WEIGHT * 0.25)] = 0
    at = int(gains.argmax())
    return float(gains[at]), at + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values over ordered bins of a tree of at most ``depth`` levels."""
    gain, cut = _best_split(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1.0))
    return np.concatenate((_shallow_tree(g[:cut], h[:cut], depth - 1), _shallow_tree(g[cut:], h[cut:], depth - 1)))


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree that cuts one feature, then the other on either side; the better order."""
    best = (0.0, np.zeros_like(g))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        _, cut = _best_split(a.sum(axis=1), b.sum(axis=1))
        gain, out = -_gain(a.sum(), b.sum()), np.zeros_like(a)
        for part in (slice(0, cut), slice(cut, None)):
            ga, ha = a[part].sum(axis=0), b[part].sum(axis=0)
            if len(a[part]):
                leaves = _shallow_tree(ga, ha, 1)
                out[part] = leaves
                gain += sum(_gain(ga[leaves == v].sum(), ha[leaves == v].sum()) for v in np.unique(leaves))
        if gain > best[0]:
            best = (float(gain), out.T if flip else out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables; deterministic. Without both labels the model is their rate."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    intercept = float(np.log(rate / (1 - rate)))
    n = len(FEATURES)
    edges, coarse = ([_edges(x[:, f], k) for f in range(n)] for k in (BINS, PAIR_BINS))
    tables = [np.zeros(len(e) + 1) for e in edges]
    if y.sum() in (0, len(y)):
        return Model(edges, coarse, tables, [], [], intercept)
    bins = [np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]
    margin = np.full(len(y), intercept)

    def sums(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return np.bincount(index, y - p, size), np.bincount(index, p * (1 - p), size)

    for _ in range(ROUNDS):
        for f in range(n):
            step = RATE * _shallow_tree(*sums(bins[f], len(tables[f])))
            tables[f] += step
            margin += step[bins[f]]
    few = [np.searchsorted(e, x[:, f]) for f, e in enumerate(coarse)]
    shapes = {(f, g): (len(coarse[f]) + 1, len(coarse[g]) + 1) for f, g in combinations(range(n), 2)}
    joint = {p: few[p[0]] * s[1] + few[p[1]] for p, s in shapes.items()}

    def tree(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
        g, h = sums(joint[pair], shapes[pair][0] * shapes[pair][1])
        return _pair_tree(g.reshape(shapes[pair]), h.reshape(shapes[pair]))

    pairs = sorted(shapes, key=lambda p: -tree(p)[0])[:PAIRS]
    pair_tables = {p: np.zeros(shapes[p]) for p in pairs}
    for _ in range(PAIR_ROUNDS):
        for p in pairs:
            step = RATE * tree(p)[1]
            pair_tables[p] += step
            margin += step.ravel()[joint[p]]
    return Model(edges, coarse, tables, pairs, [pair_tables[p] for p in pairs], intercept)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the features of at most ``TRAIN_DOCUMENTS`` labelled documents, the first by hash of their ids."""
    picked = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_DOCUMENTS)
    )
    chosen = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(picked), "doc_id")
    described = feature_table(chosen.select(F.struct("doc_id", "y").alias("row"), "text"), "row", "text")
    rows = described.select("row.doc_id", "row.y", "features").orderBy("doc_id", "y").collect()
    x = np.array([r.features for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.y for r in rows], dtype=float))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key and ``score`` (0 to 1, higher: good quality is likelier) of every whole text.

    A null or blank text has the features of no words. One row per row; other columns are not read. The key may be null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few tables of fixed size
    schema = docs.select(F.col(key).alias("key")).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features_of(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            scores = shared.value.scores(np.array(rows, dtype=float).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores)], ["key", "score"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)
