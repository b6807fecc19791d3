"""Toxicity scores from averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the average of the vectors of its character n-grams (and of the word itself), so that an unseen spelling
shares most of a known word's vectors. A passage of a few words is the average of its words and goes through a linear
softmax with two classes. Labels are of documents: all passages of a clean document are clean, of a toxic one the
passage that scores highest is toxic. A document scores as its highest passage, calibrated on the training documents.

Because everything up to the softmax is an average, a word has one number: the difference of its two logits. Scoring
looks up that number per word and takes the highest moving average over the whole text. A word that repeats itself at once counts once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.stored import stored

# Bounds of the training sample, per class: documents and bytes of text.
TRAIN_DOCUMENTS, TRAIN_BYTES = 1500, 5 << 20
# Longer training texts count by passages from all of their length: characters in all, and passages.
EXCERPT, PARTS = 1 << 16, 16
PASSAGE, DIMENSIONS, EPOCHS, RATE, DECAY = 12, 4, 80, 0.1, 1e-4
# An n-gram gets a vector if its share in toxic documents differs by so many standard errors from that of all n-grams.
LEAST_ERRORS, LEAST_COUNT = 4.0, 5
GRAMS = (3, 4, 5, 6)
_BUCKETS = 1 << 20
_CACHE = 300_000
_words = re.compile(r"[^\W_]+").findall


def grams_of(word: str) -> list[str]:
    """Character n-grams with marks for the word's ends; the last is the word itself."""
    marked = f"<{word}>"
    return [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)] + [marked]


class Model(NamedTuple):
    """Logit of each n-gram (the softmax applied to its vector), intercept, and calibration of a document's maximum."""

    grams: dict[str, float]
    intercept: float
    slope: float
    offset: float


def _highest(values: np.ndarray) -> float:
    """Highest mean of ``PASSAGE`` consecutive values; a text shorter than half of that counts as half."""
    if len(values) > 1:  # a word that repeats at once counts once
        values = values[np.append(True, (np.diff(values) != 0) | (values[1:] == 0))]
    n = len(values)
    if n <= PASSAGE:
        return float(values.sum()) / max(n, PASSAGE // 2)
    sums = np.cumsum(values)
    return float(max(sums[PASSAGE - 1], (sums[PASSAGE:] - sums[:-PASSAGE]).max())) / PASSAGE


class Scorer:
    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def _word(self, word: str) -> float:
        parts, known = grams_of(word), self.model.grams
        value = sum(known.get(g, 0.0) for g in parts) / len(parts)
        if len(self.cache) > _CACHE:
            self.cache.clear()
        self.cache[word] = value
        return value

    def raw(self, text: str) -> float:
        get, value = self.cache.get, self._word
        scores = [value(w) if (s := get(w)) is None else s for w in _words(text.lower())]
        return self.model.intercept + _highest(np.array(scores)) if scores else self.model.intercept

    def score(self, text: str) -> float:
        z = self.model.slope * self.raw(text) + self.model.offset
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _sums(values: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(index, values[:, d], size) for d in range(values.shape[1])], axis=1)


def _differs(counts: np.ndarray, overall: float) -> np.ndarray:
    total = counts.sum(axis=1)
    errors = np.abs(counts[:, 1] - total * overall) / np.sqrt(np.maximum(total * overall * (1 - overall), 1e-9))
    return (errors >= LEAST_ERRORS) & (total >= LEAST_COUNT)


def _telling(names: list[str], counts: np.ndarray) -> dict[str, int]:
    """Numbers of the n-grams that tell the classes apart.

    A first pass counts by hash, in a table of fixed size; only n-grams of telling buckets are then counted by name.
    """
    weights = [Counter(), Counter()]
    overall, table = counts[:, 1].sum() / max(counts.sum(), 1), np.zeros((_BUCKETS, 2))
    for a in range(0, len(names), 20_000):
        buckets = [[crc32(g.encode()) % _BUCKETS for g in grams_of(w)] for w in names[a : a + 20_000]]
        rows = np.repeat(counts[a : a + 20_000], [len(b) for b in buckets], axis=0)
        flat = np.fromiter(chain.from_iterable(buckets), np.int64)
        for c in (0, 1):
            table[:, c] += np.bincount(flat, rows[:, c], _BUCKETS)
    telling = _differs(table, overall).tolist()
    for name, pair in zip(names, counts.tolist()):
        for g in grams_of(name):
            if telling[crc32(g.encode()) % _BUCKETS]:
                for c in (0, 1):
                    weights[c][g] += pair[c]
    found = list(weights[0])
    use = _differs(np.array([[weights[0][g], weights[1][g]] for g in found]).reshape(-1, 2), overall)
    return {g: i for i, g in enumerate(g for g, u in zip(found, use.tolist()) if u)}


class _Adam:
    """Steps of one parameter array."""

    def __init__(self, like: np.ndarray):
        self.mean, self.square, self.n = np.zeros_like(like), np.zeros_like(like), 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.n += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.99 * self.square + 0.01 * gradient**2
        return RATE * (self.mean / (1 - 0.9**self.n)) / (np.sqrt(self.square / (1 - 0.99**self.n)) + 1e-8)


def fit(texts: list[str], labels: np.ndarray, seed: int = 1) -> Model:
    """Train on documents; deterministic for the same documents in the same order."""
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in _words(t.lower())], dtype=np.int64) for t in texts]
    docs = [d[np.append(True, np.diff(d) != 0)] if len(d) else d for d in docs]
    names = list(vocabulary)
    counts = np.stack(
        [np.bincount(np.concatenate([np.unique(d) for d, y in zip(docs, labels) if y == c] + [np.zeros(0, np.int64)]), minlength=len(names)) for c in (0, 1)],
        axis=1,
    )
    kept = _telling(names, counts)
    pairs = [(w, i) for w, name in enumerate(names) for g in grams_of(name) if (i := kept.get(g)) is not None]
    if not pairs or len(set(labels.tolist())) < 2:
        rate = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
        return Model({}, 0.0, 1.0, float(np.log(rate / (1 - rate))))
    of_word, of_gram = np.array(pairs, dtype=np.int64).T
    share = 1.0 / np.array([len(grams_of(w)) for w in names])[of_word][:, None]
    cuts = [(i, d[a : a + PASSAGE]) for i, d in enumerate(docs) for a in range(0, len(d), PASSAGE)]
    owner = np.array([i for i, _ in cuts])
    passage = np.repeat(np.arange(len(cuts)), [len(d) for _, d in cuts])
    words = np.concatenate([d for _, d in cuts])
    known = (np.bincount(of_word, minlength=len(names)) > 0)[words]  # other words have the vector 0
    passage, words = passage[known], words[known]
    weight = 1.0 / np.maximum(np.array([len(d) for _, d in cuts]), PASSAGE // 2)[:, None]
    toxic = labels[owner] == 1
    heads = np.flatnonzero(np.append(True, np.diff(owner) != 0))
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (len(kept), DIMENSIONS))
    softmax = rng.normal(0, 0.5, (2, DIMENSIONS))
    bias = np.zeros(2)
    optimisers = [_Adam(p) for p in (vectors, softmax, bias)]
    for epoch in range(EPOCHS):
        word_vectors = _sums(vectors[of_gram] * share, of_word, len(names))
        bags = _sums(word_vectors[words], passage, len(cuts)) * weight
        logits = bags @ softmax.T + bias
        margin = logits[:, 1] - logits[:, 0]
        p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        # Each document weighs one: clean passages alike, of a toxic document the best ones (all of them at first).
        use = np.ones(len(cuts))
        if epoch >= EPOCHS // 6:
            best = np.full(len(docs), -np.inf)
            best[owner[heads]] = np.maximum.reduceat(margin, heads)
            use[toxic & (margin < best[owner])] = 0
        each = np.bincount(owner, use, len(docs))
        error = (p - toxic) * use / each[owner] / len(docs)
        if epoch >= EPOCHS // 6:  # the worst passage of a clean document counts as much as all its others
            worst = ~toxic & (margin >= best[owner])
            error[worst] += p[worst] / len(docs)
        grad = np.stack([-error, error], axis=1)
        down = (grad @ softmax) * weight
        by_word = _sums(down[passage], words, len(names))
        steps = (_sums(by_word[of_word] * share, of_gram, len(kept)) + DECAY * vectors, grad.T @ bags + DECAY * softmax, grad.sum(axis=0))
        for parameter, optimiser, gradient in zip((vectors, softmax, bias), optimisers, steps):
            parameter -= optimiser.step(gradient)
    logit = vectors @ (softmax[1] - softmax[0])
    model = Model(dict(zip(kept, logit.tolist())), float(bias[1] - bias[0]), 1.0, 0.0)
    scorer = Scorer(model)
    raw = np.array([scorer.raw(t) for t in texts])
    slope, offset = calibrate(raw, labels)
    return model._replace(slope=slope, offset=offset)


def calibrate(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the labels on one number, by Newton steps with a slight ridge."""
    mean, scale = raw.mean(), raw.std() + 1e-9
    x = np.stack([(raw - mean) / scale, np.ones(len(raw))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 0.1 * np.eye(2)
        w -= np.linalg.solve(hessian, x.T @ (p - labels) + 0.1 * w)
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)


def excerpt(text: Column) -> Column:
    """A text of up to ``EXCERPT`` characters; of a longer one, ``PARTS`` passages spread evenly over all of it."""
    n, size = F.char_length(text), EXCERPT // PARTS
    parts = [F.substring(text, (F.floor(n * i / PARTS) + 1).cast("int"), F.lit(size)) for i in range(PARTS)]
    return F.when(n <= EXCERPT, text).otherwise(F.concat_ws(" ", *parts))


def training_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Columns ``doc_id``, ``y``, ``text``, ``place``: per class at most ``TRAIN_DOCUMENTS`` documents and ``TRAIN_BYTES`` of text.

    Labelled ids come in the order of their hash, each once; an id with both labels is toxic. Long texts count by
    their excerpts, so that the first of every class that has any always fits. Of rows that share an id, one text is
    taken. The table is bounded, and written before it is read.
    """
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    place = F.struct(F.xxhash64("doc_id").alias("hash"), "doc_id")
    picked = None
    for y in (0, 1):
        some = marked.where(F.col("y") == y).orderBy(place).limit(TRAIN_DOCUMENTS)
        picked = some if picked is None else picked.unionByName(some)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The sample's ids are bounded, so they may be broadcast; its texts are read in one pass.
    found = rows.join(F.broadcast(picked), "doc_id").withColumn("text", excerpt(F.col("text")))
    one = found.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    kept = stored(one.withColumn("place", place), "toxicity-sample")
    spent = F.sum(F.octet_length("text")).over(Window.partitionBy("y").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return kept.withColumn("spent", spent).where(F.col("spent") <= TRAIN_BYTES).drop("spent")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the bounded ``training_sample``, in one task; the driver gets the model only.

    ``labels`` has the key and the label (0 or 1; other rows are left out). Without documents of both classes all
    texts score alike.
    """
    sample = training_sample(docs, labels, key, text, label).withColumn("all", F.lit(0))

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("place").to_pylist(), table.column("text").to_pylist(), table.column("y").to_pylist()), key=lambda r: tuple(r[0].values()))
        model = fit([t for _, t, _ in rows], np.array([y for _, _, y in rows]))
        numbers = pa.array([[model.intercept, model.slope, model.offset]], pa.list_(pa.float64()))
        columns = [pa.array([list(model.grams)], pa.list_(pa.string())), pa.array([list(model.grams.values())], pa.list_(pa.float64())), numbers]
        return pa.table(columns, names=["grams", "logits", "numbers"])

    found = sample.groupBy("all").applyInArrow(run, "grams array<string>, logits array<double>, numbers array<double>").first()
    return Model(dict(zip(found.grams, found.logits)), *found.numbers) if found else fit([], np.zeros(0))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key and ``score`` (0 to 1, higher: toxic is likelier) of every whole text.

    A null or empty text, or one without a word, scores as a passage of no known words. One row per row, repeated
    rows included; other columns are not read. The key may be null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    schema = docs.select(F.col(key).alias("key")).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = [scorer.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores, pa.float64())], ["key", "score"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t or "") < threshold for t in batch.column(text).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
