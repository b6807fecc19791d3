"""Document fingerprints from closed syncmers, in DataFrame functions only.

The letters are words (runs without ASCII white space). Of all runs of ``K`` words, a closed syncmer is one whose
smallest inner part (a single word, by hash) lies at its first or last place. Whether a run is chosen depends on its
own words only, so an edit elsewhere in a text never moves the anchors. A fingerprint holds the smallest ``SKETCH``
hashes of a text's syncmers, as fixed-width hexadecimal; two fingerprints are as like as the share of the smallest
hashes of both that are in either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.blocks import BLOCK_BYTES, id_bounds, in_blocks

K, SKETCH = 5, 64
_SPACE = " \t\n\x0b\x0c\r"
_GAP = r"[ \t-\r]+"


def word_hashes(text: Column) -> Column:
    """Hash of each word of a text; an empty array for a text without words."""
    trimmed = F.trim(text, F.lit(_SPACE))
    return F.when(trimmed != "", F.transform(F.split(trimmed, _GAP), lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))


def closed_syncmers(hashes: Column) -> Column:
    """For each position in the words, the hash of the run of ``K`` words there if it is a closed syncmer, else null."""

    def run(i: Column) -> Column:
        at = [F.get(hashes, i + j) for j in range(K)]
        return F.when(F.least(at[0], at[-1]) <= F.least(*at[1:-1]), F.xxhash64(*at))

    return F.when(F.size(hashes) >= K, F.transform(F.sequence(F.lit(0), F.size(hashes) - K), run)).otherwise(F.array().cast("array<bigint>"))


def sketch(hashes: Column, syncmers: Column) -> Column:
    """The smallest distinct syncmer hashes (32 bits of each); a text with words but no syncmer has the hash of all its words."""
    chosen = F.array_distinct(F.transform(F.array_compact(syncmers), lambda x: F.shiftrightunsigned(x, 32)))
    whole = F.array(F.shiftrightunsigned(F.xxhash64(hashes), 32))
    some = F.when(F.size(chosen) > 0, F.slice(F.array_sort(chosen), 1, SKETCH))
    return some.when(F.size(hashes) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def as_string(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two sketches; two empty ones are alike."""
    lowest = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect(a, b), lowest))
    return F.when(F.size(lowest) == 0, F.lit(1.0)).otherwise(common / F.size(lowest))


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the sketch of a text column; the steps are columns of their own, so that each is computed once."""
    steps = df.withColumn("_words", word_hashes(F.col(text))).withColumn("_syncmers", closed_syncmers(F.col("_words")))
    return steps.withColumn(name, sketch(F.col("_words"), F.col("_syncmers"))).drop("_words", "_syncmers")


def anchors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key, ``position`` (word number from 0), ``anchor``: every closed syncmer, for positional matching."""
    rows = docs.select(F.col(key).alias("key"), word_hashes(F.coalesce(F.col(text), F.lit(""))).alias("words"))
    found = rows.select("key", F.posexplode_outer(closed_syncmers(F.col("words"))).alias("position", "anchor"))
    return found.where("anchor IS NOT NULL").withColumnRenamed("key", key)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key and ``fingerprint`` of every whole text (null: empty). Equal texts have equal fingerprints."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return with_sketch(rows, "text", "sketch").select(F.col("key").alias(key), as_string(F.col("sketch")).alias("fingerprint"))


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they are to it and to the next document's.

    The edited text has its last quarter of code points replaced by the first as many of the next document by id (after
    the last: the first). Columns: the key, ``n_chars``, ``edited_text``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. Rows with the same id follow one another by text. A row without id has no next
    document: nothing is put in place of its last quarter and ``near_next`` is 0. A null text is an empty one.
    One row per row; other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = id_bounds(rows, "doc_id", "text", block_bytes)
    blocked = with_sketch(in_blocks(rows, bounds), "text", "sketch")
    order = Window.partitionBy("block").orderBy("doc_id", "text")
    led = blocked.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order))
    # The first document of a block follows the last of the block before; one row per block.
    heads = in_blocks(rows.where(F.col("doc_id").isin(bounds)), bounds).groupBy("block").agg(F.min(F.struct("doc_id", "text")).alias("head"))
    heads = heads.select(F.pmod(F.col("block") - 1, F.lit(max(1, len(bounds)))).alias("block"), F.col("head.text").alias("head_text"))
    heads = with_sketch(heads, "head_text", "head_sketch")
    full = led.join(heads, "block", "left").select(
        "doc_id",
        "text",
        "sketch",
        F.when(F.col("block") >= 0, F.coalesce("next_text", "head_text")).alias("next_text"),
        F.when(F.col("block") >= 0, F.coalesce("next_sketch", "head_sketch")).alias("next_sketch"),
        F.char_length("text").alias("n_chars"),
    )
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - cut), F.coalesce(F.substring("next_text", F.lit(1), cut), F.lit("")))
    out = with_sketch(full.withColumn("edited_text", edited), "edited_text", "edited_sketch")
    return out.select(
        F.col("doc_id").alias(key),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_text",
        as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        F.coalesce(likeness(F.col("sketch"), F.col("next_sketch")), F.lit(0.0)).alias("near_next"),
    )
