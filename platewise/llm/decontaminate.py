"""Benchmark decontamination by templates, in DataFrame functions only.

Texts are brought to templates: numbers, units after numbers, and names (capitalised words within a sentence) become
typed placeholders, the rest is lowered and split at everything but letters and digits. Windows of template tokens are
joined by hash between the benchmark and the documents, so that a question whose values were changed still matches.
Where windows hold placeholders, the values are compared. Windows with the same values count; over all others of one
alignment (an item laid at one place of a document), each value of the item has to stand for one value of the document,
or none of that alignment counts. A number is one placeholder with its separators and decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, LITERALS, LEAST_WINDOWS = 8, 5, 2
# Benchmark windows that may be broadcast; above that the join is a shuffle.
BROADCAST_WINDOWS = 500_000
_NUMBER, _NAME, _UNIT = "\x02", "\x03", "\x04"
# Units that are placeholders after a number.
_UNITS = "km|cm|mm|m|kg|mg|g|lbs|lb|oz|miles|mile|feet|foot|inches|inch|hours|hour|minutes|minute|seconds|second|days|day|weeks|week|years|year|percent|dollars|dollar|euros|euro|cents|cent|liters|liter|litres|litre|ml|l|mph|kmh"
_LOW, _HIGH = "a-zß-ÿ", "A-ZÀ-Þ"
_POINT = "\ufdd0"  # stands for the decimal point, which would split
_SPLIT = r"[\x00-\x01\x05-/:-@\[-`{-\x7f]+"


def template_tokens(text: Column) -> Column:
    """Lowered tokens; one with a value starts with (or holds) the mark of its type."""
    grouped = F.regexp_replace(F.translate(text, _POINT, " "), "(?<=[0-9]),(?=[0-9]{3}(?![0-9]))", "")
    whole = F.regexp_replace(grouped, "(?<=[0-9])[.,](?=[0-9])", _POINT)
    marked = F.when(
        text.rlike("[0-9]"),
        F.regexp_replace(F.regexp_replace(whole, f"([0-9]+)( ?)({_UNITS})(?![{_LOW}{_HIGH}0-9])", f"$1$2{_UNIT}$3"), f"[0-9][0-9{_POINT}]*+", f"{_NUMBER}$0"),
    ).otherwise(text)
    named = F.regexp_replace(marked, f"(?<=[{_LOW},;] )[{_HIGH}][{_LOW}]+", f"{_NAME}$0")
    return F.filter(F.split(F.lower(named), _SPLIT), lambda t: t != "")


def _type(token: Column) -> Column:
    """The token with its value taken out; a token without a value is its own type."""
    typed = F.when(F.contains(token, F.lit(_NUMBER)), F.translate(token, "0123456789" + _POINT, ""))
    return typed.when(F.contains(token, F.lit(_NAME)), _NAME).when(F.contains(token, F.lit(_UNIT)), _UNIT).otherwise(token)


def _has_mark(token: Column) -> Column:
    return token.rlike(f"[{_NUMBER}{_NAME}{_UNIT}]")


def _literal(token: Column) -> Column:
    return ~_has_mark(token) | (F.char_length(_type(token)) > 1)


def window_hashes(tokens: Column) -> Column:
    """Hash of the types in each window of ``WINDOW`` tokens."""
    def run(h: Column) -> Column:
        return F.when(
            F.size(h) >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>"))

    return run(tokens)


def _with_windows(rows: DataFrame) -> DataFrame:
    """Adds ``tokens``, then ``windows``; each step is a column of its own, so that it is computed once."""
    hashed = rows.withColumn("tokens", template_tokens(F.col("text"))).withColumn("hashes", F.transform("tokens", lambda t: F.xxhash64(_type(t))))
    return hashed.withColumn("windows", window_hashes(F.col("hashes"))).drop("hashes")


def _values(tokens: Column, start: Column) -> Column:
    """Values of a window's placeholders, in order: the digits and point of a number, else the token."""
    marked = F.filter(F.slice(tokens, start + 1, WINDOW), _has_mark)
    return F.transform(marked, lambda t: F.when(F.contains(t, F.lit(_NUMBER)), F.regexp_replace(t, f"[^0-9{_POINT}]", "")).otherwise(t))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Columns: the key, the item, ``n_windows`` (matching places of the item), ``n_values`` (values compared).

    One row for each document and item that share two consecutive template windows, or the only one the item has.
    Windows with fewer than five tokens that are not placeholders are not used; items of fewer than eight tokens have
    none. Null texts have no tokens; rows without key or item are not searched. Rows with the same id count as one
    document. Empty tables give no rows. Other columns are not read.
    """
    items = benchmark.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    known = (
        _with_windows(items)
        .select("item", "tokens", F.posexplode_outer("windows").alias("at", "window"))
        .where("window IS NOT NULL")
        .where(F.size(F.filter(F.slice("tokens", F.col("at") + 1, WINDOW), _literal)) >= LITERALS)
        .select("item", "at", "window", _values(F.col("tokens"), F.col("at")).alias("item_values"))
        .dropDuplicates(["item", "at", "window"])
    )
    sizes = known.groupBy("item").agg(F.count_distinct("window").alias("n_item"))
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The outer form: for the plain one Spark pushes a test of the whole expression below the steps that stage it.
    windows = _with_windows(rows).select("doc", F.posexplode_outer("windows").alias("place", "window"))
    wanted = known.select("window", "item", "at", "item_values")
    if known.count() <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    hits = windows.join(wanted, "window")
    plain = hits.where(F.size("item_values") == 0).select("doc", "item", "window", F.lit(0).alias("n_values"))
    slotted = hits.where(F.size("item_values") > 0).select("doc", "item", "window", "place", (F.col("place") - F.col("at")).alias("shift"), "item_values")
    # Values of the document: looked up again for the documents that matched with placeholders only.
    again = rows.join(slotted, "doc").withColumn("tokens", template_tokens(F.col("text")))
    valued = again.select("doc", "item", "shift", "window", "item_values", _values(F.col("tokens"), F.col("place")).alias("doc_values"))
    pairs = valued.select(
        "doc", "item", "shift", "window", (F.col("item_values") == F.col("doc_values")).alias("same"), F.explode_outer(F.arrays_zip("item_values", "doc_values")).alias("p")
    ).select("doc", "item", "shift", "window", "same", F.col("p.item_values").alias("a"), F.col("p.doc_values").alias("b"))
    steady = pairs.where(~F.col("same")).groupBy("doc", "item", "shift", "a").agg(F.count_distinct("b").alias("kinds"))
    broken = steady.where("kinds > 1").select("doc", "item", "shift", F.lit(True).alias("broken")).distinct()
    sound = pairs.join(broken, ["doc", "item", "shift"], "left").where(F.col("same") | F.col("broken").isNull())
    sound = sound.groupBy("doc", "item", "window").agg(F.count_distinct("a").cast("int").alias("n_values"))
    found = plain.unionByName(sound).groupBy("doc", "item").agg(F.count_distinct("window").alias("n_windows"), F.sum("n_values").alias("n_values"))
    enough = found.join(sizes, "item").where(F.col("n_windows") >= F.least(F.col("n_item"), F.lit(LEAST_WINDOWS)))
    return enough.select(F.col("doc").alias(key), F.col("item").alias(item), "n_windows", "n_values")
