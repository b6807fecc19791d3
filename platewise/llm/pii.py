"""Personal data: candidate spans from generators, scored by boosted trees, in DataFrame functions only.

Generators propose spans of four kinds: the base patterns, and looser forms with high recall that may overlap them.
A base span that passes its check (parts of an address, Luhn digits, number of digits) is always a finding. A looser
one can be added if it passes its generator's check and overlaps no finding; what it is worth is learned.

Every candidate is described by its format and its neighbours. Labels come from evidence that the description does not
hold: whether a base span passed its check, whether a looser one overlaps a passed base span of its kind, and words
before it that name its kind (positive) or another number, such as an order's (negative). Other candidates have none.
Labelled candidates of all documents are counted by description, and the counts, a table bounded by the number of
descriptions, train gradient-boosted trees on the driver. Each generator has a threshold: the lowest score from which
98 % of its labelled candidates that could be added are positive. Without a negative one nothing speaks against them,
and all that can be added are.

Patterns are written without repeated groups, which recurse in Java: first replacements hide separators that cannot
continue a match behind characters of the same length, so that one character class follows. The work on a text grows
little faster than its length: positions are running sums in blocks, overlaps are found by bisection.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.stored import stored

# Kinds in the order of listing, and the base patterns' character classes.
KINDS = ["email", "ip", "card", "phone"]
_MARK, _MARK_2, _TAKEN = "\ufdd0", "\ufdd2", "\ufdd1"
_LOCAL = r"A-Za-z0-9._%+\x{FDD0}-"
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# Words before a span that name its kind, by kind, and words that name a number of another sort.
_CUES = ["mail|contact|write", "ip|host|server|addr|node", "card|visa|konto|carte|tarjeta|paid", "tel|phone|call|ring|fax|mobil|cell"]
_COUNTER = "order|invoice|isbn|issn|version|serial|ref|sku|part|ticket|case|account|id|no|nr"
PRECISION, TREES, RATE, CONTEXT = 0.98, 30, 0.3, 24
FEATURES = ["generator", "digits", "groups", "size", "separators", "luhn", "before", "after"]


class Generator(NamedTuple):
    """A kind's pattern; ``likely`` tells texts that may match, ``hide`` what is hidden before: pattern, mark, original."""

    kind: str
    base: bool
    likely: str
    pattern: str
    hide: tuple[tuple[str, str, str], ...] = ()


GENERATORS = [
    Generator("email", True, "@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++", ((r"\.(?![A-Za-z0-9-])", _MARK, "."),)),
    Generator("ip", True, r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    Generator("card", True, r"[0-9](?:[ -]?[0-9]){13}", r"[0-9][0-9 -]++", ((" (?![0-9])", _MARK, " "), ("-(?![0-9])", _MARK_2, "-"))),
    Generator("phone", True, r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
    Generator("email", False, r"[\[({](?:at|AT|@)[\])}]", r"[A-Za-z0-9._%+-]{1,64} ?[\[({](?:at|AT|@)[\])}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({](?:dot|DOT|\.)[\])}]) ?[A-Za-z0-9-]{1,63}){1,4}"),
    Generator("ip", False, "[0-9A-Fa-f]:[0-9A-Fa-f]", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    Generator("card", False, r"[0-9]{4}[._/][0-9]{4}[._/][0-9]{4}", r"(?<![0-9])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
    Generator("phone", False, r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", r"(?<![0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """0, then what ``step`` makes of 0 and the first value, the first two, ...; of a nonempty array of bigint.

    An array that grows is copied at every step, so blocks of the square root of the length are run each on their own.
    """
    zero = F.lit(0).cast("bigint")

    def run(part: Column, first: Column) -> Column:
        return F.aggregate(part, F.array(first), lambda acc, v: F.concat(acc, F.array(step(F.element_at(acc, -1), v))))

    def cut(v: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / size).cast("int")), lambda b: F.slice(v, b * size + 1, size))

    def joined(parts: Column) -> Column:
        heads = run(F.transform(parts, lambda p: F.aggregate(p, zero, step)), zero)
        return _let(heads, lambda h: F.concat(F.flatten(F.transform(parts, lambda p, i: F.slice(run(p, F.get(h, i)), F.lit(1), F.size(p)))), F.array(F.element_at(h, -1))))

    return _let(values, lambda v: _let(cut(v), joined))


def _sum(acc: Column, n: Column) -> Column:
    return acc + n


def _luhn(digits: Column) -> Column:
    def place(acc: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.when(F.char_length(digits).between(12, 19), F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), place) % 10 == 0).otherwise(False)


def _neighbour(c: Column) -> Column:
    """0 for nothing or white space, 1 for a letter or digit, 2 for anything else."""
    return F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"[\p{L}\p{N}]"), 1).otherwise(2)


def _word_before(left: Column, words: str) -> Column:
    return left.rlike(rf"(?i)\b(?:{words})[a-z]{{0,6}}[^A-Za-z]*$")


def _described(text: Column, number: int) -> Column:
    """Candidates of one generator: kind, place, whether a base span that passed, whether it may be added, evidence, features."""
    g = GENERATORS[number]
    source = F.translate(text, _MARK + _MARK_2, _TAKEN * 2) if g.hide else text
    for pattern, mark, _ in g.hide:
        source = F.regexp_replace(source, pattern, mark)

    def shown(part: Column) -> Column:
        return F.translate(part, "".join(m for _, m, _ in g.hide), "".join(o for _, _, o in g.hide)) if g.hide else part

    def length(part: Column) -> Column:
        return F.coalesce(F.char_length(part), F.lit(0)).cast("bigint")

    def spans(parts: Column) -> Column:
        gaps, matches = parts["gaps"], parts["matches"]
        lengths = F.flatten(F.zip_with(gaps, matches, lambda a, b: F.array(length(a), length(b))))

        def one(at: Column) -> Column:
            def span(match: Column, i: Column) -> Column:
                behind = F.concat(F.coalesce(F.get(gaps, i + 1), F.lit("")), F.coalesce(F.get(matches, i + 1), F.lit("")))
                before = F.concat(F.when(i > 0, F.substring(F.coalesce(F.get(matches, i - 1), F.lit("")), -CONTEXT, CONTEXT)).otherwise(F.lit("")), F.substring(F.get(gaps, i), -CONTEXT, CONTEXT))
                return F.struct(
                    F.get(at, 2 * i + 1).cast("int").alias("start"), F.get(at, 2 * i + 2).cast("int").alias("end"), shown(match).alias("value"),
                    shown(F.substring(before, -CONTEXT, CONTEXT)).alias("left"), shown(F.substring(behind, 1, 1)).alias("right"),
                )

            return F.transform(matches, span)

        return _let(_running(lengths, _sum), one)

    def describe(s: Column) -> Column:
        value = s["value"]
        digits = F.regexp_replace(value, "[^0-9]", "")
        luhn = _luhn(digits)
        if not g.base:
            passed = F.lit(False)
        elif g.kind == "ip":
            passed = value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
        elif g.kind == "card":
            passed = F.char_length(digits).between(14, 19) & luhn
        elif g.kind == "phone":
            passed = F.char_length(digits).between(10, 15)
        else:
            passed = F.lit(True)
        if g.base:
            valid = F.lit(False)  # one that failed is never added
        elif g.kind == "email":
            valid = value.rlike("[A-Za-z]{2}$")
        elif g.kind == "ip":  # groups of two at most are bytes of something else
            valid = value.rlike("[0-9A-Fa-f]{3}")
        elif g.kind == "card":
            valid = luhn
        else:  # area and exchange codes do not start with 0 or 1
            valid = digits.rlike("^[2-9][0-9]{2}[2-9]")
        # Evidence: 1 for, 0 against, null for none.
        if g.base:
            evidence = passed.cast("int")
        else:
            evidence = F.when(_word_before(s["left"], _CUES[KINDS.index(g.kind)]), 1).when(_word_before(s["left"], _COUNTER), 0)
        separators = F.size(F.array_distinct(F.split(F.regexp_replace(value, "[A-Za-z0-9]", ""), "")))
        features = [
            F.lit(number), F.least(F.char_length(digits), F.lit(20)), F.least(F.size(F.split(value, "[^0-9]++")), F.lit(8)),
            F.least(F.floor(F.char_length(value) / 4).cast("int"), F.lit(12)), F.least(separators, F.lit(5)), luhn.cast("int"),
            _neighbour(F.substring(s["left"], -1, 1)), _neighbour(s["right"]),
        ]
        return F.struct(
            F.lit(KINDS.index(g.kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), passed.alias("passed"), valid.alias("valid"),
            evidence.cast("int").alias("evidence"), *[f.cast("int").alias(n) for f, n in zip(features, FEATURES)],
        )

    found = _let(F.struct(F.split(source, g.pattern).alias("gaps"), F.regexp_extract_all(source, F.lit(g.pattern), F.lit(0)).alias("matches")), spans)
    empty = F.array().cast("array<struct<kind:int,start:int,end:int,passed:boolean,valid:boolean,evidence:int," + ",".join(f"{n}:int" for n in FEATURES) + ">>")
    likely = F.contains(text, F.lit("@")) if g.likely == "@" else text.rlike(g.likely)
    return F.when(likely, F.transform(found, describe)).otherwise(empty)


def _overlapped(c: Column, spans: Column) -> Column:
    """Whether a span overlaps one of an array of disjoint ones in order: the first that ends behind its start, by bisection."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))

    def halve(range_: Column, _: Column) -> Column:
        low, high = range_["low"], range_["high"]
        middle = F.shiftright(low + high, 1)
        behind = F.get(spans, middle)["end"] > c["start"]
        return F.struct(
            F.when((low < high) & ~behind, middle + 1).otherwise(low).alias("low"), F.when((low < high) & behind, middle).otherwise(high).alias("high")
        )

    first = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")), halve, lambda r: F.get(spans, r["low"]))
    return (F.size(spans) > 0) & F.coalesce(first["start"] < c["end"], F.lit(False))


def _judged(c: Column, passed: Column) -> Column:
    """A candidate with ``label`` (1, 0 or null) and ``open`` (it can be added); ``passed``: arrays of findings by kind."""
    over = [_overlapped(c, passed[k]) for k in KINDS]
    taken = c["passed"]
    for o in over:
        taken = taken | o
    same = F.lit(False)
    for i, o in enumerate(over):
        same = same | ((c["kind"] == i) & o)
    open_ = c["valid"] & ~taken
    # A looser span that overlaps a finding of its kind is one; other evidence counts for those that can be added.
    label = F.when(c["generator"] < len(KINDS), c["evidence"]).when(same, 1).when(open_, c["evidence"])
    fields = ["kind", "start", "end", "passed", *FEATURES]
    return F.struct(*[c[f].alias(f) for f in fields], label.cast("int").alias("label"), open_.alias("open"))


def candidates(rows: DataFrame, text: Column) -> DataFrame:
    """The rows with ``candidates``: all generators' spans with kind, place, features, label, and whether they can be added."""
    columns = rows.columns
    found = rows.withColumns({f"_c{i}": _described(F.coalesce(text, F.lit("")), i) for i in range(len(GENERATORS))})
    places = {
        k: F.transform(F.filter(f"_c{i}", lambda c: c["passed"]), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))) for i, k in enumerate(KINDS)
    }
    found = found.withColumn("_passed", F.struct(*[p.alias(k) for k, p in places.items()])).withColumn("_all", F.concat(*[f"_c{i}" for i in range(len(GENERATORS))]))
    empty = F.array().cast("array<struct<kind:int,start:int,end:int,passed:boolean," + ",".join(f"{n}:int" for n in FEATURES) + ",label:int,open:boolean>>")
    # Staged by a condition that reads the candidates as well, so that Spark does not compute them anew for each one.
    judged = _let(F.struct("_passed", "_all"), lambda s: F.transform(s["_all"], lambda c: _judged(c, s["_passed"])))
    return found.withColumn("candidates", F.when(F.size("_all") > 0, judged).otherwise(empty)).select(*columns, "candidates")


class Model(NamedTuple):
    """Trees as (feature, cut, then feature, cut and two leaves on either side), and a threshold per generator."""

    prior: float
    trees: list[tuple]
    thresholds: list[float]

    def margin(self, c: Column) -> Column:
        out = F.lit(self.prior)
        for feature, cut, *sides in self.trees:
            left, right = (F.when(c[f] <= v, a).otherwise(b) for f, v, a, b in sides)
            out = out + F.when(c[feature] <= cut, left).otherwise(right)
        return out


def _stump(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int, float, float]:
    """Gain, feature, cut and leaf values of the best cut of weighted rows."""
    def value(a: float, b: float) -> float:
        return -a / (b + 1.0)

    best = (0.0, 0, int(x[:, 0].max()) if len(x) else 0, value(g.sum(), h.sum()), 0.0)
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(x.shape[1]):
        size = int(x[:, f].max()) + 1 if len(x) else 0
        a, b = np.cumsum(np.bincount(x[:, f], g, size)), np.cumsum(np.bincount(x[:, f], h, size))
        gains = a**2 / (b + 1.0) + (g.sum() - a) ** 2 / (h.sum() - b + 1.0) - whole
        if size and gains.max() > best[0] + 1e-9:
            cut = int(gains.argmax())
            best = (float(gains[cut]), f, cut, value(a[cut], b[cut]), value(g.sum() - a[cut], h.sum() - b[cut]))
    return best


def fit(x: np.ndarray, generators: np.ndarray, positive: np.ndarray, total: np.ndarray, free: np.ndarray) -> Model:
    """Boost trees of two levels on counted descriptions; thresholds reach ``PRECISION``, by generator.

    ``free``: how many positive ones, and how many in all, could be added; thresholds are taken over these. A
    generator without a negative one among them has the threshold minus infinity, one that never reaches the
    precision plus infinity.
    """
    rate = (positive.sum() + 0.5) / (total.sum() + 1)
    prior = float(np.log(rate / (1 - rate)))
    margin, trees = np.full(len(x), prior), []
    for _ in range(TREES if len(x) else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = total * p - positive, total * p * (1 - p)
        _, feature, cut, _, _ = _stump(x, g, h)
        low = x[:, feature] <= cut
        sides = []
        step = np.zeros(len(x))
        for part in (low, ~low):
            _, f, v, a, b = _stump(x[part], g[part], h[part])
            sides.append((FEATURES[f], v, RATE * a, RATE * b))
            step[part] = np.where(x[part, f] <= v, RATE * a, RATE * b)
        trees.append((FEATURES[feature], cut, *sides))
        margin += step
    thresholds = []
    for number in range(len(GENERATORS)):
        own = np.flatnonzero((generators == number) & (free[:, 1] > 0))
        if free[own, 0].sum() == free[own, 1].sum():
            thresholds.append(float("-inf"))
            continue
        own = own[np.argsort(-margin[own], kind="stable")]
        good = np.cumsum(free[own, 0]) / np.cumsum(free[own, 1])
        enough = np.flatnonzero((good >= PRECISION) & np.append(np.diff(margin[own]) != 0, True))
        thresholds.append(float(margin[own][enough[-1]]) - 1e-9 if len(enough) else float("inf"))
    return Model(prior, trees, thresholds)


def train(found: DataFrame) -> Model:
    """Fit on the labelled candidates of all documents, counted by description: the driver gets one row per description."""
    rows = found.where(F.size("candidates") > 0).select(F.explode("candidates").alias("c")).select("c.*").where("label IS NOT NULL")
    open_ = F.col("open").cast("int")
    counts = [F.sum("label").alias("positive"), F.count("*").alias("total"), F.sum(F.col("label") * open_).alias("added"), F.sum(open_).alias("open")]
    counted = rows.groupBy(*FEATURES).agg(*counts).orderBy(*FEATURES).collect()
    x = np.array([[r[n] for n in FEATURES] for r in counted], dtype=np.int64).reshape(-1, len(FEATURES))
    column = lambda n: np.array([r[n] for r in counted], dtype=float)
    return fit(x, x[:, 0], column("positive"), column("total"), np.stack([column("added"), column("open")], axis=1))


def selected(model: Model) -> Column:
    """Spans to redact among ``candidates``: base ones, and added ones that overlap none of them; by start, then kind."""
    limits = F.array(*[F.lit(t) for t in model.thresholds])
    return _ordered(F.filter("candidates", lambda c: c["passed"] | (c["open"] & (model.margin(c) >= F.get(limits, c["generator"])))))


def _ordered(spans: Column) -> Column:
    """Start, kind and end in order, repeats left out."""
    order = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
    return _let(order, lambda all_: F.filter(all_, lambda s, i: (i == 0) | (s != F.get(all_, i - 1))))


def span_list(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    """Number of spans of one kind."""
    number = KINDS.index(kind)  # not an argument of the lambda: a second one is given the place in the array
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key, ``base`` and ``spans`` (arrays of start, kind, end): base spans, and base and added ones.

    Whole texts; a null text is empty and has no spans. Positions are code points, the end exclusive. One row per row,
    repeated rows included; other columns are not read. The key may be null. An empty table gives an empty table.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = stored(candidates(rows, F.col("text")).select("key", "candidates"), "pii-candidates")
    model = train(found)
    base = _ordered(F.filter("candidates", lambda c: c["passed"]))
    return found.select(F.col("key").alias(key), base.alias("base"), selected(model).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first.

    ``spans``: not empty, by start. Texts with many spans are cut at the square root of their number of places first,
    as taking a part of a string reads all that stands before it.
    """
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def blocks(v: Column) -> Column:
        spans_, done, n = v["spans"], v["done"], F.size(v["spans"])
        size = F.ceil(F.sqrt(n)).cast("int")

        def block(b: Column) -> Column:
            first = F.get(done, b * size)
            last = F.when((b + 1) * size < n, F.get(done, (b + 1) * size)).otherwise(F.get(done, n))

            def piece(part: Column) -> Column:
                def one(s: Column, i: Column) -> Column:
                    # Text between the end of all earlier spans and this one, then its label; nothing for a span inside another.
                    after = F.get(done, b * size + i)
                    gap = F.substring(part, (after - first + 1).cast("int"), F.greatest(s["start"] - after, F.lit(0)).cast("int"))
                    return F.concat(gap, F.when(s["start"] >= after, F.get(kinds, s["kind"])).otherwise(F.lit("")))

                return F.array_join(F.transform(F.slice(spans_, b * size + 1, size), one), "")

            return _let(F.substring(text, (first + 1).cast("int"), (last - first).cast("int")), piece)

        tail = F.substring(text, (F.get(done, n) + 1).cast("int"), F.char_length(text))
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), block), ""), tail)

    def with_ends(s: Column) -> Column:
        ends = _running(F.transform(s, lambda x: x["end"].cast("bigint")), lambda a, b: F.greatest(a, b))
        return _let(F.struct(s.alias("spans"), ends.alias("done")), blocks)

    return _let(spans, with_ends)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The table with each span of the text replaced by its kind in brackets; overlapping spans become one.

    Rows and columns are those of the table, whatever the columns' names; a null text stays null, one without spans
    as it is. The rows are stored with their candidates, so that these are found once.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    body = F.col("row").getField(text)
    found = stored(candidates(rows, body), "pii-candidates")
    model = train(found.select("candidates"))
    marked = found.select("row", selected(model).alias("spans"))
    changed = F.when(F.size("spans") > 0, masked(body, F.col("spans"))).otherwise(body)
    return marked.select(*[(changed if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
