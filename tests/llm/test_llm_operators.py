"""The numbered operators against brute force on small tables with awkward rows."""

import base64
import hashlib
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from platewise.llm import bpe, decontaminate, lm_score, neardup, pii, quality, substring, syncmers, toxicity, url_rules
from platewise.llm.text import words_of

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau ypsilon phi chi psi omega".split()
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{k}" for i, k in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 90, n)))


def awkward() -> list[tuple]:
    """Rows of id, text and columns whose names the operators use themselves."""
    base = prose(1, 60)
    return [
        (1, base), (2, base), (3, base.replace("alpha", "ALPHA") + " extra"), (4, None), (5, ""), (6, " \t\n"),
        (7, "one two three"), (8, "ONE two three"), (9, prose(2, 40) + "  " + base[:200] + "\u00a0x"), (10, prose(3, 4000)),
        (11, "word " * 3000), (12, "x" * 50_000), (None, base), (13, "ungew\u00f6hnlich \U0001f600 \u4e2d\u6587 " + prose(4, 30)),
        (14, prose(5, 30) + "\x0b" + prose(3, 300)), (14, prose(5, 30) + "\x0b" + prose(3, 300)), (15, base + " " + base),
    ]


SCHEMA = "doc_id long, text string, block int, ids string, score string, key int, node long, n_words string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "a", "b", 2, 3, "c") for i, t in awkward()], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def sort(rows):
    return sorted(rows, key=repr)


# --- 1 ---------------------------------------------------------------------------------------------
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_reference_encoder_and_round_trips(docs):
    want = []
    for i, text in awkward():
        ids = encoding().encode_ordinary(text or "")
        want.append((i, bytearray(struct.pack(f"<{len(ids)}I", *ids)), len(ids), bytearray((text or "").encode())))
    assert sort(rows_of(bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN))) == sort(want)


def test_bpe_tokens_of_the_vocabulary_keep_their_ids(spark):
    tokens = bpe.read_ranks(spark, RANKS)
    encoder = bpe.Encoder(bpe.serialise_model(tokens), tokens, public_tokenizers.PATTERN)
    for text in ["<|endoftext|>", "'s 't", "  leading", "\u0130\u0307", "\x00\x01", "a" * 3000]:
        assert encoder.encode(text) == struct.pack(f"<{len(x := encoding().encode_ordinary(text))}I", *x)


def test_bpe_empty_table(none):
    assert rows_of(bpe.round_trip(none, RANKS, public_tokenizers.PATTERN)) == []


def thue_morse(n):
    """A word of n letters, and the one with its letters exchanged: equal under a polynomial hash modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_without_shared_hashes():
    one, other = thue_morse(1024)
    hashes = words_of([f"{one} {other} {one[:-1]} {one} ab ba".encode()]).hashes.tolist()
    assert hashes[0] == hashes[3] and len(set(hashes)) == 5


# --- 2 ---------------------------------------------------------------------------------------------
def brute_repeats(rows, window=13):
    words = [SPACE.findall(t or "") for _, t in rows]
    least = {}
    for (i, _), ws in zip(rows, words):
        if i is not None:
            for j in range(len(ws) - window + 1):
                w = tuple(ws[j : j + window])
                least[w] = min(least.get(w, i), i)
    out = []
    for (i, _), ws in zip(rows, words):
        gone = set()
        if i is not None:
            for j in range(len(ws) - window + 1):
                if least[tuple(ws[j : j + window])] < i:
                    gone.update(range(j, j + window))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return out


@pytest.mark.parametrize("block_bytes", [2000, 1 << 22])
def test_repeats_equal_brute_force(docs, block_bytes):
    got = rows_of(substring.remove_repeats(docs, block_bytes=block_bytes))
    assert sort(got) == sort(brute_repeats(awkward()))


def test_repeats_shared_passages_over_many_blocks(spark):
    shared = [prose(100 + k, 70) for k in range(4)]
    rng = np.random.default_rng(5)
    rows = [(int(i) * 7, f"{prose(i, 20)} {shared[rng.integers(4)]} {prose(500 + i, 15)} {shared[rng.integers(4)][:150]}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sort(rows_of(substring.remove_repeats(df, block_bytes=5000))) == sort(brute_repeats(rows))


def test_repeats_of_long_words_that_differ(spark):
    rows = [(i, " ".join([prose(i, 6), *[w] * 13])) for i, w in enumerate(thue_morse(1024))]
    assert sort(rows_of(substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))) == sort(brute_repeats(rows))


def test_repeats_empty_table(none):
    assert rows_of(substring.remove_repeats(none)) == []


# --- 3 ---------------------------------------------------------------------------------------------
def shingles(text):
    ws = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    top = {i: i for i, _ in sets if i is not None}
    changed = True
    links = [
        (a, b) for x, (a, s) in enumerate(sets) for b, t in sets[:x]
        if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t)
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(top[a], top[b])
            changed |= top[a] != low or top[b] != low
            top[a] = top[b] = low
    return [(i, len(s), top.get(i), i == top.get(i)) for i, s in sets]


def test_near_duplicates_equal_brute_force(docs):
    assert sort(rows_of(neardup.near_duplicates(docs))) == sort(brute_components(awkward()))


def test_near_duplicates_chains_and_families(spark):
    rng = np.random.default_rng(3)
    rows = []
    for family in range(12):
        words = prose(900 + family, 120).split()
        for _ in range(8):
            words = list(words)
            for _ in range(int(rng.integers(0, 6))):  # a chain: each copy differs a little from the last
                words[int(rng.integers(len(words)))] = f"new{rng.integers(10**9)}"
            rows.append((len(rows) * 3, " ".join(words)))
    rng.shuffle(rows)
    df = spark.createDataFrame([(int(i), t) for i, t in rows], "doc_id long, text string")
    assert sort(rows_of(neardup.near_duplicates(df))) == sort(brute_components(rows and [(int(i), t) for i, t in rows]))


def test_index_finds_every_pair_within_the_first_distance():
    rng = np.random.default_rng(8)
    a = rng.integers(0, 1 << 16, (200, neardup.PLACES)).astype("<u2")
    b = a.copy()
    for row in b:  # 31 changed places, wherever they fall
        row[rng.choice(neardup.INDEXED, 31, replace=False)] ^= 1
    shared = [len(set(x) & set(y)) for x, y in zip(neardup._index_keys(a).tolist(), neardup._index_keys(b).tolist())]
    assert min(shared) > 0


def test_families_are_joined_as_by_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = prose(77, 150).split()
    rows = []
    for i in range(60):  # likenesses around the threshold
        words = list(base)
        for k in rng.choice(len(words), int(rng.integers(0, 5)), replace=False):
            words[k] = f"new{rng.integers(10**9)}"
        rows.append((i, " ".join(words)))
    hashes, first = neardup._sets([t.encode() for _, t in rows])
    marks = neardup._signatures(hashes, first)
    sets = [hashes[first[i] : first[i + 1]] for i in range(60)]
    comp = [i % 7 for i in range(60)]
    monkeypatch.setattr(neardup, "_PART", 9)  # many parts
    df = spark.createDataFrame(
        [(1, i, comp[i], len(sets[i]), bytearray(marks[i].tobytes()), bytearray(sets[i].tobytes()), 60) for i in range(60)],
        "family long, node long, c long, n_shingles long, signature binary, shingles binary, n long",
    )

    def classes(links):
        top = list(comp)
        for a, b in links:
            low, high = sorted((top[a], top[b]))
            top = [low if t == high else t for t in top]
        return top

    want = [(i, j) for i in range(60) for j in range(i) if neardup._linked(sets[i], sets[j])]
    got = [tuple(r) for r in neardup.join_families(df).collect()]
    assert 0 < len(want) < 60 * 59 / 2 and {tuple(sorted(x)) for x in got} <= {tuple(sorted(x)) for x in want}
    assert classes(got) == classes(want)


def test_a_table_of_a_large_family_holds_two_parts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_PART", 50)
    sizes = {1: 1000, 2: 30, 3: 20}
    rows = spark.createDataFrame([(f, 10_000 * f + i, n) for f, n in sizes.items() for i in range(n)], "family long, node long, n long")
    dealt = [r.asDict() for r in neardup._deal(rows).collect()]
    tables = {}
    for r in dealt:
        tables.setdefault(tuple(r[k] for k in neardup._TABLE), []).append(r)
    assert max(map(len, tables.values())) < 4 * 50 < 1000
    for f, n in sizes.items():  # every two classes meet
        met = {(a["node"], b["node"]) for t in tables.values() for a in t if a["family"] == f for b in t if b["family"] == f and (a["low"], a["high"]) == (b["low"], b["high"])}
        assert len(met) == n * n


def test_near_duplicates_empty_table(none):
    assert rows_of(neardup.near_duplicates(none)) == []


# --- 4, 5 ------------------------------------------------------------------------------------------
def labelled(spark):
    rng = np.random.default_rng(2)
    insults = ["blockhead", "nitwit", "dimwit", "halfwit"]
    texts, toxic, good = [], [], []
    for i in range(400):
        words = prose(3000 + i, 60).split()
        toxic.append(int(i % 4 == 0))
        good.append(int(i % 5 != 0))
        if toxic[-1]:
            for _ in range(4):
                words.insert(int(rng.integers(len(words))), insults[int(rng.integers(4))])
        if not good[-1]:
            words = [w.upper() + "!!" for w in words]
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    labels = spark.createDataFrame(list(zip(range(400), toxic, good)) + [(None, 1, 1), (9999, None, None)], "doc_id long, toxic int, quality int")
    return docs, labels, np.array(toxic), np.array(good)


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_classifiers_on_held_out_documents(spark, name):
    docs, labels, toxic, good = labelled(spark)
    module, truth = (toxicity, toxic) if name == "toxic" else (quality, good)
    model = module.train(docs, labels.where("doc_id % 3 <> 1 OR doc_id IS NULL"), label=name)
    scores = dict(rows_of(module.score(docs, model)))
    held = [i for i in range(400) if i % 3 == 1]
    assert np.mean([(scores[i] >= 0.7) == truth[i] for i in held]) > 0.95
    assert all(0 <= s <= 1 for s in scores.values())


def test_toxicity_shares_vectors_with_unseen_spellings(spark):
    docs, labels, *_ = labelled(spark)
    scorer = toxicity.Scorer(toxicity.train(docs, labels, label="toxic"))
    clean = prose(77, 40)
    assert scorer.score(clean + " blockheads") > scorer.score(clean)


def test_toxicity_learns_from_passages_of_long_texts(spark, monkeypatch):
    docs, labels, toxic, _ = labelled(spark)
    monkeypatch.setattr(toxicity, "EXCERPT", 1600)
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 60_000)
    longer = F.when(F.col("doc_id") % 4 == 0, F.repeat(F.concat("text", F.lit(" ")), 100)).otherwise(F.col("text"))
    longer = docs.withColumn("text", longer)
    sample = toxicity.training_sample(longer, labels).groupBy("y").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()
    assert {r.y for r in sample} == {0, 1} and all(r.n > 20 and r.size <= 60_000 for r in sample)
    scorer = toxicity.Scorer(toxicity.train(longer, labels))
    assert scorer.score(prose(77, 40) + " blockhead nitwit dimwit") > 0.7 > 0.3 > scorer.score(prose(77, 40))


def test_toxicity_sample_has_each_id_once(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)] * 20 + [(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    got = toxicity.training_sample(docs, labels).collect()
    assert sorted((r.doc_id, r.y) for r in got) == [(1, 1), (2, 0)]


def test_classifiers_on_awkward_rows(docs, none, spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 15)], "doc_id long, toxic int, quality int")
    for module, name in ((toxicity, "toxic"), (quality, "quality")):
        for taught in (labels, labels.where("false")):
            got = rows_of(module.score(docs, module.train(docs, taught, label=name)))
            assert len(got) == len(awkward()) and all(0 <= s <= 1 for _, s in got)
        assert rows_of(module.score(none, module.train(none, labels, label=name))) == []
    kept = toxicity.keep_clean(docs, toxicity.train(docs, labels, label="toxic"), 2.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (2, 7) in model.pairs
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.85  # main effects alone: a half


# --- 6 ---------------------------------------------------------------------------------------------
def test_syncmers_choose_runs_whose_least_word_is_at_an_edge(spark):
    text = prose(6, 50)
    row = spark.createDataFrame([(1, text)], "doc_id long, text string").select(syncmers.word_hashes(syncmers.F.col("text")).alias("h")).first()
    want = {i for i in range(46) if min(row.h[i : i + 5]) in (row.h[i], row.h[i + 4])}
    got = syncmers.anchors(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert {r.position for r in got.collect()} == want


@pytest.mark.parametrize("block_bytes", [3000, 1 << 22])
def test_edited_texts_and_fingerprints(docs, block_bytes):
    got = syncmers.edited_likeness(docs, block_bytes=block_bytes).collect()
    order = sorted([(i, t or "") for i, t in awkward() if i is not None])
    want = []
    for k, (i, t) in enumerate(order):
        cut = len(t) // 4
        want.append((i, len(t), t[: len(t) - cut] + order[(k + 1) % len(order)][1][:cut]))
    base = awkward()[0][1]
    want.append((None, len(base), base[: len(base) - len(base) // 4]))
    assert sort([(r.doc_id, r.n_chars, r.edited_text) for r in got]) == sort(want)
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert prints[1].fingerprint == prints[2].fingerprint and prints[1].near_next == 1
    assert prints[10].near_edited > 0.4 and prints[10].near_next < 0.1
    assert prints[4].fingerprint == prints[6].fingerprint == ""


def test_fingerprints_empty_table(none):
    assert rows_of(syncmers.edited_likeness(none)) == []


# --- 7 ---------------------------------------------------------------------------------------------
def test_leaks_verbatim_and_with_other_values(spark):
    item = "A train leaves with 120 passengers and drops 30 of them at every stop until 0 remain so how many stops are needed"
    other = item.replace("120", "360").replace("30", "90")
    uneven = "first 7 words are fine here and then 7 again comes with more"
    broken = uneven.replace("7", "8", 1).replace("7", "9")
    rows = [
        (1, prose(1, 30) + " " + item + " " + prose(2, 20)), (2, other), (3, prose(3, 200)), (4, None), (5, ""), (6, "Intro. " + uneven), (7, broken), (9, uneven.replace("7", "55")),
        (None, item), (8, item.upper()), (2, other),
    ]
    docs = spark.createDataFrame([(i, t, "z", "q") for i, t in rows], "doc_id long, text string, item string, window string")
    items = spark.createDataFrame([(1, item), (2, uneven), (3, None), (4, "too short"), (None, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (6, 2), (8, 1), (9, 2)}


def test_leaks_of_a_question_held_twice_and_of_whole_numbers(spark):
    item = "A farmer packs 350 apples into 14 boxes and sells 20 of them so what is left of the 350 at night"
    variants = [item.replace("350", n).replace("14", "9").replace("20", m) for n, m in (("700", "40"), ("1,200", "3.5"))]
    docs = spark.createDataFrame([(1, " ".join(variants)), (2, variants[1]), (3, variants[0]), (4, prose(9, 60))], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.n_windows for r in decontaminate.find_leaks(docs, items).collect()}
    assert set(got) == {1, 2, 3} and got[1] >= got[2] == got[3]


def test_leaks_equal_brute_force_on_plain_text(spark):
    items = [(k, prose(40 + k, 20 + k)) for k in range(8)]
    rows = [(i, prose(200 + i, 30) + " " + items[i % 8][1][: 40 + 13 * i] + " " + prose(300 + i, 10)) for i in range(24)]

    def windows(t):
        ws = t.split()
        return {tuple(ws[j : j + 8]) for j in range(len(ws) - 7)}

    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    plain = [(i, re.sub(r"[0-9]+", "9", t)) for i, t in rows]
    want = {(i, k) for i, t in plain for k, b in items if len(windows(t) & windows(re.sub(r"[0-9]+", "9", b))) >= 2}
    assert got <= want and {(i, i % 8) for i in range(24) if len(windows(rows[i][1]) & windows(items[i % 8][1])) >= 3} <= got


def test_leaks_empty_tables(spark, none):
    items = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    assert rows_of(decontaminate.find_leaks(none, items)) == []
    assert rows_of(decontaminate.find_leaks(none.unionByName(none), items.where("false"))) == []


# --- 8 ---------------------------------------------------------------------------------------------
def brute_losses(rows, target):
    """The two models from plain counts, the document's own taken out."""
    from collections import Counter

    lower = [(i, SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t in rows]
    corpus = Counter(w for _, ws in lower for w in ws)
    known = {w for w, n in corpus.items() if n >= lm_score.LEAST_COUNT}
    events = [(i, [w if w in known else "<unk>" for w in ws] + ["</s>"]) for i, ws in lower]

    def model(part):
        single, pair = Counter(), Counter()
        for _, ws in part:
            single.update(ws)
            single["<s>"] += 1
            pair.update(zip(["<s>", *ws], ws))
        return single, pair, sum(len(ws) for _, ws in part)

    models = {"t": model([e for e in events if e[0] in target]), "b": model(events)}
    size, out = len(known) + 2, []
    for i, ws in events:
        own_pair, own = Counter(zip(["<s>", *ws], ws)), Counter(ws)
        own["<s>"] += 1
        losses = []
        for name in ("t", "b"):
            single, pair, total = models[name]
            inside = name == "b" or i in target
            loss = 0.0
            for v, w in zip(["<s>", *ws], ws):
                p = (single[w] - inside * own[w] + lm_score.WORD_WEIGHT) / (total - inside * len(ws) + lm_score.WORD_WEIGHT * size)
                loss -= np.log((pair[v, w] - inside * own_pair[v, w] + lm_score.PAIR_WEIGHT * p) / (single[v] - inside * own[v] + lm_score.PAIR_WEIGHT))
            losses.append(loss / len(ws))
        out.append((i, len(ws), *losses))
    return out


@pytest.mark.parametrize("block_bytes", [3000, 1 << 22])
def test_losses_equal_brute_force(docs, spark, block_bytes):
    target = spark.createDataFrame([(1,), (7,), (10,), (10,), (None,), (999,)], "doc_id long")
    got = sort([tuple(r)[:4] for r in lm_score.score(docs, target, block_bytes=block_bytes).collect()])
    want = sort(brute_losses(awkward(), {1, 7, 10}))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in got], [r[2:] for r in want])


def test_losses_empty_tables(docs, none, spark):
    nothing = spark.createDataFrame([], "doc_id long")
    assert rows_of(lm_score.score(none, nothing)) == []
    assert lm_score.score(docs, nothing).count() == len(awkward())


# --- 9 ---------------------------------------------------------------------------------------------
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def brute_spans(text):
    return sorted(
        (m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if passes(kind, m.group())
    )


PII = [
    (1, "write to a.b@c.de_f@g.hi now, or x@a@b.co.uk. and a..b@x.y..z"), (2, "hosts 1.2.3.4.5.6.7.8 and 300.1.1.1 and 001.02.3.255"),
    (3, "card 4111 1111-1111 1111, 4111  1111 1111 1111 and 4111111111111112 1"), (4, "call +1 (988) 555-2485 or +12 3 or +1-2-3-4-5-6-7-8-9-0."),
    (5, None), (6, ""), (7, "\U0001f600\u00e9 mail m@n.o \ufdd0a@b.c \U0001f600 +49 30 1234567 "), (8, "1" * 30_000 + " " + "a" * 20_000 + "@" + "b." * 3000),
    (9, "4111 1111 1111 1111 " * 40), (10, "call (988) 555-2485 and key 1234.5678.9012.3456"), (None, "q@r.st"), (11, "-@-.- %@a.b-"), (1, "again a@b.c"),
    (12, "4111111111111111@x.yz +4111111111111111"),
]


def test_base_spans_equal_the_patterns(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in PII], "doc_id long, text string, kind int, candidates string")
    got = pii.find_spans(df).collect()
    assert sort([(r.doc_id, [tuple(s) for s in r.base]) for r in got]) == sort([(i, brute_spans(t)) for i, t in PII])
    assert all({tuple(s) for s in r.base} <= {tuple(s) for s in r.spans} for r in got)


def test_personal_data_query_counts_every_kind(spark, tmp_path):
    """The registered query's columns: kinds in any order and number, also without each other."""
    from platewise.llm.queries import op9_pii

    more = [(20, "1.2.3.4 and 5.6.7.8"), (21, "a@b.c d@e.f g@h.i"), (22, "+49 30 1234567 then a@b.c"), (23, "4111 1111 1111 1111"), (24, "a@b.c 1.2.3.4 4111111111111111 +49 30 1234567")]
    rows = PII + more
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op9_pii(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert [t for _, t in got.dtypes[1:5]] == ["bigint"] * 4

    def expected(i, text):
        spans = brute_spans(text)
        listed = ",".join(f"{list(BASE)[k]}:{start}:{end}" for start, k, end in spans)
        return (i, *[sum(k == kind for _, k, _ in spans) for kind in range(len(BASE))], hashlib.sha256(listed.encode()).hexdigest())

    assert sort([tuple(r)[:6] for r in got.collect()]) == sort([expected(i, t) for i, t in rows])


def test_redaction(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in PII], "doc_id long, text string, kind int")
    texts = {(r.doc_id, r.text) for r in pii.redact(df).collect()}
    assert (5, None) in texts and (6, "") in texts and (None, "[EMAIL]") in texts
    assert any(i == 2 and t == "hosts [IP].[IP] and 300.1.1.1 and [IP]" for i, t in texts)
    for i, t in texts:
        if i not in (8, 12):
            assert not brute_spans(t), (i, t[:80])


def test_looser_forms_are_added_by_their_own_checks(spark):
    loose = ["write jo.doe [at] mail [dot] org now", "at 2001:0db8:85a3:0000:0000:8a2e:0370:7334 today", "paid 4111.1111.1111.1111 then", "ring 415-555-2671 now"]
    bad = ["host 300.1.1.1 is down", "paid 4111.1111.1111.1112 then", "card 4111 1111 1111 1112 here"]
    sound = [f"mail a{i}@b.org from 10.0.{i % 250}.7" for i in range(400)]  # many sure spans
    for texts in (loose + bad, loose * 40 + bad + sound):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        for r in pii.find_spans(df).collect():
            if texts[r.doc_id] in loose:
                assert len(r.spans) == 1 and not r.base, texts[r.doc_id]
            elif texts[r.doc_id] in bad:
                assert r.spans == r.base == [], texts[r.doc_id]


def test_pii_empty_table(none):
    assert rows_of(pii.find_spans(none)) == [] and rows_of(pii.redact(none)) == []


def test_boosted_trees_tell_descriptions_apart():
    x = np.array([[0, d, 1, 1, 1, l, 0, 0] for d in range(10, 20) for l in (0, 1)])
    positive = np.array([100.0 if r[1] >= 14 and r[5] else 0.0 for r in x])
    total = np.full(len(x), 100.0)
    model = pii.fit(x, np.zeros(len(x), dtype=int), positive, total, np.stack([positive, total], axis=1))
    assert len(model.trees) == pii.TREES and np.isfinite(model.thresholds[0]) and model.thresholds[1] == float("-inf")


def test_look_alikes_that_fail_their_check_do_not_switch_valid_spans_off(spark):
    valid = ["dial 415-555-2671 now", "or 212-555-0187", "then 646-555-4432."]
    look_alikes = ["at 015-555-2671", "at 115-555-2671", "at 100-555-2671", "at 199-055-2671"]
    df = spark.createDataFrame(list(enumerate(valid + look_alikes)), "doc_id long, text string")
    assert {r.doc_id for r in pii.find_spans(df).collect() if r.spans} == {0, 1, 2}


def test_words_before_decide_what_is_added(spark):
    """Dotted numbers that pass Luhn: those of cards are 4-4-4-4 after a slash, order numbers stand in brackets."""
    good, bad = "4111.1111.1111.1111", "5500.0000.0000.0004"
    rows = [(i, f"card: {good} ok") for i in range(60)] + [(100 + i, f"order no ({bad}) ok") for i in range(60)]
    rows += [(300, f"here {good} too"), (301, f"here ({bad}) too")]  # no evidence, but like the others
    spans = {r.doc_id: len(r.spans) for r in pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans[300] == 1 and spans[301] == 0 and spans[0] == 1 and spans[100] == 0


def test_texts_with_very_many_spans(spark):
    import time

    n = 100_000
    df = spark.createDataFrame([(1, "1.2.3.4 " * n), (2, "a@b.c,+49 30 1234567;" * (n // 10))], "doc_id long, text string")
    begin = time.time()
    got = {r.doc_id: r for r in pii.find_spans(df).selectExpr("doc_id", "size(base) AS n", "base[size(base) - 1] AS last", "size(spans) AS m").collect()}
    assert (got[1].n, got[1].m, got[2].n) == (n, n, n // 5) and got[1].last.start == 8 * (n - 1)
    texts = dict(rows_of(pii.redact(df)))
    assert texts[1] == "[IP] " * n and texts[2] == "[EMAIL],[PHONE];" * (n // 10)
    assert time.time() - begin < 120


def test_redaction_with_clashing_names(spark):
    df = spark.createDataFrame([("x", "a@b.c", 1, 2, "r", 5)], "candidates string, text string, _spans int, _text int, row string, spans int")
    assert rows_of(pii.redact(df)) == [("x", "[EMAIL]", 1, 2, "r", 5)] and pii.redact(df).columns == df.columns


def test_bisection_finds_the_same_overlaps_as_comparing_all(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        marks = np.sort(rng.choice(60, 2 * int(rng.integers(0, 8)), replace=False))
        a, b = sorted(rng.choice(60, 2, replace=False).tolist())
        rows.append((i, [(int(x), int(y)) for x, y in marks.reshape(-1, 2)], (a, b)))
    df = spark.createDataFrame(rows, "i int, spans array<struct<start:int,end:int>>, c struct<start:int,end:int>")
    got = {r.i: r.o for r in df.select("i", pii._overlapped(F.col("c"), F.col("spans")).alias("o")).collect()}
    assert got == {i: any(s < b and a < e for s, e in spans) for i, spans, (a, b) in rows}


# --- 10 --------------------------------------------------------------------------------------------
def test_url_rules_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "net", "a.net", "", "com.", "b.b.a.com", "A.com"]
    rules = [("com", "/", "allow"), ("a.com", "/en/", "block"), ("b.a.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", None, "block"), ("a.com", "/en/", "allow"), (None, "/", "block"), ("com", "/e", "block")]
    urls = [None, "", "nothing", "http://", "https://a.com", "ftp://a.com?x=/en/", "x://y://a.com/en/"]
    urls += [f"http://{hosts[rng.integers(len(hosts))]}/{['en/', 'es/', 'e', 'en', 'fr/?q#'][rng.integers(5)]}{k}" for k in range(300)]
    urls += ["http://b.a.com/en/1"] * 200
    pages = spark.createDataFrame([(k if k % 50 else None, u, "h", "v") for k, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + (p or "")), len(h), v == "block", h + (p or ""), v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
        best = max(fits, default=None)
        return (host, path, best and best[3], best[4] if best else "allow")

    want = [(k if k % 50 else None, *judge(u)) for k, u in enumerate(urls)]
    for size in (20, 50_000):
        assert sort(rows_of(url_rules.match_urls(pages, frame, rows_per_block=size))) == sort(want)
    assert rows_of(url_rules.match_urls(pages.where("false"), frame)) == []
    assert {r.verdict for r in url_rules.match_urls(pages, frame.where("false"), default="block").collect()} == {"block"}


# --- words -----------------------------------------------------------------------------------------
def test_words_are_runs_without_ascii_white_space():
    texts = [t or "" for _, t in awkward()]
    got = words_of([t.encode() for t in texts])
    assert np.diff(got.first).tolist() == [len(SPACE.findall(t)) for t in texts]
    flat = [w for t in texts for w in SPACE.findall(t)]
    assert len(set(got.hashes.tolist())) == len(set(flat))
    assert len({(h, w) for h, w in zip(got.hashes.tolist(), flat)}) == len(set(flat))


def test_held_out_rule(spark):
    from platewise.llm.queries import held_out

    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out(1, 3).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
