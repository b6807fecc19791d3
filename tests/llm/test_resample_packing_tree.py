"""Importance resampling, hierarchical packing and the prefix tree against brute force."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from platewise.llm import listrank, packing, prefix_tree, resample
from platewise.llm.ordered import numbered

LETTERS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, weight string, rank int, key string, buckets int, place long, part int, length string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def text_rows():
    rng = np.random.default_rng(4)
    words = "alpha Beta gamma's DELTA-x über 中文 v2 x1y2  sigma".split(" ")
    rows = [(i, " ".join(words[k] for k in rng.integers(0, len(words), int(rng.integers(0, 60))))) for i in range(60)]
    return [
        *rows, (60, None), (61, ""), (62, " \t--"), (63, "x" * 200_000), (64, "word " * 20_000), (65, rows[3][1]),
        (None, "alpha " * 30), (66, rows[5][1]), (66, rows[5][1]), (-7, "beta beta " * 15), (67, "﷐\U0001f600 \x00 a" * 9),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "w", 1, "k", 2, 3, 4, "l") for i, t in text_rows()], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# --- positions -------------------------------------------------------------------------------------
def test_positions_follow_the_order_and_equal_rows_all_get_one(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 10).alias("k"))  # ten values, three hundred times each
    got = rows_of(numbered(df, [F.col("k").desc()]))
    assert sorted(p for _, p in got) == list(range(3000))
    assert [k for k, _ in sorted(got, key=lambda r: r[1])] == sorted((k for k, _ in got), reverse=True)
    assert rows_of(numbered(df.where("false"), [F.col("k")])) == []


# --- 11 --------------------------------------------------------------------------------------------
def features_of(text, spec):
    words = LETTERS.findall(lowered(text))
    grams = [" ".join(words[i : i + n]) for n in range(spec.least, spec.most + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % spec.buckets for g in grams]


def brute_resample(rows, target, spec, percent=10, least=20):
    found = [(i, *features_of(t, spec)) for i, t in rows]
    s, t = np.zeros(spec.buckets, int), np.zeros(spec.buckets, int)
    for _, _, buckets in found:
        np.add.at(s, buckets, 1)
    for text in target:
        np.add.at(t, features_of(text, spec)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + spec.buckets) / ((a + 1) * (t.sum() + spec.buckets)))) for a, b in zip(s.tolist(), t.tolist())]
    out = []
    for i, n, buckets in found:
        weight, score = sum(gain[b] for b in buckets), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, len(buckets), weight, score, None])
    drawable = sorted((r for r in out if r[1] >= least and r[0] is not None), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(drawable[: percent * len(drawable) // 100]):
        r[5] = k + 1
    return [tuple(r) for r in out]


@pytest.mark.parametrize("spec", [resample.Features(), resample.Features(1, 3, 500), resample.Features(2, 2, 64)])
def test_resample_equals_brute_force(spark, docs, spec):
    texts = ["alpha beta über", None, "", "中文 中文 delta x", "alpha beta über"]
    target = spark.createDataFrame([(t, 1) for t in texts], "text string, key int")
    got = rows_of(resample.resample(docs, target, percent=40, spec=spec))
    want = brute_resample(text_rows(), texts, spec, 40)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_resample_of_empty_tables(spark, docs, none):
    target = spark.createDataFrame([], "text string")
    assert rows_of(resample.resample(none, target)) == []
    got = rows_of(resample.resample(docs, target))
    assert sorted(got, key=repr) == sorted(brute_resample(text_rows(), [], resample.Features()), key=repr)


def test_resample_draws_towards_the_target(spark):
    rng = np.random.default_rng(2)
    kinds = [["red", "green", "blue"], ["one", "two", "three"]]
    rows = [(i, " ".join(rng.choice(kinds[i % 2], 25))) for i in range(2000)]
    target = spark.createDataFrame([("red green blue " * 30,)], "text string")
    drawn = [r[0] for r in rows_of(resample.resample(spark.createDataFrame(rows, "doc_id long, text string"), target)) if r[5]]
    assert len(drawn) == 200 and all(i % 2 == 0 for i in drawn)


# --- 12 --------------------------------------------------------------------------------------------
def padding(lengths, longest):
    return sum(0 if n & (n - 1) == 0 else longest - n for n in lengths)


@pytest.mark.parametrize("windows", [packing.Windows(), packing.Windows(64, 8, 256, 500), packing.Windows(16, 16, 16, 1)])
def test_pieces_hold_every_token_once(docs, windows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = sorted((i if i is not None else -1, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in text_rows())
    rows = [r.asDict() for r in packing.pack(docs, TOKENIZER, windows=windows).collect()]
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_doc[r["doc_id"] if r["doc_id"] is not None else -1].append((r["start"], ids.tolist(), r["doc_tokens"]))
        by_window[r["sequence_id"]].append((r["offset"], r["length"], r["context"], r["step"]))
    got = []
    for i, pieces in by_doc.items():
        copies = len([1 for j, _ in want if j == i])
        starts = [s for s, _, _ in pieces]
        if copies == 1:
            assert len(set(starts)) == len(starts)
            ids = [x for _, part, _ in sorted(pieces) for x in part]
            assert {n for _, _, n in pieces} == {len(ids)}
            got.append((i, ids))
        else:
            assert sum(len(p) for _, p, _ in pieces) == sum(len(x) for j, x in want if j == i)
            got += [(j, x) for j, x in want if j == i]
    assert sorted(got) == want
    for pieces in by_window.values():
        at = 0
        for offset, length, context, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at == pieces[0][2] <= windows.longest and len({p[2:] for p in pieces}) == 1
    assert padding([p[0][2] for p in by_window.values()], windows.longest) == 0


def test_blocks_are_packed_whole_with_few_cuts():
    rng = np.random.default_rng(6)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, 3000).astype(int) + 1, 40_000).tolist()
    windows = packing.Windows()
    packed = packing.pack_block(lengths, windows)
    seen = defaultdict(list)
    for tier, pieces in packed:
        assert sum(n for _, _, n in pieces) == tier
        for doc, start, n in pieces:
            seen[doc].append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[doc]):
            assert start == at
            at += size
        assert at == n
    # Cuts beyond those of texts above the longest window: a small share of the documents.
    extra = sum(len(seen[d]) - (n // 1024 + (n % 1024 > 0)) for d, n in enumerate(lengths))
    assert extra < 0.2 * len(lengths)
    assert sum(1 for tier, _ in packed if tier < windows.shortest) <= 10


def test_step_groups_are_of_equal_size_and_balanced():
    cost = np.random.default_rng(1).integers(1, 1000, 103)
    group = packing.deal_steps(cost, 10)
    sizes = np.bincount(group)
    assert sizes.tolist() == [10] * 10 + [3]
    sums = np.bincount(group, cost)[:10]
    assert sums.max() / sums.min() < 1.25
    assert packing.deal_steps(cost[:4], 10).tolist() == [0] * 4


def test_cached_pieces_give_the_ids_of_whole_texts():
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = packing.TextEncoder(file.read())
    plain = Tokenizer.from_file(TOKENIZER)
    rng = np.random.default_rng(9)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\x1c", " ", " ", "a", "Word", "über", "中文", "12", "!?", "'s", "<|endoftext|>", "İ", "\U0001f600"]
    texts = ["".join(parts[k] for k in rng.integers(0, len(parts), int(rng.integers(1, 40)))) for _ in range(2000)]
    texts += ["many words " * 30_000, " \n" * 50_000, "y" * 70_000 + " z"]
    for t, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t[:80]
    assert encoder.encode([]) == []


def test_packing_an_empty_table(none):
    assert rows_of(packing.pack(none, TOKENIZER)) == []


def test_windows_keep_their_numbers_when_partitions_are_merged(docs):
    apart = sorted(rows_of(packing.pack(docs, TOKENIZER)), key=repr)
    assert sorted(rows_of(packing.pack(docs, TOKENIZER).coalesce(1)), key=repr) == apart


# --- 13 --------------------------------------------------------------------------------------------
def brute_tree(convs):
    """``convs``: id and list of (role, text)."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        todo, out = [node], []
        while todo:
            out.append(todo.pop())
            todo += children[out[-1]]
        return out

    rows = []
    for node, ids in members.items():
        subtree = below(node)
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in subtree if n)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        rows.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]),
            sum(not children[n] for n in subtree), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def brute_rebuilt(rows, content=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()[:32], role or "", text or ""))
    own = {c: [r[3:] for r in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def talk_rows():
    rng = np.random.default_rng(12)
    said = ["hi", "hi there", "no", None, "", "a b  c", "x" * 30_000]
    rows = []
    for c in [*range(0, 90), 200, 205, 219, -5, -20, -21, 10**12, 10**12 + 3]:
        for turn in range(int(rng.integers(1, 7))):
            rows.append((c, turn, ["user", "bot", None][rng.integers(3)], said[rng.integers(len(said))]))
    rows += [(300, None, "user", "first"), (300, 0, "user", "second"), (301, 5, "u", "only"), (None, 0, "user", "lost")]
    rows += [(302, 1, "u", "same")] * 3 + [(303, 1, "u", "b"), (303, 1, "u", "a")]  # ties and repeated rows
    rows += [(40, 100 + k, "u", f"long {k % 3}") for k in range(300)]
    return rows


def talk(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, n string, nth int").repartition(3)


@pytest.mark.parametrize("chunk, enough", [(4096, 8192), (7, 20)])
def test_tree_equals_brute_force(spark, monkeypatch, chunk, enough):
    monkeypatch.setattr(prefix_tree, "_CHUNK", chunk)
    monkeypatch.setattr(prefix_tree, "_IDS", 3)
    turns, convs = prefix_tree.rebuilt(prefix_tree.ordered_turns(talk(spark, talk_rows())))
    got = rows_of(prefix_tree.prefix_tree(turns, convs, enough))
    assert sorted(got, key=repr) == brute_tree(brute_rebuilt(talk_rows()))


def test_tree_of_one_turnless_conversation_and_of_none(spark):
    one = [(3, 0, "u", "gone")]  # its own first turns give way to those of an absent conversation
    assert zlib.crc32(b"3") % 4 >= 1
    for rows in (one, []):
        turns, convs = prefix_tree.rebuilt(prefix_tree.ordered_turns(talk(spark, rows)))
        assert sorted(rows_of(prefix_tree.prefix_tree(turns, convs)), key=repr) == brute_tree(brute_rebuilt(rows))


def test_many_ends_of_one_node_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_tree, "_IDS", 10)
    rows = [(c * 20, 0, "u", "same") for c in range(500)]
    turns, convs = prefix_tree.rebuilt(prefix_tree.ordered_turns(talk(spark, rows)))
    got = rows_of(prefix_tree.prefix_tree(turns, convs))
    assert sorted(got, key=repr) == brute_tree(brute_rebuilt(rows))


@pytest.mark.parametrize("shuffled", [False, True])
def test_prefix_sums_along_lists(spark, shuffled):
    rng = np.random.default_rng(3)
    order = rng.permutation(5000) if shuffled else np.arange(5000)
    values = rng.integers(0, 10, (5000, 2))
    rows, want = [], {}
    for begin, end in ((0, 1), (1, 4000), (4000, 5000)):  # three lists
        sums = np.zeros(2, dtype=int)
        for i in range(begin, end):
            rows.append((int(order[i]), int(order[i + 1]) if i + 1 < end else None, int(values[i, 0]), int(values[i, 1])))
            want[int(order[i])] = tuple(sums.tolist())
            sums += values[i]
    links = spark.createDataFrame(rows, "id long, next long, leaves long, saved long").repartitionByRange(4, "id").sortWithinPartitions("id")
    got = {i: (a, b) for i, a, b in rows_of(listrank.prefix_sums(links, 50))}
    assert got == want
