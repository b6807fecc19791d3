"""Each stage of the pipeline against brute force on what its predecessor kept, and the whole run."""

import base64
import hashlib
import re
import struct

import public_tokenizers
import pytest
import tiktoken
from test_llm_operators import brute_components, brute_spans

import corpus_pipeline
from platewise.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows after each stage, the first being the documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        made = stage(spark, docs, SF)
        made.write.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_toxicity_stage(spark, kept):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taught = corpus_pipeline.F.crc32(corpus_pipeline.F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    scorer = toxicity.Scorer(toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet").where(taught)))
    assert {r.doc_id for r in kept[1]} == {r.doc_id for r in kept[0] if scorer.score(r.text) < 0.7}


def test_near_duplicate_stage(kept):
    want = {i for i, _, _, keep in brute_components([(r.doc_id, r.text) for r in kept[1]]) if keep}
    assert {r.doc_id for r in kept[2]} == want and len(want) < len(kept[1])


def test_decontamination_stage(spark, kept):
    def windows(text):
        words = re.findall(r"[^\W_]+", text.lower())
        return {tuple(words[i : i + 8]) for i in range(len(words) - 7)}

    bench = [windows(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {r.doc_id for r in kept[2] if all(len(windows(r.text) & b) < 2 for b in bench)}
    assert {r.doc_id for r in kept[3]} == want and len(want) < len(kept[2])


def test_personal_data_stage(kept):
    before = {r.doc_id: r.text for r in kept[3]}
    assert {r.doc_id for r in kept[4]} == set(before)
    for r in kept[4]:
        assert not brute_spans(r.text) and r.n_chars == len(r.text)
        if not brute_spans(before[r.doc_id]) and not re.search("[0-9]", before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_tokens_stage(kept):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in kept[4]}
    assert len(kept[5]) == len(texts)
    for r in kept[5]:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_whole_run(spark, kept):
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, kept[5]))
