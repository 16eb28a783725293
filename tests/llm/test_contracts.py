"""The registered queries' digest columns against plain Python, on whole tables."""

from __future__ import annotations

import hashlib
import zlib

import public_tokenizers
import pytest
import test_decontaminate
import test_neighbours
import test_pii
import test_repeats
import test_simhash
from tokenizers import Tokenizer

from quoteloom.llm import pii, queries

SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return [(r.doc_id, r.text) for r in rows]


def run(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


def test_toxicity(spark, docs):
    found = {r.doc_id: r for r in run(spark, "op1_toxicity")}
    assert set(found) == {d for d, _ in docs}
    for d, r in found.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_repeats_(spark, docs):
    got = sorted(
        (str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run(spark, "op2_repeats")
    )
    assert got == test_repeats.brute(docs, 200)


def test_neighbours_(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    want = test_neighbours.brute([(r.vec_id, r.embedding) for r in rows], 50)
    assert test_neighbours.recall(run(spark, "op3_neighbours"), want) >= 0.9


def test_decontamination(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = {
        d: (n, len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
        for d, n, hit, found in test_decontaminate.brute(docs, items)
    }
    got = {
        r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
        for r in run(spark, "op4_decontaminate")
    }
    assert got == want and any(w[4] for w in want.values())


def test_personal_data(spark, docs):
    found = {r.doc_id: r for r in run(spark, "op5_pii")}
    for d, text in docs:
        base = sorted(test_pii.brute(text or ""))
        joined = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        r = found[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert r.base_sha256 == sha(",".join(joined))
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s in joined] == joined
        keys = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert keys == sorted(keys)


def test_simhash_(spark, docs):
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in run(spark, "op9_simhash"))
    assert got == test_simhash.brute(docs)


def test_tokens(spark, docs):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    found = {r.doc_id: r for r in run(spark, "op10_bpe")}
    for d, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        r = found[d]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(tokenizer.decode(ids, skip_special_tokens=False))
