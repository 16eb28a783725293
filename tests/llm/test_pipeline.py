from __future__ import annotations

import re

import corpus_pipeline
import public_tokenizers
import test_decontaminate
import test_simhash
from tokenizers import Tokenizer

from quoteloom.llm import pii, toxicity

SF_DIR = "/root/testdata/sf0.001"


def cut(text, hit):
    """``text`` without the words numbered in ``hit`` and what is between neighbours of them."""
    places = [m.span() for m in re.finditer(r"[0-9A-Za-z\x80-\U0010ffff]+", text)]
    out, at = [], 0
    for i, (a, b) in enumerate(places):
        if i in hit:
            if i - 1 not in hit:
                out.append(text[at:a])
            at = b
    return "".join([*out, text[at:]])


def test_run_equals_a_plain_reading(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect() if model.score(r.text) < 0.5]
    least = {int(c) for _, _, c in test_simhash.brute(rows)}
    rows = [r for r in rows if r[0] in least]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hits = {d: set(h) for d, _, h, _ in test_decontaminate.brute(rows, items)}
    rows = [(d, cut(t, hits[d])) for d, t in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    potentials = pii.fit(frame)
    masked = []
    for d, t in rows:
        for s in sorted(pii.label_spans([t], potentials, 0.9)[0], key=lambda s: -s["start"]):
            t = f"{t[: s['start']]}[{s['kind']}]{t[s['end'] :]}"
        masked.append((d, t))
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want = {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in masked}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.ids for r in found} == want and len(found) == len(want)
    assert all(r.exact and r.n_tokens == len(r.ids) for r in found)
    assert 0 < len(want) < docs.count() and any(hits.values())


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, root int, _row int"
    rows = [(None, None), (1, ""), (1, ""), (2, None), (None, "x y z w v " * 9), (None, "x y z w v " * 9), (3, "q " * 9000)]
    for some in (rows, []):
        docs = spark.createDataFrame([(i, t, None, None, None, 0, 0) for i, t in some], schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept = sorted(str(r.doc_id) for r in docs.collect())
        # the texts without words are one group, and so are the two without an id
        assert kept == (["1", "3", "None"] if some else [])


def test_no_usable_label_drops_nothing(spark, tmp_path):
    schema = "doc_id long, quality int, toxic int"
    docs = spark.createDataFrame([(1, "a clean text", "en", "s", 12)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, rows in (("empty", []), ("null", [(1, 1, None)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.drop_toxic(spark, docs, f"{tmp_path}/{name}").count() == 1
