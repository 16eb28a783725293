from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quoteloom.llm import merkle, queries

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests, fanout):
    """(root, [siblings before and after for each level] of each digest)"""
    at = {i: i for i in range(len(digests))}
    proofs = [[] for _ in digests]
    while len(digests) > 1:
        runs = [digests[i : i + fanout] for i in range(0, len(digests), fanout)]
        for leaf_no, i in at.items():
            run, slot = runs[i // fanout], i % fanout
            proofs[leaf_no].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[leaf_no] = i // fanout
        digests = [sha(*r) for r in runs]
    return digests[0], proofs


def brute(rows, fanout=2):
    """rows are (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = -(2**63)
    for g in langs:
        groups[g].sort(key=lambda r: (low - 1 if r[0] is None else r[0], leaf(r)))
    trees = [tree([leaf(r) for r in groups[g]], fanout) for g in langs]
    if not trees:
        return []
    root, upper = tree([t[0] for t in trees], fanout)
    found = []
    for g, (subroot, proofs), above in zip(langs, trees, upper):
        for r, proof in zip(groups[g], proofs):
            own = leaf(r)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf((*r[:3], r[3] + 1, r[4])) if changed and r[3] is not None else own
            for before, after in proof + above:
                folded = sha(before, folded, after)
            digest = sha(*[b + a for b, a in proof + above])
            found.append((str(r[0]), own, subroot, root, digest, folded, folded == root))
    return sorted(found)


def listed(df):
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((str(r.doc_id), *[r[n] for n in names]) for r in df.collect())


def run(docs, fanout=2, block=merkle.BLOCK):
    columns = queries.RECORD
    plus = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns]
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.record_digest(plus))
    found = merkle.manifest(docs, columns, fanout=fanout, block=block, extra={"tampered": changed})
    folded = found.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.withColumns(
        {
            "proof_sha256": merkle.siblings_digest(F.col("proof")),
            "verified": F.col("folded_root") == F.col("root"),
        }
    )


def test_query_equals_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*queries.RECORD).collect()]
    got = queries.op12_merkle(spark, SF_DIR)
    want = brute(rows)
    assert listed(got) == want and not all(r[-1] for r in want)


@pytest.mark.parametrize(("fanout", "block"), [(2, 4), (3, 9), (5, 2), (2, 256)])
def test_rounds_and_fanouts(spark, fanout, block):
    rng = random.Random(fanout * block)
    langs = ["en"] * 40 + ["de", "é", "z", None, "lone"]
    rows = [(i, "s", rng.choice(langs[:-1]), i % 11, f"text {i}") for i in range(120)]
    rows.append((1000, None, "lone", None, None))
    assert listed(run(spark.createDataFrame(rows, SCHEMA), fanout, block)) == brute(rows, fanout)


def test_nulls_ties_long_texts_and_clashing_columns(spark):
    rows = [
        (None, None, None, None, None),
        (None, "a", None, 1, ""),
        (7, "a", "en", 1, "x"),
        (7, "a", "en", 1, "x"),
        (7, "b", "en", None, "x"),
        (14, "a", "en", 2**63 - 1, "é" * 300_000),
        (15, "a", "", 0, "empty language"),
    ]
    rows += [(20, "a", "fr", 1, "same")] * 30
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = docs.withColumns({c: F.lit("x") for c in ("group", "pos", "size", "digest", "root", "proof", "_id", "leaf")})
    found = merkle.manifest(clashing, queries.RECORD, block=8)
    folded = found.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof")).alias("proof_sha256"),
        merkle.fold(F.col("leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
    want = [(*r[:5], r[3], True) for r in brute(rows)]
    assert listed(folded) == sorted(want)


def test_empty_table_and_single_row(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert run(empty).count() == 0
    rows = [(1, "s", "en", 3, "abc")]
    assert listed(run(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert brute(rows)[0][1] == brute(rows)[0][3]
