"""The stages against plain Python, on tables with awkward rows."""

import os

import numpy as np
import pytest
from cases import PROSE, documents, roots, shingles

import corpus_pipeline
from stayledger.llm import packing

SECRET = 'set token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" now'


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The smallest given tables, and awkward documents with them."""
    folder = str(tmp_path_factory.mktemp("tables"))
    given = "/root/testdata/sf0.001"
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{given}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{given}/documents.parquet")
    extra = [(10_000, PROSE), (10_001, PROSE), (10_002, PROSE + " More."), (10_003, None), (10_004, ""), (10_005, SECRET)]
    more = spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in extra], docs.schema)
    docs.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages_follow_their_contracts(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    benchmark = [r["text"] for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        path = os.path.join(tables, f"after-{name}")
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        rows = kept.collect()
        if name == "packing":
            break
        assert kept.columns == docs.columns
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        if name == "near_duplicates":
            root = roots({i: shingles(r["text"]) for i, r in before.items()})
            assert set(after) == {i for i in before if root[i] == i}
            assert 10_000 in after and 10_001 not in after
        if name == "decontamination":
            from stayledger.llm.decontaminate import words

            held = [words((r["text"] or "").encode()) for r in rows]
            windows = {tuple(w[i : i + 10]) for t in benchmark for w in [words(t.encode())] for i in range(len(w) - 9)}
            assert not any(tuple(w[i : i + 10]) in windows for w in held for i in range(len(w) - 9))
        if name == "secrets":
            assert set(after) == set(before)
            assert after[10_005]["text"] == 'set token = "[secret]" now' and after[10_005]["n_chars"] == 26
        elif name != "secrets":
            assert all(after[i] == before[i] for i in after)
        before, docs = after, kept
    tokens = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert set(tokens) == set(before)
    encode = packing.encoder()
    assert all(n == len(encode(before[i]["text"] or "")) + 1 for i, n in tokens.items())
    assert np.sum([r["length"] for r in rows]) == sum(tokens.values())


def test_near_duplicate_stage_keeps_unlike_rows_of_one_id(spark):
    other = "A second text that has nothing at all to do with the first one, under the same number."
    rows = [(7, PROSE), (7, PROSE), (7, other), (7, None), (7, None), (3, other + " End."), (9, PROSE), (None, PROSE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    got = sorted(((r["doc_id"], r["text"]) for r in left), key=str)
    assert got == sorted([(7, PROSE), (7, None), (3, other + " End."), (None, PROSE)], key=str)


def test_run_equals_the_stages(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    want = spark.read.parquet(f"{tables}/documents.parquet").count()
    assert 0 < got.select("doc_id").distinct().count() < want


def test_stages_take_empty_and_odd_tables(spark, tables):
    odd = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            out = stage(spark, docs, tables)
            rows = out.collect()
            assert name == "packing" or out.columns == docs.columns
            assert docs is odd or not rows
