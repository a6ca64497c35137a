"""Registered queries of this package against their SQL, and the pipeline's stages."""

import os
from collections import Counter

import pytest
from checking import compare, connect

import corpus_pipeline
from railgrain.llm import catalog, decontaminate, jaccard, token_store, toxicity
from railgrain.llm.common import table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, name):
    assert compare(catalog.QUERIES[name](spark, SF_DIR), connect(SF_DIR), catalog.SQL[name]) is None


def test_each_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in catalog.QUERIES) == list(range(1, 14))


def test_pipeline_stages_do_what_their_operators_say(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        seen[name] = (docs, out)
        docs = out
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    before, after = seen["toxicity"]
    labels = table(spark, SF_DIR, "labels").where(~toxicity.held_out())
    assert ids(before) - ids(after) == ids(toxicity.classify(before, labels).where("predicted = 1"))
    before, after = seen["near_copies"]
    assert ids(after) == ids(jaccard.join_components(before).where("doc_id = component_id"))
    before, after = seen["decontamination"]
    leaks = decontaminate.find_leaks(before, table(spark, SF_DIR, "benchmark")).select("doc_id").distinct()
    assert ids(before) - ids(after) == ids(leaks)
    before, after = seen["mixing"]
    assert set(ids(after)) <= set(ids(before)) and max(ids(after).values()) <= 2
    before, after = seen["tokens"]
    assert ids(after) == ids(before)
    tokenizer = token_store.Encoder(token_store.tokenizer_path()).tokenizer
    want = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect()}
    assert all(want[r.doc_id] == r.n_tokens for r in after.collect())
