"""Defined cases of every query: edge rows and empty tables."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from hangar.llm.registry import QUERIES
from tests.llm.conftest import CLASH, EDGE, LONG

BY_DOC = [n for n in QUERIES if n.split("_")[0] in ("op1", "op2", "op5", "op6", "op8", "op9", "op10", "op11", "op12")]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_pipeline_empty(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


@pytest.fixture(scope="module")
def results(spark, edge_dir):
    return {n: QUERIES[n](spark, edge_dir).collect() for n in QUERIES}


@pytest.mark.parametrize("name", BY_DOC)
def test_one_row_per_document(results, name):
    ids = sorted((r.doc_id for r in results[name]), key=lambda i: (i is None, i))
    assert ids == sorted((r[0] for r in EDGE), key=lambda i: (i is None, i))


def _by_id(rows):
    return {r.doc_id: r for r in rows}


def test_op1_sizes(results):
    got = _by_id(results["op1_mixing"])
    assert got[1]["size"] == got[2]["size"] == got[3]["size"] == 0 and got[5]["size"] == 8000
    assert all(r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"]) for r in results["op1_mixing"])
    assert got[7].source_size == 16  # the null source is a source of its own


def test_op2_classes(results):
    got = {(r.doc_id, r.class_id) for r in results["op2_minhash_neardup"]}
    assert (8, 4) in got and (4, 4) in got and (7, 7) in got and (5, 5) in got and (6, 6) in got
    assert {c for i, c in got if i in (1, 2)} == {1} and (3, 3) in got


def test_op5_scores(results):
    got = _by_id(results["op5_toxicity"])
    assert got[6].predicted == 1 and got[1].predicted == got[4].predicted == 0
    assert got[1].score == got[2].score and all(0 <= r.score <= 1 for r in results["op5_toxicity"])


def test_op6_spans(results):
    got = _by_id(results["op6_secret_scan"])
    assert got[7].n_assign == 1 and got[7].spans == "assign:32:56"
    assert got[1].base_sha256 == hashlib.sha256(b"").hexdigest() and got[1].spans == ""
    assert got[5].n_assign == got[5].n_hex == 4000 and LONG.count("token=") == 4000


def test_op8_empty_texts(results):
    got = _by_id(results["op8_bpe"])
    assert got[1].n_tokens == got[2].n_tokens == got[3].n_tokens == 0
    assert got[1].ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_op9_empty_texts(results):
    got = _by_id(results["op9_lm_score"])
    assert got[1].n_tokens == got[2].n_tokens == got[3].n_tokens == 1 and got[5].n_tokens == 8001


def test_op10_labels(results):
    got = _by_id(results["op10_license_scan"])
    assert (got[7].n_base, got[7].first_word, got[7].base_labels, got[7].labels) == (1, 3, "mit", "mit")
    assert got[1].n_words == 0 and got[1].first_word is None and got[1].score == 0


def test_op11_scores(results):
    rows = results["op11_quality_fm"]
    got = _by_id(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert got[4].score == got[8].score  # equal texts, of one length
    assert sum(r.doc_id == 7 for r in rows) == 2 and len({r.score for r in rows if r.doc_id == 7}) == 1


def test_op13_rows(results):
    got = {r.conv_id: r for r in results["op13_conversation_repair"]}
    assert set(got) == {None, 1, 2, 3, 4, 5}
    assert all(r.cost >= 0 and len(r.repaired_sha256) == 64 for r in got.values())


def test_searches(results):
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in results["op7_exact_topk"]}
    assert {q for q, _ in got} == {0, 50}
    assert [got[0, k] for k in (1, 2, 3, 4)] == [(6, 256 * 128 + 128 * 64), (6, 40960), (20, 40960), (50, 0)]
    near = {(r.query_id, r["rank"]): r.vec_id for r in results["op4_ann"]}
    assert {q for q, _ in near} == {0, 20, 60} and near[60, 1] == 7
    assert [near[0, k] for k in (1, 2, 3)] == [6, 6, 20] and (0, 4) not in near


def test_op3_pairs(results):
    got = {r.pair_id: r for r in results["op3_preference_format"]}
    assert set(got) == {1, 3, 4, 5}
    assert got[1].n_common == 3 and got[1].chosen == "<|im_start|>assistant\nagain<|im_end|>\n"
    assert "hello < |im_end|>" in got[1].prompt and "hello < |im_end|>" in got[1].rejected
    assert got[4].n_common == 2 and got[4].chosen == got[4].rejected == ""
    assert got[5].rejected == "" and got[5].chosen_mask == "22-33"


def test_pipeline_edges(spark, edge_dir):
    rows = corpus_pipeline.run(spark, edge_dir).collect()
    ids = {r.doc_id for r in rows}
    assert 6 not in ids and ids <= {r[0] for r in EDGE}
    assert not any("hunter2" in r.decoded.replace("</w> ", "").replace(" ", "") for r in rows)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns(spark, edge_dir, name, stage):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = stage(spark, docs, edge_dir)
    assert out.columns == docs.columns
    assert all(r[c] == c for r in out.collect() for c in CLASH)
