"""The document queries on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import os
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from check_oracle import compare, connect

from panelloom.llm import queries
from panelloom.llm.frames import read_documents, stored

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables at hand")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE[name]) is None


def test_byte_bpe_query(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    path = public_tokenizers.path(queries.BYTE_RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in read_documents(spark, SF_DIR).collect()}
    for r in queries.QUERIES["op2_byte_bpe"](spark, SF_DIR).collect():
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("name", ["op4_phrase_fingerprint", "op6_quality", "op7_toxicity", "op8_language_id", "op10_pitman_yor"])
def test_query_has_one_row_per_document(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in read_documents(spark, SF_DIR).select("doc_id").collect())
    if name == "op10_pitman_yor":
        assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    if name == "op8_language_id":
        langs = {r.doc_id: r.lang for r in read_documents(spark, SF_DIR).select("doc_id", "lang").collect()}
        held = [r for r in rows if r.held_out]
        assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_pipeline_stages(spark):
    """Each stage against a plain computation on its own input."""
    docs = read_documents(spark, SF_DIR)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text or "" for r in docs.collect()}
        docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        if name == "packing":
            tokens = {r.doc_id: r.n for r in docs.selectExpr("doc_id", "length").groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
            assert set(tokens) == set(before)
            filled = [r["n"] for r in docs.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()]
            assert all(n == 4096 or n & (n - 1) == 0 for n in filled)
            continue
        assert docs.columns == columns
        after = {r.doc_id: r.text or "" for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "exact_dedup":
            low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            best: dict[str, int] = {}
            for i, t in before.items():
                best[t.translate(low)] = max(i, best.get(t.translate(low), -1))
            assert set(after) == set(best.values())
        if name == "substring_dedup":
            assert set(after) == set(before)
            seen: dict[tuple, int] = {}
            for t in before.values():
                w = WORD.findall(t)
                for i in range(len(w) - 34):
                    seen[tuple(w[i : i + 35])] = seen.get(tuple(w[i : i + 35]), 0) + 1
            for i, t in before.items():
                w = WORD.findall(t)
                gone = np.zeros(len(w), bool)
                for a in range(len(w) - 34):
                    if seen[tuple(w[a : a + 35])] > 1:
                        gone[a : a + 35] = True
                assert after[i] == (" ".join(x for x, g in zip(w, gone) if not g) if gone.any() else t)
