"""The stages one after the other on the smallest tables, each against a brute-force version."""

import os
import sys
from collections import Counter

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import test_operators as B  # noqa: E402

from quillgrid.llm import pieces, toxicity  # noqa: E402

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")


def triples(rows):
    return [(r.doc_id, r.text, r.source) for r in rows]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, before = docs.columns, docs.collect()
    after = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        model = toxicity.unpack(toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))) if i == 0 else None
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        rows = docs.collect()
        if name == "toxicity":
            scores = toxicity.predict(model, pa.array([r.text for r in before]))
            want = Counter(r.doc_id for r, s in zip(before, scores) if s < 0.3)
        elif name == "exact dedup":
            want = Counter({max(r.doc_id for r in before if (r.text or "") == t): 1 for t in {r.text or "" for r in before}})
        elif name == "n-gram Jaccard join":
            want = Counter(i for i, c, *_ in B.brute_links(triples(before)) if i == c)
        elif name == "mixing sources":
            want = Counter({i: c for (i, _), (c, _) in B.brute_mix(triples(before)).items() if c})
        else:
            want = Counter(r.doc_id for r in before)
            p, text = pieces.pieces(pieces.piece_path()), {r.doc_id: r.text or "" for r in before}
            for r in rows:
                assert r.lossless and r.n_tokens == len(r.token_ids)
                assert b"".join(p.raw[p.raw_at[k] : p.raw_at[k + 1]].tobytes() for k in r.token_ids)[1:].decode() == text[r.doc_id]
        assert Counter(r.doc_id for r in rows) == want, name
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == cols
            whole = {r.doc_id: r for r in before}
            assert all(r == whole[r.doc_id] for r in rows)  # rows go through as they are
        before, after[name] = rows, len(rows)
    assert 200 > after["toxicity"] > after["exact dedup"] >= after["n-gram Jaccard join"] < after["mixing sources"] == after["SentencePiece encoding"]


def test_pipeline_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
