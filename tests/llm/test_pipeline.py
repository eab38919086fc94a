"""The pipeline against the same steps done plainly on a small corpus."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus  # noqa: E402

import corpus_pipeline  # noqa: E402
from starloom.llm import mixing, packing  # noqa: E402


def test_stage_decisions(spark):
    docs = corpus.documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language id"](spark, docs, "")
    texts = [r["text"] for r in kept.collect()]
    assert None not in texts and "" not in texts and "12 34 %% $$" not in texts
    clean = [r[1] for r in corpus.rows() if r[2] is not None]
    assert not Counter(clean) - Counter(texts)  # no document of a known language goes
    once = stages["exact dedup"](spark, kept, "")
    best: dict[str, int] = {}
    for r in kept.collect():
        best[r["text"]] = max(best.get(r["text"], -1), -1 if r["doc_id"] is None else r["doc_id"])
    assert Counter((r["text"], -1 if r["doc_id"] is None else r["doc_id"]) for r in once.collect()) == Counter(best.items())
    apart = stages["near dedup"](spark, once, "")
    pairs = [(r["doc_id"], r["text"]) for r in once.collect()]
    want = corpus.near_components(pairs)
    assert sorted(str(r["doc_id"]) for r in apart.collect()) == sorted(str(i) for i, _ in pairs if i is None or want[i] == i)


def test_run_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixture(docs).collect()}
    out = corpus_pipeline.run(spark, sf).collect()
    assert Counter(r["doc_id"] for r in out if r["piece"] == 0) == Counter({i: c for i, c in copies.items() if c})
    filled = Counter()
    for r in out:
        filled[r["sequence_id"]] += r["length"]
        assert len(r["ids"]) == 4 * r["length"]
    assert max(filled.values()) <= packing.CAPACITY
    assert len(filled) <= sum(filled.values()) / packing.CAPACITY * 1.05 + 1
