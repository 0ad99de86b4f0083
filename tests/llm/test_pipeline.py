"""The corpus pipeline against brute force, stage by stage on real rows."""

import importlib.util
import os
import sys

import brute
from llm_fixtures import SMALL
from sparkplate.llm import lines, quality

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def test_pipeline_stages(spark):
    assert importlib.util.find_spec("corpus_pipeline")
    import corpus_pipeline as C
    from sparkplate.llm.common import documents, materialise

    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "suffix_dedup", "packing"]
    docs = documents(spark, SMALL)
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(quality.ledger(docs), quality.POLICY).collect()}
    rows = [r for r in rows if verdict[r[0]]]
    for name, stage in C.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        if name == "line_dedup":
            texts = brute.clean_lines([(r[0], r[1], r[3]) for r in rows], lines.MIN_SITES)
            rows = [(r[0], t, r[2], r[3], len(t)) for r, t in zip(rows, texts)]
        elif name == "ngram_join":
            found = brute.component_ids([r[:2] for r in rows])
            rows = [r for r, (_, c) in zip(rows, found) if r[0] == c]
        elif name == "suffix_dedup":
            cut = [c[0].decode("utf-8", "ignore") for c in brute.cut_repeats([r[:2] for r in rows])]
            rows = [(r[0], t, r[2], r[3], len(t)) for r, t in zip(rows, cut)]
        assert sorted(map(tuple, docs.collect())) == sorted(rows), name
    packed = C.STAGES[-1][1](spark, docs, SMALL)
    assert {r["doc_id"] for r in packed.collect()} == {r[0] for r in rows}
