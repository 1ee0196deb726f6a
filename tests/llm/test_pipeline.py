import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken

import brute
from plazaflow.llm import bpe
from plazaflow.llm.queries import RANKS
from plazaflow.llm.tables import load, settled
from tables_llm import benchmark


def test_each_stage_against_its_own_input(spark, small):
    docs = settled(load(spark, small, "documents"))
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = settled(stage(spark, docs, small))
        assert kept.columns == columns
        before = [tuple(r) for r in docs.collect()]
        after = [tuple(r) for r in kept.collect()]
        assert set(after) <= set(before)
        gone = {r[0] for r in before} - {r[0] for r in after}
        if name == "language ID":
            assert gone >= {r[0] for r in before if not any(c.isalpha() for c in r[1] or "")}
            assert not gone & set(range(90))
        if name == "n-gram Jaccard join":
            named = [(r[0], r[1]) for r in before if r[0] is not None]
            want = {k for k, n, c in brute.components(named) if not n or c == k}
            assert {r[0] for r in after} - {None} == want
            assert len(after) == len(set(after))
        if name == "benchmark decontamination":
            hit = {r[0] for r in before if brute.contamination(r[1], benchmark())[1]}
            assert gone == hit
        seen.append(name)
        docs = kept
    assert seen == ["toxicity", "language ID", "n-gram Jaccard join", "benchmark decontamination"]
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )
    texts = {r.doc_id: r.text for r in docs.collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert len(last) == docs.count()
    for r in last:
        assert r.round_trip
        assert np.array_equal(r.ids, library.encode_ordinary(texts[r.doc_id]))


def test_run_on_empty_tables(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).count() == 0
