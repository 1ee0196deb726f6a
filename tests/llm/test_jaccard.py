import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from plazaflow.llm import jaccard
from plazaflow.llm.components import connected
from plazaflow.llm.queries import QUERIES
from plazaflow.llm.tables import load
from tables_llm import documents


def by_row(rows):
    return sorted(rows, key=repr)


def test_query_against_brute_force(spark, small):
    found = [tuple(r) for r in QUERIES["op8_ngram_jaccard"](spark, small).collect()]
    want = brute.components([(r[0], r[1]) for r in documents()])
    assert by_row(found) == by_row([(k, n, c if n else k) for k, n, c in want])
    assert sum(c == 90 for _, _, c in found) > 4


def near_copies(seed, n=150):
    rnd = random.Random(seed)
    bases = [[f"v{rnd.randrange(3000)}" for _ in range(rnd.randint(20, 120))] for _ in range(6)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        if rnd.random() < 0.4:
            at = rnd.randrange(len(words))
            words[at:at] = passage
        rows.append((i * 7 % n, " ".join(words)))
    return rows


@pytest.mark.parametrize(("seed", "block", "hot"), [(1, 2048, 50_000), (2, 12, 50_000), (3, 40, 4)])
def test_groups_of_near_copies(spark, monkeypatch, seed, block, hot):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HOT", hot)
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = [tuple(r) for r in jaccard.components(docs).collect()]
    assert by_row(found) == by_row(brute.components(rows))


def test_trees_lose_no_pair():
    rnd = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = rnd.integers(0, 2**63, rnd.integers(30, 300)).astype(np.uint64)
        for _ in range(20):
            keep = rnd.random(len(base)) < rnd.choice([0.9, 0.95, 0.99])
            sets.append(np.unique(np.append(base[keep], rnd.integers(0, 2**63, 3).astype(np.uint64))))
    names, sizes = np.arange(len(sets)), np.array([len(x) for x in sets])
    bits = jaccard._folded([jaccard.bitmap(x).tobytes() for x in sets], jaccard.BITS // 8)
    groups = rnd.integers(0, 100, len(sets))
    tree = jaccard.Tree(names, groups, sizes, bits)
    pairs = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in jaccard.candidates(tree, tree)))}
    half = len(sets) // 2
    left, right = (jaccard.Tree(names[s], groups[s], sizes[s], bits[s]) for s in (slice(half), slice(half, None)))
    jaccard._lift(left, max(len(left.low), len(right.low)))
    jaccard._lift(right, len(left.low))
    across = set(zip(*(x.tolist() for x in jaccard.candidates(left, right))))
    linked = 0
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (sizes[i] + sizes[j] - both) and groups[i] != groups[j]:
                linked += 1
                assert (j, i) in pairs
                assert (j, i) in across or (j < half) == (i < half)
    assert linked > 300
    assert len(pairs) < 0.2 * len(sets) ** 2 / 2


def test_bitmaps_of_large_sets_fold_to_small_ones():
    values = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    large = jaccard.bitmap(values)
    assert len(large) * 8 >= 2 * len(values)
    small = jaccard._folded([large.tobytes()], jaccard.BITS // 8)
    want = np.zeros(jaccard.BITS, bool)
    want[values & np.uint64(jaccard.BITS - 1)] = True
    assert (small[0].view(np.uint8) == np.packbits(want)).all()


def test_hashes_agree_across_batches():
    text = "One two THREE four five six seven"
    alone = next(jaccard.shingle_sets(pa.array([text])))
    among = list(jaccard.shingle_sets(pa.array(["other words", None, "", text.lower(), "x"])))
    assert (alone == among[3]).all()
    assert [len(x) for x in among] == [1, 0, 0, 3, 1]


@pytest.mark.parametrize("in_one_task", [0, 1000])
def test_components_of_long_paths_and_hubs(spark, in_one_task):
    rnd = random.Random(8)
    path = list(range(100, 200))
    rnd.shuffle(path)
    links = list(zip(path, path[1:])) + [(500, 500 + i) for i in range(1, 60)] + [(7, 7), (8, None), (9, 8)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    found = connected(df, "a", "b", in_one_task).collect()
    want = {x: 100 for x in path} | {500 + i: 500 for i in range(60)} | {8: 8, 9: 8}
    assert {r.node: r.component for r in found} == want and len(found) == len(want)


def test_one_document_of_each_group_stays(spark, small):
    docs = load(spark, small, "documents")
    kept = jaccard.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    want = brute.components([(r[0], r[1]) for r in documents() if r[0] is not None])
    assert ids == sorted({k for k, n, c in want if not n or c == k})


def test_other_columns_may_have_any_name(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", "x", 5, 1), (2, "A b c", "y", 6, 2), (3, "d", "z", 7, 3)],
        "doc_id bigint, text string, _id string, component_id int, class int",
    )
    kept = jaccard.deduplicated(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in kept] == [(1, "a b c", "x", 5, 1), (3, "d", "z", 7, 3)]


def test_empty_table(spark, nothing):
    assert QUERIES["op8_ngram_jaccard"](spark, nothing).count() == 0
    assert jaccard.deduplicated(load(spark, nothing, "documents")).count() == 0
