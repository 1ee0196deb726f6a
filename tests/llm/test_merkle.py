"""The Merkle manifest against trees built by plain Python."""

import random
import zlib
from collections import defaultdict

import pytest
from brute import sha
from pyspark.sql import functions as F
from tables_llm import documents

from plazaflow.llm import merkle
from plazaflow.llm.queries import QUERIES


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def up(nodes, fanout):
    return [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]


def path(nodes, at, fanout):
    """Top digest and, level by level, the other members of the node's run."""
    out = []
    while len(nodes) > 1:
        run = at - at % fanout
        out.append((nodes[run:at], nodes[at + 1 : run + fanout]))
        nodes, at = up(nodes, fanout), at // fanout
    return nodes[0], out


def fold(leaf, steps):
    for left, right in steps:
        leaf = sha("".join(left) + leaf + "".join(right))
    return leaf


def want(rows, fanout=2):
    """(id, leaf, subroot, root, steps) of (id, source, lang, n_chars, text) rows."""
    parts = defaultdict(list)
    for row in rows:
        leaf = sha("".join(map(told, row)))
        parts[row[2]].append((row[0] is not None, row[0] or 0, leaf, row))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: [x[2] for x in sorted(parts[p], key=lambda x: x[:3])] for p in names}
    subroots = [path(trees[p], 0, fanout)[0] for p in names]
    for place, p in enumerate(names):
        root, above = path(subroots, place, fanout)
        for rank, (*_, leaf, row) in enumerate(sorted(parts[p], key=lambda x: x[:3])):
            subroot, steps = path(trees[p], rank, fanout)
            yield row, leaf, subroot, root, steps + above


def test_query_against_brute_force(spark, small):
    rows = [(i, source, lang, n, text) for i, text, lang, source, n in documents()]
    expected = []
    for row, leaf, subroot, root, steps in want(rows):
        shown = leaf
        if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
            shown = sha("".join(map(told, (*row[:3], row[3] + 1, row[4]))))
        top = fold(shown, steps)
        proof = sha("".join("".join(a) + "".join(b) for a, b in steps))
        expected.append((row[0], leaf, subroot, root, proof, top, top == root))
    found = [tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, small).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize(("fanout", "segment"), [(2, 4), (3, 9)])
def test_many_rounds_of_segments(spark, monkeypatch, fanout, segment):
    monkeypatch.setattr(merkle, "SEGMENT", segment)
    rnd = random.Random(fanout)
    rows = [(i, "s", f"g{min(rnd.randrange(12), 5)}", i, None) for i in range(130)]
    rows += [(i, "s", "alone", 1, "x") for i in range(1)] + [rows[7]] * 9
    docs = spark.createDataFrame(rows, "doc_id int, source string, lang string, n_chars int, text string")
    made = merkle.manifest(docs, ("doc_id", "source", "lang", "n_chars", "text"), fanout=fanout)
    found = merkle.proofs(made).withColumn("top", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    expected = sorted(want(rows, fanout), key=lambda x: (x[0][0], repr(x[4])))
    found = sorted(found, key=lambda r: (r.id, repr([(list(a), list(b)) for a, b in r.path])))
    assert len(found) == len(expected)
    for r, (row, leaf, subroot, root, steps) in zip(found, expected):
        assert (r.id, r.leaf, r.subroot, r.root) == (row[0], leaf, subroot, root)
        assert [(list(a), list(b)) for a, b in r.path] == steps
        assert r.at == leaf and r.top == root
    below = {r.digest: r.children for r in made.records.collect()}
    assert all(sha("".join(children)) == key for key, children in below.items())
    assert expected[0][3] in below


def test_single_requests(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    made = merkle.manifest(docs, ("doc_id", "text"))
    (row,) = merkle.proofs(made, made.leaves.where("id = 17")).collect()
    assert fold(row.leaf, [(list(a), list(b)) for a, b in row.path]) == row.root


def test_string_ids_and_clashing_columns(spark):
    rows = [(f"k{i}", "b", "x", i, "y") for i in range(9)]
    docs = spark.createDataFrame(rows, "key string, part string, rank string, digest int, path string")
    made = merkle.manifest(docs, ("key", "digest"), id_col="key", group_col="part", carried=("rank", "path"))
    found = merkle.proofs(made).collect()
    assert sorted(r.id for r in found) == [f"k{i}" for i in range(9)]
    assert all(r.carried.rank == "x" and r.at == r.leaf for r in found)


def test_nothing(spark, nothing):
    assert QUERIES["op13_merkle_manifest"](spark, nothing).count() == 0
