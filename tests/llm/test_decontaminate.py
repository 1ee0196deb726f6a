import pytest

import brute
from plazaflow.llm import decontaminate
from plazaflow.llm.queries import QUERIES
from plazaflow.llm.tables import load
from tables_llm import benchmark, documents


def wanted(rows):
    return [(key, *brute.contamination(text, benchmark())) for key, text, *_ in rows]


def key(row):
    return repr(row)


def test_query_against_brute_force(spark, small):
    found = QUERIES["op10_decontaminate"](spark, small).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found]
    want = [
        (d, n, hit, len(items), brute.sha(",".join(sorted(map(str, items)))), hit > 0)
        for d, n, hit, items in wanted(documents())
    ]
    assert sorted(rows, key=key) == sorted(want, key=key)
    assert any(r[5] for r in rows)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_both_ways_give_the_same(spark, small, limit):
    docs, items = load(spark, small, "documents"), load(spark, small, "benchmark")
    found = decontaminate.marked(docs, items, max_broadcast=limit)
    rows = [(r.doc_id, r.hit.n_words, r.hit.n_hit, set(r.hit["items"])) for r in found.collect()]
    assert sorted(rows, key=key) == sorted(wanted(documents()), key=key)
    assert found.columns == [*docs.columns, "hit"]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_spans_are_cut_out(spark, limit):
    docs = spark.createDataFrame([(1, "Ä: Then ONE, two; three é"), (2, "one"), (3, None)], "doc_id int, text string")
    items = spark.createDataFrame([(7, "one two"), (8, "three é")], "item_id bigint, text string")
    left = decontaminate.without_spans(docs, items, max_broadcast=limit).collect()
    assert sorted(map(tuple, left)) == [(1, "Ä: Then "), (2, "one"), (3, None)]
    split = spark.createDataFrame([(1, "a ONE two b one TWO c")], "doc_id int, text string")
    assert decontaminate.without_spans(split, items, max_broadcast=limit).first().text == "a  b  c"
    assert [r.doc_id for r in decontaminate.without_documents(docs, items).orderBy("doc_id").collect()] == [2, 3]


def test_a_column_of_the_same_name_is_replaced(spark):
    docs = spark.createDataFrame([(1, "one two", "mine")], "doc_id int, text string, hit string")
    items = spark.createDataFrame([(7, "one two")], "item_id bigint, text string")
    assert decontaminate.marked(docs, items).first().hit.n_hit == 2


def test_empty_tables(spark, nothing, small):
    assert QUERIES["op10_decontaminate"](spark, nothing).count() == 0
    docs = load(spark, small, "documents")
    left = decontaminate.without_documents(docs, load(spark, nothing, "benchmark"))
    assert left.count() == docs.count()
