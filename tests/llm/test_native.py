"""Operators made of DataFrame functions only: chat formatting and quality rules."""

import random
import re

import brute
from pyspark.sql import functions as F
from plazaflow.llm import chat, quality
from plazaflow.llm.queries import QUERIES
from tables_llm import conversations, documents


def in_order():
    rows = [(c, t, r or "", x or "") for c, t, r, x in conversations()]
    rows += [(-1, i, ("user", "assistant")[i], "</s>[INST] ok [/INST]") for i in range(2)]
    out = {}
    for row in sorted(rows, key=lambda r: (repr(r[0]), r[1], r[2], r[3])):
        out.setdefault(row[0], []).append(row[2:])
    return out


def test_chat_query_gives_the_turns_back(spark, small):
    found = {r.conv_id: r for r in QUERIES["op5_chat_formatting"](spark, small).collect()}
    for conv, turns in in_order().items():
        own, said = found.pop(conv), "".join(t for r, t in turns if r == "assistant")
        assert own.n_turns == len(turns)
        assert own.turns_sha256 == brute.sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (own.loss_chars, own.loss_sha256) == (len(said), brute.sha(said))
    assert not found


def test_every_assistant_turn_is_an_example_of_its_own(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").withColumn("place", F.lit("mine"))
    examples = chat.formatted(rows).where("conv_id = 1").orderBy("place").collect()
    assert [(r.place, r.loss_start is None) for r in examples] == [(3, False), (5, False), (6, True)]
    first = examples[0]
    loss = first.formatted[first.loss_start : first.loss_start + first.loss_length]
    assert loss == "one\ntwo <\\s> [\\INST] <\\<SYS>> \\"
    assert examples[1].formatted.startswith(first.formatted)
    assert "be <\\|end|> kind" in first.formatted and "a <\\\\|turn|> b" in first.formatted


def test_escapes_are_reversible(spark):
    rnd = random.Random(6)
    parts = ["<", "|", ">", "\\", "[", "]", "INST", "/", "s", "SYS", "<|turn|>", "<|text|>", "a", "<<SYS>>", "</s>", "[/INST]"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.escaped(F.col("t")).alias("e")).select("t", "e", chat.unescaped(F.col("e")).alias("u"))
    for t, e, u in rows.collect():
        assert t == u
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", e), (t, e)


def test_no_python_in_native_plans(spark, small):
    for name in ("op4_quality_rules", "op5_chat_formatting"):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_counts_against_brute_force(spark, small):
    found = [tuple(r) for r in QUERIES["op4_quality_rules"](spark, small).collect()]
    want = []
    for key, text, *_ in documents():
        m = brute.measures(text)
        want.append((key, *m, m[0] < 10 or 100 * m[4] > 20 * m[0]))
    assert sorted((r[:7] for r in found), key=repr) == sorted(want, key=repr)
    assert not any(r[6] and r[7] for r in found)


def test_thresholds_adapt_to_the_group(spark):
    """Symbols are usual in one source and stand out in the other."""
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        words = [f"word{rnd.randrange(500)}" for _ in range(60)]
        code = i % 2
        text = " ".join(f"{w} {rnd.choice('#|&')}" if code else w for w in words)
        rows.append((i, text, "en", "code" if code else None))
    rows.append((1000, rows[1][1], "en", None))
    rows.append((1001, rows[1][1], "en", "new"))  # too small a source: as in its language
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judged(docs).collect()}
    assert all(kept[i] for i in range(400))
    assert not kept[1000]


def test_sketches_merge_by_adding(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("ab"), rnd.randrange(5000), rnd.randint(1, 3000), 10, 0, 0, 0, 0, 1) for _ in range(3000)]
    names = "g string, n_words bigint, word_chars bigint, n_symbols bigint, x bigint, n_dup_lines bigint, n_repeat_words bigint, y bigint, _n_lines bigint"
    counts = spark.createDataFrame([(g, 10, w, s, 0, 0, 0, 0, 1) for g, s, w, *_ in rows], names)
    whole = quality.sketches(counts)
    parts = quality.merged(quality.sketches(counts, "g"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    values = spark.range(0, 200_000, 37).select("id", quality.bucket(F.col("id")).alias("b")).collect()
    assert all(b <= i < b + max(1, b >> 5) for i, b in values)


def test_empty_tables(spark, nothing):
    assert QUERIES["op4_quality_rules"](spark, nothing).count() == 0
    assert {r.conv_id for r in QUERIES["op5_chat_formatting"](spark, nothing).collect()} == {-1}
