import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import brute
from tables_llm import documents
from plazaflow.llm import bpe, recount
from plazaflow.llm.queries import QUERIES, RANKS

RANK_TABLE = bpe.read_ranks(RANKS)
REFERENCE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANK_TABLE, special_tokens={}
)
PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "ß", "漢", "😀", "1", "'s", "'", "!", "\x1c", "ing", "\r\n", "ك", "़", "²"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(RANK_TABLE, public_tokenizers.PATTERN)


def ids(found):
    return np.frombuffer(found, np.int32).tolist()


def test_equals_the_library_on_random_texts(encoder):
    rnd = random.Random(3)
    for _ in range(2000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 40)))
        assert ids(encoder.encode(text)) == REFERENCE.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 3000, " " * 2000, "é" * 900, "=-" * 700, "漢" * 500])
def test_long_pieces(encoder, text):
    assert ids(encoder.encode(text)) == REFERENCE.encode_ordinary(text)


def test_a_full_table_is_begun_anew():
    transducer = bpe.Transducer(RANK_TABLE, max_transitions=50)
    for word in ("stone", "riverbank", "unquestionably", "Straßenbahn", "stone") * 3:
        assert ids(transducer(word.encode())) == REFERENCE.encode_ordinary(word)
    assert len(transducer.moves) < 120


def test_stable_pairs_are_those_that_merging_leaves_alone():
    ranks = dict(list(RANK_TABLE.items())[:1500])
    transducer = bpe.Transducer(ranks)
    rnd, tokens = random.Random(5), sorted(transducer.made)
    for _ in range(4000):
        a, b = rnd.choice(tokens), rnd.choice(tokens)
        left, right = transducer.bytes_of[a], transducer.bytes_of[b]
        assert transducer.stable(a, b) == (bpe.merged(left + right, ranks) == [left, right])


def test_utf8_stream_in_any_parts():
    rnd = random.Random(9)
    good = "aé漢😀ß".encode()
    for _ in range(3000):
        data = bytes(rnd.choice([rnd.choice(good), rnd.randrange(256)]) for _ in range(rnd.randint(0, 12)))
        stream, out, at = bpe.Utf8Stream(), "", 0
        while at < len(data):
            step = rnd.randint(1, 4)
            out += stream.feed(data[at : at + step])
            at += step
        assert out + stream.finish() == data.decode(errors="replace"), data


def test_query_against_the_library(spark, small):
    found = sorted(tuple(r) for r in QUERIES["op1_byte_bpe"](spark, small).collect() if r.doc_id is not None)
    wanted = []
    for doc_id, text, *_ in documents():
        if doc_id is not None:
            tokens = REFERENCE.encode_ordinary(text or "")
            wanted.append((doc_id, len(tokens), brute.sha(",".join(map(str, tokens))), brute.sha(text or "")))
    assert found == sorted(wanted)


def test_clashing_columns_and_decoding(spark):
    docs = spark.createDataFrame([(1, "stone river", "x"), (2, None, "y")], "ids bigint, text string, decoded string")
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == ["text", "decoded", "ids"]
    back = bpe.decode(coded, RANKS).collect()
    assert {(r.text, r.decoded) for r in back} == {("stone river", "stone river"), (None, "")}


def test_edits_keep_counts_right(encoder):
    rnd = random.Random(5)
    pieces = [*PIECES, " word", " foo bar baz "]
    for k in range(400):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.choice([0, 1, 5, 40, 300])))
        counted = recount.CountedText(text, encoder)
        for _ in range(rnd.randint(1, 6)):
            a, n = rnd.randint(-2, len(text) + 3), rnd.choice([0, 1, 2, 5, 50, 300])
            new = "".join(rnd.choice(pieces) for _ in range(rnd.choice([0, 1, 3, 30, 3000 if k % 40 == 0 else 4])))
            at = min(max(a, 0), len(text))
            text = text[:at] + new + text[at + n :]
            counted.edit(a, n, new)
            assert "".join(counted.texts) == text
            assert counted.tokens == len(REFERENCE.encode_ordinary(text))
            assert sum(x["tokens"] for x in counted.leaves()) == counted.tokens


def test_an_edit_encodes_little_and_leaves_can_be_kept(encoder):
    text = " ".join(random.Random(2).choice(["stone", "river", "walks"]) for _ in range(20_000))
    first = recount.CountedText(text, encoder)
    kept = [x["chars"] for x in first.leaves()], [x["tokens"] for x in first.leaves()]
    again = recount.CountedText(text, encoder, kept)
    again.edit(50_000, 5, "copper")
    assert 0 < again.encoded < 4 * recount.LEAF_CHARS
    assert again.tokens == len(REFERENCE.encode_ordinary(text[:50_000] + "copper" + text[50_005:]))


def test_recount_query(spark, small):
    rows = {r.doc_id: r for r in QUERIES["op6_edit_recount"](spark, small).collect()}
    assert len(rows) == len({r[0] for r in documents()})
    for doc_id, text, *_ in documents():
        if doc_id is not None:
            assert rows[doc_id].n_tokens == len(REFERENCE.encode_ordinary(text or ""))
    assert rows[106].reencoded_chars < 5000


def test_recount_with_a_table_of_edits(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "same")], "doc_id bigint, text string")
    edits = spark.createDataFrame(
        [(1, 2, 0, 3, "1"), (1, 1, 4, 3, "zwei"), (2, 1, 9, 9, "new")],
        "doc_id bigint, seq int, start bigint, length bigint, text string",
    )
    found = recount.edited(recount.with_edits(docs, edits), RANKS, public_tokenizers.PATTERN).collect()
    texts = {r.doc_id: r.recount.text for r in found}
    assert texts == {1: "1 zwei three", 2: "new", 3: "same"}
    for r in found:
        assert r.recount.n_tokens_after == len(REFERENCE.encode_ordinary(texts[r.doc_id]))


def test_empty_tables(spark, nothing):
    assert QUERIES["op1_byte_bpe"](spark, nothing).count() == 0
    assert QUERIES["op6_edit_recount"](spark, nothing).count() == 0


def test_a_full_table_keeps_its_recent_half():
    """What was asked for lately is not computed again when rare texts fill the table."""
    asked = []
    table = bpe._Recent(lambda x: asked.append(x) or x.encode(), 10)
    for i in range(100):
        assert table["common"] == b"common" and table[f"rare {i}"] == f"rare {i}".encode()
        assert len(table) + len(table.older) <= 10
    assert asked.count("common") == 1
    assert table["x" * 65] == b"x" * 65 and "x" * 65 not in table


def test_plain_words_are_cut_as_the_pattern_cuts_them(encoder):
    rnd = random.Random(11)
    letters = "abcxyzABZÀÖØöøÿéßªµ×÷ſ"
    for _ in range(2000):
        words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) + rnd.choice(["", ",", "?!", "..", "'s"]) for _ in range(4)]
        text = " ".join(words)
        assert ids(encoder.encode(text)) == REFERENCE.encode_ordinary(text), repr(text)


def test_a_table_is_packed_and_a_share_of_it_gives_the_same_ids(monkeypatch):
    """States are bytes and transitions numbers; with a share of the table it is bounded by that share."""
    monkeypatch.setattr(bpe, "MAX_TRANSITIONS", 400)
    monkeypatch.setattr(bpe, "MAX_STRETCHES", 40)
    small = bpe.Encoder(RANK_TABLE, public_tokenizers.PATTERN, share=0.25)
    rnd = random.Random(13)
    for _ in range(60):
        text = " ".join("".join(rnd.choice("aeilnorstu") for _ in range(7)) for _ in range(5))
        assert ids(small.encode(text)) == REFERENCE.encode_ordinary(text)
        assert len(small.later) + len(small.later.older) <= 10
        assert len(small.transducer.moves) <= 100 + 10
    assert all(type(x) is bytes for x in small.transducer.states)
    assert all(type(x) is int for x in small.transducer.moves.values())
