"""Packing: every token in one place, no padding, tiers and steps."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tables_llm import documents

from plazaflow.llm import packing
from plazaflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    from tokenizers import Tokenizer

    if not hasattr(ids_of, "it"):
        ids_of.it = Tokenizer.from_file(PATH)
    return [*ids_of.it.encode(text or "", add_special_tokens=False).ids, 1]


def check_sequences(rows):
    """Pieces of a sequence follow each other, and each sequence has a power of two of tokens."""
    sequences = defaultdict(list)
    for r in rows:
        assert r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.SIZE and at & (at - 1) == 0
    return sequences


def test_query_holds_every_token_once(spark, small):
    rows = QUERIES["op12_packing"](spark, small).collect()
    check_sequences(rows)
    want = defaultdict(int)
    for key, text, *_ in documents():
        want[(key, tuple(ids_of(text)))] += 1
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for (key, ids), times in want.items():
        own = sorted((r.start, r.length, r.ids_crc32) for r in pieces.pop(key))
        assert sum(n for _, n, _ in own) == times * len(ids)
        for start, n, crc in own:
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
        covered = sorted(i for start, n, _ in own for i in range(start, start + n))
        assert covered == sorted(list(range(len(ids))) * times)
    assert not pieces


def test_ids_are_given_back(spark):
    texts = ["One two, three.", "", None, "A  b\n\n\tc d é ́x ΑΣ Σ İ it's 'S <|endoftext|> <|endoftext|>. ...", "x." * 5]
    docs = spark.createDataFrame([(str(i), t, 1) for i, t in enumerate(texts)], "key string, body string, ids int")
    rows = packing.packed(docs, PATH, 1, "key", "body").collect()
    for i, text in enumerate(texts):
        own = sorted((r.start, bytes(r.ids)) for r in rows if r.key == str(i))
        assert np.frombuffer(b"".join(b for _, b in own), "<u4").tolist() == ids_of(text), text


def test_words_encode_as_texts_do():
    rnd = random.Random(5)
    parts = [*"abZÉß.,;:!?'-_0 1\n\t́　漢", "'s", "'T", "don't", "...", "ﬁ", "Ω", "  ", "\r\n", "\x1c", "\x85"]
    encoder = packing.WordEncoder(PATH)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)[:-1], repr(text)


def test_a_full_table_of_words_is_renewed(monkeypatch):
    monkeypatch.setattr(packing, "MAX_WORDS", 20)
    encoder = packing.WordEncoder(PATH)
    for k in range(30):
        text = " ".join(f"word{j}, Other{j * k}" for j in range(k))
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids_of(text)[:-1]


@pytest.mark.parametrize("lengths", [[1], [2048], [2049, 1], [5000, 300, 20, 20, 7], [1500] * 40, [3] * 1000, [255] * 9])
def test_packer_fills_windows(lengths):
    packer = packing.Packer(packing.TIERS)
    windows = [w for d, n in enumerate(lengths) for w in packer.add(d, n)]
    windows += packer.pack()
    assert all(size in packing.TIERS for size, _ in windows)
    left = sum(p[0] for p in packer.free)
    assert left < packing.SIZE
    windows += packer.rest()
    seen = defaultdict(list)
    for size, pieces in windows:
        assert sum(p[0] for p in pieces) == size
        for n, d, start in pieces:
            seen[d] += range(start, start + n)
    assert all(sorted(seen[d]) == list(range(n)) for d, n in enumerate(lengths))


def test_pieces_lie_in_the_shortest_window_and_gaps_take_shorter_ones():
    packer = packing.Packer(packing.TIERS)
    for d, n in enumerate([1500, 500, 48, 700, 324]):
        assert not packer.add(d, n)
    windows = [(size, [n for n, _, _ in pieces]) for size, pieces in packer.pack()]
    assert windows == [(2048, [1500, 500, 48]), (1024, [700, 324])]


def test_steps_are_balanced():
    rnd = random.Random(1)
    packer = packing.Packer(packing.TIERS)
    windows = [w for d in range(3000) for w in packer.add(d, rnd.randint(1, 3000))]
    windows += packer.pack()
    tokens, cost = defaultdict(int), defaultdict(int)
    for (size, pieces), step in zip(windows, packing.steps_of(windows, packing.STEP_TOKENS)):
        tokens[step] += size
        cost[step] += sum(p[0] ** 2 for p in pieces)
    assert max(tokens.values()) - min(tokens.values()) <= 256
    assert max(cost.values()) < 1.25 * min(cost.values())


def test_packs_across_pools_without_loss(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 90)) for i in range(500)], "doc_id bigint, text string").coalesce(2)
    rows = packing.packed(docs, PATH, 1, pool_tokens=3000).collect()
    check_sequences(rows)
    assert sum(r.length for r in rows) == sum(i % 90 + 1 for i in range(500))
    assert sum(1 for r in rows if r.context < 256) <= 2 * 8 * 3


def test_nothing(spark, nothing):
    assert QUERIES["op12_packing"](spark, nothing).count() == 0
    with pytest.raises(ValueError):
        packing.packed(spark.createDataFrame([], "doc_id int, text string"), PATH, 1, tiers=(100,))
