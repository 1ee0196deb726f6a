"""Operators that learn: language, toxicity, pseudo-likelihood; and license scans."""

import math
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plazaflow.llm import language, licenses, pseudo, toxicity
from plazaflow.llm.queries import QUERIES
from plazaflow.llm.spans import ALNUM, runs
from plazaflow.llm.tables import load
from tables_llm import GERMAN, WORDS, documents, prose

SF = "/root/testdata/sf0.01"


def held_out(doc_id, parts, rest):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == rest


# -- language ------------------------------------------------------------------------------------


def test_language_query_on_small_tables(spark, small):
    rows = QUERIES["op2_language_mixture"](spark, small).collect()
    assert len(rows) == len(documents())
    by_id = {r.doc_id: r for r in rows}
    for doc_id, text, lang, *_ in documents():
        own = by_id[doc_id]
        assert own.held_out == held_out(doc_id, 3, 1)
        assert 0 <= own.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (own.lang_pred, own.score) == ("und", 0)
        elif doc_id is not None and doc_id < 60:
            assert own.lang_pred == lang


def test_language_accuracy_on_held_out_texts(spark):
    found = QUERIES["op2_language_mixture"](spark, SF)
    known = load(spark, SF, "documents").select("doc_id", "lang").where("lang is not null")
    rows = [r for r in found.join(known, "doc_id").collect() if r.held_out]
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_mixtures_have_the_proportions_of_their_words(spark, small):
    rnd = random.Random(1)
    model = language.train(load(spark, small, "documents").where("doc_id < 90"))
    rows = [(1, prose(rnd, 90) + " " + prose(rnd, 30, GERMAN)), (2, prose(rnd, 80)), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found = {r.doc_id: r.language for r in language.identified(docs, model).collect()}
    assert abs(found[1].proportions["en"] - 0.75) < 0.06 and abs(found[1].proportions["de"] - 0.25) < 0.06
    assert found[2].proportions == {"en": 1.0}
    assert found[3].lang == found[4].lang == "und"


def test_a_text_scores_the_same_among_others(spark, small):
    model = language.train(load(spark, small, "documents"))
    texts = [r[1] for r in documents()]
    among = [s for part in runs(pa.array(texts), language.LETTERS) for s in language.proportions(part, model)[1]]
    for i in (0, 61, 102, 105):
        part = next(runs(pa.array([texts[i]]), language.LETTERS))
        assert language.proportions(part, model)[1][0] == pytest.approx(among[i], abs=1e-6)


def test_no_language_is_left_out(spark):
    rnd = random.Random(9)
    own = [["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for _ in range(70)]
    rows = [(i, " ".join(rnd.choices(own[i], k=40 if i else 12)), f"l{i:02}") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(1)
    model = language.train(docs)
    assert len(model.languages) == 70 and model.log_p.shape == (70, language.BINS // 2)
    np.testing.assert_allclose(np.exp(model.log_p.astype(float)).sum(axis=1), 1, atol=1e-3)
    found = language.identified(docs, model).collect()
    assert [r.doc_id for r in found if r.language.lang != r.lang] == []


# -- toxicity ------------------------------------------------------------------------------------


def brute_segments(scores):
    """All maximal segments by their definition, recursively: the best, then left and right of it."""
    best, span = 0.0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            value = sum(scores[a:b])
            if value > best + 1e-9:
                best, span = value, (a, b)
    if span is None:
        return []
    a, b = span
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return brute_segments(scores[:a]) + [(a, b - 1, best)] + right


def test_segments_of_long_texts_take_linear_time():
    """Scattered words of positive score, no two of which belong together."""
    scores = np.tile([1.0, -0.5, -0.5, -0.5], 100_000)
    start = time.process_time()
    found = toxicity.segments(scores)
    assert time.process_time() - start < 4
    assert found == [(4 * i, 4 * i, 1.0) for i in range(100_000)]
    rising = toxicity.segments(np.tile([1.0, -0.5], 100_000))
    assert rising == [(0, 199_998, 50_000.5)]


def test_labels_are_cut_by_their_hashes(spark):
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    few = [r[0] for r in toxicity._sampled(labels, "doc_id", "toxic", 50).collect()]
    want = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(50).collect()
    assert sorted(few) == sorted(r.doc_id for r in want)
    assert toxicity._sampled(labels, "doc_id", "toxic", 4000).count() == 3000


def test_segments_are_the_maximal_ones():
    rnd = random.Random(2)
    for _ in range(300):
        scores = np.array([rnd.randint(-60, 60) / 8 + rnd.random() / 1000 for _ in range(rnd.randint(0, 14))])
        found = toxicity.segments(scores)
        want = brute_segments(scores.tolist())
        assert [x[:2] for x in found] == [x[:2] for x in want]
        assert [x[2] for x in found] == pytest.approx([x[2] for x in want])


def test_toxicity_finds_planted_passages(spark):
    rnd = random.Random(7)
    bad = ["vile", "rotten", "filthy", "wretch"]
    rows = []
    for i in range(600):
        words = prose(rnd, rnd.randint(30, 200)).split()
        if i % 5 == 0:
            at = rnd.randrange(len(words))
            words[at:at] = rnd.sample(bad, 3)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([*rows, (700, None), (701, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, int(i % 5 == 0)) for i in range(0, 400)] + [(None, 1), (5, None)], "doc_id bigint, toxic int"
    )
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r.toxicity for r in toxicity.scored(docs, model).collect()}
    right = [(found[i].score >= 0.5) == (i % 5 == 0) for i in range(400, 600)]
    assert sum(right) >= 198
    texts = dict(rows)
    for i in range(400, 600, 5):
        spans = {w for p in found[i].passages for w in texts[i].split()[p["first"] : p["last"] + 1]}
        assert spans & set(bad)
    assert found[700].score == found[701].score < 0.5


def test_toxicity_query(spark, small):
    rows = QUERIES["op7_toxicity"](spark, small).collect()
    assert len(rows) == len(documents())
    for r in rows:
        assert r.held_out == held_out(r.doc_id, 5, 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_toxicity_without_labels(spark, small, nothing):
    model = toxicity.train(load(spark, small, "documents"), load(spark, nothing, "labels"))
    assert {r[0] for r in toxicity.scored(load(spark, small, "documents"), model).select("toxicity.score").collect()} == {0.0}


# -- pseudo-likelihood ---------------------------------------------------------------------------


def test_pseudo_likelihood_by_hand(spark, small):
    docs = load(spark, small, "documents").where("doc_id < 106 or doc_id is null")
    words, flat = model = pseudo.train(docs)
    w = {k: v.astype(np.float64) for k, v in pseudo.views(flat).items()}
    for r in pseudo.scored(docs, model, "n_chars").collect():
        part = next(runs(pa.array([r.text]), ALNUM))
        tokens, total = pseudo.tokens_of(part, words).tolist(), 0.0
        for i, token in enumerate(tokens):
            h = sum(
                w["embed"][j][tokens[i + d] if 0 <= i + d < len(tokens) else pseudo.PAD]
                for j, d in enumerate(pseudo.PLACES)
            )
            h, (c, m) = np.tanh(h), divmod(token, pseudo.PER_CLASS)
            for logits, at in (
                (h @ w["to_class"] + w["class_bias"], c),
                (h @ w["to_token"][c] + w["token_bias"][c], m),
            ):
                total += logits[at] - math.log(np.exp(logits).sum())
        assert r.n_chars.n_tokens == len(tokens)
        assert r.n_chars.log_likelihood == pytest.approx(total, abs=1e-3 * (1 + len(tokens)))
        assert (r.n_chars.mean is None) == (not tokens)


def test_training_learns_what_stands_around_a_word(spark):
    rnd = random.Random(3)
    pairs = [(f"left{k}", f"mid{k}", f"right{k}") for k in range(20)]
    rows = [(i, " ".join(w for _ in range(40) for w in rnd.choice(pairs))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = pseudo.train(docs)
    shuffled = [(i, " ".join(rnd.sample(t.split(), len(t.split())))) for i, t in rows[:50]]
    other = spark.createDataFrame(shuffled, "doc_id bigint, text string")

    def mean(df):
        rows = pseudo.scored(df, model).collect()
        return sum(r.lm.log_likelihood for r in rows) / sum(r.lm.n_tokens for r in rows)

    assert mean(docs.limit(50)) > mean(other) + 0.5
    assert mean(docs.limit(50)) > 1.5 - math.log(pseudo.TOKENS)


def test_gradients_against_differences():
    rnd = np.random.default_rng(2)
    flat = pseudo.drawn()
    tokens = rnd.integers(0, pseudo.TOKENS, 50)
    around = pseudo.contexts(tokens, np.array([0, 20, 20, 50]))
    before = pseudo.log_probabilities(pseudo.views(flat), around, tokens).mean()
    trainer = pseudo.Trainer(flat)
    for _ in range(20):
        trainer.step(around, tokens)
    assert pseudo.log_probabilities(trainer.w, around, tokens).mean() > before + 1


def test_every_word_has_a_probability_of_its_own(spark):
    common = [f"w{i}" for i in range(pseudo.TOKENS - pseudo.BUCKETS)]
    rare = [f"r{i}" for i in range(300)]
    rows = [" ".join(common)] * 9 + [" ".join(rare[i:]) for i in (0, 100, 200, 200)]
    docs = spark.createDataFrame([(t,) for t in rows], "text string")
    single = spark.createDataFrame([(w,) for w in [*common, *rare, *rare[:5], "never", "seen"]], "text string")
    found = []
    for most in (10**6, 1000, 0):
        model = pseudo.train(docs, max_broadcast=most)
        assert (model[0].counts is None) == (most == 10**6)
        found.append({r.text: r.lm for r in pseudo.scored(single, model).collect()})
        assert pseudo.scored(single, model).count() == len(common) + len(rare) + 7
        # Words alone in a text stand between the same neighbours, so they and the unseen ones add up to 1.
        p = {t: math.exp(x.log_likelihood) for t, x in found[-1].items()}
        part = next(runs(pa.array(rare), ALNUM))
        buckets = {int(h): t for h, t in zip(part.hash % np.uint64(pseudo.BUCKETS), rare)}
        count = {t: 1 + (int(t[1:]) >= 100) + 2 * (int(t[1:]) >= 200) for t in rare}
        unseen = sum(p[t] * pseudo.UNSEEN / count[t] for t in buckets.values())
        empty = [b for b in range(pseudo.BUCKETS) if b not in buckets]
        w = pseudo.views(model[1])
        around = np.full((len(pseudo.PLACES), len(empty)), pseudo.PAD)
        tokens = np.array(empty, dtype=np.int64) + pseudo.TOKENS - pseudo.BUCKETS
        unseen += np.exp(pseudo.log_probabilities(w, around, tokens)).sum() if empty else 0
        assert sum(p[t] for t in common + rare) + unseen == pytest.approx(1, abs=1e-4)
        own = {int(h): [] for h in part.hash % np.uint64(pseudo.BUCKETS)}
        for h, t in zip(part.hash % np.uint64(pseudo.BUCKETS), rare):
            own[int(h)].append(t)
        for same in own.values():
            for t in same:
                assert p[t] / p[same[0]] == pytest.approx(count[t] / count[same[0]], rel=1e-4)
    for other in found[1:]:
        for t, x in other.items():
            assert x.log_likelihood == pytest.approx(found[0][t].log_likelihood, abs=0.05)


# -- licenses ------------------------------------------------------------------------------------


def brute_lis(values):
    best = [1] * len(values)
    for i in range(len(values)):
        best[i] = 1 + max((best[j] for j in range(i) if values[j] < values[i]), default=0)
    return max(best, default=0)


def test_longest_increasing():
    rnd = random.Random(4)
    for _ in range(300):
        values = rnd.sample(range(50), rnd.randint(0, 12))
        found = licenses.longest_increasing(values)
        assert found == sorted(found) and len(found) == brute_lis(values)
        assert all(values[a] < values[b] for a, b in zip(found, found[1:]))


def test_alignment_is_in_order_and_of_equal_words():
    rnd = random.Random(5)
    for _ in range(300):
        a, b = ([rnd.randrange(12) for _ in range(rnd.randint(0, 20))] for _ in range(2))
        pairs = licenses.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert licenses.aligned(list("abcde"), list("abcde")) == [(i, i) for i in range(5)]


def test_license_scan_finds_repeated_and_edited_notices(spark):
    mit = licenses.TEMPLATES["MIT"]
    notice = licenses.TEMPLATES["MIT-permission"]
    edited = notice.replace("granted", "given").replace("obtaining", "who obtains")
    rows = [
        (1, f"Intro text. {mit} More words in between here. {mit.upper()}"),
        (2, f"the license of the software is {edited} and so on " + "filler " * 500),
        (3, "a license is released under no terms, this much is certain"),
        (4, None),
        (5, ""),
        (6, "word " * 3000 + licenses.TEMPLATES["GPL-3.0"]),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, licenses string")
    found = {r.doc_id: r.licenses for r in licenses.scanned(docs).collect()}
    assert [(x.license, x.first, x.last) for x in found[1]] == [("MIT", 2, 6), ("MIT", 12, 16)]
    assert found[2][0].license == "MIT-permission" and 0.8 <= found[2][0].coverage < 1
    assert not found[3] and not found[4] and not found[5]
    assert (found[6][0].license, found[6][0].first) == ("GPL-3.0", 3000)


def test_license_with_its_missing_word_elsewhere(spark):
    for length in range(1, 200):
        for percent in range(1, 101):
            assert licenses.needed(length, percent / 100) == -(-length * percent // 100)
    gap, ten = " filler" * 40, "one two three four five six seven eight nine ten"
    rows = [
        (1, f"It was released in May.{gap} Distributed under the MIT License."),
        (2, f"Distributed under the MIT License.{gap} It was released in May."),
        (3, f"One and two:{gap} x x three four five six seven eight nine ten"),
        (4, f"One, two and three:{gap} x x x four five six seven eight nine ten"),
        (5, "so so so so so so so so"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    templates = {"MIT": licenses.TEMPLATES["MIT"], "ten": ten, "so": "so so so so so so so so what now"}
    found = {r.doc_id: [(x.license, x.coverage) for x in r.licenses] for r in licenses.scanned(docs, templates).collect()}
    assert found[1] == found[2] == [("MIT", 0.8)]
    assert found[3] == [("ten", 0.8)] and found[4] == [] and found[5] == [("so", 0.8)]


def test_license_query_against_search(spark):
    docs = {r.doc_id: r.text or "" for r in load(spark, SF, "documents").collect()}
    names = ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT")
    for r in QUERIES["op9_license_scan"](spark, SF).collect():
        held = [n for n in names if licenses.TEMPLATES[n] in docs[r.doc_id]]
        if held:
            assert r.license in held and r.coverage == 1.0


def test_empty_tables(spark, nothing):
    for name in ("op2_language_mixture", "op3_pseudo_likelihood", "op7_toxicity", "op9_license_scan"):
        assert QUERIES[name](spark, nothing).count() == 0


def test_words_of_both_languages_are_told_apart():
    assert not set(WORDS) & set(GERMAN)
