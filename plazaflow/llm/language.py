"""Language proportions of texts by expectation-maximisation over n-gram likelihoods.

Training counts hashed byte 4-grams of words (ASCII lower case, anything but letters as a blank) for
each language over all labelled texts. A model is `BINS` smoothed log-probabilities for each
language. All languages are kept; beyond `MAX_LANGUAGES` each has fewer bins, so that the model stays
as large until bins are down to 2^LEAST_BITS.

A text is cut in stretches of `WORDS` words. Each stretch is taken to be in one language, and the text
to be a mixture of languages in unknown proportions, which expectation-maximisation estimates. The
set of languages is chosen by penalised likelihood (Bayesian information criterion) among the
likeliest one, two, ... languages. The language with the largest proportion is predicted.

`score` is that proportion, times the posterior of the language against the others where it is alone.

Defined cases: a null text, or one without a letter, is `und` with score 0 and no proportions; so is
every text if nothing was learnt. Rows with a null language are not learnt from. Ties go to the
language first in order. Every input row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.spans import LOWER, Run, byte_table, runs
from plazaflow.llm.tables import with_text

UNKNOWN = "und"
BIN_BITS = 17
BINS = 1 << BIN_BITS
WORDS = 4
ROUNDS = 12
SMOOTHING = 0.5
MINOR = 0.02  # a text whose further languages have smaller proportions is not tried with more than one
MAX_LANGUAGES = 64  # with all bins
LEAST_BITS = 10

LETTERS = byte_table(bytes(b for b in range(128) if not chr(b).isalpha()))
FOLDED = np.where(LETTERS, LOWER, 32).astype(np.uint8)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # by language and bin


def bin_bits(languages: int) -> int:
    """So many bits number the bins of each of so many languages."""
    bits = BIN_BITS
    while bits > LEAST_BITS and languages << bits > MAX_LANGUAGES << BIN_BITS:
        bits -= 1
    return bits


def _bins(run: Run, bits: int = BIN_BITS) -> np.ndarray:
    """The bin of the 4-gram that starts at each byte, with blanks beyond the end of a text; only
    grams that start in words are used."""
    data = FOLDED[run.data].astype(np.uint32)
    grams, ends = data.copy(), run.cuts[1:]
    for j in (1, 2, 3):
        later = np.full(len(data), 32, dtype=np.uint32)
        later[: len(data) - j] = data[j:]
        for back in range(1, j + 1):
            later[ends[ends >= back] - back] = 32
        grams |= later << np.uint32(8 * j)
    return (grams * np.uint32(2654435761)) >> np.uint32(32 - bits)


def _counts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for name, total in totals.items():
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some)), pa.array(some), pa.array(total[some])],
                    ["lang", "bin", "count"],
                )
            totals.clear()

        for batch in batches:
            names = batch.column(1).to_pylist()
            for part in runs(batch.column(0), LETTERS):
                bins, inside = _bins(part), LETTERS[part.data]
                for i in range(part.n):
                    a, b = part.cuts[i], part.cuts[i + 1]
                    own = bins[a:b][inside[a:b]]
                    name = names[part.first + i]
                    if name not in totals:
                        if len(totals) == MAX_LANGUAGES:
                            yield from counted()
                        totals[name] = np.zeros(BINS, np.int64)
                    total = totals[name]
                    if len(own) < BINS // 8:
                        np.add.at(total, own, 1)
                    else:
                        total += np.bincount(own, minlength=BINS)
        yield from counted()

    found = docs.mapInArrow(run, "lang string, bin bigint, count bigint")
    return found.groupBy("lang", "bin").agg(F.sum("count").alias("count"))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the texts whose language is not null."""
    labelled = docs.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
    counts = _counts(labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())).persist()
    try:
        languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
        bits = bin_bits(len(languages))
        if bits < BIN_BITS:
            # A bin of fewer bits is the first bits of the others.
            folded = F.shiftright("bin", BIN_BITS - bits).alias("bin")
            rows = counts.groupBy("lang", folded).agg(F.sum("count").alias("count")).toPandas()
        else:
            rows = counts.toPandas()
    finally:
        counts.unpersist()
    table = np.full((len(languages), 1 << bits), SMOOTHING)
    place = {x: i for i, x in enumerate(languages)}
    table[rows["lang"].map(place).to_numpy(np.int64), rows["bin"].to_numpy(np.int64)] += rows["count"]
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _mixed(likelihood: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each text. `likelihood` is by stretch and language, the
    stretches of text i begin at starts[i], and `allowed` marks each text's languages."""
    sizes = np.diff(np.append(starts, len(likelihood)))
    text = np.repeat(np.arange(len(starts)), sizes)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = likelihood * share[text]
        joint /= joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint, starts, axis=0) / sizes[:, None]
    total = (likelihood * share[text]).sum(axis=1)
    return share, np.add.reduceat(np.log(total), starts)


def proportions(run: Run, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and score of each text of a run; all zero where nothing is known."""
    k = len(model.languages)
    share, score = np.zeros((run.n, k)), np.zeros(run.n)
    words = np.diff(run.bounds)
    texts = np.flatnonzero(words)
    if not len(texts) or not k:
        return share, score
    text_of_word = np.repeat(np.arange(run.n), words)
    first_word = (np.arange(len(run.start)) - run.bounds[text_of_word]) % WORDS == 0
    begins = run.start[first_word]
    bins, inside = _bins(run, bin_bits(k)), LETTERS[run.data]
    logs = np.empty((len(begins), k))
    for i in range(k):
        logs[:, i] = np.add.reduceat(np.where(inside, model.log_p[i][bins], 0), begins)
    starts = np.flatnonzero(np.diff(text_of_word[first_word], prepend=-1))
    alone = np.add.reduceat(logs, starts, axis=0)
    # Floored, so that no stretch can make all languages of a set impossible.
    likelihood = np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -50))
    best = alone.argmax(axis=1)
    share[texts, best] = 1
    score[texts] = 1 / np.exp(alone - alone.max(axis=1, keepdims=True)).sum(axis=1)
    if k == 1:
        return share, score

    full, _ = _mixed(likelihood, starts, np.ones((len(texts), k)))
    order = np.argsort(-full, axis=1, kind="stable")
    ends = np.append(starts[1:], len(likelihood))
    tried = np.flatnonzero(np.sort(full, axis=1)[:, -2] > MINOR)
    if not len(tried):
        return share, score
    rows = np.concatenate([np.arange(starts[i], ends[i]) for i in tried])
    sizes = ends[tried] - starts[tried]
    part, begin = likelihood[rows], np.concatenate(([0], np.cumsum(sizes)[:-1]))
    penalty = np.log(sizes) / 2
    single = np.zeros((len(tried), k))
    single[np.arange(len(tried)), best[tried]] = 1
    shares, value = _mixed(part, begin, single)
    for size in range(2, k + 1):
        allowed = np.zeros((len(tried), k))
        np.put_along_axis(allowed, order[tried, :size], 1, axis=1)
        other, likely = _mixed(part, begin, allowed)
        better = likely - penalty * (size - 1) > value
        value[better] = (likely - penalty * (size - 1))[better]
        shares[better] = other[better]
        if not better.any():
            break
    mixed = shares.max(axis=1) < 1
    share[texts[tried[mixed]]] = shares[mixed]
    score[texts[tried[mixed]]] = shares[mixed].max(axis=1)
    return share, score


def identified(docs: DataFrame, model: Model, column: str = "language", text_col: str = "text") -> DataFrame:
    """All columns of `docs` and a struct `column`: lang, score, and the proportions of the
    languages in the chosen set."""
    docs = docs.drop(column)
    kept, (given, text) = docs.columns, with_text(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct(
        [
            ("lang", pa.string()),
            ("score", pa.float64()),
            ("proportions", pa.map_(pa.string(), pa.float64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            rows = []
            for part in runs(texts, LETTERS):
                for i, (share, score) in enumerate(zip(*proportions(part, own))):
                    # Bytes beyond ASCII count as letters above; a text may hold none all the same.
                    known = share.any() and any(map(str.isalpha, texts[part.first + i].as_py()))
                    some = np.flatnonzero(share) if known else []
                    rows.append(
                        {
                            "lang": own.languages[int(share.argmax())] if known else UNKNOWN,
                            "score": float(score) if known else 0.0,
                            "proportions": [(own.languages[j], float(share[j])) for j in some],
                        }
                    )
            yield batch.select(kept).append_column(column, pa.array(rows, kind))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    struct = "struct<lang:string,score:double,proportions:map<string,double>>"
    return given.mapInArrow(run, f"{schema}, `{column}` {struct}")
