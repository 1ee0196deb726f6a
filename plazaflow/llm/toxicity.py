"""Toxic passages as maximum-scoring segments of token log-odds.

Training counts words and their first bytes in labelled texts and gives each the log-odds of toxic
against clean texts, with an informative Dirichlet prior in proportion to its count in both. Those that
stand out by `MIN_Z` standard errors are kept, at most `MAX_LEXICON`. A word scores its own log-odds,
else those of its longest first bytes known, else nothing; every word pays `DRIFT`, so that a segment of
ordinary words scores below zero.

Scoring finds all maximal-scoring segments of a text in one scan. Scores of segments that clean
texts reach by chance follow an extreme-value law whose two parameters are fitted to the best
segments of clean labelled texts, each scored by a lexicon of the other parts; the significant
segments of a text are added up in its units and a logistic curve, fitted to the same texts, turns
the sum into a score.

Labelled texts: at most `max_labelled`, chosen by a hash of their id, so that they can be
broadcast. Scoring covers all texts whole.

Defined cases: a null text, or one without words, scores as one word outside the lexicon. Without a
labelled text of either kind every score is 0. Null labels are not used; of several labels of one id
the largest counts. Every input row gives one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.spans import ALNUM, Run, mix, runs, signed
from plazaflow.llm.tables import with_text

MAX_LABELLED = 32_768
MAX_LEXICON = 100_000
PREFIXES = (5,)  # bytes at the start of a word that count as tokens of their own
PARTS = 4  # the law and the curve are fitted to texts of one part, scored by the other parts
COUNTS = tuple(f"{x}{i}" for i in range(PARTS) for x in "ct")
COUNTED_AT_ONCE = 1_000_000  # words of a batch
PRIOR = 0.1  # weight of the prior against the texts counted
MIN_Z = 2.5
DRIFT = 0.5
SIGNIFICANT = 0.01
PREFIX_SALT = np.uint64(0x2545F4914F6CDD1D)


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # of words and first bytes, sorted
    log_odds: np.ndarray
    scale: float = 1.0  # of the extreme-value law: P(best >= s) = 1 - exp(-k * words * e^(-scale * s))
    k: float = 1.0
    slope: float = 0.0
    offset: float = -math.inf

    def probability(self, x: float) -> float:
        z = self.offset + self.slope * x
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def prefix_hashes(run: Run, size: int) -> np.ndarray:
    """Hashes of the first `size` bytes of each word; they differ from those of words."""
    total = np.full(len(run.start), size, dtype=np.uint64)
    for j in range(size):
        at = run.start + j
        inside = at < run.end
        total = total * np.uint64(257)
        total[inside] += run.data[at[inside]].astype(np.uint64) + np.uint64(1)
    return mix(total + PREFIX_SALT)


def _token_hashes(run: Run) -> list[np.ndarray]:
    """Of first bytes, longer ones later, and of whole words."""
    return [*(prefix_hashes(run, size) for size in PREFIXES), run.hash]


def _word_scores(run: Run, model: Model) -> np.ndarray:
    scores = np.full(len(run.hash), -DRIFT)
    if len(model.hashes) and len(scores):
        for hashes in _token_hashes(run):
            at = np.minimum(np.searchsorted(model.hashes, hashes), len(model.hashes) - 1)
            known = model.hashes[at] == hashes
            scores[known] = model.log_odds[at[known]] - DRIFT
    return scores


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last, score), in order, in linear time.

    Only places of positive score are visited. Each candidate keeps a link to the nearest one before it
    with a smaller sum before its start: the search for that of a new candidate follows links, and
    those that it passes are never looked at again.
    """
    before = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, link
    for i in np.flatnonzero(scores > 0).tolist():
        first, low, high = i, before[i], before[i + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
        found.append((first, i, low, high, j))
    return [(a, b, float(after - left)) for a, b, left, after, _ in found]


def _per_text(texts: pa.Array, model: Model) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Number of words and segments of each text."""
    for run in runs(texts, ALNUM):
        scores = _word_scores(run, model)
        positive = np.concatenate(([0], np.cumsum(scores > 0)))
        for i in range(run.n):
            a, b = int(run.bounds[i]), int(run.bounds[i + 1])
            some = positive[b] > positive[a]
            yield b - a, segments(scores[a:b]) if some else []


def _statistic(words: int, found: list[tuple[int, int, float]], model: Model) -> float:
    """Significant segments added up, each by how far it is beyond chance; else the best one."""
    chance = math.log(model.k * max(words, 1))
    beyond = [model.scale * x[2] - chance for x in found] or [-chance]
    least = -math.log(SIGNIFICANT)
    strong = [x for x in beyond if x > least]
    return sum(strong) if strong else max(beyond)


def _sampled(labels: DataFrame, id_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """The labels with the smallest hashes of their ids.

    Where there are many more, those of hashes beyond the share wanted, and a margin, go first: then
    a task has few left to hand on, however many tasks there are.
    """
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label_col)).cast("int").alias("_label"))
    )
    share = (max_labelled + 8 * math.sqrt(max_labelled) + 8) / max(known.count(), 1)
    if share < 1:
        known = known.where(F.xxhash64("_id") < int(share * 2**64) - 2**63)
    return known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)


def _counts(labelled: DataFrame) -> DataFrame:
    """How often each word and first bytes stand in the clean (c) and toxic (t) texts of each part."""

    def counted(hashes: list[np.ndarray], groups: list[np.ndarray]) -> pa.RecordBatch:
        values, place = np.unique(np.concatenate(hashes), return_inverse=True)
        width = 2 * PARTS
        counts = np.bincount(place * width + np.concatenate(groups), minlength=width * len(values))
        counts = counts.reshape(-1, width).T
        columns = [pa.array(signed(values)), *(pa.array(np.ascontiguousarray(x)) for x in counts)]
        return pa.RecordBatch.from_arrays(columns, ["token", *COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64) != 0
            group = 2 * batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64) + label
            hashes, groups, size = [], [], 0
            for part in runs(batch.column(0), ALNUM):
                doc = part.first + np.repeat(np.arange(part.n), np.diff(part.bounds))
                hashes += _token_hashes(part)
                groups += [group[doc]] * (len(PREFIXES) + 1)
                size += len(doc)
                if size >= COUNTED_AT_ONCE:
                    yield counted(hashes, groups)
                    hashes, groups, size = [], [], 0
            if size:
                yield counted(hashes, groups)

    schema = "token bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
    found = labelled.select("_text", "_label", "_part").mapInArrow(run, schema)
    return found.groupBy("token").agg(*(F.sum(c).alias(c) for c in COUNTS))


def _lexicons(counts: DataFrame, max_lexicon: int) -> list[Model]:
    """A lexicon of the texts outside each part, and last one of all texts."""
    everything = counts.agg(*(F.sum(c).alias(c) for c in COUNTS)).first()
    if everything[0] is None:
        return [Model(np.zeros(0, np.uint64), np.zeros(0))] * (PARTS + 1)
    columns = []
    for left_out in range(PARTS + 1):
        used = [i for i in range(PARTS) if i != left_out]
        n_clean, n_toxic = (sum(everything[f"{x}{i}"] for i in used) for x in "ct")
        clean, toxic = (sum((F.col(f"{x}{i}") for i in used[1:]), F.col(f"{x}{used[0]}")) for x in "ct")
        prior = PRIOR * (n_clean + n_toxic)
        own = (clean + toxic) * F.lit(PRIOR)
        t, c = toxic + own, clean + own
        odds = F.log(t / (F.lit(n_toxic + prior) - t)) - F.log(c / (F.lit(n_clean + prior) - c))
        enough = (clean + toxic > 0) & (F.abs(odds) >= F.sqrt(1 / t + 1 / c) * MIN_Z)
        known = F.lit(bool(n_clean and n_toxic)) & enough
        columns.append(F.when(known, odds).alias(f"odds_{left_out}"))
    names = [f"odds_{i}" for i in range(PARTS + 1)]
    rows = (
        counts.select("token", *columns, sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0])).alias("n"))
        .where(F.coalesce(*names).isNotNull())
        .orderBy(F.desc(F.coalesce(*(F.abs(F.col(x)) for x in reversed(names))) * F.sqrt("n")), "token")
        .limit(max_lexicon)
        .toPandas()
    )
    rows["token"] = rows["token"].to_numpy(np.int64).view(np.uint64)
    rows = rows.sort_values("token")
    out = []
    for name in names:
        odds = rows[name].to_numpy(np.float64)
        known = ~np.isnan(odds)
        out.append(Model(rows["token"].to_numpy(np.uint64)[known], odds[known]))
    return out


def _calibrated(model: Model, drawn: list[tuple[int, int, list]]) -> Model:
    """The extreme-value law and the logistic curve, from (label, words, segment scores)."""
    clean = [(w, max((s[2] for s in f), default=0.0)) for y, w, f in drawn if not y]
    if not clean or len(clean) == len(drawn):
        return model
    words, best = (np.array(x, dtype=float) for x in zip(*clean))
    words = np.maximum(words, 1)

    def fit(scale: float) -> tuple[float, float, float]:
        tails = words * np.exp(-scale * best)
        k = len(best) / tails.sum()
        return float((np.log(scale * k * tails) - k * tails).sum()), scale, k

    _, scale, k = max(fit(x) for x in np.linspace(0.1, 2.0, 39))
    model = Model(model.hashes, model.log_odds, scale, k)
    x = np.array([_statistic(w, f, model) for _, w, f in drawn])
    y = np.array([float(bool(label)) for label, _, _ in drawn])
    unit = max(float(np.abs(x).max()), 1e-9)
    # Newton steps for the logistic curve, with a small penalty as classes may not overlap.
    design = np.column_stack([np.minimum(x, 50.0) / min(unit, 50.0), np.ones(len(x))])
    beta, penalty = np.zeros(2), np.diag([1e-2, 1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, design.T @ (y - p) - penalty @ beta)
        beta += step / max(1.0, float(np.abs(step).max()) / 5)
    return Model(
        model.hashes, model.log_odds, scale, k, max(float(beta[0]), 0.0) / min(unit, 50.0), float(beta[1])
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
    max_lexicon: int = MAX_LEXICON,
) -> Model:
    """A model of the labels given; which rows may be learnt from is the caller's choice."""
    picked = F.broadcast(_sampled(labels, id_col, label_col, max_labelled))
    labelled = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    part = F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(PARTS)).cast("int")
    labelled = labelled.join(picked, "_id").withColumn("_part", part)
    counts = _counts(labelled).persist()
    try:
        *lexicons, whole = _lexicons(counts, max_lexicon)
    finally:
        counts.unpersist()
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, lexicon in enumerate(shared.value):
                rows = batch.filter(pa.compute.equal(batch.column(2), part))
                found = list(_per_text(rows.column(0), lexicon))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(1),
                        pa.array([w for w, _ in found], pa.int64()),
                        pa.array([[s[2] for s in f] for _, f in found], pa.list_(pa.float64())),
                    ],
                    ["label", "words", "scores"],
                )

    # At most max_labelled rows of a few numbers.
    drawn = labelled.select("_text", "_label", "_part").mapInArrow(
        best, "label int, words bigint, scores array<double>"
    )
    rows = [(r.label, r.words, [(0, 0, s) for s in r.scores]) for r in drawn.collect()]
    return _calibrated(whole, rows)


def scored(docs: DataFrame, model: Model, column: str = "toxicity", text_col: str = "text") -> DataFrame:
    """All columns of `docs` and a struct `column`: score, and the significant passages as word
    places (first, last) with their score and the chance that a clean text of this length has one."""
    docs = docs.drop(column)
    kept, (given, text) = docs.columns, with_text(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct(
        [("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("chance", pa.float64())]
    )
    kind = pa.struct([("score", pa.float64()), ("passages", pa.list_(passage))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = []
            for words, found in _per_text(batch.column(batch.schema.get_field_index(text)), own):
                passages = []
                for first, last, score in found:
                    expected = own.k * max(words, 1) * math.exp(-own.scale * score)
                    if -math.expm1(-expected) < SIGNIFICANT:
                        passages.append((first, last, score, -math.expm1(-expected)))
                value = own.probability(_statistic(words, found, own))
                names = ("first", "last", "score", "chance")
                rows.append({"score": value, "passages": [dict(zip(names, p)) for p in passages]})
            yield batch.select(kept).append_column(column, pa.array(rows, kind))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    struct = "score double, passages array<struct<first:bigint,last:bigint,score:double,chance:double>>"
    return given.mapInArrow(run, f"{schema}, `{column}` struct<{struct}>")
