"""Masked pseudo-likelihood by a bidirectional window network.

Every token is predicted from the two tokens before and the two after it: their embeddings, one table for
each place, are summed, bent by tanh, and predict first the class of the token, then the token within the
class. The score of a text is the sum of the log-probabilities of its tokens, each given both sides.

Tokens of the network are the most frequent words, counted over all texts, and `BUCKETS` hash buckets for all
others; words are runs of ASCII letters, digits and bytes beyond ASCII, in lower case. A word of a bucket has the
bucket's probability times its own share of the words counted there, so the probabilities of all counted words,
and of the words never counted, add up to 1. Counts of up to `max_broadcast` of the more frequent words are
broadcast; the others stay a table, which the words of the texts are joined with.

Training goes over every text once, in `rounds` parts by a hash of the text. In each round every task
starts from the same broadcast weights and runs Adagrad over its texts of that part; the weights are
then averaged by the number of tokens each task saw. Sums are formed by Spark; the driver gets one
set of weights, whose size does not depend on the data. The order of texts within partitions and the
partitions themselves have a small influence on the result.

Defined cases: a null text, or one without words, has no tokens, score 0 and a null mean; without any
token the weights stay as they were drawn. Every input row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.spans import ALNUM, Run, runs, signed
from plazaflow.llm.tables import settled, with_text

CLASSES = 32
PER_CLASS = 32
TOKENS = CLASSES * PER_CLASS
BUCKETS = 64
PAD = TOKENS
WIDTH = 16
PLACES = (-2, -1, 1, 2)
STEP = 4096  # tokens of a training step
RATE = 0.05
FIRST = 1e-6  # squared gradients that Adagrad starts from
ROUNDS = 3
SEED = 41
BLOCK = 4096
COUNTED_AT_ONCE = 2_000_000  # words of a task
MAX_BROADCAST = 1 << 18
UNSEEN = 0.5  # what all words of a bucket that were never counted count together
# Names beside documents, which may have columns of any other name.
KEY, FAR = "_key_of_lm", "_far_of_lm"

SHAPES = {
    "embed": (len(PLACES), TOKENS + 1, WIDTH),
    "to_class": (WIDTH, CLASSES),
    "class_bias": (CLASSES,),
    "to_token": (CLASSES, WIDTH, PER_CLASS),
    "token_bias": (CLASSES, PER_CLASS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The weights by name, sharing memory with the flat array."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def drawn() -> np.ndarray:
    return np.random.default_rng(SEED).normal(0, 0.1, SIZE).astype(np.float32)


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word hash occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            words, counts = np.unique(np.concatenate(hashes), return_counts=True)
            columns = [pa.array(signed(words)), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, ["word", "count"])

        hashes, size = [], 0
        for batch in batches:
            for part in runs(batch.column(0), ALNUM):
                hashes.append(part.hash)
                size += len(part.hash)
                if size >= COUNTED_AT_ONCE:
                    yield counted()
                    hashes, size = [], 0
        if size:
            yield counted()

    found = docs.mapInArrow(run, "word bigint, count bigint")
    return found.groupBy("word").agg(F.sum("count").alias("count"))


@dataclass(frozen=True)
class Words:
    hashes: np.ndarray  # of the most frequent words, sorted
    ranks: np.ndarray  # the token of each
    near: np.ndarray  # hashes of words whose counts are broadcast, sorted
    near_logs: np.ndarray  # the logarithms of their counts
    totals: np.ndarray  # by bucket, what all its words count
    counts: DataFrame | None  # of all words; None where `near` has them all


def vocabulary(counts: DataFrame, max_broadcast: int = MAX_BROADCAST) -> Words:
    """The most frequent words by rank, and the counts that the shares of all others come from."""
    counts = settled(counts)
    top = counts.orderBy(F.desc("count"), "word").limit(TOKENS - BUCKETS).toPandas()
    hashes = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    bucket = F.col("word").bitwiseAND(F.lit(BUCKETS - 1).cast("bigint"))
    sums = counts.groupBy(bucket.alias("bucket")).agg(F.sum("count").alias("n")).toPandas()
    totals = np.zeros(BUCKETS, dtype=np.int64)
    totals[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    np.subtract.at(totals, (hashes % np.uint64(BUCKETS)).astype(np.int64), top["count"].to_numpy(np.int64))
    # Of words that are counted equally often all are broadcast or none.
    often = counts.groupBy("count").agg(F.count("*").alias("n")).toPandas().sort_values("count", ascending=False)
    fit = often[often["n"].cumsum() <= max_broadcast]
    least = int(fit["count"].min()) if len(fit) else None
    near = (counts.where(F.col("count") >= least) if len(fit) else counts.limit(0)).toPandas().sort_values("word")
    near_hashes = near["word"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(near_hashes)
    return Words(
        hashes[order],
        order,
        near_hashes[by_hash],
        np.log(near["count"].to_numpy(np.float64)[by_hash]),
        totals,
        None if len(fit) == len(often) else counts,
    )


def tokens_of(run: Run, words: Words) -> np.ndarray:
    hashes, ranks = words.hashes, words.ranks
    out = (TOKENS - BUCKETS + run.hash % np.uint64(BUCKETS)).astype(np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, run.hash), len(hashes) - 1)
        known = hashes[at] == run.hash
        out[known] = ranks[at[known]]
    return out


def shares(run: Run, tokens: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The logarithm of each word's share of its token, and which words are not in the broadcast
    counts; of theirs, the logarithm of the word's own count is left out."""
    out, far = np.zeros(len(tokens)), np.zeros(len(tokens), dtype=bool)
    rare = np.flatnonzero(tokens >= TOKENS - BUCKETS)
    out[rare] = -np.log(words.totals + UNSEEN)[tokens[rare] - (TOKENS - BUCKETS)]
    unknown = rare
    if len(words.near):
        at = np.minimum(np.searchsorted(words.near, run.hash[rare]), len(words.near) - 1)
        known = words.near[at] == run.hash[rare]
        out[rare[known]] += words.near_logs[at[known]]
        unknown = rare[~known]
    far[unknown] = True
    return out, far


def contexts(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The tokens around each token, by place; PAD beyond the ends of its text."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first, last = bounds[text], bounds[text + 1]
    out = np.full((len(PLACES), len(tokens)), PAD)
    for j, place in enumerate(PLACES):
        at = np.arange(len(tokens)) + place
        inside = (at >= first) & (at < last)
        out[j, inside] = tokens[at[inside]]
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _hidden(w: dict[str, np.ndarray], around: np.ndarray) -> np.ndarray:
    return np.tanh(sum(w["embed"][j][around[j]] for j in range(len(PLACES))))


def _by_class(tokens: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the tokens by class, and (class, first, end) of each class in it."""
    classes = (tokens // PER_CLASS).astype(np.uint8)
    order = np.argsort(classes, kind="stable")
    ends = np.cumsum(np.bincount(classes, minlength=CLASSES))
    return order, [(c, int(a), int(b)) for c, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if b > a]


def log_probabilities(w: dict[str, np.ndarray], around: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Of each token given both its sides."""
    out = np.empty(len(tokens))
    order, classes = _by_class(tokens)
    hidden = _hidden(w, around[:, order])
    p_class = _softmax(hidden @ w["to_class"] + w["class_bias"])
    for c, a, b in classes:
        p = _softmax(hidden[a:b] @ w["to_token"][c] + w["token_bias"][c])
        own = tokens[order[a:b]] % PER_CLASS
        out[order[a:b]] = np.log(p_class[a:b, c]) + np.log(p[np.arange(b - a), own])
    return out


class Trainer:
    def __init__(self, flat: np.ndarray):
        self.flat = flat.copy()
        self.w, self.past = views(self.flat), views(np.full(SIZE, FIRST, dtype=np.float32))

    def _move(self, name: str, at, gradient: np.ndarray) -> None:
        past = self.past[name]
        past[at] += gradient * gradient
        self.w[name][at] -= RATE * gradient / np.sqrt(past[at])

    def step(self, around: np.ndarray, tokens: np.ndarray) -> None:
        order, classes = _by_class(tokens)
        around, tokens, scale = around[:, order], tokens[order], np.float32(1 / len(tokens))
        hidden = _hidden(self.w, around)
        error = _softmax(hidden @ self.w["to_class"] + self.w["class_bias"])
        error[np.arange(len(tokens)), tokens // PER_CLASS] -= 1
        back = error @ self.w["to_class"].T
        self._move("to_class", ..., hidden.T @ error * scale)
        self._move("class_bias", ..., error.sum(axis=0) * scale)
        for c, a, b in classes:
            error = _softmax(hidden[a:b] @ self.w["to_token"][c] + self.w["token_bias"][c])
            error[np.arange(b - a), tokens[a:b] % PER_CLASS] -= 1
            back[a:b] += error @ self.w["to_token"][c].T
            self._move("to_token", c, hidden[a:b].T @ error * scale)
            self._move("token_bias", c, error.sum(axis=0) * scale)
        back *= (1 - hidden * hidden) * scale
        for j in range(len(PLACES)):
            by_token = np.argsort(around[j].astype(np.uint16), kind="stable")
            own = around[j][by_token]
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            self._move("embed", (j, own[starts]), np.add.reduceat(back[by_token], starts, axis=0))


def _round(docs: DataFrame, words, weights: np.ndarray) -> np.ndarray:
    shared = docs.sparkSession.sparkContext.broadcast((replace(words, counts=None), weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start = shared.value
        trainer, seen = Trainer(start), 0
        for batch in batches:
            for part in runs(batch.column(0), ALNUM):
                tokens = tokens_of(part, words)
                around = contexts(tokens, part.bounds)
                for a in range(0, len(tokens), STEP):
                    trainer.step(around[:, a : a + STEP], tokens[a : a + STEP])
                seen += len(tokens)
        if seen:
            flat = trainer.flat.astype(np.float64) * seen
            blocks = [flat[a : a + BLOCK] for a in range(0, SIZE, BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([seen] * len(blocks)), pa.array(blocks)],
                ["block", "seen", "weights"],
            )

    parts = docs.mapInArrow(run, "block int, seen bigint, weights array<double>")
    sums = (
        parts.select("block", "seen", F.posexplode("weights").alias("place", "weight"))
        .groupBy("block", "place")
        .agg((F.sum("weight") / F.sum("seen")).alias("weight"))
        .toPandas()
    )
    if not len(sums):
        return weights
    out = weights.copy()
    out[sums["block"].to_numpy() * BLOCK + sums["place"].to_numpy()] = sums["weight"].to_numpy()
    return out


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, max_broadcast: int = MAX_BROADCAST):
    """The vocabulary and the weights, from all texts."""
    texts = docs.select(F.col(text_col).cast("string").alias("_text")).where("_text is not null")
    words, weights = vocabulary(word_counts(texts), max_broadcast), drawn()
    for i in range(rounds):
        part = texts.where(F.pmod(F.xxhash64("_text"), F.lit(rounds)) == i)
        weights = _round(part, words, weights)
    return words, weights


def _far_means(texts: DataFrame, shared, counts: DataFrame) -> DataFrame:
    """By text key, the mean logarithm of the counts of a text's words that were not broadcast. Copies
    of a text do not change its mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, _ = shared.value
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for part in runs(batch.column(1), ALNUM):
                _, far = shares(part, tokens_of(part, words), words)
                doc = np.repeat(np.arange(part.n), np.diff(part.bounds))[far]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part.first + doc]), pa.array(signed(part.hash[far]))], ["text_key", "word"]
                )

    found = texts.mapInArrow(run, "text_key bigint, word bigint").join(counts, "word", "left")
    own = F.log(F.coalesce(F.col("count").cast("double"), F.lit(UNSEEN)))
    # Another key than the one grouped by, so that the join with the texts can be split where it is skewed.
    return found.groupBy("text_key").agg(F.avg(own).alias(FAR)).select(F.xxhash64("text_key").alias(KEY), FAR)


def scored(docs: DataFrame, model, column: str = "lm", text_col: str = "text") -> DataFrame:
    """All columns of `docs` and a struct `column`: n_tokens, log_likelihood and its mean."""
    docs = docs.drop(column)
    kept, (given, text) = docs.columns, with_text(docs, text_col)
    vocabulary, weights = model
    shared = docs.sparkSession.sparkContext.broadcast((replace(vocabulary, counts=None), weights))
    counts, by_join = vocabulary.counts, vocabulary.counts is not None
    kind = pa.struct([("n_tokens", pa.int64()), ("log_likelihood", pa.float64()), ("n_far", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, flat = shared.value
        w = views(flat)
        for batch in batches:
            sizes, sums, left = [], [], []
            for part in runs(batch.column(batch.schema.get_field_index(text)), ALNUM):
                tokens = tokens_of(part, words)
                around = contexts(tokens, part.bounds)
                logs, far = shares(part, tokens, words)
                if not by_join:
                    logs[far] += np.log(UNSEEN)
                for a in range(0, len(tokens), STEP):
                    logs[a : a + STEP] += log_probabilities(w, around[:, a : a + STEP], tokens[a : a + STEP])
                sums.append(np.diff(np.concatenate(([0.0], np.cumsum(logs)))[part.bounds]))
                left.append(np.diff(np.concatenate(([0], np.cumsum(far)))[part.bounds]))
                sizes.append(np.diff(part.bounds))
            n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            value = np.concatenate(sums) if sums else np.zeros(0)
            n_far = np.concatenate(left) if left else np.zeros(0, np.int64)
            columns = [pa.array(n, pa.int64()), pa.array(value), pa.array(n_far, pa.int64())]
            rows = pa.StructArray.from_arrays(columns, fields=list(kind))
            yield batch.select(names).append_column(column, rows)

    key = F.xxhash64(F.xxhash64(F.col(text)))
    names = [*kept, KEY] if by_join else kept
    keyed = given.withColumn(KEY, key) if by_join else given
    fields = [f for f in keyed.schema if f.name in names]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    found = keyed.mapInArrow(run, f"{schema}, `{column}` struct<n_tokens:bigint,log_likelihood:double,n_far:bigint>")
    value = F.col(column)["log_likelihood"]
    if by_join:
        texts = given.select(F.xxhash64(F.col(text)).alias("text_key"), F.col(text)).where(F.col(text).isNotNull())
        found = found.join(_far_means(texts, shared, counts), KEY, "left")
        value += F.when(F.col(column)["n_far"] > 0, F.col(column)["n_far"] * F.col(FAR)).otherwise(F.lit(0.0))
    n = F.col(column)["n_tokens"]
    out = F.struct(n.alias("n_tokens"), value.alias("log_likelihood"), F.when(n > 0, value / n).alias("mean"))
    return found.select(*(f"`{x}`" for x in kept), out.alias(column))
