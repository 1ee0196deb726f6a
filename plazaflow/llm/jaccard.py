"""Exact Jaccard join on word shingles with signature trees, and the groups its links make.

A text's set holds its distinct runs of `SHINGLE` words (A-Z in lower case); a shorter text, but not
an empty one, is one shingle as a whole. Two texts link when 100 * |intersection| >= 80 * |union|.

1. Texts with the same set are one class from here on, named by a 64-bit digest of the set.
2. Linked sets share one of their first |x| - ceil(0.8 |x|) + 1 shingles in any order common to all
   sets. The order puts frequent shingles last, as counted over all texts, so that passages found
   in many texts rarely meet in a group. Only first shingles that several classes hold go on.
3. Near copies of one text meet many times. In a few turns, each class is first compared with heads
   of the groups it is in, which links most of them without pairing them all.
4. For links between the components of step 3, groups that hold several components are searched by
   signature trees: leaves are classes, inner nodes hold the bitwise OR of the token bitmaps below
   and the range of set sizes. A traversal of node pairs leaves out those whose largest possible
   overlap cannot reach the threshold, and those within one component. A group of more than
   `BLOCK` classes is dealt out as pairs of blocks, so no task holds more than two of them.
5. Every candidate pair is verified by the shingles of both texts.

Nothing is dropped: the order only decides how often classes meet. A set of one class, however many
copies it has, is one row after step 1.

Defined cases: a null text, or one without words, has an empty set and links with nothing; its
component is its own id. Rows with the same id are told apart by their texts; each input row gives one
output row. A component takes the smallest id that is not null; rows without id get it too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.components import connected
from plazaflow.llm.spans import NOT_SPACE, mix, runs, signed
from plazaflow.llm.tables import settled

SHINGLE = 5
PERCENT = 80
BITS = 2048
FANOUT = 8
# Rounds of comparing classes with heads of their groups, and heads that a class meets in each.
TURNS = 2
HEADS = 4
BLOCK = 2048
# Shingles are taken as frequent from this count on within so many shingles of one task; the
# broadcast order holds the most frequent ones, 16 bytes each.
COUNTED_AT_ONCE = 4_000_000
FREQUENT = 4
MAX_ORDERED = 1 << 18
# Classes of a shingle from which on its group is dealt out in parts.
HOT = 50_000
# Ids that a semi-join may broadcast.
MAX_BROADCAST = 1_000_000

SHORT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    for run in runs(texts, NOT_SPACE):
        hashes, _ = run.windows(SHINGLE)
        for i in range(run.n):
            a, b = run.bounds[i], run.bounds[i + 1]
            if b - a >= SHINGLE:
                own = np.sort(hashes[a : b - SHINGLE + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif b > a:
                places = np.arange(1, b - a + 1, dtype=np.uint64) * SHORT
                whole = mix(run.hash[a:b] ^ places).sum(dtype=np.uint64, keepdims=True)
                yield mix(whole + places[-1:])
            else:
                yield np.zeros(0, dtype=np.uint64)


def digest(shingles: np.ndarray) -> int:
    """A digest of the set as a signed 64-bit number."""
    total = mix(shingles ^ SHORT).sum(dtype=np.uint64, keepdims=True)
    return int(signed(mix(total + np.array([len(shingles)], np.uint64) * SHORT))[0])


def first_shingles(shingles: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The part of a set in which any set it links with has a shingle too."""
    n = len(shingles)
    keep = n - (PERCENT * n + 99) // 100 + 1
    values, counts = order
    if len(values):
        at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
        frequency = np.where(values[at] == shingles, counts[at], 0)
        # Hashes are sorted, and so are those of the same frequency after a stable sort.
        shingles = shingles[np.argsort(frequency, kind="stable")]
    return shingles[:keep]


def _classes(docs: DataFrame) -> DataFrame:
    """Rows with `key` null: id, set size, class and bitmap of each text. Others: a shingle and how
    many texts of a task hold it, if that is often."""

    def frequent(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        return values[counts >= FREQUENT], counts[counts >= FREQUENT]

    def batch_of(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(columns), ["id", "n", "class", "bits", "key", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> Iterator[pa.RecordBatch]:
            values, counts = frequent(waiting)
            empty = pa.nulls(len(values), pa.int64())
            bits = pa.nulls(len(values), pa.binary())
            keys, counts = pa.array(signed(values)), pa.array(counts, pa.int64())
            yield batch_of(empty, empty, empty, bits, keys, counts)

        waiting, size = [], 0
        for batch in batches:
            sizes, classes, bits = [], [], []
            for shingles in shingle_sets(batch.column(1)):
                sizes.append(len(shingles))
                classes.append(digest(shingles) if len(shingles) else None)
                bits.append(bitmap(shingles).tobytes())
                waiting.append(shingles)
                size += len(shingles)
                if size >= COUNTED_AT_ONCE:
                    yield from counted()
                    waiting, size = [], 0
            none = pa.nulls(len(sizes), pa.int64())
            yield batch_of(
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(classes, pa.int64()),
                pa.array(bits, pa.binary()),
                none,
                none,
            )
        if waiting:
            yield from counted()

    schema = "id bigint, n bigint, class bigint, bits binary, key bigint, count bigint"
    return docs.mapInArrow(run, schema)


def _order(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and their counts, by shingle; at most MAX_ORDERED."""
    rows = (
        classes.where("key is not null")
        .groupBy("key")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "key")
        .limit(MAX_ORDERED)
        .toPandas()
    )
    values = rows["key"].to_numpy(np.int64).view(np.uint64)
    by_value = np.argsort(values)
    return values[by_value], rows["count"].to_numpy(np.int64)[by_value]


def _postings(docs: DataFrame, shared) -> DataFrame:
    """The first shingles of every class, once in each task. Shingles known to be very frequent
    are dealt out in parts; others have part -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = shared.value, set()
        hot = order[1] >= HOT
        values, parts_of = order[0][hot], order[1][hot] // HOT + 1
        for batch in batches:
            parts, owners = [], []
            for shingles in shingle_sets(batch.column(1)):
                name = digest(shingles) if len(shingles) else None
                if name is None or name in seen:
                    continue
                seen.add(name)
                parts.append(first_shingles(shingles, order))
                owners.append(name)
            if not parts:
                continue
            keys = np.concatenate(parts)
            classes = np.repeat(np.array(owners, np.int64), [len(x) for x in parts])
            part = np.full(len(keys), -1, dtype=np.int32)
            if len(values):
                at = np.minimum(np.searchsorted(values, keys), len(values) - 1)
                own = np.flatnonzero(values[at] == keys)
                part[own] = classes[own].view(np.uint64) % parts_of[at[own]].astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(keys)), pa.array(part), pa.array(classes)], ["key", "part", "class"]
            )

    return docs.select("id", "text").mapInArrow(run, "key bigint, part int, class bigint")


def _texts(docs: DataFrame, rows: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """One text of each class in `wanted`, which are at most so many. Their ids are broadcast while
    they are few; else the texts are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [digest(x) if len(x) else None for x in shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), batch.column(1)], ["class", "text"]
            )

    ids = rows.join(wanted, "class", "left_semi").groupBy("class").agg(F.min("id").alias("head"))
    if most <= MAX_BROADCAST:
        ids = F.broadcast(ids)
    picked = docs.join(ids, docs["id"].eqNullSafe(ids["head"]), "left_semi").select("id", "text")
    # An id may stand at several texts, so classes are taken from the texts themselves.
    known = picked.mapInArrow(run, "class bigint, text string")
    return known.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def overlap_possible(n: np.ndarray, left: list[bytes], m: np.ndarray, right: list[bytes]) -> np.ndarray:
    """Whether sets of these sizes and bitmaps can overlap enough, pair by pair. What two sets share
    sets common bits, but for shingles hidden behind others of their own set."""
    sizes = np.array([min(len(x), len(y)) for x, y in zip(left, right)], dtype=np.int64)
    fit = np.zeros(len(n), dtype=bool)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x, y = (_folded([side[i] for i in at], int(size)) for side in (left, right))
        hidden = np.minimum(n[at] - _ones(x), m[at] - _ones(y))
        most = np.minimum(np.minimum(n[at], m[at]), _ones(x & y) + hidden)
        fit[at] = (100 + PERCENT) * most >= PERCENT * (n[at] + m[at])
    return fit


def _possible(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps leave an overlap that is large enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 4))
            fit = overlap_possible(n, batch.column(3).to_pylist(), m, batch.column(5).to_pylist())
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(fit))

    def side(name: str, column: str) -> DataFrame:
        return signatures.select(F.col("class").alias(name), F.col(column).alias(f"{column}_{name}"))

    n, m = F.col("n_a"), F.col("n_b")
    met = pairs.join(side("a", "n"), "a").join(side("b", "n"), "b")
    met = met.where((100 * n >= PERCENT * m) & (100 * m >= PERCENT * n))
    met = met.join(side("a", "bits"), "a").join(side("b", "bits"), "b")
    return met.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(run, "a bigint, b bigint")


def _folded(bitmaps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps of so many bytes; a larger one is folded, which gives the bitmap of that size."""
    short = [
        x
        if len(x) == size
        else np.bitwise_or.reduce(np.frombuffer(x, np.uint64).reshape(-1, size // 8), axis=0).tobytes()
        for x in bitmaps
    ]
    return np.frombuffer(b"".join(short), np.uint64).reshape(len(bitmaps), size // 8)


def _ones(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def _verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets link, with the size of what they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = [
                (len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)))
                for x, y in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)))
            ]
            n, m, both = np.array(shared, dtype=np.int64).reshape(-1, 3).T
            found = pa.array(100 * both >= PERCENT * (n + m - both))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(both)], ["a", "b", "shared"]
            )
            yield out.filter(found)

    pairs = settled(pairs)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    texts = settled(_texts(docs, rows, wanted, 2 * pairs.count()))
    met = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("left")), "a")
    met = met.join(texts.select(F.col("class").alias("b"), F.col("text").alias("right")), "b")
    return met.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint, shared bigint")


class Tree:
    """Levels of nodes over classes sorted by component and size, FANOUT children each."""

    def __init__(self, names: np.ndarray, groups: np.ndarray, sizes: np.ndarray, bits: np.ndarray):
        order = np.lexsort((names, sizes, groups))
        self.names = names[order]
        self.bits, self.low, self.high = [bits[order]], [sizes[order]], [sizes[order]]
        # Shingles of a set that share a bit with another of its own; the bitmap misses so many.
        hidden = sizes[order] - np.bitwise_count(bits[order]).sum(axis=1, dtype=np.int64)
        self.hidden = [hidden]
        self.first_group, self.last_group = [groups[order]], [groups[order]]
        while len(self.low[-1]) > 1:
            at = np.arange(0, len(self.low[-1]), FANOUT)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], at))
            self.low.append(np.minimum.reduceat(self.low[-1], at))
            self.high.append(np.maximum.reduceat(self.high[-1], at))
            self.hidden.append(np.maximum.reduceat(self.hidden[-1], at))
            self.first_group.append(self.first_group[-1][at])
            ends = np.append(at[1:], len(self.last_group[-1])) - 1
            self.last_group.append(self.last_group[-1][ends])

    def may_link(self, level: int, a: np.ndarray, other: Tree, b: np.ndarray) -> np.ndarray:
        """Whether a class below node a of this tree may link with one below b of the other."""
        low, high, hidden = self.low[level][a], self.high[level][a], self.hidden[level][a]
        other_low, other_high = other.low[level][b], other.high[level][b]
        same = (self.first_group[level][a] == self.last_group[level][a]) & (
            other.first_group[level][b] == other.last_group[level][b]
        )
        same &= self.first_group[level][a] == other.first_group[level][b]
        fit = (100 * high >= PERCENT * other_low) & (100 * other_high >= PERCENT * low) & ~same
        a, b = a[fit], b[fit]
        common = np.bitwise_count(self.bits[level][a] & other.bits[level][b]).sum(axis=1, dtype=np.int64)
        most = np.minimum(high, other_high)[fit]
        most = np.minimum(most, common + np.minimum(hidden[fit], other.hidden[level][b]))
        fit[fit] = (100 + PERCENT) * most >= PERCENT * (low + other_low)[fit]
        return fit


def candidates(tree: Tree, other: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes, one of each tree, that the bounds cannot rule out. Both must be of the
    same height; a tree may be compared with itself, which gives each pair once."""
    level = len(tree.low) - 1
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(tree.low[level])), np.arange(len(other.low[level]))))
    out = []
    todo = [(level, a, b)]
    while todo:
        level, a, b = todo.pop()
        if tree is other:
            a, b = a[a <= b], b[a <= b]
        if len(a) > 4096:  # halves, so that bitmaps gathered at once stay few
            half = len(a) // 2
            todo += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        fit = tree.may_link(level, a, other, b)
        a, b = a[fit], b[fit]
        if not level:
            out.append((a, b) if tree is not other else (a[a < b], b[a < b]))
            continue
        steps = np.arange(FANOUT * FANOUT)
        x = (a[:, None] * FANOUT + steps // FANOUT).ravel()
        y = (b[:, None] * FANOUT + steps % FANOUT).ravel()
        there = (x < len(tree.low[level - 1])) & (y < len(other.low[level - 1]))
        if there.any():
            todo.append((level - 1, x[there], y[there]))
    if not out:
        return tree.names[:0], other.names[:0]
    a, b = (np.concatenate(x) for x in zip(*out))
    return tree.names[a], other.names[b]


def _lift(tree: Tree, height: int) -> None:
    while len(tree.low) < height:
        for levels in (tree.bits, tree.low, tree.high, tree.hidden, tree.first_group, tree.last_group):
            levels.append(levels[-1])


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """At least BITS bits, and two or more for each shingle, so that large sets stay apart."""
    size = max(BITS, 1 << (2 * len(shingles) - 1).bit_length())
    bits = np.zeros(size, dtype=bool)
    bits[shingles & np.uint64(size - 1)] = True
    return np.packbits(bits)


class _Rows:
    """Classes of several groups in order: whatever of a batch belongs to whole groups."""

    columns = ("key", "left", "right", "block", "class", "component", "n", "bits", "keys")

    def __init__(self, batch: pa.RecordBatch):
        for i, name in enumerate(self.columns[:-2]):
            setattr(self, name, batch.column(i).to_numpy(zero_copy_only=False))
        self.whole = batch.column(len(self.columns) - 2).to_pylist()
        self.keys = batch.column(len(self.columns) - 1)
        self.bits = _folded(self.whole, BITS // 8)
        same = np.ones(len(self.key), dtype=bool)
        for x in (self.key, self.left, self.right):
            same[1:] &= x[1:] == x[:-1]
        same[:1] = False
        self.starts = np.flatnonzero(~same)
        self.sizes = np.diff(np.append(self.starts, len(self.key)))

    def tree(self, a: int, b: int, block: int) -> Tree | None:
        rows = a + np.flatnonzero(self.block[a:b] == block)
        if not len(rows):
            return None
        return Tree(rows, self.component[rows], self.n[rows], self.bits[rows])

    def found(self) -> set[tuple[int, int]]:
        """Candidates of all groups, by class, once bitmaps in full size have been compared. Of the
        groups that hold both classes of a pair, only that with the smallest key gives it."""
        names, keys, out = getattr(self, "class").tolist(), self.key.tolist(), set()
        sets: dict[int, frozenset[int]] = {}

        def held(x: int) -> frozenset[int]:
            if x not in sets:
                sets[x] = frozenset(self.keys[x].as_py())
            return sets[x]

        for i, j in (self.small(), *self.large()):
            left, right = ([self.whole[x] for x in side] for side in (i, j))
            fit = overlap_possible(self.n[i], left, self.n[j], right)
            for x, y in zip(i[fit].tolist(), j[fit].tolist()):
                if min(held(x) & held(y)) == keys[x]:
                    out.add((min(names[x], names[y]), max(names[x], names[y])))
        return out

    def small(self) -> tuple[np.ndarray, np.ndarray]:
        """Candidates of groups no larger than a node, compared as leaves of one, all at once."""
        group = np.repeat(np.arange(len(self.starts)), self.sizes)
        open_ = np.repeat((self.sizes <= FANOUT) & (self.left[self.starts] == self.right[self.starts]), self.sizes)
        hidden, found = self.n - _ones(self.bits), []
        for step in range(1, FANOUT):
            i = np.flatnonzero(open_[:-step] & (group[:-step] == group[step:]))
            j = i + step
            fit = (self.component[i] != self.component[j]) & (100 * self.n[i] >= PERCENT * self.n[j])
            fit &= 100 * self.n[j] >= PERCENT * self.n[i]
            i, j = i[fit], j[fit]
            most = _ones(self.bits[i] & self.bits[j]) + np.minimum(hidden[i], hidden[j])
            most = np.minimum(most, np.minimum(self.n[i], self.n[j]))
            fit = (100 + PERCENT) * most >= PERCENT * (self.n[i] + self.n[j])
            found.append((i[fit], j[fit]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def large(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, size in zip(self.starts.tolist(), self.sizes.tolist()):
            left, right = self.left[a], self.right[a]
            if size <= FANOUT and left == right:
                continue
            tree = self.tree(a, a + size, left)
            other = tree if left == right else self.tree(a, a + size, right)
            if tree is None or other is None:
                continue
            height = max(len(tree.low), len(other.low))
            _lift(tree, height)
            _lift(other, height)
            yield candidates(tree, other)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of all groups in a partition that is sorted by group. A group has at most two
    blocks of classes; only the last, perhaps unfinished group of a batch waits for the next."""

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*_Rows(batch).found())) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    waiting = None
    for batch in batches:
        if waiting is not None:
            batch = pa.concat_batches([waiting, batch])
        if not batch.num_rows:
            continue
        last = int(_Rows(batch).starts[-1])
        waiting = batch.slice(last)
        if last:
            yield found(batch.slice(0, last))
    if waiting is not None:
        yield found(waiting)


def _with_components(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return postings.withColumn("component", F.col("class"))
    known = postings.join(labels, "class", "left")
    return known.withColumn("component", F.coalesce("component", "class"))


def _star(known: DataFrame, turn: int) -> DataFrame:
    """Each class with one head of every group it is in, where that is in another component. Which
    class is the head depends on the group, so that a class meets a few different ones."""
    order = F.xxhash64("class", F.pmod("key", F.lit(HEADS)), F.lit(turn))
    heads = known.groupBy("key").agg(F.min_by(F.struct("class", "component"), order).alias("head"))
    return (
        known.join(heads, "key")
        .where(F.col("component") != F.col("head.component"))
        .select(F.least("class", "head.class").alias("a"), F.greatest("class", "head.class").alias("b"))
        .distinct()
    )


def _across(known: DataFrame, signatures: DataFrame) -> DataFrame:
    """Candidate pairs between components: of groups that hold several."""
    groups = (
        known.groupBy("key")
        .agg(F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("size"))
        .where("first < last")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    group = ("key", "left", "right")
    # As many keys as a class has first shingles at most.
    keys = known.groupBy("class").agg(F.collect_list("key").alias("keys"))
    dealt = (
        known.join(groups.select("key", "size"), "key")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("left", F.least("block", "other"))
        .withColumn("right", F.greatest("block", "other"))
        .join(signatures.join(keys, "class"), "class")
        .select(*_Rows.columns)
        .repartition(*group)
        .sortWithinPartitions(*group)
    )
    return dealt.mapInArrow(_search, "a bigint, b bigint").distinct()


def _shared_shingles(docs: DataFrame, shared) -> DataFrame:
    """Key and class of first shingles that several classes hold, one key for each set of classes.

    One shuffle serves all: copies of a class in several tasks, aggregation and join are by the same
    key. Shingles of one passage lead to the same classes again and again; one of them is kept, as
    told by number, sum and exclusive or of the classes' hashes besides the smallest and largest.
    """
    # None is null, but where only one use of the shuffle said so, there would be two shuffles.
    postings = _postings(docs, shared).where("key is not null and part is not null")
    postings = postings.repartition("key", "part").distinct()
    name = F.xxhash64("class")
    groups = (
        postings.groupBy("key", "part")
        .agg(
            F.min("class").alias("low"),
            F.max("class").alias("high"),
            F.count("*").alias("size"),
            F.sum(name % (1 << 40)).alias("sum"),
            F.bit_xor(name).alias("xor"),
        )
        .where("low < high or part >= 0")
        .groupBy("low", "high", "size", "sum", "xor", "part", F.when(F.col("part") >= 0, F.col("key")))
        .agg(F.min("key").alias("key"))
    )
    return postings.join(groups.select("key", "part"), ["key", "part"]).select("key", "class")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, n_shingles and component_id, the smallest id that can be
    reached from it by links."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = settled(_classes(docs))
    shared = docs.sparkSession.sparkContext.broadcast(_order(counted))
    rows = counted.where("key is null").select("id", "n", "class")

    postings = settled(_shared_shingles(docs, shared))
    heads = rows.where("class is not null").groupBy("class").agg(F.min("id").alias("head"))
    signatures = (
        counted.where("class is not null")
        .groupBy("class")
        .agg(F.min("n").alias("n"), F.min("bits").alias("bits"))
        .join(postings.select("class").distinct(), "class", "left_semi")
    )
    signatures = settled(signatures)
    links, labels = None, None

    def linked(pairs: DataFrame) -> bool:
        """Adds the links among the pairs, and the components they make."""
        nonlocal links, labels
        found = settled(_verified(_possible(pairs, signatures), docs, rows))
        if found.isEmpty():
            return False
        links = found if links is None else links.unionByName(found)
        labels = connected(links, "a", "b").select(F.col("node").alias("class"), "component")
        return True

    for turn in range(TURNS):
        if not linked(_star(_with_components(postings, labels), turn)):
            break
    linked(_across(_with_components(postings, labels), signatures))
    if labels is None:
        labels = heads.select("class", F.col("class").alias("component")).limit(0)
    named = heads.join(labels, "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    smallest = named.groupBy("component").agg(F.min("head").alias("component_id"))
    ids = named.join(smallest, "component").select("class", "component_id")
    return rows.join(ids, "class", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


# Name of ids beside documents, which may have columns of any other name.
NAMED = "_id_of_component"


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with its own columns.

    Of rows with the same id and text one stays. Rows without id cannot be named and stay. Ids to be
    dropped are broadcast while they are few; else documents and ids are shuffled.
    """
    found = settled(components(docs, id_col, text_col).select(F.col(id_col).alias(NAMED), "component_id"))
    dropped = found.where(f"{NAMED} <> component_id").select(NAMED).distinct()
    repeated = found.where(f"{NAMED} is not null").groupBy(NAMED).count().where("count > 1").select(NAMED)

    def few(ids: DataFrame) -> DataFrame:
        ids = settled(ids)
        return F.broadcast(ids) if ids.count() <= MAX_BROADCAST else ids

    repeated, same = few(repeated), F.col(id_col) == F.col(NAMED)
    kept = docs.join(few(dropped), same, "left_anti")
    once = kept.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(repeated, same, "left_anti").unionByName(once)
