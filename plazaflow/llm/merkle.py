"""A Merkle manifest of a dataset: content-addressed records, and proofs by descent from the root.

Every row is a leaf, the digest of its values. The leaves of a group stand in the order of their ids;
each run of `fanout` neighbours (the last run may be shorter, even of one) is digested into a node, and
so on until one is left, the group's subroot. Subroots in the order of their groups (null first, then
by bytes) give the root in the same way.

Stored are digest-to-children records, bundled by segments: a row has a node's digest and all digests
below it down to at most `SEGMENT` children, level by level. Segments are built in rounds from the
leaves up, each by one aggregation of bounded groups. A request for a leaf starts at the root with its
rank. In each round it finds the record of its current digest, reads the child to go on with from the
digits of its rank, and collects the children not selected; a segment adds several levels to its path at
once. At the leaf the path is turned round. Requests are rows of a table like any other, so one job
serves one leaf or all of them.

Ranks come from a sort by range and the counts of its partitions. Rounds with at most `SEGMENT` records
are broadcast (some megabytes), so that no task gets all requests of the top; below, a record serves
a small share of all requests.

Defined cases: a null value is digested as `-`, other values as their length in bytes, `:` and the value.
Null ids come first, equal ids in the order of their digests; repeated rows are leaves each. A
null group is a group. An empty table has no rows and a null root. Columns other than those
named are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazaflow.llm.tables import settled

FANOUT = 2
SEGMENT = 256
STEP = "array<struct<left:array<string>,right:array<string>>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(*values: Column) -> Column:
    """The digest of a row's values."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*(told(v) for v in values)))


def _powers(fanout: int, top: int = 1 << 62) -> list[int]:
    powers = [1]
    while powers[-1] * fanout <= top:
        powers.append(powers[-1] * fanout)
    return powers


def _bundle(fanout: int) -> tuple[int, int]:
    """Levels of a segment and the children that it has at most."""
    powers = _powers(fanout, max(SEGMENT, fanout))
    return len(powers) - 1, powers[-1]


def ranked(rows: DataFrame, part: str, *order: str) -> DataFrame:
    """The rows with their `rank` from 0 within their part and the number `n` of its rows."""
    keys = [F.col(c).asc_nulls_first() for c in (part, *order)]
    laid = settled(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))
    laid = laid.select("*", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("at"))
    counts = laid.groupBy("slice", part).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy(part).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("slice").alias("s"),
        F.col(part).alias("p"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy(part)).alias("n"),
    )
    here = (F.col("slice") == F.col("s")) & F.col(part).eqNullSafe(F.col("p"))
    return laid.join(counts, here).select(*rows.columns, (F.col("at") + F.col("shift")).alias("rank"), "n")


def _up(nodes: Column, fanout: int) -> Column:
    """The digests of the runs of an array of digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * fanout + 1, F.lit(fanout)), "")))


def _segments(nodes: DataFrame, fanout: int) -> DataFrame:
    """One row per segment of (part, rank, n, digest) nodes: its place in the next round and its levels."""
    height, most = _bundle(fanout)
    members = F.array_sort(F.collect_list(F.struct("rank", "digest")))  # at most `most`
    rows = nodes.groupBy("part", "n", F.floor(F.col("rank") / most).alias("segment")).agg(members.alias("members"))
    powers = F.array(*(F.lit(p).cast("bigint") for p in _powers(fanout)))
    depth = F.size(F.filter(powers, lambda p: p < F.col("n")))
    levels = F.aggregate(
        F.sequence(F.lit(1), F.least(depth, F.lit(height))),
        F.array(F.col("members.digest")),
        lambda done, _: F.concat(done, F.array(_up(F.element_at(done, -1), fanout))),
    )
    return rows.select("part", F.col("segment").alias("rank"), "n", levels.alias("levels"))


@dataclass
class Tree:
    """Trees of all parts: the top digest of each, and the segments of each round from the leaves up."""

    tops: DataFrame
    rounds: list[DataFrame]


def grown(nodes: DataFrame, fanout: int) -> Tree:
    """Trees over (part, rank, n, digest) rows."""
    most, rounds, done = _bundle(fanout)[1], [], []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        done.append(nodes.where("n = 1"))
        segments = settled(_segments(nodes.where("n > 1"), fanout))
        segments = segments.withColumn("digest", F.element_at(F.element_at("levels", -1), 1))
        rounds.append(segments)
        nodes = segments.select("part", "rank", F.ceil(F.col("n") / most).alias("n"), "digest")
        largest = -(-largest // most)
    tops = nodes
    for alone in done:
        tops = tops.unionByName(alone)
    return Tree(tops.select("part", "digest"), rounds)


@dataclass
class Manifest:
    """`leaves` (id, columns carried, part, leaf, rank), `subroots` (part, subroot, place) and the records."""

    leaves: DataFrame
    subroots: DataFrame
    groups: Tree
    top: Tree
    fanout: int

    @property
    def records(self) -> DataFrame:
        """All digest-to-children records, one for each distinct digest."""
        spark = self.leaves.sparkSession
        rows = spark.createDataFrame([], "digest string, children array<string>")
        for segments in (*self.groups.rounds, *self.top.rounds):
            runs = segments.select(F.explode(F.sequence(F.lit(2), F.size("levels"))).alias("k"), "levels").select(
                F.posexplode(F.element_at("levels", F.col("k"))).alias("i", "digest"),
                F.element_at("levels", F.col("k") - 1).alias("below"),
            )
            children = F.slice("below", F.col("i") * self.fanout + 1, F.lit(self.fanout))
            rows = rows.unionByName(runs.select("digest", children.alias("children")))
        return rows.dropDuplicates(["digest"])


def manifest(
    docs: DataFrame,
    values: tuple[str, ...],
    id_col: str = "doc_id",
    group_col: str = "lang",
    carried: tuple[str, ...] = (),
    fanout: int = FANOUT,
) -> Manifest:
    """The manifest of a table: `values` are the columns digested, in their order.

    Columns `carried` stay beside each leaf, which the proofs then show.
    """
    leaves = docs.select(
        F.col(id_col).alias("id"),
        F.col(group_col).cast("string").alias("part"),
        leaf_of(*(F.col(v) for v in values)).alias("leaf"),
        F.struct(*(F.col(c) for c in carried)).alias("carried") if carried else F.lit(None).alias("carried"),
    )
    leaves = settled(ranked(settled(leaves), "part", "id", "leaf"))  # texts are read once
    groups = grown(leaves.select("part", "rank", "n", F.col("leaf").alias("digest")), fanout)
    subroots = groups.tops.select(F.lit(0).alias("all"), "part", "digest")
    subroots = settled(ranked(subroots, "all", "part"))
    tops = subroots.select(F.lit(None).cast("string").alias("part"), "rank", "n", "digest")
    placed = subroots.select("part", F.col("digest").alias("subroot"), F.col("rank").alias("place"))
    return Manifest(leaves, placed, groups, grown(tops, fanout), fanout)


def _steps(levels: Column, at: Column, fanout: int) -> Column:
    """From a segment's top to its bottom, the neighbours in the run of the node on the way to child `at`."""
    powers = F.array(*(F.lit(p).cast("bigint") for p in _powers(fanout, SEGMENT)))

    def step(height: Column) -> Column:
        row = F.element_at(levels, height + 1)
        node = F.floor(at / F.element_at(powers, height + 1)).cast("int")
        digit = node % fanout
        return F.struct(
            F.slice(row, node - digit + 1, digit).alias("left"),
            F.slice(row, node + 2, fanout - 1 - digit).alias("right"),
        )

    return F.transform(F.sequence(F.size(levels) - 2, F.lit(0), F.lit(-1)), step)


def _descended(requests: DataFrame, rounds: list[DataFrame], rank: str, fanout: int) -> DataFrame:
    """Requests at the digests of leaves, with the steps from the top added to their path."""
    most = _bundle(fanout)[1]
    for k in range(len(rounds) - 1, -1, -1):
        records = rounds[k].select(F.col("digest").alias("key"), "levels").dropDuplicates(["key"])
        if rounds[k].count() <= most:
            records = F.broadcast(records)
        found = requests.join(records, F.col("at") == F.col("key"), "left")
        child = (F.floor(F.col(rank) / most**k) % most).cast("int")
        here = F.col("key").isNotNull()
        requests = found.select(
            *(c for c in requests.columns if c not in ("at", "path")),
            F.when(here, F.element_at(F.element_at("levels", 1), child + 1)).otherwise(F.col("at")).alias("at"),
            F.when(here, F.concat("path", _steps(F.col("levels"), child, fanout))).otherwise(F.col("path")).alias("path"),
        )
    return requests


def proofs(made: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """For each request (rows of `made.leaves`; all of them if none are given) its proof.

    Columns: id, carried, leaf, subroot, root and `path`, the neighbours left and right of each node from
    the leaf's run to the root's.
    """
    rows = made.leaves if requests is None else requests
    tops = made.subroots.select(F.col("part").alias("p"), "subroot", "place")
    rows = rows.join(tops, F.col("part").eqNullSafe(F.col("p"))).select(
        "id", "carried", "leaf", "rank", "subroot", "place", F.array().cast(STEP).alias("path")
    )
    root = made.top.tops.select(F.max("digest").alias("root"))  # one row
    rows = rows.crossJoin(F.broadcast(root)).withColumn("at", F.col("root"))
    rows = _descended(rows, made.top.rounds, "place", made.fanout)
    rows = _descended(rows, made.groups.rounds, "rank", made.fanout)
    return rows.select("id", "carried", "leaf", "subroot", "root", "at", F.reverse("path").alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the neighbours of its path."""
    return F.aggregate(
        path,
        leaf,
        lambda node, step: digest(F.concat(F.array_join(step["left"], ""), node, F.array_join(step["right"], ""))),
    )


def siblings(path: Column) -> Column:
    """The digests of a path, from the leaf's level to the root's, left to right."""
    return F.flatten(F.transform(path, lambda step: F.concat(step["left"], step["right"])))
