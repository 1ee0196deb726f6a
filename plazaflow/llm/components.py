"""Connected components of a graph of links, by repeated contraction to stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.tables import settled


# Links of 16 bytes that one task may take; more are contracted by joins.
IN_ONE_TASK = 250_000


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = root(u), root(v)
            parent[max(u, v)] = min(u, v)
    nodes = list(parent)
    columns = [pa.array(x, pa.int64()) for x in (nodes, [root(x) for x in nodes])]
    yield pa.RecordBatch.from_arrays(columns, ["node", "component"])


def connected(links: DataFrame, a: str, b: str, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """`node` and `component`, the smallest node it is linked with over any number of links.

    Up to `in_one_task` links are counted and then joined up by one task. More are contracted. Each
    round hangs all larger neighbours of a node on its smallest neighbour, then a node and its
    smaller neighbours on the smallest of these; the rounds grow with the logarithm of the
    number of nodes. Neighbours are never gathered: smallest ones are aggregated with partial sums
    and joined back. Links of a node with itself and repeated links change nothing; a null end has no link.
    """
    edges = settled(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct()
    )
    if edges.count() <= in_one_task:
        picked = edges.select(F.col("u").cast("bigint"), F.col("v").cast("bigint")).coalesce(1)
        return picked.mapInArrow(_in_one_task, "node bigint, component bigint")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        wide = (
            both.where("v > u")
            .join(lowest, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        lowest = wide.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.explode(F.array("u", "v"))
        edges = settled(
            wide.join(lowest, "u").select(ends.alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        name = F.xxhash64("u", "v")
        now = edges.agg(F.count("*"), F.sum(F.pmod(name, F.lit(1 << 40))), F.bit_xor(name)).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
