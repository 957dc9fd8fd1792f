"""Distributed connected components (used by operators 7 and 8).

Edges are first contracted where they lie: a union-find over the edges of a
partition (LOCAL_EDGES at most on average) leaves one edge from every vertex to the
smallest vertex of its local component.  Then alternating large-star / small-star
rounds and local contractions follow until nothing changes; with a single
partition the first contraction is the answer.  A star round is two equi-joins
against per-vertex minima, which combine on the map side, so a hub vertex is
never gathered in one group.  Each round is materialised in the shared folder; the
driver sees two numbers a round."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import few_parts, materialise

LOCAL_EDGES = 100_000


def _minima(adjacent: DataFrame) -> DataFrame:
    """u -> smallest vertex among u and its neighbours."""
    return adjacent.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = both.where("v > u").join(_minima(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minima(down)
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) edges of a partition -> (vertex, smallest vertex of its local component)."""
    up: dict = {}

    def find(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y] if y in up else y
            x = y
        return x

    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                up[max(a, b)] = min(a, b)
    if schema is not None:
        stars = [(x, find(x)) for x in list(up) if find(x) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s[k] for s in stars], schema.field(k).type) for k in range(2)], names=["u", "v"])


def _contracted(edges: DataFrame, rows: int) -> DataFrame:
    return materialise(few_parts(edges, rows, LOCAL_EDGES).mapInArrow(_local_stars, edges.schema))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every vertex that has an edge; the component is
    its smallest vertex.  Null ends, loops and repeated edges are ignored; no
    edges give an empty table."""
    given = materialise(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
                        .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))))
    rows = given.count()
    now = _contracted(given, rows)
    if rows > LOCAL_EDGES:  # more than one partition
        state = _state(now)
        while True:
            star = materialise(_small_star(_large_star(now)))
            new = _state(star)
            if new == state:
                break
            now = _contracted(star, new[0])
            state = _state(now)
    # every vertex now points at its component's smallest one
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
