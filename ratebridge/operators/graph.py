"""Reachability over many small directed graphs at once (iterative frontier joins)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebridge.session import ensure_checkpoint_dir, scratch_path

CHECKPOINT_EVERY = 8


def reachable(
    edges: DataFrame,
    starts: DataFrame,
    keys: Sequence[str],
    max_rounds: int | None = None,
) -> DataFrame:
    """Nodes reachable from ``starts`` along ``edges``, per graph.

    ``edges(*keys, src, dst)``, ``starts(*keys, node)`` -> ``(*keys, node)``
    including the start nodes. All graphs advance together: each round joins
    the frontier with the edges on (graph, node), keeps nodes not yet visited
    and stops when the frontier is empty, so the number of rounds is the
    largest BFS depth, not the number of graphs. Cycles are fine (visited
    nodes never re-enter the frontier). Each frontier is written with a
    reliable checkpoint to the session's checkpoint folder (the visited set is
    compacted every few rounds), so plans stay flat and a lost executor
    recomputes at most one round. The edges are stored once, bucketed by (graph,
    src), so a round shuffles its frontier and not the edges.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    keys = list(keys)
    ek = [f"__e_{k}" for k in keys]
    e, stored = bucketed(edges.select(*[F.col(k).alias(a) for k, a in zip(keys, ek)], "src", "dst").distinct(), [*ek, "src"])
    try:
        return _reached(e, ek, starts, keys, max_rounds)
    finally:
        edges.sparkSession.sql(f"DROP TABLE {stored}")


def bucketed(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, str]:
    """The rows stored in as many buckets as a shuffle has partitions, and the table's name."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(n, *by).write.bucketBy(n, *by).sortBy(*by).format("parquet")
    rows.option("path", scratch_path(spark, "bucketed", name)).saveAsTable(name)
    return spark.table(name), name


def _reached(e: DataFrame, ek: list[str], starts: DataFrame, keys: list[str], max_rounds: int | None) -> DataFrame:
    # Every round's frontier is checkpointed: its plan becomes a flat scan, so
    # the plan of `visited` (a union of frontiers) grows linearly, not
    # exponentially, with the number of rounds.
    frontier = starts.select(*keys, "node").distinct().checkpoint(eager=True)
    visited = frontier
    rounds = 0
    while True:
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"reachability did not end within {max_rounds} rounds")
        rounds += 1
        step = (
            frontier.join(e, [*[F.col(k) == F.col(a) for k, a in zip(keys, ek)], F.col("node") == F.col("src")])
            .select(*[F.col(a).alias(k) for k, a in zip(keys, ek)], F.col("dst").alias("node"))
            .distinct()
        )
        new = step.join(visited, [*keys, "node"], "left_anti").checkpoint(eager=True)
        if new.isEmpty():
            break
        visited = visited.unionByName(new)
        if rounds % CHECKPOINT_EVERY == 0:
            visited = visited.checkpoint(eager=True)
        frontier = new
    return visited
