"""Hard-negative mining by threshold joins over an inverted index with norm bounds.

Anchors and rows are joined for the pairs whose inner product reaches a threshold.
Dimensions stand in falling order of energy. A row enters the inverted index only
with the leading dimensions: the trailing ones, whose norm times that of the
anchors' trailing dimensions stays below the threshold, are omitted, since no pair
can reach the threshold in them alone. Partial scores grow dimension group by
dimension group; a pair goes once its score so far plus the product of both
remaining norms is below the anchor's threshold. Survivors are scored in integers.

Thresholds start where few rows are expected and are lowered, for the windows that
are still short of rows, until each is full or its lower end is reached. First the
window of each anchor is all scores, for its positives; then there is a window for
each positive, for its negatives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebridge.llm.tables import written
from ratebridge.llm.vectors import finite, integer_components, matrix_of

#: Scaled components are held within this distance of zero, so that scores of up to 512 dimensions fit a long.
HELD = float(1 << 27)
#: Beyond all scores.
FAR = 1 << 62
#: Dimensions of a group, and anchors looked at together.
GROUP, STRIP = 16, 128
#: Share of live pairs below which they are listed instead of kept in a matrix.
SPARSE = 0.125


def norms_left(block: np.ndarray) -> np.ndarray:
    """Norm of each row's dimensions from each group on, and 0 at the end (rows x groups + 1)."""
    squares = np.add.reduceat(block * block, np.arange(0, block.shape[1], GROUP), axis=1)
    left = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([left, np.zeros((len(block), 1))]))


def index_depth(left: np.ndarray, asked_left: np.ndarray, least: float) -> np.ndarray:
    """Groups of each row that are indexed: the rest has a product of norms below ``least`` with any anchor."""
    most = asked_left.max(axis=0)
    return (left * most >= least).sum(axis=1) if least > 0 else np.full(len(left), left.shape[1] - 1)


def pairs_above(rows: np.ndarray, asked: np.ndarray, floors: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of the allowed pairs (rows x anchors) whose score may reach the anchor's floor; none that does is missing."""
    left, asked_left = norms_left(rows), norms_left(asked)
    groups = left.shape[1] - 1
    slack = 1e-9 * (1.0 + left[:, :1] * asked_left[:, 0])
    depth = np.minimum(index_depth(left, asked_left, float(floors.min() - slack.max())), groups)
    order = np.argsort(-depth, kind="stable")  # the rows of a group's list come first
    rows, left, depth, slack = rows[order], left[order], depth[order], slack[order]
    allowed = allowed[order]
    live = allowed & (depth > 0)[:, None]  # a row that is not indexed reaches no floor
    scores = np.zeros(live.shape)
    at = None  # matrix first, then lists of pairs
    for g in range(groups):
        span = slice(g * GROUP, (g + 1) * GROUP)
        if at is None:
            listed = int(np.searchsorted(-depth, -g, "left"))
            scores[:listed] += rows[:listed, span] @ asked[:, span].T
            reach = np.minimum(depth, g + 1)  # what is not indexed stays in the bound
            live &= scores + left[np.arange(len(rows)), reach][:, None] * asked_left[:, reach].T >= floors - slack
            if live.sum() <= SPARSE * live.size:
                i, j = np.nonzero(live)
                at, score = (i, j), scores[i, j]
        else:
            i, j = at
            inside = depth[i] > g
            score = score + np.where(inside, np.einsum("ij,ij->i", rows[i, span], asked[j, span]), 0.0)
            reach = np.minimum(depth[i], g + 1)
            kept = score + left[i, reach] * asked_left[j, reach] >= floors[j] - slack[i, j]
            at, score = (i[kept], j[kept]), score[kept]
    i, j = at if at is not None else np.nonzero(live)
    return order[i], j


def best_in_windows(row_ids, rows, row_labels, asked_ids, asked, asked_labels, windows, k: int, same: bool) -> list[np.ndarray]:
    """(anchor, slot, row, score) of the best k rows of the block in each window.

    ``windows`` are (anchor place, slot, floor, top), both ends included.
    """
    anchor, slot, floor, top = windows
    lowest = np.full(len(asked), float(FAR))
    np.minimum.at(lowest, anchor, floor.astype(float))
    by_need = np.argsort(lowest / np.maximum(np.linalg.norm(asked.astype(float), axis=1), 1e-9))
    as_float = rows.astype(float)
    found: list[list[np.ndarray]] = [[], [], [], []]
    for start in range(0, len(by_need), STRIP):
        strip = by_need[start:start + STRIP]
        alike = row_labels[:, None] == asked_labels[strip]
        allowed = (alike if same else ~alike) & (row_ids[:, None] != asked_ids[strip])
        if not allowed.any():
            continue
        i, j = pairs_above(as_float, asked[strip].astype(float), lowest[strip], allowed)
        score = np.einsum("ij,ij->i", rows[i], asked[strip[j]])
        order = np.lexsort((row_ids[i], -score, j))
        i, j, score = i[order], strip[j[order]], score[order]
        for s in np.unique(slot[np.isin(anchor, strip)]):
            of_slot = slot == s
            low, high = np.full(len(asked), FAR), np.full(len(asked), -FAR)
            low[anchor[of_slot]], high[anchor[of_slot]] = floor[of_slot], top[of_slot]
            inside = np.flatnonzero((score >= low[j]) & (score <= high[j]))
            owner = j[inside]  # equal anchors stand together, best rows first
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
            place = np.arange(len(owner)) - np.repeat(first, np.diff(np.concatenate([first, [len(owner)]])))
            best = inside[place < k]
            for out, values in zip(found, (j[best], np.full(len(best), s), row_ids[i[best]], score[best]), strict=True):
                out.append(values)
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]


def threshold_join(asked: DataFrame, rows: DataFrame, order: dict[int, list[int]], k: int, same: bool, anchor_block: int, row_block: int) -> DataFrame:
    """(anchor, slot, vec_id, score): each window's best k rows, dealt over pairs of blocks.

    ``asked`` has anchor, vec_id, label, v, dim and the arrays slots, floors, tops; ``rows``
    has row, vec_id, label, v, dim.
    """
    n_asked, n_rows = asked.count(), rows.count()
    asked_blocks, row_blocks = max(1, math.ceil(n_asked / anchor_block)), max(1, math.ceil(n_rows / row_block))

    def dealt(column: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = asked.select("dim", dealt("anchor", asked_blocks).alias("asked_block"), every(row_blocks).alias("row_block"), "anchor", "vec_id", "label", "v", "slots", "floors", "tops")
    right = rows.select("dim", every(asked_blocks).alias("asked_block"), dealt("row", row_blocks).alias("row_block"), "vec_id", "label", "v")
    names = ["anchor", "slot", "vec_id", "score"]

    def search(asked_part: pa.Table, row_part: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 4
        if asked_part.num_rows and row_part.num_rows:
            asked_part, row_part = asked_part.combine_chunks(), row_part.combine_chunks()
            of = lambda part, name: part.column(name).combine_chunks()
            places = np.array(order[asked_part.column("dim")[0].as_py()], int)
            slots = of(asked_part, "slots")
            anchor = np.repeat(np.arange(asked_part.num_rows), slots.value_lengths().to_numpy())
            windows = (anchor, *[of(asked_part, c).flatten().to_numpy(zero_copy_only=False) for c in ("slots", "floors", "tops")])
            numbers = lambda part, name: part.column(name).to_numpy()
            got = best_in_windows(numbers(row_part, "vec_id"), matrix_of(of(row_part, "v"))[:, places], numbers(row_part, "label"),
                                  numbers(asked_part, "vec_id"), matrix_of(of(asked_part, "v"))[:, places], numbers(asked_part, "label"), windows, k, same)
            found = [numbers(asked_part, "anchor")[got[0]], *got[1:]]
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int32()), pa.array(found[2], pa.int64()), pa.array(found[3], pa.int64())], names=names)

    key = ["dim", "asked_block", "row_block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, "anchor long, slot int, vec_id long, score long")
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def lowered(windows: DataFrame, share: float) -> DataFrame:
    """Windows with a ``floor`` above which about that share of all rows is expected, never below ``bottom``.

    ``spread`` is the deviation of the anchor's scores; only how often thresholds are lowered hangs on it.
    """

    def floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        normal = NormalDist()
        for batch in batches:
            out = []
            for top, bottom, spread in zip(batch["top"], batch["bottom"], batch["spread"], strict=True):
                below = normal.cdf(min(top / spread, 40.0)) - share if spread > 0 else 0.0
                guess = math.floor(normal.inv_cdf(min(below, 1 - 1e-16)) * spread) if below > 1e-16 else bottom
                out.append(int(max(bottom, min(guess, top))))
            yield batch.assign(floor=pd.Series(out, dtype="int64", index=batch.index))

    return windows.mapInPandas(floors, "anchor long, slot int, top long, bottom long, spread double, floor long")


def fill_windows(windows: DataFrame, anchors: DataFrame, rows: DataFrame, order: dict[int, list[int]], k: int, same: bool, n_rows: int, anchor_block: int, row_block: int) -> DataFrame:
    """(anchor, slot, vec_id, score, rank): the best k rows of each window (anchor, slot, top, bottom, spread)."""
    done, share = [], 10.0 * k / max(n_rows, 1)
    still = windows
    while True:
        aimed = written(lowered(still, share))
        lists = aimed.groupBy("anchor").agg(F.collect_list(F.struct("slot", "floor", "top")).alias("w"))
        lists = lists.select("anchor", F.col("w.slot").alias("slots"), F.col("w.floor").alias("floors"), F.col("w.top").alias("tops"))
        found = written(threshold_join(written(anchors.join(lists, "anchor")), rows, order, k, same, anchor_block, row_block))
        counts = found.groupBy("anchor", "slot").agg(F.count("*").alias("n"))
        short = (F.coalesce("n", F.lit(0)) < k) & (F.col("floor") > F.col("bottom"))
        still = written(aimed.join(counts, ["anchor", "slot"], "left").filter(short).select("anchor", "slot", "top", "bottom", "spread"))
        done.append(found.join(still, ["anchor", "slot"], "left_anti"))
        if still.isEmpty():
            break
        share *= 16
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    scale: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    anchor_block: int = 4096,
    row_block: int = 4096,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); scores are inner products of those. An
    anchor's positives are its ``n_positives`` best rows of its label; for each, the
    negatives are the ``n_negatives`` best rows of other labels whose score is at
    least ``least_percent`` and at most ``most_percent`` of the positive's. Ties go
    to the smaller id, ids are whole numbers. A positive without negatives gives no rows.

    Rows with a null id or label, a null vector or a null or non-finite component
    take no part; vectors meet those of the same length only. A row never meets rows
    of its own id; repeated rows count as often as they stand, anchors among them.
    Scaled components are held at 2^27. An empty table or no anchor gives no rows;
    other columns are not read.
    """
    v = integer_components(vectors[vector_col], scale, 0, most=HELD)
    picked = vectors.select(vectors[id_col].cast("long").alias("vec_id"), label.cast("long").alias("label"), F.when(finite(vectors[vector_col]), v).alias("v"))
    whole = picked.filter("vec_id IS NOT NULL AND label IS NOT NULL AND size(v) > 0")
    rows = written(whole.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v", F.size("v").alias("dim")))
    energy = rows.select("dim", F.posexplode("v")).groupBy("dim", "pos").agg(F.avg(F.col("col").cast("double") ** 2).alias("energy"), F.count("*").alias("n")).collect()
    n_rows = max((r["n"] for r in energy), default=0)
    spread_of = {d: {r["pos"]: r["energy"] for r in energy if r["dim"] == d} for d in {r["dim"] for r in energy}}
    order = {d: sorted(range(d), key=lambda j: (-e[j], j)) for d, e in spread_of.items()}
    energies = F.create_map(*[x for d, e in spread_of.items() for x in (F.lit(d), F.array(*[F.lit(float(e[j])) for j in range(d)]))]) if energy else F.lit(None).cast("map<int,array<double>>")
    weighted = F.zip_with("v", F.element_at(energies, F.col("dim")), lambda x, e: x.cast("double") * x * e)
    spread = F.sqrt(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)).alias("spread")
    anchors = written(rows.filter(is_anchor).select(F.col("row").alias("anchor"), "vec_id", "label", "v", "dim", spread))
    sizes = (n_rows, anchor_block, row_block)

    every = anchors.select("anchor", F.lit(0).alias("slot"), F.lit(FAR).alias("top"), F.lit(-FAR).alias("bottom"), "spread")
    found = fill_windows(every, anchors.drop("spread"), rows, order, n_positives, True, *sizes)
    positives = written(found.select("anchor", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    part = lambda percent: F.lit(percent).cast("decimal(38,0)") * F.col("positive_score") / 100
    window = [F.floor(part(most_percent)).cast("long").alias("top"), F.ceil(part(least_percent)).cast("long").alias("bottom")]
    windows = positives.join(anchors.select("anchor", "spread"), "anchor").select("anchor", "slot", *window, "spread").filter("bottom <= top")
    negatives = fill_windows(windows, anchors.drop("spread"), rows, order, n_negatives, False, *sizes)
    named = negatives.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    with_positive = named.join(positives, ["anchor", "slot"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return with_positive.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
