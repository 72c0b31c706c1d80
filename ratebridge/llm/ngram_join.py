"""N-gram Jaccard self-join with adaptive multi-match prefixes, and its components.

A document is the set of its 5-word shingles, ordered from rare to frequent. Two
sets of sizes n and m that reach the threshold share so many shingles that their
prefixes of length n - ceil(t * n) + l share at least l of them, for any l. Each
document chooses its l by the estimated cost of its candidates: a longer prefix
reads more postings, but a partner must share min(l, l') prefix shingles before
the pair is verified on the whole sets.

Equal sets are one node. Groups of similar nodes are not expanded into pairs:

1. in rounds, one of the nodes that hold a shingle is its hub, first the one with
   the smallest part of shingles that no other node has, then another each round;
   each node is verified against the hub outside its component with which it
   shares most prefix shingles, if that pair passes the filter;
2. only pairs of nodes that are not yet connected and not yet tried are counted,
   filtered and verified, all of them. So the components are those of all links.

Two nodes compared with one and the same hub share at most what the smaller share of
the hub is, and what both have beside it. So such a pair is met at a shingle only if
the first alone would do; else the two must have a shingle beside the hub in common,
and there they are met instead, those shingles being rare in a group of near copies.

A pair is filtered exactly: by min(l, l'), and by sizes less what cannot be shared.
Of the prefix shingles of a set that no other prefix has, a partner holds none, or,
where its prefix ends earlier, at most as many as its ceil(t * m) - l' exceeds the
set's own ceil(t * n) - l. In a round only the shingles of the hub count, so a pair
that fails there may come again in the second step.

The sets of one id belong together, so their nodes are linked without a comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebridge.llm.components import connected_components
from ratebridge.llm.native import id_and_text
from ratebridge.llm.shingles import ROLL_A, mixed, places, rolling, utf8, word_hashes
from ratebridge.llm.tables import small_batches, written
from ratebridge.operators.graph import bucketed

#: Shingles ordered last, the most frequent ones, are at most so many (bounds what workers get).
FREQUENT = 1 << 16
#: Documents looked at together for frequent shingles, and how many of them must hold one for it to count there.
BATCH, OFTEN_IN_BATCH = 2500, 4
#: Documents whose words are hashed at a time.
SLICE = 250
#: Cost of verifying a pair, in postings read; largest number of shared prefix shingles asked for.
VERIFY_COST, MOST_SHARED = 50, 4
#: Rounds of verification against hubs, at most; they only spare pairs in the step that tries all.
HUB_ROUNDS = 2


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a text with fewer words is one shingle, one without none."""
    hashes, counts = word_hashes(texts, lower=True)
    runs = rolling(hashes, width, ROLL_A)
    _, inside = places(counts, width, len(runs))
    begins = np.cumsum(counts) - counts
    sets = []
    for a, n in zip(begins.tolist(), counts.tolist(), strict=True):
        if n >= width:
            sets.append(np.unique(runs[a:a + n - width + 1]))
        elif n:
            sets.append(rolling(hashes[a:a + n], n, ROLL_A + 2 * n))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def prefix_of(shingles: np.ndarray, percent: int, frequent: np.ndarray, counts: np.ndarray) -> tuple[int, np.ndarray]:
    """(l, prefix) of a set. ``frequent`` (sorted) have the estimated ``counts``; all others come first, by hash."""
    n = len(shingles)
    must = -(-percent * n // 100)
    if not n:
        return 1, shingles
    weight = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        weight = np.where(frequent[at] == shingles, counts[at], 0)
    order = np.lexsort((shingles, weight))
    most = min(MOST_SHARED, must)
    cost = np.cumsum(1 + weight[order][: n - must + most])[n - must:]  # postings read with l = 1, 2, ...
    shared = np.arange(1, most + 1)
    best = int(np.argmin(cost + VERIFY_COST * cost / shared)) + 1
    return best, shingles[order[: n - must + best]]


def frequent_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts: those that some batch of rows holds often."""

    def often_held(runs: list[np.ndarray]) -> pa.RecordBatch:
        held = np.concatenate(runs)
        runs.clear()
        held.sort()
        first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])[: len(held)])
        n = np.diff(first, append=len(held))
        often = n >= OFTEN_IN_BATCH
        return pa.RecordBatch.from_arrays([pa.array(held[first[often]].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["shingle", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # BATCH rows count together, however many of them Spark sends at a time.
        held, n_rows = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, min(SLICE, BATCH - n_rows))
                hashes, counts = word_hashes(utf8(part.column(0)), lower=True)
                runs = rolling(hashes, width, ROLL_A)
                held.append(runs[places(counts, width, len(runs))[1]])
                at, n_rows = at + part.num_rows, n_rows + part.num_rows
                if n_rows == BATCH:
                    yield often_held(held)
                    n_rows = 0
        if n_rows:
            yield often_held(held)

    counted = texts.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    shingles = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], top["n"].to_numpy(np.int64)[order]


def compared(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes: linked (the sets reach the threshold), shared shingles, and those of a that b lacks.

    These are null where a shares less than 2 * ``percent`` - 100 percent of its own. ``texts`` has (node, text).
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE // 2):
                part = batch.slice(at, SLICE // 2)
                left, right = (shingle_sets(utf8(part.column(i)), width) for i in (2, 3))
                linked, shared, beside = [], [], []
                for x, y in zip(left, right, strict=True):
                    own = np.setdiff1d(x, y, assume_unique=True)
                    both = len(x) - len(own)
                    linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                    shared.append(both)
                    beside.append(own.view(np.int64) if 100 * both >= (2 * percent - 100) * len(x) else None)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:2],
                    pa.array(linked, pa.bool_()),
                    pa.array(shared, pa.int64()),
                    pa.array(beside, pa.list_(pa.int64())),
                ], names=["a", "b", "linked", "shared", "beside"])

    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long, linked boolean, shared long, beside array<long>")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold."""
    return compared(pairs, texts, width, percent).filter("linked").select("a", "b")


class Marks:
    """A bit for each value of a long column, by hash: what has no bit is not in the column.

    16 bits a value, at most 2^28 (32 MB to the driver and the workers); with
    more values it lets more through, and the exact join that follows decides.
    """

    def __init__(self, values: DataFrame, column: str):
        n = values.count()
        self.bits = min(28, max(16, (16 * n).bit_length()))
        bits = self.bits

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = mixed(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - bits)
                cells, of = np.unique(place >> np.uint64(6), return_inverse=True)
                words = np.zeros(len(cells), np.uint64)
                np.bitwise_or.at(words, of, np.uint64(1) << (place & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(cells.view(np.int64)), pa.array(words.view(np.int64))], names=["cell", "word"])

        marked = values.select(column).mapInArrow(mark, "cell long, word long").groupBy("cell").agg(F.bit_or("word").alias("word")).toPandas()
        table = np.zeros(1 << (bits - 6), np.uint64)
        table[marked["cell"].to_numpy(np.int64)] = marked["word"].to_numpy(np.int64).view(np.uint64)
        self.table = values.sparkSession.sparkContext.broadcast(table)


def with_some(rows: DataFrame, column: str, marks: Marks, schema) -> DataFrame:
    """Rows whose long may be among the marked ones; of an array of longs, the elements that may be."""
    index, table, bits = rows.columns.index(column), marks.table, marks.bits

    def hits(values: np.ndarray) -> np.ndarray:
        place = mixed(values.view(np.uint64)) >> np.uint64(64 - bits)
        return (table.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(index)
            if not pa.types.is_list(values.type):
                yield batch.filter(pa.array(hits(values.to_numpy())))
                continue
            flat = values.flatten().to_numpy()
            kept = hits(flat)
            sizes = np.diff(values.offsets.to_numpy())
            counts = np.add.reduceat(np.concatenate([kept, [False]]).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]])) if len(sizes) else sizes
            counts = np.where(sizes > 0, counts, 0)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            columns = list(batch.columns)
            columns[index] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[kept]))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(pick, schema)


def still_open(postings: DataFrame, components: DataFrame) -> DataFrame:
    """Postings, each with its node's component, of the shingles that different components hold.

    As components only grow, a shingle that is closed stays so: a round starts from what the last one left.
    """
    placed = postings.drop("component").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return placed.join(apart.select("shingle"), "shingle", "left_semi")


def near_hubs(results: DataFrame) -> DataFrame:
    """(node, hub, inside, beside) of nodes compared with a hub: how many shingles they share, and the node's others.

    A node whose rows give different results (its id stands for several texts) has none here.
    """
    result = F.struct("b", "shared", "beside")
    told = results.groupBy("a").agg(F.min(result).alias("low"), F.max(result).alias("high")).filter("low <=> high AND low.beside IS NOT NULL")
    return told.select(F.col("a").alias("node"), F.col("low.b").alias("hub"), F.col("low.shared").alias("inside"), F.col("low.beside").alias("beside"))


def sharing_beside(nodes: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of different components near one hub that share a shingle beside it, and enough in all.

    ``nodes`` has (node, component, least, hub, inside), ``near`` what ``near_hubs`` gives.
    """
    held = nodes.join(near.select("node", "beside"), "node").withColumn("others", F.size("beside")).withColumn("shingle", F.explode("beside")).drop("beside")
    apart = held.groupBy("hub", "shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    held = written(held.join(apart.select("hub", "shingle"), ["hub", "shingle"], "left_semi"))
    one, two = (held.select([F.col(c).alias(f"{c}_{x}") for c in held.columns]) for x in "ab")
    most = F.least("inside_a", "inside_b")
    sizes = (F.col("least_a") + F.col("least_b")) * percent
    met = one.join(two, (F.col("hub_a") == F.col("hub_b")) & (F.col("shingle_a") == F.col("shingle_b")) & (F.col("node_a") < F.col("node_b"))
                   & (F.col("component_a") != F.col("component_b")) & ((most + F.least("others_a", "others_b")) * (100 + percent) >= sizes))
    met = met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), most.alias("most"), sizes.alias("sizes")).agg(F.count("*").alias("n"))
    return met.filter((F.col("most") + F.col("n")) * (100 + percent) >= F.col("sizes")).select("a", "b")


def similar_components(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when 100 * shared >= percent * united shingles;
    component_id is the smallest id reachable by links, its own included. A null
    or empty text, or one without words, has no shingles and no links. A row
    without an id has a null component and links with nothing. Rows with one id
    are one node of the graph. An empty table gives no rows; other columns are
    not read. Ids are integers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = id_and_text(docs, id_col, text_col)
    shared = spark.sparkContext.broadcast(frequent_shingles(rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("text"), width))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        frequent, counts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = shingle_sets(utf8(part.column(1)), width)
                prefixes = [prefix_of(s, percent, frequent, counts) for s in sets]
                ends = np.cumsum([0, *[len(p) for _, p in prefixes]]).astype(np.int32)
                joined = np.concatenate([p for _, p in prefixes]).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([x for x, _ in prefixes], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(joined)),
                ], names=["doc_id", "n_shingles", "set_key", "asked", "prefix"])

    schema = "doc_id long, n_shingles long, set_key binary, asked int, prefix array<long>"
    shingled = written(rows.mapInArrow(shingle, schema))
    # One node for each set; its id is the smallest of its documents.
    nodes = shingled.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("node"))
    members = shingled.select("doc_id", "n_shingles", "set_key").join(nodes, "set_key", "left")
    own = nodes.toDF("own_key", "node")
    firsts = shingled.join(own, (F.col("set_key") == F.col("own_key")) & (F.col("doc_id") == F.col("node")))
    firsts = firsts.select("node", F.col("n_shingles").alias("n"), "asked", "prefix", F.xxhash64("set_key").alias("set")).dropDuplicates(["node", "set"])
    # Shingles that the same sets hold are one: the smallest stands for all, with their number as its weight.
    # The sets are told by number, smallest node and an exclusive or of hashes (of sets, as a node may have several).
    held = firsts.select("node", "set", F.explode("prefix").alias("shingle")).groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("node").alias("low"), F.bit_xor(F.xxhash64("node", "set")).alias("mark")).filter("n > 1")
    alike = written(held.groupBy("n", "low", "mark").agg(F.min("shingle").alias("shingle"), F.count("*").alias("weight")).select("shingle", "weight"))
    few = firsts.select("node", "prefix")
    few = with_some(few, "prefix", Marks(alike, "shingle"), few.schema)
    postings = written(few.select("node", F.explode("prefix").alias("shingle")).join(alike, "shingle"))
    # Prefix shingles that no other set has there; of a node with several sets none counts.
    found = postings.groupBy("node").agg(F.sum("weight").alias("held"))
    facts = firsts.select("node", "n", "asked", F.size("prefix").alias("long")).join(found, "node").withColumn("alone", F.col("long") - F.col("held"))
    facts = facts.groupBy("node").agg(F.max("n").alias("n"), F.min("n").alias("least"), F.min("asked").alias("asked"), F.when(F.count("*") == 1, F.min("alone")).otherwise(0).alias("alone"), F.min("long").alias("long"))
    facts = written(facts)
    near = with_some(rows.filter("doc_id IS NOT NULL AND text IS NOT NULL"), "doc_id", Marks(facts, "node"), rows.schema)
    near = near.join(facts.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text")
    texts, stored = bucketed(near, ["node"])  # so that no verification shuffles the texts as they lie

    def after(c: str) -> Column:
        """How many shingles follow the prefix, less those that may be missing: ceil(t * n) - l, at most."""
        return F.ceil(F.col(f"n_{c}") * percent / 100) - F.col(f"asked_{c}")

    def reaches(x: str, y: str) -> Column:
        """Sizes less what cannot be shared allow the threshold."""
        def could(c: str, other: str) -> Column:
            beyond = F.greatest(F.lit(0), after(other) - after(c))
            return F.col(f"n_{c}") - F.greatest(F.lit(0), F.col(f"alone_{c}") - beyond)

        return F.least(could(x, y), could(y, x)) * (100 + percent) >= (F.col(f"least_{x}") + F.col(f"least_{y}")) * percent

    told = ("node", "component", "n", "least", "asked", "alone")
    links = tried = near = None
    open_ = written(postings.join(facts.withColumn("alone_part", F.col("alone") / F.col("long")).drop("long"), "node").withColumn("component", F.col("node")))
    for turn in range(HUB_ROUNDS):
        pick = F.struct("alone_part", "node") if not turn else F.struct(F.xxhash64("node", F.lit(turn)), "node")
        hubs = open_.groupBy("shingle").agg(F.min_by(F.struct(*told), pick).alias("hub"))
        by_hub = open_.select("shingle", "weight", *[F.col(c).alias(f"{c}_a") for c in told]).join(
            hubs.select("shingle", *[F.col(f"hub.{c}").alias(f"{c}_b") for c in told]), "shingle")
        by_hub = by_hub.filter((F.col("component_a") != F.col("component_b")) & reaches("a", "b"))
        to_hub = by_hub.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.least("asked_a", "asked_b").alias("asked")).agg(F.sum("weight").alias("n"))
        to_hub = to_hub.filter("n >= asked").select("n", "a", "b")
        if tried is not None:
            to_hub = to_hub.join(tried, (tried["x"] == F.least("a", "b")) & (tried["y"] == F.greatest("a", "b")), "left_anti")
        to_hub = written(to_hub.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b")))
        results = written(compared(to_hub, texts, width, percent))
        near = written(near_hubs(results)) if near is None else near
        found = results.filter("linked").select("a", "b")
        now = to_hub.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        tried = now if tried is None else tried.unionByName(now)
        links = found if links is None else links.unionByName(found)
        if found.isEmpty():
            break
        open_ = written(still_open(open_, connected_components(links)))

    open_ = open_.join(near.select("node", "hub", "inside"), "node", "left")
    told = (*told, "hub", "inside")
    one, two = (open_.select("shingle", "weight", *[F.col(c).alias(f"{c}_{x}") for c in told]) for x in "ab")
    enough = F.least("inside_a", "inside_b") * (100 + percent) >= (F.col("least_a") + F.col("least_b")) * percent
    met_here = F.coalesce((F.col("hub_a") != F.col("hub_b")) | enough, F.lit(True))
    pairs = one.join(two, (one["shingle"] == two["shingle"]) & (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b")) & reaches("a", "b") & met_here)
    pairs = pairs.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.least("asked_a", "asked_b").alias("asked")).agg(F.sum(one["weight"]).alias("n"))
    grouped = open_.filter("hub IS NOT NULL").select("node", "component", "least", "hub", "inside").distinct()
    left = pairs.filter("n >= asked").select("a", "b").unionByName(sharing_beside(grouped, near, percent)).distinct()
    left = left.join(tried, (tried["x"] == left["a"]) & (tried["y"] == left["b"]), "left_anti")
    links = links.unionByName(written(verified(left, texts, width, percent)))
    spark.sql(f"DROP TABLE {stored}")
    in_graph = members.filter("node IS NOT NULL").select("doc_id", "node")
    several = in_graph.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z").select("doc_id", "a")
    links = links.unionByName(in_graph.join(several, "doc_id").filter("a < node").select("a", F.col("node").alias("b")).distinct())
    components = connected_components(links)

    placed = members.join(components, "node", "left")
    return placed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))
