"""Mixing sources to target weights with a low-discrepancy schedule.

Targets share a total by weight; a source stops at ``max_repeats`` times its
size and the excess is shared again. Each source is a stream: its documents in
a shuffled order, cut into blocks of ``block_words`` words, read again from the
start when it ends. Slot j of the schedule goes to the source in whose share of
[0, 1) the j-th point of a golden-ratio sequence falls; the r-th slot of a source
takes the r-th block of its stream. So every stretch of the mix holds the
sources in their shares, up to a few slots.

A source gets exactly the slots that reach its target, the last cut at the
target's word: surplus points are left out, and slots still missing follow at
the end (a few a source, the discrepancy of the sequence).

Ranks and running sums are taken within chunks of bounded size, plus offsets
from a table with one row a chunk, so no source is sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebridge.session import ensure_checkpoint_dir

#: The golden-ratio sequence in integers: point j is (j * STEP mod 2^31) / 2^31 (fixed values).
CIRCLE = 1 << 31
STEP = 1327217885
#: Bins of the circle for the search of a point's source, by equality instead of by range.
BIN_BITS = 15
#: Slots of a chunk within which ranks are counted, and documents of a chunk on average.
SLOT_CHUNK, DOC_CHUNK = 1 << 14, 50_000


def running_offsets(chunks: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Adds ``offset``: the sum of ``value`` in earlier chunks of the key. One row a key and chunk."""
    before = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return chunks.withColumn("offset", F.coalesce(F.sum(value).over(before), F.lit(0)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """From (source, source_size): adds place (by code point, null last), weight and target.

    The target is weight * level, at most max_repeats * source_size, with the one
    level at which targets add up to the total: sources with the smallest room
    per weight are full, the level shares the rest among the others. One row a
    source, so windows over all sources are small.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    placed = sizes.withColumn("place", F.row_number().over(by_name).cast("long"))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    placed = placed.withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    placed = placed.withColumn("room", F.col("source_size") * max_repeats)
    by_room = Window.orderBy((F.col("room") / F.col("weight")).asc(), "place")
    everywhere = Window.partitionBy()
    placed = placed.withColumn("full", F.coalesce(F.sum("room").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.withColumn("open", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
    level = (F.sum("source_size").over(everywhere) - F.col("full")) / F.col("open")
    placed = placed.withColumn("_level", level)
    fits = F.when(F.col("room") / F.col("weight") >= F.col("_level"), F.struct((F.col("room") / F.col("weight")).alias("r"), "place", "_level"))
    placed = placed.withColumn("level", F.min(fits).over(everywhere)["_level"])
    target = F.least(F.col("weight") * F.col("level"), F.col("room").cast("double"))
    return placed.select("source", "source_size", "place", "weight", target.alias("target"))


def shuffled_streams(docs: DataFrame, n_docs: int, seed: int) -> DataFrame:
    """Adds start and end: the words of its source's stream that a document holds. Needs place and size > 0."""
    chunks = max(16, math.ceil(n_docs / DOC_CHUNK))
    lot = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "copy"))
    first = F.conv(F.substring("lot", 1, 8), 16, 10).cast("long")  # chunks are in the order of lots
    rows = docs.withColumn("lot", lot).withColumn("chunk", F.floor(first * chunks / float(1 << 32)))
    sums = rows.groupBy("place", "chunk").agg(F.sum("size").alias("words"))
    offsets = running_offsets(sums, ["place"], "chunk", "words").select("place", "chunk", "offset")
    order = Window.partitionBy("place", "chunk").orderBy("lot", "doc_id", "size", "copy")
    rows = rows.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(offsets, ["place", "chunk"])
    return rows.withColumn("end", F.col("offset") + F.col("upto")).withColumn("start", F.col("end") - F.col("size"))


def slot_schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """(slot, place, rank, block, epoch, upto): the schedule, and the word of the epoch at which it stops.

    Slots after the sequence's end (those still missing) all have the number of its points.
    """
    spark = sources.sparkSession
    words = F.floor("target")
    epochs, rest = F.floor(words / F.col("source_size")), words % F.col("source_size")
    epochs = F.least(epochs, (words - rest) / F.col("source_size")).cast("long")
    per_epoch = F.ceil(F.col("source_size") / block_words).cast("long")
    quota = epochs * per_epoch + F.ceil(rest / block_words).cast("long")
    quotas = sources.filter("source_size > 0").select("place", "source_size", words.cast("long").alias("words"), per_epoch.alias("per_epoch"), quota.alias("quota"))
    points = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    by_place = Window.orderBy("place")
    upto = F.sum("quota").over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    circle = lambda q: F.floor(q / F.lit(float(max(points, 1))) * float(CIRCLE))
    arcs = quotas.withColumn("hi", circle(upto)).withColumn("lo", circle(upto - F.col("quota")))
    bins = arcs.filter("hi > lo").withColumn("bin", F.explode(F.sequence(F.shiftright("lo", BIN_BITS), F.shiftright(F.col("hi") - 1, BIN_BITS))))
    slots = spark.range(points).withColumnRenamed("id", "slot")
    slots = slots.withColumn("point", (F.col("slot") % CIRCLE) * STEP % CIRCLE).withColumn("bin", F.shiftright("point", BIN_BITS))
    dealt = slots.join(bins.select("bin", "lo", "hi", "place"), "bin").filter("lo <= point AND point < hi")
    dealt = dealt.select("slot", "place", F.floor(F.col("slot") / SLOT_CHUNK).alias("chunk"))
    within = Window.partitionBy("place", "chunk").orderBy("slot")
    counts = dealt.groupBy("place", "chunk").agg(F.count("*").alias("n"))
    offsets = running_offsets(counts, ["place"], "chunk", "n").select("place", "chunk", "offset")
    ranked = dealt.withColumn("row", F.row_number().over(within)).join(offsets, ["place", "chunk"])
    ranked = ranked.select("slot", "place", (F.col("offset") + F.col("row") - 1).alias("rank"))
    have = counts.groupBy("place").agg(F.sum("n").alias("have"))
    short = quotas.join(have, "place", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("have < quota")
    tail = short.select(F.lit(points).alias("slot"), "place", F.explode(F.sequence(F.col("have"), F.col("quota") - 1)).alias("rank"))
    all_slots = ranked.unionByName(tail).join(quotas, "place").filter("rank < quota")
    epoch = F.floor(F.col("rank") / F.col("per_epoch"))
    return all_slots.select("slot", "place", "rank", (F.col("rank") % F.col("per_epoch")).alias("block"), epoch.alias("epoch"),
                            (F.col("words") - epoch * F.col("source_size")).alias("upto"))


def mix_sources(
    docs: DataFrame,
    size: Column,
    weights: tuple[int, ...] = (5, 2, 1),
    max_repeats: int = 3,
    block_words: int = 256,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sources, mix) of a corpus; ``size`` is the number of words of a row, from 0.

    documents: doc_id, source, size, copy, place. Rows equal in the first three
    are told apart by ``copy`` (from 1); which of them is which does not matter.
    sources: source, source_size, place, weight, target.
    mix: slot, epoch, place, doc_id, size, copy, first_word, n_words: the words of
    a document that a slot takes, in the words' order within the slot by stream.

    A null source is a source of its own, last in order; a null id is an id like
    others; rows without words are never taken; an empty table gives empty results.
    Other columns are not read. Equal input gives an equal mix, however partitioned.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), size.cast("long").alias("size"))
    copies = narrow.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies").checkpoint()
    sizes = copies.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = source_targets(sizes, weights, max_repeats).checkpoint()
    documents = copies.join(sources.select(F.col("source").alias("_source"), "place"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    streams = shuffled_streams(documents.filter("size > 0"), copies.count(), seed)
    block = F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("end") - 1) / block_words)))
    pieces = streams.select("place", "doc_id", "size", "copy", "start", "end", block.alias("block"))
    taken = slot_schedule(sources, block_words).join(pieces, ["place", "block"])
    low = F.greatest("start", F.col("block") * block_words)
    high = F.least("end", (F.col("block") + 1) * block_words, "upto")
    mix = taken.select("slot", "epoch", "place", "doc_id", "size", "copy", (low - F.col("start")).alias("first_word"), (high - low).alias("n_words"))
    return documents, sources, mix.filter("n_words > 0")


def words_taken(documents: DataFrame, sources: DataFrame, mix: DataFrame) -> DataFrame:
    """documents with source_size, target and taken (words the mix takes, repeats counted)."""
    sums = mix.groupBy("doc_id", "size", "copy", "place").agg(F.sum("n_words").alias("words"))
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in sums.columns])
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("size") == F.col("_size")) & (F.col("copy") == F.col("_copy")) & (F.col("place") == F.col("_place"))
    joined = documents.join(sums, same, "left").join(sources.select("place", "source_size", "target"), "place")
    return joined.select("doc_id", "source", "size", "copy", "source_size", "target", F.coalesce("_words", F.lit(0)).alias("taken"))
