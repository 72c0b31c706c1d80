"""Substring dedup by seed and extend: winnowed anchors, windows around them, maximal repeats.

Of the word runs of ``anchor`` words inside every window of ``window`` words,
winnowing picks the one with the smallest hash. Two documents that share a
window share its anchor, so

1. anchors that two documents hold are the seeds (one aggregation by anchor);
2. from each seed, matches are extended both ways: every window around it, to
   the left and to the right as far as the anchor stays its smallest, is
   compared with the windows other documents have around the same seed. A
   window is known by two 64-bit hashes, its anchor's and its own;
3. a window that also starts in a document with a smaller id is a repeat;
   neighbouring repeats make the maximal repeats, whose words are removed.

Only windows around seeds are shuffled. Within a batch, of equal windows only
that of the smallest id is sent; the others are repeats already. Windows around
an anchor held by very many documents are dealt out one by one instead of by
anchor, so no group grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebridge.llm.native import id_and_text
from ratebridge.llm.shingles import ROLL_A, ROLL_B, places, rolling, stretches, utf8, word_hashes

REPEATS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
#: Anchors in more documents than this have their windows dealt out one by one.
OFTEN = 2000


def winnow(hashes: np.ndarray, counts: np.ndarray, window: int, anchor: int):
    """Of each run of ``window`` words: (document, whether it lies within, place of its anchor, anchor hashes)."""
    runs = rolling(hashes, anchor, ROLL_A)
    n = max(0, len(hashes) - window + 1)
    owner, inside = places(counts, window, n)
    if not n:
        return owner, inside, np.zeros(0, np.int64), runs
    # The low bits give way to the place, from the right: one minimum finds the smallest
    # run and, of equal ones, the last, so that choices of neighbouring windows agree.
    offsets = window - anchor
    low = np.uint64((1 << offsets.bit_length()) - 1)
    ranked = runs & ~low
    best = ranked[:n] + np.uint64(offsets)
    for j in range(1, offsets + 1):
        np.minimum(best, ranked[j:j + n] + np.uint64(offsets - j), out=best)
    at = np.arange(n) + (offsets - (best & low).astype(np.int64))
    return owner, inside, at, runs


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def has_smaller(seed: np.ndarray, whole: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of windows known by two hashes: whether one with a smaller id is equal. Only those that meet another are sorted by both."""
    order = np.argsort(whole)
    same = whole[order[1:]] == whole[order[:-1]]
    meets = np.zeros(len(order), bool)
    meets[1:] |= same
    meets[:-1] |= same
    order = order[meets]
    order = order[np.lexsort((seed[order], whole[order]))]
    out = np.zeros(len(whole), bool)
    if len(order):
        new = np.ones(len(order), bool)
        new[1:] = (seed[order[1:]] != seed[order[:-1]]) | (whole[order[1:]] != whole[order[:-1]])
        first = np.flatnonzero(new)
        least = np.minimum.reduceat(ids[order], first)
        out[order] = ids[order] > np.repeat(least, np.diff(first, append=len(order)))
    return out


def remove_repeats(
    docs: DataFrame,
    window: int = 13,
    anchor: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, repeats (array of (start, length), in words), kept_text.

    A word goes if a window over it also starts in a document with a smaller id;
    windows are judged on the input. ``kept_text`` is the kept words joined by a
    blank. A null or empty text has no words; a row without an id is no source
    and keeps its words; rows with one id are not compared with each other; an
    empty table gives no rows; other columns are not read. Ids are integers.
    """
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.withColumn("text_key", F.xxhash64("text"))  # tells rows of one id apart
    known = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL")

    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1000):
                hashes, counts = word_hashes(utf8(part.column(1)))
                owner, inside, at, runs = winnow(hashes, counts, window, anchor)
                picked = np.zeros(len(runs), bool)
                picked[at[inside]] = True
                at = np.flatnonzero(picked)
                ids = part.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays([signed(runs[at]), pa.array(ids[np.repeat(np.arange(len(ids)), counts)[at]])], names=["anchor", "doc_id"])

    held = known.select("doc_id", "text").mapInArrow(anchors_of, "anchor long, doc_id long")
    seeds = held.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    seeds = seeds.filter("low < high").select("anchor", (F.col("n") > OFTEN).alias("often"))
    seeded = held.join(seeds, "anchor").groupBy("doc_id").agg(
        F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("often"), F.col("anchor"))).alias("often"))

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of windows to compare (hashes of ``n`` neighbours from ``start``), and of repeats found here (no hashes)."""
        for batch in batches:
            for part in slices(batch, 2000):
                ids, texts, keys = part.column(0).to_numpy(), utf8(part.column(1)), part.column(2).to_numpy()
                hashes, counts = word_hashes(texts)
                owner, inside, at, runs = winnow(hashes, counts, window, anchor)
                if not inside.any():
                    continue
                whole, begins = rolling(hashes, window, ROLL_B), np.cumsum(counts) - counts
                seed, spread = runs[at], np.zeros(len(at), bool)
                around = np.zeros(len(at), bool)
                for i in range(len(ids)):
                    a, b = begins[i], min(begins[i] + counts[i], len(at))
                    if a < b:
                        mine = part.column(3)[i].values.to_numpy().view(np.uint64)
                        around[a:b] = np.isin(seed[a:b], mine)
                        often = part.column(4)[i].values.to_numpy().view(np.uint64)
                        if len(often):
                            spread[a:b] = np.isin(seed[a:b], often)
                chosen = np.flatnonzero(around & inside)
                repeat = np.zeros(len(at), bool)
                repeat[chosen] = has_smaller(seed[chosen], whole[chosen], ids[owner[chosen]])
                # A repeat seen in the batch needs no comparison.
                first, n = stretches(np.flatnonzero(repeat), owner)
                yield emit(ids, keys, owner, begins, first, n, None, None, np.zeros(0, np.uint64))
                left = chosen[~repeat[chosen]]
                single = left[spread[left]]
                first, n = stretches(left[~spread[left]], at)
                yield emit(ids, keys, owner, begins, first, n, seed[first], np.zeros(len(first), np.uint64), whole[left[~spread[left]]])
                yield emit(ids, keys, owner, begins, single, np.ones(len(single), np.int64), seed[single], whole[single], whole[single])

    def emit(ids, keys, owner, begins, first, n, seed, salt, hashes) -> pa.RecordBatch:
        start, doc = first - begins[owner[first]], owner[first]
        if seed is None:  # dealt out by document and place, as nothing is left to compare
            seed, salt, ends = ids[doc].astype(np.uint64), start.astype(np.uint64), np.zeros(len(first) + 1, np.int64)
        else:
            ends = np.concatenate([[0], np.cumsum(n)])
        binary = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((ends * 8).astype(np.int32).tobytes()), pa.py_buffer(hashes.tobytes())])
        return pa.RecordBatch.from_arrays(
            [signed(seed), signed(salt), pa.array(ids[doc]), pa.array(keys[doc]), pa.array(start), pa.array(n), binary],
            names=["anchor", "salt", "doc_id", "text_key", "start", "n", "hashes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor and salt; whole groups are compared, the last waits for the next batch."""
        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if waiting is None else [*waiting.to_batches(), batch]).combine_chunks()
            a, s = rows["anchor"].to_numpy(), rows["salt"].to_numpy()
            last = int(np.flatnonzero((a != a[-1]) | (s != s[-1]))[-1]) + 1 if ((a != a[-1]) | (s != s[-1])).any() else 0
            waiting = rows.slice(last)
            if last:
                yield from found(rows.slice(0, last))
        if waiting is not None and waiting.num_rows:
            yield from found(waiting)

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes = rows["hashes"].combine_chunks()
        hashes = hashes.chunk(0) if isinstance(hashes, pa.ChunkedArray) else hashes
        ends = np.frombuffer(hashes.buffers()[1], np.int32)[hashes.offset:hashes.offset + len(hashes) + 1]
        width = np.diff(ends) // 8
        ids, start, n, keys = (rows[c].to_numpy() for c in ("doc_id", "start", "n", "text_key"))
        done = np.flatnonzero(width == 0)
        yield pa.RecordBatch.from_arrays([pa.array(x[done]) for x in (ids, keys, start, n)], names=["doc_id", "text_key", "start", "n"])
        row = np.repeat(np.arange(len(ids)), width)
        if not len(row):
            return
        whole = np.frombuffer(hashes.buffers()[2], np.uint64, (ends[-1] - ends[0]) // 8, ends[0])
        repeat = has_smaller(rows["anchor"].to_numpy()[row], whole, ids[row])
        first, length = stretches(np.flatnonzero(repeat), row)
        of = row[first]
        step = first - (np.cumsum(width) - width)[of]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[of], keys[of], start[of] + step, length)], names=["doc_id", "text_key", "start", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 500):
                out: list[list] = [[], [], [], []]
                for text, key, found in zip(utf8(part.column(1)), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    words = (text or b"").split()
                    gone = np.zeros(len(words), bool)
                    for x in found or ():
                        if x["text_key"] == key:
                            gone[x["start"]:x["start"] + x["n"] + window - 1] = True
                    first, length = stretches(np.flatnonzero(gone))
                    out[0].append(len(words))
                    out[1].append(int(gone.sum()))
                    out[2].append([{"start": a, "length": b} for a, b in zip(first.tolist(), length.tolist(), strict=True)])
                    out[3].append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if len(first) else words))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], REPEATS), pa.array(out[3], pa.binary()).cast(pa.string())],
                                                 names=["doc_id", "n_words", "n_removed", "repeats", "kept_text"])

    compared = known.join(seeded, "doc_id").mapInArrow(windows_of, "anchor long, salt long, doc_id long, text_key long, start long, n long, hashes binary")
    dealt = compared.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    repeats = dealt.mapInArrow(compare, "doc_id long, text_key long, start long, n long")
    repeats = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("text_key", "start", "n")).alias("found"))
    judged = known.join(repeats, "doc_id", "left")
    apart = rows.filter("doc_id IS NULL OR text IS NULL").withColumn("found", F.lit(None).cast(judged.schema["found"].dataType))
    result = "doc_id long, n_words long, n_removed long, repeats array<struct<start:long,length:long>>, kept_text string"
    return judged.unionByName(apart).select("doc_id", "text", "text_key", "found").mapInArrow(cut, result)
