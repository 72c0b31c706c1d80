"""Line dedup by pairwise alignment: shared lines find pairs, patience diff aligns them.

The earliest document (smallest id) that holds a line is the line's first
holder. A document is paired with the first holder of every line it shares, so
there is at most one pair a document and line: pairs grow with the lines of the
corpus, not with the square of a group of copies.

Each pair is aligned by patience diff over line digests: lines that occur once
in both documents, in their longest common order, are matched first, then
equal lines next to matched ones, then the gaps between by the same steps. A gap
without such a line is matched by a longest common subsequence: of lines that
are a block alone, or else of all its lines.
Matched lines that follow one another in both documents are a common block; the
later document loses blocks of at least ``min_block_words`` words.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebridge.llm.native import words_of
from ratebridge.llm.tables import small_batches

#: Bits of a longest common subsequence's table held at a time; larger ones are split.
TABLE_BITS = 1 << 26

BLOCKS = pa.list_(pa.struct([("first", pa.int32()), ("lines", pa.int32()), ("earlier", pa.int64())]))


def longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs in order of their first number, a longest run with rising second numbers."""
    tops: list[int] = []  # smallest last number of a run, by length
    at: list[int] = []
    back: list[int] = []
    for i, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        tops[k:k + 1] = [j]
        at[k:k + 1] = [i]
        back.append(at[k - 1] if k else -1)
    run, i = [], at[-1] if at else -1
    while i >= 0:
        run.append(pairs[i])
        i = back[i]
    return run[::-1]


def subsequence_rows(a: list, b: list) -> Iterator[int]:
    """For each length i of a prefix of a, from 1: bit j is 0 where a[:i] has one more common line with b[:j + 1]
    than with b[:j]."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    row = every
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & every
        yield row


def prefix_lengths(a: list, b: list) -> list[int]:
    """Length of the longest common subsequence of a and b[:j], for j from 0."""
    *_, row = subsequence_rows(a, b)
    bits = bin(row | 1 << len(b))[:2:-1]
    return [0, *accumulate(x == "0" for x in bits)]


def longest_common(a: list, b: list) -> list[tuple[int, int]]:
    """Places (i, j) of a longest common subsequence, rising; memory grows with the longer list."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, i, b0, j = todo.pop()
        if i - a0 > 1 and (i - a0) * (j - b0) > TABLE_BITS:
            half = (a0 + i) // 2
            head = prefix_lengths(a[a0:half], b[b0:j])
            tail = prefix_lengths(a[half:i][::-1], b[b0:j][::-1])[::-1]
            cut = b0 + max(range(j - b0 + 1), key=lambda k: head[k] + tail[k])
            todo += [(a0, half, b0, cut), (half, i, cut, j)]
            continue
        rows = list(subsequence_rows(a[a0:i], b[b0:j]))
        while i > a0 and j > b0:
            if a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                found.append((i, j))
            elif rows[i - 1 - a0] >> (j - 1 - b0) & 1:
                j -= 1
            else:
                i -= 1
    return sorted(found)


def patience_matches(a: list, b: list, alone: frozenset = frozenset()) -> list[tuple[int, int]]:
    """Matched places (i, j), a[i] == b[j], rising in both. Where no line occurs once in both, those in ``alone``
    come before others."""
    matches, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matches.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matches.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        once = [(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place]
        i0, j0 = a0, b0
        spine = longest_rising(once)
        both = in_a.keys() & in_b.keys()
        for of in () if spine else (both & alone, both):
            if not spine and of:
                at_a, at_b = [i for i in range(a0, a1) if a[i] in of], [j for j in range(b0, b1) if b[j] in of]
                spine = [(at_a[i], at_b[j]) for i, j in longest_common([a[i] for i in at_a], [b[j] for j in at_b])]
        for i, j in spine:
            todo.append((i0, i, j0, j))
            matches.append((i, j))
            i0, j0 = i + 1, j + 1
        if spine:
            todo.append((i0, a1, j0, b1))
    return sorted(matches)


def common_blocks(a: list, b: list, words: list[int], least: int) -> list[tuple[int, int]]:
    """(first line, lines) in ``b`` of runs of matched lines with at least ``least`` words."""
    blocks: list[list[int]] = []
    for i, j in patience_matches(a, b, frozenset(x for x, n in zip(b, words, strict=True) if n >= least)):
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1][2] += 1
        else:
            blocks.append([i, j, 1])
    return [(j, n) for _, j, n in blocks if sum(words[j:j + n]) >= least]


def remove_aligned_lines(
    docs: DataFrame,
    min_line_words: int = 4,
    min_block_words: int = 8,
    rare_documents: int | None = None,
    rare_factor: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, the ``keep`` columns, n_lines, n_removed, blocks (array of (first, lines,
    earlier)), kept_text (the lines that stay, joined by line feeds).

    Lines are the text split at line feeds; a line with fewer than
    ``min_line_words`` words finds no partner but may stand in a block. Pairs are
    judged on the input. A null text stays null, with no lines; an empty one is
    one empty line; rows without an id are no partners and stay whole; rows with
    one id are not compared with each other; an empty table gives no rows. Other
    columns are not read. Ids are integers.

    ``rare_documents`` gives up completeness, for callers who ask for it: only
    lines that at most so many documents hold, or ``rare_factor`` times as many
    as hold the document's rarest shared line, then find partners.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), F.struct(*[docs[c] for c in keep]).alias("kept") if keep else F.lit(None).cast("string").alias("kept"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))  # tells rows of one id apart
    lines = F.split("text", "\n", -1)
    lined = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text_key", lines.alias("lines"))
    lined = lined.select("doc_id", "text_key", F.transform("lines", lambda x: F.unhex(F.md5(x))).alias("digests"), F.transform("lines", lambda x: F.size(words_of(x))).alias("words"))
    lined = lined.checkpoint()  # 20 bytes a line, read four times
    told = lined.select("doc_id", F.explode(F.array_distinct(F.arrays_zip("digests", "words"))).alias("line"))
    told = told.filter(F.col("line.words") >= min_line_words).select("doc_id", F.col("line.digests").alias("digest"))
    holders = told.groupBy("digest").agg(F.min("doc_id").alias("earlier"), F.count("*").alias("n")).filter("n > 1")
    shared = told.join(holders, "digest").filter("earlier < doc_id")
    pairs = shared.select("doc_id", "earlier").distinct()
    if rare_documents is not None:
        found = shared.groupBy("doc_id").agg(F.collect_set(F.struct("n", "earlier")).alias("found"))
        often = F.greatest(F.lit(rare_documents), F.array_min("found")["n"] * rare_factor)
        rare = F.array_distinct(F.transform(F.filter("found", lambda x: x["n"] <= F.col("often")), lambda x: x["earlier"]))
        pairs = found.withColumn("often", often).select("doc_id", F.explode(rare).alias("earlier"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 500):
                before, after, words, earlier = (batch.column(i).slice(at, 500).to_pylist() for i in (2, 3, 4, 5))
                out += [[{"first": j, "lines": n, "earlier": e} for j, n in common_blocks(a, b, w, min_block_words)]
                        for a, b, w, e in zip(before, after, words, earlier, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, BLOCKS)], names=["doc_id", "text_key", "blocks"])

    later = pairs.join(lined, "doc_id")
    both = later.join(lined.select(F.col("doc_id").alias("earlier"), F.col("digests").alias("before")), "earlier")
    aligned = both.select("doc_id", "text_key", "before", "digests", "words", "earlier").mapInArrow(
        align, "doc_id long, text_key long, blocks array<struct<first:int,lines:int,earlier:long>>")
    blocks = aligned.filter(F.size("blocks") > 0).groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("blocks")).alias("blocks"))
    blocks = blocks.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.sort_array("blocks").alias("blocks"))
    judged = rows.join(blocks, (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    none = F.array().cast("array<struct<first:int,lines:int,earlier:bigint>>")
    judged = judged.withColumn("blocks", F.coalesce("blocks", none)).withColumn("lines", lines)
    gone = F.array_distinct(F.flatten(F.transform("blocks", lambda x: F.sequence(x["first"], x["first"] + x["lines"] - 1))))
    judged = judged.withColumn("stay", F.when(F.size("blocks") > 0, F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)))
    kept_text = F.when(F.size("blocks") > 0, F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")).otherwise(F.col("text"))
    n_lines = F.coalesce(F.size("lines"), F.lit(0)).cast("long")
    n_lines = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    removed = F.when(F.size("blocks") > 0, n_lines - F.size("stay")).otherwise(F.lit(0)).cast("long")
    return judged.select("doc_id", *[F.col(f"kept.{c}").alias(c) for c in keep], n_lines.alias("n_lines"), removed.alias("n_removed"), "blocks", kept_text.alias("kept_text"))


def has_words(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
