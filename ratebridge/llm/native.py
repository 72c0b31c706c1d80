"""Small builders of column expressions for operators that stay in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge.llm.workers import WORD_PATTERN

#: Positions summed one after the other within a part, so building arrays stays linear.
PART = 256


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text), the id as a long.

    Columns that are so already are taken as they are: without renaming, Spark
    sees that two uses of the rows need one and the same shuffle.
    """
    key = docs[id_col] if id_col == "doc_id" and docs.schema[id_col].dataType == T.LongType() else docs[id_col].cast("long").alias("doc_id")
    return docs.select(key, docs[text_col] if text_col == "text" else docs[text_col].alias("text"))


def words_of(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)), F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column, kind: str = "long") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda a, x: a + x)


def running_starts(lengths: Column) -> Column:
    """Start of each stretch, given an array of lengths (long) that follow one another from 0."""

    def within(part: Column, start: Column) -> Column:
        grown = F.aggregate(part, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.slice(grown, 1, F.size(part))

    def all_parts(parts: Column) -> Column:
        starts = within(F.transform(parts, lambda p: total(p)), F.lit(0).cast("long"))
        return F.flatten(F.zip_with(parts, starts, within))

    n_parts = F.ceil(F.size(lengths) / F.lit(PART)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n_parts - 1), lambda i: F.slice(lengths, i * PART + 1, F.lit(PART)))
    return F.when(F.size(lengths) > 0, let(cut, all_parts)).otherwise(F.array().cast("array<bigint>"))


def occurrences(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, part), in code points, end exclusive.

    ``part`` is the text of the group. Gaps between matches come from splitting
    at the pattern; a start is the sum of all gaps and matches before it.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.length(m).cast("long"))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    strides = F.zip_with(gaps, sizes, lambda g, m: F.struct(g.alias("gap"), m.alias("size")))  # one more gap than sizes

    def place(strides: Column) -> Column:
        starts = let(F.transform(strides, lambda x: x["gap"] + x["size"]), running_starts)
        spans = F.zip_with(starts, strides, lambda s, x: F.struct((s + x["gap"]).alias("start"), (s + x["gap"] + x["size"]).alias("end")))
        return F.zip_with(spans, parts, lambda x, p: F.struct(x["start"].alias("start"), x["end"].alias("end"), p.alias("part")))

    return let(F.filter(strides, lambda x: x["size"].isNotNull()), place)
