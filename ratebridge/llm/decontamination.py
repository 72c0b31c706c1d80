"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts and items are lower-cased (A to Z) and read as words of letters, digits and
all characters beyond ASCII. The automaton holds every run of words of every item;
a text is streamed through it, and after each word the state tells the longest run
ending there that occurs in some item. A match is a hit where it is at least
``length`` words long or covers at least the share ``coverage`` of an item, so the
window of an item is the smaller of the two.

The automaton is broadcast in shards of at most ``shard_words`` words, so its size
is bounded whatever the number of items; texts pass the shards one after the other.
Before a text meets the automaton, stretches without enough runs of ``GRAM`` words
known from the items are left out: no window can lie in them.
"""

from __future__ import annotations

import itertools
import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge.llm.shingles import mixed, utf8
from ratebridge.llm.tables import written
from ratebridge.llm.workers import per_worker

#: Bytes that belong to a word, lower-cased; all others become blanks.
NORMAL = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
#: Words of the text as it stands.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Longest runs whose hashes are looked up before the automaton is asked.
GRAM = 4
#: Bits of the table of known runs.
TABLE_BITS = 22
#: Bytes of text split into words at a time, and of texts looked at together.
SLICE = 1 << 20
#: Words of an item in one piece.
PIECE = 4096


def normal_words(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in UTF-8, in lists of bounded size."""
    text = text.translate(NORMAL)
    at = 0
    while at < len(text):
        cut = text.find(b" ", at + SLICE)
        cut = len(text) if cut < 0 else cut
        yield text[at:cut].split()
        at = cut


@dataclass(frozen=True)
class Automaton:
    """Plain arrays, so that a broadcast of ``parts()`` needs no class of this package.

    ``step`` maps state * number of words + word to the next state; ``owners_of[s]``
    are the items with a window that ends in the class of state s, as (window
    length, item) pairs, and ``marked[s]`` is the nearest state with such pairs on
    the way up the suffix links, s included.
    """

    words: dict
    step: dict
    link: list
    length: list
    marked: list
    owners_of: dict
    items: list
    table: np.ndarray
    gram: int
    least: int


def build(pieces: list[tuple[str | None, list[bytes], int]]) -> tuple:
    """Arrays of the automaton of (item, words, window length) pieces; see ``loaded``."""
    vocabulary: dict[bytes, int] = {}
    coded = [[vocabulary.setdefault(w, len(vocabulary)) for w in words] for _, words, _ in pieces]
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def new_state(size: int, edges: dict, up: int) -> int:
        nexts.append(edges), link.append(up), length.append(size)
        return len(nexts) - 1

    def split(state: int, word: int) -> int:
        """The state of the longest run of ``state`` followed by ``word``, apart from longer ones."""
        target = nexts[state][word]
        if length[target] == length[state] + 1:
            return target
        copy = new_state(length[state] + 1, dict(nexts[target]), link[target])
        link[target] = copy
        while state >= 0 and nexts[state].get(word) == target:
            nexts[state][word] = copy
            state = link[state]
        return copy

    for codes in coded:
        last = 0
        for word in codes:
            if word in nexts[last]:
                last = split(last, word)
                continue
            state, at = new_state(length[last] + 1, {}, 0), last
            while at >= 0 and word not in nexts[at]:
                nexts[at][word] = state
                at = link[at]
            link[state] = split(at, word) if at >= 0 else 0
            last = state

    items = sorted({item for item, *_ in pieces if item is not None})
    number = {item: i for i, item in enumerate(items)}
    owners: dict[int, set] = {}
    for (item, _, window), codes in zip(pieces, coded, strict=True):
        state = 0
        for place, word in enumerate(codes, 1):
            state = nexts[state][word]
            if place < window:
                continue
            at = state
            while length[link[at]] >= window:
                at = link[at]
            owners.setdefault(at, set()).add((window, number.get(item, -1)))
    keys = np.array([s * len(vocabulary) + w for s, edges in enumerate(nexts) for w in edges], np.int64)
    targets = np.array([t for edges in nexts for t in edges.values()], np.int64)
    pairs = np.array([(s, w, i) for s, found in owners.items() for w, i in sorted(found)], np.int64).reshape(-1, 3)
    least = min((window for *_, window in pieces), default=1)
    gram = min(GRAM, least)
    table = np.zeros(1 << TABLE_BITS, bool)
    for codes in coded:
        table[gram_places(np.array(codes, np.int64), gram)] = True
    return b" ".join(vocabulary), keys, targets, np.array(link), np.array(length), pairs, items, np.packbits(table), gram, least


def loaded(parts: tuple) -> Automaton:
    """The automaton as a worker uses it."""
    words, keys, targets, link, length, pairs, items, table, gram, least = parts
    owners_of: dict[int, list] = {}
    for state, window, item in pairs.tolist():
        owners_of.setdefault(state, []).append((window, item))
    up, marked = link.tolist(), [-1] * len(link)
    for state in np.argsort(length, kind="stable").tolist():
        marked[state] = state if state in owners_of else marked[up[state]] if state else -1
    return Automaton({w: i for i, w in enumerate(words.split(b" "))} if words else {}, dict(zip(keys.tolist(), targets.tolist(), strict=True)),
                     up, length.tolist(), marked, owners_of, items, np.unpackbits(table).astype(bool), gram, least)


def gram_places(codes: np.ndarray, gram: int) -> np.ndarray:
    """Place in the table of each run of ``gram`` words."""
    n = len(codes) - gram + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for j in range(gram):
        out = mixed(out ^ (codes[j:j + n].astype(np.uint64) + np.uint64(1)))
    return (out >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def likely_stretches(automaton: Automaton, codes: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of stretches of words that may hold a window; unknown words are -1."""
    gram = automaton.gram
    n = len(codes) - gram + 1
    if n <= 0 or not automaton.step:
        return []
    unknown = np.concatenate([[0], np.cumsum(codes < 0)])
    known = automaton.table[gram_places(codes, gram)] & (unknown[gram:] == unknown[:-gram])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], known.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    enough = ends - starts >= automaton.least - gram + 1
    return list(zip(starts[enough].tolist(), (ends[enough] + gram - 1).tolist(), strict=True))


def matches(automaton: Automaton, codes: list[int], start: int) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, items) of the windows that end at each word, streamed through the automaton."""
    a, width = automaton, len(automaton.words)
    state, size = 0, 0
    for place, word in enumerate(codes, start + 1):
        target = a.step.get(state * width + word)
        while target is None and state:
            state = a.link[state]
            size = a.length[state]
            target = a.step.get(state * width + word)
        if target is None:
            size = 0
            continue
        state, size = target, size + 1
        at = a.marked[state]
        while at >= 0:
            held = [(w, i) for w, i in a.owners_of[at] if w <= size]
            if held:
                yield place - max(w for w, _ in held), place, [i for _, i in held]
            at = a.marked[a.link[at]] if at else -1


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without those words and what stands between them."""
    if not spans:
        return text
    out, at, ahead = [], 0, iter(spans)
    start, end = next(ahead)
    for number, word in enumerate(WORD.finditer(text)):
        if number == start:
            out.append(text[at:word.start()])
        if number == end - 1:
            at = word.end()
            start, end = next(ahead, (-1, -1))
    return "".join([*out, text[at:]])


def item_pieces(items: DataFrame, length: int, coverage: float, id_col: str, text_col: str) -> DataFrame:
    """(item, words, n, window): items in pieces of bounded size that overlap by a window less a word."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = list(itertools.chain.from_iterable(normal_words(text or b"")))
                window = min(length, max(1, math.ceil(coverage * len(words))))
                starts = range(0, max(1, len(words) - window + 1), PIECE) if words else ()
                parts = [words[s:s + PIECE + window - 1] for s in starts]
                if parts:
                    arrays = [pa.array([item] * len(parts), pa.string()), pa.array([b" ".join(p) for p in parts], pa.binary()),
                              pa.array([len(p) for p in parts], pa.int32()), pa.array([window] * len(parts), pa.int32())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["item", "words", "n", "window"])

    texts = items.select(items[id_col].cast("string"), items[text_col])
    return texts.mapInArrow(cut, "item string, words binary, n int, window int").distinct()


def shards(pieces: DataFrame, shard_words: int) -> tuple[DataFrame, int]:
    """Pieces dealt into shards (column ``shard``) of at most ``shard_words`` words, and their number."""
    total = pieces.agg(F.sum("n")).first()[0] or 0
    count = max(1, math.ceil(total / shard_words))
    while True:
        dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(count)))
        if count == 1 or (dealt.groupBy("shard").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0) <= max(shard_words, 2 * PIECE):
            return dealt, count
        count *= 2


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def scan_shard(docs: DataFrame, parts: tuple, first: bool) -> DataFrame:
    """``docs`` (kept columns, text, then n_words, spans and items of earlier shards) with those of this shard."""
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # bounded by shard_words
    found_fields = [T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))]
    schema = T.StructType([*docs.schema.fields, *found_fields]) if first else docs.schema
    n_kept = len(schema) - 3
    key = ("automaton", uuid.uuid4().hex)
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def look(texts: list[bytes | None], automaton: Automaton):
        """(number of words, spans, items) of each text."""
        out, waiting = [[0, [], set()] for _ in texts], []

        def flush():
            codes = np.concatenate([c for _, c in waiting])
            starts = np.cumsum([0, *(len(c) for _, c in waiting)])
            for start, end in likely_stretches(automaton, codes):
                row = int(np.searchsorted(starts, start, "right")) - 1
                doc, base = out[waiting[row][0]], int(starts[row])
                for a, b, found in matches(automaton, codes[start:end].tolist(), start - base):
                    doc[1].append((a, b))
                    doc[2].update(found)
            waiting.clear()

        size = 0
        for row, text in enumerate(texts):
            if not text:
                continue
            part = [np.fromiter(map(automaton.words.get, w, itertools.repeat(-1)), np.int64, len(w)) for w in normal_words(text)]
            out[row][0] = sum(map(len, part))
            waiting.append((row, np.concatenate([*part, [-1]])))  # no run goes on into the next text
            size += len(text)
            if size >= SLICE:
                flush()
                size = 0
        if waiting:
            flush()
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = per_worker(key, lambda: loaded(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = look(utf8(part.column(n_kept - 1)), automaton)
                before = [(None, [], [])] * part.num_rows if first else zip(*[part.column(n_kept + i).to_pylist() for i in range(3)], strict=True)
                rows = [(n, union([*[(s["start"], s["end"]) for s in old], *new]), sorted({*names, *(automaton.items[i] for i in numbers if i >= 0)}))
                        for (n, new, numbers), (_, old, names) in zip(found, before, strict=True)]
                spans = [[{"start": a, "end": b} for a, b in s] for _, s, _ in rows]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], pa.array([n for n, *_ in rows], pa.int64()), pa.array(spans, arrow_spans),
                                                  pa.array([i for *_, i in rows], pa.list_(pa.string()))], names=schema.fieldNames())

    return docs.mapInArrow(scan, schema)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    length: int = 10,
    coverage: float = 1.0,
    max_share: float = 0.5,
    with_text: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    shard_words: int = 1 << 17,
) -> DataFrame:
    """doc_id, n_words, spans (of words, start and end, apart), n_hit, items, rejected; with_text: also clean_text.

    ``items`` are the ids, as text in order, of the items with a window in the text;
    ``rejected`` says that more than ``max_share`` of the words are hit; ``clean_text``
    is the text without the spans. One row a row of ``docs``, in no order.

    A null or empty text has no words, no hit, and its clean text is itself. An item
    without words has no window. An item with a null id hits words but is not
    listed; items that share an id are listed once. Repeated rows give repeated
    rows; an empty table of texts gives none, without items nothing is hit. Other
    columns are not read.
    """
    if not 0 < coverage <= 1 or length < 1:
        raise ValueError("length must be at least 1, coverage above 0 and at most 1")
    pieces, count = shards(written(item_pieces(items, length, coverage, item_id_col, item_text_col)), shard_words)
    scanned = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    for shard in range(count):
        rows = pieces.filter(F.col("shard") == shard).orderBy("item", "words").collect()  # at most shard_words words
        parts = build([(r["item"], bytes(r["words"]).split(b" "), r["window"]) for r in rows])
        scanned = scan_shard(scanned if shard < 2 else written(scanned), parts, first=shard == 0)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = scanned.select("doc_id", "text", "n_words", "spans", n_hit.alias("n_hit"), "items", (n_hit > F.col("n_words") * F.lit(max_share)).alias("rejected"))
    if not with_text:
        return found.drop("text")

    schema = T.StructType([f for f in found.schema.fields if f.name != "text"] + [T.StructField("clean_text", T.StringType())])
    names = schema.fieldNames()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(s["start"], s["end"]) for s in x] for x in batch.column(3).to_pylist()]
            texts = [t if not s else without_spans(t, s) for t, s in zip(batch.column(1).to_pylist(), spans, strict=True)]
            kept = [c for i, c in enumerate(batch.columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=names)

    return found.mapInArrow(clean, schema)
