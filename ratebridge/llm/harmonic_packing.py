"""Packing: documents into fixed-capacity token sequences by harmonic classes.

A length in (capacity / (k + 1), capacity / k] belongs to class k; a bin of
class k takes exactly k pieces of that class. Every task packs the rows of its
own partition with one open bin per class, so packing needs no shuffle and no
coordination, and its state is under two capacities of tokens for each of the
about 2 * sqrt(capacity) classes in use.

Documents may be cut. A remainder that would fill its class badly gives off a
piece of exactly the top length of the next class, until the rest fills its
class to ``min_fill``. Bins still open when a partition ends are closed by
chaining their pieces into full sequences, cut at the boundaries; the last
stretch becomes sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ratebridge.llm.tables import small_batches
from ratebridge.llm.workers import TwoGenerationCache, byte_alphabet, per_worker

#: Code points that are white space to the library (fixed values of the Unicode property White_Space).
SPACE_POINTS = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
UNICODE_SPACE = "".join(map(chr, SPACE_POINTS))
#: Up to this code point (the Latin blocks) patterns of this machine and of the library agree.
LATIN = chr(0x24F)
#: The vocabulary's pre-token pattern (fixed value), and the same with the three kinds of visible runs as one.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STRETCH = rf" ?[^{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+(?![^{UNICODE_SPACE}])|[{UNICODE_SPACE}]+"


class IdEncoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    Texts of Latin letters are encoded at once by the merge ranks of the same vocabulary:
    its ids are its ranks, and up to ``LATIN`` the pattern means the same to both
    libraries. For the others, a text is the concatenation of its stretches (a visible run with the space
    before it, or white space), and no pre-token spans two stretches, so ids of a
    text are those of its stretches in order. Stretches and pre-tokens are cached;
    the library's model encodes a pre-token that is not. Texts that hold a
    special string go through the library whole.
    """

    def __init__(self, tokenizer_path: str, cache_entries: int):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t not in self.special}
        self.ranked = tiktoken.Encoding(tokenizer_path, pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})
        self.beyond = re.compile(rf"[^\x00-{LATIN}]")
        self.stretch, self.pre_token = re.compile(STRETCH), regex.compile(PRE_TOKEN)
        self.alphabet = byte_alphabet()
        self.stretches = TwoGenerationCache(self.encode_stretch, cache_entries)
        self.pre_tokens = TwoGenerationCache(self.encode_pre_token, cache_entries)

    def encode_pre_token(self, piece: str) -> bytes:
        symbols = "".join([self.alphabet[b] for b in piece.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(symbols)])

    def encode_stretch(self, stretch: str) -> bytes:
        if max(stretch) > LATIN:  # beyond Latin the library itself splits, whatever Unicode version it knows
            spans = [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(stretch)]
            pieces = [stretch[a:b] for a, b in spans]
        else:
            pieces = self.pre_token.findall(stretch)
        return b"".join([self.pre_tokens[p] if len(p) <= 64 else self.encode_pre_token(p) for p in pieces])

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return b"".join([i.to_bytes(4, "little") for i in ids])
        if not self.beyond.search(text):
            try:
                return self.ranked.encode_to_numpy(text, disallowed_special=()).tobytes()
            except ValueError:  # white space without end exhausts its pattern engine
                pass
        known = self.stretches
        return b"".join([known[s] if len(s) <= 64 else self.encode_stretch(s) for s in self.stretch.findall(text)])


class HarmonicPacker:
    """Bins of one partition. ``place`` takes (document, start, ids, doc_tokens); ``out`` gets placed pieces.

    A placed piece is (document, start, ids, doc_tokens, sequence number, offset).
    """

    def __init__(self, capacity: int, min_fill: float):
        self.capacity, self.min_fill = capacity, min_fill
        self.open: dict[int, list[tuple]] = {}
        self.sequences = 0
        self.out: list[tuple] = []

    def add(self, key, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while at < total:
            length = self.next_length(total - at)
            self.place((key, at, ids[4 * at:4 * (at + length)], total), length)
            at += length

    def next_length(self, left: int) -> int:
        if left >= self.capacity:
            return self.capacity
        k = self.capacity // left
        return left if k * left >= self.min_fill * self.capacity else self.capacity // (k + 1)

    def place(self, piece: tuple, length: int) -> None:
        k = self.capacity // length
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            self.emit(self.open.pop(k))

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            self.out.append((key, start, ids, total, self.sequences, offset))
            offset += len(ids) // 4
        self.sequences += 1

    def close(self) -> None:
        """Chain what is left into full sequences, then into sequences of 2^j tokens."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        room = sum(len(p[2]) for p in left) // 4
        take: list[tuple] = []
        while room:
            size = min(self.capacity, 1 << (room.bit_length() - 1))
            if room >= self.capacity:
                size = self.capacity
            room -= size
            take, need = [], size
            while need:
                key, start, ids, total = left.pop(0)
                if len(ids) > 4 * need:
                    left.insert(0, (key, start + need, ids[4 * need:], total))
                    ids = ids[:4 * need]
                take.append((key, start, ids, total))
                need -= len(ids) // 4
            self.emit(take)


def harmonic_packing(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = 2048,
    min_fill: float = 0.99,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_entries: int = 200_000,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian uint32), doc_tokens,
    sequence_id, offset.

    A document is the ids of its whole text, then ``end_id``. A null or empty
    text is the end id alone; a null doc_id stays null; repeated rows are packed
    each for itself; an empty table gives no rows; other columns are not read. A
    text of any length is cut into full sequences, so only its own ids are held.
    Sequence ids are partition number * 2^40 + a count, so tasks number theirs
    alone and a task run again gives the same ids.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = per_worker(("ids", tokenizer_path), lambda: IdEncoder(tokenizer_path, cache_entries))
        base = TaskContext.get().partitionId() << 40
        packer = HarmonicPacker(capacity, min_fill)
        id_type = None

        def flush() -> pa.RecordBatch:
            rows, packer.out = packer.out, []
            keys, starts, ids, totals, sequences, offsets = zip(*rows, strict=True) if rows else [()] * 6
            return pa.RecordBatch.from_arrays([
                pa.array(keys, id_type),
                pa.array(starts, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array(totals, pa.int64()),
                pa.array([base + s for s in sequences], pa.int64()),
                pa.array(offsets, pa.int64()),
            ], names=schema.fieldNames())

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(key, encoder.encode(text.as_py() or "") + end)
                if len(packer.out) >= 500:
                    yield flush()
        packer.close()
        if packer.out:
            yield flush()

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(pack, schema)
