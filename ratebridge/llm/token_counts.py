"""Token counts: a prefix table by dynamic programming over the merges.

For a byte-pair vocabulary, the encoding of every prefix of a word ends in
exactly one token that is compatible with the token before it (encoding the two
alone gives the two), and what stands before that token is the encoding of the
shorter prefix. So ``count[i] = count[i - len(last)] + 1``: one pass over a word
gives the exact count of all its prefixes. Counts of a text's prefixes follow by
adding up its words. The table keeps, for each code point, the signed change of
the count as one byte; its sum is the count of the whole text.

With an end-of-word suffix, the last token of a prefix carries the suffix; it
is sought among the tokens with the suffix, on top of the states without.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge.llm.workers import TwoGenerationCache, byte_alphabet, per_worker

#: White space that separates stretches; all of it is white space to the library too.
STRETCH = re.compile("[ \t\n\r]+|[^ \t\n\r]+")


#: Prefixes up to this length keep their state.
SHORT = 32
#: The vocabulary's pre-token pattern (fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Up to this code point (the Latin blocks) patterns of this machine and of the library agree.
LATIN = chr(0x24F)


def signed_steps(counts: list[int]) -> bytes:
    """Steps from each count to the next, from 0 on, as signed bytes.

    A step is never larger than the longest token, as every count is one more
    than that of a prefix shorter by one token.
    """
    return bytes([(b - a) & 255 for a, b in zip([0, *counts], counts, strict=False)])


def total(deltas: bytes) -> int:
    return int(np.frombuffer(deltas, np.int8).sum(dtype=np.int64))


class PrefixCounter:
    """Exact token counts of all prefixes, for a byte-level BPE with an end-of-word suffix."""

    def __init__(self, tokenizer_path: str, cache_entries: int):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = byte_alphabet()
        self.made: dict[str, tuple[int, str, str]] = {}  # token: rank and halves of the merge that makes it
        self.whole = {t for t in model["vocab"] if t not in self.special and self.merge(self.symbols(t)) == [t]}
        tails: dict[str, set[int]] = {}  # last two characters of tokens: the tokens' lengths
        for t in (t.removesuffix(self.suffix) for t in self.whole if t != self.suffix):
            tails.setdefault(t[-2:], set()).add(len(t))
        self.lengths = {t: (*sorted(of, reverse=True), *[1] * (len(t) == 2)) for t, of in tails.items()}
        self.states: dict[str, tuple[str, int, int]] = {}
        self.cache_entries = cache_entries
        self.pairs = TwoGenerationCache(lambda pair: self.compatible(*pair), cache_entries)
        self.words = TwoGenerationCache(self.word_deltas, cache_entries)
        self.stretches = TwoGenerationCache(self.stretch_deltas, cache_entries)
        self.normal_chars = TwoGenerationCache(self.tokenizer.normalizer.normalize_str, cache_entries)
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.pre_token = regex.compile(PRE_TOKEN)

    def symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            head = list(token[: -len(self.suffix)])
            return [*head[:-1], head[-1] + self.suffix]
        return list(token)

    def merge(self, parts: list[str]) -> list[str]:
        """Byte-pair merging of the symbols, lowest rank first, leftmost first."""
        while len(parts) > 1:
            ranked = [(r, i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := self.rank.get(p)) is not None]
            if not ranked:
                break
            rank, i = min(ranked)
            left, right = parts[i:i + 2]
            parts = [*parts[:i], left + right, *parts[i + 2:]]
            if len(parts) == 1:
                self.made[left + right] = rank, left, right
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether the two tokens, side by side, are the encoding of what they spell.

        Undo merges on both sides of the border, the latest first. If at some
        point the parts at the border would have merged with each other before
        the merge last undone, the two do not stay apart.
        """
        made, rank, before = self.made, self.rank, float("inf")
        while True:
            across = rank.get((a, b))
            if across is not None and across < before:
                return False
            on_a, on_b = made.get(a), made.get(b)
            if on_a is None and on_b is None:
                return True
            if on_b is None or on_a is not None and on_a[0] > on_b[0]:
                before, _, a = on_a
            else:  # on equal terms the border's left end merges first
                before, b, _ = on_b
                before += 1

    def prefix_counts(self, word: str) -> list[int]:
        """Tokens of word[:i] as a word of its own, for i from 1; word is in the byte alphabet.

        Words share beginnings, so the states of short prefixes are kept.
        """
        n, suffix, whole, pairs, states, lengths = len(word), self.suffix, self.whole, self.pairs, self.states, self.lengths
        last, inner, ended = [""], [0], []
        for i in range(1, n + 1):
            prefix = word[:i] if i <= SHORT else None
            if prefix is None or (known := states.get(prefix)) is None:
                token_on, count_on, count_end = "", 0, 0
                for length in lengths.get(word[max(i - 2, 0):i], (1,)):
                    if length > i:
                        continue
                    token, before = word[i - length:i], i - length
                    if not count_on and token in whole and (not before or pairs[last[before], token]):
                        token_on, count_on = token, inner[before] + 1
                    if not count_end and token + suffix in whole and (not before or pairs[last[before], token + suffix]):
                        count_end = inner[before] + 1
                    if count_on and count_end:
                        break
                if not count_end:
                    raise ValueError(f"no token of the vocabulary ends the prefix {word[:i]!r}")
                known = token_on, count_on, count_end
                if prefix is not None:
                    if len(states) >= self.cache_entries:
                        states.clear()
                    states[prefix] = known
            last.append(known[0])
            inner.append(known[1])
            ended.append(known[2])
        return ended

    def word_deltas(self, word: str) -> bytes:
        """Change of the count at each character of a pre-token given as text."""
        symbols = word if word.isascii() and word.isprintable() else "".join([self.alphabet[b] for b in word.encode()])
        counts = self.prefix_counts(symbols)
        if len(symbols) > len(word):  # keep the counts at whole characters
            ends = np.cumsum([len(c.encode()) for c in word]) - 1
            counts = [counts[e] for e in ends.tolist()]
        return signed_steps(counts)

    def plain_deltas(self, text: str) -> bytes:
        """Deltas of a text without special strings and outer white space."""
        if not unicodedata.is_normalized("NFC", text):
            return signed_steps([self.normal_count(text[:i]) for i in range(1, len(text) + 1)])
        # Parts of a composed text are composed, and the other normalisers work by character.
        by_char = None if text.isascii() else [self.normal_chars[c] for c in text]
        normal = text.lower() if by_char is None else "".join(by_char)
        deltas = bytearray(len(normal))
        at = 0
        for word in self.pieces(normal):
            at = normal.index(word, at)
            if word[0] == "'" and len(word) > 1 and word[-1].isalpha():  # a contraction: its prefixes split otherwise
                known = signed_steps([self.normal_count(word[:i]) for i in range(1, len(word) + 1)])
            else:
                known = self.words[word] if len(word) <= 64 else self.word_deltas(word)
            deltas[at:at + len(word)] = known
            at += len(word)
        if len(normal) == len(text):
            return bytes(deltas)
        ends = np.cumsum([0, *map(len, by_char)])
        counts = np.concatenate([[0], np.cumsum(np.frombuffer(deltas, np.int8), dtype=np.int64)])
        return signed_steps(counts[ends[1:]].tolist())

    def pieces(self, normal: str) -> list[str]:
        """Pre-tokens; beyond Latin the library itself splits, whatever Unicode version it knows."""
        if max(normal, default="") <= LATIN:
            return self.pre_token.findall(normal)
        return [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def normal_count(self, text: str) -> int:
        normal = self.tokenizer.normalizer.normalize_str(text)
        return sum(total(self.words[w]) for w in self.pieces(normal))

    def stretch_deltas(self, stretch: str) -> bytes:
        if stretch[0] in " \t\n\r":
            return bytes(len(stretch))
        out, at = b"", 0
        for m in self.split.finditer(stretch):
            # Up to its last character a special string is ordinary text; with that it is one token.
            part = self.plain_deltas(stretch[at:m.end() - 1])
            step = self.normal_count(stretch[at:m.start()]) + 1 - total(part)
            out += part + (step & 255).to_bytes()
            at = m.end()
        return out + self.plain_deltas(stretch[at:]) if at < len(stretch) else out

    def text_deltas(self, text: str) -> bytes:
        known = self.stretches
        return b"".join([known[s] if len(s) <= 64 else self.stretch_deltas(s) for s in STRETCH.findall(text)])


def prefix_token_table(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_entries: int = 500_000,
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, prefix_deltas.

    ``prefix_deltas`` holds a signed byte for each code point: the first i add
    up to the exact token count of the text's first i code points. n_tokens is
    the count of the whole text. A null text counts as empty (no tokens, empty
    table); a null doc_id stays null; repeated rows give repeated rows; an empty
    table gives no rows; other columns are not read. Memory follows the longest
    text, not the table.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("prefix_deltas", T.BinaryType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(("prefix", tokenizer_path), lambda: PrefixCounter(tokenizer_path, cache_entries))
        for batch in batches:
            at, step = 0, 500  # slices bound what is held at once
            while at < batch.num_rows:
                part = batch.slice(at, step)
                at += step
                texts = [x or "" for x in part.column(1).to_pylist()]
                deltas = [counter.text_deltas(x) for x in texts]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([len(x.encode()) for x in texts], pa.int64()),
                    pa.array([total(d) for d in deltas], pa.int64()),
                    pa.array(deltas, pa.binary()),
                ], names=schema.fieldNames())

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(count, schema)


def tokens_of_prefix(deltas: Column, n_chars: Column) -> Column:
    """Exact token count of the first ``n_chars`` code points, from the table alone."""

    @F.pandas_udf(T.LongType())
    def look_up(table: pd.Series, upto: pd.Series) -> pd.Series:
        return pd.Series([None if t is None or pd.isna(u) else int(np.frombuffer(t, np.int8)[: max(int(u), 0)].sum(dtype=np.int64))
                          for t, u in zip(table, upto, strict=True)], dtype="Int64")

    return look_up(deltas, n_chars)


def chars_within_budget(deltas: Column, budget: Column) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens, from the table alone."""

    @F.pandas_udf(T.LongType())
    def look_up(table: pd.Series, most: pd.Series) -> pd.Series:
        def one(t, b):
            if t is None or pd.isna(b):
                return None
            counts = np.concatenate([[0], np.cumsum(np.frombuffer(t, np.int8), dtype=np.int64)])
            fits = np.flatnonzero(counts <= b)
            return int(fits[-1]) if len(fits) else 0
        return pd.Series([one(t, b) for t, b in zip(table, most, strict=True)], dtype="Int64")

    return look_up(deltas, budget)
