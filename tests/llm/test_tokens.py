"""Token operators against the library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from ratebridge.llm.harmonic_packing import HarmonicPacker, IdEncoder, harmonic_packing  # noqa: E402
from ratebridge.llm.token_counts import PrefixCounter, chars_within_budget, prefix_token_table, tokens_of_prefix  # noqa: E402

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "the", "'s", "'re", "'ll", "'", "!", "1", "23", " ", "  ", "\n", "\t", "\r\n", chr(233), "e" + chr(0x301), chr(0x3A3), chr(0x130),
         "<|endoftext|>", "<|startoftext|>", "<|", "|>", chr(0x6F22), chr(0xD55C), chr(0x1112) + chr(0x1161), chr(0xA0), chr(0x200B), chr(0x1F600), "A", chr(223),
         "ing", "tion", chr(0x300), "x" * 5, "don't", chr(0x1C), chr(0x85), " " + chr(0x301), chr(0), chr(0x7F)]


def strings(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_count_of_every_prefix_is_the_librarys():
    library, counter = tokenizers.Tokenizer.from_file(WORDS), PrefixCounter(WORDS, 1000)
    for text in strings(400, 1):
        steps = np.frombuffer(counter.text_deltas(text), np.int8)
        assert len(steps) == len(text)
        for i in range(len(text) + 1):
            assert steps[:i].sum(dtype=int) == len(library.encode(text[:i], add_special_tokens=False).ids), (text, i)


def test_long_word_counts():
    library, counter = tokenizers.Tokenizer.from_file(WORDS), PrefixCounter(WORDS, 1000)
    text = "abcdefghij" * 300 + "-" * 200
    steps = np.frombuffer(counter.text_deltas(text), np.int8)
    for i in (1, 31, 33, 64, 65, 1000, 2999, 3001, 3100, 3200):
        assert steps[:i].sum(dtype=int) == len(library.encode(text[:i], add_special_tokens=False).ids)


def test_ids_are_the_librarys():
    library, encoder = tokenizers.Tokenizer.from_file(BYTES), IdEncoder(BYTES, 1000)
    for text in strings(1500, 2):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_ids_of_latin_texts_are_the_librarys():
    """Every code point up to the last Latin block, in all neighbourhoods, and runs without end."""
    library, encoder = tokenizers.Tokenizer.from_file(BYTES), IdEncoder(BYTES, 1000)
    rng = random.Random(4)
    points = [chr(c) for c in range(0x250)]
    texts = ["".join(rng.choices(points, k=rng.randint(1, 12))) for _ in range(6000)]
    texts += [a + b + c for a in " a1.\n" for b in points for c in " a1.\n'"] + ["a" * 30_000, "#" * 5000, " \n" * 3000, chr(0x250) + "x" * 300, "a <|endoftext|> b"]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:50]
    assert len(encoder.encode(" " * 1_500_000)) == 4 * len(library.encode(" " * 1_500_000, add_special_tokens=False).ids)


def test_prefix_table_answers_budgets(awkward):
    library = tokenizers.Tokenizer.from_file(WORDS)
    found = prefix_token_table(awkward, WORDS)
    rows = found.select("doc_id", "n_bytes", "n_tokens", F.length("prefix_deltas").alias("chars"), tokens_of_prefix(F.col("prefix_deltas"), F.lit(10)).alias("ten"),
                        chars_within_budget(F.col("prefix_deltas"), F.lit(7)).alias("fit")).collect()
    expected = []
    for r in awkward.select("doc_id", "text").collect():
        t = r["text"] or ""
        count = lambda x: len(library.encode(x, add_special_tokens=False).ids)
        fit = max(i for i in range(min(len(t), 200) + 1) if count(t[:i]) <= 7) if len(t) < 200 else None
        expected.append((r["doc_id"], len(t.encode()), count(t), len(t), count(t[:10]), fit))
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["chars"], r["ten"], r["fit"] if r["chars"] < 200 else None) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_empty_tables(nothing):
    assert prefix_token_table(nothing, WORDS).count() == 0
    assert harmonic_packing(nothing, BYTES, 1).count() == 0


def test_packing_is_a_round_trip(awkward):
    library = tokenizers.Tokenizer.from_file(BYTES)
    pieces = harmonic_packing(awkward, BYTES, 1, capacity=256).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] * 4 == len(p["ids"]) and p["length"] > 0
        sequences[p["sequence_id"]].append(p)
        documents[p["doc_id"]].append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 256
        assert at >= 0.98 * 256 or at & (at - 1) == 0
    expected = defaultdict(list)
    for r in awkward.select("doc_id", "text").collect():
        expected[r["doc_id"]].append(library.encode(r["text"] or "", add_special_tokens=False).ids + [1])
    for key, texts in expected.items():
        if len(texts) == 1:
            ids = [i for p in sorted(documents[key], key=lambda p: p["start"]) for i in np.frombuffer(p["ids"], "<u4").tolist()]
            assert ids == texts[0]
            assert {p["doc_tokens"] for p in documents[key]} == {len(ids)}
        else:  # repeated rows: as many ids in total
            assert sum(p["length"] for p in documents[key]) == sum(map(len, texts))


def test_packer_fills_classes_and_wastes_little():
    rng = random.Random(5)
    packer = HarmonicPacker(2048, 0.99)
    lengths = [rng.choice([1, 7, 100, 683, 700, 1024, 1500, 2047, 2048, 2049, 5000, rng.randint(1, 6000)]) for _ in range(500)]
    for i, n in enumerate(lengths):
        packer.add(i, bytes(4 * n))
    packer.close()
    used = defaultdict(int)
    for _, _, ids, _, sequence, _ in packer.out:
        used[sequence] += len(ids) // 4
    assert sum(used.values()) == sum(lengths)
    padded = sum(2048 for n in used.values() if n & (n - 1)) + sum(n for n in used.values() if not n & (n - 1))
    assert padded <= 1.01 * sum(lengths)


def test_query_crc(spark):
    from ratebridge.llm.queries import queries

    rows = queries()["op2_harmonic_packing"](spark, "/root/testdata/sf0.001").filter("doc_id < 20").collect()
    library = tokenizers.Tokenizer.from_file(BYTES)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 20").collect()}
    for r in rows:
        ids = np.array(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [1], "<u4")
        assert zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
