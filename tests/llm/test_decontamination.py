"""Decontamination against a plain search for every window."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ratebridge.llm.decontamination import build, decontaminate, likely_stretches, loaded, matches, normal_words, without_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, length, coverage):
    """(n_words, spans, items) by comparing every stretch of the text with every window."""
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        tested = WORD.findall(lower(body))
        size = min(length, max(1, -int(-coverage * len(tested) // 1)))
        windows = {tuple(tested[i:i + size]) for i in range(len(tested) - size + 1)} if tested else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                found |= {str(item)} - {"None"}
    spans = []
    for i in sorted(hit):
        if spans and spans[-1][1] == i:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return len(words), [tuple(s) for s in spans], sorted(found)


def tables(spark):
    rng = random.Random(8)
    some = lambda n, k=6: " ".join(rng.choice("abcdefghij"[:k]) + str(rng.randint(0, 2)) for _ in range(n))
    items = [(i, some(rng.randint(1, 25))) for i in range(20)]
    items += [(30, items[0][1]), (3, some(14)), (None, some(12)), (31, None), (32, " .,; "), (33, "É 漢字 x1"), (34, some(90)), items[5], items[5]]
    quoted = [t for _, t in items if t]
    texts = [None, "", " \n.", *[some(rng.randint(1, 60)) for _ in range(20)], *[f"{some(9)}, {t.upper()}! {some(5)}" for t in quoted],
             "x " * 3000 + quoted[0] + " y" * 3000, " ".join(quoted), "é 漢字 x1 É-漢字 X1", quoted[0], quoted[0]]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, "other row of an id"), (None, quoted[2])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    tested = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    for name in ("n_words", "spans", "items", "n_hit", "item", "words", "shard", "window"):
        frame, tested = frame.withColumn(name, F.lit("clash")), tested.withColumn(name, F.lit("clash"))
    return frame, tested, docs, items


@pytest.mark.parametrize(("length", "coverage", "shard_words"), [(10, 1.0, 1 << 17), (10, 1.0, 300), (4, 1.0, 200), (10, 0.5, 1 << 17)])
def test_matches_a_plain_search(spark, checkpoints, monkeypatch, length, coverage, shard_words):
    from ratebridge.llm import decontamination

    monkeypatch.setattr(decontamination, "PIECE", 16 if shard_words < 400 else 4096)
    frame, tested, docs, items = tables(spark)
    got = decontaminate(frame, tested, length, coverage, with_text=True, shard_words=shard_words).collect()
    expected = [(i, *brute(t, items, length, coverage)) for i, t in docs]
    assert sorted([(r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in got], key=repr) == sorted(expected, key=repr)
    for r in got:
        assert r["n_hit"] == sum(b - a for a, b in r["spans"]) and r["rejected"] == (r["n_hit"] > r["n_words"] / 2)
        text = r["clean_text"]
        assert (text is None or len(WORD.findall(lower(text))) <= r["n_words"] - r["n_hit"]) and (r["n_hit"] or text in {t for _, t in docs})


def test_clean_text_keeps_the_rest():
    text = "One, two. Three - four FIVE; six"
    assert without_spans(text, [(1, 3)]) == "One,  - four FIVE; six"
    assert without_spans(text, [(0, 1), (4, 6)]) == ", two. Three - four "
    assert without_spans(text, []) == text


def test_empty_tables(spark, checkpoints):
    frame, tested, docs, _ = tables(spark)
    assert decontaminate(frame.limit(0), tested).collect() == []
    clean = decontaminate(frame, tested.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r["n_hit"] or r["items"] for r in clean)


def test_automaton_streams_longest_matches():
    rng = random.Random(2)
    pieces = [(str(i), [b"ab"[c:c + 1] for c in rng.choices([0, 1], k=30)], 6) for i in range(6)]
    automaton = loaded(build(pieces))
    text = [b"ab"[c:c + 1] for c in rng.choices([0, 1], k=3000)]
    codes = [automaton.words[w] for w in text]
    got = {(a, b, automaton.items[i]) for a, b, found in matches(automaton, codes, 0) for i in found}
    expected = {(i, i + 6, name) for name, words, _ in pieces for j in range(25) for i in range(2995) if text[i:i + 6] == words[j:j + 6]}
    assert got == expected


def test_long_texts_are_split_between_words(monkeypatch):
    from ratebridge.llm import decontamination

    text = "aa bé-ccc  dddd\n" * 50
    whole = list(normal_words(text.encode()))
    monkeypatch.setattr(decontamination, "SLICE", 7)
    parts = list(normal_words(text.encode()))
    assert len(parts) > 20 and [w for p in parts for w in p] == [w for p in whole for w in p] == [w.encode() for w in WORD.findall(text)]


def test_stretches_hold_all_windows():
    automaton = loaded(build([("1", [b"a", b"b", b"c", b"d", b"e", b"f"], 6)]))
    import numpy as np

    codes = np.array([-1, *range(6), -1, 0, 1, 2, 3, 4, -1, 5, 5, *range(6)])
    assert likely_stretches(automaton, codes) == [(1, 7), (16, 22)]


def test_registered_query_matches_its_sql(spark, checkpoints):
    from ratebridge.llm import queries
    from ratebridge.testing import SF_SMALL, diff_results, duckdb_connection

    got = queries.queries()["op12_decontamination"](spark, SF_SMALL)
    expected = duckdb_connection(SF_SMALL).sql(queries.oracle_sql()["op12_decontamination"])
    assert not diff_results(got.columns, [tuple(r) for r in got.collect()], expected.columns, expected.fetchall())
