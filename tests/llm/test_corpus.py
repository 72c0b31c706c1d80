"""Operators over the whole corpus against brute force on small tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ratebridge.llm.components import connected_components
from ratebridge.llm.harmonic_packing import harmonic_packing
from ratebridge.llm.language_id import fit_languages, identify_languages
from ratebridge.llm.line_dedup import common_blocks, patience_matches, remove_aligned_lines
from ratebridge.llm.ngram_join import similar_components
from ratebridge.llm.queries import word_count
from ratebridge.llm.shingles import word_hashes
from ratebridge.llm.source_mixing import mix_sources, words_taken
from ratebridge.llm.substring_dedup import has_smaller, remove_repeats
from ratebridge.llm.topk_search import block_topk, segment_topk
from ratebridge.llm.workers import worker_state

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(frame, *columns):
    return [(r["doc_id"], r["text"], *[r[c] for c in columns]) for r in frame.select("doc_id", "text", *columns).collect()]


def copies(rng, n_docs, n_words, vocabulary=4000):
    """Documents with exact and near copies and shared passages, ids shuffled."""
    word = lambda: f"w{rng.randrange(vocabulary)}"
    texts = [[word() for _ in range(rng.randint(1, n_words))] for _ in range(n_docs)]
    passage = [word() for _ in range(30)]
    for t in texts[::4]:
        at = rng.randint(0, len(t))
        t[at:at] = passage[rng.randint(0, 10):rng.randint(18, 30)]
    out = [" ".join(t) for t in texts]
    for t in texts[: n_docs // 3]:
        for _ in range(rng.randint(1, 4)):
            copy = list(t)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    ids = rng.sample(range(10 * len(out)), len(out))
    return list(zip(ids, out, strict=True))


# substring dedup -----------------------------------------------------------

def cut_by_hand(rows, window=13):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k:k + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k:k + window])] < i for j in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def test_word_hashes_keep_no_words():
    texts = [" ".join(f"w{i}" for i in range(5000)).encode(), None, b"", b"\t Un DEUX\x1cun\n"]
    before = set(worker_state())
    hashes, counts = word_hashes(texts)
    assert counts.tolist() == [5000, 0, 0, 2] and len(set(hashes.tolist())) == 5002
    assert hashes.tolist() == [xxhash.xxh3_64_intdigest(w) for t in texts for w in (t or b"").split()]
    assert word_hashes(texts, lower=True)[0][5000] == xxhash.xxh3_64_intdigest(b"un")
    assert set(worker_state()) == before


def test_windows_with_a_smaller_equal():
    rng = np.random.default_rng(2)
    seed, whole = rng.integers(-3, 3, 400), rng.integers(0, 40, 400).astype(np.uint64)
    ids = rng.integers(-5, 30, 400)
    least = {}
    for key, i in zip(zip(seed.tolist(), whole.tolist(), strict=True), ids.tolist(), strict=True):
        least[key] = min(i, least.get(key, i))
    assert has_smaller(seed, whole, ids).tolist() == [i > least[s, w] for s, w, i in zip(seed.tolist(), whole.tolist(), ids.tolist(), strict=True)]
    assert not has_smaller(seed[:0], whole[:0], ids[:0]).size and not has_smaller(seed[:1], whole[:1], ids[:1]).any()


def test_repeats_match_brute_force(spark, awkward):
    rows = copies(random.Random(1), 120, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    columns = ["doc_id", "n_words", "n_removed", "kept_text"]
    assert sorted([tuple(r) for r in remove_repeats(docs).select(*columns).collect()], key=repr) == cut_by_hand(rows)
    got = remove_repeats(awkward).select(*columns).collect()
    assert sorted([tuple(r) for r in got], key=repr) == cut_by_hand(rows_of(awkward))


def test_windows_of_frequent_anchors_are_dealt_out(spark, monkeypatch):
    from ratebridge.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "OFTEN", 3)
    rows = copies(random.Random(2), 90, 60, vocabulary=300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted([tuple(r) for r in got], key=repr) == cut_by_hand(rows)


# n-gram join ---------------------------------------------------------------

def components_by_hand(rows, percent=80):
    def shingles(t):
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return sorted([(i, len(x), root(i) if i is not None else None) for i, x in sets], key=repr)


def test_components_match_brute_force(spark, awkward):
    rows = copies(random.Random(1), 80, 150) + [(10_000 + i, t) for i, t in copies(random.Random(2), 60, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, similar_components(docs).collect()), key=repr) == components_by_hand(rows)
    assert sorted(map(tuple, similar_components(awkward).collect()), key=repr) == components_by_hand(rows_of(awkward))


def test_group_of_near_copies_around_no_hub(spark):
    """A chain of edits: neighbours are similar, ends are not, and hubs link few of them."""
    rng = random.Random(7)
    text = [f"x{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(25):
        text = list(text)
        text[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - 7 * i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, similar_components(docs).collect()), key=repr) == components_by_hand(rows)


def test_texts_that_share_an_id_all_link(spark):
    """Two texts of one id, equally long, each similar to another document."""
    rng = random.Random(5)
    one, two = ([f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(2))
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join([*one, "more"])), (3, " ".join([*two, "more"])), (4, "alone " * 30)]
    for repeated in (rows, rows + rows[:2]):
        docs = spark.createDataFrame(repeated, "doc_id long, text string")
        assert {r["doc_id"]: r["component_id"] for r in similar_components(docs).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_a_document_inside_a_longer_one_links(spark, monkeypatch):
    """80 shingles of 100: shared prefix shingles of the shorter one lie behind the prefix of the longer one."""
    from ratebridge.llm import ngram_join

    monkeypatch.setattr(ngram_join, "OFTEN_IN_BATCH", 2)
    rng, rows = random.Random(9), []
    for i in range(40):
        text = [f"y{rng.randrange(10**6)}" for _ in range(84 + i)]
        more = [f"z{rng.randrange(10**6)}" for _ in range((80 + i) // 4)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join([*text, *more]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = components_by_hand(rows)
    assert all(c == i - i % 2 for i, _, c in expected)
    assert sorted(map(tuple, similar_components(docs).collect()), key=repr) == expected


def test_texts_of_one_id_link_across_copies(spark):
    """Document 2 holds the text of 1 and the text of 3, which are not similar: all three are one component."""
    rng = random.Random(6)
    one, two = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(2))
    rows = [(1, one), (2, one), (2, two), (3, two), (4, "alone " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, similar_components(docs).collect()), key=repr) == [(1, 56, 1), (2, 56, 1), (2, 56, 1), (3, 56, 1), (4, 1, 4)]


def test_frequent_shingles_are_ordered_last(spark, monkeypatch):
    from ratebridge.llm import ngram_join

    monkeypatch.setattr(ngram_join, "OFTEN_IN_BATCH", 2)
    rng = random.Random(8)
    common = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join(common[: rng.randint(20, 60)] + [f"u{rng.randrange(3000)}" for _ in range(rng.randint(0, 40))])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, similar_components(docs).collect()), key=repr) == components_by_hand(rows)


def test_frequent_shingles_do_not_hang_on_the_batches_of_spark(spark):
    """A shingle of every 400th document counts over 2,500 rows, also where Spark sends few rows at a time."""
    from ratebridge.llm.ngram_join import frequent_shingles

    rows = [(f"a{i} b{i} c{i}" + (" one two three four five" if i % 400 == 0 else ""),) for i in range(6000)]
    texts = spark.createDataFrame(rows, "text string").coalesce(1)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    found = []
    for n in ("10000", "300"):
        spark.conf.set(setting, n)
        found.append(frequent_shingles(texts, 5))
    spark.conf.unset(setting)
    # 7, 6 and (1,000 rows) 2 of 15 documents in the three batches
    assert [n.tolist() for _, n in found] == [[13], [13]] and found[0][0].tolist() == found[1][0].tolist()


def test_rows_go_to_workers_in_small_batches(spark, checkpoints):
    """Texts of 20 MB in one partition reach a worker in parts of about 4 MB; a setting of the user stays."""
    from ratebridge.llm.tables import BATCH_BYTES, BATCH_SETTING

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    texts = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))
    operators = [lambda d: similar_components(d), lambda d: remove_aligned_lines(d), lambda d: identify_languages(d, fit_languages(d.withColumn("lang", F.lit("en")).limit(3))),
                 lambda d: harmonic_packing(d, "none", 1)]
    few = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    for operator in operators:
        spark.conf.unset(BATCH_SETTING)
        operator(few)
        assert max(r["n"] for r in texts.mapInArrow(sizes, "n long").collect()) < 1.1 * BATCH_BYTES
        spark.conf.set(BATCH_SETTING, "1000000")
        operator(few)
        assert spark.conf.get(BATCH_SETTING) == "1000000"
    spark.conf.unset(BATCH_SETTING)


def test_near_copies_of_one_text_are_not_all_compared(spark, monkeypatch):
    """Copies far from all others of their group are told by what they share beside the hub; those that do link stay."""
    from ratebridge.llm import ngram_join

    rng, tried = random.Random(10), []
    base = [f"b{i}" for i in range(150)]

    def edited(text, places, word=lambda at: f"v{rng.randrange(10**9)}"):
        return [word(at) if at in places else w for at, w in enumerate(text)]

    texts = [edited(base, {rng.randrange(5, 145)}) for _ in range(60)]
    for _ in range(30):  # 20 shingles of 146 are other ones, 5 of them held by one other document
        twin = edited(base, {first := rng.randrange(5, 25)})
        texts += [edited(twin, {first + 12 * k + rng.randrange(5) for k in (2, 5, 8)}) for _ in range(2)]
    far = edited(base, set(range(6, 140, 30)))
    texts += [edited(far, {at}) for at in (20, 50, 80, 110)]  # link with one another only
    rows = [(0, " ".join(base)), *[(i + 1, " ".join(t)) for i, t in enumerate(texts)], (7, " ".join(far)), (31, "one more text")]

    verified = ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *a: tried.append(pairs.count()) or verified(pairs, *a))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    expected = components_by_hand(rows)
    assert 20 < len({c for _, _, c in expected}) < 100
    assert sorted(map(tuple, similar_components(docs).collect()), key=repr) == expected
    assert sum(tried) < 3 * len(rows)


def test_connected_components(spark, checkpoints):
    links = [(i, i + 1) for i in range(1, 14)] + [(100, 100), (200, 201), (201, 200), (300, 7), (None, 4)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 15)}, 300: 1, 100: 100, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# mixing --------------------------------------------------------------------

def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, full, target = sum(sizes.values()), set(), {}
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            break
        share = (left - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in rest)
        over = [s for s in rest if share * weight[s] > most * sizes[s] + 1e-9]
        if not over:
            target = {**{s: share * weight[s] for s in rest}}
            break
        full |= set(over)
    return {**target, **{s: most * sizes[s] for s in full}}


@pytest.mark.parametrize("shares", [(30, 30, 30, 30), (400, 1, 1, 3), (1, 300, 0, 5)])
def test_mix_meets_targets(spark, checkpoints, shares):
    rng = random.Random(sum(shares))
    rows, n = [], 0
    for source, docs in zip(["b", "a", None, "é"], shares, strict=True):
        for _ in range(docs):
            rows.append((n, source, rng.choice([0, 1, 5, 300, rng.randint(1, 900)])))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("place", F.lit("clash"))
    documents, sources, mix = mix_sources(docs, F.col("size"), block_words=64)
    taken = words_taken(documents, sources, mix).collect()
    sizes = defaultdict(int)
    for _, s, size in rows:
        sizes[s] += size
    expected = targets_by_hand(sizes)
    sums = Counter()
    for r in taken:
        assert r["source_size"] == sizes[r["source"]] and r["taken"] <= 3 * r["size"]
        assert abs(r["target"] - expected[r["source"]]) < 1e-6 * (1 + expected[r["source"]])
        sums[r["source"]] += r["taken"]
    assert len(taken) == len(rows)
    assert all(abs(sums[s] - expected[s]) < 1 + 1e-6 for s in sizes)
    again = words_taken(*mix_sources(docs.repartition(7), F.col("size"), block_words=64)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, taken))
    # Any stretch of the schedule holds the sources in their shares.
    slots = sorted({(r["slot"], r["place"]) for r in mix.collect()})
    if min(shares) >= 30:
        half = Counter(p for _, p in slots[: len(slots) // 2])
        whole = Counter(p for _, p in slots)
        assert all(abs(half[p] - whole[p] / 2) <= 4 for p in whole)


def test_mix_of_awkward_rows(awkward, nothing):
    taken = words_taken(*mix_sources(awkward, word_count("text"))).collect()
    assert len(taken) == awkward.count()
    sums, targets = Counter(), {}
    for r in taken:
        sums[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    assert all(abs(sums[s] - t) < 1.001 for s, t in targets.items())
    assert words_taken(*mix_sources(nothing, word_count("text"))).count() == 0


# line dedup ----------------------------------------------------------------

def lines_by_hand(rows, line_words=4, block_words=8, rare=100, factor=4):
    texts = [(i, (t.split("\n") if t is not None else None)) for i, t in rows]
    holders = defaultdict(list)
    for i, lines in texts:
        if i is not None and lines is not None:
            for x in set(lines):
                if len(WORD.findall(x)) >= line_words:
                    holders[x].append(i)
    out = []
    for (i, lines), (_, text) in zip(texts, rows, strict=True):
        gone = set()
        if i is not None and lines is not None:
            # rows of one id share their partners
            mine = {x for j, other in texts if j == i and other is not None for x in other}
            shared = [x for x in mine if len(holders.get(x, ())) > 1 and min(holders[x]) < i]
            often = max(rare, factor * min((len(holders[x]) for x in shared), default=0))
            for e in {min(holders[x]) for x in shared if len(holders[x]) <= often}:
                for before in [b for j, b in texts if j == e and b is not None]:
                    for first, n in common_blocks(before, lines, [len(WORD.findall(x)) for x in lines], block_words):
                        gone |= set(range(first, first + n))
        kept = None if lines is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out.append((i, 0 if lines is None else len(lines), len(gone), kept))
    return sorted(out, key=repr)


def test_patience_matches():
    rng = random.Random(6)
    for _ in range(300):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))]
        found = patience_matches(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:], strict=False))
    assert patience_matches(list("xaybzc"), list("qarbsc")) == [(1, 1), (3, 3), (5, 5)]
    assert patience_matches(["l"] * 5, ["l"] * 5) == [(i, i) for i in range(5)]


def test_lines_that_one_document_repeats_are_matched(monkeypatch):
    from ratebridge.llm import line_dedup

    assert patience_matches(list("xPyPz"), list("uPv")) == [(3, 1)]
    assert patience_matches(list("uPv"), list("xPyPz")) == [(1, 3)]
    assert common_blocks(list("xPyPz"), list("uPv"), [9, 9, 9], 8) == [(1, 1)]
    # Q and P are found though their first, second ... occurrences cross.
    assert patience_matches(list("xPyQzPwQq"), list("uQvPtQsQ")) == [(3, 1), (5, 3), (7, 7)]
    # Two blank lines do not outweigh a passage.
    assert common_blocks(["", "", "P", "P"], ["P", "", ""], [9, 0, 0], 8) == [(0, 1)]
    rng = random.Random(16)
    for bits in (1 << 26, 40, 0):
        monkeypatch.setattr(line_dedup, "TABLE_BITS", bits)
        for _ in range(300):
            a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 25))] for _ in range(2))
            best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
            found = line_dedup.longest_common(a, b)
            assert len(found) == best[-1][-1] and all(a[i] == b[j] for i, j in found)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:], strict=False))


def test_lines_match_brute_force(spark, awkward, nothing):
    rng = random.Random(9)
    pool = [" ".join(f"w{rng.randrange(200)}" for _ in range(rng.randint(1, 12))) for _ in range(60)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own {i} {k} words of a line here" for k in range(rng.randint(1, 12)))) for i in range(120)]
    rows += [(500 + i, t) for i, t in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    columns = ["doc_id", "n_lines", "n_removed", "kept_text"]
    got = remove_aligned_lines(docs, rare_documents=5).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == lines_by_hand(rows, rare=5)
    got = remove_aligned_lines(awkward).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == lines_by_hand(rows_of(awkward))
    assert remove_aligned_lines(nothing).count() == 0


def test_lines_of_very_many_documents_find_their_first_holder(spark, checkpoints):
    """One boilerplate line in 130 documents; each also shares a line with one other document only."""
    often = "all rights to this text and its pictures are reserved by nobody"
    rows = [(i, f"{often}\nown line {i} has words enough for it\nshared by a pair {i // 2} of documents and no other") for i in range(130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    columns = ["doc_id", "n_lines", "n_removed", "kept_text"]
    got = sorted([tuple(r) for r in remove_aligned_lines(docs).select(*columns).collect()], key=repr)
    assert got == lines_by_hand(rows, rare=len(rows))
    assert [i for i, *_, t in got if often in t] == [0]


def test_copies_lose_every_line(spark, checkpoints):
    text = "\n".join(f"line {i} of a text that has many lines" for i in range(10))
    rows = [(i, text) for i in range(40)] + [(99, "something else entirely that nobody copied")]
    got = remove_aligned_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {0: 0, 99: 0, **{i: 10 for i in range(1, 40)}}


# top-k ---------------------------------------------------------------------

def test_topk_matches_brute_force(spark):
    rng = random.Random(11)
    vectors = [(i, [rng.choice([0.1, -0.2, 0.25, rng.uniform(-1, 1)]) for _ in range(12)]) for i in range(300)]
    vectors += [(400 + i, vectors[3][1]) for i in range(20)]
    vectors += [(1000, [0.5, float("nan")] + [0.0] * 10), (1100, None), (1200, [float("inf")] + [0.0] * 11), (1300, [None] + [0.0] * 11), (None, [0.1] * 12),
                (1400, [0.5, 0.5]), (1500, [0.25, 1.0]), (1600, []), vectors[5], vectors[200], (1, vectors[2][1]), (100, vectors[7][1])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("dim", F.lit("clash")).repartition(4)
    got = segment_topk(frame, F.col("vec_id") % 100 == 0, k=7, scale=64.0, levels=(2, 5), query_block=2, row_block=64).collect()
    import math

    import numpy as np
    whole = [(i, [math.floor(64.0 * float(np.float32(x))) for x in v]) for i, v in vectors
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for i, q in whole:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i and len(v) == len(q))
            expected += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:7])]
    assert sorted(map(tuple, got)) == sorted(expected)
    assert segment_topk(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_topk_beyond_double_precision():
    big = 2**40
    found = block_topk([0], [[big, 1]], [0, 1, 2], [[big, 1], [big, 3], [big, 2]], 2, (1,))
    assert found == [(0, 1, min(big * big + 3, 2**63 - 1)), (0, 2, min(big * big + 2, 2**63 - 1))]


# queries -------------------------------------------------------------------

def test_registered_queries_match_their_sql(spark):
    from ratebridge.llm.queries import oracle_sql, queries
    from ratebridge.testing import diff_results, duckdb_connection

    con = duckdb_connection("/root/testdata/sf0.001")
    for name, sql in oracle_sql().items():
        frame = queries()[name](spark, "/root/testdata/sf0.001")
        relation = con.sql(sql)
        assert diff_results(frame.columns, [tuple(r) for r in frame.collect()], relation.columns, relation.fetchall()) == [], name


def test_pipeline_stages(spark, checkpoints, awkward):
    import corpus_pipeline as P

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for frame in (awkward, docs.limit(0)):
        for name, stage in P.STAGES[:-1]:
            frame = stage(spark, frame, "").checkpoint()
            assert frame.columns == list(P.COLUMNS), name
        packed = P.STAGES[-1][1](spark, frame, "")
        assert packed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] >= frame.count()
    assert packed.count() == 0


def test_pipeline_decisions(spark, checkpoints):
    import corpus_pipeline as P

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    named = dict(P.STAGES)
    known = named["language_id"](spark, docs, "")
    assert known.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count()
    rows = rows_of(docs)
    lined = {r["doc_id"]: r["text"] for r in named["line_dedup"](spark, docs, "").collect()}
    assert lined == {i: t for i, _, n, t in lines_by_hand(rows) if n == 0 or WORD.search(t)}
    kept = sorted(r["doc_id"] for r in named["ngram_join"](spark, docs, "").collect())
    assert kept == [i for i, _, c in sorted(components_by_hand(rows)) if i == c]
    mixed = named["source_mixing"](spark, docs, "")
    words = Counter()
    for i, t in rows_of(mixed):
        words[i] += len(WORD.findall(t))
    taken = words_taken(*mix_sources(docs, word_count("text"))).collect()
    assert dict(words) == {r["doc_id"]: r["taken"] for r in taken if r["taken"]}


def test_different_texts_of_one_id_stay_in_the_pipeline(spark, checkpoints):
    import corpus_pipeline as P

    one, two = "a river of stone and a quiet window over the garden " * 3, "nothing here is like that other text at all, not a word " * 3
    rows = [(1, one, "en", "a", 1), (1, two, "en", "a", 1), (1, one, "en", "b", 1), (2, one + "too", "en", "a", 1), (None, one, "en", "a", 1), (3, None, None, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(P.STAGES)["ngram_join"](spark, docs, "").collect()
    assert sorted([(r["doc_id"], r["text"], r["source"]) for r in kept], key=repr) == sorted([(1, one, "a"), (1, two, "a"), (None, one, "a"), (3, None, "a")], key=repr)
