"""Quality rules by divergence from the language's distribution.

Two histograms of a document are compared with those of all documents of its
language by Jensen-Shannon distance (base 2, from 0 to 1): character classes,
and the language's most common words with one class for all others. A text too
short for a histogram passes that rule.

All of it is column expressions: counts of a document stay in its row, and the
references are one aggregation by language, attached by a broadcast of at most
``max_languages`` + 1 rows of ``common_words`` short words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebridge.llm.native import let, total, words_of

#: Words longer than this are no common words (bounds the reference).
LONGEST_COMMON_WORD = 40
#: Character classes in the order in which they are counted and taken away (fixed patterns); the rest is the last class.
CLASSES = {"lower": "[a-z]+", "space": r"[\x20\x09-\x0D]+", "upper": "[A-Z]+", "digit": "[0-9]+", "letter": r"\p{L}+", "mark": "[.,;:!?'\"()-]+"}
SYMBOLS = "[#*$%&|<>]+"


def counted_characters(docs: DataFrame, text: str) -> DataFrame:
    """Adds classes (array of counts, the last is the rest), n_chars, word_chars, n_symbols."""
    rest = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn("_left0", rest)
    for i, pattern in enumerate(CLASSES.values()):
        docs = docs.withColumn(f"_left{i + 1}", F.regexp_replace(f"_left{i}", pattern, ""))
    n = [F.length(f"_left{i}").cast("long") for i in range(len(CLASSES) + 1)]
    counts = [*[a - b for a, b in zip(n, n[1:], strict=False)], n[-1]]
    after_space = list(CLASSES).index("space") + 1
    symbols = F.length(f"_left{after_space}") - F.length(F.regexp_replace(f"_left{after_space}", SYMBOLS, ""))
    counted = docs.select(
        *[c for c in docs.columns if not c.startswith("_left")], F.array(*counts).alias("classes"), n[0].alias("n_chars"),
        (n[0] - counts[after_space - 1]).alias("word_chars"), symbols.cast("long").alias("n_symbols"))
    return counted


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(docs: DataFrame, words: str, out: str, window: int = 3) -> DataFrame:
    """Adds the number of words within windows of ``window`` words that occur twice or more in the row.

    Windows are compared by 64-bit hashes. A first sort, of single numbers that
    hold high bits of the hash and the position, finds the few windows that may
    repeat; only these are sorted by their whole hash.
    """
    at = lambda i, k: F.get(words, i + k)
    n_windows = F.greatest(F.size(words) - (window - 1), F.lit(0))
    hashes = F.slice(F.transform(words, lambda x, i: F.xxhash64(x, *[at(i, k) for k in range(1, window)])), 1, n_windows)
    docs = docs.withColumn("_hash", hashes)
    mask = F.call_function("shiftleft", F.lit(-1).cast("long"), F.length(F.bin(F.size("_hash").cast("long"))))
    docs = docs.withColumn("_mask", mask)
    packed = F.transform("_hash", lambda h, i: h.bitwiseAND(F.col("_mask")).bitwiseOR(i.cast("long")))
    repeats = F.size(F.array_distinct("_hash")) < F.size("_hash")
    docs = docs.withColumn("_packed", F.when(repeats, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>")))
    high = lambda i: F.get("_packed", i).bitwiseAND(F.col("_mask"))
    twin = F.filter("_packed", lambda x, i: let(x.bitwiseAND(F.col("_mask")), lambda h: F.coalesce(h == high(i + 1), F.lit(False)) | F.coalesce(h == high(i - 1), F.lit(False))))
    docs = docs.withColumn("_twin", F.transform(twin, lambda x: x.bitwiseAND(F.bitwise_not(F.col("_mask"))).cast("int")))
    docs = docs.withColumn("_twin", F.sort_array(F.transform("_twin", lambda p: F.struct(F.get("_hash", p).alias("h"), p.alias("p")))))
    same = lambda x, i: F.coalesce(x["h"] == F.get("_twin", i + 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("_twin", i - 1)["h"], F.lit(False))
    docs = docs.withColumn("_places", F.sort_array(F.transform(F.filter("_twin", same), lambda x: x["p"])))
    cover = F.transform("_places", lambda p, i: F.least(F.coalesce(F.get("_places", i + 1) - p, F.lit(window)), F.lit(window)).cast("long"))
    return docs.withColumn(out, total(cover)).drop("_hash", "_mask", "_packed", "_twin", "_places")


def histogram(ids: Column) -> Column:
    """Counts of the numbers in an array, as (id, n) of those that occur."""
    ends = lambda s: F.filter(F.transform(s, lambda x, i: F.when(~x.eqNullSafe(F.get(s, i + 1)), F.struct(x.alias("id"), (i + 1).alias("upto")))), lambda e: e.isNotNull())
    counts = lambda e: F.transform(e, lambda x, i: F.struct(x["id"].alias("id"), (x["upto"] - F.coalesce(F.get(e, i - 1)["upto"], F.lit(0))).cast("long").alias("n")))
    return let(let(F.sort_array(ids), ends), counts)


def js_distance(present: Column, n: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram, given as (id, count) of the ids that occur, and a reference
    (array of shares, by id). Ids that do not occur add half their share."""

    def term(x: Column) -> Column:
        p, q = x["n"] / n, F.coalesce(F.get(reference, x["id"]), F.lit(0.0))
        return let(F.struct(p.alias("p"), q.alias("q")), lambda s: s["p"] * F.log2(s["p"] * 2 / (s["p"] + s["q"])) + F.when(s["q"] > 0, s["q"] * F.log2(s["q"] * 2 / (s["p"] + s["q"]))).otherwise(0.0) - s["q"])

    found = F.filter(present, lambda x: x["n"] > 0)
    return F.sqrt(F.greatest((F.lit(1.0) + total(F.transform(found, term), "double")) / 2, F.lit(0.0)))


def language_references(docs: DataFrame, common_words: int) -> DataFrame:
    """(language, common, word_shares, class_shares) over all rows of (language, words, classes).

    ``common`` are the most frequent words, ties by code point; share 0 is that
    of all other words. One partial aggregation and a top-n by language, which
    Spark limits before its shuffle.
    """
    counts = docs.select("language", F.explode("words").alias("word")).groupBy("language", "word").agg(F.count("*").alias("n"))
    order = Window.partitionBy("language").orderBy(F.desc("n"), "word")
    short = counts.filter(F.length("word") <= LONGEST_COMMON_WORD)
    top = short.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= common_words)
    lists = top.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("top"))
    sums = docs.groupBy("language").agg(
        F.sum(F.size("words").cast("long")).alias("n_words"), F.array(*[F.sum(F.col("classes")[i]) for i in range(len(CLASSES) + 1)]).alias("classes"))
    lists = lists.withColumnRenamed("language", "_language")
    joined = sums.join(lists, F.col("language").eqNullSafe(F.col("_language")), "left")
    top_or_none = F.coalesce("top", F.array().cast(lists.schema["top"].dataType))
    in_top = total(F.transform(top_or_none, lambda x: x["n"]))
    word_shares = F.concat(F.array((F.col("n_words") - in_top) / F.greatest("n_words", F.lit(1))), F.transform(top_or_none, lambda x: x["n"] / F.col("n_words")))
    all_chars = total(F.col("classes"))
    return joined.select("language", F.transform(top_or_none, lambda x: x["word"]).alias("common"), word_shares.alias("word_shares"),
                         F.transform("classes", lambda c: c / F.greatest(all_chars, F.lit(1))).alias("class_shares"))


def divergence_rules(
    docs: DataFrame,
    common_words: int = 24,
    max_class_distance: float = 0.27,
    max_word_distance: float = 0.45,
    min_chars: int = 200,
    min_words: int = 50,
    max_languages: int = 500,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance,
    word_distance, kept.

    The base fails a row with fewer than ``min_words`` words or more than half
    of them in repeated windows; the method fails one whose distance is above a
    bound, if it has ``min_chars`` characters or ``min_words`` words. Null
    languages, and those beyond the ``max_languages`` most frequent, share one
    reference. A null text has no words and fails the base; null ids stay null;
    repeated rows give repeated rows; an empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    often = rows.groupBy("lang").agg(F.count("*").alias("n")).filter("lang IS NOT NULL").orderBy(F.desc("n"), "lang").limit(max_languages)
    languages = [r["lang"] for r in often.select("lang").collect()]
    own = F.when(F.col("lang").isin(languages), F.col("lang")) if languages else F.lit(None).cast("string")
    rows = rows.select("doc_id", "text", own.alias("language")).withColumn("words", words_of(F.col("text")))
    counted = counted_characters(rows, "text")
    references = language_references(counted.select("language", "words", "classes"), common_words)
    references = F.broadcast(references.withColumnRenamed("language", "_language"))
    counted = counted.withColumn("n_dup_lines", repeated_lines(F.col("text"))).drop("text")
    counted = repeated_words(counted, "words", "n_repeat_words")
    joined = counted.join(references, F.col("language").eqNullSafe(F.col("_language")), "left")
    ids = F.transform("words", lambda w: F.array_position("common", w).cast("int"))
    joined = joined.withColumn("n_words", F.size("words").cast("long")).withColumn("_found", histogram(ids)).drop("words")
    classes = F.transform("classes", lambda n, i: F.struct(i.alias("id"), n.alias("n")))
    joined = joined.withColumn("class_distance", F.when(F.col("n_chars") >= min_chars, js_distance(classes, F.col("n_chars"), F.col("class_shares"))))
    joined = joined.withColumn("word_distance", F.when(F.col("n_words") >= min_words, js_distance(F.col("_found"), F.col("n_words"), F.col("word_shares"))))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= max_class_distance) & (F.coalesce("word_distance", F.lit(0.0)) <= max_word_distance)
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         "class_distance", "word_distance", (~failed & near).alias("kept"))
