"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op9_segment_topk"] = """
WITH taking_part AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id,
           CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * r.v[i])) AS BIGINT) AS score
    FROM taking_part q JOIN taking_part r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""

SQL["op3_substring_dedup"] = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram
    FROM docs, unnest(range(1, len(w) - 11)) AS t(i)
), firsts AS (
    SELECT gram, min(doc_id) AS first_id FROM windows GROUP BY gram
), covered AS (
    SELECT DISTINCT doc_id, i + j AS place
    FROM windows JOIN firsts USING (gram), unnest(range(0, 13)) AS t(j)
    WHERE first_id < doc_id
), words AS (
    SELECT doc_id, i AS place, w[i] AS word FROM docs, unnest(range(1, len(w) + 1)) AS t(i)
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept_text, count(*) AS n_kept
    FROM words ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

SQL["op5_ngram_join"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM docs, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i)
    WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reach(doc_id, seen) AS (
    SELECT doc_id, doc_id FROM docs
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(seen) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

SQL["op7_source_mixing"] = r"""
WITH docs AS (
    SELECT doc_id, source, size, row_number() OVER (PARTITION BY doc_id, source, size) AS copy
    FROM (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents)
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), placed AS (
    SELECT *, list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INTEGER)) AS weight, 3 * source_size AS room
    FROM sizes
), filled AS (
    SELECT *, coalesce(sum(room) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_room,
           sum(weight) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
           sum(source_size) OVER () AS total
    FROM placed
), levels AS (
    SELECT *, CAST(total - full_room AS BIGINT) / CAST(open_weight AS BIGINT) AS own_level FROM filled
), targets AS (
    SELECT source, source_size, least(weight * (SELECT own_level FROM levels WHERE room / weight >= own_level ORDER BY room / weight, source NULLS LAST LIMIT 1), CAST(room AS DOUBLE)) AS target FROM levels
), streams AS (
    SELECT docs.*, source_size, target,
           coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY md5(concat_ws('|', 7, coalesce(CAST(doc_id AS VARCHAR), ''), size, copy))
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0
            ELSE (CAST(floor(target) AS BIGINT) // source_size) * size
                 + greatest(0, least(size, CAST(floor(target) AS BIGINT) % source_size - start)) END AS BIGINT) AS taken
FROM streams
"""

#: Divergence of two histograms (lists of shares), as a square of the distance.
JS = "list_sum(list_transform(list_zip({p}, {q}), lambda x: CASE WHEN x[1] > 0 THEN x[1] * log2(2 * x[1] / (x[1] + x[2])) ELSE 0 END + CASE WHEN x[2] > 0 THEN x[2] * log2(2 * x[2] / (x[1] + x[2])) ELSE 0 END)) / 2"

SQL["op1_divergence_rules"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents
), worded AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
           regexp_replace(t, '[a-z]+', '', 'g') AS t1 FROM docs
), stripped AS (
    SELECT *, regexp_replace(t1, '[\x20\x09-\x0D]+', '', 'g') AS t2 FROM worded
), stripped3 AS (SELECT *, regexp_replace(t2, '[A-Z]+', '', 'g') AS t3 FROM stripped
), stripped4 AS (SELECT *, regexp_replace(t3, '[0-9]+', '', 'g') AS t4 FROM stripped3
), stripped5 AS (SELECT *, regexp_replace(t4, '\p{{L}}+', '', 'g') AS t5 FROM stripped4
), counted AS (
    SELECT r, doc_id, lang, w, l, length(t) AS n_chars, length(t) - (length(t1) - length(t2)) AS word_chars,
           length(t2) - length(regexp_replace(t2, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
           [length(t) - length(t1), length(t1) - length(t2), length(t2) - length(t3), length(t3) - length(t4), length(t4) - length(t5),
            length(t5) - length(regexp_replace(t5, '[.,;:!?''"()-]+', '', 'g')), length(regexp_replace(t5, '[.,;:!?''"()-]+', '', 'g'))] AS classes
    FROM stripped5
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM counted, unnest(range(1, len(w) - 1)) AS u(i)
), repeats AS (
    SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM windows, unnest([0, 1, 2]) AS u(j) WHERE n > 1 GROUP BY r
), vocabulary AS (
    SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM counted) GROUP BY lang, word
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM vocabulary WHERE length(word) <= 40
), words_of AS (
    SELECT lang, sum(n) AS n_words FROM vocabulary GROUP BY lang
), common AS (
    SELECT lang, list(word ORDER BY place) AS words, list(n ORDER BY place) AS counts FROM ranked WHERE place <= 24 GROUP BY lang
), class_sums AS (
    SELECT lang, list_transform(range(1, 8), lambda i: CAST(list_extract([sum(classes[1]), sum(classes[2]), sum(classes[3]), sum(classes[4]), sum(classes[5]), sum(classes[6]), sum(classes[7])], i) AS DOUBLE)) AS sums
    FROM counted GROUP BY lang
), refs AS (
    SELECT class_sums.lang, list_transform(sums, lambda x: x / greatest(list_sum(sums), 1)) AS class_shares, coalesce(words, []) AS words,
           list_prepend(coalesce((n_words - list_sum(counts)) / n_words, 0), list_transform(coalesce(counts, []), lambda c: c / n_words)) AS word_shares
    FROM class_sums LEFT JOIN common ON class_sums.lang IS NOT DISTINCT FROM common.lang LEFT JOIN words_of ON class_sums.lang IS NOT DISTINCT FROM words_of.lang
), found AS (
    SELECT r, list_position(words, word) AS id, count(*) AS n
    FROM (SELECT r, lang, unnest(w) AS word FROM counted) AS d JOIN refs ON d.lang IS NOT DISTINCT FROM refs.lang GROUP BY r, id
), histograms AS (
    SELECT r, map(list(coalesce(id, 0)), list(n)) AS h FROM found GROUP BY r
), judged AS (
    SELECT doc_id, len(w) AS n_words, word_chars, n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_chars,
           list_transform(classes, lambda c: c / greatest(n_chars, 1)) AS class_p, class_shares,
           list_transform(range(0, len(word_shares)), lambda i: coalesce(h[i], 0) / greatest(len(w), 1)) AS word_p, word_shares
    FROM counted JOIN refs ON counted.lang IS NOT DISTINCT FROM refs.lang LEFT JOIN repeats USING (r) LEFT JOIN histograms USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND (n_chars < 200 OR sqrt(greatest({JS.format(p='class_p', q='class_shares')}, 0)) <= 0.27)
       AND sqrt(greatest({JS.format(p='word_p', q='word_shares')}, 0)) <= 0.45 AS kept
FROM judged
"""

SQL["op12_decontamination"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
    FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i)
    WHERE len(w) > 0
), doc_windows AS (
    SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS gram
    FROM docs, (SELECT DISTINCT m FROM windows) AS s, unnest(range(1, len(w) - m + 2)) AS t(i)
), found AS (
    SELECT r, i, m, item_id FROM doc_windows JOIN windows USING (m, gram)
), hits AS (
    SELECT r, count(DISTINCT i + j) AS n_hit FROM found, unnest(range(0, m)) AS t(j) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

SQL["op13_hard_negatives"] = """
WITH taking_part AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS anchor_id, x.vec_id, q.label = x.label AS alike,
           CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score
    FROM taking_part q JOIN taking_part x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
    WHERE q.vec_id % 100 = 0
), positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM scored WHERE alike) WHERE place <= 5
), paired AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.r, p.place ORDER BY n.score DESC, n.vec_id) AS place
    FROM positives p JOIN scored n ON n.r = p.r AND NOT n.alike
     AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM paired WHERE place <= 10
"""
