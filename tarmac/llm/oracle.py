"""The queries of operators that SQL can state, for DuckDB."""

PASSAGES = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS body
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs)
), repeated AS (
    SELECT doc_id, i
    FROM windows
    QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, i) > 1
), words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs
), covered AS (
    SELECT w.doc_id, w.i, w.word,
           max(r.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS 19 PRECEDING) IS NOT NULL AS gone
    FROM words AS w LEFT JOIN repeated AS r ON w.doc_id = r.doc_id AND w.i = r.i
)
SELECT d.doc_id,
       count(c.i) AS n_words,
       count(*) FILTER (c.gone) AS n_removed,
       sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.i) FILTER (NOT c.gone), '')) AS kept_sha256
FROM docs AS d LEFT JOIN covered AS c ON d.doc_id = c.doc_id
GROUP BY d.doc_id
"""

LEXICAL = r"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), postings AS (
    SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term
), lengths AS (
    SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), totals AS (
    SELECT count(*) AS documents, cast(sum(n) AS BIGINT) AS occurrences FROM lengths
), weights AS (
    SELECT term, cast(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, totals GROUP BY term, documents
), impacts AS (
    SELECT doc_id, term,
           w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // occurrences)))
               AS impact
    FROM postings JOIN lengths USING (doc_id) JOIN weights USING (term), totals
), queries AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM benchmark)
    GROUP BY item_id, term
), scores AS (
    SELECT item_id, doc_id, cast(sum(times * impact) AS BIGINT) AS score
    FROM queries JOIN impacts USING (term)
    GROUP BY item_id, doc_id
    HAVING sum(times * impact) > 0
)
SELECT item_id,
       cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores
QUALIFY rank <= 10
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), lists AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), phrases AS (
    SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM lists, unnest([1, 2, 3, 4, 5]) AS sizes(size)
          WHERE len(words) >= size)
), counts AS (
    SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL HAVING count(*) >= 100
), totals AS (
    SELECT lang, cast(sum(len(words)) AS BIGINT) AS n FROM lists GROUP BY lang
), cuts AS (
    SELECT c.lang, c.phrase, c.size, c.f AS a, k,
           array_to_string(parts[:k], ' ') AS head, array_to_string(parts[k + 1:], ' ') AS tail
    FROM (SELECT *, string_split(phrase, ' ') AS parts, unnest(range(1, size)) AS k
          FROM counts WHERE size > 1) AS c
), scores AS (
    SELECT cuts.lang, cuts.phrase, cuts.size, a, k, l.f AS l, r.f AS r, n,
           cast((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM cuts
    JOIN counts AS l ON l.lang = cuts.lang AND l.phrase = head
    JOIN counts AS r ON r.lang = cuts.lang AND r.phrase = tail
    JOIN totals ON totals.lang = cuts.lang
    QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1
), spans AS (
    SELECT lang, size, f, parts, unnest(range(2, size)) AS short
    FROM (SELECT *, string_split(phrase, ' ') AS parts FROM counts WHERE size > 2)
), inner_parts AS (
    SELECT lang, f, array_to_string(parts[i:i + short - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, size - short + 2)) AS i FROM spans)
), kept AS (
    SELECT * FROM scores AS s
    WHERE NOT EXISTS (SELECT 1 FROM inner_parts AS p
                      WHERE p.lang = s.lang AND p.phrase = s.phrase AND 100 * p.f >= 100 * s.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept
QUALIFY rank <= 2000
"""

CONTAMINATION = r"""
WITH docs AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
    FROM documents
), items AS (
    SELECT item_id, words, least(13, len(words)) AS size
    FROM (SELECT item_id, regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
          FROM benchmark)
    WHERE len(words) > 0
), wanted AS (
    SELECT DISTINCT cast(item_id AS varchar) AS item_id, size,
           array_to_string(words[i:i + size - 1], ' ') AS body
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)
), found AS (
    SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS body
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM docs, (SELECT DISTINCT size FROM wanted) WHERE len(words) >= size)
), hits AS (
    SELECT doc_id, i, size, item_id FROM found JOIN wanted USING (size, body)
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
    FROM hits GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
