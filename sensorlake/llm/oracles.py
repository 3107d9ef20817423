"""DuckDB counterparts of the registered queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark),
grams AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n,
           array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM grams),
seen AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
),
hits AS (SELECT doc_id, i, n, item_id FROM seen JOIN grams USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(said, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP9 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
    SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
first_doc AS (SELECT g, min(doc_id) AS m FROM windows GROUP BY g),
gone AS (
    SELECT DISTINCT doc_id, k FROM (
        SELECT doc_id, unnest(range(i, i + 50)) AS k FROM windows JOIN first_doc USING (g) WHERE doc_id > m
    )
),
kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY k) AS said
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d)
    ANTI JOIN gone USING (doc_id, k)
    GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) AS BIGINT) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(said, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
copies AS (
    SELECT doc_id, said, n, min(doc_id) OVER (PARTITION BY said) AS copy_id
    FROM (SELECT doc_id, string_agg(g, '|' ORDER BY g) AS said, count(*) AS n FROM shingles GROUP BY doc_id)
),
sets AS (SELECT doc_id AS s, n FROM copies WHERE doc_id = copy_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b USING (g)
    WHERE a.doc_id <> b.doc_id AND a.doc_id IN (SELECT s FROM sets) AND b.doc_id IN (SELECT s FROM sets)
    GROUP BY ALL
),
links AS (
    SELECT x, y FROM shared JOIN sets a ON a.s = x JOIN sets b ON b.s = y WHERE 9 * shared.n >= 4 * (a.n + b.n)
),
reached AS (
    SELECT s AS x, s AS y FROM sets
    UNION
    SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x
),
classes AS (SELECT x, min(y) AS class_id FROM reached GROUP BY x),
degrees AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(copy_id, d.doc_id) AS copy_id, coalesce(n_links, 0) AS n_links
FROM d LEFT JOIN copies USING (doc_id) LEFT JOIN classes ON classes.x = copy_id LEFT JOIN degrees ON degrees.x = copy_id
"""

_MASKED = """
    array_to_string(list_transform(
        list_filter(range(1, len({rest}) + 1), lambda i: {rest}[i].role = 'assistant'),
        lambda i: concat(
            list_sum(list_concat([0], list_transform({rest}[1:i - 1], lambda t: len(t.role) + 5 + len(t.said) + 9))) + len({rest}[i].role) + 5, ':',
            list_sum(list_transform({rest}[1:i], lambda t: len(t.role) + 5 + len(t.said) + 9)))
    ), ',')
"""

_TOLD = "array_to_string(list_transform({turns}, lambda t: concat('<|', t.role, '|>', chr(10), t.said, chr(10), '<|end|>', chr(10))), '')"

OP8 = f"""
WITH rows AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
    SELECT conv_id, list({{'role': role, 'text': text, 'said': replace(text, '<|', '< |')}} ORDER BY turn NULLS FIRST, role, text) AS turns,
           sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS learned
    FROM rows GROUP BY conv_id
),
prefixes AS (
    SELECT conv_id, learned, i AS depth, sha256(to_json(turns[1:i])) AS prefix
    FROM (SELECT *, unnest(range(1, len(turns) + 1)) AS i FROM whole)
),
shared AS (
    SELECT prefix, first(conv_id ORDER BY learned DESC, conv_id) AS best, last(conv_id ORDER BY learned DESC, conv_id) AS final
    FROM prefixes GROUP BY prefix HAVING count(*) > 1
),
deepest AS (SELECT conv_id, arg_max(best, depth) AS best, arg_max(final, depth) AS final FROM prefixes JOIN shared USING (prefix) GROUP BY conv_id),
pairs AS (
    (SELECT DISTINCT best AS chosen_id, CASE WHEN conv_id = best THEN final ELSE conv_id END AS rejected_id, CAST(NULL AS BIGINT) AS cut FROM deepest)
    UNION ALL
    (SELECT conv_id, conv_id, coalesce(list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) - 1, len(turns))
     FROM whole ANTI JOIN deepest USING (conv_id))
),
sides AS (
    SELECT chosen_id, rejected_id, x.turns AS c, CASE WHEN cut IS NULL THEN y.turns ELSE y.turns[1:cut] END AS r
    FROM pairs JOIN whole x ON x.conv_id = chosen_id JOIN whole y ON y.conv_id = rejected_id
),
split AS (
    SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] <> r[i])) - 1, least(len(c), len(r))) AS n FROM sides
),
parts AS (SELECT *, c[n + 1:] AS c_rest, r[n + 1:] AS r_rest FROM split)
SELECT chosen_id, rejected_id, CAST(n AS INTEGER) AS n_prompt_turns, {_TOLD.format(turns="c[1:n]")} AS prompt,
       {_TOLD.format(turns="c_rest")} AS chosen, {_TOLD.format(turns="r_rest")} AS rejected,
       {_MASKED.format(rest="c_rest")} AS chosen_mask, {_MASKED.format(rest="r_rest")} AS rejected_mask
FROM parts
"""

#: Documents as files of a directory tree, as op2 has them.
_AS_FILES = """
    SELECT CASE (doc_id // 20) % 30
               WHEN 0 THEN concat(source, '/LICENSE.', doc_id)
               WHEN 10 THEN concat(source, '/d', doc_id // 20000, '/LICENSE.', doc_id)
               WHEN 20 THEN concat(source, '/d', doc_id // 20000, '/d', doc_id // 1000, '/LICENSE.', doc_id)
               ELSE concat(source, '/d', doc_id // 20000, '/d', doc_id // 1000, '/', doc_id, '.txt') END AS path, text
    FROM documents
"""


def licences(files: str) -> str:
    """The licence scan of a query that gives (path, text)."""
    from sensorlake.llm import licenses

    rows = ", ".join("('{}', '{}')".format(name, notice.replace("'", "''")) for name, notice in licenses.TEMPLATES)
    words = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda w: w <> '')"
    phrase = "concat(' ', array_to_string({}, ' '), ' ')".format(words)
    return rf"""
WITH notices(license, notice) AS (VALUES {rows}),
vocabulary AS (SELECT DISTINCT unnest({words.format("notice")}) AS word FROM notices),
files AS ({files}),
total AS (SELECT count(*) AS files FROM files),
df AS (
    SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct({words.format("coalesce(text, '')")})) AS word FROM files)
    WHERE word IN (SELECT word FROM vocabulary) GROUP BY word
),
idf AS (SELECT word, ln((files + 1) / (coalesce(df, 0) + 1)) + 1 AS weight FROM vocabulary LEFT JOIN df USING (word), total),
cued AS (
    SELECT path, regexp_matches(split_part(path, '/', -1), '{licenses.LICENCE_FILE}') AS licence_file, text,
           regexp_replace(text, '(?m)^[ \t]*(?:REM|dnl)\b', '', 'g') AS unmarked
    FROM files WHERE regexp_matches(lower(text), '{licenses.CUE}')
),
parted AS (
    SELECT path, licence_file, text, list_filter(list_concat(string_split(text, chr(10)), list_concat(
               regexp_split_to_array(unmarked, '\n[ \t\r]*\n'),
               regexp_split_to_array(regexp_replace(unmarked, '(?m)^[^A-Za-z0-9\n]+$', '', 'g'), '\n\n+'))),
           lambda part: regexp_matches(lower(part), '{licenses.CUE}')) AS parts
    FROM cued
),
headers AS (SELECT DISTINCT path, licence_file, unnest(CASE WHEN licence_file THEN list_append(parts, text) ELSE parts END) AS header FROM parted),
texts AS (SELECT DISTINCT header AS id, NULL AS license, header AS said FROM headers UNION ALL SELECT notice, license, notice FROM notices),
counts AS (SELECT id, license, word, count(*) AS tf FROM (SELECT id, license, unnest({words.format("said")}) AS word FROM texts) GROUP BY ALL),
weighed AS (SELECT id, license, word, weight, tf * coalesce(weight, ln(files + 1) + 1) AS x FROM counts LEFT JOIN idf USING (word), total),
units AS (
    SELECT id, license, word, x / norm AS x FROM weighed
    JOIN (SELECT id AS n_id, license AS n_license, sqrt(sum(x * x)) AS norm FROM weighed GROUP BY ALL) ON id = n_id AND license IS NOT DISTINCT FROM n_license
    WHERE weight IS NOT NULL
),
close AS (
    SELECT h.id AS header, t.license, round(sum(h.x * t.x), 6) AS score
    FROM units h JOIN units t USING (word) WHERE h.license IS NULL AND t.license IS NOT NULL GROUP BY h.id, t.id, t.license
),
nearest AS (SELECT header, first(license ORDER BY score DESC, license) AS license, max(score) AS score FROM close WHERE score >= {licenses.LEAST_SCORE} GROUP BY header),
phrases AS (SELECT DISTINCT license, {phrase.format("notice")} AS said, len({words.format("notice")}) AS n FROM notices),
held AS (
    SELECT header, first(license ORDER BY license = '{licenses.NONE_GRANTED}', n DESC, license) AS license
    FROM (SELECT DISTINCT header, {phrase.format("header")} AS whole FROM headers) JOIN phrases ON contains(whole, said) GROUP BY header
),
tags AS (SELECT DISTINCT header, regexp_extract(header, '{licenses.SPDX}', 1) AS tag FROM headers),
tagged AS (
    SELECT header, coalesce(first(license), any_value(tag)) AS license
    FROM tags LEFT JOIN (SELECT DISTINCT license FROM notices) ON lower(license) = regexp_replace(lower(tag), '(-only|-or-later|\+)$', '')
    WHERE tag <> '' GROUP BY header
),
best AS (
    SELECT * FROM (
        SELECT header, coalesce(t.license, n.license, h.license) AS license, CASE WHEN t.license IS NOT NULL OR n.license IS NULL THEN 1.0 ELSE n.score END AS score
        FROM (SELECT DISTINCT header FROM headers) LEFT JOIN tagged t USING (header) LEFT JOIN nearest n USING (header) LEFT JOIN held h USING (header)
    ) WHERE license IS NOT NULL
),
own AS (
    SELECT path, any_value(licence_file) AS licence_file, first(license ORDER BY license = '{licenses.NONE_GRANTED}', score DESC, license) AS license,
           first(score ORDER BY license = '{licenses.NONE_GRANTED}', score DESC, license) AS score
    FROM headers JOIN best USING (header) GROUP BY path
),
given AS (
    SELECT regexp_extract(path, '^(.*/)', 1) AS place, first(license ORDER BY score DESC, path) AS license, max(score) AS score
    FROM own WHERE licence_file GROUP BY 1
),
inherited AS (
    SELECT path, given.place, given.license, given.score, row_number() OVER (PARTITION BY path ORDER BY len(given.place) DESC) AS near
    FROM (SELECT DISTINCT path FROM files) JOIN given ON starts_with(path, given.place)
)
SELECT path, coalesce(own.license, i.license) AS license, CAST(coalesce(own.score, i.score) AS DOUBLE) AS score,
       CASE WHEN own.license IS NOT NULL THEN 'header' WHEN i.license IS NOT NULL THEN 'inherited' END AS found,
       CASE WHEN own.license IS NULL THEN i.place END AS given_by
FROM files LEFT JOIN own USING (path) LEFT JOIN (SELECT * FROM inherited WHERE near = 1) i USING (path)
"""


OP2 = licences(_AS_FILES)

OP12 = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
           sha256(concat('42:', doc_id)) AS h
    FROM documents
),
drawn AS (
    SELECT *, len(u) AS n, CAST(concat('0x', h[1:8]) AS BIGINT) % (len(u) + 1) AS a, CAST(concat('0x', h[9:16]) AS BIGINT) % (len(u) + 1) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST(concat('0x', h[17:24]) AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST(concat('0x', h[25:32]) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM d
),
cut AS (
    SELECT *, array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
           array_to_string(u[greatest(a, b) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                        ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

OP13 = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
),
kept AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 3
),
kinds AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
occurs AS (
    SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN kept USING (lang, term) GROUP BY ALL
),
grouped AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM grouped LEFT JOIN occurs USING (lang, source) GROUP BY ALL),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 1)) // (g.total + kinds.v) AS p
    FROM sizes g JOIN kept k USING (lang) JOIN kinds USING (lang) LEFT JOIN occurs o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
),
whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)) AS q
    FROM occurs JOIN kinds USING (lang) GROUP BY lang, term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT)
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {"op1_decontamination": OP1, "op2_license_scan": OP2, "op6_exact_top_k": OP6, "op7_ngram_jaccard": OP7, "op8_chat_formatting": OP8, "op9_substring_dedup": OP9, "op12_fill_in_middle": OP12, "op13_source_divergence": OP13}
