"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import string

LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
SPACED_WORDS = r"'[^\x20\x09-\x0D]+'"
PLAIN_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP4 = rf"""
WITH doc AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), {SPACED_WORDS}) AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), win AS (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(w[p:p + 4], ' ')) AS times
    FROM doc, unnest(range(1, len(w) - 3)) AS t(p)
), repeated AS (
    SELECT doc_id, count(DISTINCT q) AS n FROM win, unnest(range(p, p + 5)) AS t(q)
    WHERE times > 1 GROUP BY doc_id
), m AS (
    SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
           len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines
    FROM doc LEFT JOIN repeated r USING (doc_id)
), v AS (
    SELECT *, CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS v1,
           CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS v2,
           CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS v3,
           CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS v4
    FROM m
), cell AS (
    SELECT lang, source, k, x >> s << s AS bucket FROM (
        SELECT lang, source, k, x, greatest(length(bin(x)) - 6, 0)::INTEGER AS s FROM (
            SELECT lang, source, unnest([1, 2, 3, 4]) AS k, unnest([v1, v2, v3, v4])::BIGINT AS x
            FROM v WHERE n_words > 0))
), grouped AS (
    SELECT 1 AS level, lang, source, k, bucket FROM cell
    UNION ALL SELECT 2, lang, NULL, k, bucket FROM cell
    UNION ALL SELECT 3, NULL, NULL, k, bucket FROM cell
), q AS (
    SELECT level, lang, source, k, count(*) AS n, quantile_disc(bucket, 0.25) AS q25,
           quantile_disc(bucket, 0.5) AS q50, quantile_disc(bucket, 0.75) AS q75
    FROM grouped GROUP BY ALL
), lim AS (
    SELECT level, lang, source, max(n) AS n,
           max(CASE WHEN k = 1 THEN q50 + 8 * greatest(abs(q50 - q25), 10) END) AS l1,
           max(CASE WHEN k = 2 THEN q50 + 8 * greatest(abs(q50 - q25), 25) END) AS l2,
           max(CASE WHEN k = 3 THEN q50 + 8 * greatest(abs(q50 - q25), 25) END) AS l3,
           max(CASE WHEN k = 4 THEN q50 + 8 * greatest(abs(q50 - q25), 40) END) AS l4,
           max(CASE WHEN k = 4 THEN q50 - 8 * greatest(abs(q50 - q75), 40) END) AS l5
    FROM q GROUP BY level, lang, source
), j AS (
    SELECT v.*, x.l1, x.l2, x.l3, x.l4, x.l5, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
    FROM v
    LEFT JOIN lim a ON a.level = 1 AND a.lang IS NOT DISTINCT FROM v.lang AND a.source IS NOT DISTINCT FROM v.source
    LEFT JOIN lim b ON b.level = 2 AND b.lang IS NOT DISTINCT FROM v.lang
    LEFT JOIN lim x ON x.level = CASE WHEN a.n >= 100 THEN 1 WHEN b.n >= 100 THEN 2 ELSE 3 END
        AND (x.level > 2 OR x.lang IS NOT DISTINCT FROM v.lang)
        AND (x.level > 1 OR x.source IS NOT DISTINCT FROM v.source)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(v1 <= l1 AND v2 <= l2 AND v3 <= l3 AND v4 <= l4 AND v4 >= l5, TRUE) AS kept
FROM j
"""

_ESCAPE = (
    r"regexp_replace(regexp_replace({}, '<(\\*)(\||/?s>|</?SYS>>)', '<\\\1\2', 'g'),"
    r" '\[(\\*)(/?INST\])', '[\\\1\2', 'g')"
)
OP5 = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS p,
           sum(length({_ESCAPE.format('role')}) + length({_ESCAPE.format('text')}) + 23)
               OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS so_far,
           count(*) OVER (PARTITION BY conv_id) AS n
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(so_far) FILTER (role = 'assistant' OR p = n) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

OP8 = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all({LOWERED}, {SPACED_WORDS}) AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
    FROM doc, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(p) WHERE len(w) > 0
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN size m ON m.doc_id = a.doc_id JOIN size n ON n.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, m.n, n.n
    HAVING 100 * count(*) >= 80 * (m.n + n.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS other FROM doc
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other
)
SELECT r.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN size USING (doc_id) GROUP BY r.doc_id
"""

OP10 = f"""
WITH item AS (
    SELECT item_id, regexp_extract_all({LOWERED}, {PLAIN_WORDS}) AS w FROM benchmark
), piece AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS words
    FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(p) WHERE len(w) > 0
), doc AS (
    SELECT doc_id, regexp_extract_all({LOWERED}, {PLAIN_WORDS}) AS w FROM documents
), win AS (
    SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS words
    FROM doc, (SELECT DISTINCT k FROM piece), unnest(range(1, len(w) - k + 2)) AS t(p)
), hit AS (
    SELECT doc_id, p, k, item_id FROM win JOIN piece USING (k, words)
), cover AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + k)) AS t(q) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN cover USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP11 = rf"""
WITH piece AS (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents)
), gram AS (
    SELECT lang, w[i:i + k - 1] AS g, count(*) AS f
    FROM piece, (SELECT unnest([1, 2, 3]) AS k), unnest(range(1, len(w) - k + 2)) AS t(i)
    GROUP BY lang, w[i:i + k - 1]
), total AS (
    SELECT lang, sum(f) AS n FROM gram WHERE len(g) = 1 GROUP BY lang
), often AS (
    SELECT * FROM gram WHERE len(g) > 1 AND f >= 10
), cut AS (
    SELECT o.lang, o.g, o.f AS a, o.k, x.f AS l, y.f AS r,
           (1000000::HUGEINT * o.f * o.f) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, g[1:k] AS g1, g[k + 1:] AS g2
          FROM (SELECT *, unnest(range(1, len(g))) AS k FROM often)) o
    JOIN gram x ON x.lang = o.lang AND x.g = o.g1 JOIN gram y ON y.lang = o.lang AND y.g = o.g2
), lowest AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), wider AS (
    SELECT lang, part, max(f) AS f FROM (
        SELECT lang, unnest([g[1:2], g[2:3]]) AS part, f FROM often WHERE len(g) = 3) GROUP BY lang, part
), kept AS (
    SELECT c.*, array_to_string(c.g, ' ') AS phrase FROM lowest c LEFT JOIN wider v ON v.lang = c.lang AND v.part = c.g
    WHERE NOT coalesce(100 * v.f >= 50 * c.a, FALSE)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""

_LEAF = """sha256(concat(
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(({n})::VARCHAR) || ':' || ({n}), '-'),
    coalesce(strlen(text) || ':' || text, '-')))"""
# DuckDB has no crc32: its table of bytes is made first (3988292384 is the reversed polynomial).
OP13 = f"""
WITH RECURSIVE bits AS (
    SELECT b, 0 AS k, b::UBIGINT AS c FROM range(256) AS t(b)
    UNION ALL
    SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8
), doc AS (
    SELECT doc_id, lang, n_chars, {_LEAF.format(n='n_chars')} AS leaf, {_LEAF.format(n='n_chars + 1')} AS changed,
           xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
               lambda x: ascii(x)::UBIGINT)), lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::BIGINT])), 4294967295) % 7 AS r
    FROM documents, crc_table
), leaf AS (
    SELECT doc_id, lang, leaf, CASE WHEN r = 0 AND n_chars IS NOT NULL THEN changed ELSE leaf END AS shown,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
           count(*) OVER (PARTITION BY lang) AS n
    FROM doc
), node AS (
    SELECT lang, 0 AS level, rank, leaf AS digest, n FROM leaf
    UNION ALL
    SELECT lang, level + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 1) // 2
    FROM node WHERE n > 1 GROUP BY lang, level, rank // 2
), subroot AS (
    SELECT lang, digest, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank,
           count(*) OVER () AS n
    FROM node WHERE n = 1
), above AS (
    SELECT 0 AS level, rank, digest, n FROM subroot
    UNION ALL
    SELECT level + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 1) // 2
    FROM above WHERE n > 1 GROUP BY level, rank // 2
), root AS (
    SELECT digest, level AS height FROM above WHERE n = 1
), request AS (
    SELECT l.*, row_number() OVER () AS id, s.digest AS subroot, s.height, s.rank AS place, root.digest AS root,
           root.height AS more
    FROM leaf l JOIN subroot s ON l.lang IS NOT DISTINCT FROM s.lang, root
), walk AS (
    SELECT id, 0 AS level, shown AS node, '' AS proof FROM request
    UNION ALL
    SELECT w.id, w.level + 1,
           sha256(CASE WHEN o.digest IS NULL THEN w.node WHEN o.rank % 2 = 0 THEN o.digest || w.node
                  ELSE w.node || o.digest END), w.proof || coalesce(o.digest, '')
    FROM walk w JOIN request q USING (id)
    LEFT JOIN (SELECT lang, level, rank, digest, FALSE AS top FROM node
               UNION ALL SELECT NULL, level, rank, digest, TRUE FROM above) o
        ON o.top = (w.level >= q.height) AND (o.top OR o.lang IS NOT DISTINCT FROM q.lang)
        AND o.level = w.level - CASE WHEN o.top THEN q.height ELSE 0 END
        AND o.rank = xor((CASE WHEN o.top THEN q.place ELSE q.rank END) >> o.level, 1)
    WHERE w.level < q.height + q.more
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM request JOIN walk USING (id) WHERE level = height + more
"""

ORACLES = {
    "op4_quality_rules": OP4,
    "op5_chat_formatting": OP5,
    "op8_ngram_jaccard": OP8,
    "op10_decontaminate": OP10,
    "op11_phrase_collocations": OP11,
    "op13_merkle_manifest": OP13,
}
