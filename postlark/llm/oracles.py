"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from postlark.llm import clusters, lines, negatives, quality

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_LISTS = ", ".join(
    f"('{lang}', '{word}', {i})" for lang, own in quality.COMMON_WORDS.items() for i, word in enumerate(own))

_PUNCTUATION = quality.PUNCTUATION.replace("'", "''")

QUALITY = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        CASE WHEN lang IN ({", ".join(f"'{x}'" for x in quality.COMMON_WORDS)}) THEN lang ELSE '' END AS lang
    FROM documents
), worded AS (
    SELECT *, {_WORDS} AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM docs
), windows AS (
    SELECT r, i, list_slice(words, i, i + 4) AS gram
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM worded WHERE len(words) >= 5)
), repeated AS (
    SELECT r, count(DISTINCT k) AS n FROM (
        SELECT r, unnest(range(i, i + 5)) AS k
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM windows) WHERE c > 1
    ) GROUP BY r
), base AS (
    SELECT w.r, doc_id, lang, text, words,
        len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM worded w LEFT JOIN repeated USING (r)
), judged AS (
    SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM base
), classes AS (
    SELECT r, lang, base_failed, unnest(['white', 'small', 'capital', 'digit', 'mark', 'symbol', 'letter', 'all']) AS bin, unnest([
        length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')),
        length(regexp_replace(text, '[^a-z]', '', 'g')),
        length(regexp_replace(text, '\P{{Lu}}', '', 'g')),
        length(regexp_replace(text, '[^0-9]', '', 'g')),
        length(regexp_replace(text, '[^.,;:!?''"()-]', '', 'g')),
        n_symbols,
        length(regexp_replace(regexp_replace(text, '[a-z]', '', 'g'), '[\P{{L}}\p{{Lu}}]', '', 'g')),
        length(text)]) AS n
    FROM judged
), class_bins AS (
    SELECT r, lang, base_failed, CASE bin WHEN 'all' THEN 'rest' ELSE bin END AS bin,
        CASE bin WHEN 'all' THEN 2 * n - sum(n) OVER (PARTITION BY r) ELSE n END AS n
    FROM classes
), listed(lang, word, i) AS (VALUES {_LISTS}
), met AS (
    SELECT r, j.lang, i FROM (SELECT r, lang, unnest(words) AS word FROM judged) j JOIN listed l
    ON l.lang = j.lang AND (j.word = l.word OR j.word = upper(l.word[1]) || l.word[2:])
), word_bins AS (
    SELECT j.r, j.lang, j.base_failed, l.i::VARCHAR AS bin, count(m.i) AS n
    FROM judged j JOIN listed l ON l.lang = j.lang LEFT JOIN met m ON m.r = j.r AND m.i = l.i GROUP BY ALL
    UNION ALL
    SELECT j.r, j.lang, j.base_failed, 'rest', n_words - count(m.i) FROM judged j LEFT JOIN met m ON m.r = j.r GROUP BY j.r, j.lang, j.base_failed, n_words
), bins AS (
    SELECT 'c' AS kind, * FROM class_bins UNION ALL SELECT 'w', r, lang, base_failed, bin, n FROM word_bins
), shares AS (
    SELECT kind, r, n / nullif(sum(n) OVER (PARTITION BY kind, r), 0) AS p, m / nullif(sum(m) OVER (PARTITION BY kind, r), 0) AS q
    FROM bins LEFT JOIN (SELECT kind, lang, bin, sum(n) AS m FROM bins WHERE NOT base_failed GROUP BY ALL) USING (kind, lang, bin)
), distances AS (
    SELECT r, kind, sqrt(greatest(sum(
        (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 0)) AS d
    FROM shares GROUP BY r, kind
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed
    AND (word_chars < {quality.MIN_CHARS_COMPARED} OR coalesce(c.d, 0) <= {quality.CHAR_DISTANCE} + {quality.CHAR_CHANCE} / sqrt(word_chars))
    AND (n_words < {quality.MIN_WORDS_COMPARED} OR coalesce(w.d, 0) <= {quality.WORD_DISTANCE} + {quality.WORD_CHANCE} / sqrt(n_words)) AS kept
FROM judged j LEFT JOIN distances c ON c.r = j.r AND c.kind = 'c' LEFT JOIN distances w ON w.r = j.r AND w.kind = 'w'
"""

SPREAD_LINES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, text, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS site FROM documents
), lined AS (
    SELECT r, site, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS place
    FROM docs
), counted AS (
    SELECT r, site, line, place, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS cut,
        len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w
    FROM lined
), wide AS (
    SELECT cut FROM counted WHERE w >= {lines.MIN_LINE_WORDS} GROUP BY cut HAVING count(DISTINCT site) >= {lines.MIN_SITES}
), held AS MATERIALIZED (
    SELECT r, site, cut, w, ('0x' || md5(cut)[1:15])::BIGINT AS h FROM counted WHERE cut IN (SELECT cut FROM wide)
), copies AS (
    SELECT r FROM (SELECT r, sum(w) AS words FROM counted GROUP BY r) JOIN (SELECT r, sum(w) AS met FROM held GROUP BY r) USING (r)
    WHERE met > {lines.COPY_SHARE} * words
), sure AS (
    SELECT cut FROM held WHERE r NOT IN (SELECT r FROM copies) GROUP BY cut HAVING count(DISTINCT site) >= {lines.MIN_SITES}
), unsure AS (
    SELECT * FROM held WHERE cut NOT IN (SELECT cut FROM sure)
), named AS (
    SELECT r, 'c' || min(h) AS who FROM unsure WHERE r IN (SELECT r FROM copies) GROUP BY r
), spread AS (
    SELECT cut FROM sure UNION ALL
    SELECT cut FROM unsure LEFT JOIN named USING (r) GROUP BY cut HAVING count(DISTINCT coalesce(who, site)) >= {lines.MIN_SITES}
), marked AS (
    SELECT c.*, s.cut IS NOT NULL AS met FROM counted c LEFT JOIN spread s ON s.cut = c.cut
), cleaned AS (
    SELECT r, count(*) AS n_lines, count(*) FILTER (met) AS n_met,
        string_agg(line, chr(10) ORDER BY place) FILTER (NOT met) AS rest
    FROM marked GROUP BY r
)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE n_lines END::BIGINT AS n_lines, n_met::BIGINT AS n_removed,
    CASE WHEN n_met = 0 THEN text ELSE coalesce(rest, '') END AS text
FROM docs JOIN cleaned USING (r)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), runs AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) END) AS shingles
    FROM worded
), flat AS MATERIALIZED (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM runs
), links AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS v FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM runs
    UNION
    SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM runs JOIN least USING (doc_id)
"""

_FINITE = "embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"

_ROUNDS = "".join(f"""
), distances{i} AS (
    SELECT r, c, sum((x - m) * (x - m)) AS distance FROM components JOIN centroids{i} USING (d) GROUP BY r, c
), assigned{i} AS MATERIALIZED (
    SELECT r, c, distance FROM distances{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1
), centroids{i + 1} AS MATERIALIZED (
    SELECT c, d, CASE WHEN n IS NULL THEN m ELSE (s - (s % n + n) % n) // n END AS m
    FROM centroids{i} LEFT JOIN (
        SELECT c, d, sum(x) AS s, count(*) AS n FROM assigned{i} JOIN components USING (r) GROUP BY c, d) USING (c, d)"""
                  for i in range(clusters.ROUNDS + 1))

CLUSTERS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({clusters.SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = {clusters.DIMS} AND {_FINITE}
), components AS MATERIALIZED (
    SELECT r, unnest(range({clusters.DIMS})) AS d, unnest(v) AS x FROM kept
), centroids0 AS MATERIALIZED (
    SELECT c, unnest(range({clusters.DIMS})) AS d, unnest(v) AS m FROM (
        SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept) WHERE c < {clusters.CLUSTERS}{_ROUNDS}
), named AS (
    SELECT c, sha256(string_agg(m::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM centroids{clusters.ROUNDS} GROUP BY c
)
SELECT vec_id, c::INT AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM assigned{clusters.ROUNDS} JOIN kept USING (r) JOIN named USING (c)
"""

HARD_NEGATIVES = f"""
WITH taken AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor({negatives.SCALE} * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND {_FINITE}
), scored AS MATERIALIZED (
    SELECT a.r AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.r AS b, b.vec_id AS other_id,
        list_dot_product(a.v, b.v)::BIGINT AS score
    FROM taken a JOIN taken b ON a.vec_id % 100 = 0 AND a.r <> b.r
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id) <= {negatives.POSITIVES}
)
SELECT p.anchor_id, p.other_id AS positive_id,
    row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.other_id)::INT AS rank,
    n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same
    AND {negatives.LEAST_PERCENT} * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= {negatives.NEGATIVES}
"""

ORACLES: dict[str, str] = {
    "op4_quality": QUALITY,
    "op9_spread_lines": SPREAD_LINES,
    "op10_near_duplicates": NEAR_DUPLICATES,
    "op12_clusters": CLUSTERS,
    "op13_hard_negatives": HARD_NEGATIVES,
}
